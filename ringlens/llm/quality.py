"""Quality: how much better good text's zstandard dictionary compresses a document."""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.llm.labelled import held_out, sample_texts, sigmoid

DICTIONARY_BYTES, LEVEL, BLOCK = 112_640, 3, 1024
#: Good and bad documents to learn from, and bytes of each kind.
SAMPLE, SAMPLE_BYTES = 4000, 16 << 20


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the calibration: differences in order, and their scores."""

    good: bytes
    bad: bytes
    at: np.ndarray
    scores: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.interp(differences(self.good, self.bad, texts), self.at, self.scores)


def calibration(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function of ``x`` that fits ``y`` best (pooled neighbours), as points.

    A share of a logistic curve through the same points keeps the order within a step.
    """
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    pools: list[list[float]] = []  # mean, size
    for value in y:
        pools.append([float(value), 1.0])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            mean, n = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][1] + mean * n) / (pools[-1][1] + n), pools[-1][1] + n]
    base = y.mean()
    steps = np.concatenate([np.full(int(n), (mean * n + base) / (n + 1)) for mean, n in pools])
    middle, spread = np.median(x), x.std() or 1.0
    points, first = np.unique(x, return_index=True)
    return points, 0.98 * steps[first] + 0.02 * sigmoid((points - middle) / spread)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    made = zstandard.ZstdCompressionDict(content)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False)


def differences(good: bytes, bad: bytes, texts: list[bytes]) -> np.ndarray:
    """Compressed size with the bad dictionary less that with the good one, per byte.

    A text is compressed in blocks, so that its own past, which helps both alike, doesn't
    drown the dictionaries' share in long texts. All blocks count.
    """
    with_good, with_bad = compressor(good), compressor(bad)
    out = np.empty(len(texts))
    for i, t in enumerate(texts):
        blocks = [t[a : a + BLOCK] for a in range(0, len(t), BLOCK)]
        out[i] = sum(len(with_bad.compress(x)) - len(with_good.compress(x)) for x in blocks) / (len(t) + 1)
    return out


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few texts for training are taken as they are."""
    texts = [t for t in texts if len(t) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY_BYTES]


def _own_lines(kinds: list[list[bytes]]) -> list[list[bytes]]:
    """Texts without lines that several sampled texts have: these tell copies, not quality."""
    seen = Counter(line for texts in kinds for t in texts for line in set(t.split(b"\n")))
    return [[b"\n".join(x for x in t.split(b"\n") if seen[x] == 1) for t in texts] for texts in kinds]


def fit(good: list[bytes], bad: list[bytes]) -> Model:
    """Dictionaries from all texts; the calibration from differences of each half against
    dictionaries of the other half."""
    if not good or not bad:
        return Model(b"", b"", np.zeros(1), np.array([0.98 if good else 0.02 if bad else 0.5]))
    own_good, own_bad = _own_lines([good, bad])
    x, y = [], []
    for half in (0, 1):
        pair = dictionary(own_good[half::2]), dictionary(own_bad[half::2])
        for texts, label in ((good, 1.0), (bad, 0.0)):
            other = texts[1 - half :: 2]
            x.append(differences(*pair, other))
            y.append(np.full(len(other), label))
    return Model(dictionary(own_good), dictionary(own_bad), *calibration(np.concatenate(x), np.concatenate(y)))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from labelled documents that are not held out."""
    known = labels.filter(~held_out(id)).select(F.col(id).alias("id"), F.col(label).alias("y"))
    texts = sample_texts(
        docs, {"good": known.filter("y = 1"), "bad": known.filter("y = 0")}, sample, sample_bytes, text, id
    )
    return fit(texts["good"], texts["bad"])


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", **settings) -> DataFrame:
    """``id, score`` of every row: how likely its whole text is of good quality, 0 to 1.

    Null and empty texts compress alike with both dictionaries and get the score of that
    difference. Null and repeated ids are scored like others, null labels are not learnt
    from, other columns are not read. An empty table gives no rows; with one class or none
    labelled, every document gets the same score.
    """
    model = learn(docs, labels, text, id, **settings)
    kind = docs.schema[id].dataType.simpleString()

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            yield batch[["id"]].assign(score=model.score(texts))

    return docs.select(F.col(id).alias("id"), whole(text).alias("text")).mapInPandas(
        scored, f"id {kind}, score double"
    )
