"""Toxicity: non-negative positive-unlabelled learning on hashed words, stems and parts."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.llm.labelled import held_out, sample_texts, sigmoid
from ringlens.llm.substring import word_hashes

#: Hash space of features; prefix lengths (bytes) of a word that are features, besides the
#: whole word.
BITS = 18
PREFIXES = (4, 5, 6)
#: Words with more bytes have the runs of so many bytes that begin at a later character as
#: features too, the same as a prefix of that length: the stems inside of compounds, and the
#: words of scripts without blanks.
LONG, PART = 8, 6
#: Text bytes whose words are taken at a time.
CHUNK = 1 << 20
#: Positive and unlabelled documents to learn from, and bytes of each kind.
SAMPLE, SAMPLE_BYTES = 10000, 40 << 20
#: Least log-likelihood ratio (Poisson) of a feature's count among toxic texts.
SURPRISE = 8.0


def word_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and feature numbers of every word: hashes of its prefixes, of all of it,
    and of the parts of a long one.

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII bytes.
    """
    data = b"\0".join(texts).lower() + bytes(8)
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    edges = np.diff(inside[codes].view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    length = end - start
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    doc = np.searchsorted(begins, start, side="right") - 1
    docs, keys, kinds = [], [], []

    def add(own: np.ndarray, key: np.ndarray, kind: int) -> None:
        docs.append(own)
        keys.append(key)
        kinds.append(kind)

    for width in PREFIXES:
        keep = length >= width
        add(doc[keep], eight[start[keep]] & np.uint64((1 << 8 * width) - 1), width)
    add(doc, word_hashes(data, start, end), 0)
    long = length > LONG
    parts = length[long] - PART
    at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + np.repeat(start[long] + 1, parts)
    first = codes[at] & 0xC0 != 0x80  # the first byte of a character
    add(np.repeat(doc[long], parts)[first], eight[at[first]] & np.uint64((1 << 8 * PART) - 1), PART)
    features = []
    for key, kind in zip(keys, kinds):
        mixed = (key ^ np.uint64(kind << 60)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        features.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(features)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Numbers of first texts, and texts of about ``CHUNK`` bytes together."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


def present(texts: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a text's number and a wanted feature in it, as its column."""
    pairs = [np.empty(0, np.int64)]
    width = max(1, int(wanted.max(initial=0)) + 1)
    for first, part in _chunks(texts):
        doc, feature = word_features(part)
        column = wanted[feature]
        hit = column >= 0
        pairs.append(np.unique((doc[hit] + first) * width + column[hit]))
    both = np.concatenate(pairs)
    return both // width, both % width


@dataclass(frozen=True)
class Model:
    """``wanted`` gives each feature's column or -1; ``weights`` has a last entry, the bias."""

    wanted: np.ndarray
    weights: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        doc, column = present(texts, self.wanted)
        return sigmoid(np.bincount(doc, self.weights[column], len(texts)) + self.weights[-1])


def _rates(texts: list[bytes]) -> np.ndarray:
    """In how many texts each feature is."""
    total = np.zeros(1 << BITS, np.int64)
    for _, part in _chunks(texts):
        doc, feature = word_features(part)
        total += np.bincount(np.unique((doc << BITS) | feature) & ((1 << BITS) - 1), minlength=1 << BITS)
    return total


def fit(toxic: list[bytes], unlabelled: list[bytes], prior: float, steps: int = 500, rate: float = 0.1, decay: float = 3e-5) -> Model:
    """Weights that minimise the non-negative risk

        prior * E_p[loss(g)] + max(0, E_u[loss(-g)] - prior * E_p[loss(-g)])

    with the logistic loss, by Adam on all of the sample. Where the bracket turns negative,
    the step goes the other way, which undoes the overfit that makes it so. Features are
    those that toxic texts have much oftener than the unlabelled mixture, by more than
    chance would give among so many features; they never count against it.
    """
    prior = min(max(prior, 1e-3), 0.999)
    n_p, n_u = max(1, len(toxic)), max(1, len(unlabelled))
    in_p, in_u = _rates(toxic), _rates(unlabelled)
    expected = (in_u + 1) / n_u * n_p
    surprise = in_p * np.log(np.maximum(in_p, 1) / expected) - (in_p - expected)
    chosen = np.flatnonzero((surprise >= SURPRISE) & (in_p >= max(1.5, 0.6 / prior) * expected))
    wanted = np.full(1 << BITS, -1, np.int64)
    wanted[chosen] = np.arange(len(chosen))
    k = len(chosen)
    (doc_p, col_p), (doc_u, col_u) = present(toxic, wanted), present(unlabelled, wanted)
    w = np.zeros(k + 1)
    w[k] = np.log(prior / (1 - prior))
    m, v = np.zeros(k + 1), np.zeros(k + 1)

    def margin(doc, col, n):
        return np.bincount(doc, w[col], n) + w[k]

    def back(doc, col, slope):
        return np.append(np.bincount(col, slope[doc], k), slope.sum())

    for step in range(1, steps + 1):
        g_p, g_u = margin(doc_p, col_p, n_p), margin(doc_u, col_u, n_u)
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        down = back(doc_u, col_u, sigmoid(g_u) / n_u) - prior * back(doc_p, col_p, sigmoid(g_p) / n_p)
        if negative >= 0:
            grad = down + prior * back(doc_p, col_p, (sigmoid(g_p) - 1) / n_p)
        else:
            grad = -down
        grad[:k] += decay * w[:k]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        np.maximum(w[:k], 0, out=w[:k])
    return Model(wanted, w)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from confirmed toxic documents and unlabelled ones, none of them held out.

    The class prior is the share of toxic rows among the learnable labels. Without any
    toxic example, every document gets that prior's score.
    """
    known = labels.filter(~held_out(id) & F.col(label).isNotNull()).select(F.col(id).alias("id"), F.col(label).alias("y"))
    prior = known.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0] or 0.0
    open_ids = docs.select(F.col(id).alias("id")).filter(~held_out("id"))
    texts = sample_texts(
        docs, {"toxic": known.filter("y = 1"), "unlabelled": open_ids}, sample, sample_bytes, text, id
    )
    if not texts["toxic"]:
        prior = min(max(prior, 1e-3), 0.999)
        return Model(np.full(1 << BITS, -1, np.int64), np.array([np.log(prior / (1 - prior))]))
    return fit(texts["toxic"], texts["unlabelled"], prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", **settings) -> DataFrame:
    """``id, score`` of every row: how likely its text is toxic, from 0 to 1.

    Every word of a whole text counts, and all of each word; null and empty texts get the score of a text without
    any telling word. Null and repeated ids are scored like others, null labels are not
    learnt from, and other columns are not read. Empty tables: no rows, or without labels
    the least score for every row.
    """
    model = learn(docs, labels, text, id, **settings)
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), whole(text).alias("text")).mapInPandas(
        scorer(model), f"id {kind}, score double"
    )


def scorer(model: Model):
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            yield batch.drop(columns="text").assign(score=model.score(texts))

    return scored


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", limit: float = 0.5, **settings) -> DataFrame:
    """The documents that score below ``limit``, with all their columns as they came.

    A document is judged by its text alone: null and empty texts score as one without any
    telling word and stay, long ones are read whole, repeated rows and equal texts get one
    verdict, null and repeated ids stay, and no column's name matters but those given. An
    empty table gives an empty one; without labels every document stays.
    """
    model = learn(docs, labels, text, id, **settings)
    score = F.pandas_udf(lambda t: pd.Series(model.score([x.encode("utf-8", "surrogatepass") for x in t])), "double")
    return docs.filter(score(whole(text)) < limit)
