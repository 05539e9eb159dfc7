"""LM scoring: masked pseudo-likelihood of a bidirectional window network."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.llm.substring import word_bounds, word_hashes
from ringlens.session import settled

#: Words left and right of the predicted one.
SIDES = (-2, -1, 1, 2)
#: Tokens are CLASSES x MEMBERS ids: the FREQUENT most frequent words have their own, all
#: other words share the rest.
CLASSES, MEMBERS, FREQUENT, HASH_BITS = 64, 64, 3072, 63
TOKENS = CLASSES * MEMBERS
SHARED = TOKENS - FREQUENT
#: Words after the frequent ones whose counts go to the tasks, and steps of an octave in
#: which counts are ranked. Counts of all other words are joined.
KNOWN, OCTAVE = 1 << 17, 64
#: Width of the hidden layer; tokens per step and per scoring block; text bytes and tokens at
#: a time.
HIDDEN, STEP, BLOCK, CHUNK, RUN = 24, 1 << 14, 1 << 14, 1 << 21, 1 << 18
#: Training rounds: in round r each document gives its words r, r + rounds, ..., so that
#: every word is predicted once, whatever the number of rounds.
ROUNDS, RATE = 1, 0.1
#: Parts into which parameters are cut to be averaged, and models averaged at a time.
PARTS, FAN_IN = 16, 16

SHAPES = {
    "inputs": (len(SIDES), TOKENS + 1, HIDDEN),
    "hidden": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (CLASSES, HIDDEN, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def split(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the parameters in one flat array."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def start_parameters(counts: np.ndarray, seed: int = 3) -> np.ndarray:
    """Small random weights; biases that give each token its share of the corpus."""
    flat = np.random.default_rng(seed).normal(0, 0.05, SIZE).astype(np.float32)
    p = split(flat)
    p["hidden"][:] = 0
    share = (counts + 0.5).reshape(CLASSES, MEMBERS)
    p["class_bias"][:] = np.log(share.sum(1) / share.sum())
    p["member_bias"][:] = np.log(share / share.sum(1, keepdims=True))
    return flat


def hashed_words(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and ``HASH_BITS``-bit hashes of all words, about ``CHUNK`` bytes at a time.

    Words are split at ASCII white space, A-Z lower-cased. A text longer than a chunk is one.
    """
    words: list[bytes] = []
    numbers: list[int] = []
    counts: list[int] = []
    size = 0

    def flush():
        if not words:
            return
        joined = b" ".join(words)
        h = word_hashes(joined, *word_bounds(joined)) >> np.uint64(64 - HASH_BITS)
        yield np.repeat(numbers, counts), h.astype(np.int64)

    for number, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").lower().split()
        words += own
        numbers.append(number)
        counts.append(len(own))
        size += len(text)
        if size >= CHUNK:
            yield from flush()
            words, numbers, counts, size = [], [], [], 0
    yield from flush()


def _token(rank: np.ndarray) -> np.ndarray:
    """Tokens in order of frequency go to the classes in turn, so that classes have like shares."""
    return (rank % CLASSES) * MEMBERS + rank // CLASSES


@dataclass(frozen=True)
class Words:
    """Tokens of words by hash, and what part of a shared token a word is.

    ``frequent``: sorted hashes of the words with their own token, ``own``. ``known``: sorted
    hashes of the next words, with the logarithms of their counts. ``log_total``: of each
    token's count. Only whole steps of counts are frequent or known, ties not cut, so both
    may be fewer than their limits; results do not depend on how many are known.
    """

    frequent: np.ndarray
    own: np.ndarray
    known: np.ndarray
    log_count: np.ndarray
    total: np.ndarray
    log_total: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> Words:
        """From ``hash, n`` of all words; what is collected is bounded by the constants."""
        leveled = counts.withColumn("level", F.floor(F.log2("n") * OCTAVE))
        room, least = FREQUENT + KNOWN, None
        for row in sorted(leveled.groupBy("level").agg(F.count("*").alias("words")).collect(), reverse=True):
            room -= row.words
            if room < 0:
                break
            least = row.level
        head = leveled.filter(F.col("level") >= F.lit(least)).select("hash", "n").collect()
        head.sort(key=lambda r: (-r.n, r.hash))
        hashes, n = (np.array([r[k] for r in head], np.int64) for k in range(2))
        total = np.zeros(TOKENS, np.int64)
        by = (F.col("hash") % SHARED).alias("shared")
        for row in counts.groupBy(by).agg(F.sum("n").alias("n")).collect():
            total[_token(np.int64(FREQUENT + row.shared))] = row.n
        frequent, own = hashes[:FREQUENT], _token(np.arange(len(hashes[:FREQUENT])))
        np.subtract.at(total, _token(FREQUENT + frequent % SHARED), n[:FREQUENT])
        total[own] = n[:FREQUENT]
        first, then = np.argsort(frequent), np.argsort(hashes[FREQUENT:])
        return cls(
            frequent[first], own[first], hashes[FREQUENT:][then], np.log(n[FREQUENT:][then]),
            total, np.log(np.maximum(total, 1)),
        )

    def __getitem__(self, h: np.ndarray) -> np.ndarray:
        """Tokens of word hashes."""
        at, hit = _find(self.frequent, h)
        return np.where(hit, self.own[at] if len(self.own) else 0, _token(FREQUENT + h % SHARED))

    def shares(self, h: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log(count of word / count of its token), and places of words that are not known,
        whose share still lacks the logarithm of their count."""
        share = np.zeros(len(h))
        tail = np.flatnonzero(token % MEMBERS >= FREQUENT // CLASSES)
        at, hit = _find(self.known, h[tail])
        share[tail] = -self.log_total[token[tail]]
        share[tail[hit]] += self.log_count[at[hit]]
        return share, tail[~hit]


def _find(ordered: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``h`` in sorted numbers, and whether it is there."""
    at = np.minimum(np.searchsorted(ordered, h), max(0, len(ordered) - 1))
    return at, (ordered[at] == h if len(ordered) else np.zeros(np.shape(h), bool))


def contexts(doc: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Tokens at ``SIDES`` of each place; beyond a document's ends, the id ``TOKENS``."""
    out = np.full((len(SIDES), len(token)), TOKENS, np.int64)
    n = len(token)
    for row, side in zip(out, SIDES):
        a, b = max(0, -side), n - max(0, side)
        if a < b:
            same = doc[a:b] == doc[a + side : b + side]
            row[a:b][same] = token[a + side : b + side][same]
    return out


def _hidden(p: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    total = p["inputs"][0][context[0]]
    for table, row in zip(p["inputs"][1:], context[1:]):
        total += table[row]
    total += p["hidden"]
    return np.tanh(total, out=total)


def _far(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Whether scores could leave the range of their exponentials. The hidden layer lies
    within -1 and 1, so only weights that could carry a score too far need the rows' greatest
    scores to be taken off."""
    return np.abs(weights).sum(-2).max(-1) + np.abs(bias).max(-1) > 60


def _logits(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, far: bool) -> np.ndarray:
    z = h @ weights
    z += bias
    if far:
        z -= z.max(axis=1, keepdims=True)
    return z


def _softmax(z: np.ndarray) -> np.ndarray:
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def _picked(z: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log-softmax of one column in each row; ``z`` is used up."""
    own = z[np.arange(len(z)), column]
    np.exp(z, out=z)
    return own - np.log(z @ np.ones(z.shape[1], z.dtype))


def _by_class(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts tokens of one class together, and the classes' edges in it."""
    kind = (token // MEMBERS).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    return order, np.searchsorted(kind[order], np.arange(CLASSES + 1))


def log_probabilities(p: dict[str, np.ndarray], context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Log-probability of each token given both sides: its class, then itself in the class."""
    out = np.empty(len(token), np.float64)
    far, far_in = _far(p["classes"], p["class_bias"]), _far(p["members"], p["member_bias"])
    for at in range(0, len(token), BLOCK):
        order, edges = _by_class(token[at : at + BLOCK])
        order += at
        own, h = token[order], _hidden(p, context[:, order])
        log_p = _picked(_logits(h, p["classes"], p["class_bias"], far), own // MEMBERS).astype(np.float64)
        for c in range(CLASSES):
            of = slice(edges[c], edges[c + 1])
            if of.start < of.stop:
                log_p[of] += _picked(_logits(h[of], p["members"][c], p["member_bias"][c], far_in[c]), own[of] % MEMBERS)
        out[order] = log_p
    return out


class Trainer:
    """Adagrad steps on one task's share of the words."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat.copy()
        self.p = split(self.flat)
        self.squares = np.full(SIZE, 1e-8, np.float32)
        self.seen = 0

    def step(self, context: np.ndarray, token: np.ndarray) -> None:
        p, n = self.p, len(token)
        inputs = int(np.prod(SHAPES["inputs"]))
        grad = np.zeros(SIZE - inputs, np.float32)
        g, at = {}, 0
        for name, shape in list(SHAPES.items())[1:]:
            size = int(np.prod(shape))
            g[name] = grad[at : at + size].reshape(shape)
            at += size
        far, far_in = _far(p["classes"], p["class_bias"]), _far(p["members"], p["member_bias"])
        order, edges = _by_class(token)
        token, context = token[order], context[:, order]
        h = _hidden(p, context)
        member = token % MEMBERS
        d = _softmax(_logits(h, p["classes"], p["class_bias"], far))
        d[np.arange(n), token // MEMBERS] -= 1
        g["classes"][:] = h.T @ d
        g["class_bias"][:] = d.sum(0)
        back = d @ p["classes"].T
        for c in range(CLASSES):
            of = slice(edges[c], edges[c + 1])
            if of.start < of.stop:
                d = _softmax(_logits(h[of], p["members"][c], p["member_bias"][c], far_in[c]))
                d[np.arange(len(d)), member[of]] -= 1
                g["members"][c] = h[of].T @ d
                g["member_bias"][c] = d.sum(0)
                back[of] += d @ p["members"][c].T
        back *= 1 - h * h
        g["hidden"][:] = back.sum(0)
        # Rows of the input tables that no context has do not move, so they are left alone.
        squares = split(self.squares)["inputs"]
        for table, seen, row in zip(p["inputs"], squares, context):
            by = np.argsort(row.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.diff(row[by], prepend=-1))
            rows = row[by[first]]
            slope = np.add.reduceat(back[by], first, axis=0) / n
            seen[rows] += slope * slope
            table[rows] -= slope / np.sqrt(seen[rows]) * np.float32(RATE)
        grad /= n
        rest = self.squares[inputs:]
        rest += grad * grad
        grad /= np.sqrt(rest)
        grad *= np.float32(RATE)
        self.flat[inputs:] -= grad
        self.seen += n


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, h in hashed_words(batch["text"].tolist()):
            found, n = np.unique(h, return_counts=True)
            yield pd.DataFrame({"hash": found, "n": n})


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``hash, n`` of every word of the corpus, as a stored table that grows with it."""
    texts = docs.select(whole(text).alias("text"))
    counted = texts.mapInPandas(_count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    return settled(counted, "lm-words")


def _code(table: Words):
    """Tokens, and what is known of the words' shares, of whole texts."""

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, share = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            tokens, docs, rare = [b""], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc, h in hashed_words(batch["text"].tolist()):
                token = table[h]
                known, unknown = table.shares(h, token)
                n += np.bincount(doc, minlength=len(batch))
                share += np.bincount(doc, known, len(batch))
                tokens.append(token.astype("<u2").tobytes())
                docs.append(doc[unknown])
                rare.append(h[unknown])
            joined, ends = b"".join(tokens), 2 * np.cumsum(n)
            lacking = np.cumsum(np.bincount(np.concatenate(docs), minlength=len(batch)))
            yield batch.drop(columns="text").assign(
                n_words=n, share=share, tokens=[joined[a:b] for a, b in zip(ends - 2 * n, ends)],
                rare=pd.Series(np.split(np.concatenate(rare), lacking[:-1]), batch.index, object),
            )

    return coded


def coded_documents(docs: DataFrame, table: Words, text: str, id: str | None = None) -> DataFrame:
    """``tag, id, n_words, share, tokens, rare`` of every row, stored: two bytes a word, which
    training and scoring read in place of the texts."""
    names = [F.monotonically_increasing_id().alias("tag")]
    kinds = "tag bigint"
    if id is not None:
        names.append(F.col(id).alias("id"))
        kinds += f", id {docs.schema[id].dataType.simpleString()}"
    rows = docs.select(*names, whole(text).alias("text")).mapInPandas(
        _code(table), f"{kinds}, n_words bigint, share double, tokens binary, rare array<bigint>"
    )
    return settled(rows, "lm-tokens")


def _runs(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document numbers, tokens and contexts, about ``RUN`` tokens at a time. A run may end
    inside of a document, whose words beyond it are still in the contexts."""
    token = np.frombuffer(b"".join(batch["tokens"]), "<u2").astype(np.int64)
    doc = np.repeat(np.arange(len(batch)), batch["n_words"])
    reach = max(abs(s) for s in SIDES)
    for at in range(0, len(token), RUN):
        low, high = max(0, at - reach), min(len(token), at + RUN + reach)
        own = slice(at - low, min(at + RUN, len(token)) - low)
        yield doc[low:high][own], token[low:high][own], contexts(doc[low:high], token[low:high])[:, own]


def _train(flat: np.ndarray, turn: int, rounds: int):
    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trainer = Trainer(flat)
        for batch in batches:
            begins = np.cumsum(batch["n_words"].to_numpy()) - batch["n_words"].to_numpy()
            at = 0
            for doc, token, context in _runs(batch):
                place = np.arange(at, at + len(doc)) - begins[doc]
                at += len(doc)
                pick = np.flatnonzero(place % rounds == turn)
                pick = np.random.default_rng(len(pick)).permutation(pick)
                for first in range(0, len(pick), STEP):
                    some = pick[first : first + STEP]
                    trainer.step(context[:, some], token[some])
        if trainer.seen:
            parts = np.array_split(trainer.flat * np.float32(trainer.seen), PARTS)
            yield pd.DataFrame({
                "grp": TaskContext.get().partitionId(), "part": np.arange(PARTS),
                "seen": np.int64(trainer.seen), "blob": [x.astype(np.float32).tobytes() for x in parts],
            })

    return trained


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b, np.float32).astype(np.float64) for b in rows["blob"]], axis=0)
    return pd.DataFrame({
        "grp": rows["grp"].iloc[:1], "part": rows["part"].iloc[:1], "seen": [rows["seen"].sum()],
        "blob": [total.astype(np.float32).tobytes()],
    })


MODEL_ROW = "grp int, part int, seen bigint, blob binary"


def train_coded(coded: DataFrame, table: Words, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters from all coded documents; every word is predicted in one of the rounds.

    In each round every task starts from the same parameters, trains on its own documents and
    hands back what it learnt; these models are averaged by number of words, sixteen at a time
    in a tree of shuffles, so no task and not the driver takes more than a few models, however
    large the input.
    """
    flat = start_parameters(table.total)
    texts = coded.filter("n_words > 0").select("n_words", "tokens")
    for turn in range(rounds):
        models = settled(texts.mapInPandas(_train(flat, turn, rounds), MODEL_ROW), "lm-models")
        groups = models.agg(F.max("grp")).first()[0]
        if groups is None:
            break
        while True:
            groups //= FAN_IN
            models = models.withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("int")).groupBy("grp", "part").applyInPandas(_added, MODEL_ROW)
            if not groups:
                break
        rows = sorted(models.collect(), key=lambda r: r.part)  # PARTS rows, one model
        flat = np.concatenate([np.frombuffer(r.blob, np.float32) / np.float32(r.seen) for r in rows])
    return flat


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[np.ndarray, Words]:
    """Parameters and words from all documents. Word counts cover the whole corpus."""
    table = Words.of(word_counts(docs, text))
    return train_coded(coded_documents(docs, table, text), table, rounds), table


def score_texts(flat: np.ndarray, table: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and summed conditional log-probability of texts, but for the logarithms
    of the counts of words that are not known."""
    batch = next(_code(table)(iter([pd.DataFrame({"text": texts})])))
    return batch["n_words"].to_numpy(), _summed(split(flat), batch) + batch["share"].to_numpy()


def _summed(p: dict[str, np.ndarray], batch: pd.DataFrame) -> np.ndarray:
    """The sum of the tokens' log-probabilities in each coded text."""
    total = np.zeros(len(batch))
    for doc, token, context in _runs(batch):
        total += np.bincount(doc, log_probabilities(p, context, token), len(batch))
    return total


def lm_scores(docs: DataFrame, text: str = "text", id: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """``id, n_words, log_prob`` of every row, from a model trained on all rows.

    ``log_prob`` is the sum over the words of a whole text of the log-probability of the word
    given two words on either side, the word itself masked: that of its token, and of the word
    among all words of the corpus that share the token, by their counts. Counts of words too
    rare to be known to the tasks are joined. Null and empty texts: no words, sum 0. Null and
    repeated ids are rows of their own, an empty table gives an empty result, other columns
    are not read.
    """
    counts = word_counts(docs, text)
    table = Words.of(counts)
    coded = coded_documents(docs, table, text, id)
    flat = train_coded(coded, table, rounds)
    kind = docs.schema[id].dataType.simpleString()

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = _summed(split(flat), batch) + batch["share"].to_numpy()
            yield batch[["tag", "id", "n_words"]].assign(log_prob=total)

    rows = coded.select("tag", "id", "n_words", "share", "tokens").mapInPandas(
        scored, f"tag bigint, id {kind}, n_words bigint, log_prob double"
    )
    lacking = (
        coded.select("tag", F.explode("rare").alias("hash")).join(counts, "hash")
        .groupBy("tag").agg(F.sum(F.log("n")).alias("lacking"))
    )
    return rows.join(lacking, "tag", "left").select(
        "id", "n_words", (F.col("log_prob") + F.coalesce("lacking", F.lit(0.0))).alias("log_prob")
    )
