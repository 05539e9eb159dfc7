"""Ranked lexical search: accumulator-limited term-at-a-time over blocks of documents."""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import plain_bytes, term_blocks, whole
from ringlens.session import settled

#: What a term is made of beside letters and non-ASCII: digits.
DIGITS = b"0123456789"
#: Best documents of an item.
BEST = 20
#: Bytes of item texts searched in one pass over the documents; what goes to the tasks.
ITEM_BYTES = 8 << 20
#: Postings that a task holds at a time.
POSTINGS = 2 << 20
#: The scoring rule's numbers, all in whole numbers.
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE, PERCENT = 1_000_000_000, 1000, 12, 25, 100

PLAIN = plain_bytes(DIGITS)


@dataclass(frozen=True)
class Block:
    """Items searched together: the terms they use, and each item's terms with repeats."""

    ids: list
    codes: dict[bytes, int]
    terms: list[list[tuple[int, int]]]


def item_blocks(items: DataFrame, text: str, id: str, limit: int) -> Iterator[Block]:
    """The items with terms in blocks of about ``limit`` bytes; an item is never cut."""
    rows = items.select(F.col(id).alias("id"), whole(text).cast("binary").alias("raw"))
    ids, counts, held = [], [], 0

    def block() -> Block:
        codes = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        return Block(ids, codes, [sorted((codes[t], n) for t, n in c.items()) for c in counts])

    for row in rows.toLocalIterator():
        count = Counter()
        for words in term_blocks(bytes(row.raw), PLAIN):
            count.update(words)
        if not count:
            continue
        if held and held + len(row.raw) > limit:
            yield block()
            ids, counts, held = [], [], 0
        ids.append(row.id)
        counts.append(count)
        held += len(row.raw)
    if ids:
        yield block()


def postings(docs: DataFrame, block: Block, text: str, id: str) -> DataFrame:
    """``id, n, codes, tfs`` of every document with terms: how many it has with repeats, and
    which of the block's terms how often."""
    codes = block.codes
    kind = docs.schema[id].dataType.simpleString()

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, sizes, which, often = [], [], [], []
            for place, raw in enumerate(batch["raw"]):
                count, n = Counter(), 0
                for words in term_blocks(raw, PLAIN):
                    count.update(words)
                    n += len(words)
                if n:
                    terms = list(count.keys() & codes.keys())
                    kept.append(place)
                    sizes.append(n)
                    which.append([codes[t] for t in terms])
                    often.append([count[t] for t in terms])
            yield pd.DataFrame({"id": batch["id"].iloc[kept].to_numpy(), "n": sizes, "codes": which, "tfs": often})

    return docs.select(F.col(id).alias("id"), whole(text).cast("binary").alias("raw")).mapInPandas(
        found, f"id {kind}, n bigint, codes array<int>, tfs array<bigint>"
    )


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Inverted lists of a few documents, with the gain of each posting."""

    def __init__(self, ids, sizes, codes, tfs, n_docs: int, n_terms: int):
        self.ids = ids
        # the order of ids decides between equal scores; null ids come last
        self.order = pd.Series(ids).rank(method="first", na_option="bottom").to_numpy()
        share = PERCENT - LENGTH_SHARE
        norm = np.array([share + LENGTH_SHARE * int(n) * n_docs // n_terms for n in sizes], np.int64)
        docs = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
        code, tf = np.concatenate(codes), np.concatenate(tfs).astype(np.int64)
        by_term = np.argsort(code, kind="stable")
        self.docs, tf = docs[by_term], tf[by_term]
        self.gain = SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * norm[self.docs])
        terms, begin = np.unique(code[by_term], return_index=True)
        self.span = dict(zip(terms.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(code)])))
        most = np.maximum.reduceat(self.gain, begin) if len(begin) else begin
        self.most = dict(zip(terms.tolist(), most.tolist()))

    def best(self, terms: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents, of those not below ``floor``.

        ``terms`` are (code, weight), rarest first. While a document seen first at this term
        could still reach the k-th best partial score, new documents get an accumulator; from
        then on the terms left only add to those there are, so these end with whole scores.
        """
        terms = [(c, w) for c, w in terms if c in self.span]
        bounds = [w * self.most[c] for c, w in terms]
        left, before = sum(bounds), 0
        score, alive = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        held, growing = np.empty(0, np.int64), True
        for (code, weight), bound in zip(terms, bounds):
            begin, end = self.span[code]
            docs, gain = self.docs[begin:end], weight * self.gain[begin:end]
            if growing and left < floor:
                growing = False
            elif growing and left < before and len(held) >= k:
                growing = left >= np.partition(score[held], -k)[-k]
            there = alive[docs]
            if growing:
                fresh = docs[~there]
                alive[fresh] = True
                held = np.concatenate([held, fresh])
                score[docs] += gain
            else:
                score[docs[there]] += gain[there]
            left -= bound
            before += bound
        held = held[score[held] >= max(1, floor)]
        held = held[np.lexsort((self.order[held], -score[held]))[:k]]
        return held, score[held]


def _shards(batches: Iterator[pd.DataFrame], n_docs: int, n_terms: int) -> Iterator[Shard]:
    """Documents gathered until they hold ``POSTINGS`` postings."""
    parts, held = [], 0

    def shard() -> Shard:
        b = pd.concat(parts, ignore_index=True)
        return Shard(b["id"], b["n"], b["codes"].tolist(), b["tfs"].tolist(), n_docs, n_terms)

    for batch in batches:
        sizes = batch["codes"].map(len).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // POSTINGS)) + 1, [len(batch)]])
        for a, b in zip(cut[:-1], cut[1:]):
            if held and held + sizes[a:b].sum() > POSTINGS:
                yield shard()
                parts, held = [], 0
            parts.append(batch.iloc[a:b])
            held += int(sizes[a:b].sum())
    if held:
        yield shard()


def _ranked(found: DataFrame, block: Block, n_docs: int, n_terms: int, df: dict[int, int], k: int, id_types) -> DataFrame:
    weights = {c: term_weight(n_docs, n) for c, n in df.items()}
    queries = []
    for terms in block.terms:
        rarest = sorted((df[c], c, n) for c, n in terms if c in df)
        queries.append([(c, n * weights[c]) for _, c, n in rarest])

    def search_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tops = [np.empty(0, np.int64)] * len(queries)
        for shard in _shards(batches, n_docs, n_terms):
            items, places, scores = [], [], []
            for q, terms in enumerate(queries):
                floor = int(tops[q][0]) if len(tops[q]) == k else 0
                place, score = shard.best(terms, k, floor)
                tops[q] = np.sort(np.concatenate([tops[q], score]))[-k:]
                items.append(np.full(len(place), q))
                places.append(place)
                scores.append(score)
            yield pd.DataFrame(
                {
                    "item": np.concatenate(items),
                    "id": shard.ids.iloc[np.concatenate(places)].to_numpy(),
                    "score": np.concatenate(scores),
                }
            )

    item_type, doc_type = id_types
    rows = found.filter(F.size("codes") > 0).mapInPandas(search_part, f"item int, id {doc_type.simpleString()}, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    names = found.sparkSession.createDataFrame(
        list(enumerate(block.ids)), f"item int, item_id {item_type.simpleString()}"
    )
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    Items are searched in blocks of bounded size, each in one pass over all documents; the
    terms of a block go to the tasks. In a task documents are gathered to shards of bounded
    size, whose inverted lists are read term at a time; the counts behind the weights are
    those of all documents. The best of the shards are ranked together.

    Null texts have no terms; items without terms have no rows, nor have documents that share
    no term with an item. Equal scores are ordered by id, null ids last. Each row of ``docs``
    is a document of its own and each row of ``items`` an item of its own, also where ids
    repeat. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    id_types = items.schema[item_id].dataType, docs.schema[id].dataType
    parts, totals = [], None
    for block in item_blocks(items, item_text, item_id, item_bytes):
        found = settled(postings(docs, block, text, id), "postings")
        if totals is None:
            totals = found.agg(F.count("*"), F.sum("n")).first()
        rows = found.select(F.explode("codes").alias("code")).groupBy("code").count().collect()
        df = {r["code"]: r["count"] for r in rows}  # at most a number for each term of the block
        if df:
            parts.append(settled(_ranked(found, block, *totals, df, k, id_types), "ranked"))
    if not parts:
        item_type, doc_type = (t.simpleString() for t in id_types)
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score bigint")
    return reduce(DataFrame.unionByName, parts)
