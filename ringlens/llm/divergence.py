"""Source divergence audit: a frequent-pattern tree over the term rows of each language."""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import plain_bytes, term_blocks, whole
from ringlens.session import settled

#: Documents of a language that a kept term occurs in, at least.
MIN_DOCS = 10
#: Ranks of the part ``term``.
TOP_TERMS = 10
#: What a share of 1 counts as.
UNIT = 1_000_000_000
#: Counts up to here, times the unit, are longs.
LARGE = 9_000_000_000
#: Distinct terms that a counting task holds before it hands them on.
HELD_TERMS = 400_000
#: Pairs of tree nodes whose corrections a task holds before it adds them up.
HELD_PAIRS = 1 << 18

PLAIN = plain_bytes()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term and documents with it, by language and source."""
    groups, held = defaultdict(lambda: (Counter(), Counter())), 0

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in groups.items():
            terms, n = list(count), len(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]).take(pa.array(np.zeros(n, np.int32))),
                    pa.array([source]).take(pa.array(np.zeros(n, np.int32))),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(np.fromiter(count.values(), np.int64, n)),
                    pa.array(np.fromiter(map(docs.__getitem__, terms), np.int64, n)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        groups.clear()

    for batch in batches:
        for lang, source, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "raw"))):
            count, docs = groups[lang, source]
            before, seen = len(count), set()
            for terms in term_blocks(raw, PLAIN):
                count.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(count) - before
            if held > HELD_TERMS:
                yield from counted()
                held = 0
    yield from counted()


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, docs`` over all documents."""
    rows = docs.select(
        whole(lang).alias("lang"), whole(source).alias("source"), whole(text).cast("binary").alias("raw")
    ).mapInArrow(_count_terms, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """A smoothed share in units; of a count whose product outgrows a long, as decimals."""
    whole_number = "decimal(19,0)"
    below = F.greatest(total + 2 * terms, F.lit(1))
    small = _div(F.least(count + 2, F.lit(LARGE)) * UNIT, below)
    large = _div(F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast(whole_number), below.cast(whole_number))
    return 1 + F.when(count + 2 <= LARGE, small).otherwise(large)


def _gap(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _node_pairs(path: dict[str, np.ndarray], first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Corrections of the nodes from depth ``first`` on, each with all its ancestors:
    ``(ancestor's source, node's source, value)``, a node's multiplicity in the value.

    The correction is what the pair's summand differs from, were each of both counts
    corrected alone.
    """
    rank, share, zero, times = path["rank"], path["share"], path["zero"], path["times"]
    depth = len(rank)
    step = max(1, HELD_PAIRS // max(depth, 1))
    for begin in range(max(first, 1), depth, step):
        nodes = np.arange(begin, min(begin + step, depth))
        node = np.repeat(nodes, nodes)
        above = np.arange(len(node)) - np.repeat(np.cumsum(nodes) - nodes, nodes)
        p, p0, q, q0 = share[node], zero[node], share[above], zero[above]
        yield rank[above], rank[node], times[node] * (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0))


def _tree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pair corrections of the tree whose rows come sorted by language and path.

    The rows are read as a walk through the tree: a row shares the nodes of its common prefix
    with the row before; the nodes below are finished then, with all that passed through them.
    Only the current path is held.
    """
    lang, path = None, None
    held, n_held = [], 0

    def summed() -> pd.DataFrame:
        above, node, value = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((node, above))
        above, node, value = above[order], node[order], value[order]
        begins = np.flatnonzero(np.r_[True, (above[1:] != above[:-1]) | (node[1:] != node[:-1])])
        return pd.DataFrame({"lang": lang, "a": above[begins], "b": node[begins], "value": np.add.reduceat(value, begins)})

    def finish(first: int) -> Iterator[pd.DataFrame]:
        nonlocal n_held
        for pairs in _node_pairs(path, first):
            held.append(pairs)
            n_held += len(pairs[0])
            if n_held > HELD_PAIRS:
                yield summed()
                held.clear()
                n_held = 0

    for batch in batches:
        columns = zip(*(batch[c] for c in ("lang", "rank", "n", "share", "zero", "times")))
        for own, rank, n, share, zero, times in columns:
            shared = 0
            if own == lang:
                k = min(len(rank), len(path["rank"]))
                differs = (rank[:k] != path["rank"][:k]) | (n[:k] != path["n"][:k])
                shared = int(differs.argmax()) if differs.any() else k
            if lang is not None:
                yield from finish(shared)
                if own != lang and held:
                    yield summed()
                    held.clear()
                    n_held = 0
            passed = np.full(len(rank), times, np.int64)
            if shared:
                passed[:shared] += path["times"][:shared]
            lang, path = own, {"rank": rank, "n": n, "share": share, "zero": zero, "times": passed}
    if lang is not None:
        yield from finish(0)
        if held:
            yield summed()


@dataclass(frozen=True)
class Audit:
    """``groups``: ``lang, source, rank, total, terms, lang_total, zero`` per group; ``rows``:
    ``lang, term, lang_share, path`` per kept term, the path being ``rank, n, share, zero`` of
    each source that has the term, in the order of sources."""

    groups: DataFrame
    rows: DataFrame


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source") -> Audit:
    """Groups, and the priced row of every kept term. Null texts, languages and sources count as ''."""
    found = docs.select(whole(lang).alias("lang"), whole(source).alias("source")).distinct()
    ranked = settled(
        found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("source"))), "ranks"
    )
    rows = settled(
        term_counts(docs, text, lang, source).join(ranked, ["lang", "source"])
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"),
            F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("path"),
        )
        .filter(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n", "path"),
        "term-rows",
    )
    totals = rows.select("lang", F.explode("path").alias("e")).groupBy("lang", F.col("e.rank").alias("rank")).agg(F.sum("e.n").alias("total"))
    langs = rows.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    none = F.lit(0).cast("long")
    groups = settled(
        ranked.join(totals, ["lang", "rank"], "left").join(langs, "lang", "left").na.fill(0)
        .withColumn("zero", _share(none, F.col("total"), F.col("terms"))),
        "groups",
    )
    of_lang = groups.groupBy("lang", "terms", "lang_total").agg(
        F.sort_array(F.collect_list(F.struct("rank", "total", "zero"))).alias("of")
    )

    def priced(e: Column) -> Column:
        own = F.get("of", e["rank"] - 1)
        share = _share(e["n"], own["total"], F.col("terms")).alias("share")
        return F.struct(e["rank"].alias("rank"), e["n"].alias("n"), share, own["zero"].alias("zero"))

    rows = rows.join(of_lang, "lang").select(
        "lang", "term", _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("lang_share"),
        F.transform("path", priced).alias("path"),
    )
    return Audit(groups, settled(rows, "priced"))


def tree_corrections(rows: DataFrame) -> DataFrame:
    """``lang, a, b, value``: what pairs of sources need where a term occurs in both.

    A term's row is the path of its counts in the order of the sources; equal rows pass
    through the same nodes. Paths are dealt in ranges of their order, so each task walks a
    connected part of the tree; a node whose rows lie in several parts is added up from them.
    """
    return (
        rows.filter(F.size("path") > 1)
        .select("lang", "path")
        .repartitionByRange("lang", "path")
        .sortWithinPartitions("lang", "path")
        .select("lang", *[F.col(f"path.{c}").alias(c) for c in ("rank", "n", "share", "zero")], F.lit(1).cast("long").alias("times"))
        .mapInPandas(_tree, "lang string, a int, b int, value bigint")
    )


def single_corrections(found: Audit) -> DataFrame:
    """``lang, a, b, value``: what a count of one source changes against the other sources'
    zero, once per distinct count."""
    one = found.rows.select("lang", F.explode("path").alias("e")).groupBy("lang", "e.rank", "e.share", "e.zero").agg(F.count("*").alias("times"))
    other = found.groups.select("lang", F.col("rank").alias("other"), F.col("zero").alias("q"))
    change = F.col("times") * (_gap(F.col("share"), F.col("q")) - _gap(F.col("zero"), F.col("q")))
    return (
        one.join(other, "lang")
        .filter("rank <> other")
        .groupBy("lang", F.least("rank", "other").alias("a"), F.greatest("rank", "other").alias("b"))
        .agg(F.sum(change).alias("value"))
    )


def source_pairs(found: Audit) -> DataFrame:
    """``lang, source, item, value``: each source with each other one of its language.

    Were no term counted, all terms would have the same summand; the corrections of single
    counts and, through the tree, of pairs of counts are added to that.
    """
    groups = found.groups.select("lang", "terms", "rank", "source", "zero")
    a = groups.select("lang", "terms", *[F.col(c).alias(f"{c}_a") for c in ("rank", "source", "zero")])
    b = groups.select("lang", *[F.col(c).alias(f"{c}_b") for c in ("rank", "source", "zero")])
    plain = a.join(b, "lang").filter("rank_a < rank_b")
    changes = single_corrections(found).unionByName(tree_corrections(found.rows))
    changes = changes.groupBy("lang", F.col("a").alias("rank_a"), F.col("b").alias("rank_b")).agg(F.sum("value").alias("change"))
    value = F.col("terms") * _gap(F.col("zero_a"), F.col("zero_b")) + F.coalesce("change", F.lit(0))
    both = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                   F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    return (
        plain.join(changes, ["lang", "rank_a", "rank_b"], "left")
        .select("lang", value.alias("value"), F.explode(both).alias("s"))
        .select("lang", "s.source", "s.item", "value")
    )


def source_terms(found: Audit) -> DataFrame:
    """``lang, source, item, value``: the terms that a source has more of than its language."""
    more = found.rows.select(
        "lang", F.col("term").alias("item"), "lang_share",
        F.explode(F.filter("path", lambda e: e["share"] > F.col("lang_share"))).alias("e"),
    )
    gaps = more.select("lang", F.col("e.rank").alias("rank"), "item", _gap(F.col("e.share"), F.col("lang_share")).alias("value"))
    return gaps.join(found.groups.select("lang", "rank", "source"), ["lang", "rank"]).select("lang", "source", "item", "value")


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text: str = "text",
    lang: str = "lang", source: str = "source",
) -> DataFrame:
    """How far the sources of each language lie apart: ``lang, source, part, item, value, rank``.

    Part ``pair`` has every other source of the language, part ``term`` the ``top_terms`` terms
    that are most over-represented. A group without kept terms has pairs, and no terms; without
    kept terms in its language its pairs are 0. Null texts, languages and sources count as the
    empty string; repeated rows count each; equal values rank by item. An empty table gives no
    rows. Other columns are not read. A term's row has an entry per source of its language, and
    the result has a row per pair of sources, so sources are taken to be names, not documents.
    """
    found = audit(docs, min_docs, text, lang, source)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = source_pairs(found).withColumn("rank", F.row_number().over(order))
    terms = source_terms(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns)
    )
