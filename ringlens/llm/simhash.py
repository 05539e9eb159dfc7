"""SimHash near-duplicates: a Gray-order hierarchical index over 64-bit fingerprints."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.session import settled

SHINGLE, SEED, DIFFERENCES = 3, 42, 2
#: Nodes with more fingerprints are refined: then 48 of 64 bits are fixed, 2**16 are left.
DENSE = 4096
#: Children of an index node, and fingerprints searched at a time.
FAN, BATCH = 8, 4096
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str) -> int:
    """The SimHash of a text as an unsigned number: bits set in over half of the shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    width = min(SHINGLE, len(words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[width - 1 :])
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence, where neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        codes = np.array([fingerprint(t) for t in batch["text"]], np.uint64)
        yield batch.drop(columns="text").assign(code=codes.view(np.int64))


def document_codes(docs: DataFrame, text: str, id: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, code`` and the ``carry`` columns per row; the code is the fingerprint as a signed long."""
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), *carry, whole(text).alias("text")).mapInPandas(
        _fingerprints, f"id {kind}{kinds}, code bigint"
    )


def _within(counts: np.ndarray) -> np.ndarray:
    """The place of each member inside its group, for groups of ``counts`` members."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _index(codes: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Trees over the Gray-sorted codes of many groups, the roots' level first.

    A node covers ``FAN`` neighbours of the level below in its group. It is a mask of the bits
    that they all share and the pattern of these bits. Each level comes with the number of its
    nodes in every group; the groups have equally many levels.
    """
    masks, patterns, counts = np.full(len(codes), ~np.uint64(0)), codes, sizes
    levels = [(masks, patterns, counts)]
    while counts.max(initial=1) > 1:
        firsts = np.flatnonzero(_within(counts) % FAN == 0)
        covered = np.diff(np.r_[firsts, len(masks)])
        odd = (patterns ^ np.repeat(patterns[firsts], covered)) | ~masks
        masks = ~np.bitwise_or.reduceat(odd, firsts)
        patterns = patterns[firsts] & masks
        counts = -(-counts // FAN)
        levels.append((masks, patterns, counts))
    return levels[::-1]


def _search(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places, of one group, whose codes differ in at most ``DIFFERENCES`` bits, by
    tree descent.

    Differences add up on the way down, each level counting the bits that it fixes anew; a
    node beyond the limit drops all that lies below it.
    """
    levels = _index(codes, sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    left, right = [], []
    for at in range(0, len(codes), BATCH):
        who = np.arange(at, min(at + BATCH, len(codes)))
        place = np.zeros(len(who), np.int64)
        apart, above = np.zeros(len(who), np.int64), np.zeros(len(who), np.uint64)
        for depth, (masks, patterns, counts) in enumerate(levels):
            if depth:
                place = (place[:, None] * FAN + np.arange(FAN)).ravel()
                who, apart, above = (np.repeat(x, FAN) for x in (who, apart, above))
                real = place < counts[of[who]]
                who, place, apart, above = who[real], place[real], apart[real], above[real]
            node = (np.cumsum(counts) - counts)[of[who]] + place
            fresh = masks[node] & ~above
            apart = apart + np.bitwise_count((codes[who] ^ patterns[node]) & fresh)
            near = apart <= DIFFERENCES
            who, place, apart, above, node = who[near], place[near], apart[near], masks[node[near]], node[near]
        ahead = node > who
        left.append(who[ahead])
        right.append(node[ahead])
    return np.concatenate(left), np.concatenate(right)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place in the component of each of ``n`` places."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        nxt = root.copy()
        np.minimum.at(nxt, root[left], low)
        np.minimum.at(nxt, root[right], low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, root):
            return root
        root = nxt


def _links(group: np.ndarray, codes: np.ndarray) -> pd.DataFrame:
    """A star for every component of linked codes within a group; rows sorted by group and
    Gray rank. Groups whose trees have equally many levels are searched together."""
    n = len(codes)
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[begins, n])
    depths = np.zeros(len(sizes), np.int64)
    counts = sizes
    while counts.max(initial=1) > 1:
        depths += counts > 1
        counts = -(-counts // FAN)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for depth in range(1, depths.max(initial=0) + 1):
        own = depths == depth
        if own.any():
            places = np.repeat(begins[own], sizes[own]) + _within(sizes[own])
            a, b = _search(codes[places], sizes[own])
            left.append(places[a])
            right.append(places[b])
    root = _roots(n, np.concatenate(left), np.concatenate(right))
    member = np.flatnonzero(root != np.arange(n))
    signed = codes.view(np.int64)
    return pd.DataFrame({"a": signed[member], "b": signed[root[member]]})


def _partition_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one partition, whose rows come sorted by node and Gray rank. The last node
    of a batch waits for the next batch; a node is bounded, so what waits is too."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        node = batch["node"].to_numpy()
        sub = batch["sub"].to_numpy()
        change = np.r_[True, (node[1:] != node[:-1]) | (sub[1:] != sub[:-1])]
        cut = np.flatnonzero(change)[-1]
        rest = batch.iloc[cut:]
        if cut:
            yield _links(np.cumsum(change)[:cut], batch["code"].to_numpy()[:cut].view(np.uint64))
    if rest is not None and len(rest) > 1:
        codes = rest["code"].to_numpy().view(np.uint64)
        yield _links(np.zeros(len(codes), np.int64), codes)


def _blocks(code: Column, width: int, first: int, count: int) -> list[Column]:
    mask = F.lit((1 << width) - 1).cast("long")
    return [F.shiftrightunsigned(code, first + width * i).bitwiseAND(mask) for i in range(count)]


def linked_codes(codes: DataFrame) -> DataFrame:
    """Links between codes that differ in at most two bits: a star per component and node.

    Upper nodes fix the bits of two of four 16-bit blocks: two codes at most two bits apart
    agree in at least two blocks, so they meet in one of six such nodes. A node with more
    than ``DENSE`` codes is refined the same way on the four 8-bit blocks of the other bits;
    what is left below are 16 bits, at most 65,536 codes. Within a node, the index over the
    codes in Gray order finds all links.
    """
    blocks = _blocks(F.col("code"), 16, 0, 4)
    uppers = [
        F.struct(
            F.lit(i).cast("long").alias("pair"),
            F.shiftleft(blocks[a], 16).bitwiseOR(blocks[b]).alias("bits"),
            F.shiftleft(blocks[c], 16).bitwiseOR(blocks[d]).alias("others"),
        )
        for i, (a, b) in enumerate(combinations(range(4), 2))
        for c, d in [sorted({0, 1, 2, 3} - {a, b})]
    ]
    placed = codes.withColumn("u", F.explode(F.array(*uppers))).select(
        "code", "gray", F.shiftleft("u.pair", 32).bitwiseOR(F.col("u.bits")).alias("node"), F.col("u.others").alias("others")
    )
    dense = placed.groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    small = _blocks(F.col("others"), 8, 0, 4)
    subs = F.array(
        *[
            F.lit(i << 16).cast("long").bitwiseOR(F.shiftleft(small[a], 8)).bitwiseOR(small[b])
            for i, (a, b) in enumerate(combinations(range(4), 2))
        ]
    )
    none = F.array(F.lit(-1).cast("long"))
    return (
        placed.join(dense, "node")
        .select("code", "gray", "node", F.explode(F.when(F.col("n") > DENSE, subs).otherwise(none)).alias("sub"))
        .repartition("node", "sub")
        .sortWithinPartitions("node", "sub", "gray")
        .select("code", "node", "sub")
        .mapInPandas(_partition_links, "a bigint, b bigint")
    )


def components(links: DataFrame) -> DataFrame:
    """``code, root``: the smallest code of the component, for every linked code but roots.

    Alternating stars: every node hands its larger neighbours to its smallest, then its
    smaller ones, until each component is one star. Each round is settled in the shared
    folder, and takes aggregates that combine before the shuffle.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = settled(small, "small-star")
        # stars: who has a neighbour below has only that one, and is nobody's neighbour below
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("u").alias("node"), F.col("v").alias("below")),
            F.struct(F.col("v").alias("node"), F.lit(None).cast(edges.schema["v"].dataType).alias("below")),
        )).alias("e")).select("e.*")
        odd = ends.groupBy("node").agg(
            F.count("below").alias("n"), F.count("*").alias("all"), F.min("below").alias("low"), F.max("below").alias("high")
        ).filter("n > 0 AND (n < all OR low < high)")
        if odd.isEmpty():
            return edges.select(F.col("u").alias("code"), F.col("v").alias("root"))


def near_groups(docs: DataFrame, text: str = "text", id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, code, component_id, component`` of every row, and its ``carry`` columns.

    ``code`` is the SimHash (signed) of the text's three-word shingles, ``component`` names
    the group of rows that links of at most two differing bits connect, ``component_id`` is
    the smallest id in it.

    Equal codes are one node of the graph, so copies are never paired. Null texts count as
    empty; texts without words have code zero and are linked like any other. Rows with null
    ids belong to groups but never name one; a group of such rows only has a null
    ``component_id``. Repeated ids and rows are kept as they are. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = settled(document_codes(docs, text, id, carry), "codes")
    gray = F.col("code")
    for shift in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, shift))
    distinct = settled(rows.groupBy("code").agg(F.min("id").alias("least")), "distinct-codes")
    links = linked_codes(distinct.select("code", gray.alias("gray")))
    roots = settled(components(links), "roots")
    named = distinct.join(roots, "code", "left").withColumn("component", F.coalesce("root", "code"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.select("code", "component").join(smallest, "component")
    return rows.join(named, "code")


def near_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One document of each group: that with the smallest id (null last), all columns kept.

    Rows are told apart by a stored tag; of several with that id the first as stored stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = settled(docs.select(F.monotonically_increasing_id().alias("row"), row), "near-rows")
    plain = rows.select("row", F.col(f"doc.`{id}`").alias("id"), F.col(f"doc.`{text}`").alias("text"))
    groups = near_groups(plain, "text", "id", ("row",))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    keep = settled(groups.groupBy("component").agg(F.min(first).alias("k")).select("k.row"), "near-kept")
    return rows.join(keep, "row", "left_semi").select("doc.*")
