"""MinHash near-duplicates: one-permutation hashing, banded buckets, stars of candidates."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.llm.simhash import components
from ringlens.llm.substring import word_hashes
from ringlens.session import settled

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 2, 80
#: A signature has 256 bins, of which the bands use 42 * 6: two sets with a similarity of 0.8
#: share no band once in 300,000 times, two with 0.1 share one once in 20,000.
BIN_BITS, BANDS, ROWS = 8, 42, 6
#: Nodes, and shingles, that lie in one block.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 21
#: Members that are compared with one copy of their centre's text.
STAR = 2000
#: Bytes of text hashed at a time.
BLOCK = 1 << 20

BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: 1 for the bytes that words are made of.
WORD_BYTE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)], np.int8)
_BINS = 1 << BIN_BITS
_EVERY = np.arange(_BINS, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers of texts, and texts of about ``BLOCK`` bytes together; a longer one comes in
    pieces, cut at white space."""
    numbers, parts, size = [], [], 0
    for number, raw in enumerate(texts):
        at = 0
        while at < len(raw):
            cut = BLANK.search(raw, at + BLOCK) if len(raw) - at > BLOCK else None
            end = cut.start() if cut else len(raw)
            numbers.append(number)
            parts.append(raw[at:end])
            size += end - at
            at = end
            if size >= BLOCK:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of all words, A-Z lower-cased."""
    docs, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for numbers, parts in _pieces(texts):
        data = b" ".join(parts).lower() + b" "
        edges = np.diff(WORD_BYTE[np.frombuffer(data, np.uint8)], prepend=np.int8(0))
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        begins = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        docs.append(np.asarray(numbers)[np.searchsorted(begins, start, side="right") - 1])
        hashes.append(word_hashes(data, start, end))
    return np.concatenate(docs), np.concatenate(hashes)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``ends, hashes``: the sorted distinct hashes of each text's shingles, one text after the
    other; of fewer words, one hash for all of them."""
    doc, words = words_of(texts)
    count = np.bincount(doc, minlength=len(texts))
    n = max(0, len(words) - width + 1)
    whole = doc[:n] == doc[len(words) - n :]  # the shingle that begins here ends in the same text
    hashes = mix(np.full(n, width, np.uint64))
    for i in range(width):
        hashes = mix(hashes ^ words[i : i + n]) + np.uint64(i)
    owner, hashes = [doc[:n][whole]], [hashes[whole]]
    begins = np.cumsum(count) - count
    for few in np.flatnonzero((count > 0) & (count < width)):
        own = mix(np.full(1, count[few], np.uint64))
        for i, word in enumerate(words[begins[few] : begins[few] + count[few]]):
            own = mix(own ^ word) + np.uint64(i)
        owner.append([few])
        hashes.append(own)
    doc, hashes = np.concatenate(owner), np.concatenate(hashes)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    once = np.r_[True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])][: len(doc)]
    return np.cumsum(np.bincount(doc[once], minlength=len(texts))), hashes[once]


def signatures(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin of each set, a bin being a range of hashes: one permutation.

    An empty bin takes the value of a bin drawn by its own sequence of draws, the first that is
    not empty. The sequence is the same for every set, so two sets agree in a bin as often as
    they are similar. The sets are not empty.
    """
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    place = owner * _BINS + (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    value, filled = np.zeros(len(ends) * _BINS, np.uint64), np.zeros(len(ends) * _BINS, bool)
    value[place[first]], filled[place[first]] = hashes[first], True
    empty, draw = np.flatnonzero(~filled), 0
    while len(empty):
        draw += 1
        donor = mix(_EVERY + np.uint64(draw << BIN_BITS)) >> np.uint64(64 - BIN_BITS)
        source = empty - empty % _BINS + donor.astype(np.int64)[empty % _BINS]
        found = filled[source]
        value[empty[found]] = value[source[found]]
        empty = empty[~found]
    return value.reshape(len(ends), _BINS)


def buckets(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One bucket of each set for each band of its signature."""
    bins = signatures(ends, hashes)[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.repeat(mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :], len(bins), axis=0)
    for row in range(ROWS):
        key = mix(key ^ bins[:, :, row])
    return key


def smallest_linked(percent: int) -> int:
    """Sets with fewer members are linked with equal sets only: two that differ have at most
    one member less in common than together."""
    return 100 // (100 - percent) - 1 + (100 % (100 - percent) > 0) if percent < 100 else 1 << 62


def _signed(percent: int, width: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack, least = zstandard.ZstdCompressor(level=3), smallest_linked(percent)
        for batch in batches:
            part = batch["raw"].str.len().to_numpy().cumsum() // BLOCK
            for _, own in batch.groupby(part, sort=False):
                texts = own["raw"].tolist()
                ends, hashes = shingle_sets(texts, width)
                sizes = np.diff(ends, prepend=0)
                sets = [hashes[e - n : e] for e, n in zip(ends, sizes)]
                able = np.flatnonzero(sizes >= least)
                rows: list[list[int]] = [[]] * len(texts)
                packed = [b""] * len(texts)
                if len(able):
                    keys = buckets(np.cumsum(sizes[able]), np.concatenate([sets[i] for i in able])).view(np.int64)
                    for i, key in zip(able, keys):
                        rows[i], packed[i] = key, pack.compress(texts[i])
                yield own[["tag", "id"]].assign(
                    code=[xxhash.xxh3_128_digest(h.tobytes()) for h in sets], n=sizes,
                    buckets=pd.Series(rows, own.index, object), packed=packed,
                )

    return sign


def signed_documents(docs: DataFrame, text: str, id: str, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """``tag, id, code, n, buckets, packed`` per row: ``tag`` tells the rows apart, ``code``
    is a 128-bit digest of the set, ``n`` its size, ``packed`` the compressed text."""
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("tag"), F.col(id).alias("id"), whole(text).cast("binary").alias("raw")
    )
    return rows.mapInPandas(
        _signed(percent, width), f"tag bigint, id {kind}, code binary, n bigint, buckets array<bigint>, packed binary"
    )


def _confirm(percent: int, width: int):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by star, its centre first."""
        unpack = zstandard.ZstdDecompressor()
        star, centre = None, None
        for batch in batches:
            left, right = [], []
            for a, part, node, packed in zip(batch["centre"], batch["part"], batch["node"], batch["packed"]):
                _, hashes = shingle_sets([unpack.decompress(packed)], width)
                if star != (a, part):
                    star, centre = (a, part), hashes
                    continue
                common = len(np.intersect1d(centre, hashes, assume_unique=True))
                if 100 * common >= percent * (len(centre) + len(hashes) - common):
                    left.append(a)
                    right.append(node)
            yield pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})

    return confirm


def confirmed(edges: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links ``a, b`` among the edges ``centre, node``, by the whole sets of both.

    A star is cut into parts of about ``STAR`` members, each with a copy of the centre, so a
    centre of many members fills no task.
    """
    sizes = edges.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    members = edges.join(sizes, "centre").select("centre", part.alias("part"), "node", F.lit(1).alias("role"))
    heads = members.select("centre", "part", F.col("centre").alias("node"), F.lit(0).alias("role")).distinct()
    return (
        members.unionByName(heads)
        .join(texts, "node")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part", "role")
        .select("centre", "part", "node", "packed")
        .mapInPandas(_confirm(percent, width), "a bigint, b bigint")
    )


def _compare(percent: int, width: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block, its members before the probes that meet them. A probe
        counts what it has in common with all members at once, and gives one link for each
        component that it is linked with."""
        unpack = zstandard.ZstdDecompressor()
        block, members, index = None, [], None
        for batch in batches:
            left, right = [], []
            columns = zip(*(batch[c] for c in ("merged", "bucket", "block", "role", "node", "part", "packed")))
            for *own, role, node, part, packed in columns:
                if block != own:
                    block, members, index = own, [], None
                _, hashes = shingle_sets([unpack.decompress(packed)], width)
                if role == 0:
                    members.append((node, part, hashes))
                    continue
                if not members:  # the hash left this block without any
                    continue
                if index is None:
                    sizes = np.array([len(h) for _, _, h in members])
                    every = np.concatenate([h for _, _, h in members])
                    order = np.argsort(every, kind="stable")
                    owner = np.repeat(np.arange(len(members)), sizes)[order]
                    index = every[order], owner, sizes, np.array([m[0] for m in members]), np.array([m[1] for m in members])
                every, owner, sizes, nodes, parts = index
                low, high = np.searchsorted(every, hashes, "left"), np.searchsorted(every, hashes, "right")
                count = high - low
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                common = np.bincount(owner[at], minlength=len(sizes))
                linked = np.flatnonzero((100 * common >= percent * (sizes + len(hashes) - common)) & (parts != part))
                first = np.unique(parts[linked], return_index=True)[1]
                left += [node] * len(first)
                right += nodes[linked[first]].tolist()
            yield pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})

    return compare


def _effort(rows: DataFrame, key: str) -> DataFrame:
    """Per group: its blocks, and how many texts it moves: every node once, and the probes
    (nodes outside of the main component) to every block."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    counted = rows.groupBy("main", key).agg(
        F.count("*").alias("nodes"), F.count_if(F.col("part") != F.col("main")).alias("probes"), blocks.alias("blocks")
    )
    return counted.withColumn("moved", F.col("nodes") + F.col("probes") * F.col("blocks"))


def crossed(parts: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links ``a, b`` between the components that meet in a bucket; ``parts`` has ``bucket,
    node, n, part``.

    A group is a bucket, or all buckets with the same largest component together where that
    moves fewer texts. Its nodes are dealt to blocks of bounded size; those outside of the
    largest component are probes and go to every block, where they are compared with all of its
    nodes at once. So pairs are counted inside a block and are never rows of a table.
    """
    per = parts.groupBy("bucket", "part").agg(F.count("*").alias("nodes"))
    mixed = per.groupBy("bucket").agg(
        F.max_by("part", F.struct("nodes", "part")).alias("main"), F.count("*").alias("parts")
    ).filter("parts > 1")
    placed = settled(parts.join(mixed.select("bucket", "main"), "bucket"), "mixed")
    once = settled(placed.groupBy("main", "node", "part").agg(F.max("n").alias("n")).withColumn("bucket", F.col("main")), "mixed-once")
    apart, together = settled(_effort(placed, "bucket"), "apart"), _effort(once, "bucket")
    plan = settled(
        apart.groupBy("main").agg(F.sum("moved").alias("moved_apart")).join(together.drop("bucket"), "main")
        .select("main", "blocks", (F.col("moved") <= F.col("moved_apart")).alias("merged")),
        "effort",
    )
    columns = ["merged", "bucket", "node", "part", "main", "blocks"]
    rows = once.join(plan.filter("merged"), "main").select(*columns).unionByName(
        placed.join(plan.filter("NOT merged").select("main", "merged"), "main")
        .join(apart.select("bucket", "blocks"), "bucket").select(*columns)
    )
    # a member goes to the block of its hash, a probe to every block besides
    own = F.array(F.struct(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role")))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("block"), F.lit(1).alias("role")))
    places = F.when(F.col("part") != F.col("main"), F.concat(own, every)).otherwise(own)
    group = ["merged", "bucket", "block"]
    return (
        rows.select("merged", "bucket", "node", "part", F.explode(places).alias("at"))
        .select("merged", "bucket", "at.block", "at.role", "node", "part")
        .join(texts, "node")
        .repartition(*group)
        .sortWithinPartitions(*group, "role")
        .mapInPandas(_compare(percent, width), "a bigint, b bigint")
    )


def picked(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose ``tag`` is a ``node``.

    Nodes are put down as bitmaps of 32,768 neighbouring tags, 4 KB each. As tags follow the
    order of the rows, those are few and small, so Spark broadcasts them where it would deal
    out all texts to meet a list of nodes.
    """
    placed = nodes.select(F.bitmap_bucket_number("node").alias("place"), F.bitmap_bit_position("node").alias("bit"))
    marks = settled(
        placed.repartition("place").groupBy("place").agg(F.bitmap_construct_agg("bit").alias("marks")), "marks"
    )
    bit = F.bitmap_bit_position("tag")
    byte = F.substring("marks", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    found = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1
    return rows.join(marks, F.bitmap_bucket_number("tag") == F.col("place")).filter(found).select(*rows.columns)


def linked_nodes(signed: DataFrame, nodes: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """``node, root`` for every linked node but roots; ``nodes`` are ``node, n, buckets``.

    First each bucket is a star: the node with the most company in all its buckets is the
    centre, and the others are compared with it, on the whole sets. Links form components,
    and most buckets then lie in one. In the others, the nodes outside of the largest
    component are compared with all of the bucket (see ``crossed``). So no pair that shares a bucket is lost: it
    was compared, or both lie in one component.
    """
    members = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    company = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = settled(members.join(company, "bucket"), "met")
    weights = settled(met.groupBy("node").agg((-F.sum("size")).alias("weight")), "weights")
    texts = settled(picked(signed.select("tag", "packed"), weights).withColumnRenamed("tag", "node"), "met-texts")
    heads = met.join(weights, "node").groupBy("bucket").agg(F.min(F.struct("weight", "node", "n")).alias("head"))
    stars = (
        met.join(heads, "bucket")
        .filter(f"node <> head.node AND 100 * least(n, head.n) >= {percent} * greatest(n, head.n)")
        .select(F.col("head.node").alias("centre"), "node")
        .distinct()
    )
    found = settled(confirmed(settled(stars, "stars"), texts, percent, width), "confirmed")
    roots = _roots_of(found)
    parts = met.select("bucket", "node", "n").join(roots, "node", "left").withColumn("part", F.coalesce("root", "node"))
    more = settled(crossed(parts.drop("root"), texts, percent, width), "crossed")
    if more.isEmpty():
        return roots
    return _roots_of(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _roots_of(links: DataFrame) -> DataFrame:
    return links.toDF("node", "root") if links.isEmpty() else components(links).withColumnRenamed("code", "node")


def minhash_groups(
    docs: DataFrame, text: str = "text", id: str = "doc_id", percent: int = PERCENT, width: int = SHINGLE
) -> DataFrame:
    """``tag, id, n, group, component_id`` of every row.

    Rows belong to one ``group`` if links connect them; a link needs sets of ``width``-word
    shingles (A-Z lower-cased; of fewer words, all of them as one) whose intersection has at
    least ``percent`` hundredths of their union. ``component_id`` is the smallest id in the
    group, itself included. ``tag`` numbers the rows as they were read.

    Equal sets are one node of the graph, so copies are never paired. Texts without words, null
    ones too, are groups of their own, whose ``component_id`` is their own id. Rows with null
    ids belong to groups but never name one; a group of such rows only has a null
    ``component_id``. Repeated ids and rows are kept as they are. Empty tables give an empty
    result. Other columns are not read. Sets are compared by 64-bit hashes of their shingles.
    """
    signed = settled(signed_documents(docs, text, id, percent, width), "signed")
    codes = settled(
        signed.filter("n > 0").groupBy("code").agg(F.min("tag").alias("node"), F.min("id").alias("least")), "codes"
    )
    banded = signed.filter(F.size("buckets") > 0).select(F.col("tag").alias("node"), "n", "buckets")
    nodes = banded.join(codes.select("node"), "node", "left_semi")
    roots = linked_nodes(signed, nodes, percent, width)
    named = codes.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = settled(named.select("code", "group").join(smallest, "group"), "named")
    alone = F.col("n") == 0
    return (
        signed.select("tag", "id", "code", "n")
        .join(named, "code", "left")
        .select(
            "tag", "id", "n", F.when(alone, F.col("tag")).otherwise(F.col("group")).alias("group"),
            F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def minhash_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One document of each group: that with the smallest id (null last), all columns kept.

    Of several rows with that id one stays. Texts without words all stay.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = settled(docs.select(F.monotonically_increasing_id().alias("row"), row), "rows")
    own = F.col(f"doc.`{id}`")
    name = F.struct(own.isNull().alias("none"), own.alias("id"), "row").alias("name")
    found = minhash_groups(rows.select(F.col(f"doc.`{text}`").alias("text"), name), "text", "name", percent, width)
    keep = found.groupBy("group").agg(F.min("id").alias("name")).select("name.row")
    return rows.join(keep, "row", "left_semi").select("doc.*")
