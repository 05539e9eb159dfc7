"""Substring dedup: windows of words, counted in super-k-mer buckets."""
from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.session import settled

#: Words of a window, and of the k-mers whose smallest hash is a window's minimiser.
WINDOW, KMER = 13, 3
#: Text bytes taken at a time, packed at a time, and packed bytes that one bucket should get.
CHUNK, FLUSH, BUCKET = 1 << 21, 24 << 20, 8 << 20
#: Longest stretch of words handled in one piece.
SEGMENT = 1 << 17
#: A minimiser is hot if its super-k-mers (about 128 bytes each) fill half of a bucket
#: and are more than this share of all.
HOT_ROWS, HOT_SHARE = BUCKET // 256, 1 / 16384
#: Super-k-mer bytes of one bucket held in memory; what is beyond goes the hot way.
HELD = 8 * BUCKET
NO_ID = (1 << 63) - 1

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words that single blanks separate."""
    blank = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.r_[0, blank + 1], np.r_[blank, len(joined)]


def word_hashes(joined: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes at a time."""
    padded = joined + bytes(8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    length = end - start
    h = _mix(length.astype(np.uint64))
    left = np.arange(len(start))
    step = 0
    while len(left):
        rest = np.minimum(length[left] - step, 8).astype(np.uint64)
        piece = eight[start[left] + step] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest))
        h[left] = _mix(h[left] ^ piece)
        step += 8
        left = left[length[left] > step]
    return h


def _fold(values: np.ndarray, span: int, op) -> np.ndarray:
    """``op`` over every ``span`` neighbours, by doubling."""
    width = 1
    while width < span:
        shift = min(width, span - width)
        values = op(values[:-shift], values[shift:])
        width += shift
    return values


@dataclass
class Pieces:
    """Super-k-mers of some texts: the joined words with bounds, and for each super-k-mer
    its minimiser, its text's number, its first word there, its first word here, windows."""

    joined: bytes
    start: np.ndarray
    end: np.ndarray
    minimiser: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    first: np.ndarray
    windows: np.ndarray


def super_kmers(texts: list[str]) -> Iterator[Pieces]:
    """Super-k-mers of whole texts, about ``CHUNK`` bytes at a time.

    Neighbouring windows with the same minimiser (smallest hash of their k-mers) are one
    super-k-mer. Long texts come in segments that overlap by a window less one word.
    """
    words: list[bytes] = []
    segments: list[tuple[int, int, int]] = []  # text, its first word, number of words
    size = 0

    def flush() -> Iterator[Pieces]:
        if len(words) < WINDOW:
            return
        joined = b" ".join(words)
        start, end = word_bounds(joined)
        h = word_hashes(joined, start, end)
        kmer = _mix(_fold(h, KMER, lambda a, b: _mix(a * _A + b)))
        least = _fold(kmer, WINDOW - KMER + 1, np.minimum)
        doc, base, count = (np.array(x) for x in zip(*segments))
        segment = np.repeat(np.arange(len(segments)), count)
        begin = np.cumsum(count) - count
        inside = segment[: len(least)] == segment[WINDOW - 1 :]
        fresh = np.r_[True, (least[1:] != least[:-1]) | (segment[1 : len(least)] != segment[: len(least) - 1])]
        first = np.flatnonzero(fresh & inside)
        last = np.flatnonzero(inside & np.r_[fresh[1:] | ~inside[1:], True])
        own = segment[first]
        yield Pieces(joined, start, end, least[first], doc[own], base[own] + first - begin[own], first, last - first + 1)

    for number, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").split()
        for at in range(0, max(1, len(own) - WINDOW + 1), SEGMENT):
            part = own[at : at + SEGMENT + WINDOW - 1]
            if len(part) < WINDOW:
                continue
            words += part
            segments.append((number, at, len(part)))
            size += sum(map(len, part)) + len(part)
            if size >= CHUNK:
                yield from flush()
                words, segments, size = [], [], 0
    yield from flush()


def _groups(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows whose texts make about ``FLUSH`` bytes together."""
    size = batch["text"].str.len().to_numpy().cumsum() // FLUSH
    for _, part in batch.groupby(size, sort=False):
        yield part


def _minimiser_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of minimisers with half the hot share of some texts; under null, the total
    and the bytes of all super-k-mers."""
    for batch in batches:
        for part in _groups(batch):
            found = [(p.minimiser, len(p.joined), p.windows) for p in super_kmers(part["text"].tolist())]
            if not found:
                continue
            value, n = np.unique(np.concatenate([m for m, _, _ in found]), return_counts=True)
            total, size = int(n.sum()), 0
            for m, joined, windows in found:
                size += joined + len(m) * WINDOW * 7
            often = n >= total * HOT_SHARE / 2
            yield pd.DataFrame({
                "minimiser": pd.array([*value[often].view(np.int64), None], "Int64"),
                "n": np.r_[n[often], total], "bytes": np.r_[np.zeros(often.sum(), np.int64), size],
            })


def _pack(hot: np.ndarray, buckets: int):
    """Rows of (bucket, packed super-k-mers) for all minimisers but hot ones."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in _groups(batch):
                ranks, hashes = part["rank"].to_numpy(), part["text_hash"].to_numpy()
                # only buckets that occur: there may be millions, and a flush meets few
                texts: dict[int, list[bytes]] = defaultdict(list)
                where: dict[int, list[np.ndarray]] = defaultdict(list)
                for p in super_kmers(part["text"].tolist()):
                    keep = np.flatnonzero(~np.isin(p.minimiser, hot))
                    bucket = (_mix(p.minimiser[keep]) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    keep, bucket = keep[order], bucket[order]
                    a = p.start[p.first[keep]].tolist()
                    b = p.end[p.first[keep] + p.windows[keep] + (WINDOW - 2)].tolist()
                    joined = p.joined
                    cut = [joined[x:y] for x, y in zip(a, b)]
                    place = np.stack([p.doc[keep], p.place[keep], p.windows[keep]])
                    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keep) else []
                    for x, y in zip(edges, [*edges[1:], len(keep)]):
                        texts[bucket[x]] += cut[x:y]
                        where[bucket[x]].append(place[:, x:y])
                full, blobs = sorted(texts), []
                for i in full:
                    place = np.concatenate(where[i], axis=1)
                    docs, number = np.unique(place[0], return_inverse=True)
                    block = (ranks[docs], hashes[docs], number.astype(np.int32), place[1].astype(np.int32),
                             place[2].astype(np.int32), b" ".join(texts[i]))
                    blobs.append(squeeze.compress(pickle.dumps(block, 5)))
                    del texts[i], where[i]
                yield pd.DataFrame({"bucket": pd.array(full, "int32"), "block": blobs})

    return packed


def _hot_windows(hot: np.ndarray):
    """A row for each window of a hot minimiser: a 128-bit digest of its words, its place."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _groups(batch):
                ranks, hashes = part["rank"].to_numpy(), part["text_hash"].to_numpy()
                for p in super_kmers(part["text"].tolist()):
                    own = np.flatnonzero(np.isin(p.minimiser, hot))
                    n = p.windows[own]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    first = np.repeat(p.first[own], n) + step
                    doc = np.repeat(p.doc[own], n)
                    yield _digest_rows(p.joined, p.start[first], p.end[first + WINDOW - 1], ranks[doc], hashes[doc], np.repeat(p.place[own], n) + step)

    return windows


def _digest_rows(joined: bytes, a: np.ndarray, b: np.ndarray, rank, text_hash, place) -> pd.DataFrame:
    """One row for each window's digest and text, with all the places that it has there."""
    digest = xxhash.xxh3_128_digest
    places: dict[tuple[bytes, int, int], list[int]] = {}
    for x, y, r, h, p in zip(a.tolist(), b.tolist(), rank.tolist(), text_hash.tolist(), place.tolist()):
        places.setdefault((digest(joined[x:y]), r, h), []).append(p)
    keys = list(zip(*places)) or [(), (), ()]
    return _rows(keys[0], keys[1], keys[2], list(places.values()), np.full(len(places), -1))


class _Bucket:
    """Super-k-mers of one bucket, as far as read."""

    def __init__(self):
        self.joined: list[bytes] = []
        self.columns: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, block: bytes) -> None:
        rank, text_hash, number, place, windows, joined = pickle.loads(zstandard.decompress(block))
        self.joined.append(joined)
        self.columns.append((rank[number], text_hash[number], place, windows))
        self.size += len(joined)

    def windows(self):
        """Joined words; first word and place of every window with its text; super-k-mers."""
        joined = b" ".join(self.joined)
        rank, text_hash, place, n = (np.concatenate(x) for x in zip(*self.columns))
        start, end = word_bounds(joined)
        words = n.astype(np.int64) + WINDOW - 1
        begin = np.cumsum(words) - words
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(begin, n) + step
        own = np.repeat(np.arange(len(n)), n)
        return joined, start, end, first, own, rank[own], text_hash[own], place[own] + step.astype(np.int32)

    def overflow(self) -> pd.DataFrame:
        joined, start, end, first, _, rank, text_hash, place = self.windows()
        return _digest_rows(joined, start[first], end[first + WINDOW - 1], rank, text_hash, place)

    def repeats(self) -> pd.DataFrame:
        """Runs of windows that a text with a smaller rank has too.

        Windows are sorted by a hash of their words; each one beside a smaller rank is
        compared with it word for word.
        """
        joined, start, end, first, own, rank, text_hash, place = self.windows()
        h = _fold(word_hashes(joined, start, end), WINDOW, lambda a, b: _mix(a * _B + b))[first]
        order = np.argsort(h)
        begins = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0])
        sizes = np.diff(np.r_[begins, len(order)])
        several = np.repeat(sizes > 1, sizes)
        order, sizes = order[several], sizes[sizes > 1]
        if not len(order):
            return _rows()
        begins = np.cumsum(sizes) - sizes
        low = np.repeat(np.minimum.reduceat(rank[order], begins), sizes)
        lead = np.maximum.reduceat(np.where(rank[order] == low, order, -1), begins)
        lead = np.repeat(lead, sizes)
        beside = rank[order] > low
        own_at, lead_at = order[beside], lead[beside]
        a, b = start[first], end[first + WINDOW - 1]
        same = np.fromiter(
            (joined[w:x] == joined[y:z] for w, x, y, z in zip(a[own_at].tolist(), b[own_at].tolist(), a[lead_at].tolist(), b[lead_at].tolist())),
            bool, len(own_at),
        )
        hit = own_at[same]
        if not same.all():  # two texts under one hash: look at that hash's windows by text
            clash = np.isin(h, np.unique(h[own_at[~same]]))
            least: dict[bytes, int] = {}
            for i in np.flatnonzero(clash):
                key = joined[a[i] : b[i]]
                least[key] = min(least.get(key, NO_ID), int(rank[i]))
            more = [i for i in np.flatnonzero(clash) if least[joined[a[i] : b[i]]] < rank[i]]
            hit = np.r_[hit[~clash[hit]], np.array(more, np.int64)]
        hit = np.sort(hit)
        if not len(hit):
            return _rows()
        fresh = np.r_[True, (np.diff(hit) != 1) | (np.diff(own[hit]) != 0)]
        head = np.flatnonzero(fresh)
        lead = hit[head]
        return _rows([None] * len(lead), rank[lead], text_hash[lead], place[lead, None], np.diff(np.r_[head, len(hit)]))


def _rows(digest=(), rank=(), text_hash=(), places=(), n=()) -> pd.DataFrame:
    return pd.DataFrame({
        "digest": pd.Series(list(digest), dtype=object), "rank": np.array(rank, np.int64), "text_hash": np.array(text_hash, np.int64),
        "places": pd.Series(list(places), dtype=object), "n": np.array(n, np.int32),
    })


def _bucket_repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeated windows of each bucket in a partition sorted by bucket. A bucket beyond
    ``HELD`` bytes is turned into rows of window digests instead, a part at a time."""
    current, held, over = None, _Bucket(), False
    for batch in batches:
        for bucket, block in zip(batch["bucket"], batch["block"]):
            if bucket != current:
                if held.size:
                    yield held.overflow() if over else held.repeats()
                current, held, over = bucket, _Bucket(), False
            held.add(block)
            if held.size > HELD:
                yield held.overflow()
                held, over = _Bucket(), True
    if held.size:
        yield held.overflow() if over else held.repeats()


ROWS = "digest binary, rank bigint, text_hash bigint, places array<int>, n int"


def repeated_windows(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``rank, text_hash, places, n``: runs of n windows, each starting at one of ``places``,
    that also start in a document with a smaller id (``rank``; null is last).

    1. Count minimisers in all texts and find the hot ones: at most twice 1 / HOT_SHARE.
    2. Super-k-mers of other minimisers go, packed and compressed, to their buckets; a bucket
       sorts its windows by hash, compares them as text and answers with runs.
    3. Windows of hot minimisers (and of buckets that outgrow memory) are rows of a digest, a
       document and its places there: smallest ids are aggregated before the shuffle, and the join back to the rows
       is one that AQE can split.
    """
    thin = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("rank"),
        F.xxhash64(whole(text)).alias("text_hash"),
        whole(text).alias("text"),
    ).filter(F.length("text") >= 2 * WINDOW - 1)
    counts = settled(
        thin.select("text").mapInPandas(_minimiser_counts, "minimiser bigint, n bigint, bytes bigint")
        .groupBy("minimiser").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .filter(F.col("minimiser").isNull() | (F.col("n") >= HOT_ROWS / 2)),
        "minimisers",
    )
    whole_count = counts.filter("minimiser IS NULL").first()
    total, size = (whole_count.n, whole_count.bytes) if whole_count else (0, 0)
    hot = counts.filter(F.col("minimiser").isNotNull() & (F.col("n") >= max(HOT_ROWS / 2, total * HOT_SHARE / 2)))
    hot = np.array([r.minimiser for r in hot.collect()], np.int64).view(np.uint64)
    buckets = max(1, -(-size // BUCKET))
    found = settled(
        thin.mapInPandas(_pack(hot, buckets), "bucket int, block binary")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInPandas(_bucket_repeats, ROWS),
        "repeats",
    )
    singles = found.filter("n < 0")
    if len(hot):
        singles = singles.unionByName(thin.mapInPandas(_hot_windows(hot), ROWS))
    singles = settled(singles, "hot-windows")
    least = singles.groupBy("digest").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).filter("low < high")
    hits = singles.join(least, "digest").filter("rank > low").withColumn("n", F.lit(1))
    columns = ("rank", "text_hash", "places", "n")
    return found.filter("n > 0").select(*columns).unionByName(hits.select(*columns))


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, runs in zip(batch["text"], batch["runs"]):
            words = text.encode("utf-8", "surrogatepass").split()
            n_words.append(len(words))
            if runs is None:
                n_removed.append(0)
            else:
                runs = np.asarray(runs, np.int64)
                place, n = runs >> 32, runs & 0xFFFFFFFF
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, place, 1)
                np.add.at(edge, place + n + WINDOW - 1, -1)
                gone = edge.cumsum()[:-1] > 0
                words = [words[i] for i in np.flatnonzero(~gone)]
                n_removed.append(int(gone.sum()))
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        yield pd.DataFrame({"id": batch["id"], "n_words": n_words, "n_removed": n_removed, "kept_text": kept})


def remove_repeats(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``id, n_words, n_removed, kept_text`` of every row: its words without those in a
    window of 13 words that also starts in a document with a smaller id.

    Windows are judged on the input. Words are runs of anything but ASCII white space, and
    kept ones are joined by one blank. Ids must be whole numbers; a null id counts as larger
    than all others, and rows with the same id are never removed for one another. Null and
    empty texts have no words; texts of fewer than 13 words are kept. An empty table gives
    an empty result. Other columns are not read.
    """
    kind = docs.schema[id].dataType.simpleString()
    packed = F.transform("places", lambda p: F.shiftleft(p.cast("long"), 32).bitwiseOR(F.col("n").cast("long")))
    runs = repeated_windows(docs, text, id).groupBy("rank", "text_hash").agg(F.flatten(F.collect_set(packed)).alias("runs"))
    rows = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("rank"),
        F.xxhash64(whole(text)).alias("text_hash"), whole(text).alias("text"),
    )
    return (
        rows.join(runs, ["rank", "text_hash"], "left")
        .select("id", "text", "runs")
        .mapInPandas(_remove, f"id {kind}, n_words bigint, n_removed bigint, kept_text string")
    )
