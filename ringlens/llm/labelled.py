"""Bounded training samples for the classifiers, and what both classifiers share."""
from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole
from ringlens.llm.substring import _fold, _mix, word_bounds, word_hashes
from ringlens.session import settled


def held_out(id: str | Column) -> Column:
    """A fifth of all documents, by CRC-32 of the id as text: never used for learning."""
    id = F.col(id) if isinstance(id, str) else id
    return F.crc32(F.encode(F.coalesce(id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def without_copies(texts: list[bytes], shingle: int = 5, hashes: int = 6) -> list[bytes]:
    """The texts but those that look like near copies of an earlier one: half or more of
    their smallest shingle hashes occurred before. Copies would pass for evidence."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for text in texts:
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        h = word_hashes(joined, *word_bounds(joined))
        h = _fold(h, min(shingle, len(h)), lambda a, b: _mix(a * np.uint64(0x9E3779B97F4A7C15) + b))
        own = {(k, int(_mix(h ^ np.uint64(0xD1B54A32D192ED03 * (k + 1) % (1 << 64))).min())) for k in range(hashes)}
        if 2 * len(own & seen) < hashes:
            kept.append(text)
        seen |= own
    return kept


def sample_texts(docs: DataFrame, picks: dict[str, DataFrame], each: int, max_bytes: int, text: str, id: str) -> dict[str, list[bytes]]:
    """Whole texts, near copies left out, of at most ``each`` ids from every frame in ``picks`` (column ``id``).

    Ids are taken in the order of a hash, and texts in that order as long as the sample of a
    kind stays within ``max_bytes``; so the driver's share is bounded by the two parameters.
    """
    chosen = reduce(
        DataFrame.unionByName,
        (
            frame.select("id").dropna().distinct().withColumn("o", F.xxhash64("id")).orderBy("o", "id").limit(each)
            .withColumn("kind", F.lit(kind))
            for kind, frame in picks.items()
        ),
    )
    # at most `each` ids a kind, whatever the input: a bounded broadcast
    texts = settled(
        docs.select(F.col(id).alias("id"), F.encode(whole(text), "UTF-8").alias("text"))
        .join(F.broadcast(chosen), "id")
        .dropDuplicates(["kind", "id"]),
        "sample",
    )
    sizes = texts.select("kind", "id", "o", F.octet_length("text").alias("n")).orderBy("o", "id").collect()
    left, fits = dict.fromkeys(picks, max_bytes), []
    for row in sizes:
        if row.n <= left[row.kind]:
            left[row.kind] -= row.n
            fits.append((row.kind, row.id))
    if not fits:
        return {kind: [] for kind in picks}
    wanted = docs.sparkSession.createDataFrame(fits, texts.select("kind", "id").schema)
    found: dict[str, list[bytes]] = {kind: [] for kind in picks}
    for row in texts.join(F.broadcast(wanted), ["kind", "id"]).orderBy("o", "id").select("kind", "text").toLocalIterator():
        found[row.kind].append(bytes(row.text))
    return {kind: without_copies(sample) for kind, sample in found.items()}


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
