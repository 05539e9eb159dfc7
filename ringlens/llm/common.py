"""Helpers that the operators share."""
from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"
#: One word of the contracts that split at white space, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")


def row_key(id: str, text: str) -> Column:
    """``key``: id and a 128-bit text hash as one value, for tables whose ids repeat or are null.

    Rows that agree in both are the same document, so anything computed from its text
    holds for each of them. Null ids inside the struct compare as equal.
    """
    return F.struct(F.col(id).alias("id"), F.unhex(F.md5(whole(text))).alias("text_hash")).alias("key")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def uniform(*key: Column | int) -> Column:
    """A double in [0, 1) that depends on ``key`` only."""
    cols = [F.lit(k).cast("long") if isinstance(k, int) else k for k in key]
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def plain_bytes(more: bytes = b"") -> bytes:
    """A table for ``bytes.translate``: A-Z lower-cased; letters, bytes of non-ASCII characters
    and ``more`` as they are; blanks for all else."""
    letters = bytes(range(ord("a"), ord("z") + 1))
    keep = {*letters, *range(0x80, 0x100), *more}
    upper = {b - 32: b for b in letters}
    return bytes(b if b in keep else upper.get(b, 0x20) for b in range(256))


def term_blocks(raw: bytes, table: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text, about ``block`` bytes of it at a time."""
    plain, at = raw.translate(table), 0
    while at < len(plain):
        cut = plain.find(b" ", at + block)
        cut = len(plain) if cut < 0 else cut
        yield plain[at:cut].split()
        at = cut
