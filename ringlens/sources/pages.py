"""Documentation pages: scan, path rules, audit and statistics."""
from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.functions.numbers import col
from ringlens.functions.text import category

# fixed values: folders without documentation
ASSET_DIRS = ("assets", "css", "js", "javascripts", "stylesheets", "images", "img")
VENDOR_DIRS = ("node_modules", "vendor")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per HTML file below ``folder``: (path, html)."""
    return (
        spark.read.text(
            folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.[hH][tT][mM][lL]"
        )
        .withColumn("path", F.regexp_replace(F.input_file_name(), "^file:(//)?", ""))
        .select("path", F.col("value").alias("html"))
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below ``folder``, of any kind: (path, length, modified). Contents are not read.

    As everywhere in Spark, files whose name begins with a dot or an underscore are not seen,
    nor are empty folders.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.regexp_replace("path", "^file:(//)?", "").alias("path"), "length", F.col("modificationTime").alias("modified")
    )


def page_path(url: str | Column) -> Column:
    """File path of a web page: no scheme, query or fragment; a folder means its index."""
    bare = F.regexp_replace(F.regexp_replace(col(url), "^[a-z]+://", ""), "[?#].*$", "")
    return F.when(bare.endswith("/"), F.concat(bare, F.lit("index.html"))).otherwise(bare)


@dataclass(frozen=True)
class ScanOptions:
    root: str = ""
    skip_assets: bool = True
    skip_root_index: bool = False
    include_dirs: tuple[str, ...] = ()
    exclude_dirs: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ("*.html",)
    min_depth: int = 0
    max_depth: int = 0


def _parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))


def depth(path: str | Column) -> Column:
    return F.size(_parts(col(path)))


def _name(path: Column) -> Column:
    return F.lower(F.substring_index(path, "/", -1))


def _glob(pattern: str) -> str:
    """A file-name pattern as a regular expression: ``*``, ``?``, ``[a-z]``, ``[^a-z]``, and a
    backslash before a character meant as it is. A bracket that is never closed raises."""
    out, rest = "", pattern
    while rest:
        c, rest = rest[0], rest[1:]
        if c in "*?":
            out += "[^/]" + ("*" if c == "*" else "")
        elif c == "[":
            inside = re.match(r"(\^?)((?:\\.|[^\]\\])+)\]", rest)
            if not inside:
                raise ValueError(f"bad pattern {pattern!r}")
            out += "[" + inside[1] + re.sub(r"([\[&^])", r"\\\1", inside[2]) + "]"
            rest = rest[inside.end() :]
        else:
            if c == "\\" and rest:
                c, rest = rest[0], rest[1:]
            out += re.escape(c)
    return f"(?i)^{out}$"


def is_html(path: str | Column, options: ScanOptions = ScanOptions()) -> Column:
    """``.html`` in any case whose name fits one of the glob patterns."""
    name = F.substring_index(col(path), "/", -1)
    test = F.lower(name).endswith(".html")
    if options.patterns:
        test = test & reduce(lambda a, b: a | b, [name.rlike(_glob(g)) for g in options.patterns])
    return test


def skip_file(path: str | Column, options: ScanOptions = ScanOptions()) -> Column:
    path = col(path)
    parts = _parts(path)
    skip = _name(path) == "404.html"
    if options.skip_root_index:
        root = len([p for p in options.root.split("/") if p and p != "."])
        skip = skip | ((_name(path) == "index.html") & (F.size(parts) == root + 1))
    if options.skip_assets:
        folder = F.lower(F.coalesce(F.get(parts, F.size(parts) - 2), F.lit("")))
        skip = skip | folder.isin(*ASSET_DIRS)
    return skip


def skip_directory(path: str | Column, options: ScanOptions = ScanOptions()) -> Column:
    path = col(path)
    skip = _name(path).startswith(".")
    if options.skip_assets:
        skip = skip | _name(path).isin(*ASSET_DIRS, *VENDOR_DIRS)
    for part in options.exclude_dirs:
        skip = skip | path.contains(part)
    if options.include_dirs:
        skip = skip | ~reduce(
            lambda a, b: a | b, [path.contains(p) for p in options.include_dirs]
        )
    if options.max_depth:
        skip = skip | (depth(path) > options.max_depth)
    if options.min_depth:
        skip = skip | (depth(path) < options.min_depth)
    return skip


def folders_of(path: str | Column, root: str = "") -> Column:
    """Every folder on the way from ``root`` to a file."""
    parts = F.split(col(path), "/")
    skipped = len(root.rstrip("/").split("/")) if root else 1
    lengths = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))),
        lambda n: (n >= skipped) & (n < F.size(parts)),
    )
    return F.filter(
        F.transform(lengths, lambda n: F.array_join(F.slice(parts, 1, n), "/")),
        lambda p: p != "",
    )


def _reached(path, options):
    """No folder on the way is skipped."""
    return ~F.exists(folders_of(path, options.root), lambda d: skip_directory(d, options))


def scan_filter(pages: DataFrame, options: ScanOptions = ScanOptions()) -> DataFrame:
    """The pages a scan keeps: a pure path predicate, evaluated inside the scan stage."""
    return pages.filter(
        is_html("path", options) & ~skip_file("path", options) & _reached("path", options)
    )


def scan_summary(pages: DataFrame, options: ScanOptions = ScanOptions()) -> DataFrame:
    """One row of counts: files, html, skipped, unreadable, directories.

    ``pages`` are pages with their ``html`` (NULL: unreadable), or a listing of files.
    """
    bad = F.col("html").isNull() if "html" in pages.columns else F.lit(False)
    seen = pages.filter(_reached("path", options)).select("path", bad.alias("bad"))
    html, skip = is_html("path", options), skip_file("path", options)
    # a skipped folder counts where it is met; what lies below it is never met
    folders = pages.select(F.explode(folders_of("path", options.root)).alias("dir")).filter(
        _reached("dir", options)
    )
    return seen.agg(
        F.count("*").alias("total_files"),
        F.count_if(html & ~skip & ~F.col("bad")).alias("html_files"),
        F.count_if(html & skip).alias("skipped_files"),
        F.count_if(F.col("bad")).alias("error_files"),
    ).withColumn("total_dirs", folders.distinct().agg(F.count("*")).scalar())


def categorise(pages: DataFrame, root: str = "") -> DataFrame:
    """Category and path of each page: the listing in relational form, one row per page."""
    return pages.select(category("path", root).alias("category"), "path")


def file_stats(pages: DataFrame, root: str = "") -> DataFrame:
    """Page count, and the largest and smallest page with its size in bytes, from the pages'
    ``html`` or a listing's ``length``.

    One row per category and a row '*' for all pages, from one pass.
    """
    size = F.octet_length("html") if "html" in pages.columns else F.col("length")
    sized = pages.select(category("path", root).alias("category"), "path", size.cast("long").alias("size"))
    largest = F.struct(-F.col("size"), F.col("path"))
    smallest = F.struct("size", "path")
    per_category = sized.rollup("category").agg(
        F.count("*").alias("files"),
        F.min_by("path", largest).alias("largest_file"),
        F.max("size").alias("largest_size"),
        F.min_by("path", smallest).alias("smallest_file"),
        F.min("size").alias("smallest_size"),
    )
    return per_category.withColumn("category", F.coalesce("category", F.lit("*")))
