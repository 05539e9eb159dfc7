"""Cells, sections and text of HTML documentation pages as array expressions.

Tags are found by splitting at the opening tag, so omitted closing tags do no harm. Each
page is one row and stays one row; nothing is exploded until a caller asks. The nested
expressions are large, so the helpers compose SQL text, which Spark parses in one go.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringlens.functions.text import WHITE_SPACE

# fixed values: named character references that occur in pages
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": " ",
    "&laquo;": "«",
    "&raquo;": "»",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&copy;": "©",
    "&middot;": "·",
}
CELL_END = r"(?is)(?:</t[hdr]\s*>|<th[\s>]).*$"
ALL = 1 << 30


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _numeric(text: str, pattern: str, base: int) -> str:
    refs = f"array_distinct(regexp_extract_all({text}, {quoted(pattern)}, 0))"
    code = f"CAST(conv(regexp_extract(ref, {quoted(pattern)}, 1), {base}, 10) AS BIGINT)"
    valid = f"({code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343)"
    char = f"decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32')"
    put = f"CASE WHEN {valid} THEN replace(acc, ref, {char}) ELSE acc END"
    return f"aggregate({refs}, {text}, (acc, ref) -> {put})"


def _decode(text: str) -> str:
    """Decode character references; '&amp;' last, so nothing is decoded twice."""
    for name, char in ENTITIES.items():
        text = f"replace({text}, {quoted(name)}, {quoted(char)})"
    hexed = let(_numeric("dec", "&#([0-9]{1,7});", 10), "hex_", _numeric("hex_", "&#[xX]([0-9a-fA-F]{1,6});", 16))
    return f"replace({let(text, 'dec', hexed)}, '&amp;', '&')"


def text_of(fragment: str) -> str:
    """Text of a fragment: no tags, references decoded. Plain text passes untouched."""
    bare = f"CASE WHEN contains({fragment}, '<') THEN regexp_replace({fragment}, '<[^>]*>', '') ELSE {fragment} END"
    return let(bare, "bare", f"CASE WHEN contains(bare, '&') THEN {_decode('bare')} ELSE bare END")


def code_text(fragment: str) -> str:
    """Text of all code elements; NULL when there is none."""
    pattern = quoted(r"(?is)<code\b[^>]*>(.*?)</code\s*>")
    codes = f"regexp_extract_all({fragment}, {pattern}, 1)"
    joined = let(codes, "codes", "CASE WHEN size(codes) > 0 THEN array_join(codes, '') END")
    raw = f"CASE WHEN contains({fragment}, '<') THEN {joined} END"
    return let(raw, "raw", text_of("raw"))


def without_noise(html: str) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(
        F.col(html), r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", ""
    )


def first_heading(html: str) -> Column:
    """Trimmed text of the first h1; '' when there is none."""
    pattern = quoted(r"(?is)<h1\b[^>]*>(.*?)</h1\s*>")
    heading = let(f"regexp_extract({html}, {pattern}, 1)", "h", text_of("h"))
    return F.expr(f"btrim({heading}, {quoted(WHITE_SPACE)})")


def _row_parts(fragment: str) -> str:
    return f"slice(split({fragment}, {quoted(r'(?i)<tr(?=[\s>])[^>]*>')}), 2, {ALL})"


def rows_of(html: str, *labels: str) -> Column:
    """Rows that hold one of the labels, as arrays of (tag, text, code) cells.

    A label is looked for in the raw row first, so other rows cost one search.
    """
    wanted = " OR ".join(
        ["contains(r, '&#')"] + [f"contains(r, {quoted(label)})" for label in labels]
    )
    cells = (
        f"filter(split(r, {quoted(r'(?i)(?=<t[hd][\s>])')}), "
        f"c -> c RLIKE {quoted(r'(?i)^<t[hd][\s>]')})"
    )
    inner = f"regexp_replace(c, {quoted(r'(?is)^<t[hd]\b[^>]*>|</t[hdr]\s*>.*$')}, '')"
    cell = let(
        inner,
        "inner_",
        f"named_struct('tag', lower(substring(c, 2, 2)), 'text', {text_of('inner_')}, "
        f"'code', {code_text('inner_')})",
    )
    return F.expr(
        f"transform(filter({_row_parts(html)}, r -> {wanted}), r -> transform({cells}, c -> {cell}))"
    )


def sections_of(html: str) -> Column:
    """Header blocks: (level, title, body up to the next header)."""
    blocks = (
        f"filter(split({html}, {quoted(r'(?i)(?=<h[1-6][\s>])')}), "
        f"b -> b RLIKE {quoted(r'(?i)^<h[1-6][\s>]')})"
    )
    whole = quoted(r"(?is)^<h[1-6][^>]*>(.*?)</h[1-6]\s*>")
    title = let(f"regexp_extract(b, {whole}, 1)", "h", text_of("h"))
    return F.expr(
        f"transform({blocks}, b -> named_struct('level', CAST(substring(b, 3, 1) AS INT), "
        f"'title', {title}, 'body', regexp_replace(b, {whole}, '')))"
    )


def pick_sections(sections: str, title: str) -> str:
    """Sections whose header holds ``title``, on the highest header level that has any."""
    hits = f"filter({sections}, s -> contains(s.title, {quoted(title)}))"
    top = "filter(hits, s -> s.level = array_min(transform(hits, x -> x.level)))"
    return let(hits, "hits", top)


def table_after(picked: str) -> str:
    """Data rows of the tables that directly follow the headers (the first row is a head).

    A row is an array of (text, code) data cells.
    """
    table = quoted(r"(?is)^[^<]*<table\b[^>]*>(.*?)(?:</table\s*>|$)")
    rows = f"flatten(transform({picked}, s -> {_row_parts(f'regexp_extract(s.body, {table}, 1)')}))"
    cells = f"slice(split(r, {quoted(r'(?i)<td(?=[\s>])[^>]*>')}), 2, {ALL})"
    cell = let(
        f"regexp_replace(c, {quoted(CELL_END)}, '')",
        "inner_",
        f"named_struct('text', {text_of('inner_')}, 'code', {code_text('inner_')})",
    )
    return f"transform(slice({rows}, 2, {ALL}), r -> transform({cells}, c -> {cell}))"


def code_after(picked: str) -> str:
    """Code text of the pre block that directly follows the header; NULL when absent."""
    block = quoted(r"(?is)^[^<]*<pre\b[^>]*>(.*?)</pre\s*>")
    one = let(f"regexp_extract(s.body, {block}, 1)", "pre_", code_text("pre_"))
    parts = f"filter(transform({picked}, s -> {one}), t -> t IS NOT NULL)"
    return let(parts, "parts", "CASE WHEN size(parts) > 0 THEN array_join(parts, '') END")


def code_beside(rows: str, label: str) -> str:
    """Code text of the cells after the first head cell in rows labelled ``label``."""
    labelled = f"filter({rows}, r -> exists(r, c -> c.tag = 'th' AND contains(c.text, {quoted(label)})))"
    beside = f"flatten(transform({labelled}, r -> filter(r, (c, i) -> i > 0 AND get(r, i - 1).tag = 'th')))"
    return f"array_join(transform({beside}, c -> c.code), '')"


def text_beside(rows: str, label: str) -> str:
    """Text of the cell after each data cell that holds ``label``."""
    before = f"get(r, i - 1).tag = 'td' AND contains(get(r, i - 1).text, {quoted(label)})"
    beside = f"flatten(transform({rows}, r -> filter(r, (c, i) -> i > 0 AND {before})))"
    return f"array_join(transform({beside}, c -> c.text), '')"
