"""Scalar rules of the documentation catalog, as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringlens.functions.numbers import col

# fixed values: the Unicode white-space characters
WHITE_SPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def clean_text(c: str | Column) -> Column:
    """Line breaks, tabs and runs of spaces become one space; the ends are trimmed."""
    return trim_space(F.regexp_replace(col(c), "[\\n\\r\\t ]+", " "))


def title_case(c: str | Column) -> Column:
    """Upper-case the first letter of each word and leave the others as they are.

    Words are runs of letters, digits and '_', so a letter after a dot starts a word.
    """
    runs = F.regexp_extract_all(
        col(c), F.lit("([\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+)"), F.lit(1)
    )
    head = F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30)))
    return F.array_join(head, "")


def category(path: str | Column, root: str = "") -> Column:
    """Title of the first path part below ``root``; 'root' when there is none."""
    rel = F.regexp_replace(col(path), f"^{_quote(root.rstrip('/'))}/+", "") if root else col(path)
    parts = F.filter(F.split(rel, "/"), lambda p: (p != "") & (p != "."))
    first = F.get(parts, F.lit(0))
    return F.coalesce(title_case(F.replace(first, F.lit("_"), F.lit(" "))), F.lit("root"))


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"


def safe_name(method: str | Column) -> Column:
    return F.translate(col(method), ".", "_")


# fixed values: method prefix -> HTTP verb, any other method is a post
VERBS = {"get.": "get", "create.": "post", "update.": "put", "delete.": "delete"}


def http_verb(method: str | Column) -> Column:
    chain = F.when(col(method).isNull(), "post")
    for prefix, verb in VERBS.items():
        chain = chain.when(col(method).startswith(prefix), verb)
    return chain.otherwise("post")


def _lookup(table: dict[str, str], c: str | Column) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col(c))


# fixed values: documented type -> schema type
SCHEMA_TYPES = {
    "string": "string",
    "number": "number",
    "boolean": "boolean",
    "object": "object",
    "array": "array",
    "enum": "string",
}
# fixed values: types known to the validator
JSON_TYPES = ("string", "number", "boolean", "object", "array")


def schema_type(c: str | Column) -> Column:
    """Schema type of a documented type; NULL for types outside the table."""
    return _lookup(SCHEMA_TYPES, c)


def json_type(c: str | Column) -> Column:
    """Validator type; anything unknown is a string."""
    return F.when(col(c).isin(*JSON_TYPES), col(c)).otherwise("string")


# fixed values: words that mark a cell of allowed values as a format
FORMAT_WORDS = "формат|format"
STRICT_FORMAT_WORDS = "формат|format|e\\.164|international"


def is_format(c: str | Column, strict: bool = False) -> Column:
    return F.lower(col(c)).rlike(STRICT_FORMAT_WORDS if strict else FORMAT_WORDS)


def _items(c: str | Column) -> Column:
    return F.transform(F.split(col(c), ","), lambda x: trim_space(x))


def allowed_format(c: str | Column, strict: bool = False) -> Column:
    return F.when(is_format(c, strict), col(c))


def allowed_enum(c: str | Column) -> Column:
    """Two or more comma items are an enumeration, blank items included; else NULL."""
    return F.when(~is_format(c) & col(c).contains(","), _items(c))


def allowed_enum_strict(c: str | Column) -> Column:
    """Validator form: blanks are dropped and one item is enough; NULL when none is left."""
    kept = F.filter(_items(c), lambda x: x != "")
    return F.when(~is_format(c, strict=True) & (F.size(kept) > 0), kept)


# fixed values: example shown for a type, as JSON text
EXAMPLES = {"string": '"example_string"', "number": "123", "boolean": "true", "array": "[]"}


def default_example(c: str | Column) -> Column:
    return _lookup(EXAMPLES, c)


def item_example(item_type: str | Column) -> Column:
    """Example of an array item; arrays of arrays have none."""
    return F.when(col(item_type) != "array", default_example(item_type))


def is_http_status(code: str | Column) -> Column:
    return col(code).rlike("^[1-5][0-9]{2}$")


def array_item_type(name: Column, allowed: Column, description: Column) -> Column:
    """Item type of an array parameter, by the first rule that fits.

    Allowed values speak before the description, and that before the name.
    """
    allowed, description, name = F.lower(allowed), F.lower(description), F.lower(name)
    # fixed values: words that tell the item type
    phone_text = description.contains("номер") & description.contains("формат e164")
    mail_text = description.contains("адрес") & description.contains("почт")
    return (
        F.when(allowed.rlike("адрес|email|номер|phone"), "string")
        .when(description.rlike("идентификатор|id"), "number")
        .when(phone_text | mail_text | name.rlike("phone|number|email"), "string")
        .when(name.rlike("group|member|contact"), "number")
        .otherwise("string")
    )


# fixed values: folder of an API -> key prefix, and domain aliases
API_FOLDERS = {"data_api": "data", "call_api": "calls"}
DOMAIN_ALIASES = {
    "ca_deal": "deal",
    "ca_contact": "contact",
    "ca_employee": "employee",
    "ca_sales_funnel": "sales_funnel",
}


def catalog_key(path: str | Column) -> Column:
    """Dotted key of a page: the path below its API folder, or its last two parts.

    ``…/data_api/tag/get_tags/index.html`` gives ``data.tag.get_tags``.
    """
    c = col(path)
    below = F.regexp_extract(c, "(?:^|/)(?:data_api|call_api)/(.+)$", 1)
    tail = F.regexp_extract(c, "([^/]*/)?[^/]*$", 0)
    prefix = F.when(c.contains("/data_api/"), API_FOLDERS["data_api"]).when(
        c.contains("/call_api/"), API_FOLDERS["call_api"]
    )
    name = F.when(below != "", below).otherwise(tail)
    name = F.regexp_replace(F.replace(name, F.lit("/"), F.lit(".")), "\\.html$", "")
    name = F.regexp_replace(name, "\\.index$", "")
    return F.concat_ws(".", F.when(below != "", prefix), name)


def api_of(key: str | Column) -> Column:
    parts = F.split(col(key), "\\.")
    return F.when((F.size(parts) >= 2) & (parts[0] == "calls"), "calls").otherwise("data")


def domain_of(key: str | Column) -> Column:
    """Domain part of a key with aliases applied."""
    parts = F.split(col(key), "\\.")
    tagged = (F.size(parts) >= 2) & parts[0].isin("data", "calls")
    raw = F.when(tagged, F.get(parts, F.lit(1))).otherwise(parts[0])
    return F.coalesce(_lookup(DOMAIN_ALIASES, raw), raw)
