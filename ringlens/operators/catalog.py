"""From documentation pages to a method catalog, its documents, rules and reports.

``extract`` keeps one row per page with nested arrays: a page is bounded by its own text,
so assembling a method needs no grouping and no shuffle. Only bundling and the reports
aggregate across pages.
"""
from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.functions import html as ht
from ringlens.functions import text as tx

# fixed values: versions and wording of the documents
OPENAPI_VERSION, DOCUMENT_VERSION, RPC_VERSION = "3.0.0", "1.0.0", "2.0"
SUCCESS_TEXT, FAILURE_TEXT = "Successful response", "Error response"
TITLE_TEXT, ENDPOINT_TEXT, BUNDLE_TEXT = "API - ", "API endpoint for ", "Methods of "
RPC_TEXT, ID_TEXT, METHOD_TEXT, METADATA_TEXT = (
    "JSON-RPC version", "Request identifier", "Method name", "Response metadata",
)

# fixed values: labels and headings of a documentation page
METHOD_LABEL = "Метод"
DESCRIPTION_LABEL = "Описание"
REQUEST_TITLE = "Параметры запроса"
RESPONSE_TITLE = "Параметры ответа"
REQUEST_EXAMPLES = ("Пример запроса", "JSON структура запроса")
RESPONSE_EXAMPLES = ("Пример ответа", "JSON структура ответа")
ERRORS_TITLE = "Список возвращаемых ошибок"
YES = "да"

MISSING_METHOD = "parsing failed: failed to extract method info: method name not found"


def _text(row: Column, i: int) -> Column:
    return F.coalesce(F.get(row, F.lit(i)).text, F.lit(""))


def _parameter(row: Column, request: bool) -> Column:
    """One parameter of a table row (name, type, required, [allowed,] description)."""
    first = F.get(row, F.lit(0))
    name = tx.trim_space(F.coalesce(first.code, first.text))
    kind = tx.trim_space(_text(row, 1))
    wide = F.size(row) >= 5
    if request:
        allowed = F.when(wide, tx.trim_space(_text(row, 3))).otherwise("")
        described = F.when(wide, _text(row, 4)).otherwise(_text(row, 3))
    else:
        allowed, described = F.lit(""), _text(row, 3)
    return F.struct(
        name.alias("name"),
        kind.alias("type"),
        (F.lower(tx.trim_space(_text(row, 2))) == YES).alias("required"),
        allowed.alias("allowed_values"),
        tx.clean_text(described).alias("description"),
    )


def _with_item_type(p: Column) -> Column:
    item = tx.array_item_type(p["name"], p.allowed_values, p.description)
    return F.struct(
        p["name"].alias("name"),
        p.type.alias("type"),
        p.required.alias("required"),
        p.allowed_values.alias("allowed_values"),
        p.description.alias("description"),
        F.when(p.type == "array", item).alias("array_item_type"),
    )


def _parameters(rows: Column, request: bool) -> Column:
    wide_enough = F.filter(rows, lambda r: F.size(r) >= (4 if request else 3))
    named = F.filter(
        F.transform(wide_enough, lambda r: _parameter(r, request)), lambda p: p["name"] != ""
    )
    return F.transform(named, _with_item_type)


def last_of_each(items: Column) -> Column:
    """Drop array entries whose name comes again later; the rest keep their order."""
    backwards = F.reverse(F.transform(items, lambda p: p["name"]))
    return F.filter(
        items, lambda p, i: i == F.size(items) - F.array_position(backwards, p["name"])
    )


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last row per key, by an aggregate with map-side combine."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return rows.groupBy(*keys).agg(best).select(*keys, "__row.*")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return rows.groupBy(*keys).agg(best).select(*keys, "__row.*")


def conflicts(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows ``first_wins`` leaves out. The winners' side has one row per key."""
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__first"))
    return rows.join(first, keys).filter(F.struct(*order) != F.col("__first")).drop("__first")


def _errors(rows: Column) -> Column:
    def one(r):
        return F.struct(
            tx.trim_space(_text(r, 1)).alias("code"),
            tx.trim_space(_text(r, 2)).alias("mnemonic"),
            tx.trim_space(_text(r, 3)).alias("description"),
        )

    return F.transform(F.filter(rows, lambda r: F.size(r) >= 3), one)


def json_object(text: Column) -> Column:
    """Top-level members of a JSON object as text: NULL when absent, empty when malformed.

    Text after the object is malformed too. The parser stops at the closing brace, so the
    object is read as the one member of an array and as the one value of an object: what
    follows it would have to end both.
    """
    strict = {"allowSingleQuotes": "false"}
    boxed = F.concat(F.lit("["), text, F.lit("]"))
    parsed = F.from_json(boxed, "array<map<string,string>>", strict)
    empty = F.create_map().cast("map<string,string>")
    held = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,string>", strict)
    alone = (F.size(parsed) == 1) & (F.size(held) == 1) & F.ltrim(text).startswith("{")
    return F.when(text.isNotNull(), F.coalesce(F.when(alone, parsed[0]), empty))


def _example(titles: tuple[str, str]) -> Column:
    """Code after the first spelling of a title, after the second only if that is absent."""
    first, second = (ht.pick_sections("sections", t) for t in titles)
    picked = ht.let(first, "one", f"CASE WHEN size(one) > 0 THEN one ELSE {second} END")
    return F.expr(ht.let(picked, "found", ht.code_after("found")))


def _table(title: str) -> Column:
    return F.expr(ht.table_after(ht.pick_sections("sections", title)))


# The column lists below depend on nothing, so each is built once per process: composing
# nested expressions costs more driver time than planning them.


@cache
def _parsed() -> list[Column]:
    return [
        ht.first_heading("html").alias("title"),
        ht.rows_of("html", METHOD_LABEL, DESCRIPTION_LABEL).alias("rows"),
        ht.sections_of("html").alias("sections"),
    ]


@cache
def _tables() -> list[Column]:
    name = F.btrim(F.expr(ht.code_beside("rows", METHOD_LABEL)), F.lit("\"'"))
    return [
        F.col("title"),
        name.alias("name"),
        tx.clean_text(F.expr(ht.text_beside("rows", DESCRIPTION_LABEL))).alias("description"),
        _table(REQUEST_TITLE).alias("request_rows"),
        _table(RESPONSE_TITLE).alias("response_rows"),
        _table(ERRORS_TITLE).alias("error_rows"),
        _example(REQUEST_EXAMPLES).alias("request_text"),
        _example(RESPONSE_EXAMPLES).alias("response_text"),
    ]


@cache
def _records() -> list[Column]:
    return [
        *map(F.col, ("name", "title", "description")),
        tx.http_verb("name").alias("http_method"),
        _parameters(F.col("request_rows"), True).alias("request_all"),
        _parameters(F.col("response_rows"), False).alias("response_all"),
        json_object(F.col("request_text")).alias("request_json"),
        json_object(F.col("response_text")).alias("response_json"),
        _errors(F.col("error_rows")).alias("errors"),
    ]


@cache
def _catalog() -> list[Column]:
    return [
        *map(F.col, ("name", "title", "description", "http_method")),
        last_of_each(F.col("request_all")).alias("request_params"),
        last_of_each(F.col("response_all")).alias("response_params"),
        *map(F.col, ("request_json", "response_json", "errors")),
    ]


def extract(pages: DataFrame) -> DataFrame:
    """(path, html) to one catalog row per page; ``name`` is '' when a page has no method."""
    kept = [c for c in pages.columns if c != "html"]
    rows = pages.select(*kept, ht.without_noise("html").alias("html"))
    for stage in (_parsed, _tables, _records, _catalog):
        rows = rows.select(*kept, *stage())
    return rows


def methods(catalog: DataFrame) -> DataFrame:
    """The pages that hold a method.

    The test looks at a generated copy of the name: on the name itself the optimizer would
    move it down to the scan and run half of the extraction twice.
    """
    copied = catalog.withColumn("__name", F.explode_outer(F.array("name")))
    return copied.filter(F.col("__name") != "").drop("__name")


def each(rows: DataFrame, keep: list[str], array: str) -> DataFrame:
    """One row per array entry: the kept columns, ``pos`` and the entry's fields.

    The outer form is used because the plain one makes the optimizer derive a size filter
    that would run the whole extraction a second time below the generator.
    """
    exploded = rows.select(*keep, F.posexplode_outer(array).alias("pos", "__entry"))
    return exploded.filter(F.col("__entry").isNotNull()).select(*keep, "pos", "__entry.*")


def explode_params(catalog: DataFrame, direction: str) -> DataFrame:
    rows = catalog.withColumnRenamed("name", "method")
    return each(rows, ["path", "method"], f"{direction}_params")


def explode_errors(catalog: DataFrame) -> DataFrame:
    return each(catalog.withColumnRenamed("name", "method"), ["path", "method"], "errors")


def with_defaults(catalog: DataFrame, brand: str = "Service") -> DataFrame:
    """Fill an empty title or description from the method name."""
    return catalog.withColumns(
        {
            "title": F.coalesce(
                F.nullif("title", F.lit("")), F.concat(F.lit(f"{brand} {TITLE_TEXT}"), "name")
            ),
            "description": F.coalesce(
                F.nullif("description", F.lit("")), F.concat(F.lit(ENDPOINT_TEXT), "name")
            ),
        }
    )


def _by_name(params: str) -> Column:
    return F.array_sort(F.col(params))  # name is the leading field


@cache
def render_description() -> Column:
    """Method text: description, then counted parameter lists in name order."""
    def bullet(p, request):
        need = F.concat(F.lit(", "), F.when(p.required, "required").otherwise("optional"))
        return F.concat(
            F.lit("- `"), p["name"], F.lit("` ("), p.type, need if request else F.lit(""),
            F.lit("): "), tx.clean_text(p.description),
        )

    def listing(params, word, request):
        head = F.concat(F.lit(f"**{word} Parameters:** "), F.size(params).cast("string"))
        lines = F.transform(_by_name(params), lambda p: bullet(p, request))
        return F.when(F.size(params) > 0, F.concat(F.array(head), lines)).otherwise(F.array())

    lead = tx.clean_text("description")
    return F.array_join(
        F.concat(
            F.when(lead != "", F.array(lead)).otherwise(F.array()),
            listing("request_params", "Request", True),
            listing("response_params", "Response", False),
        ),
        "\n\n",
    )


@cache
def responses() -> Column:
    """(code, description) pairs: 200, 400 and every error code that is an HTTP status.

    A repeated code keeps its last description.
    """
    standard = F.array(
        F.struct(F.lit("200").alias("name"), F.lit(SUCCESS_TEXT).alias("description")),
        F.struct(F.lit("400").alias("name"), F.lit(FAILURE_TEXT).alias("description")),
    )
    special = F.transform(
        F.filter("errors", lambda e: tx.is_http_status(e.code)),
        lambda e: F.struct(e.code.alias("name"), e.description.alias("description")),
    )
    return last_of_each(F.concat(standard, special))


def explode_responses(catalog: DataFrame) -> DataFrame:
    rows = catalog.select("path", F.col("name").alias("method"), responses().alias("responses"))
    return each(rows, ["path", "method"], "responses").withColumnRenamed("name", "code")


def _param_schema(p: Column) -> Column:
    enum = tx.allowed_enum(p.allowed_values)
    shown = F.when(enum.isNotNull(), F.get(enum, F.lit(0))).otherwise(tx.default_example(p.type))
    return F.struct(
        tx.schema_type(p.type).alias("type"),
        p.required.alias("required"),
        tx.clean_text(p.description).alias("description"),
        tx.allowed_format(p.allowed_values).alias("format"),
        enum.alias("enum"),
        shown.alias("example"),
        p.array_item_type.alias("item_type"),
        tx.item_example(p.array_item_type).alias("item_example"),
    )


@cache
def assemble() -> dict[str, Column]:
    """Parameter maps name -> schema and the sorted required names, both directions."""
    out = {}
    for side in ("request", "response"):
        params = F.col(f"{side}_params")
        out[f"{side}_schema"] = F.map_from_entries(
            F.transform(params, lambda p: F.struct(p["name"], _param_schema(p)))
        )
        out[f"{side}_required"] = F.array_sort(
            F.transform(F.filter(params, lambda p: p.required), lambda p: p["name"])
        )
    return out


def _object(properties: dict[str, Column], required: list[str] | None = None) -> Column:
    fields = [
        F.lit("object").alias("type"),
        F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties"),
    ]
    if required:
        fields.append(F.array(*map(F.lit, required)).alias("required"))
    return F.struct(*fields)


def _scalar(kind: str, description: str | None = None, example: Column | None = None) -> Column:
    fields = [F.lit(kind).alias("type")]
    if description:
        fields.append(F.lit(description).alias("description"))
    if example is not None:
        fields.append(example.alias("example"))
    return F.struct(*fields)


def _json_schema(p: Column) -> Column:
    """Schema of one parameter inside the document; examples become JSON values."""
    enum = tx.allowed_enum(p.allowed_values)
    value = F.to_variant_object(F.struct(F.get(enum, F.lit(0)).alias("v")))
    first = F.variant_get(value, "$.v", "variant")
    default = F.parse_json(tx.default_example(p.type))
    items = F.struct(
        p.array_item_type.alias("type"),
        F.parse_json(tx.item_example(p.array_item_type)).alias("example"),
    )
    return F.struct(
        tx.schema_type(p.type).alias("type"),
        tx.clean_text(p.description).alias("description"),
        F.when(enum.isNotNull(), first).otherwise(default).alias("example"),
        enum.alias("enum"),
        tx.allowed_format(p.allowed_values).alias("format"),
        F.when(p.type == "array", items).alias("items"),
    )


def _params_object(params: str) -> Column:
    column = F.col(params)
    required = F.array_sort(
        F.transform(F.filter(column, lambda p: p.required), lambda p: p["name"])
    )
    full = F.struct(
        F.lit("object").alias("type"),
        F.map_from_entries(
            F.transform(_by_name(params), lambda p: F.struct(p["name"], _json_schema(p)))
        ).alias("properties"),
        F.when(F.size(required) > 0, required).alias("required"),
    )
    return full


def openapi(catalog: DataFrame, brand: str = "Service") -> DataFrame:
    """One OpenAPI 3 document per method, as JSON text: (path, name, document)."""
    rows = with_defaults(
        methods(catalog).withColumns({"summary": F.col("title"), "text": render_description()}),
        brand,
    ).withColumn("responses", responses())
    version = _scalar("string", RPC_TEXT, F.lit(RPC_VERSION))
    ident = _scalar("number", ID_TEXT)
    body = F.struct(
        F.lit(True).alias("required"),
        _content(
            _object(
                {
                    "jsonrpc": version,
                    "id": ident,
                    "method": _scalar("string", METHOD_TEXT, F.col("name")),
                    "params": _params_object("request_params"),
                },
                ["jsonrpc", "id", "method", "params"],
            )
        ),
    )
    data = _params_object("response_params")
    empty = F.size("response_params") == 0
    success = _object(
        {
            "jsonrpc": version,
            "id": ident,
            "result": _object(
                {
                    "data": F.struct(
                        F.lit("object").alias("type"),
                        F.when(~empty, data["properties"]).alias("properties"),
                        F.when(~empty, data["required"]).alias("required"),
                    ),
                    "metadata": _scalar("object", METADATA_TEXT),
                },
                ["data", "metadata"],
            ),
        },
        ["jsonrpc", "id", "result"],
    )
    failure = _object(
        {
            "jsonrpc": _scalar("string"),
            "id": _scalar("number"),
            "error": _object(
                {
                    "code": _scalar("number"),
                    "message": _scalar("string"),
                    "data": _scalar("object"),
                }
            ),
        }
    )

    def reply(r):
        schema = F.when(r["name"] == "200", F.to_json(_content_of(success))).otherwise(
            F.to_json(_content_of(failure))
        )
        return F.struct(
            r["name"], F.struct(r.description.alias("description"), F.parse_json(schema).alias("content"))
        )

    operation = F.struct(
        F.col("summary").alias("summary"),
        F.col("text").alias("description"),
        F.when(F.size("request_params") > 0, body).alias("requestBody"),
        F.map_from_entries(F.transform(F.array_sort("responses"), reply)).alias("responses"),
        F.array(F.lit(brand.lower())).alias("tags"),
    )
    document = F.struct(
        F.lit(OPENAPI_VERSION).alias("openapi"),
        F.struct(
            F.col("title").alias("title"),
            F.lit(DOCUMENT_VERSION).alias("version"),
            F.col("description").alias("description"),
        ).alias("info"),
        F.create_map(
            F.concat(F.lit("/"), "name"), F.create_map(F.col("http_method"), operation)
        ).alias("paths"),
        F.when(F.size("errors") > 0, F.struct(F.col("errors").alias("errors"))).alias("x-errors"),
    )
    return rows.select("path", "name", F.to_json(document).alias("document"))


def _content_of(schema: Column) -> Column:
    return F.struct(F.struct(schema.alias("schema")).alias("application/json"))


def _content(schema: Column) -> Column:
    return _content_of(schema).alias("content")


# ---- bundles -----------------------------------------------------------------


def keyed(catalog: DataFrame) -> DataFrame:
    """Catalog rows with their key, API and domain."""
    return catalog.withColumn("key", tx.catalog_key("path")).withColumns(
        {"domain": tx.domain_of("key"), "api": tx.api_of("key")}
    )


def bundle_title(domain: str | Column, api: str | Column, brand: str = "Service") -> Column:
    domain = F.col(domain) if isinstance(domain, str) else domain
    api = F.col(api) if isinstance(api, str) else api
    word = F.when(api == "calls", " Calls API").otherwise(" API")
    return F.concat(F.lit(f"{brand} "), tx.title_case(domain), word)


def bundle_by_domain(items: DataFrame, min_files: int = 1, brand: str = "Service") -> DataFrame:
    """One row per (domain, api) with at least ``min_files`` pages.

    Members stay rows of their own (``bundle_members``), so no bundle has to fit one task.
    """
    return (
        items.groupBy("domain", "api")
        .agg(F.count("*").alias("files"), F.count_distinct("name").alias("paths"))
        .filter(F.col("files") >= min_files)
        .withColumns(
            {
                "bundle": F.concat(
                    "domain", F.when(F.col("api") == "calls", "_calls").otherwise("")
                ),
                "title": bundle_title("domain", "api", brand),
            }
        )
    )


def bundle_by_type(items: DataFrame) -> DataFrame:
    """Bundles by API only, told from a /data/ or /calls/ folder in the path."""
    api = F.when(F.col("path").contains("/data/"), "data").when(
        F.col("path").contains("/calls/"), "calls"
    )
    return (
        items.withColumn("api", api)
        .filter(F.col("api").isNotNull())
        .groupBy("api")
        .agg(F.count("*").alias("files"), F.count_distinct("name").alias("paths"))
    )


def bundle_members(items: DataFrame) -> DataFrame:
    """The page that supplies each method of a bundle: the first one in path order."""
    return first_wins(
        items.select("domain", "api", "name", "path"), ["domain", "api", "name"], ["path"]
    )


def merge_components(components: DataFrame) -> DataFrame:
    """First definition of each (bundle, type, name), in path order."""
    return first_wins(components, ["domain", "api", "type", "name"], ["path", "pos"])


def merge_errors(errors: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct error of a bundle."""
    return errors.select(*keys, "code", "mnemonic", "description").distinct()


def bundle_output(catalog: DataFrame, min_files: int = 1, brand: str = "Service") -> DataFrame:
    """Everything that the bundles hold, a row each: ``bundle, kind, entry, source, body``.

    'info' names and describes a bundle, a 'path' is a method's path item as JSON (of pages
    that document the same method the first in path order), a 'component' is a parameter
    (the first of its type and name), an 'error' every distinct error. Rows, not one
    document, so no bundle has to fit one task.
    """
    bundles = bundle_by_domain(keyed(methods(catalog)), min_files, brand).select("domain", "api", "bundle", "title")
    within = ["domain", "api"]
    nothing = F.lit(None).cast("string")
    documents = first_wins(keyed(openapi(catalog, brand)), [*within, "name"], ["path"]).select(
        *within, F.lit("path").alias("kind"), F.col("name").alias("entry"), F.col("path").alias("source"),
        F.get_json_object("document", "$.paths").alias("body"),
    )
    items = keyed(methods(catalog)).drop("name")
    components = merge_components(each(items, [*within, "path"], "request_params")).select(
        *within, F.lit("component").alias("kind"), F.concat_ws(" ", "type", "name").alias("entry"),
        F.col("path").alias("source"),
        F.to_json(F.struct("type", "description", "allowed_values", "array_item_type")).alias("body"),
    )
    errors = merge_errors(each(items, within, "errors"), within).select(
        *within, F.lit("error").alias("kind"), F.concat_ws(" ", "code", "mnemonic", "description").alias("entry"),
        nothing.alias("source"), F.to_json(F.struct("code", "mnemonic", "description")).alias("body"),
    )
    info = bundles.select(
        "bundle", F.lit("info").alias("kind"), F.col("title").alias("entry"), nothing.alias("source"),
        F.to_json(F.struct("title", F.concat(F.lit(BUNDLE_TEXT), "title").alias("description"))).alias("body"),
    )
    held = documents.unionByName(components).unionByName(errors).join(bundles.drop("title"), within)
    return info.unionByName(held.drop(*within))


# ---- rules and validation ----------------------------------------------------


def rules_of(params: str = "request_params") -> Column:
    """Validation rules of a method as an array: field, type, required, enum, minimum."""
    return F.transform(
        F.col(params),
        lambda p: F.struct(
            p["name"].alias("field"),
            tx.json_type(p.type).alias("type"),
            p.required.alias("required"),
            tx.allowed_enum_strict(p.allowed_values).alias("enum"),
            tx.allowed_format(p.allowed_values, strict=True).alias("format"),
            F.lit(None).cast("double").alias("minimum"),
        ),
    )


def derive_rules(catalog: DataFrame) -> DataFrame:
    """Rules of all methods in long form; the envelope fields come first."""
    envelope = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.lit(kind).alias("type"),
                F.lit(True).alias("required"),
                (F.array(const) if const is not None else F.lit(None).cast("array<string>")).alias(
                    "enum"
                ),
                F.lit(None).cast("string").alias("format"),
                F.lit(None).cast("double").alias("minimum"),
            )
            for field, kind, const in (
                ("jsonrpc", "string", F.lit(RPC_VERSION)),
                ("id", "number", None),
                ("method", "string", F.col("name")),
            )
        ]
    )
    tagged = methods(catalog).select(
        F.col("name").alias("method"),
        F.concat(
            F.transform(envelope, lambda r: F.struct(F.lit("envelope").alias("part"), r.alias("r"))),
            F.transform(rules_of(), lambda r: F.struct(F.lit("params").alias("part"), r.alias("r"))),
        ).alias("rules"),
    )
    return each(tagged, ["method"], "rules").select("method", "part", "r.*")


def _kind(value: Column) -> Column:
    """JSON type of a variant."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "VOID", "null")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def _problems(members: Column, rule: Column) -> Column:
    """Violations of one rule: (field, type, description, value)."""
    value = F.try_element_at(members, rule.field)
    kind = _kind(value)
    shown = F.coalesce(value.cast("string"), F.to_json(value))

    def problem(when, kind_name, text):
        return F.when(
            when,
            F.struct(
                rule.field.alias("field"),
                F.lit(kind_name).alias("type"),
                text.alias("description"),
                shown.alias("value"),
            ),
        )

    present = value.isNotNull()
    typed = present & (kind == rule.type)
    found = F.array(
        problem(~present & rule.required, "required", F.concat(rule.field, F.lit(" is required"))),
        problem(
            present & (kind != rule.type),
            "invalid_type",
            F.concat(F.lit("Invalid type. Expected: "), rule.type, F.lit(", given: "), kind),
        ),
        problem(
            typed & rule.enum.isNotNull() & ~F.array_contains(rule.enum, shown),
            "enum",
            F.concat(rule.field, F.lit(" must be one of the following: "), F.array_join(rule.enum, ", ")),
        ),
        problem(
            typed & (rule.type == "number") & (F.try_variant_get(value, "$", "double") < rule.minimum),
            "number_gte",
            F.concat(F.lit("Must be greater than or equal to "), rule.minimum.cast("string")),
        ),
    )
    return F.filter(found, lambda e: e.isNotNull())


def validate(records: DataFrame, payload: str, rules: Column | str) -> DataFrame:
    """Check JSON records against an array of rules on the same row.

    Adds ``valid`` and ``errors``. A payload that is no JSON object fails as a whole.
    """
    rules = F.col(rules) if isinstance(rules, str) else rules
    parsed = records.withColumn("__doc", F.try_parse_json(F.col(payload))).withColumn(
        "__members", F.try_variant_get(F.col("__doc"), "$", "map<string,variant>")
    )
    broken = F.array(
        F.struct(
            F.lit("(root)").alias("field"),
            F.lit("invalid_type").alias("type"),
            F.lit("Invalid type. Expected: object").alias("description"),
            F.col(payload).alias("value"),
        )
    )
    found = F.flatten(F.transform(rules, lambda r: _problems(F.col("__members"), r)))
    return (
        parsed.withColumn("errors", F.when(F.col("__members").isNull(), broken).otherwise(found))
        .drop("__doc", "__members")
        .withColumn("valid", F.size("errors") == 0)
    )


def validation_errors(validated: DataFrame, ident: str) -> DataFrame:
    return each(validated, [ident], "errors").drop("pos")


# ---- batch results -----------------------------------------------------------


def batch_results(catalog: DataFrame, cost: str | Column) -> DataFrame:
    """One result row per page; a page without a method fails, the others succeed.

    ``cost`` is the measured number of a page (time or size). A later stage's problem is
    kept in ``stage_error`` and leaves ``success`` true.
    """
    cost = F.col(cost) if isinstance(cost, str) else cost
    ok = F.col("name") != ""
    return catalog.select(
        "path",
        ok.alias("success"),
        F.when(~ok, MISSING_METHOD).alias("error"),
        F.when(ok & F.exists("request_params", lambda p: p.type == ""), "untyped parameter").alias(
            "stage_error"
        ),
        F.when(ok, F.col("name")).alias("name"),
        F.when(ok, F.size("request_params") + F.size("response_params")).otherwise(0).alias("params"),
        F.when(ok, F.size("errors")).otherwise(0).alias("errors"),
        cost.cast("double").alias("cost"),
    )


def batch_report(results: DataFrame) -> DataFrame:
    """One row of totals; an empty input gives zeros."""
    def zero(c):
        return F.coalesce(c, F.lit(0))

    return results.agg(
        F.count("*").alias("total"),
        F.count_if("success").alias("success_count"),
        F.count_if(~F.col("success")).alias("error_count"),
        zero(F.sum(F.when(F.col("success"), F.col("params")))).alias("total_params"),
        zero(F.sum(F.when(F.col("success"), F.col("errors")))).alias("total_errors"),
        zero(F.sum(F.col("cost").cast("decimal(28,4)")).cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("average_cost"),
    )


def extremes(rows: DataFrame, ident: str, cost: str) -> DataFrame:
    """Cheapest and dearest item; ties go to the first id."""
    return rows.agg(
        F.min_by(ident, F.struct(F.col(cost), F.col(ident))).alias("fastest"),
        F.min_by(ident, F.struct(-F.col(cost), F.col(ident))).alias("slowest"),
    )


def summary_lists(results: DataFrame) -> DataFrame:
    """Method names and error messages of a batch in long form with their counts.

    Entries that are NULL go by their count: a filter on the entry would move down to the scan
    and run the extraction there a second time, before its rows are dealt to the tasks.
    """
    return (
        results.select(
            F.when(F.col("success"), "method").otherwise("error").alias("list"),
            F.when(F.col("success"), F.col("name")).otherwise(F.col("error")).alias("entry"),
        )
        .groupBy("list", "entry")
        .agg(F.count("entry").alias("n"))
        .filter("n > 0")
    )
