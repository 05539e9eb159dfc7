"""Documentation pages.

``doc_pages`` renders one documentation page per part row with Spark, with faults mixed in
(no method, short rows, repeated names, malformed JSON, a paragraph before the table). The
SQL twins compute the expected catalog from the part table directly, without any HTML.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.functions import text as tx
from ringlens.operators import catalog as ct
from ringlens.plans.registry import query
from ringlens.session import settled
from ringlens.sources import pages as pg
from ringlens.sources.model import spread

VERBS = ["get", "create", "update", "delete", "start"]
DOMAINS = ["ca_deal", "contact", "ca_contact", "campaign", "ca_employee", "ca_sales_funnel", "tag"]
NAMES = ["user_id", "phone_numbers", "contact_email", "group_ids", "sort", "filter", "fields", "date_from"]
TYPES = ["string", "number", "array", "object", "enum", "iso8601", "boolean", "numeric", "duration"]
ALLOWED = ["", "in, out, any", "Формат E.164", "single", " x , , y ", "Номер телефона"]
NEEDED = ["да", "нет", "Да ", ""]
DESCRIBED = ["Идентификатор группы", "Номер, формат E164", "Адрес  почты", "Имя", "Group id", "Статус &amp; роль &lt;b&gt;"]
PLAIN = [d.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">").replace("  ", " ") for d in DESCRIBED]
CODES = ["404", "-32602", "500", "0", "404"]


def _array(values):
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _spark_pick(values, index):
    return f"element_at({_array(values)}, CAST(({index}) % {len(values)} AS INT) + 1)"


def _row(cells):
    """A table row from (condition or None, cell content) pairs."""
    parts = [
        f"CASE WHEN {test} THEN concat('<td>', {body}, '</td>') ELSE '' END" if test
        else f"concat('<td>', {body}, '</td>')"
        for test, body in cells
    ]
    return f"concat('<tr>', {', '.join(parts)}, '</tr>')"


def _rows(count, row):
    return f"array_join(transform(slice(array(0, 1, 2, 3), 1, CAST({count} AS INT)), i -> {row}), '')"


METHOD = (
    f"concat({_spark_pick(VERBS, 'p_partkey')}, '.', lower(p_type), '_', p_partkey % 50)"
)
REQUEST_ROW = _row(
    [
        (None, f"concat('<code>', {_spark_pick(NAMES, 'p_partkey + i * (p_size % 3)')}, '</code>')"),
        (None, _spark_pick(TYPES, "p_partkey + i")),
        (None, _spark_pick(NEEDED, "p_size + i")),
        ("(p_partkey + i) % 10 < 8", _spark_pick(ALLOWED, "p_partkey + 2 * i")),
        ("(p_partkey + i) % 10 < 9", f"concat('\\n\\t', {_spark_pick(DESCRIBED, 'p_size + i')})"),
    ]
)
RESPONSE_ROW = _row(
    [
        (None, "concat('field_', CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE i END)"),
        (None, _spark_pick(TYPES, "2 * p_partkey + i")),
        ("(p_partkey + i) % 5 <> 1", _spark_pick(NEEDED, "p_size + i")),
        ("(p_partkey + i) % 5 > 1", _spark_pick(DESCRIBED, "p_size + i")),
    ]
)
ERROR_ROW = _row(
    [
        (None, "'text'"),
        (None, f"concat(' ', {_spark_pick(CODES, 'p_partkey + i')})"),
        ("(p_partkey + i) % 3 <> 1", "concat('<code>err_', i, '</code>')"),
        ("(p_partkey + i) % 3 = 2", _spark_pick(DESCRIBED, "p_size + i")),
    ]
)
HEAD = "'<table><tr><th>a</th><th>b</th></tr>'"
PAGE = f"""concat(
  '<!DOCTYPE html><html><body><!-- <h1>old</h1> -->',
  CASE WHEN p_partkey % 11 = 0 THEN '' ELSE concat('<h1> <b>', p_name, '</b> ', p_partkey, '\\n</h1>') END,
  CASE WHEN p_partkey % 17 = 0 THEN '' ELSE concat('<table><tr><th>Метод</th><th><code>"', {METHOD},
    '"</code></th></tr>', CASE WHEN p_partkey % 13 = 0 THEN '' ELSE
    concat('<tr><td>Описание</td><td>About\\n  ', p_name, ' </td></tr>') END, '</table>') END,
  '<h', 3 + p_partkey % 2, '>Параметры запроса</h', 3 + p_partkey % 2, '> ',
  CASE WHEN p_partkey % 19 = 5 THEN '<p>none</p>' ELSE '' END, {HEAD},
  {_rows('p_size % 4', REQUEST_ROW)}, '</table>',
  '<h5>Параметры запроса (пример)</h5>', {HEAD}, '<tr><td>x</td><td>x</td><td>x</td><td>x</td></tr></table>',
  '<h4>Параметры ответа</h4>', {HEAD}, {_rows('p_size % 3', RESPONSE_ROW)}, '</table>',
  CASE p_partkey % 3
    WHEN 1 THEN concat('<h4>', CASE WHEN p_size % 2 = 0 THEN 'Пример запроса' ELSE 'JSON структура запроса' END,
      '</h4><pre><code>{{"id": ', p_partkey, ', "tag": {{"brand": "', p_brand, '"}}}}</code></pre>')
    WHEN 2 THEN '<h4>Пример запроса</h4><pre><code>{{"id": </code></pre>'
    ELSE '' END,
  '<h4>Список возвращаемых ошибок</h4>', {HEAD}, {_rows('p_partkey % 4', ERROR_ROW)}, '</table>',
  '</body></html>')"""
PATH = f"""concat('/site/', CASE WHEN p_partkey % 23 = 0 THEN 'misc' WHEN p_size % 3 = 0 THEN 'call_api'
  ELSE 'data_api' END, '/', {_spark_pick(DOMAINS, 'p_partkey')}, '/', lower(p_type), '_', p_partkey,
  CASE WHEN p_size % 2 = 0 THEN '/index.html' ELSE '.html' END)"""


def doc_pages(m):
    return spread(m.table("part")).select(
        F.col("p_partkey").alias("page"), F.expr(PATH).alias("path"), F.expr(PAGE).alias("html")
    )


def catalog(m):
    return ct.extract(doc_pages(m))


# ---- the same facts in SQL ---------------------------------------------------


def _pick(values, index):
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


METHOD_SQL = f"{_pick(VERBS, 'p_partkey')} || '.' || lower(p_type) || '_' || p_partkey % 50"
PATH_SQL = f"""'/site/' || CASE WHEN p_partkey % 23 = 0 THEN 'misc' WHEN p_size % 3 = 0 THEN 'call_api'
  ELSE 'data_api' END || '/' || {_pick(DOMAINS, 'p_partkey')} || '/' || lower(p_type) || '_' || p_partkey
  || CASE WHEN p_size % 2 = 0 THEN '/index.html' ELSE '.html' END"""
KEY_SQL = f"""CASE WHEN p_partkey % 23 = 0 THEN
    CASE WHEN p_size % 2 = 0 THEN lower(p_type) || '_' || p_partkey
      ELSE {_pick(DOMAINS, 'p_partkey')} || '.' || lower(p_type) || '_' || p_partkey END
  ELSE CASE WHEN p_size % 3 = 0 THEN 'calls.' ELSE 'data.' END || {_pick(DOMAINS, 'p_partkey')} || '.'
    || lower(p_type) || '_' || p_partkey END"""
ITEM_SQL = """CASE WHEN type <> 'array' THEN NULL
  WHEN regexp_matches(lower(allowed_values), 'адрес|email|номер|phone') THEN 'string'
  WHEN regexp_matches(lower(description), 'идентификатор|id') THEN 'number'
  WHEN contains(lower(description), 'номер') AND contains(lower(description), 'формат e164') THEN 'string'
  WHEN contains(lower(description), 'адрес') AND contains(lower(description), 'почт') THEN 'string'
  WHEN regexp_matches(name, 'phone|number|email') THEN 'string'
  WHEN regexp_matches(name, 'group|member|contact') THEN 'number' ELSE 'string' END"""
CTE = f"""
WITH page AS (SELECT p_partkey AS page, {PATH_SQL} AS path, {KEY_SQL} AS key,
    CASE WHEN p_partkey % 17 = 0 THEN '' ELSE {METHOD_SQL} END AS name,
    CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name || ' ' || p_partkey END AS title,
    CASE WHEN p_partkey % 17 = 0 OR p_partkey % 13 = 0 THEN '' ELSE 'About ' || p_name END AS description,
    p_size, p_brand FROM part),
tagged AS (SELECT *,
    CASE WHEN key LIKE 'calls.%' THEN 'calls' ELSE 'data' END AS api,
    CASE WHEN key LIKE 'data.%' OR key LIKE 'calls.%' THEN split_part(key, '.', 2)
      ELSE split_part(key, '.', 1) END AS raw_domain FROM page),
keyed AS (SELECT *, CASE raw_domain WHEN 'ca_deal' THEN 'deal' WHEN 'ca_contact' THEN 'contact'
    WHEN 'ca_employee' THEN 'employee' WHEN 'ca_sales_funnel' THEN 'sales_funnel' ELSE raw_domain END
    AS domain FROM tagged),
request_raw AS (SELECT p_partkey AS page, i, {_pick(NAMES, 'p_partkey + i * (p_size % 3)')} AS name,
    {_pick(TYPES, 'p_partkey + i')} AS type, {_pick(NEEDED, 'p_size + i')} IN ('да', 'Да ') AS required,
    CASE WHEN (p_partkey + i) % 10 < 8 THEN trim({_pick(ALLOWED, 'p_partkey + 2 * i')}) ELSE '' END
      AS allowed_values,
    {_pick(PLAIN, 'p_size + i')} AS description
  FROM part, unnest([0, 1, 2, 3]) t(i)
  WHERE i < p_size % 4 AND p_partkey % 19 <> 5 AND (p_partkey + i) % 10 < 9),
request AS (SELECT *, {ITEM_SQL} AS array_item_type FROM request_raw
  QUALIFY row_number() OVER (PARTITION BY page, name ORDER BY i DESC) = 1),
response_raw AS (SELECT p_partkey AS page, i,
    'field_' || CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE i END AS name,
    {_pick(TYPES, '2 * p_partkey + i')} AS type, {_pick(NEEDED, 'p_size + i')} IN ('да', 'Да ') AS required,
    '' AS allowed_values,
    CASE WHEN (p_partkey + i) % 5 > 1 THEN {_pick(PLAIN, 'p_size + i')} ELSE '' END AS description
  FROM part, unnest([0, 1, 2, 3]) t(i) WHERE i < p_size % 3 AND (p_partkey + i) % 5 <> 1),
response AS (SELECT *, {ITEM_SQL} AS array_item_type FROM response_raw
  QUALIFY row_number() OVER (PARTITION BY page, name ORDER BY i DESC) = 1),
error AS (SELECT p_partkey AS page, i, {_pick(CODES, 'p_partkey + i')} AS code, 'err_' || i AS mnemonic,
    CASE WHEN (p_partkey + i) % 3 = 2 THEN replace({_pick(PLAIN, 'p_size + i')}, 'Адрес почты',
      'Адрес  почты') ELSE '' END AS description
  FROM part, unnest([0, 1, 2, 3]) t(i) WHERE i < p_partkey % 4 AND (p_partkey + i) % 3 <> 1)
"""
VERB_SQL = """CASE WHEN starts_with({c}, 'get.') THEN 'get' WHEN starts_with({c}, 'create.') THEN 'post'
  WHEN starts_with({c}, 'update.') THEN 'put' WHEN starts_with({c}, 'delete.') THEN 'delete' ELSE 'post' END"""


# ---- page scan -----------------------------------------------------------------

PAGE_PATH_SQL = """(SELECT page_id, html, CASE WHEN p LIKE '%/' THEN p || 'index.html' ELSE p END AS path
  FROM (SELECT page_id, html, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS p
  FROM pages))"""


def _files(m):
    return m.pages().select("page_id", pg.page_path("url").alias("path"), "html")


@query("page_scan", f"SELECT page_id, path, strlen(html) AS size FROM {PAGE_PATH_SQL}")
def page_scan(m):
    return _files(m).select("page_id", "path", F.octet_length("html").cast("long").alias("size"))


SCAN = pg.ScanOptions(exclude_dirs=("/de", "ads-track"), max_depth=2)


@query(
    "scan_filter",
    f"""SELECT page_id, path FROM {PAGE_PATH_SQL} WHERE lower(path) LIKE '%.html'
    AND NOT regexp_matches(path, '/de/|ads-track')
    AND len(string_split(path, '/')) - 1 <= 2""",
)
def scan_filter(m):
    return pg.scan_filter(_files(m), SCAN).select("page_id", "path")


@query(
    "scan_summary",
    f"""
    WITH f AS (SELECT * FROM {PAGE_PATH_SQL} WHERE NOT regexp_matches(path, '/de/')),
    d AS (SELECT unnest(list_transform(range(1, len(string_split(path, '/'))),
      lambda n: array_to_string(string_split(path, '/')[1:n], '/'))) AS dir FROM {PAGE_PATH_SQL}
      WHERE true)
    SELECT count(*) AS total_files, count(*) FILTER (WHERE lower(path) LIKE '%.html') AS html_files,
      0 AS skipped_files, 0 AS error_files, (SELECT count(DISTINCT dir) FROM d WHERE NOT regexp_matches(dir, '/de/')) AS total_dirs FROM f
    """,
)
def scan_summary(m):
    return pg.scan_summary(_files(m), pg.ScanOptions(exclude_dirs=("/de",)))


CATEGORY_SQL = """regexp_extract(path, '^[^/]+/([^/]+)', 1)"""


def _category(part):
    return f"upper({part}[1]) || {part}[2:]"


@query(
    "page_categories",
    f"SELECT {_category(CATEGORY_SQL)} AS category, path FROM {PAGE_PATH_SQL}",
)
def page_categories(m):
    below = _files(m).select(F.regexp_replace("path", "^[^/]+/", "").alias("rel"), "path")
    return below.select(tx.category("rel").alias("category"), "path")


@query(
    "file_stats",
    f"""
    SELECT coalesce(category, '*') AS category, count(*) AS files,
      arg_min(path, (-strlen(html), path)) AS largest_file, max(strlen(html)) AS largest_size,
      arg_min(path, (strlen(html), path)) AS smallest_file, min(strlen(html)) AS smallest_size
    FROM (SELECT *, {_category(CATEGORY_SQL)} AS category FROM
      (SELECT regexp_replace(path, '^[^/]+/', 'site/') AS path, html FROM {PAGE_PATH_SQL}))
    GROUP BY ROLLUP (category)
    """,
)
def file_stats(m):
    files = _files(m).withColumn("path", F.regexp_replace("path", "^[^/]+/", "site/"))
    return pg.file_stats(files, root="site")


@query(
    "page_title",
    r"""SELECT page_id, trim(replace(replace(replace(replace(replace(regexp_replace(
      regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), E' \n\t') AS title FROM pages""",
)
def page_title(m):
    from ringlens.functions.html import first_heading, without_noise

    clean = m.pages().select("page_id", without_noise("html").alias("html"))
    return clean.select("page_id", first_heading("html").alias("title"))


# ---- extraction ----------------------------------------------------------------


@query("doc_method", f"{CTE} SELECT page, name, title, {VERB_SQL.format(c='name')} AS http_method FROM page")
def doc_method(m):
    return catalog(m).select("page", "name", "title", "http_method")


@query("doc_description", f"{CTE} SELECT page, description FROM page")
def doc_description(m):
    return catalog(m).select("page", "description")


@query(
    "doc_sections",
    f"""{CTE} SELECT p_partkey AS page, 3 + p_partkey % 2 AS request_level,
      CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS examples,
      CASE WHEN p_partkey % 19 = 5 THEN 0 ELSE p_size % 4 END AS request_rows FROM part""",
)
def doc_sections(m):
    from ringlens.functions import html as ht

    clean = doc_pages(m).select("page", ht.without_noise("html").alias("html"))
    parsed = clean.select("page", ht.sections_of("html").alias("sections"))
    request = ht.pick_sections("sections", ct.REQUEST_TITLE)
    examples = F.filter("sections", lambda s: s.title.isin(*ct.REQUEST_EXAMPLES))
    return parsed.select(
        "page",
        F.expr(f"get({request}, 0).level").alias("request_level"),
        F.size(examples).alias("examples"),
        F.expr(f"size({ht.table_after(request)})").alias("request_rows"),
    )


PARAM_COLUMNS = "page, name, type, required, allowed_values, description, array_item_type"


def _params(m, direction):
    return ct.each(catalog(m), ["page"], f"{direction}_params").drop("pos")


@query("doc_request_params", f"{CTE} SELECT {PARAM_COLUMNS} FROM request")
def doc_request_params(m):
    return _params(m, "request")


@query("doc_response_params", f"{CTE} SELECT {PARAM_COLUMNS} FROM response")
def doc_response_params(m):
    return _params(m, "response")


@query("doc_errors", f"{CTE} SELECT page, code, mnemonic, description FROM error")
def doc_errors(m):
    return ct.each(catalog(m), ["page"], "errors").drop("pos")


@query(
    "doc_examples",
    """
    SELECT p_partkey AS page, CASE p_partkey % 3 WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE -1 END AS members,
      CASE WHEN p_partkey % 3 = 1 THEN p_partkey::VARCHAR END AS id,
      CASE WHEN p_partkey % 3 = 1 THEN '{"brand":"' || p_brand || '"}' END AS tag FROM part
    """,
)
def doc_examples(m):
    members = F.col("request_json")
    return catalog(m).select(
        "page",
        F.when(members.isNotNull(), F.size(members)).otherwise(-1).alias("members"),
        F.try_element_at(members, F.lit("id")).alias("id"),
        F.try_element_at(members, F.lit("tag")).alias("tag"),
    )


@query(
    "json_examples",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def json_examples(m):
    members = ct.json_object(F.col("properties"))
    return m.events().select("event_id", F.try_element_at(members, F.lit("k")).alias("k"))


@query(
    "array_item_type",
    f"""{CTE} SELECT name, array_item_type, count(*) AS n FROM request
    WHERE type = 'array' GROUP BY ALL""",
)
def array_item_type(m):
    return (
        _params(m, "request")
        .filter("type = 'array'")
        .groupBy("name", "array_item_type")
        .agg(F.count("*").alias("n"))
    )


LAST_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity"


@query(
    "last_wins_dedupe",
    f"""SELECT l_orderkey AS call_id, l_linenumber AS leg_no, l_partkey AS number_id, l_suppkey AS employee_id
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {', '.join(c + ' DESC' for c in LAST_ORDER.split(', '))}) = 1""",
)
def last_wins_dedupe(m):
    order = ["leg_time", "number_id", "employee_id", "charge", "duration"]
    legs = m.legs().select("call_id", "leg_no", *order)
    return ct.last_wins(legs, ["call_id", "leg_no"], order).select(
        "call_id", "leg_no", "number_id", "employee_id"
    )


# ---- catalog -------------------------------------------------------------------

SCHEMA_SQL = """CASE WHEN type IN ('string', 'number', 'boolean', 'object', 'array') THEN type
  WHEN type = 'enum' THEN 'string' END"""
LAX_ENUM_SQL = """CASE WHEN NOT regexp_matches(lower(allowed_values), 'формат|format')
  AND contains(allowed_values, ',') THEN list_transform(string_split(allowed_values, ','), lambda x: trim(x)) END"""
STRICT_ENUM_SQL = """CASE WHEN NOT regexp_matches(lower(allowed_values), 'формат|format|e\\.164|international')
  AND len(list_filter(list_transform(string_split(allowed_values, ','), lambda x: trim(x)), lambda x: x <> '')) > 0
  THEN list_filter(list_transform(string_split(allowed_values, ','), lambda x: trim(x)), lambda x: x <> '') END"""


@query(
    "assemble_params",
    f"""{CTE}, ok AS (SELECT page FROM page WHERE name <> '')
    SELECT 'request' AS side, page, name, {SCHEMA_SQL} AS schema_type, required,
      array_to_string({LAX_ENUM_SQL}, '|') AS enum,
      coalesce(({LAX_ENUM_SQL})[1], CASE type WHEN 'string' THEN '"example_string"' WHEN 'number' THEN '123'
        WHEN 'boolean' THEN 'true' WHEN 'array' THEN '[]' END) AS example,
      array_item_type AS item_type FROM request JOIN ok USING (page)
    UNION ALL
    SELECT 'response', page, name, {SCHEMA_SQL}, required, NULL,
      CASE type WHEN 'string' THEN '"example_string"' WHEN 'number' THEN '123'
        WHEN 'boolean' THEN 'true' WHEN 'array' THEN '[]' END, array_item_type
    FROM response JOIN ok USING (page)""",
)
def assemble_params(m):
    rows = ct.methods(catalog(m)).withColumns(ct.assemble())
    sides = [
        rows.select(
            F.lit(side).alias("side"), "page", F.explode_outer(f"{side}_schema").alias("name", "s")
        ).filter("name IS NOT NULL")
        for side in ("request", "response")
    ]
    return sides[0].unionByName(sides[1]).select(
        "side",
        "page",
        "name",
        F.col("s.type").alias("schema_type"),
        "s.required",
        F.array_join("s.enum", "|").alias("enum"),
        "s.example",
        "s.item_type",
    )


@query(
    "required_names",
    f"""{CTE} SELECT page, coalesce(string_agg(r.name, ',' ORDER BY r.name) FILTER (WHERE r.required), '')
      AS required FROM page LEFT JOIN request r USING (page) WHERE page.name <> '' GROUP BY 1""",
)
def required_names(m):
    rows = ct.methods(catalog(m))
    return rows.select(
        "page", F.array_join(ct.assemble()["request_required"], ",").alias("required")
    )


@query(
    "render_description",
    f"""{CTE}, q AS (SELECT page, '**Request Parameters:** ' || count(*) || E'\\n\\n' || string_agg(
        '- `' || name || '` (' || type || ', ' || CASE WHEN required THEN 'required' ELSE 'optional' END
        || '): ' || description, E'\\n\\n' ORDER BY name) AS text FROM request GROUP BY 1),
    a AS (SELECT page, '**Response Parameters:** ' || count(*) || E'\\n\\n' || string_agg(
        '- `' || name || '` (' || type || '): ' || description, E'\\n\\n' ORDER BY name) AS text
        FROM response GROUP BY 1)
    SELECT page, concat_ws(E'\\n\\n', nullif(description, ''), q.text, a.text) AS text
    FROM page LEFT JOIN q USING (page) LEFT JOIN a USING (page) WHERE name <> ''""",
)
def render_description(m):
    return ct.methods(catalog(m)).select("page", ct.render_description().alias("text"))


@query(
    "response_fanout",
    f"""{CTE}, ok AS (SELECT page FROM page WHERE name <> ''),
    special AS (SELECT page, code, description FROM error JOIN ok USING (page)
      WHERE regexp_matches(code, '^[1-5][0-9][0-9]$')
      QUALIFY row_number() OVER (PARTITION BY page, code ORDER BY i DESC) = 1)
    SELECT page, '200' AS code, 'Successful response' AS description FROM ok
    UNION ALL SELECT page, '400', 'Error response' FROM ok UNION ALL SELECT * FROM special""",
)
def response_fanout(m):
    rows = ct.methods(catalog(m)).withColumn("path", F.col("page"))
    return ct.explode_responses(rows).select(F.col("path").alias("page"), "code", "description")


@query(
    "default_title",
    f"""{CTE} SELECT page, coalesce(nullif(title, ''), 'Service API - ' || name) AS title,
    coalesce(nullif(description, ''), 'API endpoint for ' || name) AS description
    FROM page WHERE name <> ''""",
)
def default_title(m):
    return ct.with_defaults(ct.methods(catalog(m))).select("page", "title", "description")


@query("catalog_key", f"{CTE} SELECT page, key, api, domain FROM keyed")
def catalog_key(m):
    return ct.keyed(doc_pages(m).select("page", "path")).select("page", "key", "api", "domain")


@query(
    "page_key",
    f"""SELECT page_id, regexp_replace(regexp_replace(replace(regexp_extract(path, '([^/]*/)?[^/]*$'),
      '/', '.'), '\\.html$', ''), '\\.index$', '') AS key FROM {PAGE_PATH_SQL}""",
)
def page_key(m):
    return _files(m).select("page_id", tx.catalog_key("path").alias("key"))


def _items(m):
    return ct.keyed(ct.methods(catalog(m)))


@query(
    "bundle_by_domain",
    f"""{CTE} SELECT domain, api, count(*) AS files, count(DISTINCT name) AS paths,
      domain || CASE WHEN api = 'calls' THEN '_calls' ELSE '' END AS bundle,
      'Service ' || upper(domain[1]) || domain[2:] || CASE WHEN api = 'calls' THEN ' Calls API' ELSE ' API' END
        AS title
    FROM keyed WHERE name <> '' GROUP BY 1, 2 HAVING count(*) >= 5""",
)
def bundle_by_domain(m):
    return ct.bundle_by_domain(_items(m), min_files=5)


@query(
    "bundle_by_type",
    f"""{CTE} SELECT api, count(*) AS files, count(DISTINCT name) AS paths FROM keyed
    WHERE name <> '' AND NOT contains(path, '/tag/') GROUP BY 1""",
)
def bundle_by_type(m):
    filed = _items(m).withColumn(
        "path",
        F.concat(
            F.lit("/spec/"),
            F.when(F.col("path").contains("/tag/"), "other").otherwise(F.col("api")),
            F.lit("/"),
            "key",
        ),
    )
    return ct.bundle_by_type(filed)


@query(
    "bundle_title",
    f"""{CTE} SELECT DISTINCT domain, api, 'Service ' || upper(domain[1]) || domain[2:]
    || CASE WHEN api = 'calls' THEN ' Calls API' ELSE ' API' END AS title FROM keyed""",
)
def bundle_title(m):
    rows = ct.keyed(doc_pages(m).select("path"))
    return rows.select("domain", "api", ct.bundle_title("domain", "api").alias("title")).distinct()


@query(
    "bundle_members",
    f"""{CTE} SELECT domain, api, name, min(path) AS path FROM keyed WHERE name <> '' GROUP BY ALL""",
)
def bundle_members(m):
    return ct.bundle_members(_items(m))


@query(
    "bundle_conflicts",
    f"""{CTE} SELECT page, name, path FROM keyed WHERE name <> ''
    QUALIFY row_number() OVER (PARTITION BY domain, api, name ORDER BY path) > 1""",
)
def bundle_conflicts(m):
    rows = settled(_items(m).select("page", "domain", "api", "name", "path"), "items")
    return ct.conflicts(rows, ["domain", "api", "name"], ["path"]).select("page", "name", "path")


@query(
    "first_wins_dedupe",
    """SELECT o_custkey AS contact_id, o_orderpriority AS tag, o_orderkey AS call_id, o_orderstatus AS status
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
      ORDER BY o_orderdate, o_orderkey) = 1""",
)
def first_wins_dedupe(m):
    rows = m.calls().drop("revenue")
    return ct.first_wins(rows, ["contact_id", "tag"], ["start_time", "call_id"]).drop("start_time")


@query(
    "merge_components",
    f"""{CTE} SELECT domain, api, r.type, r.name, array_item_type FROM request r
    JOIN keyed k USING (page) WHERE k.name <> ''
    QUALIFY row_number() OVER (PARTITION BY domain, api, r.type, r.name ORDER BY path, i) = 1""",
)
def merge_components(m):
    items = ct.keyed(ct.methods(catalog(m)))
    keep = ["domain", "api", "path"]
    components = ct.each(items.drop("name"), keep, "request_params").select(
        *keep, "pos", "type", "name", "array_item_type"
    )
    return ct.merge_components(components).select("domain", "api", "type", "name", "array_item_type")


@query(
    "merge_errors",
    f"""{CTE} SELECT DISTINCT domain, api, code, mnemonic, error.description
    FROM error JOIN keyed USING (page) WHERE name <> ''""",
)
def merge_errors(m):
    rows = ct.each(_items(m), ["domain", "api"], "errors")
    return ct.merge_errors(rows, ["domain", "api"])


@query(
    "derive_rules",
    f"""{CTE}, ok AS (SELECT page, name AS method FROM page WHERE name <> '')
    SELECT method, part, field, type, required, enum, count(*) AS n FROM (
      SELECT method, 'params' AS part, name AS field,
        CASE WHEN type IN ('string', 'number', 'boolean', 'object', 'array') THEN type ELSE 'string' END AS type,
        required, coalesce(array_to_string({STRICT_ENUM_SQL}, '|'), '') AS enum
      FROM request JOIN ok USING (page)
      UNION ALL SELECT method, 'envelope', 'jsonrpc', 'string', true, '2.0' FROM ok
      UNION ALL SELECT method, 'envelope', 'id', 'number', true, '' FROM ok
      UNION ALL SELECT method, 'envelope', 'method', 'string', true, method FROM ok) GROUP BY ALL""",
)
def derive_rules(m):
    rules = ct.derive_rules(catalog(m))
    keys = ["method", "part", "field", "type", "required"]
    joined = F.coalesce(F.array_join("enum", "|"), F.lit(""))
    return rules.groupBy(*keys, joined.alias("enum")).agg(F.count("*").alias("n"))


def _rules(*rows):
    """A literal rule array: (field, type, required, enum, minimum)."""
    return F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.lit(kind).alias("type"),
                F.lit(required).alias("required"),
                (F.array(*map(F.lit, enum)) if enum else F.lit(None).cast("array<string>")).alias("enum"),
                F.lit(None).cast("string").alias("format"),
                F.lit(minimum).cast("double").alias("minimum"),
            )
            for field, kind, required, enum, minimum in rows
        ]
    )


RULES = (
    ("name", "string", True, None, None),
    ("age", "number", False, None, 0.0),
    ("segment", "string", True, ("BUILDING", "MACHINERY", "HOUSEHOLD"), None),
    ("vip", "boolean", False, None, None),
)
# customer rows as JSON records with faults: no name, negative age, age as text, bad segment
RECORD = """concat('{', CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('"name": "', c_name, '", ') END,
  '"age": ', CASE WHEN c_custkey % 7 = 0 THEN '"old"' ELSE CAST(c_custkey % 50 - 5 AS STRING) END,
  ', "segment": "', c_mktsegment, '", "vip": ', CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '}' END)"""
ERROR_SQL = """
    SELECT contact_id, unnest(list_filter([
      CASE WHEN broken THEN '(root):invalid_type' END,
      CASE WHEN NOT broken AND c_custkey % 5 = 0 THEN 'name:required' END,
      CASE WHEN NOT broken AND c_custkey % 7 = 0 THEN 'age:invalid_type' END,
      CASE WHEN NOT broken AND c_custkey % 7 <> 0 AND c_custkey % 50 < 5 THEN 'age:number_gte' END,
      CASE WHEN NOT broken AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'segment:enum' END
    ], lambda x: x IS NOT NULL)) AS problem
    FROM (SELECT *, c_custkey AS contact_id, c_custkey % 11 = 0 AS broken FROM customer)"""


def _validated(m):
    records = m.table("customer").select(
        F.col("c_custkey").alias("contact_id"), F.expr(RECORD).alias("payload")
    )
    return ct.validate(records, "payload", _rules(*RULES))


@query(
    "validate_records",
    f"""WITH e AS ({ERROR_SQL}) SELECT c_custkey AS contact_id, count(problem) = 0 AS valid,
    count(problem) AS problems FROM customer LEFT JOIN e ON c_custkey = contact_id GROUP BY 1""",
)
def validate_records(m):
    return _validated(m).select("contact_id", "valid", F.size("errors").alias("problems"))


@query("validation_errors", ERROR_SQL)
def validation_errors(m):
    rows = ct.validation_errors(_validated(m), "contact_id")
    return rows.select("contact_id", F.concat_ws(":", "field", "type").alias("problem"))


@query(
    "validate_properties",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) >= 50 AS valid FROM events""",
)
def validate_properties(m):
    rules = _rules(("k", "number", True, None, 50.0))
    return ct.validate(m.events(), "properties", rules).select("event_id", "valid")


# ---- batch results -------------------------------------------------------------

RESULT_SQL = f"""{CTE}, counted AS (SELECT page, path, name,
    (SELECT count(*) FROM request r WHERE r.page = page.page)
      + (SELECT count(*) FROM response r WHERE r.page = page.page) AS n_params,
    (SELECT count(*) FROM error e WHERE e.page = page.page) AS n_errors FROM page),
result AS (SELECT path, name <> '' AS success,
    CASE WHEN name = '' THEN '{ct.MISSING_METHOD}' END AS error, nullif(name, '') AS name,
    CASE WHEN name = '' THEN 0 ELSE n_params END AS params,
    CASE WHEN name = '' THEN 0 ELSE n_errors END AS errors,
    CAST(page % 1000 AS DOUBLE) AS cost FROM counted)"""


def _results(m):
    return ct.batch_results(catalog(m), F.col("page") % 1000)


@query("batch_results", f"{RESULT_SQL} SELECT *, NULL AS stage_error FROM result")
def batch_results(m):
    return _results(m)


REPORT_SQL = """SELECT count(*) AS total, count(*) FILTER (WHERE success) AS success_count,
    count(*) FILTER (WHERE NOT success) AS error_count, CAST(coalesce(sum(params), 0) AS BIGINT) AS total_params,
    CAST(coalesce(sum(errors), 0) AS BIGINT) AS total_errors,
    coalesce(sum(CAST(cost AS BIGINT)) / nullif(count(*), 0), 0) AS average_cost FROM result"""


@query("batch_report", f"{RESULT_SQL} {REPORT_SQL}")
def batch_report(m):
    return ct.batch_report(_results(m))


@query("batch_report_empty", f"{RESULT_SQL} {REPORT_SQL} WHERE path IS NULL")
def batch_report_empty(m):
    return ct.batch_report(_results(m).filter("path IS NULL"))


@query("batch_pages", """SELECT page_id, false AS success FROM pages""")
def batch_pages(m):
    """Real web pages hold no method table, so every one is a failed row, not a failed job."""
    catalog_rows = ct.extract(_files(m))
    return ct.batch_results(catalog_rows.withColumn("path", F.col("page_id")), F.lit(1)).select(
        F.col("path").alias("page_id"), "success"
    )


@query(
    "extremes",
    """SELECT arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS fastest,
    arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS slowest FROM orders""",
)
def extremes(m):
    return ct.extremes(m.calls(), "call_id", "revenue")


@query(
    "summary_lists",
    f"""{RESULT_SQL} SELECT CASE WHEN success THEN 'method' ELSE 'error' END AS list,
    coalesce(name, error) AS entry, count(*) AS n FROM result GROUP BY 1, 2""",
)
def summary_lists(m):
    return ct.summary_lists(_results(m))


@query("openapi_documents")
def openapi_documents(m):
    return ct.openapi(catalog(m))


@query(
    "openapi_parameters",
    f"""{CTE} SELECT page.page, count(r.name) AS params FROM page LEFT JOIN request r USING (page)
    WHERE page.name <> '' GROUP BY 1""",
)
def openapi_parameters(m):
    """Parameter counts read back from the finished documents."""
    documents = ct.openapi(catalog(m).withColumn("path", F.col("page"))).withColumn(
        "d", F.parse_json("document")
    )
    operation = F.variant_get("d", "$.paths", "map<string,map<string,variant>>")
    body = F.map_values(F.map_values(operation)[0])[0]
    properties = F.try_variant_get(
        body,
        "$.requestBody.content['application/json'].schema.properties.params.properties",
        "map<string,variant>",
    )
    return documents.select(
        F.col("path").alias("page"), F.coalesce(F.size(properties), F.lit(0)).alias("params")
    )


@query(
    "openapi_fields",
    f"""{CTE}, ok AS (SELECT * FROM page WHERE name <> ''),
    q AS (SELECT page, '**Request Parameters:** ' || count(*) || E'\\n\\n' || string_agg(
        '- `' || name || '` (' || type || ', ' || CASE WHEN required THEN 'required' ELSE 'optional' END
        || '): ' || description, E'\\n\\n' ORDER BY name) AS text,
        string_agg(name, ',' ORDER BY name) FILTER (WHERE required) AS needed,
        string_agg(name, ',' ORDER BY name) AS named FROM request GROUP BY 1),
    a AS (SELECT page, '**Response Parameters:** ' || count(*) || E'\\n\\n' || string_agg(
        '- `' || name || '` (' || type || '): ' || description, E'\\n\\n' ORDER BY name) AS text,
        string_agg(name, ',' ORDER BY name) AS named FROM response GROUP BY 1),
    codes AS (
      SELECT page, string_agg(code || '=' || description, ';' ORDER BY code) AS responses FROM (
        SELECT page, '200' AS code, 'Successful response' AS description FROM ok
        UNION ALL SELECT page, '400', 'Error response' FROM ok
        UNION ALL SELECT page, code, description FROM (
          SELECT page, code, error.description FROM error JOIN ok USING (page)
          WHERE regexp_matches(code, '^[1-5][0-9][0-9]$')
          QUALIFY row_number() OVER (PARTITION BY page, code ORDER BY i DESC) = 1)) GROUP BY 1),
    e AS (SELECT page, count(*) AS n FROM error GROUP BY 1)
    SELECT page, '3.0.0' AS openapi, '1.0.0' AS version, coalesce(nullif(title, ''), 'Service API - ' || name) AS title,
      coalesce(nullif(description, ''), 'API endpoint for ' || name) AS description, '/' || name AS path,
      {VERB_SQL.format(c='name')} AS verb, title AS summary,
      concat_ws(E'\\n\\n', nullif(description, ''), q.text, a.text) AS text, 'service' AS tag, responses,
      coalesce(q.needed, '') AS needed, coalesce(q.named, '') AS asked, coalesce(a.named, '') AS given,
      coalesce(e.n, 0) AS errors
    FROM ok LEFT JOIN q USING (page) LEFT JOIN a USING (page) LEFT JOIN codes USING (page) LEFT JOIN e USING (page)""",
)
def openapi_fields(m):
    """Every field of the finished documents, read back from their text."""
    documents = ct.openapi(catalog(m).withColumn("path", F.col("page"))).withColumn("d", F.parse_json("document"))
    paths = F.variant_get("d", "$.paths", "map<string,map<string,variant>>")
    rows = documents.select(F.col("path").alias("page"), "d", paths.alias("paths"))
    operations = F.map_values("paths")[0]
    rows = rows.withColumns({"verb": F.map_keys(operations)[0], "op": F.map_values(operations)[0]})

    def get(column, path, kind="string"):
        return F.try_variant_get(column, path, kind)

    def schema(response):
        return f"$.responses['{response}'].content['application/json'].schema.properties.result.properties.data.properties"

    def names(found):
        return F.coalesce(F.array_join(F.array_sort(F.map_keys(found)), ","), F.lit(""))

    params = "$.requestBody.content['application/json'].schema.properties.params"
    replies = get(F.col("op"), "$.responses", "map<string,variant>")
    reply = lambda e: F.concat(e["key"], F.lit("="), F.try_variant_get(e["value"], "$.description", "string"))
    needed = F.array_sort(get(F.col("op"), f"{params}.required", "array<string>"))
    return rows.select(
        "page", get("d", "$.openapi").alias("openapi"), get("d", "$.info.version").alias("version"),
        get("d", "$.info.title").alias("title"), get("d", "$.info.description").alias("description"),
        F.map_keys("paths")[0].alias("path"), "verb", get("op", "$.summary").alias("summary"),
        get("op", "$.description").alias("text"), get("op", "$.tags[0]").alias("tag"),
        F.array_join(F.array_sort(F.transform(F.map_entries(replies), reply)), ";").alias("responses"),
        F.coalesce(F.array_join(needed, ","), F.lit("")).alias("needed"),
        names(get(F.col("op"), f"{params}.properties", "map<string,variant>")).alias("asked"),
        names(get(F.col("op"), schema("200"), "map<string,variant>")).alias("given"),
        F.coalesce(F.size(get("d", "$['x-errors'].errors", "array<variant>")), F.lit(0)).alias("errors"),
    )
