"""Scalar functions over whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.functions import text as tx
from ringlens.functions import urls, values
from ringlens.operators.report import bucket
from ringlens.operators.windows import seconds_between
from ringlens.plans.docs import VERB_SQL
from ringlens.plans.registry import query
from ringlens.plans.windows import secs

SPACE_SQL = r"E'[\n\r\t ]+'"


@query(
    "clean_text",
    f"""SELECT doc_id AS transcript_id, trim(regexp_replace(text, {SPACE_SQL}, ' ', 'g'),
    ' ' || chr(133) || chr(160) || chr(8195) || chr(12288)) AS text FROM documents""",
)
def clean_text(m):
    return m.transcripts().select("transcript_id", tx.clean_text("text").alias("text"))


@query(
    "http_verb",
    f"""SELECT method, {VERB_SQL.format(c='method')} AS verb, count(*) AS n FROM (
      SELECT ['get.', 'create.', 'update.', 'delete.', 'start.', 'get'][event_id % 6 + 1] || event_type AS method
      FROM events) GROUP BY 1, 2""",
)
def http_verb(m):
    prefix = F.expr(
        "element_at(array('get.', 'create.', 'update.', 'delete.', 'start.', 'get'), CAST(event_id % 6 AS INT) + 1)"
    )
    rows = m.events().select(F.concat(prefix, "kind").alias("method"))
    return rows.groupBy("method", tx.http_verb("method").alias("verb")).agg(F.count("*").alias("n"))


TYPE_WORDS = ["string", "number", "boolean", "object", "array", "enum", "iso8601", "id", "numeric", "duration", ""]
_WORD = "element_at(array({}), CAST(p_partkey % 11 AS INT) + 1)".format(
    ", ".join(f"'{t}'" for t in TYPE_WORDS)
)
_WORD_SQL = "([{}])[p_partkey % 11 + 1]".format(", ".join(f"'{t}'" for t in TYPE_WORDS))


def _typed(m):
    return m.table("part").select("p_partkey", F.expr(_WORD).alias("documented"))


@query(
    "schema_type",
    f"""SELECT p_partkey, CASE WHEN t IN ('string', 'number', 'boolean', 'object', 'array') THEN t
    WHEN t = 'enum' THEN 'string' END AS schema_type FROM (SELECT p_partkey, {_WORD_SQL} AS t FROM part)""",
)
def schema_type(m):
    return _typed(m).select("p_partkey", tx.schema_type("documented").alias("schema_type"))


@query(
    "json_type",
    f"""SELECT p_partkey, CASE WHEN t IN ('string', 'number', 'boolean', 'object', 'array') THEN t
    ELSE 'string' END AS json_type FROM (SELECT p_partkey, {_WORD_SQL} AS t FROM part)""",
)
def json_type(m):
    return _typed(m).select("p_partkey", tx.json_type("documented").alias("json_type"))


@query(
    "default_example",
    f"""SELECT p_partkey, CASE t WHEN 'string' THEN '"example_string"' WHEN 'number' THEN '123'
      WHEN 'boolean' THEN 'true' WHEN 'array' THEN '[]' END AS example,
      CASE t WHEN 'string' THEN '"example_string"' WHEN 'number' THEN '123'
      WHEN 'boolean' THEN 'true' END AS item_example
    FROM (SELECT p_partkey, {_WORD_SQL} AS t FROM part)""",
)
def default_example(m):
    return _typed(m).select(
        "p_partkey",
        tx.default_example("documented").alias("example"),
        tx.item_example("documented").alias("item_example"),
    )


# allowed-value cells of each kind, made from the part name
_CELL = """CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', ' , ') WHEN 1 THEN p_name
  WHEN 2 THEN concat('Format ', p_name, ', x') WHEN 3 THEN concat(p_name, ',, E.164 ')
  ELSE '' END"""
_LIST = "list_transform(string_split(c, ','), lambda x: trim(x))"


def _cells(m):
    return m.table("part").select("p_partkey", F.expr(_CELL).alias("c"))


@query(
    "enum_split",
    f"""SELECT p_partkey, CASE WHEN contains(lower(c), 'format') THEN c END AS format,
      CASE WHEN NOT contains(lower(c), 'format') AND contains(c, ',') THEN array_to_string({_LIST}, '|') END
        AS enum,
      CASE WHEN NOT contains(lower(c), 'format') AND contains(c, ',') THEN ({_LIST})[1] END AS example
    FROM (SELECT p_partkey, {_CELL} AS c FROM part)""",
)
def enum_split(m):
    enum = tx.allowed_enum("c")
    return _cells(m).select(
        "p_partkey",
        tx.allowed_format("c").alias("format"),
        F.array_join(enum, "|").alias("enum"),
        F.get(enum, F.lit(0)).alias("example"),
    )


@query(
    "enum_split_strict",
    f"""SELECT p_partkey, CASE WHEN f THEN c END AS format,
      CASE WHEN NOT f AND len(l) > 0 THEN array_to_string(l, '|') END AS enum
    FROM (SELECT p_partkey, c, regexp_matches(lower(c), 'format|e\\.164|international') AS f,
      list_filter({_LIST}, lambda x: x <> '') AS l FROM (SELECT p_partkey, {_CELL} AS c FROM part))""",
)
def enum_split_strict(m):
    return _cells(m).select(
        "p_partkey",
        tx.allowed_format("c", strict=True).alias("format"),
        F.array_join(tx.allowed_enum_strict("c"), "|").alias("enum"),
    )


@query(
    "http_status_filter",
    """SELECT l_partkey::VARCHAR AS code, count(*) AS n FROM lineitem
    WHERE l_partkey BETWEEN 100 AND 599 GROUP BY 1""",
)
def http_status_filter(m):
    rows = m.legs().select(F.col("number_id").cast("string").alias("code"))
    return rows.filter(tx.is_http_status("code")).groupBy("code").agg(F.count("*").alias("n"))


@query(
    "domain_map",
    """SELECT key, api, CASE d WHEN 'ca_deal' THEN 'deal' WHEN 'ca_contact' THEN 'contact' ELSE d END AS domain,
      count(*) AS n FROM (SELECT key, CASE WHEN key LIKE 'calls.%' THEN 'calls' ELSE 'data' END AS api,
        CASE WHEN key LIKE 'data.%' OR key LIKE 'calls.%' THEN split_part(key, '.', 2)
          ELSE split_part(key, '.', 1) END AS d
      FROM (SELECT ['data.', 'calls.', '', 'other.'][o_orderkey % 4 + 1]
        || ['ca_deal', 'ca_contact', 'tag'][o_custkey % 3 + 1] || ['.get', '', '.x.y'][o_orderkey % 3 + 1] AS key
        FROM orders)) GROUP BY ALL""",
)
def domain_map(m):
    key = F.expr(
        """concat(element_at(array('data.', 'calls.', '', 'other.'), CAST(call_id % 4 AS INT) + 1),
        element_at(array('ca_deal', 'ca_contact', 'tag'), CAST(contact_id % 3 AS INT) + 1),
        element_at(array('.get', '', '.x.y'), CAST(call_id % 3 AS INT) + 1))"""
    )
    rows = m.calls().select(key.alias("key"))
    return rows.groupBy(
        "key", tx.api_of("key").alias("api"), tx.domain_of("key").alias("domain")
    ).agg(F.count("*").alias("n"))


@query(
    "category",
    """SELECT p_name AS path, array_to_string(list_transform(string_split(
      split_part(replace(p_name, ' ', '_x.'), '/', 1), '.'),
      lambda w: upper(w[1]) || w[2:]), '.') AS category, count(*) AS n
    FROM part GROUP BY ALL""".replace("'_x.'", "'-.'"),
)
def category(m):
    """A file at the root: letters after a dot are capitalised too."""
    path = F.replace("number_name", F.lit(" "), F.lit("-."))
    rows = m.numbers().select(F.col("number_name").alias("path"), tx.category(path).alias("category"))
    return rows.groupBy("path", "category").agg(F.count("*").alias("n"))


@query("safe_name", "SELECT url, replace(url, '.', '_') AS name FROM pages")
def safe_name(m):
    return m.pages().select("url", tx.safe_name("url").alias("name"))


@query(
    "url_tags",
    """SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
      CAST(NULL AS VARCHAR) AS utm_medium,
      CASE WHEN page_id % 3 = 0 THEN page_id::VARCHAR END AS gclid,
      CASE WHEN page_id % 3 = 0 THEN 'svc' END AS openstat_service,
      CASE WHEN page_id % 3 = 0 THEN 'ad' || page_id END AS openstat_ad,
      regexp_extract(url, '^https?://([^/?#]+)', 1) AS referrer_domain FROM pages""",
)
def url_tags(m):
    """Sample addresses hold few marks, so click ids and openstat are appended to a third."""
    landing = F.when(
        F.col("page_id") % 3 == 0,
        F.concat(
            F.regexp_replace("url", "[?#].*$", ""),
            F.lit("?utm_source="),
            F.coalesce(urls.query_value("url", "utm_source"), F.lit("")),
            F.lit("&gclid="),
            F.col("page_id").cast("string"),
            F.lit("&_openstat=svc;cmp;ad"),
            F.col("page_id").cast("string"),
            F.lit(";src"),
        ),
    ).otherwise(F.col("url"))
    tags = urls.url_tags(landing, "url")
    tags["utm_source"] = F.nullif(tags["utm_source"], F.lit(""))
    names = ["utm_source", "utm_medium", "gclid", "openstat_service", "openstat_ad", "referrer_domain"]
    return m.pages().select("page_id", *[tags[n].alias(n) for n in names])


@query(
    "custom_props",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, 'b' AS kind,
      CAST(json_extract(props, '$.k') AS INTEGER) = 7 AS lucky FROM events""",
)
def custom_props(m):
    pairs = F.expr(
        """array(named_struct('name', 'k', 'value', get_json_object(properties, '$.k')),
        named_struct('name', 'kind', 'value', 'a'), named_struct('name', 'kind', 'value', 'b'))"""
    )
    rows = m.events().withColumn("pairs", pairs)
    props = values.properties_of("pairs")
    return rows.select(
        "event_id",
        props["k"].alias("k"),
        props["kind"].alias("kind"),
        values.has_property("pairs", "k", "7").alias("lucky"),
    )


@query(
    "time_bucket",
    """SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, date_trunc('week', ts)::TIMESTAMP AS week,
    date_trunc('quarter', ts)::TIMESTAMP AS quarter, count(*) AS n FROM events GROUP BY ALL""",
)
def time_bucket(m):
    units = [bucket("date_time", u).alias(u) for u in ("hour", "week", "quarter")]
    return m.events().groupBy(*units).agg(F.count("*").alias("n"))


@query(
    "durations",
    f"""SELECT l_orderkey AS call_id, l_linenumber AS leg_no, {secs('o_orderdate', 'l_shipdate')} AS wait
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def durations(m):
    rows = m.legs().join(m.calls(), "call_id")
    return rows.select("call_id", "leg_no", seconds_between("start_time", "leg_time").alias("wait"))


@query(
    "phone_check",
    """SELECT c_custkey AS contact_id, c_custkey % 3 = 0 AS ok FROM customer""",
)
def phone_check(m):
    number = F.expr(
        """CASE contact_id % 3 WHEN 0 THEN concat('7', lpad(CAST(contact_id AS STRING), 10, '0'))
        WHEN 1 THEN concat('+7', lpad(CAST(contact_id AS STRING), 10, '0'))
        ELSE concat('7', lpad(CAST(contact_id AS STRING), 9, '0')) END"""
    )
    return m.contacts().select("contact_id", values.is_e164(number).alias("ok"))


@query(
    "client_tz",
    """SELECT event_id, ts + INTERVAL 3 HOUR AS client_time, ts - INTERVAL 3 HOUR AS utc_time FROM events""",
)
def client_tz(m):
    """Moscow has no daylight saving in the sample's years, so the twin is a fixed shift."""
    return m.events().select(
        "event_id",
        values.to_client_tz("date_time", "Europe/Moscow").alias("client_time"),
        values.from_client_tz("date_time", "Europe/Moscow").alias("utc_time"),
    )
