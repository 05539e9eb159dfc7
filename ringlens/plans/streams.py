"""Streaming queries drained to a table in the shared folder, and sinks read back."""
from __future__ import annotations

from pyspark.sql import functions as F

from ringlens.operators import catalog as ct
from ringlens.operators.report import Metric, ReportSpec, report_table
from ringlens.plans.aggregates import dsum
from ringlens.plans.docs import CTE, catalog, doc_pages
from ringlens.plans.registry import query
from ringlens.plans.windows import secs
from ringlens.session import shared_dir
from ringlens.sources import sinks
from ringlens.streaming import live, stateful


@query(
    "visits_live",
    """SELECT event_id, ts AS date_time, user_id AS visitor_id FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE""",
)
def visits_live(m):
    return live.visits_last(m.events(), "date_time").select("event_id", "date_time", "visitor_id")


@query(
    "visits_live_stream",
    """
    SELECT w AS "from", w + INTERVAL 30 MINUTE AS till, count(*) AS visits FROM (
      SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k for k in range(6)]) AS w
      FROM events WHERE event_type = 'view') GROUP BY 1
    """,
)
def visits_live_stream(m):
    out = shared_dir(m.spark, "visits")
    views = live.table_stream(m.spark, m.path, "events").filter("event_type = 'view'")
    live.drain(live.visits_live(views), out, mode="update")
    return live.latest_update(live.drained(m.spark, out), ["from", "till"])


@query(
    "ingest_stream",
    "SELECT DISTINCT user_id || '-' || event_type AS ext_id FROM events",
)
def ingest_stream(m):
    """Each id comes out once: repeats inside the watermark fall in the stream, later ones
    in the batch rule applied to the written table."""
    out = shared_dir(m.spark, "ingest")
    ext = F.concat_ws("-", F.col("user_id").cast("string"), "event_type")
    stream = live.table_stream(m.spark, m.path, "events").withColumn("ext_id", ext)
    live.drain(live.ingest_stream(stream), out)
    written = live.drained(m.spark, out)
    return ct.first_wins(written.select("ext_id", "ts"), ["ext_id"], ["ts"]).select("ext_id")


VIEW_SESSIONS = f"""
    SELECT visitor_id, min(ts) AS start_time, max(ts) AS last_time, count(*) AS visits FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY visitor_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM (
        SELECT event_id, user_id AS visitor_id, ts, CASE WHEN {secs('lag(ts) OVER w', 'ts')} <= 1800 THEN 0 ELSE 1 END AS fresh
        FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
    GROUP BY visitor_id, no"""


def _sessions(m):
    """The views arrive in five parts, in time order, a part a batch."""
    inbox, out = shared_dir(m.spark, "visits-inbox"), shared_dir(m.spark, "visits-open")
    views = m.events().filter("kind = 'view'").select("visitor_id", "date_time")
    span = views.agg(F.min("date_time"), F.max("date_time")).first()
    share = F.lit((span[1] - span[0]).total_seconds() / 5 + 1)
    part = F.floor(F.date_diff("date_time", F.lit(span[0])) * 86400 / share).cast("int")
    for n in range(5):
        stateful.open_sessions(live.arrived(views.filter(part == n), inbox), out, 1800)
    return out


@query(
    "open_sessions_stream",
    f"""SELECT * FROM ({VIEW_SESSIONS})
    WHERE {secs('last_time', "(SELECT max(ts) FROM events WHERE event_type = 'view')")} <= 1800""",
)
def open_sessions_stream(m):
    rows = stateful.open_now(m.spark, _sessions(m))
    return rows.select("visitor_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_time", "last_time")], "visits")


@query("ended_sessions_stream", f"SELECT count(*) AS sessions, sum(visits)::BIGINT AS visits FROM ({VIEW_SESSIONS})")
def ended_sessions_stream(m):
    out = _sessions(m)
    rows = stateful.ended(m.spark, out).unionByName(stateful.open_now(m.spark, out))
    return rows.agg(F.count("*").alias("sessions"), F.sum("visits").alias("visits"))


@query(
    "ledgered_calls_stream",
    """
    WITH leg AS (SELECT l_orderkey AS ext_id, l_linenumber AS n, l_returnflag = 'A' AND l_quantity > 25 AS ok,
        l_returnflag AS flag, l_quantity AS quantity FROM lineitem),
    attempt AS (SELECT * FROM leg UNION ALL SELECT ext_id, n + 7, ok, flag, quantity FROM leg WHERE n <= 2),
    seen AS (
      SELECT *, coalesce(sum(ok::INT) OVER w, 0) AS good, coalesce(sum((NOT ok)::INT) OVER w, 0) AS bad
      FROM attempt WINDOW w AS (PARTITION BY ext_id ORDER BY n, flag, quantity
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT ext_id, count(*) AS attempts, coalesce(max(CASE WHEN ok THEN n END), -1) AS loaded_no
    FROM seen WHERE good = 0 AND bad < 3 GROUP BY 1
    """,
)
def ledgered_calls_stream(m):
    """Attempts arrive in four batches by their number; the last one repeats the first."""
    inbox, out = shared_dir(m.spark, "calls-inbox"), shared_dir(m.spark, "calls-loaded")
    attempts = m.legs().select(
        F.col("call_id").alias("ext_id"), F.col("leg_no").cast("long").alias("n"), "finish_reason", "duration"
    )
    ok = (F.col("finish_reason") == "A") & (F.col("duration") > 25)
    for low, high, repeat in ((1, 2, 0), (3, 3, 0), (4, 7, 0), (1, 2, 7)):
        rows = attempts.filter(F.col("n").between(low, high)).withColumn("n", F.col("n") + repeat)
        stateful.ledgered(live.arrived(rows, inbox), out, ok, ["n", "finish_reason", "duration"])
    tried = stateful.ledger(m.spark, out).groupBy("ext_id").agg(F.count("*").alias("attempts"))
    done = stateful.loaded(m.spark, out).select("ext_id", F.col("n").alias("loaded_no"))
    return tried.join(done, "ext_id", "left").na.fill(-1, ["loaded_no"])


@query(
    "pages_stream",
    f"""{CTE} SELECT page_id::VARCHAR AS path, strlen(html) > 0 AS read, false AS success FROM pages
    UNION ALL SELECT path, true, name <> '' FROM page""",
)
def pages_stream(m):
    """Raw pages, which hold no method, and rendered ones arrive together."""
    inbox, out = shared_dir(m.spark, "inbox"), shared_dir(m.spark, "pages")
    raw = m.pages().select(F.col("page_id").cast("string").alias("path"), "html")
    raw.unionByName(doc_pages(m).select("path", "html")).write.parquet(f"{inbox}/pages.parquet")
    live.drain(live.pages_results(live.table_stream(m.spark, inbox, "pages")), out)
    return live.drained(m.spark, out).select("path", (F.col("cost") > 0).alias("read"), "success")


@query(
    "bundle_output",
    f"""{CTE}, k AS (SELECT * FROM keyed WHERE name <> ''),
    b AS (SELECT domain, api, domain || CASE WHEN api = 'calls' THEN '_calls' ELSE '' END AS bundle,
      'Service ' || upper(domain[1]) || domain[2:] || CASE WHEN api = 'calls' THEN ' Calls API' ELSE ' API' END AS title
      FROM k GROUP BY 1, 2 HAVING count(*) >= 5)
    SELECT bundle, 'info' AS kind, title AS entry, '' AS source FROM b
    UNION ALL SELECT bundle, 'path', name, min(path) FROM k JOIN b USING (domain, api) GROUP BY bundle, name
    UNION ALL SELECT bundle, 'component', r.type || ' ' || r.name, min(path)
      FROM request r JOIN k USING (page) JOIN b USING (domain, api) GROUP BY ALL
    UNION ALL SELECT DISTINCT bundle, 'error', concat_ws(' ', code, mnemonic, error.description), ''
      FROM error JOIN k USING (page) JOIN b USING (domain, api)
    """,
)
def bundle_output(m):
    """Write the merged bundles and read their entries back."""
    out = shared_dir(m.spark, "bundles")
    sinks.write_bundles(ct.bundle_output(catalog(m), min_files=5), out)
    back = sinks.read_catalog(m.spark, out, "json", "bundle string, kind string, entry string, source string, body string")
    return back.filter("body IS NOT NULL").select("bundle", "kind", "entry", F.coalesce("source", F.lit("")).alias("source"))


@query(
    "catalog_scan",
    f"{CTE} SELECT page, name, domain, api, replace(name, '.', '_') AS file FROM keyed WHERE name <> ''",
)
def catalog_scan(m):
    """Write the catalog partitioned by API and domain, then discover and read it."""
    out = shared_dir(m.spark, "catalog")
    rows = catalog(m)
    sinks.write_catalog(rows, out, "json")
    schema = rows.schema.add("key", "string").add("file", "string")
    schema = schema.add("api", "string").add("domain", "string")
    return sinks.read_catalog(m.spark, out, "json", schema).select(
        "page", "name", "domain", "api", "file"
    )


@query(
    "catalog_openapi",
    f"{CTE} SELECT domain, api, count(*) AS documents FROM keyed WHERE name <> '' GROUP BY 1, 2",
)
def catalog_openapi(m):
    out = shared_dir(m.spark, "openapi")
    sinks.write_catalog(catalog(m), out, "openapi")
    documents = sinks.read_catalog(m.spark, out, schema=sinks.DOCUMENTS)
    return documents.groupBy("domain", "api").agg(F.count("document").alias("documents"))


@query(
    "batch_report_file",
    f"""{CTE} SELECT count(*) AS total, count(*) FILTER (WHERE name <> '') AS success_count,
    count(*) FILTER (WHERE name = '') AS error_count FROM page""",
)
def batch_report_file(m):
    out = shared_dir(m.spark, "report")
    results = ct.batch_results(catalog(m), F.lit(1))
    sinks.write_batch_report(ct.batch_report(results), out)
    return m.spark.read.json(out).select("total", "success_count", "error_count")


@query(
    "report_export",
    f"SELECT o_orderpriority AS tag, count(*) AS calls, {dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1",
)
def report_export(m):
    out = shared_dir(m.spark, "export")
    spec = ReportSpec(
        dimensions=("tag",),
        metrics=(Metric("calls", "count"), Metric("revenue", "sum", "revenue")),
        limit=None,
    )
    sinks.export_report(report_table(m.calls(), spec), out, "csv")
    return m.spark.read.csv(out, header=True, schema="tag string, calls long, revenue double")
