"""Page scan, extraction, documents, rules and batch report on small cases."""
import json

import pytest
from pyspark.sql import functions as F

from ringlens.functions import text as tx
from ringlens.functions import html as ht
from ringlens.operators import catalog as ct
from ringlens.sources import pages as pg
from ringlens.sources import sinks

PAGE = """<!DOCTYPE html><html><head><script>var t = "<h1>no</h1>";</script></head><body>
<h1>Open &amp; close</h1>
<table><tr><th>Метод</th><th><code>'get.thing'</code></th></tr>
<tr><td>Описание</td><td>Line one
   line two &#8212; end</td></tr></table>
<h2>Параметры запроса (устаревшие)</h2><p>no table here</p>
<h4>Параметры запроса</h4>
<table><tr><th>a</th></tr><tr><td>hidden</td><td>string</td><td>да</td><td></td><td>x</td></tr></table>
<h4>Параметры ответа</h4>
<table><tr><th>a</th></tr>
<TR><TD>id</TD><TD>number</TD><TD>да</TD><TD>Key</TD></TR>
<tr><td>ids<td>array<td>нет
<tr><td>id</td><td>string</td><td>нет</td><td>again &lt;b&gt;</td></tr>
<tr><td></td><td>string</td><td>нет</td><td>no name</td></tr></table>
<h4>JSON структура запроса</h4><pre><code>{"a": {"b": [1]}, "c": "x"}</code></pre>
<h4>Пример ответа</h4><pre><code>{'single': 1}</code></pre>
<h4>Список возвращаемых ошибок</h4>
<table><tr><th>a</th></tr><tr><td>t</td><td>404</td><td><code>gone</code></td><td>Gone</td></tr>
<tr><td>t</td><td>-32602</td><td>bad</td></tr><tr><td>t</td><td>1</td></tr>
<tr><td>t</td><td>404</td><td>lost</td><td>Lost</td></tr></table></body></html>"""


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        ("/w/data_api/ca_deal/get_thing/index.html", PAGE),
        ("/w/call_api/tag/x.html", PAGE.replace("get.thing", "start.thing").replace("h2", "h6")),
        ("/w/none.html", "<h1>Nothing</h1>"),
    ]
    return ct.extract(spark.createDataFrame(rows, "path string, html string")).cache()


def row(catalog, part):
    return [r for r in catalog.collect() if part in r.path][0]


def test_method(catalog):
    r = row(catalog, "get_thing")
    assert (r.name, r.title, r.http_method) == ("get.thing", "Open & close", "get")
    assert r.description == "Line one line two — end"
    assert row(catalog, "none").name == "" and row(catalog, "none").request_params == []


def test_highest_header_level_counts(catalog):
    """A matching h2 hides the h4 even though no table follows it; an h6 does not."""
    assert row(catalog, "get_thing").request_params == []
    assert [p["name"] for p in row(catalog, "tag/x").request_params] == ["hidden"]


def test_response_rows(catalog):
    got = [tuple(p) for p in row(catalog, "get_thing").response_params]
    assert got == [
        ("ids", "array", False, "", "", "string"),
        ("id", "string", False, "", "again <b>", None),
    ]


def test_examples_and_errors(catalog):
    r = row(catalog, "get_thing")
    assert r.request_json == {"a": '{"b":[1]}', "c": "x"} and r.response_json == {}
    assert row(catalog, "none").request_json is None
    assert [tuple(e) for e in r.errors] == [
        ("404", "gone", "Gone"),
        ("-32602", "bad", ""),
        ("404", "lost", "Lost"),
    ]


def test_responses(catalog):
    got = {(r.code, r.description) for r in ct.explode_responses(catalog).collect() if "get_thing" in r.path}
    assert got == {("200", "Successful response"), ("400", "Error response"), ("404", "Lost")}


def test_document(catalog):
    documents = {r.name: json.loads(r.document) for r in ct.openapi(catalog, "Acme").collect()}
    assert set(documents) == {"get.thing", "start.thing"}
    operation = documents["get.thing"]["paths"]["/get.thing"]["get"]
    assert "requestBody" not in operation and operation["tags"] == ["acme"]
    data = operation["responses"]["200"]["content"]["application/json"]["schema"]["properties"][
        "result"
    ]["properties"]["data"]
    assert data["properties"]["ids"] == {
        "type": "array",
        "description": "",
        "example": [],
        "items": {"type": "string", "example": "example_string"},
    }
    assert len(documents["get.thing"]["x-errors"]["errors"]) == 3
    body = documents["start.thing"]["paths"]["/start.thing"]["post"]["requestBody"]
    schema = body["content"]["application/json"]["schema"]
    assert schema["required"] == ["jsonrpc", "id", "method", "params"]
    assert schema["properties"]["params"]["required"] == ["hidden"]


def test_keys_and_bundles(catalog):
    items = ct.keyed(ct.methods(catalog))
    assert {(r.key, r.domain, r.api) for r in items.collect()} == {
        ("data.ca_deal.get_thing", "deal", "data"),
        ("calls.tag.x", "tag", "calls"),
    }
    bundles = {r.bundle: r.title for r in ct.bundle_by_domain(items, brand="Acme").collect()}
    assert bundles == {"deal": "Acme Deal API", "tag_calls": "Acme Tag Calls API"}
    assert ct.bundle_by_domain(items, min_files=2).count() == 0


def column(spark, values, make, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_status_codes(spark):
    cases = {"200": True, "404": True, "500": True, "100": True, "599": True, "99": False,
             "600": False, "abc": False, "2a0": False, "": False}
    assert column(spark, cases, tx.is_http_status) == list(cases.values())


def test_strict_enums(spark):
    cases = {
        "lime,kiwi , plum": ["lime", "kiwi", "plum"],
        "  fig": ["fig"],
        ",,pear,": ["pear"],
        "": None,
        "E.164, kiwi": None,
        "10, 20": ["10", "20"],
    }
    assert column(spark, cases, tx.allowed_enum_strict) == list(cases.values())


def test_lax_enums(spark):
    cases = {"a, ,b": ["a", "", "b"], "single": None, "Формат a, b": None, "": None}
    assert column(spark, cases, tx.allowed_enum) == list(cases.values())


def test_formats(spark):
    cases = {"phone in E.164": True, "an International format": True, "lime, kiwi": False, "7": False,
             "": False}
    assert column(spark, cases, lambda c: tx.is_format(c, strict=True)) == list(cases.values())


def test_verbs(spark):
    cases = {"": "post", "get.test": "get", "create.x": "post", "update.x": "put",
             "delete.x": "delete", "getx": "post", "start.call": "post"}
    assert column(spark, cases, tx.http_verb) == list(cases.values())


def test_array_item_types(spark):
    cases = [
        (("ids", "", "Идентификатор группы"), "number"),
        (("x", "Номер телефона", "id"), "string"),
        (("contact_group", "", ""), "number"),
        (("member_email", "", ""), "string"),
        (("sort", "", ""), "string"),
        (("members", "", ""), "number"),
        (("other", "", ""), "string"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], "n string, a string, d string")
    got = df.select(tx.array_item_type(F.col("n"), F.col("a"), F.col("d"))).collect()
    assert [r[0] for r in got] == [e for _, e in cases]


def test_text(spark):
    assert column(spark, [" a\r\n\tb   c "], tx.clean_text) == ["a b c"]
    assert column(spark, ["call_api v2.html é.x", "ABC def"], tx.title_case) == [
        "Call_api V2.Html É.X",
        "ABC Def",
    ]
    assert column(spark, ["&amp;lt; &lt;&#65;&#x416;&nbsp;<b>x</b>"], lambda c: F.expr(ht.text_of("v"))) == [
        "&lt; <AЖ x"
    ]


def test_categories(spark):
    cases = {
        "/srv/docs/fruit.html": "Fruit.Html",
        "/srv/docs/citrus/lime/a.html": "Citrus",
        "/srv/docs/stone_fruit/plum.html": "Stone Fruit",
        "/srv/docs/x/y/z/deep.html": "X",
    }
    assert column(spark, cases, lambda c: tx.category(c, "/srv/docs")) == list(cases.values())


def test_depth(spark):
    cases = {"/": 0, "/srv": 1, "/srv/docs/fruit/lime": 4, "./fruit": 1, "./fruit/lime/peel": 3}
    assert column(spark, cases, pg.depth) == list(cases.values())


def test_skip_rules(spark):
    files = {"/docs/plum.html": False, "/docs/index.html": False, "/docs/js/plum.html": True,
             "/docs/deep/404.html": True, "/404.htm": False, "/notes.txt": False}
    assert column(spark, files, pg.skip_file) == list(files.values())
    options = pg.ScanOptions(exclude_dirs=("old",), include_dirs=("fruit",))
    dirs = {"/docs/fruit": False, "/docs/fruit/old": True, "/docs/nuts": True, "/fruit/.git": True,
            "/fruit/assets": True}
    assert column(spark, dirs, lambda c: pg.skip_directory(c, options)) == list(dirs.values())


FILES = {
    "fruit/lime.html": "<h1>Lime</h1>",
    "fruit/plum.HTML": "<h1>Plum</h1> with a long text",
    "fruit/index.html": "fruit",
    "index.html": "start",
    "nuts/hazel/page.html": "<p>hazel</p>",
    "js/lime.html": "never seen",
    "fruit/404.html": "gone",
    "nuts/list.txt": "plain",
}


@pytest.fixture()
def site(tmp_path):
    for name, body in FILES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    return tmp_path


def test_scan(spark, site):
    root = str(site)
    pages = pg.read_pages(spark, root)
    assert pages.count() == 7
    options = pg.ScanOptions(root=root)
    kept = {r.path.removeprefix(root + "/") for r in pg.scan_filter(pages, options).collect()}
    assert kept == {"fruit/lime.html", "fruit/plum.HTML", "fruit/index.html", "index.html", "nuts/hazel/page.html"}
    bare = pg.ScanOptions(root=root, skip_root_index=True)
    assert pg.scan_filter(pages, bare).count() == 4
    listing = spark.createDataFrame(
        [(f"{root}/{n}", b) for n, b in FILES.items()], "path string, html string"
    )
    got = pg.scan_summary(listing, options).first()
    # files below a skipped folder are not visited; the folder itself is met and counted
    assert (got.total_files, got.html_files, got.skipped_files, got.error_files) == (7, 5, 1, 0)
    assert got.total_dirs == 5
    stats = {r.category: r for r in pg.file_stats(pg.scan_filter(pages, options), root).collect()}
    assert stats["Fruit"].largest_file.endswith("plum.HTML") and stats["Fruit"].files == 3
    assert stats["Fruit"].smallest_file.endswith("index.html")


def test_listing_sees_every_file(spark, site):
    """The audit of a folder with files of all kinds equals a walk through it; no content is read."""
    import os

    for name in ("fruit/peel.css", "fruit/core.txt", "nuts/shell.HTM", "nuts/notes.pdf", "big.bin"):
        (site / name).write_bytes(b"x" * len(name))
    root = str(site)
    files = pg.list_files(spark, root)
    walked = {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names}
    assert {r.path: r.length for r in files.collect()} == walked
    text = files._sc._jvm.PythonSQLUtils.explainString(files._jdf.queryExecution(), "formatted")
    assert "content" not in text.split("ReadSchema")[1].split("\n")[0]
    plain = pg.ScanOptions(root=root, skip_assets=False)
    got = pg.scan_summary(files, plain).first()
    seen = [p for p in walked if not any(x.startswith(".") for x in p[len(root):].split("/"))]
    folders = {d for d, _, _ in os.walk(root) if d != root}
    assert got.total_files == len(seen) and got.error_files == 0
    assert got.html_files + got.skipped_files == sum(p.lower().endswith(".html") for p in seen)
    assert got.total_dirs in (len(folders), len(folders) + 1)
    stats = {r.category: r for r in pg.file_stats(files, root).collect()}
    assert stats["*"].files == len(walked) and stats["*"].largest_size == max(walked.values())


def test_patterns(spark):
    names = ["ab1.html", "ab2.html", "abc.html", "a.html", "AB9.HTML", "ab-.html", "a*b.html"]
    cases = {
        "ab?.html": ["ab1.html", "ab2.html", "abc.html", "AB9.HTML", "ab-.html"],
        "ab[0-9].html": ["ab1.html", "ab2.html", "AB9.HTML"],
        "ab[^0-9-].html": ["abc.html"],
        "a*.html": names,
        "a\\*b.html": ["a*b.html"],
        "a[&&b]*.html": ["ab1.html", "ab2.html", "abc.html", "AB9.HTML", "ab-.html"],
    }
    for pattern, want in cases.items():
        got = column(spark, names, lambda c, p=pattern: pg.is_html(c, pg.ScanOptions(patterns=(p,))))
        assert [n for n, ok in zip(names, got) if ok] == want, pattern
    with pytest.raises(ValueError):
        pg.is_html("path", pg.ScanOptions(patterns=("a[b.html",)))


def test_text_after_an_example(spark):
    cases = {'{"a": 1}': {"a": "1"}, '{"a": 1} x': {}, '{"a": 1}, {"b": 2}': {}, ' {"a": [1, 2]} ': {"a": "[1,2]"},
             "[1]": {}, "{": {}, '{"a": 1}}': {}, '{"a": 1}] {}': {}, '{"a": 1}, "w": {}': {}, '{"a": 1}]': {}, "": {}, "{}": {}}
    assert column(spark, cases, ct.json_object) == list(cases.values())


def test_validation(spark):
    rules = [("orchard", "string", True, None, None, None), ("weight", "number", False, None, None, 2.5),
             ("kinds", "array", False, None, None, None)]
    schema = ("rules array<struct<field string, type string, required boolean, enum array<string>,"
              " format string, minimum double>>, id int, payload string")
    payloads = ['{"orchard": "hillside", "weight": 41.25, "kinds": ["lime"]}', '{"weight": 7}', '{"orchard": [], "weight": 2}',
                '"lime"', '{"orchard"', '{"orchard": "dale", "weight": 2.5, "kinds": "plum"}', '{"orchard": null}']
    df = spark.createDataFrame([(rules, i, p) for i, p in enumerate(payloads)], schema)
    checked = ct.validate(df, "payload", "rules")
    got = {}
    for e in ct.validation_errors(checked, "id").collect():
        got.setdefault(e.id, set()).add((e.field, e.type))
    assert got[1] == {("orchard", "required")}
    assert got[2] == {("orchard", "invalid_type"), ("weight", "number_gte")}
    assert got[3] == got[4] == {("(root)", "invalid_type")}
    assert got[5] == {("kinds", "invalid_type")}
    assert {f for f, _ in got[6]} == {"orchard"}
    assert {r.id for r in checked.filter("valid").collect()} == {0}


def test_batch_report(spark):
    rows = [
        ("lime.html", True, None, "get.lime", 4, 2, 12.0),
        ("plum.html", True, None, "get.plum", 0, 1, 3.0),
        ("husk.html", False, "no method", None, 0, 0, 30.0),
        ("peel.html", True, None, "get.lime", 7, 0, 5.0),
        ("core.html", False, "no method", None, 0, 0, 10.0),
    ]
    results = spark.createDataFrame(
        rows, "path string, success boolean, error string, name string, params int, errors int, cost double"
    )
    r = ct.batch_report(results).first()
    assert (r.total, r.success_count, r.error_count, r.total_params, r.total_errors) == (5, 3, 2, 11, 3)
    assert r.average_cost == pytest.approx(12.0)
    e = ct.extremes(results, "path", "cost").first()
    assert (e.fastest, e.slowest) == ("plum.html", "husk.html")
    lists = {(x["list"], x.entry): x.n for x in ct.summary_lists(results).collect()}
    assert lists == {("method", "get.lime"): 2, ("method", "get.plum"): 1, ("error", "no method"): 2}
    empty = ct.batch_report(results.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, 0)


def test_sinks(spark, catalog, tmp_path):
    for fmt in ("json", "parquet"):
        out = str(tmp_path / fmt)
        sinks.write_catalog(catalog, out, fmt)
        back = sinks.read_catalog(spark, out, fmt)
        assert {(r.domain, r.file) for r in back.collect()} == {("deal", "get_thing"), ("tag", "start_thing")}
    sinks.write_catalog(catalog, str(tmp_path / "o"), "openapi")
    assert sinks.read_catalog(spark, str(tmp_path / "o")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_catalog(catalog, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        sinks.export_report(catalog, str(tmp_path / "x"), "xlsx")


def test_summary_lists_deals_pages_before_extraction(spark, tmp_path):
    """No filter on the extracted name moves below the exchange that deals the pages."""
    import __spark_entry__ as entry

    listed = entry.queries()["summary_lists"](spark, "/root/testdata/sf0.001")
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Repartition") :]
    assert "Filter" not in below


def test_summary_lists_drops_missing_entries(spark):
    results = spark.createDataFrame(
        [(True, "a", None), (True, None, None), (False, None, "bad"), (None, "b", None)],
        "success boolean, name string, error string",
    )
    assert sorted(map(tuple, ct.summary_lists(results).collect())) == [("error", "bad", 1), ("method", "a", 1)]


def test_written_documents_are_read_without_inference(spark, tmp_path):
    out = str(tmp_path / "openapi")
    rows = spark.createDataFrame([("f", "{}", "data", "deal")], "file string, document string, api string, domain string")
    rows.write.partitionBy("api", "domain").json(out)
    back = sinks.read_catalog(spark, out, schema=sinks.DOCUMENTS)
    assert [tuple(r) for r in back.select("file", "document", "api", "domain").collect()] == [("f", "{}", "data", "deal")]
