"""Sources, sinks, the catalogue, pipelines and streams: round trips in temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from loomtext.plans.tables_catalogue import Catalogue, Conflict
from loomtext.plans.steps import Pipeline
from loomtext.sources import files, sinks, web
from loomtext.streaming import events


@pytest.fixture()
def corpus(tmp_path):
    for kind in ("text", "metadata", "xml"):
        (tmp_path / kind).mkdir()
    (tmp_path / "text/a.txt").write_text("alpha " * 20)
    (tmp_path / "text/b.txt").write_text("short")
    (tmp_path / "metadata/a.json").write_text(json.dumps({"title": "A", "type": "statute"}))
    (tmp_path / "metadata/b.json").write_text("{broken")
    (tmp_path / "xml/a.xml").write_text("<r>not used because the text is kept, although it is long enough to be</r>")
    (tmp_path / "xml/b.xml").write_text("<r>one <b>two</b> three " + "more words " * 10 + "</r>")
    return str(tmp_path)


def test_raw_corpus_prefers_text(spark, corpus):
    rows = {r["id"]: r for r in files.raw_corpus(spark, corpus).collect()}
    assert rows["a"]["source"] == "text" and rows["a"]["title"] == "A" and rows["a"]["type"] == "statute"
    assert rows["b"]["source"] == "xml" and rows["b"]["text"].startswith("one two three") and rows["b"]["type"] == "unknown"


def test_paired_needs_both(spark, corpus):
    got = files.paired(spark, corpus).collect()
    assert [r["doc_id"] for r in got] == ["a"]


def test_inventory(spark, corpus):
    got = {r["extension"]: r["files"] for r in files.file_inventory(spark, corpus).collect()}
    assert got == {"txt": 2, "json": 2, "xml": 2}


def test_content_record(spark):
    rec = json.dumps({"details": {"body": "one", "parts": [{"body": "two"}, {"body": "three"}]}})
    assert spark.range(1).select(files.content_record(F.lit(rec)).alias("x")).first()["x"] == "one\n\ntwo\n\nthree"


def test_html(spark):
    html = "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav>menu</nav><article><h1>Head</h1><p>Body &amp; more</p></article><footer>f</footer></body></html>"
    df = spark.createDataFrame([(1, "https://e.com/guidance/x", html), (2, "https://e.com/y", None)], "page_id int, url string, html string")
    got = web.pages(df).orderBy("page_id").collect()
    assert (got[0]["title"], got[0]["content"], got[0]["content_type"], got[0]["host"]) == ("Head", "Head\nBody & more", "guidance", "e.com")
    assert got[1]["content"] == ""


def test_listing_and_feed(spark):
    df = spark.createDataFrame([("ukpga", 1990, '<a href="/ukpga/1990/5/contents">x</a><a href="/ukpga/1990/5">x</a><a href="/uksi/1990/7">x</a>')], ["type", "year", "html"])
    assert [r["id"] for r in web.listing_items(df).collect()] == ["ukpga_1990_5"]
    feed = spark.createDataFrame([('<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="alternate" href="http://a/1"/><link rel="self" href="http://a/2"/></entry></feed>',)], ["xml"])
    assert [r["url"] for r in web.feed_links(feed).collect()] == ["http://a/1"]


def test_search_source(spark):
    def fetch(start, count):
        return [(f"t{start + i}", f"/l{start + i}", "d", "guide") for i in range(count)] if start < 6 else []

    spark.dataSource.register(web.SearchPages.with_fetch(fetch))
    df = spark.read.format("search_pages").option("pages", 10).option("count", 3).load()
    assert df.count() == 6


def test_capped_per_court(spark):
    df = spark.createDataFrame([("t", f"u{i}", i) for i in range(5)] + [("h", f"v{i}", i) for i in range(5)] + [("h", "u0", 0)], ["court", "url", "seq"])
    assert web.capped_per_court(df, 4, first_court="t").count() == 5


def test_two_writers_of_a_table(spark, tmp_path):
    """Of two changes of one version one gets through; a change that fails leaves the table as it was."""
    one, two = Catalogue(spark, str(tmp_path / "cat")), Catalogue(spark, str(tmp_path / "cat"))
    one.save("t", spark.range(3).toDF("x"))

    def interrupted(df):
        two.append("t", spark.range(5, 7).toDF("x"))
        return df.where("x > 0")

    with pytest.raises(Conflict):
        one._change("t", interrupted)
    assert sorted(r["x"] for r in one.load("t").collect()) == [0, 1, 2, 5, 6]
    with pytest.raises(Exception, match="(?i)zero"):
        one.update_column("t", "x", "assert_true(x < 0, 'zero')")
    two.update_metadata("t", {"a": 1})
    two.save("t", spark.range(1).toDF("x"), {"b": 2})
    assert one.load("t").count() == 1 and one.metadata("t") == {"b": 2} and one.names() == ["t"]


def test_catalogue(spark, tmp_path):
    cat = Catalogue(spark, str(tmp_path / "cat"))
    cat.save("d", spark.createDataFrame([(1, "a")], ["id", "x"]), {"k": 1})
    cat.append("d", spark.createDataFrame([(2, 0.5)], ["id", "y"]))
    assert set(cat.load("d").columns) == {"id", "x", "y"} and cat.info("d")["rows"] == 2
    cat.update_column("d", "id", "id * 10")
    cat.add_column("d", "z", ["p", "q"], order="id")
    assert [(r["id"], r["z"]) for r in cat.load("d").orderBy("id").collect()] == [(10, "p"), (20, "q")]
    cat.update_metadata("d", {"m": 2})
    assert cat.metadata("d") == {"k": 1, "m": 2}
    cat.drop_column("d", "z")
    with pytest.raises(KeyError):
        cat.drop_column("d", "z")
    assert not cat.delete("d") and cat.delete("d", confirm=True) and cat.names() == []


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_export_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / f"x.{fmt}")
    sinks.export(spark.createDataFrame([(1, "a"), (2, "b")], ["id", "v"]), path, fmt)
    assert files.read_table(spark, path).count() == 2
    with pytest.raises(ValueError):
        sinks.export(spark.range(1), path, "xlsx")


def test_records_and_upsert(spark):
    cases = spark.createDataFrame([("c1", "T", "text", "UKSC", ["act1", "act1"])], "id string, title string, content string, court string, legislation array<string>")
    tables = sinks.case_records(cases)
    assert tables["edges"].count() == 2 and tables["vectors"].first()["vector_id"] == "c1_chunk_0"
    old = spark.createDataFrame([("a", 1, "old"), ("b", 1, "kept")], ["k", "v", "x"])
    new = spark.createDataFrame([("a", 2, "new")], ["k", "v", "x"])
    assert {r["x"] for r in sinks.upsert(old, new, "k", "v").collect()} == {"new", "kept"}


def test_pipeline_resumes(spark, tmp_path):
    ran = []

    def step(name):
        def fn(s, done):
            ran.append(name)
            return s.range(3)

        return fn

    def broken(s, done):
        raise ValueError("no")

    p = Pipeline("p", [("one", step("one")), ("opt", broken), ("two", step("two"))], optional={"opt"})
    p.run(spark, str(tmp_path))
    p.run(spark, str(tmp_path), skip={"two"})
    assert ran == ["one", "two"] and p.report == {"one": "resumed", "opt": "failed: ValueError", "two": "skipped"}


def test_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(200).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("user_id"), F.lit("v").alias("event_type"), F.lit(1.0).alias("value"))
    rows.write.parquet(src)
    stream = events.deduplicated(files.file_stream(spark, src, rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), "parquet"))
    events.start(stream, out, str(tmp_path / "ck")).awaitTermination(60)
    rows.limit(10).write.mode("append").parquet(src)  # the same events again, in new files
    assert spark.read.parquet(out).count() == 200
    batch = {tuple(r) for r in events.windowed(rows).collect()}
    collected = {}
    streamed = events.windowed(files.file_stream(spark, src, "event_id long, ts timestamp, user_id long, event_type string, value double", "parquet").dropDuplicates(["event_id"]))
    q = streamed.writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).start()
    q.awaitTermination(60)
    collected = {tuple(r) for r in spark.table("win").collect()}
    assert collected == batch


def test_progress(spark):
    u = lambda *x: spark.createDataFrame([(v,) for v in x], "url string")
    states = events.progress(u("a", "b", "c"), u("b"), u("c"))
    assert {r["url"]: r["state"] for r in states.collect()} == {"a": "discovered", "b": "downloaded", "c": "failed"}
    assert [r["url"] for r in events.remaining(states, u("b")).collect()] == ["a", "b", "c"]


def test_search_items_and_seeds(spark):
    html = '<a href="/ukpga/1985/68/contents">Housing Act</a><a href="/ukpga/1985/68/contents">again</a><a href="/help/x">no</a><a href="/uk">short</a>'
    got = web.search_items(spark.createDataFrame([(1, html)], "page int, html string"), base="https://x.org/").collect()
    assert [(r["id"], r["type"], r["url"]) for r in got] == [("search_ukpga_1985", "ukpga", "https://x.org/ukpga/1985/68/contents")]
    seeds = web.seed_items(spark, "https://x.org")
    assert seeds.groupBy("type").count().collect() and {r["type"]: r["count"] for r in seeds.groupBy("type").count().collect()} == {"ukpga": 23, "uksi": 7}
    assert seeds.where("id = 'ukpga_1988_50'").first()["url"] == "https://x.org/ukpga/1988/50"
    assert web.court_searches(spark, ["a", "b"]).count() == 34
    links = spark.createDataFrame([("/ew/cases/EWCOP/", "/ew/cases/EWCOP/2001/"), ("/ew/cases/EWCOP/2001/", "/ew/cases/EWCOP/2001/1.html"), ("/ew/cases/EWCOP/2001/1.html", "/ew/cases/EWCOP/2001/2.html")], "src string, dst string")
    assert [r["url"] for r in web.crawl_databases(links).collect()] == ["/ew/cases/EWCOP/2001/1.html"]
    none = spark.createDataFrame([], "url string")
    some = spark.createDataFrame([("s",)], "url string")
    assert web.api_or_search(none, some).count() == 1
    assert [r["url"] for r in web.api_or_search(some, spark.createDataFrame([("t",)], "url string")).collect()] == ["s"]


def test_item_downloads(spark):
    pages = {"u1/data.xml": "<x/>", "u1": "<p>One  two</p><script>no</script>", "u2": "<p>Three</p>"}
    items = spark.createDataFrame([("1", "u1"), ("2", "u2"), ("3", "u3"), ("4", None)], "id string, url string")
    got = {(r["id"], r["format"]): r["content"] for r in web.download_items(items, lambda u: (200, pages[u]) if u in pages else (404, "")).collect()}
    assert set(got) == {("1", "xml"), ("1", "html"), ("1", "text"), ("1", "metadata"), ("2", "html"), ("2", "text"), ("2", "metadata")}
    assert got[("1", "text")] == "One\ntwo" and json.loads(got[("1", "metadata")])["formats"] == ["html", "text", "xml"]
