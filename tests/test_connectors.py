"""Resumable pages, database upserts, rates with state, one-pass lexicons, the partitioned vector index, and item downloads."""

import os
import random
import sqlite3
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomtext.functions import text as T
from loomtext.functions.terms import TermIndex
from loomtext.operators import classify, extract, lexicon_scan, models, relational, table_functions, vector, vector_index
from loomtext.plans import catalog
from loomtext.sources import database, web
from loomtext.streaming import pages, rates

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import test modules

# --- pages --------------------------------------------------------------------------------------------------------


class Numbers:
    """Rows (i, text) up to ``size``; pages are noted in a file, and fail from ``broken`` on."""

    def __init__(self, size, log, broken=None, short=False):
        self.size, self.log, self.broken, self.short = size, log, broken, short

    def total(self):
        return self.size

    def page(self, start, count):
        with open(self.log, "a") as f:
            f.write(f"{start} {count}\n")
        if self.broken is not None and start >= self.broken:
            raise OSError("down")
        return [(i, f"row {i}") for i in range(start, start + count - self.short)]


def asked(log):
    return [tuple(map(int, line.split())) for line in open(log)]


def run(spark, service, root, **more):
    options = {"count": 5, "pages_per_task": 2, "rows_per_batch": 30, "position": str(root / "position"), "pause": 0, "tries": 2, **more}
    pages.run_to_end(pages.page_stream(spark, service, "i long, t string", **options), str(root / "sink"), str(root / "checkpoint"))


def numbers(spark, root):
    return sorted(r["i"] for r in spark.read.parquet(str(root / "sink")).collect())


def test_a_broken_stream_goes_on_where_it_stopped(spark, tmp_path):
    log = tmp_path / "log"
    with pytest.raises(Exception, match="down"):
        run(spark, Numbers(103, log, broken=50), tmp_path)
    first = numbers(spark, tmp_path)
    assert first == list(range(30))  # the batch that broke is not there in part
    before = len(asked(log))
    run(spark, Numbers(103, log), tmp_path)
    assert numbers(spark, tmp_path) == list(range(103))
    assert min(start for start, _ in asked(log)[before:]) == 30  # nothing is fetched again that was kept
    run(spark, Numbers(103, log), tmp_path)
    assert numbers(spark, tmp_path) == list(range(103))
    run(spark, Numbers(110, log), tmp_path)  # the service has grown
    assert numbers(spark, tmp_path) == list(range(110))


def test_a_short_page_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="holds less than it said"):
        run(spark, Numbers(20, tmp_path / "log", short=True), tmp_path)


def test_pages_as_a_table_and_an_empty_service(spark, tmp_path):
    spark.dataSource.register(pages.PageSource.of(Numbers(23, tmp_path / "log"), "i long, t string", "numbers"))
    got = spark.read.format("numbers").option("count", 4).option("pages_per_task", 1).load()
    assert sorted(r["i"] for r in got.collect()) == list(range(23)) and got.rdd.getNumPartitions() == 6
    run(spark, Numbers(0, tmp_path / "none"), tmp_path)
    assert pages.Position(str(tmp_path / "position")).read() == 0


def test_bounded_batches_need_a_position(spark, tmp_path):
    with pytest.raises(Exception, match="position file"):
        run(spark, Numbers(5, tmp_path / "log"), tmp_path, position="")


def test_parquet_pages(spark, tmp_path):
    spark.range(57).select("id", F.lit(None).cast("string").alias("x")).repartition(3).write.parquet(str(tmp_path / "t"))
    service = pages.ParquetPages(str(tmp_path / "t"), ["id"])
    parts = [service.page(a, 10) for a in range(0, 60, 10)]
    assert service.total() == 57 and [len(p) for p in parts] == [10] * 5 + [7]
    assert sorted(r[0] for p in parts for r in p) == list(range(57))


def test_a_page_of_a_large_row_group_is_read_in_pieces(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    os.makedirs(tmp_path / "t")
    for k in range(2):
        parquet.write_table(pa.table({"x": ["a"] * 30_000, "i": range(30_000 * k, 30_000 * (k + 1))}), tmp_path / "t" / f"{k}.parquet", row_group_size=20_000)
    service = pages.ParquetPages(str(tmp_path / "t"), ["i", "x"])
    for start, count in ((0, 1), (0, 60_000), (19_999, 2), (8_190, 25_000), (29_999, 20_002), (59_999, 5), (60_000, 3)):
        got = list(service.batches(start, count))
        assert [i for b in got for i in b.column("i").to_pylist()] == list(range(60_000))[start : start + count]
        assert all(b.num_rows <= 8192 for b in got)
    spark.dataSource.register(pages.PageSource.of(service, "i long, x string", "large"))
    read = spark.read.format("large").option("count", 7_000).option("pages_per_task", 3).load()
    assert read.agg(F.sum("i"), F.count("x")).first() == (sum(range(60_000)), 60_000)


# --- upserts ------------------------------------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store.db")

    def connect():
        return sqlite3.connect(path, timeout=60)

    return database.register(spark, connect), connect


def put(spark, store, rows, write_id=None, version="v", schema="k long, x string, v long"):
    database.upsert(spark.createDataFrame(rows, schema).repartition(3), store[0], "t", key=["k"], version=version, write_id=write_id)


def held(store):
    return sorted(store[1]().execute("SELECT k, x, v FROM t").fetchall())


def test_latest_version_of_each_key_stays(spark, store):
    put(spark, store, [(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", None), (2, "e", 0), (3, "f", 5), (3, "g", 5)])
    assert held(store) == [(1, "b", 3), (2, "e", 0), (3, "g", 5)]
    put(spark, store, [(1, "old", 2), (2, "same", 0), (4, None, None)])
    assert held(store) == [(1, "b", 3), (2, "same", 0), (3, "g", 5), (4, None, None)]
    put(spark, store, [])
    assert len(held(store)) == 4


def test_repeated_and_failed_writes_give_the_state_of_one(spark, store):
    put(spark, store, [(i, "one", 1) for i in range(50)], "w1")
    before = held(store)
    put(spark, store, [(i, "two", 2) for i in range(50)], "w1")  # the id is known
    assert held(store) == before
    with pytest.raises(Exception, match="null in key"):
        put(spark, store, [(i, "three", 3) for i in range(49)] + [(None, "bad", 3)], "w2")
    assert held(store) == before
    count = lambda name: store[1]().execute(f"SELECT count(*) FROM {name}").fetchone()[0]
    assert count("t_staged") == count("t_attempts") == 0
    put(spark, store, [(i, "three", 3) for i in range(50)], "w2")  # a failed id is free
    assert {x for _, x, _ in held(store)} == {"three"} and count("t_writes") == 2


def test_rows_of_attempts_that_are_not_reported_do_not_count(spark, store):
    put(spark, store, [(1, "a", 1)])
    with store[1]() as c:
        c.execute("INSERT INTO t_staged VALUES (9, 'ghost', 9, 0, 'w9', 'lost')")
    put(spark, store, [(2, "b", 1)], "w9")
    assert held(store) == [(1, "a", 1), (2, "b", 1)]


def test_a_write_orders_no_rows_of_single_keys_and_keeps_no_copy_of_staged_ones(spark, store):
    target = database.Target("t", spark.createDataFrame([], "k long, x string, v long").schema, ["k"], "v")
    with store[1]() as c:
        target.prepare(c)
        plans = [" ".join(r[3] for r in c.execute("EXPLAIN QUERY PLAN " + one, ("w",) * 4)) for one in target.merge()]
    assert "ORDER BY" not in plans[0] and "ORDER BY" in plans[1]
    writer = database._Upserts(store[1], target, "w")
    rows = [(i, "x" * 1000, 1) for i in range(3_000)]
    message = writer.write(iter(rows))
    sizes, plain = [], writer._forget

    def forget(connection):
        plain(connection)
        sizes.append(os.path.getsize(connection.execute("PRAGMA database_list").fetchone()[2] + "-journal"))

    writer._forget = forget
    writer.commit([message])
    assert sizes[0] < 500_000 and len(held(store)) == 3_000
    assert writer.write(iter(rows)).rows == 0  # sent again, nothing is staged
    with store[1]() as c:
        c.execute("INSERT INTO t_staged VALUES (9, 'other', 9, 0, 'w3', 'a')")
    put(spark, store, [(7, "new", 2), (7, "newer", 3)], "w2")
    assert store[1]().execute("SELECT x FROM t_staged").fetchall() == [("other",)] and (7, "newer", 3) in held(store)


def test_a_load_in_parts_holds_every_record_once(spark, store):
    df = spark.range(500).select(F.concat(F.lit("v"), F.col("id") % 400).alias("vector_id"), F.lit("p").alias("preview"))
    for _ in range(2):
        database.upsert_records({"vectors": df}, store[0], write_id="load", parts=3)
    count = lambda sql: store[1]().execute(sql).fetchone()[0]
    assert count("SELECT count(*) FROM vectors") == 400 and count("SELECT count(*) FROM vectors_writes") == 3 and count("SELECT count(*) FROM vectors_staged") == 0


def test_kinds_and_reading_back(spark, store):
    rows = [(1, True, 0.5, [1, 2], bytearray(b"\x00x"), 'q"'), (2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "k long, flag boolean, d double, list array<int>, raw binary, s string")
    database.upsert(df, store[0], 'odd"name', key=["k"])
    got = database.stored(spark, store[0], 'odd"name', "k long, flag boolean, d double, list string, raw binary, s string", tasks=5)
    assert sorted(map(tuple, got.collect())) == [(1, True, 0.5, "[1, 2]", bytearray(b"\x00x"), 'q"'), (2, None, None, None, None, None)]
    with pytest.raises(Exception, match="has columns"):
        database.upsert(df.drop("s"), store[0], 'odd"name', key=["k"])
    with pytest.raises(Exception, match="must be columns"):
        database.upsert(df, store[0], "t2", key=["nope"])
    with pytest.raises(Exception, match="append"):
        df.write.format(store[0]).mode("overwrite").option("table", "t3").option("key", "k").save()


# --- rates --------------------------------------------------------------------------------------------------------


def test_stream_counts_as_the_window_does(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "a", "b", "c"]), rng.randrange(400)) for i in range(300)] + [(500, "late", 399), (501, None, None)]
    schema = "event_id long, user_id string, s long"
    table = spark.createDataFrame(rows, schema).select("event_id", "user_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"))
    for n in range(4):  # out of order by up to 100 seconds
        table.where((F.unix_seconds("ts") - 1_700_000_000 >= n * 100) & (F.unix_seconds("ts") - 1_700_000_000 < n * 100 + 100)).write.mode("append").parquet(str(tmp_path / "in"))
    table.where("ts is null").write.mode("append").parquet(str(tmp_path / "in"))
    table.limit(1).select(F.lit(999).cast("long").alias("event_id"), F.lit("end").alias("user_id"), F.timestamp_seconds(F.lit(1_700_100_000)).alias("ts")).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    rates.use_rocks(spark)
    counted = rates.stream_window_counts(stream, by="user_id", time="ts", event="event_id", seconds=30, late="1 hour")
    try:
        counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(rates.PROVIDER)
    want = relational.sliding_counts(table.where("ts is not null"), by="user_id", time="ts", seconds=30).select("event_id", "user_id", "in_window")
    got = spark.read.schema(counted.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_null_beside_whole_numbers_changes_no_key_and_no_event(spark, tmp_path):
    big = 2**53 + 1  # floats do not tell it from 2**53
    rows = [(big + i, None if i % 10 == 7 else big + i % 3, i) for i in range(60)] + [(None, big, 5), (None, None, 100_000)]
    table = spark.createDataFrame(rows, "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"))
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    rates.use_rocks(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # all keys in one Arrow batch
    counted = rates.stream_window_counts(stream, by="user_id", time="ts", event="event_id", seconds=30, late="1 hour")
    try:
        counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(rates.PROVIDER)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    want = relational.sliding_counts(table.where("event_id is not null or user_id is not null"), by="user_id", time="ts", seconds=30)
    got = spark.read.schema(counted.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("event_id", "user_id", "in_window").collect()))


def test_calls_of_the_state_do_not_grow_with_keys(spark, tmp_path):
    """One entry of state for each bucket and batch, and counts as the window gives them, for many users in few buckets."""
    rng = random.Random(5)
    rows = [(f"e{i}" if i % 40 else None, rng.randrange(50) if i % 30 else None, rng.randrange(300)) for i in range(2_000)]
    table = spark.createDataFrame(rows, "event_id string, user_id int, s long").select("event_id", "user_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"))
    for n in range(3):
        table.where(F.floor((F.unix_seconds("ts") - 1_700_000_000) / 100) == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table.limit(1).select(F.lit("end").alias("event_id"), F.lit(-1).alias("user_id"), F.timestamp_seconds(F.lit(1_700_100_000)).alias("ts")).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rates.use_rocks(spark)
    counted = rates.stream_window_counts(stream, by="user_id", time="ts", event="event_id", seconds=20, late="100 seconds", buckets=3)
    try:
        query = counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.unset(rates.PROVIDER)
    want = relational.sliding_counts(table, by="user_id", time="ts", seconds=20).select("event_id", "user_id", "in_window")
    got = spark.read.schema(counted.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3 * 20


def test_rate_stream_loses_nothing_of_a_table_out_of_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.randrange(12), rng.randrange(40 * 86_400)) for i in range(1500)]
    table = spark.createDataFrame(rows, "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"))
    table.repartition(12).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    want = relational.sliding_counts(table, by="user_id", time="ts", seconds=86_400).where("in_window > 2").select("event_id", "in_window")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # many files of the sorted table
    try:
        got = catalog.QUERIES["rate_stream"](spark, str(tmp_path / "sf"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


# --- lexicons -----------------------------------------------------------------------------------------------------


def test_one_pass_finds_what_contains_finds(spark):
    rng = random.Random(4)
    lexicon = [("x", ("a", "ab", "ba", "abab")), ("y", ("b c", "c", "c")), ("z", ("é", "zz"))]
    texts = ["".join(rng.choice("abcé z") for _ in range(rng.randrange(25))) for _ in range(300)] + [None, "", "ababab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    index = TermIndex(lexicon, ("q",))
    hits = df.withColumn("h", index.scan(F.col("t"), {"all": (0, None), "first": (0, 6), "rest": (6, None)}))
    for part, col in (("all", F.col("t")), ("first", F.substring("t", 1, 6)), ("rest", F.substring("t", 7, 99))):
        h = F.col("h")[part]
        pairs = [
            (index.any_of(h, ("a", "zz")), T.contains_any(col, ("a", "zz"))), (index.count_of(h, ("c", "c", "a")), T.count_terms(col, ("c", "c", "a"))),
            (index.first_label(h, lexicon, "none"), T.first_label(col, lexicon, "none")), (index.labels_found(h, lexicon), T.labels_found(col, lexicon)),
            (index.best_label(h, lexicon, None), T.best_label(col, lexicon, None)), (index.found(h, ("c", "ab", "a"), 2), T.terms_found(col, ("c", "ab", "a"), 2)),
        ]
        for one, other in pairs:
            same = hits.where("t is not null").select(F.count_if(~one.eqNullSafe(other)).alias("n")).first()["n"]
            assert same == 0
    assert hits.where("t is null").select(index.first_label(F.col("h")["all"], lexicon, "none").alias("l")).first()["l"] == "none"
    with pytest.raises(ValueError, match="empty term"):
        TermIndex(("",))


def test_scanned_labels_are_those_of_the_classifiers(spark):
    rows = [("Housing Act", "The landlord and VAT. S.I. 1990 No. 5 " + "x" * 2000 + " negligence contract"), (None, "tax"), ("Smith v Jones", None), ("", ""), ("İ Act 1988", "corporation tax " * 300)]
    df = spark.createDataFrame(rows, "title string, content string")
    t, c = F.col("title"), F.col("content")
    got = lexicon_scan.classified(df, ["legal_area", "source_type", "jurisdiction", "tax_domain", "tax_concepts", "subject_tags"])
    want = df.select(
        "title", "content", classify.legal_area(t, c).alias("legal_area"), classify.source_type(t, c).alias("source_type"), classify.jurisdiction(t, c).alias("jurisdiction"),
        classify.tax_domain(t, c).alias("tax_domain"), classify.tax_concepts(t, c).alias("tax_concepts"), classify.subject_tags(t, c).alias("subject_tags"),
    )
    both = lambda df: sorted(str(r) for r in df.where("title is not null and content is not null").collect())
    assert both(got) == both(want) and got.count() == len(rows)


# --- vectors ------------------------------------------------------------------------------------------------------


def test_partitioned_index(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(i % 7, 1.0) for _ in range(6)], "clash") for i in range(500)] + [(900, [0.0] * 6, "c"), (901, None, "c"), (902, [float(x) for x in range(6)], "c"), (903, [float(x) for x in range(6)], "c")]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    index = vector_index.CellIndex.create(items.where("vec_id < 400"), str(tmp_path / "i"), cells=8)
    index.add(items.where("vec_id >= 400"), "more")
    index.add(items.where("vec_id >= 400"), "more")  # replaces itself
    assert index.vectors().count() == 502
    queries = items.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    rows_of = lambda df: sorted((r["query_id"], r["vec_id"], round(r["score"], 9)) for r in df.collect())
    exact = vector.search(items, queries, 5)
    assert rows_of(index.search(queries, 5, probes=8)) == rows_of(exact)
    some = index.search(queries, 5, probes=2)
    assert rows_of(some) == rows_of(index.search(queries, 5, probes=2, broadcast_queries=0))
    r = vector_index.recall(index.search(queries, 5, probes=5), exact).first()
    assert r["n_queries"] == 25 and r["n_found"] >= 0.9 * r["n_exact"]
    reopened = vector_index.CellIndex(spark, str(tmp_path / "i"))
    assert rows_of(reopened.search(queries, 5, probes=2)) == rows_of(some)
    assert reopened.search(queries.limit(0), 5, probes=2).count() == 0


def test_probes_follow_the_measured_recall(spark, tmp_path):
    rng = random.Random(8)
    items = spark.createDataFrame([(i, [rng.gauss(0.0, 1.0) for _ in range(64)]) for i in range(500)], "vec_id long, embedding array<double>")
    items.write.parquet(str(tmp_path / "sf" / "embeddings.parquet"))  # no direction stands out: half of the cells are not enough
    got = catalog.QUERIES["vector_index_recall"](spark, str(tmp_path / "sf")).first()
    assert got["n_queries"] == 25 and got["n_exact"] == 250 and got["nine_tenths"]
    index = vector_index.CellIndex.create(items, str(tmp_path / "i"), cells=8)
    queries = items.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vector.search(items, queries, 5)
    share = lambda probes: vector_index.recall(index.search(queries, 5, probes=probes), exact).first()["n_found"] / 125
    for least in (0.3, 0.7, 1.0):
        n = index.probes_for(queries, exact, least)
        assert share(n) >= least and (n == 1 or share(n - 1) < least)
    assert index.probes_for(queries.limit(0), exact.limit(0), 0.9) == 1


def test_a_search_lists_the_probed_folders_only(spark, tmp_path):
    items = spark.createDataFrame([(i, [float(i % 4 == j) + 0.01 * (i % 3) for j in range(4)]) for i in range(80)], "vec_id long, embedding array<double>")
    index = vector_index.CellIndex.create(items, str(tmp_path / "i"), cells=4)
    found = index.search(items.where("vec_id = 5").select(F.col("vec_id").alias("query_id"), "embedding"), 3, probes=1)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["vec_id"] % 4 for r in found.collect()} == {1}
    none = vector_index.CellIndex.create(items.limit(0), str(tmp_path / "none"), cells=4)
    assert none.search(items.select(F.col("vec_id").alias("query_id"), "embedding"), 3, probes=1).count() == 0


# --- downloads ----------------------------------------------------------------------------------------------------


def test_each_address_is_fetched_once_and_again_only_after_errors(spark, tmp_path):
    log = str(tmp_path / "log")

    def fetch(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        if url.endswith("/2") and open(log).read().count(url + "\n") < 2:
            raise OSError("try again")
        return (404, "") if "/3" in url else (200, f"<p>{url}</p>")

    items = spark.createDataFrame([(i, f"http://a/{i}") for i in range(4)] + [(9, None)], "id long, url string")
    got = web.download_items(items, fetch, pause=0, calls=50, per_seconds=1)
    for _ in range(2):
        assert sorted({(r["id"], r["format"]) for r in got.collect()}) == sorted((i, f) for i in range(3) for f in ("html", "metadata", "text", "xml"))
    calls = open(log).read().split()
    assert sorted(calls) == sorted([f"http://a/{i}{tail}" for i in range(4) for tail in ("", "/data.xml")] + ["http://a/2"])
    began = time.monotonic()
    web.download_items(items.limit(4).coalesce(1), fetch, formats=(("html", ""),), gap=0.1, calls=50, per_seconds=1)
    assert time.monotonic() - began > 0.3


def test_a_search_that_keeps_failing_is_an_error(spark):
    def fetch(start, count):
        if start >= 3:
            raise OSError("gone")
        return [("t", "l", "d", "f")] * count

    spark.dataSource.register(web.SearchPages.with_fetch(fetch))
    df = spark.read.format("search_pages").option("pages", 4).option("count", 3).option("pause", 0).load()
    with pytest.raises(Exception, match="gone"):
        df.count()


# --- models and table functions -----------------------------------------------------------------------------------


def test_only_failed_rows_are_sent_again(spark, tmp_path):
    log = str(tmp_path / "log")

    def load():
        def model(texts, attempt):
            with open(log, "a") as f:
                f.writelines(f"{attempt} {t}\n" for t in texts)
            if "boom" in texts and attempt == 0:
                raise RuntimeError("a whole call fails")
            return [None if t == "never" or (t == "later" and attempt < 2) else len(t) for t in texts]

        return model

    def broken():
        raise ImportError("no")

    texts = ["one", "later", "never", None, "boom", "one"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, t string, n string").coalesce(1)
    got = models.apply_model(df, "t", "n", "int", family=log, loaders=(broken, load), default=F.lit(-1), batch=1)
    assert sorted((r["id"], r["n"], r["n_attempts"], r["n_model"]) for r in got.collect()) == [(0, 3, 1, 1), (1, 5, 3, 1), (2, -1, 3, None), (3, 0, 1, 1), (4, 4, 2, 1), (5, 3, 1, 1)]
    assert got.count() == 6 and sorted(open(log).read().split("\n")[:-1]) == sorted(["0 one", "0 later", "0 never", "0 ", "0 boom", "0 one", "1 later", "1 never", "1 boom", "2 later", "2 never"])
    assert models.apply_model(df.limit(0), "t", "n", "int", family=log, loaders=(load,)).count() == 0
    with pytest.raises(Exception, match="loads"):
        models.apply_model(df, "t", "n", "int", family=log + "x", loaders=(broken,))


def test_table_functions(spark):
    table_functions.register(spark)
    sections = "Section 1: " + "a" * 120 + "\nSection 2: short\nSection 3: " + "b" * 120
    paragraphs = "\n\n".join(["c" * 150, "short", "d" * 101] + ["e" * 200] * 30)
    df = spark.createDataFrame([(1, sections), (2, paragraphs), (3, None), (4, ""), (5, "x" * 25)], "id int, t string")
    rows = spark.sql("SELECT id, s.* FROM {df} d, LATERAL section_rows(d.t) s", df=df).collect()
    assert [(r["number"], r["section"][:10]) for r in rows if r["id"] == 1] == [(1, "Section 1:"), (3, "Section 3:")]
    assert [r["number"] for r in rows if r["id"] == 2] == [1, *range(3, 22)] and {r["id"] for r in rows} == {1, 2}
    assert {(r["id"], r["section"]) for r in rows} == {(r["id"], r["s"]["text"]) for r in df.select("id", F.explode(extract.qa_sections(F.col("t"))).alias("s")).collect()}
    chunks = spark.sql("SELECT id, c.* FROM {df} d, LATERAL overlapping_chunks(d.t, 10, 3) c WHERE id >= 3", df=df).collect()
    assert [(r["id"], r["number"], len(r["chunk"])) for r in chunks] == [(4, 0, 0), (5, 0, 10), (5, 1, 10), (5, 2, 10), (5, 3, 4)]
    spark.createDataFrame([("a", 5, 1), ("a", 3, None), ("b", 9, 4)], "k string, id long, n long").createOrReplaceTempView("groups_")
    got = spark.sql("SELECT * FROM first_of_group(TABLE(groups_) PARTITION BY k ORDER BY id)").collect()
    assert sorted(map(tuple, got)) == [("a", 3, 2, 1), ("b", 9, 1, 4)]
