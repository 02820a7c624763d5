"""Windows, joins and sets against brute force on small rows."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from pagegrain.operators import frontier as B
from pagegrain.operators import joins as J
from pagegrain.operators import options as O
from pagegrain.operators import windows as H
from pagegrain.streaming import stream as L


def test_first_n_in_buckets_equals_plain_rank(spark):
    random.seed(1)
    rows = [(random.choice("abb"), random.randint(0, 400), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    n = F.when(F.col("k") == "a", 7).otherwise(150)
    plain = H.first_n(df, ["k"], ["t", "id"], n)
    cut = H.first_n(df, ["k"], ["t", "id"], n, bucket=F.floor(F.col("t") / 25))
    assert sorted(plain.collect()) == sorted(cut.collect())
    assert plain.count() == 157


def test_last_positive_in_buckets_equals_plain_window(spark):
    random.seed(2)
    rows = [(random.choice("ab"), i, random.choice(["0.0", "", "3.5", "x", str(i)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, id int, price string")
    plain = H.last_positive(df, ["k"], ["id"], "price")
    cut = H.last_positive(df, ["k"], ["id"], "price", bucket=F.floor(F.col("id") / 7))
    assert sorted(plain.collect()) == sorted(cut.select(*plain.columns).collect())


def test_resolve_prices(spark):
    rows = [(0, "0.0", "120.0"), (1, "", "0.0"), (2, "5", ""), (3, "0.0", "0.0")]
    got = H.resolve_prices(spark.createDataFrame(rows, "pos int, sale string, standard string").withColumn("p", F.lit(1)), ["p"], ["pos"])
    assert [(r.sale, r.standard) for r in got.orderBy("pos").collect()] == [("120.0", "120.0"), ("120.0", "120.0"), ("5", "5"), ("120.0", "120.0")]


def test_first_seen_does_not_depend_on_order(spark):
    rows = [("us", "a", i, f"u{i}") for i in range(20)] + [("gb", "a", 5, "g")]
    df = spark.createDataFrame(rows, "c string, s string, t int, url string")
    for n in (1, 6):
        got = H.first_seen(df.repartition(n), ["c", "s"], ["t"]).collect()
        assert sorted((r.c, r.url) for r in got) == [("gb", "g"), ("us", "u0")]


def test_first_label_of_a_size_wins(spark):
    labels = F.array(F.lit("12 Size 8"), F.lit("10 Size 8"), F.lit("junk"))
    sizes = F.array(*[F.struct(F.lit(x).alias("size_identifier"), F.lit(x).alias("size_name")) for x in ("8", "M")])
    assert [s.size_name for s in spark.range(1).select(O.uk_names(sizes, labels).alias("s")).first()["s"]] == ["UK 12", "M"]


def test_joins_carry_no_broadcast_hint(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = J.with_dims(df, df.withColumnRenamed("k", "k"), "k")._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in plan and "broadcast" not in plan


def test_allowed_domains_need_a_whole_label(spark):
    urls = spark.createDataFrame([("http://example.com/",), ("http://a.example.com/",), ("http://badexample.com/",), ("x",)], "url string")
    good = sorted(r.url for r in B.allowed_only(urls, ["example.com"]).collect())
    assert good == ["http://a.example.com/", "http://example.com/"]
    table = spark.createDataFrame([("example.com",)], "domain string")
    assert sorted(r.url for r in B.allowed_by_table(urls, table).collect()) == good


def test_page_lists(spark):
    def value(c):
        return spark.range(1).select(c.alias("v")).first()["v"]

    pagers = spark.createDataFrame([(1, "u1", 3), (2, "u2", None), (3, "u3", 0), (4, "u4", 2500), (5, "u5", 300_000_000)], "page_id int, url string, last int")
    few = B.page_rows(pagers, F.col("last"), 5000)
    assert sorted((r.page_id, r.n, r.lo, r.hi) for r in few.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("page").alias("lo"), F.max("page").alias("hi")).collect()) == [(1, 3, 1, 3), (4, 2500, 1, 2500)]
    # the range of a number in some link is never a list
    assert [r.page for r in B.page_rows(pagers.where("page_id = 5"), F.col("last")).limit(3).collect()] == [1, 2, 3]
    assert [(r.page_id, r.stage, r.reason) for r in B.page_rejects(pagers, "page_id", "url", F.col("last"), 5000).collect()] == [(5, "pages", "300000000 pages")]
    links = F.array(F.lit("/s?page=3"), F.lit("/s?page=2"), F.lit("/s?page=3"))
    assert value(B.pages_from_links(links)) == ["/s?page=1", "/s?page=2", "/s?page=3"]
    assert value(B.last_page(F.array(F.lit("a"), F.lit("/r?page=12"), F.lit("next")), "page=")) == 12


def test_first_seen_stream_keeps_one_row_per_key(spark, tmp_path):
    rows = spark.createDataFrame([("us", "a", i) for i in range(5)] + [("gb", "a", 9)], "c string, s string, n int")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = L.read_page_stream(spark, str(tmp_path / "in"), rows.schema)
    L.run_to_end(L.first_seen_stream(stream, ["c", "s"]), str(tmp_path / "state"), str(tmp_path / "out"))
    assert sorted((r.c, r.s) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("gb", "a"), ("us", "a")]


def test_newest_row_and_null_buckets(spark):
    rows = spark.createDataFrame([("a", 1, None, 1), ("a", 2, 5, 1), ("a", 3, 5, 2), ("b", 4, None, 9), (None, 5, 1, 1), (None, 6, 2, 1)],
                                 "k string, v int, fetched_at int, page_id int")
    assert sorted((r.k or "", r.v) for r in H.newest(rows, ["k"]).collect()) == [("", 6), ("a", 3), ("b", 4)]
    kept = H.first_n(rows, ["k"], ["fetched_at", "page_id"], F.lit(1), bucket=F.col("fetched_at"))
    assert sorted((r.k or "", r.v) for r in kept.collect()) == [("", 5), ("a", 1), ("b", 4)]


def test_keys_are_forgotten_after_the_delay(spark, tmp_path):
    """A key that comes back after the watermark passed its first time is new again."""
    for k, at in [("a", 0), ("a", 10), ("b", 7200), ("a", 7300)]:
        (spark.createDataFrame([(k, at)], "k string, s bigint").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1)
         .write.mode("append").parquet(f"{tmp_path}/in"))
        seen = L.first_seen_stream(L.read_page_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files=1), ["k"], "ts", "1 minute")
        L.run_to_end(seen.select("k"), f"{tmp_path}/state", f"{tmp_path}/out")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "a", "b"]


def test_one_per_key_reads_keys_by_the_group(spark, tmp_path):
    """Calls and state grow with the groups, not with the keys; the rows are those of each key for itself, also nulls, ties and what comes too late."""
    at = "timestamp_seconds({}) AS ts"
    first = "SELECT id % 300 AS k, CASE WHEN id % 3 > 0 THEN id % 3 END AS j, " + at.format("100 + id % 7") + ", -id AS n FROM range(900)"
    early = "SELECT 5L AS k, 2L AS j, " + at.format("99") + ", 7L AS n UNION ALL SELECT NULL, NULL, " + at.format("2000") + ", 0L"
    late = "SELECT 5L AS k, 2L AS j, " + at.format("1990") + ", -7L AS n UNION ALL SELECT 900L, 1L, " + at.format("1990") + ", 1L"
    clock = "SELECT CAST(NULL AS BIGINT) AS k, CAST(NULL AS BIGINT) AS j, " + at + ", 0L AS n"
    for text in (first, early, clock.format("2001"), late, clock.format("9000")):
        spark.sql(text).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    given = spark.read.parquet(f"{tmp_path}/in")
    for latest in (False, True):
        stream = L.read_page_stream(spark, f"{tmp_path}/in", given.schema, files=1)
        out = L.one_per_key(stream, ["k", "j"], ["ts", "n"], "ts", timedelta(seconds=60), latest=latest, groups=8)
        with L.stores_on_disk(spark):
            query = out.writeStream.format("parquet").option("path", f"{tmp_path}/{latest}").option("checkpointLocation", f"{tmp_path}/s{latest}").trigger(availableNow=True).start()
            L.wait(query)
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3 * 8
        found = {(r["k"], r["j"]): (r["ts"].timestamp(), r["n"]) for r in spark.read.parquet(f"{tmp_path}/{latest}").collect()}
        want = {}
        for r in given.where("k IS NOT NULL AND (n <> -7 OR unix_seconds(ts) < 1000)").collect():
            want.setdefault((r["k"], r["j"]), []).append((r["ts"].timestamp(), r["n"]))
        assert found == {k: (max if latest else min)(v) for k, v in want.items()}


def test_job_and_supplement_streams_equal_the_batch(spark, tmp_path):
    from pagegrain.plans.jobs import brassring_jobs
    html = "<span id='Job Abbreviation Title'>t{0}</span><span id='Job Description'>d</span>"
    pages = spark.createDataFrame([(i, "detail", "u", html.format(i)) for i in range(6)], "page_id bigint, page_type string, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_path}/in")
    L.wait(L.stream_jobs(L.read_page_stream(spark, f"{tmp_path}/in", pages.schema, files=1), f"{tmp_path}/state", f"{tmp_path}/out"))
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3
    assert sorted(r.job_title for r in spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(r.job_title for r in brassring_jobs(pages).collect())
