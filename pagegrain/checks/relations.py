"""Checks of joins, aggregates, windows, sets, nested values and data quality (families F to J, N)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks.base import ORACLES, check, table
from pagegrain.functions import markup as M
from pagegrain.functions import text as X
from pagegrain.operators import aggregates as G
from pagegrain.operators import joins as J
from pagegrain.operators import nested, quality, sets
from pagegrain.operators import options as O
from pagegrain.operators import windows as H
from pagegrain.session import scratch_path
from pagegrain.sources import sinks

LONG = "bigint"


@check("f1_lookup", """
SELECT c_custkey, n_name, 'C' || n_regionkey AS currency, n_name IS NULL AS unknown
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey""")
def f1_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", F.concat(F.lit("C"), "n_regionkey").alias("currency"))
    out = J.with_dims(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), dims, "c_nationkey")
    return out.select("c_custkey", "n_name", "currency", J.no_match("n_name").alias("unknown"))


@check("f2_chain", """
WITH v AS (SELECT l_orderkey, count(*) AS n_variants, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_orderkey),
i AS (SELECT l_orderkey, max(l_partkey) AS image FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o_orderkey, c_name, n_variants, total, image
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN v ON v.l_orderkey = o_orderkey LEFT JOIN i ON i.l_orderkey = o_orderkey""")
def f2_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.assemble(*_chain_sides(spark, sf_dir), ["o_orderkey"])


def _chain_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    key = F.col("l_orderkey").alias("o_orderkey")
    detail = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    variants = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n_variants"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    images = lines.where("l_returnflag = 'R'").groupBy(key).agg(F.max("l_partkey").alias("image"))
    return [orders.select("o_orderkey"), detail, variants, images]


@check("f2_bucketed", ORACLES["f2_chain"])
def f2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chain from tables that are bucketed by the key: nothing is moved above their scans."""
    run = uuid.uuid4().hex[:12]
    sides = [sinks.write_bucketed(side, f"chain_{i}_{run}", scratch_path(spark, f"chain{i}"), ["o_orderkey"], 8) for i, side in enumerate(_chain_sides(spark, sf_dir))]
    joined = J.assemble_bucketed(*sides, ["o_orderkey"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:
        raise AssertionError(plan)
    return joined


@check("f3_option", """
SELECT l_orderkey, l_linenumber, p_name AS size_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10""")
def f3_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order as skus, the parts it names as options."""
    text = lambda c: F.col(c).cast("string")
    sku = F.struct(text("l_linenumber").alias("color_option"), text("l_partkey").alias("size_option"), F.lit(1).alias("stock"), F.lit("1").alias("price"))
    option = F.when(F.col("p_size") > 10, F.struct(F.col("p_name").alias("sOptionName"), text("p_partkey").alias("iOptionPk")))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    orders = lines.groupBy("l_orderkey").agg(F.collect_list(sku).alias("skus"), F.collect_set(option).alias("options"))
    named = orders.select("l_orderkey", F.explode(O.size_names(F.col("skus"), F.col("options"))).alias("s"))
    return named.select("l_orderkey", F.col("s.color_option").cast("int").alias("l_linenumber"), F.col("s.size").alias("size_name"))


@check("f4_swatch", """
SELECT s_suppkey, l_orderkey, l_linenumber FROM supplier LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 45) ON l_suppkey = s_suppkey AND s_suppkey % 2 = 0""")
def f4_swatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier as a swatch, its large lines as skus of its own option or of another one."""
    own = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")).otherwise(F.lit(-1)).cast("string")
    skus = table(spark, sf_dir, "lineitem").where("l_quantity > 45").groupBy("l_suppkey").agg(
        F.collect_list(F.struct(own.alias("color_option"), "l_orderkey", "l_linenumber")).alias("skus"))
    swatches = table(spark, sf_dir, "supplier").select("s_suppkey").join(skus, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    mine = swatches.select("s_suppkey", F.explode_outer(O.skus_of(F.col("s_suppkey").cast("string"), F.col("skus"))).alias("s"))
    return mine.select("s_suppkey", "s.l_orderkey", "s.l_linenumber")


def first_labels(entries: DataFrame) -> DataFrame:
    """The labels ``e`` (pos, label) of each brand in order. The first label of a US size wins, so the others are left out before the lists
    are made: they are bounded by the sizes there are, not by the parts."""
    first = entries.groupBy("p_brand", "p_size").agg(F.min("e").alias("e"))
    return first.groupBy("p_brand").agg(F.array_sort(F.collect_list("e")).alias("l"))


@check("f5_uk_size", """
WITH lab AS (SELECT p_brand, p_size AS us, min(p_partkey) AS pos FROM part WHERE p_partkey % 3 = 0 GROUP BY p_brand, p_size)
SELECT p_partkey, part.p_brand, CAST(p_size AS VARCHAR) AS size_identifier,
  CASE WHEN lab.pos IS NULL THEN NULL ELSE 'UK ' || (lab.pos % 50) END AS uk_name
FROM part LEFT JOIN lab ON lab.p_brand = part.p_brand AND lab.us = part.p_size""")
def f5_uk_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    label = F.concat((F.col("p_partkey") % 50).cast("string"), F.lit(" Size "), F.col("p_size").cast("string"))
    labels = first_labels(part.where("p_partkey % 3 = 0").select("p_brand", "p_size", F.struct(F.col("p_partkey").alias("pos"), label.alias("label")).alias("e")))
    sizes = part.select("p_partkey", "p_brand", F.col("p_size").cast("string").alias("size_identifier")).join(labels, "p_brand", "left")
    item = F.struct("size_identifier", F.col("size_identifier").alias("size_name"))
    name = F.get(O.uk_names(F.array(item), F.coalesce(F.col("l.label"), F.array().cast("array<string>"))), F.lit(0))["size_name"]
    return sizes.select("p_partkey", "p_brand", "size_identifier", F.when(F.startswith(name, F.lit("UK ")), name).alias("uk_name"))


@check("f6_color", """
WITH u AS (SELECT l_partkey, l_returnflag, max(l_orderkey) AS last_order FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL),
s AS (SELECT l_partkey, l_returnflag, count(*) AS n_sizes FROM lineitem WHERE l_quantity > 10 GROUP BY ALL)
SELECT c.l_partkey, c.l_returnflag, last_order, n_sizes FROM (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) c
LEFT JOIN u ON u.l_partkey = c.l_partkey AND u.l_returnflag = c.l_returnflag
LEFT JOIN s ON s.l_partkey = c.l_partkey AND s.l_returnflag = c.l_returnflag""")
def f6_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colours of a part with the lists that its pages give by colour."""
    lines, color = table(spark, sf_dir, "lineitem"), F.col("l_returnflag").alias("color")
    urls = lines.where("l_returnflag <> 'N'").groupBy("l_partkey", color).agg(F.max("l_orderkey").alias("last_order"))
    sizes = lines.where("l_quantity > 10").groupBy("l_partkey", color).agg(F.count(F.lit(1)).alias("n_sizes"))
    listed = lambda df, value: df.groupBy("l_partkey").agg(F.collect_list(F.struct("color", value)).alias(value))
    colors = lines.groupBy("l_partkey").agg(F.collect_set("l_returnflag").alias("colors"))
    parts = colors.join(listed(urls, "last_order"), "l_partkey", "left").join(listed(sizes, "n_sizes"), "l_partkey", "left")
    rows = parts.select("l_partkey", F.explode("colors").alias("l_returnflag"), F.col("last_order").alias("urls"), F.col("n_sizes").alias("sizes"))
    return rows.select("l_partkey", "l_returnflag", O.of_color(F.col("urls"), F.col("l_returnflag"))["last_order"].alias("last_order"),
                       O.of_color(F.col("sizes"), F.col("l_returnflag"))["n_sizes"].alias("n_sizes"))


@check("f7_ignore", """
SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 10 = 0)""")
def f7_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return J.drop_ignored(pages, pages.where("page_id % 10 = 0").select("url")).select("page_id", "url")


@check("f8_regions", """
SELECT r_name AS region, 'C' || r_regionkey AS currency, string_agg(lower(n_name), ',' ORDER BY lower(n_name)) AS countries
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def f8_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    countries = J.with_dims(nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(
        F.col("r_name").alias("region"), F.concat(F.lit("C"), "n_regionkey").alias("currency"), F.col("n_name").alias("country_name"))
    codes = nation.select(F.col("n_name").alias("country_name"), F.lower("n_name").alias("country_code"))
    return J.delivery_regions(countries, codes).withColumn("countries", F.array_join("countries", ","))


@check("g1_best", """
SELECT l_suppkey, round(max(l_discount) * 100, 2) AS best, true AS has_sign FROM lineitem GROUP BY l_suppkey""")
def g1_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.round(F.col("l_discount") * 100, 2).cast("string"), F.lit("%"))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", text.alias("save"))
    best = G.best_discount(rows, ["l_suppkey"], "save")
    return best.select("l_suppkey", F.translate("cash_back", "%", "").cast("double").alias("best"),
                       F.endswith("cash_back", F.lit("%")).alias("has_sign"))


@check("g2_varies", """
SELECT l_orderkey, count(DISTINCT l_extendedprice) > 1 AS price_varies FROM lineitem GROUP BY l_orderkey""")
def g2_varies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.price_varies(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_extendedprice")


@check("g3_has_price", """
SELECT l_orderkey, l_returnflag, count(CASE WHEN l_tax > 0.04 THEN 1 END) >= 1 AS has_price FROM lineitem GROUP BY ALL""")
def g3_has_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = F.struct(F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("price"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(sku).alias("skus"))
    return rows.select("l_orderkey", "l_returnflag", O.has_price(F.col("skus")).alias("has_price"))


@check("g4_sizes", """
SELECT l_orderkey, l_returnflag, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_linenumber || ':' || l_partkey) AS sizes
FROM lineitem GROUP BY ALL""")
def g4_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", F.col("l_linenumber").alias("pos"), F.concat_ws(":", "l_linenumber", "l_partkey").alias("item"))
    return G.sizes_per_color(rows, ["l_orderkey", "l_returnflag"]).select(
        "l_orderkey", "l_returnflag", F.array_join("size_infos", ",").alias("sizes"))


@check("g5_counts", """
SELECT p_type, count(*) AS entries, count(DISTINCT p_brand) AS distinct_values FROM part GROUP BY p_type""")
def g5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.listing_counts(table(spark, sf_dir, "part"), ["p_type"], "p_brand")


@check("h1_first_seen", """
SELECT event_type, user_id, event_id, props FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def h1_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id", "props")
    return H.first_seen(events, ["event_type", "user_id"], ["ts", "event_id"]).drop("ts")


@check("h2_ffill", """
SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'click' THEN 'v' || event_id END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS carried
FROM (SELECT event_id, user_id, event_type, CASE WHEN event_id % 13 <> 0 THEN ts END AS ts FROM events)""")
def h2_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("event_type") == "click", (F.col("event_id") + 1).cast("string")).otherwise("0.0")
    time = F.when(F.col("event_id") % 13 != 0, F.col("ts"))  # a missing time comes first
    events = table(spark, sf_dir, "events").select("event_id", "user_id", time.alias("ts"), price.alias("price"))
    out = H.last_positive(events, ["user_id"], ["ts", "event_id"], "price", "carried", bucket=F.date_trunc("hour", "ts"))
    return out.select("event_id", F.when(F.col("carried") == "", "").otherwise(
        F.concat(F.lit("v"), (F.col("carried").cast(LONG) - 1).cast("string"))).alias("carried"))


@check("h3_resolve", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_partkey % 4 WHEN 0 THEN '0.0' WHEN 1 THEN '' ELSE 's' || l_linenumber END AS sale,
    CASE l_suppkey % 3 WHEN 0 THEN '0.0' ELSE CAST(l_partkey AS VARCHAR) || '.5' END AS standard FROM lineitem),
w AS (SELECT *, coalesce(last_value(CASE WHEN TRY_CAST(standard AS DOUBLE) > 0 THEN standard END IGNORE NULLS) OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS pos FROM r),
x AS (SELECT *, CASE WHEN sale IN ('', '0.0') THEN standard ELSE sale END AS s1 FROM w),
y AS (SELECT *, CASE WHEN standard IN ('', '0.0') THEN s1 ELSE standard END AS st1 FROM x)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN st1 = '0.0' THEN pos ELSE s1 END AS sale, CASE WHEN st1 = '0.0' THEN pos ELSE st1 END AS standard FROM y""")
def h3_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sale = F.when(F.col("l_partkey") % 4 == 0, "0.0").when(F.col("l_partkey") % 4 == 1, "").otherwise(F.concat(F.lit("s"), "l_linenumber"))
    standard = F.when(F.col("l_suppkey") % 3 == 0, "0.0").otherwise(F.concat("l_partkey", F.lit(".5")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sale.alias("sale"), standard.alias("standard"))
    # line numbers repeat inside an order; rows that tie in all three have the same price
    return H.resolve_prices(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]).drop("l_suppkey")


@check("h4_first_n", """
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d NULLS FIRST, o_orderkey) AS rn
  FROM (SELECT *, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS d FROM orders))
WHERE rn <= o_custkey % 5""")
def h4_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate"))  # a missing date comes first
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", date.alias("o_orderdate"))
    return H.first_n(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_custkey") % 5,
                     bucket=F.date_trunc("month", "o_orderdate")).drop("o_orderdate")


@check("h5_sorted", "SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def h5_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.sorted_distinct(table(spark, sf_dir, "part"), "p_brand")


@check("i1_distinct", "SELECT DISTINCT p_name FROM part")
def i1_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.distinct_values(table(spark, sf_dir, "part"), "p_name")


@check("i2_union", """
SELECT 'mini' AS item_kind, CAST(l_partkey AS VARCHAR) AS base_sku, l_returnflag AS country_code, CAST(l_orderkey AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS brand FROM lineitem
UNION ALL SELECT 'full', CAST(l_partkey AS VARCHAR), l_returnflag, CAST(min(l_orderkey) AS VARCHAR), max(p_brand) FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_returnflag""")
def i2_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("array<string>")
    listing = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("base_sku"), none.alias("category_identifiers"), none.alias("category_names"),
        F.col("l_returnflag").alias("country_code"), F.lit("en").alias("language_code"), "l_orderkey",
        F.col("l_orderkey").cast("string").alias("url"), F.lit("").alias("referer_url"))
    first = sets.first_sightings(listing, ["l_orderkey"])
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("base_sku"), F.col("p_brand").alias("brand"))
    full = first.join(brands, "base_sku").select("base_sku", "country_code", "url", "brand")
    return sets.mini_and_full(listing, full).select("item_kind", "base_sku", "country_code", "url", "brand")


@check("j1_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS bare, true AS bad_is_null FROM events""")
def j1_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    bare = F.replace(F.replace(props, F.lit('"'), F.lit("")), F.lit("}"), F.lit(",'u':'a\\/b'}"))
    return table(spark, sf_dir, "events").select(
        "event_id", M.parse_js(props, "struct<k:bigint>")["k"].alias("k"),
        M.parse_js(bare, "struct<k:bigint,u:string>")["k"].alias("bare"),
        M.parse_js(F.concat(F.lit("{{"), props), "struct<k:bigint>")["k"].isNull().alias("bad_is_null"))


@check("j2_map", """
SELECT p_partkey, opt, CASE opt WHEN 's' || p_size THEN p_name ELSE p_brand END AS name, CAST(p_size AS VARCHAR) AS pk
FROM part, unnest(['s' || p_size, '7']) AS t(opt)""")
def j2_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    body = F.concat(F.lit("{s"), size, F.lit(":{sOptionName:'"), "p_name", F.lit("',iOptionPk:'"), size,
                    F.lit("'},7:{sOptionName:'"), "p_brand", F.lit("',iOptionPk:'"), size, F.lit("'}}"))
    parsed = M.parse_js(body, "map<string,struct<sOptionName:string,iOptionPk:string>>")
    rows = nested.explode_map(table(spark, sf_dir, "part"), parsed, "opt", "v", ["p_partkey"])
    return rows.select("p_partkey", "opt", F.col("v.sOptionName").alias("name"), F.col("v.iOptionPk").alias("pk"))


@check("j3_variants", """
SELECT p_partkey, CAST(0 AS BIGINT) AS pos, '001' AS color, CAST(p_size AS VARCHAR) AS size, CAST(p_size % 9 AS BIGINT) AS stock, '0.0' AS sale, '9.5' AS standard FROM part
UNION ALL SELECT p_partkey, 1, '002', '', 0, '', CAST(p_size AS VARCHAR) FROM part""")
def j3_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    body = F.concat(
        F.lit('{"variations":{"variants":[{"ATS":'), (F.col("p_size") % 9).cast("string"), F.lit(',"attributes":{"color":"001","size":"'), size,
        F.lit('"},"pricing":{"sale":"0.0","standard":"9.5"}},{"attributes":{"color":"002"},"pricing":{"standard":"'), size, F.lit('"}}]}}'))
    rows = nested.variants(table(spark, sf_dir, "part").select("p_partkey", body.alias("body")), "body", ["p_partkey"])
    return rows.select("p_partkey", F.col("pos").cast(LONG).alias("pos"), "color", "size", F.col("stock").cast(LONG).alias("stock"), "sale", "standard")


@check("j4_markup", "SELECT p_partkey, p_size || '|' || p_name AS sizes FROM part")
def j4_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<option value='1'>"), F.col("p_size").cast("string"), F.lit("\n<option value='2'>"), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(M.markup_sizes(text), "|").alias("sizes"))


@check("j5_size_item", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey AS VARCHAR) AS size_identifier, upper(l_linestatus) || ' ' || l_partkey AS size_name,
  CAST(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS BIGINT) AS stock, 's' AS current_price, 'f' AS original_price FROM lineitem""")
def j5_size_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = M.stock_flag(F.when(F.col("l_returnflag") == "N", "True").otherwise("false"))
    item = M.size_item(F.col("l_partkey").cast("string"), F.lower("l_linestatus"), flag, F.lit("s"), F.lit("f"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", item.alias("i")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "i.size_identifier", "i.size_name", F.col("i.stock").cast(LONG).alias("stock"),
        F.col("i.size_current_price_text").alias("current_price"), F.col("i.size_original_price_text").alias("original_price"))


@check("j6_fanout", """
SELECT 'p' || p_partkey AS base_sku, CASE WHEN c IS NULL THEN 'p' || p_partkey ELSE 'p' || p_partkey || '_' || c END AS sku, c AS color_code
FROM part, unnest(CASE p_size % 3 WHEN 0 THEN [NULL] WHEN 1 THEN ['001'] ELSE ['001', '002'] END) AS t(c)""")
def j6_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    colors = F.slice(F.array(*[F.struct(F.lit(c).alias("color_code")) for c in ("001", "002")]), F.lit(1), F.col("p_size") % 3)
    rows = nested.swatch_rows(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("base_sku"), colors.alias("s")), "s")
    return nested.with_color_sku(rows).select("base_sku", "sku", "color_code")


@check("n1_rejects", """
SELECT c_custkey AS page_id, c_name AS url, 'country' AS stage, 'not found or not readable' AS reason FROM customer WHERE c_nationkey >= 20
UNION ALL SELECT c_custkey, c_name, 'price', 'not found or not readable' FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, c_name, 'good', '' FROM customer WHERE c_nationkey < 20 AND c_acctbal >= 0""")
def n1_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = J.with_dims(table(spark, sf_dir, "customer"), dims, "c_nationkey")
    checks = {"country": F.col("n_name").isNull(), "price": F.col("c_acctbal") < 0}
    good, bad = quality.with_rejects(rows, "c_custkey", "c_name", checks)
    return bad.unionByName(good.select(F.col("c_custkey").alias("page_id"), F.col("c_name").alias("url"), F.lit("good").alias("stage"), F.lit("").alias("reason")))


@check("n2_defaults", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'NA' ELSE p_name END AS cash, CASE WHEN p_size % 3 = 0 THEN 'offers only' ELSE p_type END AS offer FROM part""")
def n2_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    cash = F.when(F.col("p_size") % 2 != 0, F.col("p_name"))
    offer = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", X.fill(cash, "NA").alias("cash"), X.fill(offer, "offers only").alias("offer"))
