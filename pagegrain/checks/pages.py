"""Checks of sources, sinks, frontier and nodes (families A, B, C)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks.base import LI, NAV, check, table
from pagegrain.functions import text as X
from pagegrain.functions import urls as U
from pagegrain.functions.catalog import breadcrumb
from pagegrain.functions.markup import script_var
from pagegrain.operators import frontier as B
from pagegrain.operators import nodes as N
from pagegrain.operators.filters import followed_label
from pagegrain.operators.sets import staged
from pagegrain.schemas import conform, JOBS, PRODUCTS
from pagegrain.session import scratch_path
from pagegrain.sources import sinks
from pagegrain.sources.pages import OFFER_ROUTES, PRODUCT_ROUTES, read_pages, route_pages

LONG = "bigint"


@check("a1_pages", """
SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars,
  regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '^www\\.', '') AS site
FROM pages""")
def a1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast(LONG).alias("n_chars"), "site")


def part_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cash = F.concat(F.col("p_size").cast("string"), F.lit("%"))
    return table(spark, sf_dir, "part").select(
        F.concat_ws(' "', "p_name", "p_brand").alias("store_name"), cash.alias("cash_back"),
        F.concat(F.lit("http://s.example/a,b/"), "p_partkey").alias("url"), X.cash_category(cash).alias("category"),
        F.concat(F.lit("site"), (F.col("p_partkey") % 5).cast("string")).alias("site"))


@check("a2_csv_roundtrip", """
SELECT p_name || ' "' || p_brand AS store_name, CAST(p_size AS VARCHAR) || '%' AS cash_back,
  'http://s.example/a,b/' || p_partkey AS url, 'Percentage Cash Back' AS category, 'site' || (p_partkey % 5) AS site
FROM part""")
def a2_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "a2")
    sinks.write_offers(part_offers(spark, sf_dir), path)
    return sinks.read_csv(spark, path, "store_name string, cash_back string, url string, category string, site string")


@check("a3_jobs_csv", """
SELECT lang || ' "job"' AS job_title, CAST(doc_id AS VARCHAR) AS job_id, source AS job_location,
  text AS summary, lang || chr(10) || source AS requirements
FROM documents""")
def a3_jobs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "a3")
    jobs = table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit(' "job"')).alias("job_title"), F.col("doc_id").alias("job_id"),
        F.col("source").alias("job_location"), F.col("text").alias("summary"),
        F.concat("lang", F.lit("\n"), "source").alias("requirements"))
    sinks.write_jobs(conform(jobs, JOBS), path)
    return sinks.read_csv(
        spark, path, "job_title string, job_id string, job_location string, summary string, requirements string")


@check("a4_products_parquet", """
SELECT 'c' || (p_partkey % 4) AS country_code, 'p' || p_partkey AS base_sku, p_name AS title,
  CAST(p_size AS VARCHAR) AS size_identifier, CAST(p_size % 7 AS BIGINT) AS stock
FROM part""")
def a4_products_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "a4")
    size = F.col("p_size").cast("string")
    item = F.struct(size.alias("size_identifier"), size.alias("size_name"), (F.col("p_size") % 7).alias("stock"),
                    F.lit(None).cast("string").alias("size_current_price_text"),
                    F.lit(None).cast("string").alias("size_original_price_text"))
    products = table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("country_code"),
        F.concat(F.lit("p"), "p_partkey").alias("base_sku"), F.array("p_name").alias("title"),
        F.array(item).alias("size_infos"))
    sinks.write_products(conform(products, PRODUCTS), path)
    return spark.read.parquet(path).select(
        "country_code", "base_sku", F.get("title", F.lit(0)).alias("title"), F.explode("size_infos").alias("s")
    ).select("country_code", "base_sku", "title", "s.size_identifier", F.col("s.stock").cast(LONG).alias("stock"))


@check("a4_lookup", """
SELECT 'c' || (p_partkey % 4) AS country_code, 'p' || p_partkey AS base_sku, p_name AS title FROM part WHERE p_partkey % 50 = 7""")
def a4_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by key from the clustered files."""
    path, part = scratch_path(spark, "a4"), table(spark, sf_dir, "part")
    products = part.select(F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("country_code"), F.concat(F.lit("p"), "p_partkey").alias("base_sku"), F.array("p_name").alias("title"))
    sinks.write_products(conform(products, PRODUCTS), path)
    wanted = part.where("p_partkey % 50 = 7").select(F.concat(F.lit("p"), "p_partkey").alias("base_sku"))
    return spark.read.parquet(path).join(wanted, "base_sku", "left_semi").select("country_code", "base_sku", F.get("title", F.lit(0)).alias("title"))


_ROUTE_HOSTS = [
    ("www.befrugal.com", "/coupons/stores/A", "befrugal", "listing"),
    ("giftcardgranny.com", "/buy/1", "giftcardgranny", "detail"),
    ("sjobs.brassring.com", "/TGWebHost/jobdetails.aspx?id=1", "brassring", "detail"),
    ("www.intermixonline.com", "/home.do", "intermix", "home"),
    ("www.toryburch.com", "/p?pid=1&format=json", "toryburch", "variants"),
    ("www.toryburch.jp", "/item/shop_product_id/77/", "toryburch", "detail"),
    ("intermix.scene7.com", "/is/image/a?req=imageset,javascript", "intermix", "images"),
    ("s7d5.scene7.com", "/is/image/a_S?req=imageset,json", "toryburch", "images"),
    ("www.toryburch.com", "/clothing/", "toryburch", "listing"),
    ("www.toryburch.com", "/shoes/view-all/?start=24", "toryburch", "listing"),
    ("www.toryburch.com", "/amy-bag/12345678.html", "toryburch", "detail"),
    ("unknown.example", "/x", "unknown.example", "other"),
]


def _case(values: list[str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@check("a5_route", f"""
SELECT p_partkey AS page_id, 'http://' || {_case([h + p for h, p, _, _ in _ROUTE_HOSTS], f'p_partkey % {len(_ROUTE_HOSTS)}')} AS url,
  {_case([s for _, _, s, _ in _ROUTE_HOSTS], f'p_partkey % {len(_ROUTE_HOSTS)}')} AS site,
  {_case([t for _, _, _, t in _ROUTE_HOSTS], f'p_partkey % {len(_ROUTE_HOSTS)}')} AS page_type
FROM part""")
def a5_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = F.array(*[F.lit("http://" + h + p) for h, p, _, _ in _ROUTE_HOSTS])
    pages = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"), F.get(urls, (F.col("p_partkey") % len(_ROUTE_HOSTS)).cast("int")).alias("url"))
    return route_pages(pages, OFFER_ROUTES + PRODUCT_ROUTES)


@check("b1_letters", """
SELECT n_name AS site, letter, 'http://' || lower(n_name) || '.example/' || letter AS url
FROM nation, unnest(list_prepend(CAST(n_nationkey AS VARCHAR),
  list_transform(string_split('A,B,C,D,E,F,G,H,I,J,K,L,M,N,O,P,Q,R,S,T,U,V,W,X,Y,Z', ','),
                 lambda x: CASE WHEN n_nationkey % 2 = 0 THEN x ELSE lower(x) END))) AS t(letter)""")
def b1_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("site"), F.concat(F.lit("http://"), F.lower("n_name"), F.lit(".example/")).alias("base"),
        F.col("n_nationkey").cast("string").alias("digit_token"), (F.col("n_nationkey") % 2 == 0).alias("upper"))
    return B.letter_urls(sites)


@check("b2_pages_known", """
SELECT c_custkey, rule, CAST(page AS BIGINT) AS page, 'http://x.example/' || c_custkey || '?p=' || page AS url
FROM customer, unnest(['last', 'first', 'page=', 'pg=']) AS r(rule), unnest(range(1, c_nationkey % 7 + 1)) AS p(page)""")
def b2_pages_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("c_nationkey") % 7).cast("string")
    base = F.concat(F.lit("http://x.example/"), F.col("c_custkey"), F.lit("?p="))
    pagers = {
        "last": F.array(F.lit("1"), F.lit("2"), n),
        "first": F.array(F.concat(n, F.lit(" pages"))),
        "page=": F.array(F.lit("?page=1"), F.concat(F.lit("?page="), n), F.lit("?next")),
        "pg=": F.array(F.concat(F.lit("/s?pg="), n), F.lit("a"), F.lit("b")),
    }
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    parts = [B.page_urls_known(customers, base, pager, rule).withColumn("rule", F.lit(rule))
             for rule, pager in pagers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("c_custkey", "rule", F.col("page").cast(LONG).alias("page"), "url")


@check("b3_pages_fixed", """
SELECT c_custkey, kind, CAST(page AS BIGINT) AS page, 'http://x.example/?c=' || c_custkey || '&page=' || page AS url
FROM (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'grid' WHEN 1 THEN 'directory' WHEN 2 THEN 'report'
        ELSE 'looks' END AS kind FROM customer),
  unnest(range(1, CASE WHEN c_custkey % 3 = 0 THEN 21 WHEN kind = 'grid' THEN 11 WHEN kind = 'directory' THEN 14 WHEN kind = 'report' THEN 10 ELSE 2 END)) AS p(page)
UNION ALL
SELECT c_custkey, 'jobs', CAST(o AS BIGINT), 'http://x.example/?c=' || c_custkey || '&start=' || o
FROM customer, unnest(CASE WHEN c_custkey % 3 = 0 THEN [1, 51, 101, 151, 201, 251, 301] ELSE [1, 51, 101, 151] END) AS p(o)""")
def b3_pages_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("grid", "directory", "report", "looks")])
    base = F.concat(F.lit("http://x.example/?c="), F.col("c_custkey"))
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.get(kinds, F.col("c_nationkey") % 4).alias("kind"))
    told = F.col("c_custkey") % 3 == 0
    pages = B.page_urls_fixed(customers, F.col("kind"), base, F.when(told, 20))
    jobs = customers.select("c_custkey", F.explode(B.job_offsets(F.when(told, 320))).alias("page")).withColumn(
        "kind", F.lit("jobs")).withColumn("url", F.concat(base, F.lit("&start="), F.col("page").cast("string")))
    return pages.unionByName(jobs).withColumn("page", F.col("page").cast(LONG))


@check("b4_pages_links", """
SELECT c_custkey, CAST(pos AS BIGINT) AS pos, '/s?letter=' || c_nationkey || '&page=' || [1, 10, 2, 3][pos + 1] AS url
FROM customer, unnest(range(0, 4)) AS p(pos)""")
def b4_pages_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.concat(F.lit("/s?letter="), F.col("c_nationkey"), F.lit("&page="))
    links = F.array(*[F.concat(base, F.lit(p)) for p in ("3", "2", "10", "2")])
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.posexplode(B.pages_from_links(links)).alias("pos", "url")).withColumn("pos", F.col("pos").cast(LONG))


@check("b5_links", f"""
WITH {NAV}
SELECT page_id, CAST(i - 1 AS BIGINT) AS link_pos, l[i] AS link
FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '(?is)href="(.*?)"', 1) AS l FROM pages))""")
def b5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return B.detail_links(pages, "html").withColumn("link_pos", F.col("link_pos").cast(LONG))


@check("b6_abs_url", f"""
WITH {LI}
SELECT page_id, pos, 'http://s.example' || link AS forced, 'http://s.example' || link AS unless_http,
  'http://s.example/x' || link AS no_dots, 'http://img.example' || link AS schemeless
FROM (SELECT page_id, pos, regexp_extract(block, 'href="(.*?)"', 1) AS link FROM li)""")
def b6_abs_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = X.attr_value(F.col("block"), "href")
    done = U.absolute_url(link, "http://s.example")
    return N.simple_blocks(table(spark, sf_dir, "pages").select("page_id", "html"), "li").select(
        "page_id", F.col("pos").cast(LONG).alias("pos"), done.alias("forced"),
        U.absolute_url(done, "http://other.example", force=False).alias("unless_http"),
        U.absolute_url(U.drop_parent_dots(F.concat(F.lit(".."), F.lit("/x"), link)), "http://s.example").alias("no_dots"),
        U.schemeless(F.concat(F.lit("//img.example"), link)).alias("schemeless"))


ALLOWED = ["example.org", "blog.ththan.example.net"]


@check("b7_allowed", """
SELECT page_id, url, way
FROM (SELECT page_id, url, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS h FROM pages), unnest(['list', 'table']) AS w(way)
WHERE h = 'example.org' OR ends_with(h, '.example.org')
   OR h = 'blog.ththan.example.net' OR ends_with(h, '.blog.ththan.example.net')""")
def b7_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    domains = spark.createDataFrame([(d,) for d in ALLOWED], "domain string")
    return B.allowed_only(urls, ALLOWED).withColumn("way", F.lit("list")).unionByName(
        B.allowed_by_table(urls, domains).withColumn("way", F.lit("table")))


@check("b8_dedup", """
WITH r AS (SELECT url || CASE WHEN page_id % 2 = 0 THEN '#a' ELSE '' END AS url, CASE WHEN page_id % 5 <> 0 THEN page_id % 3 = 0 END AS dont_filter FROM pages
           UNION ALL SELECT url, false FROM pages),
k AS (SELECT *, regexp_replace(url, '#.*$', '') AS bare FROM r),
c AS (SELECT *, regexp_replace(bare, '\\?.*$', '') || CASE WHEN regexp_extract(bare, '\\?(.*)$', 1) = '' THEN '' ELSE '?' ||
   array_to_string(list_sort(string_split(regexp_extract(bare, '\\?(.*)$', 1), '&')), '&') END AS key FROM k)
SELECT url, true AS dont_filter FROM c WHERE dont_filter
UNION ALL SELECT min(url), false FROM c WHERE NOT coalesce(dont_filter, false) GROUP BY key""")
def b8_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    marked = pages.select(
        F.concat("url", F.when(F.col("page_id") % 2 == 0, "#a").otherwise("")).alias("url"),
        F.when(F.col("page_id") % 5 != 0, F.col("page_id") % 3 == 0).alias("dont_filter"))
    plain = pages.select("url", F.lit(False).alias("dont_filter"))
    return B.dedup_requests(marked.unionByName(plain)).select("url", F.coalesce("dont_filter", F.lit(False)).alias("dont_filter"))


@check("b8_rounds", r"""
WITH r AS (SELECT 0 AS round, url FROM pages WHERE page_id % 3 = 0
  UNION ALL SELECT 1, url || '#top' FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT 2, CASE WHEN page_id % 5 = 0 THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'z=1' ELSE url END FROM pages),
k AS (SELECT round, url, regexp_replace(url, '#.*$', '') AS bare FROM r),
c AS (SELECT round, url, regexp_replace(bare, '\?.*$', '') || CASE WHEN regexp_extract(bare, '\?(.*)$', 1) = '' THEN '' ELSE '?' ||
  array_to_string(list_sort(string_split(regexp_extract(bare, '\?(.*)$', 1), '&')), '&') END AS key FROM k)
SELECT min(round)::BIGINT AS round, key AS seen_key FROM c GROUP BY key""")
def b8_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of a crawl: each gives the urls that no earlier round had."""
    pages, name, path = table(spark, sf_dir, "pages"), f"seen_{uuid.uuid4().hex[:12]}", scratch_path(spark, "seen")
    key, url = F.col("page_id"), F.col("url")
    more = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("z=1"))
    rounds = [pages.where(key % 3 == 0).select("url"), pages.where(key % 2 == 0).select(F.concat("url", F.lit("#top")).alias("url")),
              pages.select(F.when(key % 5 == 0, more).otherwise(url).alias("url"))]
    seen, out = None, []
    for i, requests in enumerate(rounds):
        fresh = B.unseen(requests.withColumn("dont_filter", F.lit(False)), seen).select(F.lit(i).cast(LONG).alias("round"), "seen_key")
        fresh = staged(fresh, scratch_path(spark, "round"))
        out.append(fresh)
        seen = B.remember(fresh, name, path, 8)
    return reduce(DataFrame.unionByName, out)


@check("b9_query_url", """
SELECT p_partkey, 'http://shop.example/q/' || p_size || '?pid=' || p_partkey || '&format=json' AS variant_url,
  'http://img.example/image/' || p_name || '_S?req=imageset' AS image_url,
  'http://a.example/list?c=' || p_size || '&ajaxRequest=true&page=' || (p_partkey % 10) AS page_url,
  CAST(1000 + 10000000 * (p_partkey % 3) + p_partkey AS VARCHAR) AS shop_id
FROM part""")
def b9_query_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    shop = F.concat(F.lit("http://j.example/item/shop_product_id/"), (F.col("p_partkey") + 1000 + F.col("p_partkey") % 3 * 10000000).cast("string"),
                    F.when(F.col("p_partkey") % 2 == 0, "/").otherwise(""))
    return table(spark, sf_dir, "part").select(
        "p_partkey", U.variant_url(F.concat(F.lit("http://shop.example/p/"), key), F.concat(F.lit("/q/"), size), key)
        .alias("variant_url"),
        U.image_set_url(F.lit("http://img.example/image/"), F.col("p_name"), "_S?req=imageset").alias("image_url"),
        U.listing_page_url("http://a.example/list?c=", size, F.col("p_partkey") % 10).alias("page_url"),
        U.shop_id(shop).alias("shop_id"))


@check("b10_countries", """
SELECT CASE n_nationkey WHEN 1 THEN 'gb' ELSE 'jp' END AS country_code, 'C' || n_regionkey AS currency, 'en' AS language,
  'http://s.example/start' AS url
FROM nation WHERE n_nationkey IN (1, 2)
UNION ALL SELECT 'us', 'USD', 'en', 'http://s.example/start'""")
def b10_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("n_nationkey") == 1, "GB").when(F.col("n_nationkey") == 2, "JP").otherwise(F.col("n_name"))
    dims = table(spark, sf_dir, "nation").select(
        code.alias("country_code"), F.concat(F.lit("C"), "n_regionkey").alias("currency"), F.lit("en").alias("language"))
    return B.country_requests(spark, dims, "http://s.example/start", ["gb", "jp", "us"], ("us", "USD", "en"))


NAV_TESTS = [N.Test("nav"), N.Test("li", markup=True), N.Test("a")]
CATEGORY_WORDS = ("the", "de", "of", "and", "que", "der")


def nav_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.parse_nodes(table(spark, sf_dir, "pages"), NAV_TESTS, ["page_id", "url"])


@check("b11_nav", f"""
WITH {NAV}, e AS (SELECT page_id, unnest(hrefs) AS link, unnest(texts) AS label FROM nav)
SELECT page_id, link, label, lower(label) AS category,
  CAST(list_position(['the', 'de', 'of', 'and', 'que', 'der'], lower(label)) AS BIGINT) AS category_pos
FROM e WHERE lower(label) IN ('the', 'de', 'of', 'and', 'que', 'der')""")
def b11_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = N.ALL
    anchors = N.under(nodes, N.Test("nav"), N.Test("li"), N.Test("a"))
    staged = nav_docs(spark, sf_dir).select("page_id", N.values(anchors, "href").alias("links"),
                                            N.values(anchors).alias("labels"))
    rows = N.zip_explode(staged, link="links", label="labels").withColumn("category", F.lower("label"))
    rows = rows.where(followed_label(F.col("label")))
    return B.category_links(rows, CATEGORY_WORDS).select(
        "page_id", "link", "label", "category", F.col("category_pos").cast(LONG).alias("category_pos"))


@check("c1_nodes", """
SELECT page_id, tag, CAST(len(regexp_extract_all(body, '<' || tag || '[ >]')) AS BIGINT) AS n
FROM (SELECT page_id, regexp_replace(html, '(?is)<script>.*?</script>|<!--.*?-->', '', 'g') AS body FROM pages),
  unnest(['li', 'p', 'a', 'article', 'h1', 'div', 'b', 'br']) AS t(tag)
WHERE len(regexp_extract_all(body, '<' || tag || '[ >]')) > 0""")
def c1_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = N.tags("li", "p", "a", "article", "h1", "div", "b", "br")
    docs = N.parse_nodes(table(spark, sf_dir, "pages"), wanted, ["page_id"])
    return N.explode_nodes(docs.select("page_id", "nodes")).groupBy("page_id", "tag").agg(
        F.count(F.lit(1)).alias("n"))


@check("c2_blocks", f"WITH {LI} SELECT page_id, pos, block, 'nodes' AS way FROM li UNION ALL SELECT page_id, pos, block, 'markup' FROM li")
def c2_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.posexplode(N.select(N.ALL, N.Test("li")).col).alias("pos", "n")
    nodes = nav_docs(spark, sf_dir).select("page_id", items).select(
        "page_id", F.col("pos").cast(LONG).alias("pos"), F.col("n.outer").alias("block"), F.lit("nodes").alias("way"))
    markup = N.simple_blocks(table(spark, sf_dir, "pages").select("page_id", "html"), "li").select(
        "page_id", F.col("pos").cast(LONG).alias("pos"), "block", F.lit("markup").alias("way"))
    return nodes.unionByName(markup)


@check("c3_descendant", f"""
WITH {LI} SELECT page_id, count(*) AS n_li, count(*) AS n_a, 0::BIGINT AS n_outside FROM li GROUP BY page_id""")
def c3_descendant(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = N.ALL
    nav = N.select(nodes, N.Test("nav"))
    inside = N.descendants(nav, N.select(nodes, N.Test("li")))
    return nav_docs(spark, sf_dir).select(
        "page_id", N.count(inside).cast(LONG).alias("n_li"),
        N.count(N.descendants(inside, N.select(nodes, N.Test("a")))).cast(LONG).alias("n_a"),
        N.count(N.descendants(N.select(nodes, N.Test("a")), N.select(nodes, N.Test("li")))).cast(LONG).alias("n_outside"))


@check("c4_nth_child", f"""
WITH {NAV} SELECT page_id, texts[2] AS second, hrefs[4] AS fourth FROM nav""")
def c4_nth_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = N.ALL

    def anchor(n: int):
        return N.children(N.nth_child(nodes, "li", n), N.select(nodes, N.Test("a")))

    return nav_docs(spark, sf_dir).select(
        "page_id", N.pick(N.values(anchor(2)), 0).alias("second"), N.pick(N.values(anchor(4), "href"), 0).alias("fourth"))


@check("c5_attr_pred", f"""
WITH {NAV} SELECT page_id, CAST(len(list_filter(hrefs, lambda h: starts_with(h, '/th'))) AS BIGINT) AS n_starts,
  CAST(len(list_filter(hrefs, lambda h: contains(h, 'e'))) AS BIGINT) AS n_has,
  CAST(len(list_filter(texts, lambda t: contains(t, 'on'))) AS BIGINT) AS n_text
FROM nav""")
def c5_attr_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = N.ALL

    def count(found):
        return N.count(found).cast(LONG)

    return nav_docs(spark, sf_dir).select(
        "page_id", count(N.select(nodes, N.Test("a", "href", "starts", "/th"))).alias("n_starts"),
        count(N.select(nodes, N.Test("a", "href", "has", "e"))).alias("n_has"),
        count(N.where(nodes, "n.tag = 'a' AND " + N.attr_pred("n.text", "has", "on"))).alias("n_text"))


@check("c6_union", """
SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '<(li|h1|article|nav)[ >]', 1), lambda x: x), ',') AS tags
FROM pages""")
def c6_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.parse_nodes(table(spark, sf_dir, "pages"), N.tags("li", "h1", "article", "nav", "a"), ["page_id"])
    found = N.select(N.ALL, *N.tags("article", "h1", "li", "nav", "li"))
    return docs.select("page_id", F.array_join(F.transform(found.col, lambda n: n["tag"]), ",").alias("tags"))


@check("c7_values", f"""
WITH {NAV} SELECT page_id, array_to_string(hrefs, '|') AS hrefs, array_to_string(texts, '|') AS texts FROM nav""")
def c7_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.parse_nodes(table(spark, sf_dir, "pages"), [N.Test("nav"), N.Test("a"), N.Test(N.TEXT)], ["page_id"])
    nodes = N.ALL
    return docs.select(
        "page_id", F.array_join(N.values(N.select(nodes, N.Test("a")), "href"), "|").alias("hrefs"),
        F.array_join(N.texts_under(nodes, N.Test("nav")), "|").alias("texts"))


@check("c8_pick", f"""
WITH {NAV} SELECT page_id, hrefs[1] AS first, hrefs[2] AS second, hrefs[-1] AS last, texts[9] AS ninth,
  array_to_string(hrefs[1:1], '|') AS head, array_to_string(hrefs[2:], '|') AS tail FROM nav""")
def c8_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs, texts = F.col("hrefs"), F.col("texts")
    nodes = N.ALL
    anchors = N.select(nodes, N.Test("a"))
    docs = nav_docs(spark, sf_dir).select("page_id", N.values(anchors, "href").alias("hrefs"), N.values(anchors).alias("texts"))
    return docs.select(
        "page_id", N.pick(hrefs, 0).alias("first"), N.pick(hrefs, 1).alias("second"), N.pick(hrefs, -1).alias("last"),
        N.pick(texts, 8).alias("ninth"), F.array_join(F.slice(hrefs, 1, 1), "|").alias("head"),
        F.array_join(F.slice(hrefs, F.lit(2), F.size(hrefs)), "|").alias("tail"))


@check("c9_zip", f"""
WITH {NAV} SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, hrefs[i] AS href, texts[1:3][i] AS text
FROM (SELECT page_id, hrefs, texts, unnest(range(1, len(hrefs) + 1)) AS i FROM nav)""")
def c9_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchors = N.select(N.ALL, N.Test("a"))
    docs = nav_docs(spark, sf_dir).select("page_id", N.values(anchors, "href").alias("hrefs"),
                                          F.slice(N.values(anchors), 1, 3).alias("texts"))
    return N.zip_explode(docs, href="hrefs", text="texts").select(
        "page_id", F.col("pos").cast(LONG).alias("pos"), "href", "text")


@check("c10_breadcrumb", f"""
WITH {NAV} SELECT page_id,
  array_to_string(CASE WHEN contains(lower(texts[2]), 'home') THEN texts[4:5] ELSE texts[3:4] END, '|') AS path,
  array_to_string(list_concat(['x', 'Home'], texts)[4:5], '|') AS home_path
FROM nav""")
def c10_breadcrumb(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.col("texts")
    docs = nav_docs(spark, sf_dir).select("page_id", N.values(N.select(N.ALL, N.Test("a"))).alias("texts"))
    with_home = F.concat(F.array(F.lit("x"), F.lit("Home")), texts)
    return docs.select("page_id", F.array_join(breadcrumb(texts), "|").alias("path"),
                       F.array_join(breadcrumb(with_home), "|").alias("home_path"))


@check("c11_script_var", """
SELECT page_id, regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS track, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang
FROM pages""")
def c11_script_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.parse_nodes(table(spark, sf_dir, "pages"), [], ["page_id"], with_html=True)
    html = F.col("norm_html")
    return docs.select("page_id", script_var(html, "missing\\((.*)\\)", "track\\(([0-9]+)\\)").alias("track"),
                       script_var(html, "lang=\"([a-z]+)\"").alias("lang"))
