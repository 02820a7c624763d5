"""Checks of the site jobs (family K) and the all-sites union (I3): pages are built from the tables, the job
reads them, and SQL takes the expected rows straight from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks import site_pages as S
from pagegrain.checks.base import check, dealt_parts
from pagegrain.plans import jobs, vitamins
from pagegrain.plans.offer_rules import BY_SITE
from pagegrain.plans.offers import extract_all_offers, extract_offers, offer_rejects
from pagegrain.session import scratch_path


def pages_of(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    if site == "giftcardgranny":
        return S.detail_pages(spark, sf_dir)
    return S.listing_pages(spark, sf_dir, site, S.RETAIL if site == "cardsnagger" else S.SHAPES[site])


def expected(site: str) -> str:
    if site == "giftcardgranny":
        return S.EXPECTED_BEST
    return S.EXPECTED_RETAIL if site == "cardsnagger" else S.expected(site, S.SHAPES[site])


def _register(site: str) -> None:
    @check(f"k_{site}", expected(site))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return extract_offers(pages_of(spark, sf_dir, site), [BY_SITE[site]])


for _site in BY_SITE:
    _register(_site)


@check("i3_all_sites", " UNION ALL ".join(f"({expected(s)})" for s in BY_SITE))
def i3_all_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = reduce(DataFrame.unionByName, [pages_of(spark, sf_dir, s) for s in BY_SITE])
    return extract_all_offers(pages, scratch_path(spark, "blocks"))


@check("n1_offer_rejects", """
SELECT CAST(floor(p_partkey / 40) AS BIGINT) AS page_id, 'http://cardpool.example/' || CAST(floor(p_partkey / 40) AS BIGINT) AS url,
  stage, 'not found or not readable' AS reason FROM part, unnest(['name', 'stock']) AS t(stage) WHERE p_partkey % 7 = 0""")
def n1_offer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks without the parenthesised stock: neither name nor stock can be read."""
    shape = S.SHAPES["cardpool"]
    broken = S.Shape(shape.open, shape.block, shape.close, shape.url, bare=shape.bare.replace("({s})", ""))
    return offer_rejects(S.listing_pages(spark, sf_dir, "cardpool", broken), [BY_SITE["cardpool"]])


@check("k_brassring", """
SELECT 'detail' AS kind, p_name || ' ' || p_partkey AS title, p_type || p_brand AS text FROM part
UNION ALL SELECT 'link', 'https://sjobs.brassring.com/TGWebHost/jobdetails.aspx?id=' || p_partkey || '&x=' || p_size, '' FROM part WHERE p_partkey % 3 = 0""")
def k_brassring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = dealt_parts(spark, sf_dir)
    detail = F.concat(F.lit("<p><span id='Job Abbreviation Title' class=x>"), "p_name", F.lit(" "), "p_partkey",
                      F.lit("</span><span id='Job Description'>"), "p_type", F.lit("<br/>"), "p_brand", F.lit("</span>"))
    listing = F.concat(F.when(F.col("p_partkey") % 3 == 0, "<h1>Search results</h1>").otherwise(""),
                       F.lit("<a href=jobdetails.aspx?id="), "p_partkey", F.lit("&amp;x="), "p_size", F.lit(">go</a>"))
    pages = part.select(F.col("p_partkey").alias("page_id"), F.lit("detail").alias("page_type"), F.lit("u").alias("url"), detail.alias("html")).unionByName(
        part.select(F.col("p_partkey").alias("page_id"), F.lit("listing").alias("page_type"), F.lit("u").alias("url"), listing.alias("html")))
    found = jobs.brassring_jobs(pages).select(F.lit("detail").alias("kind"), F.col("job_title").alias("title"), F.col("summary").alias("text"))
    links = jobs.brassring_links(pages).select(F.lit("link").alias("kind"), F.col("url").alias("title"), F.lit("").alias("text"))
    return found.unionByName(links)


@check("k_pentair", """
SELECT p_name AS job_title, CAST(p_partkey AS VARCHAR) AS job_id, p_brand AS job_location,
  p_type || chr(10) || 'li ' || p_size || chr(10) || 'font' || chr(10) AS summary, 'needs ' || p_size || chr(10) AS requirements
FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey % 3 <> 0, p_partkey) AS rn FROM part) WHERE rn <= (p_partkey // 20) % 20""")
def k_pentair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of twenty parts that show only some of them, fetched twice; detail pages without a time arrive first, the
    others in part order."""
    return jobs.pentair_jobs(pentair_pages(spark, sf_dir)).select("job_title", "job_id", "job_location", "summary", "requirements")


def pentair_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = dealt_parts(spark, sf_dir)
    group = F.floor(F.col("p_partkey") / 20)
    listing_url = F.concat(F.lit("http://l.example/"), group)
    span = lambda marker, text: F.concat(F.lit(f'<div><span id="{marker}0">'), text, F.lit("</span></div>"))
    detail = F.concat(
        span(jobs.PENTAIR_FIELDS["job_id"], F.col("p_partkey").cast("string")), span(jobs.PENTAIR_FIELDS["job_title"], F.col("p_name")),
        span(jobs.PENTAIR_FIELDS["job_location"], F.col("p_brand")),
        F.lit('<div id="HRS_JO_PDSC_VW_DESCRLONG$2">skipped<div> '), "p_type", F.lit(" </div><ul><li>li "), F.col("p_size").cast("string"),
        F.lit("</li></ul><p><span><font>font</font><em>skipped</em></span></p></div>"
              '<div id="HRS_JO_PDSC_VW_DESCRLONG$3"><p>needs '), F.col("p_size").cast("string"), F.lit("</p></div>"))
    details = part.select(
        F.col("p_partkey").alias("page_id"), F.lit("detail").alias("page_type"), F.concat(F.lit("http://d.example/"), "p_partkey").alias("url"),
        listing_url.alias("referer"), F.when(F.col("p_partkey") % 3 != 0, F.timestamp_seconds("p_partkey")).alias("fetched_at"), detail.alias("html"))
    shown = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.when(
        i <= F.col("g") % 20, F.concat(F.lit('<div><span><a id="POSTINGTITLE$'), i.cast("string"), F.lit('">x</a></span></div>'))).otherwise(""))
    listings = part.select(group.alias("g")).distinct().select(
        F.col("g").alias("page_id"), F.lit("listing").alias("page_type"), F.concat(F.lit("http://l.example/"), "g").alias("url"),
        F.lit("").alias("referer"), F.timestamp_seconds(F.lit(0)).alias("fetched_at"), F.array_join(shown, "").alias("html"))
    earlier = listings.withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn("html", F.lit('<a id="POSTINGTITLE$1">x</a>'))
    return details.unionByName(listings).unionByName(earlier)


@check("n1_job_rejects", """
SELECT p_partkey AS page_id, 'brassring' AS job, stage FROM part, unnest(['title', 'description']) AS t(stage)
WHERE CASE stage WHEN 'title' THEN p_partkey % 2 = 0 ELSE p_partkey % 3 = 0 END
UNION ALL SELECT p_partkey, 'pentair', 'listing' FROM part WHERE (p_partkey // 20) % 4 = 0""")
def n1_job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brassring pages without title or description, pentair pages whose listing is missing."""
    key = F.col("p_partkey")
    html = F.concat(F.when(key % 2 != 0, "<span id='Job Abbreviation Title'>t</span>").otherwise(""), F.when(key % 3 != 0, "<span id='Job Description'>d</span>").otherwise(""))
    brass = dealt_parts(spark, sf_dir).select(key.alias("page_id"), F.lit("detail").alias("page_type"), F.lit("u").alias("url"), html.alias("html"))
    pages = pentair_pages(spark, sf_dir)
    pages = pages.where((F.col("page_type") == "detail") | (F.col("page_id") % 4 != 0))
    return jobs.brassring_rejects(brass).withColumn("job", F.lit("brassring")).unionByName(
        jobs.pentair_rejects(pages).withColumn("job", F.lit("pentair"))).select("page_id", "job", "stage")


@check("n1_vitamin_rejects", """
SELECT p_partkey AS page_id, 'title' AS stage, false AS good FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, NULL, true FROM part WHERE p_partkey % 3 <> 0""")
def n1_vitamin_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplement pages without a title, and the pages that have one, from one reading."""
    title = F.concat(F.lit('<table><tr><td valign="top"><h1 class="h1productHead">'), "p_name", F.lit("</h1></td></tr></table>"))
    html = F.when(F.col("p_partkey") % 3 == 0, F.lit("<p>gone</p>")).otherwise(title)
    pages = dealt_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), F.lit("detail").alias("page_type"), F.lit("http://e.example/").alias("url"), html.alias("html"))
    read = vitamins.read(pages)
    return read.rejects().select("page_id", "stage", F.lit(False).alias("good")).unionByName(
        read.good("detail").select("page_id", F.lit(None).cast("string").alias("stage"), F.lit(True).alias("good")))


@check("k_evitamins", """
SELECT p_partkey AS page_id, p_name AS title, p_brand AS brand, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'None' END AS flavor,
  CAST(p_size AS VARCHAR) AS size, 'Tablets' AS unit, 'U' || p_partkey AS upc, '$' || p_retailprice AS price, 'http://i.example/' || p_partkey AS image_url
FROM part""")
def k_evitamins(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    html = F.concat(
        F.lit('<table><tr><td valign="top"><div><h1 class="h1productHead">'), "p_brand", F.lit(" "), "p_name",
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(", "), "p_type")).otherwise(""),
        F.lit('</h1></div><span><a href="http://i.example/'), text("p_partkey"), F.lit('">img</a></span><table><tr><td><a style="text-decoration:none">'),
        "p_brand", F.lit("</a></td></tr><tr><td><strong>Selected Size:</strong> "), text("p_size"), F.lit(" Tablets</td></tr><tr><td>"
              '<span class="size1"><span itemprop="id">U'), text("p_partkey"), F.lit('</span></span><span itemprop="price">\n$'), text("p_retailprice"),
        F.lit("\n</span></td></tr></table></td></tr></table>"))
    pages = dealt_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), F.lit("detail").alias("page_type"), F.lit("http://e.example/").alias("url"), html.alias("html"))
    return vitamins.vitamin_products(pages).drop("url")
