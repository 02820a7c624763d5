"""Fetched pages as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.functions.urls import site_of
from pagegrain.plans.offer_rules import RULES
from pagegrain.schemas import PAGES, conform

# fixed values: (site, host, url pattern, page type, body pattern); the first that fits decides, later rows are more general
PRODUCT_ROUTES = (
    ("brassring", "sjobs.brassring.com", "/jobdetails\\.aspx", "detail"),
    ("brassring", "sjobs.brassring.com", "", "listing"),
    ("pentair", "careers.pentair.com", "", "listing", "POSTINGTITLE\\$"),
    ("pentair", "careers.pentair.com", "", "detail"),
    ("evitamins", "evitamins.com", "/viewalldepartments", "brands"),
    ("evitamins", "evitamins.com", "/viewitems\\?", "listing"),
    ("evitamins", "evitamins.com", "", "detail"),
    ("intermix", "intermixonline.com", "/home\\.do", "home"),
    ("intermix", "intermixonline.com", "/(categoryproductviewall|trendlooksandproducts)\\.do|[?&]page=", "listing"),
    ("intermix", "intermixonline.com", "", "detail"),
    ("toryburch", "toryburch.com", "format=json", "variants"),
    ("toryburch", "toryburch.com", "/international-shipping", "countries"),
    ("toryburch", "toryburch.com", "", "listing", "class=[\"']product producttile"),
    ("toryburch", "toryburch.com", "[0-9]{8}|\\.html|/dwvar_", "detail"),
    ("toryburch", "toryburch.com", "", "listing"),
    ("toryburch", "toryburch.jp", "/ajax_input_color/", "sizes"),
    ("toryburch", "toryburch.jp", "shop_product_id/", "detail"),
    ("toryburch", "toryburch.jp", "", "listing"),
    ("intermix", "intermix.scene7.com", "req=imageset", "images"),
    ("toryburch", "scene7.com", "req=imageset", "images"),
)
OFFER_ROUTES = tuple((r.site, h, "", "detail" if r.custom == "best" else "listing") for r in RULES for h in r.hosts)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages table in its declared schema; site and the other missing columns are filled in."""
    raw = spark.read.parquet(path)
    pages = conform(raw, PAGES)
    return pages.withColumn("site", F.coalesce("site", site_of(F.col("url"))))


def _host_is(site_host: Column, host: str) -> Column:
    return (site_host == host) | F.endswith(site_host, F.lit("." + host))


def route_pages(pages: DataFrame, routes: tuple = OFFER_ROUTES + PRODUCT_ROUTES) -> DataFrame:
    """Set ``site`` and ``page_type`` from the url, or from the body where the url cannot tell: which job reads the page. One
    expression, no per-row dispatch.

    A page type that the pages bring along (from the request that asked for them) stays. A page no route fits keeps its host as site and
    the type ``other``.
    """
    name = site_of(F.col("url"))
    route = F
    for site, host, pattern, kind, *body in routes:
        if body and "html" not in pages.columns:
            continue
        fits = _host_is(name, host)
        fits = fits & F.col("url").rlike(pattern) if pattern else fits
        fits = fits & F.coalesce(F.col("html").rlike(body[0]), F.lit(False)) if body else fits
        route = route.when(fits, F.struct(F.lit(site).alias("site"), F.lit(kind).alias("page_type")))
    route = route.otherwise(F.struct(name.alias("site"), F.lit("other").alias("page_type")))
    rest = [c for c in pages.columns if c not in ("site", "page_type")]
    known = F.col("page_type") if "page_type" in pages.columns else F.lit(None).cast("string")
    return pages.select(*rest, known.alias("__known"), route.alias("__route")).select(
        *rest, "__route.site", F.coalesce("__known", "__route.page_type").alias("page_type"))
