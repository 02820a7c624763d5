"""Job postings: search results and detail pages to one jobs table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegrain.functions import text as X
from pagegrain.operators import nodes as N
from pagegrain.operators.filters import is_result_page
from pagegrain.operators.frontier import detail_links
from pagegrain.operators.quality import Facts, keep_where, reject_rows, with_failed
from pagegrain.operators.windows import first_n, newest
from pagegrain.schemas import JOBS, conform
from pagegrain.session import scratch_path

# fixed values: url base, link pattern and the markers of the two job sites
BRASSRING_BASE = "https://sjobs.brassring.com/TGWebHost/"
BRASSRING_LINK = "href=(jobdetails.aspx.*?)>"
BRASSRING_TITLE = "id='Job Abbreviation Title'.*?</span>"
BRASSRING_TEXT = "id='Job Description'.*?</span>"
PENTAIR_FIELDS = {
    "job_id": "HRS_JO_WRK_HRS_JOB_OPENING_ID$",
    "job_title": "HRS_JO_WRK_POSTING_TITLE$",
    "job_location": "HRS_CE_WRK2_HRS_CE_JO_LCTNS$",
}
PENTAIR_TEXTS = {"summary": "HRS_JO_PDSC_VW_DESCRLONG$2", "requirements": "HRS_JO_PDSC_VW_DESCRLONG$3"}
PENTAIR_POSTING = "POSTINGTITLE$"
# tag paths below the text box whose own texts count
PENTAIR_PATHS = "(^|/)(div|p|li|p/(.+/)?span|li/(.+/)?span|p/(.+/)?span/(.+/)?font|p/(.+/)?span/strong|p/strong)/text\\(\\)$"


def brassring_links(pages: DataFrame) -> DataFrame:
    """Detail urls of the result pages, from the raw body: page_id, link_pos, url."""
    results = pages.where((F.col("page_type") == "listing") & is_result_page(F.col("html")))
    found = detail_links(results.select("page_id", "html"), "html", BRASSRING_LINK)
    return found.select("page_id", "link_pos", F.concat(
        F.lit(BRASSRING_BASE), X.replace_all(F.col("link"), "amp;")).alias("url"))


def _span_text(pattern: str) -> Column:
    body = X.find(X.find(F.col("html"), pattern), ">.*?</span>")
    return X.drop_prefix(X.replace_all(body, "</span>"), ">")


def _brassring_details(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page_type") == "detail").select(
        "page_id", "url", F.lit("brassring").alias("site"), _span_text(BRASSRING_TITLE).alias("job_title"),
        X.replace_all(_span_text(BRASSRING_TEXT), "<br/>").alias("summary"))


def brassring_jobs(pages: DataFrame) -> DataFrame:
    """Title and description of the detail pages. Stays in the JVM: the body is read as it came."""
    detail = _brassring_details(pages)
    good = keep_where(detail, F.col("job_title").isNotNull() & F.col("summary").isNotNull(), detail.columns)
    return conform(good, JOBS)


def brassring_facts(pages: DataFrame, staging: str | None = None) -> Facts:
    """The details as a written table: jobs and rejects from one reading of the pages."""
    checks = {"title": F.col("job_title").isNull(), "description": F.col("summary").isNull()}
    return Facts({"detail": with_failed(_brassring_details(pages), checks)}, staging or scratch_path(pages.sparkSession, "facts"))


def brassring_rejects(pages: DataFrame, staging: str | None = None) -> DataFrame:
    """Detail pages without title or description: page_id, url, stage, reason."""
    return brassring_facts(pages, staging).rejects()


def _pentair_tests() -> list[N.Test]:
    spans = [N.Test("span", "id", "starts", v) for v in PENTAIR_FIELDS.values()]
    boxes = [N.Test("div", "id", "starts", v, path=True) for v in PENTAIR_TEXTS.values()]
    return [*spans, *boxes, N.Test(N.TEXT, path=True)]


def _box_text(marker: str) -> Column:
    """Texts of a box on the allowed tag paths, in document order, one per line."""
    nodes = N.tested(_pentair_tests())
    box = N.select(nodes, N.Test("div", "id", "starts", marker))
    below = f"substr(t.path, length(b.path) + 2) RLIKE {N.literal(PENTAIR_PATHS)}"
    inside = f"filter({N.select(nodes, N.Test(N.TEXT))}, t -> exists(box, b -> t.pre > b.pre AND t.pre <= b.end AND {below}))"
    return X.join_text(N.values(N.Nodes(N.let(box, "box", inside))))


def pentair_counts(pages: DataFrame) -> DataFrame:
    """Postings that each listing page shows: referer (the listing's url), page_id, fetched_at, total."""
    posting = N.Test("a", "id", "starts", PENTAIR_POSTING)
    listings = N.parse_nodes(pages.where(F.col("page_type") == "listing"), [posting], ["url", "page_id", "fetched_at"])
    return listings.select(F.col("url").alias("referer"), "page_id", "fetched_at", N.count(N.select(N.ALL, posting)).alias("total"))


def _pentair_totals(pages: DataFrame) -> DataFrame:
    """Postings that each listing shows, by its newest page: referer, total."""
    return newest(pentair_counts(pages), ["referer"]).drop("page_id", "fetched_at")


def pentair_rejects(pages: DataFrame) -> DataFrame:
    """Detail pages whose listing is not among the pages: page_id, url, stage, reason. Nothing is parsed for them."""
    listings = pages.where(F.col("page_type") == "listing").select(F.col("url").alias("referer")).distinct()
    lost = pages.where(F.col("page_type") == "detail").select("page_id", "url", "referer").join(listings, "referer", "left_anti")
    return reject_rows(lost, "page_id", "url", {"listing": F.lit(True)})


def pentair_details(pages: DataFrame) -> DataFrame:
    """The five fields of every detail page, with page_id, referer and fetched_at."""
    nodes = N.tested(_pentair_tests())
    docs = N.parse_nodes(pages.where(F.col("page_type") == "detail"), _pentair_tests(), ["page_id", "referer", "fetched_at"], marked=True)
    fields = [
        F.get(N.own_texts(nodes, N.Test("span", "id", "starts", marker)), F.lit(0)).alias(name)
        for name, marker in PENTAIR_FIELDS.items()
    ]
    return docs.select("page_id", "referer", "fetched_at", *fields, *[_box_text(m).alias(k) for k, m in PENTAIR_TEXTS.items()])


def pentair_jobs(pages: DataFrame) -> DataFrame:
    """Five fields of the detail pages, at most as many per listing as the listing shows postings.

    A detail page names its listing in ``referer``; which pages count is decided by arrival
    (``fetched_at, page_id``).
    """
    return pentair_kept(pentair_details(pages).join(_pentair_totals(pages), "referer"))


def pentair_kept(counted: DataFrame) -> DataFrame:
    """The first details of each listing, as many as its ``total``, as jobs."""
    kept = first_n(counted, ["referer"], ["fetched_at", "page_id"], F.col("total"),
                   bucket=F.date_trunc("minute", "fetched_at"))
    return conform(kept.withColumn("site", F.lit("pentair")), JOBS)
