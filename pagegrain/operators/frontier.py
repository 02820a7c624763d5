"""Which urls to visit next, as tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.functions import text as X
from pagegrain.functions.price import first_digits
from pagegrain.functions.urls import canonical, host
from pagegrain.operators.quality import reject_rows
from pagegrain.sources.sinks import write_bucketed

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def letter_list(digit_token: Column, upper: Column) -> Column:
    """A site's digit token and the 26 letters in its case."""
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    return F.concat(F.array(digit_token), F.when(upper, letters).otherwise(F.transform(letters, F.lower)))


def letter_urls(sites: DataFrame) -> DataFrame:
    """Rows (site, base, digit_token, upper) to one url per letter. No join: the letters are an array."""
    letters = letter_list(F.col("digit_token"), F.col("upper"))
    return sites.select("site", "base", F.posexplode(letters).alias("pos", "letter")).select(
        "site", "letter", F.concat("base", "letter").alias("url"))


#: Pages of an inner range; the outer one has as many entries less.
RANGE = 1000


def page_rows(df: DataFrame, last: Column, most: int | None = None, page: str = "page") -> DataFrame:
    """``df`` with one row per page 1..last; none where the number is unknown, below one, or above ``most``.

    Pages come from two nested ranges, so no list is as long as a number that some link happens to show. What ``most`` leaves out is
    told by ``page_rejects``.
    """
    last = last.cast("bigint")
    likely = last >= 1 if most is None else (last >= 1) & (last <= most)
    blocks = F.when(likely, F.sequence(F.lit(0).cast("bigint"), F.floor((last - 1) / RANGE)))
    # a row's generated rows are buffered until the next operator that is not fused with it: the sort of the few blocks is one
    cut = df.select("*", last.alias("__last"), F.explode(blocks).alias("__block")).sortWithinPartitions("__block")
    start = F.col("__block") * RANGE
    inside = F.sequence(start + 1, F.least(start + RANGE, F.col("__last")))
    return cut.select(*df.columns, F.explode(inside).alias("__page")).select(*df.columns, F.col("__page").cast("int").alias(page))


def page_rejects(df: DataFrame, page_id: str, url: str, last: Column, most: int) -> DataFrame:
    """Pagers whose last page is above ``most``: page_id, url, stage, and the number as the reason."""
    told = df.withColumn("__last", last.cast("bigint"))
    return reject_rows(told, page_id, url, {"pages": F.col("__last") > most}, F.concat(F.col("__last").cast("string"), F.lit(" pages")))


def last_page(pager: Column, rule: str) -> Column:
    """Last page number of a pager given as its texts or links.

    ``last``: last text; ``first``: digits of the first text; ``page=``: second link from the end;
    ``pg=``: third link from the end.
    """
    if rule == "last":
        return F.try_element_at(pager, F.lit(-1)).try_cast("bigint")
    if rule == "first":
        return first_digits(F.get(pager, F.lit(0)))
    from_end = {"page=": -2, "pg=": -3}[rule]
    return X.group(F.try_element_at(pager, F.lit(from_end)), rule + "(.*?)$").try_cast("bigint")


def page_urls_known(pagers: DataFrame, base: Column, pager: Column, rule: str, most: int | None = None) -> DataFrame:
    """One url per page 1..last of each pager; see ``page_rows``."""
    return page_rows(pagers, last_page(pager, rule), most).withColumn("url", F.concat(base, F.col("page").cast("string")))


# fixed values: pages asked per kind of overview, and jobs asked for, where the page does not tell how many there are
PAGES_PER_KIND = {"grid": 10, "directory": 13, "report": 9, "looks": 1}
ASSUMED_JOBS, JOBS_PER_PAGE = 199, 50


def shown_pages(body: Column) -> Column:
    """Largest page number that the links of a page ask for; null when it has no such link."""
    numbers = F.regexp_extract_all(body, F.lit("(?i)[?&](?:amp;)?page=([0-9]+)"), F.lit(1))
    return F.array_max(F.transform(numbers, lambda x: x.try_cast("bigint")))


def page_count(kind: Column, shown: Column | None = None, assumed: dict[str, int] | None = None) -> Column:
    """Pages of an overview: as many as it shows, and at least what is assumed for its kind, since a pager may show a part only."""
    count = F
    for name, n in (PAGES_PER_KIND if assumed is None else assumed).items():
        count = count.when(kind == name, n)
    return count if shown is None else F.greatest(shown, count)


def page_urls_fixed(categories: DataFrame, kind: Column, base: Column, shown: Column | None = None,
                    assumed: dict[str, int] | None = None, most: int | None = None) -> DataFrame:
    """One url per page of an overview; see ``page_count`` and ``page_rows``."""
    return page_rows(categories, page_count(kind, shown, assumed), most).withColumn("url", F.concat(base, F.lit("&page="), F.col("page").cast("string")))


def job_offsets(total: Column | None = None, step: int = JOBS_PER_PAGE, assumed: int = ASSUMED_JOBS) -> Column:
    """First job of every result page: of all ``total`` jobs where the search tells them, else of ``assumed``."""
    last = F.lit(assumed) if total is None else F.coalesce(total, F.lit(assumed))
    return F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(step))


def pages_from_links(links: Column, page_pattern: str = ".*?page=") -> Column:
    """Distinct links in order, with a synthesised page 1 in front; empty without links."""
    ordered = F.array_sort(F.array_distinct(links))
    first = F.concat(X.find(F.get(ordered, F.lit(0)), page_pattern), F.lit("1"))
    return F.when(F.size(links) > 0, F.concat(F.array(first), ordered)).otherwise(F.array().cast("array<string>"))


def detail_links(blocks: DataFrame, block: str = "block", pattern: str = 'href="(.*?)"',
                 distinct: bool = False) -> DataFrame:
    """Every link in the blocks; ``distinct`` keeps each once per block."""
    links = F.regexp_extract_all(F.col(block), F.lit(X.ANY_CASE + pattern), F.lit(1))
    links = F.array_distinct(links) if distinct else links
    rest = [c for c in blocks.columns if c != block]
    return blocks.select(*rest, F.posexplode(links).alias("link_pos", "link"))


def domain_suffixes(name: Column) -> Column:
    """A host and its parent domains: ``a.b.c`` gives ``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(name, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def allowed_only(urls: DataFrame, domains: Iterable[str], url: str = "url") -> DataFrame:
    """Urls whose host is an allowed domain or below one. The domain list is part of the job, not data."""
    allowed = F.array(*[F.lit(d) for d in domains])
    return urls.where(F.arrays_overlap(domain_suffixes(host(F.col(url))), allowed))


def allowed_by_table(urls: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """As ``allowed_only`` with the domains in a table: an equi semi-join on the exploded suffixes.

    Suffixes are joined for the distinct hosts only, of which there are far fewer than urls.
    """
    named = urls.withColumn("__host", host(F.col(url)))
    hosts = named.select("__host").where(F.col("__host").isNotNull()).distinct()
    good = hosts.select("__host", F.explode(domain_suffixes(F.col("__host"))).alias("domain")).join(
        domains.select("domain"), "domain", "left_semi").select("__host").distinct()
    return named.join(good, "__host", "left_semi").drop("__host")


def dedup_requests(requests: DataFrame, url: str = "url", keep_all: str = "dont_filter") -> DataFrame:
    """One request per canonical url, except those marked to be repeated. Which of the equal ones stays is the
    smallest, so that the result does not depend on the order of arrival. A missing mark counts as false."""
    columns = [c for c in requests.columns if c != url]
    repeated = F.coalesce(keep_all, F.lit(False))
    free = requests.where(repeated)
    once = requests.where(~repeated).groupBy(canonical(F.col(url)).alias("__key")).agg(
        F.min(F.struct(url, *columns)).alias("r")).select("r.*")
    return free.unionByName(once)


def unseen(requests: DataFrame, seen: DataFrame | None, url: str = "url", keep_all: str = "dont_filter") -> DataFrame:
    """The requests that no earlier round of the crawl had, and those marked to be repeated, with their canonical url as ``seen_key``.

    ``seen`` has the ``seen_key`` of all earlier rounds, in a table bucketed by it (see ``remember``): only the new requests are shuffled. Requests
    without url are none.
    """
    once = dedup_requests(requests.where(F.col(url).isNotNull()), url, keep_all).withColumn("seen_key", canonical(F.col(url)))
    if seen is None:
        return once
    marked, free = F.coalesce(keep_all, F.lit(False)), once
    fresh = free.where(~marked).join(seen.select("seen_key").hint("merge"), "seen_key", "left_anti")
    return fresh.select(*once.columns).unionByName(free.where(marked))


def remember(fresh: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Adds the ``seen_key`` of a round's requests (a written table) to the table of seen urls, which is returned. The table has files by
    bucket of the key, sorted, with Bloom filters; a key that is marked to be repeated may be in it more than once."""
    return write_bucketed(fresh.select("seen_key").distinct(), name, path, ["seen_key"], buckets, "append")


def country_requests(spark: SparkSession, dims: DataFrame, start: str, allowed: Iterable[str] | None,
                     fallback: tuple[str, str, str]) -> DataFrame:
    """Start requests (country_code, currency, language, url) of the allowed countries; None allows all.

    ``fallback`` is added when its country is missing. ``dims`` is a country dimension: a few hundred rows.
    """
    chosen = dims if allowed is None else dims.where(F.lower("country_code").isin(list(allowed)))
    wanted = chosen.select(
        F.lower("country_code").alias("country_code"), "currency", "language", F.lit(start).alias("url"))
    spare = spark.createDataFrame([fallback + (start,)], wanted.schema)
    return wanted.unionByName(spare.join(wanted.select("country_code"), "country_code", "left_anti")
                              .select(*wanted.columns))


def category_links(entries: DataFrame, categories: Iterable[str], category: str = "category",
                   label: str = "label") -> DataFrame:
    """Menu entries of the site's categories with the position of the category in its list."""
    order = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(category))
    return entries.where(order > 0).withColumn("category_pos", order.cast("int")).where(
        ~F.contains(F.lower(F.col(label)), F.lit("home")))
