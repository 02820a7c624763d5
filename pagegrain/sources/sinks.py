"""Result tables. Each write replaces the run's output.

Rows are rebalanced on the partition column first, or dealt by ranges: small partitions share files, and a partition value that
holds a large part of the rows is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: headers of the published files
OFFER_HEADER = ("Store Name", "Cash Back", "Url", "Category")
JOB_TITLE_HEADER = ("Job Title", "Description")
JOB_FULL_HEADER = ("JOB TITLE", "JOB ID", "JOB LOCATION", "JOB SUMMARY", "JOB REQUIREMENTS")
OFFER_FIELDS = ("store_name", "cash_back", "url", "category")


def write_offers(offers: DataFrame, path: str, compat_header: bool = False) -> None:
    """Offers as CSV by site. With ``compat_header`` the published column titles and a fifth, empty column."""
    out = offers.select(*OFFER_FIELDS, "site")
    if compat_header:
        titles = [F.col(c).alias(t) for c, t in zip(OFFER_FIELDS, OFFER_HEADER)]
        out = offers.select(*titles, F.lit("").alias("_"), "site")
    (out.hint("rebalance", "site").write.mode("overwrite").partitionBy("site")
        .option("header", True).option("escape", '"').option("emptyValue", "").csv(path))


def write_jobs(jobs: DataFrame, path: str, full: bool = True) -> None:
    """Jobs as CSV, five columns or title and description; texts may span lines."""
    fields = ("job_title", "job_id", "job_location", "summary", "requirements") if full else ("job_title", "summary")
    header = JOB_FULL_HEADER if full else JOB_TITLE_HEADER
    out = jobs.select(*[F.col(c).alias(t) for c, t in zip(fields, header)])
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def read_csv(spark, path: str, schema: str) -> DataFrame:
    """Read back what the CSV sinks wrote."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
            .option("emptyValue", "").option("enforceSchema", True).csv(path))


def write_products(products: DataFrame, path: str) -> None:
    """Nested products as parquet by country. Inside a country the files hold ranges of ``base_sku``, sorted and with Bloom filters, so that
    a lookup by key reads the row groups of one file."""
    (products.repartitionByRange("country_code", "base_sku").sortWithinPartitions("country_code", "base_sku").write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#base_sku", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("country_code").parquet(path))


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """Rows as a table whose files are buckets of ``keys``, sorted and with Bloom filters on the first key: tables with the same keys and number
    of buckets are joined and grouped on them without a shuffle."""
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet").option("path", path).option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)
