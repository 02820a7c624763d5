"""Rows that could not be read are kept, with the reason, instead of lost."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagegrain.operators.sets import staged


def reject_rows(df: DataFrame, page_id: str, url: str, checks: dict[str, Column], reason: Column | None = None) -> DataFrame:
    """One row per failed check: page_id, url, stage, reason. One pass, no shuffle."""
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(stage)) for stage, bad in checks.items()]))
    why = F.lit("not found or not readable") if reason is None else reason
    return df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.explode(failed).alias("stage"), why.alias("reason"))


def with_failed(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df`` with ``failed``: the names of the checks that a row does not pass."""
    return df.withColumn("failed", F.array_compact(F.array(*[F.when(bad, F.lit(stage)) for stage, bad in checks.items()])))


def with_rejects(df: DataFrame, page_id: str, url: str, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every check, reject rows of the others)."""
    judged = with_failed(df, checks)
    return judged.where(F.size("failed") == 0).drop("failed"), reject_rows(df, page_id, url, checks)


class Facts:
    """What the pages of a job say, by kind, as written tables that good rows and rejects are both read from.

    Every row has ``failed`` (see ``with_failed``) and ``row_id``, which is unique in its table. ``counts`` tells per kind how many rows were
    read, good and rejected: observed while the tables were written.
    """

    def __init__(self, kinds: dict[str, DataFrame], path: str):
        seen = {kind: Observation(kind) for kind in kinds}

        def write(kind: str) -> DataFrame:
            passed = F.size("failed") == 0
            rows = kinds[kind].withColumn("row_id", F.monotonically_increasing_id()).observe(
                seen[kind], F.count(F.lit(1)).alias("read"), F.count_if(passed).alias("good"), F.count_if(~passed).alias("rejected"))
            return staged(rows, f"{path}/{kind}")

        # the kinds are read side by side
        with ThreadPoolExecutor(len(kinds)) as pool:
            self.tables = dict(zip(kinds, pool.map(write, kinds)))
        self.counts = {kind: o.get for kind, o in seen.items()}

    def good(self, kind: str) -> DataFrame:
        return self.tables[kind].where(F.size("failed") == 0).drop("failed")

    def rejects(self) -> DataFrame:
        """One row per failed check: page_id, url, stage, reason."""
        out = None
        for table in self.tables.values():
            rows = table.select("page_id", "url", F.explode("failed").alias("stage")).withColumn("reason", F.lit("not found or not readable"))
            out = rows if out is None else out.unionByName(rows)
        return out


def kept_row(condition: Column, columns: list[str]) -> Column:
    """``columns`` as a generated row ``__row`` where the condition holds."""
    return F.explode(F.when(condition, F.array(F.struct(*columns)))).alias("__row")


def keep_where(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Filter on computed columns without computing them twice.

    A plain filter would be pushed below the projections and repeat their regex chains there; a generated row
    stays behind them.
    """
    return df.select(kept_row(condition, columns)).select("__row.*")
