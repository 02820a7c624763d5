"""Helpers shared by the training-data operators."""

from __future__ import annotations

import importlib
import math
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.session import remove, scratch_path


def ship(name: str) -> None:
    """Send the module's functions with the task, so executors need no installed package."""
    cloudpickle.register_pickle_by_value(importlib.import_module(name))


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows from a table in the cluster's shared folder: cuts the lineage and fixes every computed value."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that no result reads any more."""
    for t in tables:
        remove(t.sparkSession, t.written_path)


def let(value: str, name: str, body: str) -> str:
    """SQL text that evaluates ``value`` once and names it in ``body``; a plain column would be evaluated per element inside lambdas."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def process_tables() -> dict:
    """Tables that live as long as the Python worker does, whatever task it runs."""
    return sys.modules.setdefault("_pagegrain_llm_tables", types.ModuleType("_pagegrain_llm_tables")).__dict__


class ChunkTable(dict):
    """Results by chunk, computed once each while they are kept.

    At most about ``most`` entries in two generations: when the young one is full it becomes the old one, and what is used again
    comes back from there. So frequent chunks stay, and memory is bounded.
    """

    def __init__(self, make: Callable[[str], object], most: int):
        super().__init__()
        self.make, self.half, self.old = make, most // 2, {}

    def __missing__(self, key: str):
        self.turned()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turned(self) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()

    def many(self, keys: list[str]) -> list:
        """The results of distinct keys."""
        self.turned()
        out = list(map(self.get, keys))
        make, old = self.make, self.old
        for i, value in enumerate(out):
            if value is None:
                key = keys[i]
                value = old.get(key)
                if value is None:
                    value = make(key)
                out[i] = self[key] = value
        return out


def ranked(df: DataFrame, group: str, priority: Column, order: list[str], rows: int, rows_per_bucket: int = 128) -> DataFrame:
    """``df`` with ``__rank``: the exact position from 0 inside ``group``, by hash bucket of ``priority``, then ``order``.

    A group is cut into buckets whose number grows with the table, so the hottest group is ranked by many tasks; the positions before
    each bucket are sums over blocks of buckets, and over the buckets inside a block, so no window sees more than about the square root
    of the buckets. ``df`` must give the same rows when read twice.
    """
    buckets = max(1, rows // rows_per_bucket)
    width = math.isqrt(buckets - 1) + 1
    marked = df.withColumn("__bucket", F.pmod(priority, F.lit(buckets)))
    counts = (marked.groupBy(F.col(group).alias("__g"), F.col("__bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__block", F.floor(F.col("__b") / width)))

    def before(order: str, *part: str) -> Column:
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(w), F.lit(0))

    blocks = (counts.groupBy(F.col("__g").alias("__h"), F.col("__block").alias("__k")).agg(F.sum("__n").alias("__n"))
              .select("__h", "__k", before("__k", "__h").alias("__above")))
    sums = (counts.withColumn("__below", before("__b", "__g", "__block")).join(blocks, (F.col("__g") == F.col("__h")) & (F.col("__block") == F.col("__k")))
            .select("__g", "__b", (F.col("__above") + F.col("__below")).alias("__before")))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    return (marked.withColumn("__in", F.row_number().over(inside))
            .join(sums, (F.col(group) == F.col("__g")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("__rank", F.col("__before") + F.col("__in") - 1)
            .drop("__bucket", "__b", "__g", "__before", "__in"))


def filled(rows: Iterator, most: int = 512) -> Iterator:
    """Arrow record batches that have rows, ``most`` at a time: what a step makes of long texts stays small."""
    return (batch.slice(at, most) for batch in rows for at in range(0, batch.num_rows, most))


def light(rows: Iterator, column: str, most: int = 2 << 20) -> Iterator:
    """Arrow record batches with so many bytes of text at most, or a single row."""
    for batch in filled(rows):
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def encoded(texts: pa.Array, apart: str, chunks: Callable[[list[str]], list[bytes]], whole: Callable[[str], bytes],
            first: Callable[[str], bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of ids of each; null texts are empty.

    Texts are cut at their spaces. Each distinct chunk of the batch is encoded once, and ids are joined back by position. Texts that match
    ``apart`` go through ``whole``; a text's first chunk goes through ``first``, where it is given.
    """
    texts = pc.fill_null(texts, "")
    plain = pc.and_(pc.invert(pc.match_substring_regex(texts, apart)), pc.not_equal(texts, ""))
    lists = pc.split_pattern(texts.filter(plain), " ")
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = flat.dictionary_encode()
    values = chunks(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if first is not None:
        heads = np.cumsum(sizes) - sizes
        codes[heads] = len(values) + np.arange(len(heads))
        values += [first(c) for c in flat.take(pa.array(heads)).to_pylist()]
    is_plain = plain.to_numpy(zero_copy_only=False)
    each = np.ones(len(texts), np.int64)  # chunks of each row
    each[is_plain] = sizes
    index, inside = np.empty(each.sum(), np.int64), np.repeat(is_plain, each)
    index[inside] = codes
    index[~inside] = len(values) + np.arange(len(texts) - len(sizes))
    values += [whole(t) for t in texts.filter(pc.invert(plain)).to_pylist()]
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
    starts = np.cumsum(lengths) - lengths
    pool = np.frombuffer(b"".join(values), "<u4")
    counts = lengths[index]
    stops = np.cumsum(counts)
    # batches are small: 32 bits are enough for places in them
    taken = np.repeat((starts[index] - (stops - counts)).astype(np.int32), counts)
    taken += np.arange(len(taken), dtype=np.int32)
    return pool[taken], np.add.reduceat(counts, np.cumsum(each) - each) if len(each) else counts


def ended(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's, and the stops of the texts with a zero in front."""
    stops = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(stops[-1], end, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[stops[1:] - 1] = False
    out[inside] = ids
    return out, stops


def batches(rows: Iterator) -> Iterator[dict]:
    """Arrow record batches as dictionaries of columns."""
    for batch in filled(rows):
        yield {name: batch.column(i) for i, name in enumerate(batch.schema.names)}


def whole_units(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``unit`` as tables that hold all rows of their units, and where the units start and end in them."""
    def closed(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(parts).combine_chunks()
        unit = t["unit"].to_numpy()
        return t, np.append(np.flatnonzero(np.append(True, unit[1:] != unit[:-1])), len(unit))

    held: list[pa.RecordBatch] = []
    for batch in filled(rows, 8192):
        at = batch.schema.get_field_index("unit")
        unit = batch.column(at).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))[-1])
        if last or (held and held[-1].column(at)[0].as_py() != unit[0]):
            if whole := [*held, *([batch.slice(0, last)] if last else [])]:
                yield closed(whole)
            held = []
        held.append(batch.slice(last))
    if held:
        yield closed(held)
