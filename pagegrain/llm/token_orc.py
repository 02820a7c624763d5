"""Token ids in ORC files: run-length encoded integers, row indexes, and Bloom filters on the document ids.

Documents are dealt by ranges of their id and sorted, so the files and the stripes inside them ascend, and a lookup by id
is pruned by the files' minima and maxima, then by stripe and row-group statistics, then by the Bloom filters. A file is read by several tasks,
stripe by stripe.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.llm import bpe_tables
from pagegrain.llm.common import ended, filled, light, ship, table
from pagegrain.session import scratch_path

ship(__name__)

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SCHEMA = "doc_id bigint, n_tokens bigint, first bigint, ids array<int>"
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
       "orc.row.index.stride": "2000", "orc.stripe.size": str(16 << 20), "compression": "zstd"}


def encode_sorted(path: str, end_id: int):
    """Ids of each document with the end id, and the number of ids before it in the same partition."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = bpe_tables.encoder(path), 0
        for b in light(rows, "text"):
            ids, stops = ended(*encoder.encode_all(b.column(b.schema.get_field_index("text"))), end_id)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), pa.array(np.diff(stops)), pa.array(first + stops[:-1]),
                 pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids.view(np.int32)))],
                ["doc_id", "n_tokens", "first", "ids"])
            first += int(stops[-1])

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, files: int | None = None) -> None:
    """One ORC file per range of ids, in ascending order of (id, text); ``files`` defaults to the shuffle partitions.

    A null or empty text has the end id only. Null ids come first; equal ids stay in one file unless their texts differ.
    Other columns are left out.
    """
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", "__tie"]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__tie"))
     .repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
     .mapInArrow(encode_sorted(vocabulary, end_id), SCHEMA)
     .write.options(**ORC).orc(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with the number of their ``file``; ``first`` counts the ids before the row in it."""
    return (spark.read.schema(SCHEMA).orc(path)
            .select("*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file")))


def with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (with ``file`` and ``first``) with ``start``: the ids of all documents before it, over all files."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    sums = (files.groupBy("file").agg(F.sum("n_tokens").alias("n"))
            .select(F.col("file").alias("__file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
    return (rows.join(sums, F.col("file") == F.col("__file"))
            .withColumn("start", F.col("__before") + F.col("first")).drop("__file", "__before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids``."""
    rows = read_files(spark, path)
    return with_start(rows, rows).select("doc_id", "start", "n_tokens", "ids")


def digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids`` of every row as the crc32 of little-endian unsigned 32-bit integers."""
    for batch in filled(rows):
        at = batch.schema.get_field_index("ids")
        ids = batch.column(at)
        flat, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        others = [i for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in others] + [pa.array(crc, pa.int64())],
                                         [batch.schema.names[i] for i in others] + ["ids_crc32"])


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    rows = read_files(spark, path)
    # digests first, so that no ids are moved for the join with the files' sums
    narrow = rows.mapInArrow(digest, "doc_id bigint, n_tokens bigint, first bigint, file int, ids_crc32 bigint")
    return with_start(narrow, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
