"""Packing by non-negative least squares over length combinations.

Documents are cut into pieces of one window at most. For least squares their lengths are counted in steps; every way to fill the window
with up to three lengths is a pattern. Least squares with non-negative repeat counts fits the patterns to the histogram; the counts
are rounded down, and what they leave is packed greedily by exact length, longest first. All of that sees the histogram only, whose size
is that of the window. Pieces then find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.llm import bpe_tables
from pagegrain.llm.common import ended, light, ranked, ship, table, written

ship(__name__)

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
WINDOW = 2048
STEP = 16
#: Weight of lengths under an eighth of the window: short pieces fit anywhere, so their rest may stay.
SHORT_WEIGHT = 0.1
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def cut(path: str, end_id: int, window: int, entries: int = bpe_tables.ENTRIES):
    """Pieces of each document: all but the last are one window long; ids are little-endian unsigned 32-bit integers."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe_tables.encoder(path, entries)
        for b in light(rows, "text"):
            ids, stops = ended(*encoder.encode_all(b.column(b.schema.get_field_index("text"))), end_id)
            n = np.diff(stops)
            parts = -(-n // window)
            owner = np.repeat(np.arange(len(n)), parts)
            start = window * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
            length = np.minimum(window, n[owner] - start)
            at = stops[owner] + start
            pieces = [ids[s:e].tobytes() for s, e in zip(at, at + length)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")).take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(n[owner]),
                                              pa.array(pieces, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def combinations(window: int) -> list[tuple[int, ...]]:
    """Ascending lengths, three at most, that add up to the window."""
    out = [(window,)]
    for a in range(1, window // 2 + 1):
        out.append((a, window - a))
        out += [(a, b, window - a - b) for b in range(a, (window - a) // 2 + 1)]
    return out


def least_squares(a: np.ndarray, y: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative ``x`` that minimises ``|a x - y|`` (active sets)."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(y).max())
    for _ in range(rounds):
        gradient = np.where(passive, -np.inf, a.T @ (y - a @ x))
        if passive.all() or gradient.max() <= tolerance:
            break
        passive[gradient.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[passive] = np.linalg.lstsq(a[:, passive], y, rcond=None)[0]
            low = passive & (z <= 1e-12)
            if not low.any():
                x = z
                break
            step = np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))
            x = x + step * (z - x)
            passive &= x > 1e-12
            x[~passive] = 0
    return x


def patterns(histogram: dict[int, int], window: int, step: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), using every piece of the histogram exactly once."""
    left = Counter({k: v for k, v in histogram.items() if v})
    out = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        need = Counter(lengths)
        n = min([most, *(left[k] // m for k, m in need.items())])
        if n > 0:
            out.append((lengths, n))
            left.subtract({k: n * m for k, m in need.items()})

    # exact lengths by their size in steps, longest last
    sizes: dict[int, list[int]] = {}
    for k in sorted(left):
        sizes.setdefault(-(-k // step), []).append(k)
    steps = window // step
    ways = [c for c in combinations(steps) if all(k in sizes for k in c)]
    if ways:
        weight = np.where(np.arange(1, steps + 1) < steps // 8, SHORT_WEIGHT, 1.0)
        a = np.zeros((steps, len(ways)))
        for j, c in enumerate(ways):
            for k in c:
                a[k - 1, j] += 1
        y = np.array([sum(left[k] for k in sizes.get(i, ())) for i in range(1, steps + 1)], float)
        x = least_squares(a * weight[:, None], y * weight)
        for j in np.argsort(-x, kind="stable"):
            n = int(x[j] + 1e-6)
            while n > 0:
                # the longest pieces of each size that are left; a pattern is repeated until it uses one of its lengths up
                lengths, pool = [], Counter()
                for size in ways[j]:
                    while sizes[size] and left[sizes[size][-1]] == 0:
                        sizes[size].pop()
                    k = next((k for k in reversed(sizes[size]) if left[k] > pool[k]), None)
                    if k is None:
                        break
                    lengths.append(k)
                    pool[k] += 1
                if len(lengths) < len(ways[j]):
                    break
                before = len(out)
                take(tuple(lengths), n)
                n -= out[before][1]
    while left := +left:
        # longest first; each pattern is repeated until it uses one of its lengths up
        fill, room = [], window
        for k in sorted(left, reverse=True):
            n = min(room // k, left[k])
            fill += [k] * n
            room -= n * k
        take(tuple(fill), 1 << 62)
    return out


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """By length: (rank after the interval, its first rank, first sequence, pieces per sequence, first slot)."""
    out: dict[int, list] = {}
    done, sequence = Counter(), 0
    for lengths, n in plan:
        slot = 0
        for k, m in sorted(Counter(lengths).items(), reverse=True):
            out.setdefault(k, []).append((done[k] + n * m, done[k], sequence, m, slot))
            done[k] += n * m
            slot += m
        sequence += n
    return out


def pack(pieces: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """``pieces`` (written, with ``doc_id``, ``start``, ``length``) with ``sequence_id`` and ``offset``, without ids.

    Each sequence holds ``window`` tokens at most. An empty table gives no rows.
    """
    if window % step:
        raise ValueError("the window must be a multiple of the step")
    sized = pieces.drop("ids").withColumn("__size", F.col("length").cast("int"))
    # as many rows as the window has tokens
    histogram = {r["__size"]: r["n"] for r in sized.groupBy("__size").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = pieces.sparkSession.createDataFrame(
        list(places(patterns(histogram, window, step)).items()),
        "__length int, __places array<struct<to:bigint,from:bigint,sequence:bigint,times:bigint,slot:bigint>>")
    within = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    return (ranked(sized, "__size", F.xxhash64("doc_id", "start", "ids_crc32"), ["doc_id", "start", "ids_crc32", "piece_id"], sum(histogram.values()))
            .join(F.broadcast(plan), F.col("__size") == F.col("__length"))
            .withColumn("__place", F.expr("filter(__places, p -> p.to > __rank)[0]"))
            .withColumn("__at", F.col("__rank") - F.col("__place.from"))
            .withColumn("sequence_id", (F.col("__place.sequence") + F.floor(F.col("__at") / F.col("__place.times"))).cast("long"))
            .withColumn("__slot", F.col("__place.slot") + F.col("__at") % F.col("__place.times"))
            .withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long"))
            .select(*[c for c in sized.columns if c != "__size"], "sequence_id", "offset"))


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int = END_ID, window: int = WINDOW, entries: int = bpe_tables.ENTRIES) -> DataFrame:
    """A written table of pieces with ``ids``, their crc32 and ``piece_id``. A null text is empty and has the end id only.

    ``entries`` bounds the chunks whose ids a Python worker remembers: fewer take less memory and more time, and give the same ids.
    """
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut(vocabulary, end_id, window, entries), PIECES)
    return written(pieces.withColumn("ids_crc32", F.crc32("ids")).withColumn("piece_id", F.monotonically_increasing_id()), "pieces")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """``sequence_id`` and the ids of its pieces in order, as one binary value per sequence."""
    rows = packed.select("piece_id", "sequence_id", "offset").join(pieces.select("piece_id", "ids"), "piece_id")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    # a window's tokens at most
    return rows.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def op5_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = cut_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
