"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every key has a place on the ring and belongs to the next virtual node clockwise. A shard keeps the first keys of its own
nodes up to its capacity; the keys that overflow go on clockwise to the next node whose shard has room. Capacities add up
to the number of rows and differ by one at most, so the row counts of any two shards do too (law ``rows``).

Which keys stay is a rank inside the node, so the walk needs the nodes' counts only: it runs over the ring's few nodes, and
each node's keys are then cut into intervals of ranks. Ranks are computed by ``ranked`` in many tasks per node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrain.llm.common import ranked, ship, table, written

ship(__name__)

SHARDS = 16
VIRTUAL_NODES = 64


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in ring order; a shard's nodes do not depend on the other shards."""
    def place(shard: int, i: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{i}".encode(), digest_size=8).digest(), "big", signed=True)

    return sorted((place(s, i), s) for s in range(shards) for i in range(virtual_nodes))


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """(node, first rank after the interval, shard, slot of rank 0 in it) for the keys of every node, in rank order.

    First every shard takes from its own nodes in ring order; then the nodes' remaining keys walk clockwise, in ring order.
    """
    room, filled, out, over = list(room), [0] * len(room), [], []

    def put(node: int, start: int, n: int, shard: int) -> None:
        out.append((node, start + n, shard, filled[shard] - start))
        room[shard] -= n
        filled[shard] += n

    for node, shard in enumerate(owners):
        n = counts.get(node, 0)
        if take := min(n, room[shard]):
            put(node, 0, take, shard)
        if n > take:
            over.append((node, take, n - take))
    for node, start, n in over:
        at = node
        while n:
            at = (at + 1) % len(owners)
            if take := min(n, room[owners[at]]):
                put(node, start, take, owners[at])
                start, n = start + take, n - take
    return sorted(out)


def node_of(places: list[int]):
    """Index of the next virtual node clockwise."""
    ends = np.array(places, dtype=np.int64)

    @F.pandas_udf("int")
    def find(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in places:
            yield pd.Series((np.searchsorted(ends, p.to_numpy(np.int64)) % len(ends)).astype(np.int32))

    return find


def ring_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
                virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``node`` (index on the ring), ``shard`` and ``slot`` of every row.

    A null text has size 1 and the crc of no bytes. Null keys share one place and overflow like other keys; repeated
    rows are placed one by one; other columns are left out; an empty table gives no rows.
    """
    nodes = ring(shards, virtual_nodes)
    owners = [s for _, s in nodes]
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = written(
        docs.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        .withColumn("node", node_of([p for p, _ in nodes])(F.xxhash64(key))), "ring")
    # as many rows as the ring has nodes
    counts = {r["node"]: r["n"] for r in rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    intervals: dict[int, list] = {}
    for node, to, shard, base in walk(counts, owners, capacities(total, shards)):
        intervals.setdefault(node, []).append((to, shard, base))
    plan = docs.sparkSession.createDataFrame(
        [(n, x) for n, x in intervals.items()],
        "__node int, __parts array<struct<to:bigint,shard:int,base:bigint>>")
    placed = ranked(rows, "node", F.xxhash64(key, "text_crc32", "size"), [key, "text_crc32", "size"], total)
    return (placed.join(F.broadcast(plan), F.col("node") == F.col("__node"))
            .withColumn("__part", F.expr("filter(__parts, p -> p.to > __rank)[0]"))
            .select(key, "size", "text_crc32", "node", F.col("__part.shard").alias("shard"),
                    (F.col("__part.base") + F.col("__rank")).alias("slot")))


def op4_ring_shards(spark, sf_dir: str) -> DataFrame:
    return ring_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
