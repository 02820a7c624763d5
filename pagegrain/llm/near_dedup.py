"""Near-duplicate documents by b-bit MinHash, with links confirmed on the full shingle sets.

1. One pass turns each text into its set's digest, 256 minima, their low 4 bits packed into 128 bytes, and 51 band keys.
2. Documents with equal sets are one class; only a class's smallest id goes on.
3. In each band bucket every member is paired with the smallest one and with the one that meets most others. The packed signatures
   estimate the pairs' similarity by bit counts, corrected for chance; pairs within reach of the threshold are confirmed on the sets.
4. Links give components. Buckets that still hold several components are compared again, all those of one largest component together: members outside
   of it with all others, in blocks, so that no task sees a whole bucket; pairs inside a component
   need no test. That is done first with each member's best estimates per component, then with all that are within reach, whose
   sets are compared inside the blocks. So the components are those of all candidate pairs, and no bucket is cut off.

A pair at the threshold misses all bands with a chance of 1.0e-6, and the estimate drops it with one of 6.5e-7
before its sets are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.llm.common import batches, discard, ship, table, whole_units, written

ship(__name__)

WORDS = 5
PERCENT = 75
HASHES = 256
BAND_ROWS = 5
BANDS = HASHES // BAND_ROWS
BITS = 4
#: Five standard errors (0.141) and a little: the estimate loses no more pairs at the threshold than the bands do.
MARGIN = 0.145
BLOCK = 512
#: Candidates of a member per component in the first comparison.
BEST = 2
SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature binary, bands array<bigint>"


def constants(n: int, seed: int, kind: type) -> np.ndarray:
    """Odd multipliers from a rule, equal on all machines."""
    out = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, dtype=np.uint64)
    return (out | np.uint64(1)).astype(kind)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words are one shingle; without words the set is empty."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = min(WORDS, len(words))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i]
    return np.unique(mixed(total))


class Sketcher:
    def __init__(self) -> None:
        self.a, self.b = constants(HASHES, 1, np.uint32), constants(HASHES, 2, np.uint32)
        self.row, self.band = constants(BAND_ROWS, 3, np.uint64), constants(BANDS, 4, np.uint64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
        out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 1024):
            np.minimum(out, (x[i:i + 1024] * self.a + self.b).min(axis=0), out=out)
        return out

    def bands(self, minima: np.ndarray) -> np.ndarray:
        rows = minima[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
        return mixed((rows * self.row).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)

    def packed(self, minima: np.ndarray) -> bytes:
        # the top bits of a product are its best mixed ones, so the minima are folded before their low bits are kept
        low = ((minima ^ (minima >> np.uint32(16))) & np.uint32(15)).astype(np.uint8)
        return (low[0::2] | low[1::2] << np.uint8(4)).tobytes()


#: Number of 4-bit groups that are zero in a byte.
ZERO_GROUPS = np.array([(b & 15 == 0) + (b >> 4 == 0) for b in range(256)], np.uint8)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimate from packed signatures (last axis): the share of equal groups, less those equal by chance."""
    equal = ZERO_GROUPS[a ^ b].sum(axis=-1, dtype=np.int32) / HASHES
    chance = 2.0 ** -BITS
    return (equal - chance) / (1 - chance)


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES * BITS // 8)


def sketch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    s = Sketcher()
    for batch in batches(rows):
        n, digests, sigs, bands = [], [], [], []
        for text in batch["text"].to_pylist():
            x = shingles(text)
            n.append(len(x))
            if len(x):
                m = s.minima(x)
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                sigs.append(s.packed(m))
                bands.append(s.bands(m))
            else:
                digests.append(None)
                sigs.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()),
                                          pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "signature", "bands"])


def full_sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        sets = [np.sort(shingles(t).view(np.int64)) for t in batch["text"].to_pylist()]
        rows_ = pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "set"])
        yield rows_.filter(pa.array([len(s) > 0 for s in sets]))


def within_reach(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures ``sa`` and ``sb`` do not rule the threshold out."""
    for batch in batches(rows):
        keep = similarity(signatures(batch["sa"]), signatures(batch["sb"])) >= PERCENT / 100 - MARGIN
        if keep.any():
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep))


def estimated(best: int | None):
    """A unit is two blocks, ``left`` (true) and the others. Estimates all its pairs across components.

    With ``best``: pairs within reach, so many per left member and component. Without: the rows that have a partner within reach.
    """
    def compared(x: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        right = np.flatnonzero(~x["left"])
        for i in np.flatnonzero(x["left"]):
            # two members outside of the largest component are both left and right: their pair is met from both sides
            j = right[x["comp"][right] != x["comp"][i]]
            if not len(j):
                continue
            estimate = similarity(x["signature"][j], x["signature"][i])
            near = estimate >= PERCENT / 100 - MARGIN
            j, estimate = j[near], estimate[near]
            if best is not None and len(j):
                order = np.lexsort((-estimate, x["comp"][j]))
                comps = x["comp"][j][order]
                starts = np.flatnonzero(np.append(True, comps[1:] != comps[:-1]))
                place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
                j = j[order[place < best]]
            if len(j):
                yield i, j

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in whole_units(rows):
            x = {"left": t["left"].to_numpy(), "comp": t["comp"].to_numpy(), "id": t["id"].to_numpy(), "signature": signatures(t["signature"].combine_chunks())}
            keep, a, b = np.zeros(len(t), bool), [], []
            for s, e in zip(edges, edges[1:]):
                for i, j in compared({k: v[s:e] for k, v in x.items()}):
                    keep[s + i] = keep[s + j] = True
                    a.append(np.full(len(j), x["id"][s + i]))
                    b.append(x["id"][s + j])
            if not a:
                continue
            if best is None:
                yield from t.select(["unit", "left", "id", "comp"]).filter(pa.array(keep)).to_batches()
            else:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def linked_blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units with full sets: one confirmed link per left member and other component, which is all that components need."""
    for t, edges in whole_units(rows):
        left, comp, ids = t["left"].to_numpy(), t["comp"].to_numpy(), t["id"].to_numpy()
        sets = t["set"].combine_chunks()
        flat, offsets = sets.values.to_numpy(), sets.offsets.to_numpy()
        sizes = np.diff(offsets)
        a, b = [], []
        for s, e in zip(edges, edges[1:]):
            right = s + np.flatnonzero(~left[s:e])
            values = np.concatenate([flat[offsets[j]:offsets[j + 1]] for j in right]) if len(right) else flat[:0]
            starts = np.cumsum(sizes[right]) - sizes[right]
            for i in s + np.flatnonzero(left[s:e]):
                if not len(right):
                    break
                own = flat[offsets[i]:offsets[i + 1]]
                at = np.searchsorted(own, values)
                common = np.add.reduceat((own[np.minimum(at, len(own) - 1)] == values).astype(np.int64), starts)
                good = (100 * common >= PERCENT * (sizes[i] + sizes[right] - common)) & (comp[right] != comp[i])
                _, first = np.unique(comp[right][good], return_index=True)
                found = ids[right[good][first]]
                a.append(np.full(len(found), ids[i]))
                b.append(found)
        if a and len(x := np.concatenate(a)):
            y = np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``comp`` (smallest id of its component) of every linked id.

    Large-star and small-star steps: each links every id to the smallest it sees, until nothing changes. Minima are pre-aggregated
    before the shuffle; every step is a written table.
    """
    now = written(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "links")
    state = None
    while True:
        before = now
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("c"), "m")
        pulled = large.join(low, F.col("hi") == F.col("c"))
        small = pulled.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").unionAll(low.select(F.col("c").alias("hi"), F.col("m").alias("lo"))).distinct()
        now = written(small, "stars")
        discard(before)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("comp")).unionAll(now.select(F.col("lo").alias("id"), F.col("lo").alias("comp")).distinct())


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    a, b = (sets.select(F.col("doc_id").alias(f"{s}_id"), F.col("set").alias(f"{s}_set")) for s in "ab")
    both = (pairs.join(a, F.col("a") == F.col("a_id")).select("a", "b", "a_set").join(b, F.col("b") == F.col("b_id")))
    common = F.size(F.array_intersect("a_set", "b_set"))
    # generated, so that the intersection is not evaluated again in the filter
    return (both.select("a", "b", (F.size("a_set") + F.size("b_set")).alias("n"), F.explode(F.array(common)).alias("i"))
            .where(100 * F.col("i") >= PERCENT * (F.col("n") - F.col("i"))).select("a", "b").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept`` of every row.

    A text without words is linked with nothing. Rows that share an id are one document: what links one of them links it. A row
    without id is linked with nothing, has no component and is kept. Other columns are left out.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(narrow.mapInArrow(sketch, SKETCH), "sketches")
    # written, so that the last join is dealt by itself and a class that holds a third of all rows can be split
    classes = written(sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
                      .agg(F.min("doc_id").alias("rep")), "class_ids")
    # one row per class: repeated rows of its smallest id hold the same sketch
    chosen = written(sketches.where("digest IS NOT NULL").join(classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("rep")), "left_semi")
                     .dropDuplicates(["doc_id", "digest"]).select(F.col("doc_id").alias("id"), "n_shingles", "signature", "bands"), "classes")
    keys = chosen.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = keys.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # the members of the buckets that hold several classes
    shared = written(keys.join(buckets.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select("id", "band", "key", "leader", "members"), "buckets")
    wanted = shared.select(F.col("id").alias("w")).distinct()
    sets = written(narrow.join(wanted, F.col("doc_id") == F.col("w"), "left_semi").mapInArrow(full_sets, "doc_id bigint, set array<bigint>"), "sets")

    sig = chosen.select("id", "n_shingles", "signature")
    hubs = centres(shared).withColumnRenamed("key", "k")
    hubs = shared.where("members > 2").join(hubs, F.col("key") == F.col("k")).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    pairs = shared.select(F.col("leader").alias("a"), F.col("id").alias("b")).unionAll(hubs).where("a <> b").distinct()
    measured = (pairs.join(sig.select(F.col("id").alias("ia"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa")), F.col("a") == F.col("ia"))
                .join(sig.select(F.col("id").alias("ib"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb")), F.col("b") == F.col("ib"))
                .where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")).select("a", "b", "sa", "sb"))
    links = written(confirmed(measured.mapInArrow(within_reach, "a bigint, b bigint"), sets).unionAll(same_id(sketches, classes)), "links")
    comps = components(links)
    more = written(confirmed(crossing(shared, chosen, comps, BEST), sets), "links")
    if not more.isEmpty():  # no further links, no other components
        links = links.unionAll(more)
        comps = components(links)
    more = written(linked(crossing(shared, chosen, comps, None), sets), "links")
    if not more.isEmpty():
        comps = components(links.unionAll(more))
    comps = written(comps, "components")
    discard(chosen, shared, sets)
    rep = (sketches.select("doc_id", "n_shingles", "digest").join(classes.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d"), "left")
           .join(comps.withColumnRenamed("comp", "c"), F.coalesce("rep", "doc_id") == F.col("id"), "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "rep", "doc_id"))
    return (rep.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def same_id(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id but not a set."""
    known = sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "digest")
    twice = known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select(F.col("doc_id").alias("t"))
    both = known.join(twice, F.col("doc_id") == F.col("t"), "left_semi").join(classes.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d"))
    return both.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()


def linked(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the rows of each unit, compared on their full sets inside the unit: no pair is a row before it is a link."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = rows.join(sets.withColumnRenamed("doc_id", "si"), F.col("id") == F.col("si")).drop("si")
    return (whole.repartition(n, "unit").sortWithinPartitions("unit").mapInArrow(linked_blocks, "a bigint, b bigint").distinct())


def crossing(shared: DataFrame, chosen: DataFrame, comps: DataFrame, best: int | None) -> DataFrame:
    """What is within reach across components that meet in a bucket, by the signatures: the best pairs, or the rows of all such pairs.

    The buckets with the same largest component are compared together, so a document is dealt once per component that it meets, not once per band.
    """
    label = comps.select(F.col("id").alias("ci"), "comp")
    rows = (shared.where("members > 2").join(label, F.col("id") == F.col("ci"), "left")
            .select("id", "key", F.coalesce("comp", "id").alias("comp")))
    counts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed_ = (counts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("most"), F.count(F.lit(1)).alias("comps"))
              .where("comps > 1").select(F.col("key").alias("k"), F.col("most.comp").alias("main")))
    met = written(rows.join(mixed_, F.col("key") == F.col("k")).select("main", "id", "comp").distinct(), "met")
    sizes = met.groupBy(F.col("main").alias("m")).agg(F.count(F.lit(1)).alias("all_n"), F.count_if(F.col("comp") != F.col("main")).alias("left_n"))
    met = met.join(sizes, F.col("main") == F.col("m"))
    la, lb = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("left_n", "all_n"))
    own = F.xxhash64("id")
    left = met.where("comp <> main").select("main", "id", "comp", F.lit(True).alias("left"), F.pmod(own, la).cast("int").alias("i"),
                                           F.explode(F.sequence(F.lit(0), lb - 1)).alias("j"))
    right = met.select("main", "id", "comp", F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), la - 1)).alias("i"),
                       F.pmod(own, lb).cast("int").alias("j"))
    dealt = left.unionByName(right).select("id", "comp", "left", F.xxhash64("main", "i", "j").alias("unit"))
    wide = dealt.join(chosen.select(F.col("id").alias("si"), "signature"), F.col("id") == F.col("si")).drop("si")
    n = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = wide.repartition(n, "unit").sortWithinPartitions("unit")
    if best is None:
        return written(dealt.mapInArrow(estimated(best), "unit bigint, left boolean, id bigint, comp bigint"), "within")
    return dealt.mapInArrow(estimated(best), "a bigint, b bigint").distinct()


def centres(shared: DataFrame) -> DataFrame:
    """``key`` and ``hub`` of each bucket: its member that meets most others in all its buckets. In a group of copies that is near their source."""
    met = shared.groupBy(F.col("id").alias("m")).agg(F.sum("members").alias("met"))
    return shared.join(met, F.col("id") == F.col("m")).groupBy("key").agg((-F.max(F.struct("met", -F.col("id")))["col2"]).alias("hub"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group, one row each: of rows that share an id the one with the smallest text
    (null last) stays. Rows without id stay."""
    found = near_duplicates(docs)
    kept = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__kept")).distinct()
    plain = [F.col(f"`{c}`") for c, t in docs.dtypes if c != "text" and not t.startswith(("map", "array", "struct", "variant"))]
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), *plain))
    with_id = docs.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi").withColumn("__place", place).where("__place = 1").drop("__place")
    return with_id.unionByName(docs.where("doc_id IS NULL"))


def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END)) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 75 * (p.n + q.n - i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY 1
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, component_id = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN least ON a = w.doc_id
"""
