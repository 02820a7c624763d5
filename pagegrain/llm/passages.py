"""Repeated passages: every window of 20 words that also starts earlier is removed, found by compressed FM-indexes, one per shard.

1. Equal texts are one text, at the smallest id; in its copies every window starts earlier.
2. One pass cuts each text into segments: runs of windows whose least 8-word gram (by hash, the first of equal ones) is at the same place.
   Equal windows have equal least grams, so all occurrences of a window meet in the shard of its gram, and no document has to be
   streamed past every shard. Two equal windows of one text are in two segments.
3. A gram in one segment only cannot belong to a repeated window: its segment goes no further. Equal segments become one content,
   which keeps its first position.
4. A shard indexes the words of its contents (``fm_index``). The contents are streamed backward through the index; where the matching
   statistics reach 20 words, the interval gives the first position of that window in the whole corpus.
5. A gram with more than ``CROWDED`` contents (a line that stands in many texts) would make one shard too large. The windows of its
   contents are reduced to their first positions by an aggregate on the window's digest, with a partial step before the shuffle.
6. Each occurrence of a content is covered where its windows' first positions are before its own. The texts concerned are cut.

Positions are ordered by ``doc_id`` (null first), then by word. Segments, contents and windows are never dropped or capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm import fm_index  # noqa: F401  shipped with the tasks
from pagegrain.llm.common import discard, filled, ship, table, whole_units, written
from pagegrain.llm.fm_index import FMIndex

ship(__name__)

WINDOW = 20
GRAM = 8
#: Contents of a gram up to which they are indexed together, and contents of a shard.
CROWDED, SHARD = 2048, 8192
SEGMENTS = "doc_id bigint, row bigint, mark string, n_words bigint, whole_sha256 string, pos array<bigint>, gram array<bigint>, digest array<bigint>"
CONTENTS = "gram bigint, digest bigint, crowded boolean, known boolean, doc_id bigint, start bigint, copies bigint, words binary"
FIRSTS = "gram bigint, digest bigint, docs array<bigint>, starts array<bigint>"
#: ``pos`` is start * 32 + number of windows; a segment has 13 windows at most.
PLACES = 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and the number of words of each text."""
    bare = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    words = pc.ascii_split_whitespace(bare)
    counts = np.where(pc.equal(bare, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(words).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = words.filter(pc.not_equal(bare, "")).flatten()
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    coded = flat.dictionary_encode()
    each = pd.util.hash_array(np.array(coded.dictionary.cast(pa.large_binary()).to_pylist(), dtype=object), categorize=False)
    return each[coded.indices.to_numpy()], counts


class Digests:
    """Digests of stretches of the words ``h``: differences of the running sums of a polynomial, shifted to the stretch's own start."""

    def __init__(self, h: np.ndarray, seed: int):
        base = int(np.random.Generator(np.random.PCG64(seed)).integers(2**62, 2**63)) * 2 + 1
        powers = np.full(len(h) + 1, base, np.uint64)
        powers[0] = 1
        self.back = np.full(len(h) + 1, pow(base, -1, 2**64), np.uint64)
        self.back[0] = 1
        powers, self.back = (np.multiply.accumulate(x) for x in (powers, self.back))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h + np.uint64(seed)) * powers[:-1])])

    def of(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mixed((self.sums[starts + lengths] - self.sums[starts]) * self.back[starts] + lengths.astype(np.uint64))


def segments(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of windows and least grams of the segments of texts that stand one after the other."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    weights = np.random.Generator(np.random.PCG64(11)).integers(0, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)
    grams = sum(h[i:len(h) - GRAM + 1 + i] * weights[i] for i in range(GRAM))
    least, where = mixed(grams), np.arange(len(grams))
    span, have = WINDOW - GRAM + 1, 1
    while have < span:
        step = min(have, span - have)
        right = least[step:] < least[:-step]
        least, where = (np.where(right, x[step:], x[:-step]) for x in (least, where))
        have += step
    # windows that reach into the next text are none
    left = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n)
    where = np.where(left >= WINDOW, where, -1)
    starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    ends = np.append(starts[1:], n)
    real = where[starts] >= 0
    return starts[real], (ends - starts)[real], least[starts[real]]


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of 64-bit numbers from their values one after the other and the lists' ends."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values.astype(np.int64, copy=False)))


def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: its number of words, the digest of all words, and its segments."""
    for batch in filled(rows, 256):
        texts = batch.column("text")
        h, counts = numbered(texts)
        starts, windows, gram = segments(h, counts)
        digest = Digests(h, 12).of(starts, windows + WINDOW - 1)
        first = np.cumsum(counts) - counts
        ends = np.searchsorted(starts, first + counts)
        own = starts - np.repeat(first, np.diff(np.append(0, ends)))
        shas = [hashlib.sha256(b" ".join(words_of(t))).hexdigest() for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("mark"), pa.array(counts), pa.array(shas, pa.string()),
                                          lists(own * PLACES + windows, ends), lists(gram.view(np.int64), ends), lists(digest.view(np.int64), ends)],
                                         [c.split()[0] for c in SEGMENTS.split(", ")])


def contents_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the contents whose first occurrence is in these texts."""
    for batch in filled(rows, 64):
        h, counts = numbered(batch.column("text"))
        wanted = batch.column("wanted")
        w = wanted.flatten()
        text = np.repeat(np.arange(len(counts)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
        start, windows = np.divmod(w.field("pos").to_numpy(), PLACES)
        at = (np.cumsum(counts) - counts)[text] + start
        words = [h[s:e].tobytes() for s, e in zip(at, at + windows + WINDOW - 1)]
        doc = batch.column("doc_id").take(pa.array(text))
        yield pa.RecordBatch.from_arrays([*(w.field(c) for c in ("gram", "digest", "crowded")), doc.is_valid(), doc.fill_null(0), pa.array(start), w.field("copies"),
                                          pa.array(words, pa.binary())], [c.split()[0] for c in CONTENTS.split(", ")])


def spans(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all rows one after the other, and how many each row has."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.uint64), np.array([len(p) // 8 for p in parts], np.int64)


def searched(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units are shards: indexes their contents, streams them through the index, and gives the first position of each window.

    A content that stands once and first in all its windows removes nothing and is left out.
    """
    for t, edges in whole_units(rows):
        for s, e in zip(edges, edges[1:]):
            unit = t.slice(s, e - s)
            words, lengths = spans(unit["words"])
            at = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(words)) - at[owner]
            known, doc, start, copies = (unit[c].to_numpy() for c in ("known", "doc_id", "start", "copies"))
            order = np.lexsort((start[owner] + place, doc[owner], known[owner]))
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            index = FMIndex(words, lengths, WINDOW)
            index.least(rank)
            found, at_row = index.statistics(words, lengths)
            source = order[np.where(found >= WINDOW, index.smallest_at(at_row), rank)]
            tells = (copies > 1) | (np.bincount(owner, owner[source] != owner, len(lengths)) > 0)
            given = tells[owner] & (place < lengths[owner] - WINDOW + 1)
            from_ = source[given]
            ends = np.cumsum((lengths - WINDOW + 1)[tells])
            docs = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(doc[owner[from_]], mask=~known[owner[from_]]))
            keep = pa.array(tells)
            yield pa.RecordBatch.from_arrays([unit["gram"].combine_chunks().filter(keep), unit["digest"].combine_chunks().filter(keep), docs,
                                              lists(start[owner[from_]] + place[from_], ends)], ["gram", "digest", "docs", "starts"])


def windows_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of crowded grams' contents, with two digests of their words."""
    for batch in filled(rows, 1024):
        words, lengths = spans(batch.column("words"))
        n = lengths - WINDOW + 1
        owner = np.repeat(np.arange(len(n)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(lengths) - lengths)[owner] + k
        marks = [Digests(words, seed).of(at, np.full(len(at), WINDOW)).view(np.int64) for seed in (13, 14)]
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("gram", "digest", "known", "doc_id", "start")}
        yield pa.RecordBatch.from_arrays([pa.array(cols["gram"]), pa.array(cols["digest"]), pa.array(k), pa.array(marks[0]), pa.array(marks[1]),
                                          pa.array(cols["doc_id"], mask=~cols["known"]), pa.array(cols["start"] + k)],
                                         ["gram", "digest", "k", "mark", "mark2", "doc_id", "start"])


def crowded_firsts(contents: DataFrame) -> DataFrame:
    """First positions of the windows of crowded grams, by an aggregate on the windows' digests."""
    windows = written(contents.where("crowded").mapInArrow(windows_of, "gram bigint, digest bigint, k bigint, mark bigint, mark2 bigint, doc_id bigint, start bigint"), "windows")
    first = windows.groupBy("mark", "mark2").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    back = windows.select("gram", "digest", "k", "mark", "mark2").join(first, ["mark", "mark2"])
    # a content has 16 windows at most
    firsts = back.groupBy("gram", "digest").agg(F.array_sort(F.collect_list(F.struct("k", "first"))).alias("w"))
    return firsts.select("gram", "digest", F.transform("w", lambda x: x["first"]["doc_id"]).alias("docs"), F.transform("w", lambda x: x["first"]["start"]).alias("starts"))


def covered(hits: DataFrame) -> DataFrame:
    """Stretches of words that are covered by windows which start earlier elsewhere."""
    start, n = F.floor(F.col("pos") / PLACES), (F.col("pos") % PLACES).cast("int")
    first = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.when(F.struct(F.get("docs", k), F.get("starts", k)) < F.struct("doc_id", start + k), k))
    gone = hits.select("doc_id", "row", start.alias("start"), F.array_compact(first).alias("k")).where("size(k) > 0")
    lo, hi = F.element_at("k", 1), F.element_at("k", -1)

    def stretch(a: Column, b: Column) -> Column:
        return F.struct((F.col("start") + a).alias("lo"), (F.col("start") + b + WINDOW).alias("hi"))

    whole = hi - lo + 1 == F.size("k")
    return (gone.select("doc_id", "row", F.explode(F.when(whole, F.array(stretch(lo, hi))).otherwise(F.transform("k", lambda k: stretch(k, k)))).alias("s"))
            .select("doc_id", "row", "s.lo", "s.hi"))


def kept_words(text: str | None, stretches: list) -> tuple[list[bytes], int]:
    words = words_of(text)
    gone = np.zeros(len(words) + 1, np.int64)
    for lo, hi in stretches:
        gone[lo] += 1
        gone[hi] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    return [w for w, g in zip(words, gone) if not g], int(gone.sum())


def without(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in filled(rows, 256):
        texts, n, shas = [], [], []
        for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist()):
            kept, removed = kept_words(text, [(s["lo"], s["hi"]) for s in stretches])
            n.append(removed)
            texts.append(b" ".join(kept).decode())
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())],
                                         ["doc_id", "row", "n_removed", "cut_sha256", "kept_text"])


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])


def stretches(texts: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts that share a gram with another place, and the covered stretches of words, both written, by ``(doc_id, row)``.

    ``texts`` has distinct ``(doc_id, row)`` with ``text`` and is discarded; ``cuts`` is the result of ``cut``. Both are written.
    """
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cuts.select("doc_id", "row", F.explode(F.arrays_zip("pos", "gram", "digest")).alias("s")).select("doc_id", "row", "s.pos", "s.gram", "s.digest")
    # written, so that the join is dealt by itself and a gram that stands in many texts can be split
    several = written(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("gram").alias("g")), "grams")
    segments_ = written(found.join(several, F.col("gram") == F.col("g"), "left_semi"), "segments")
    first = F.struct("doc_id", F.floor(F.col("pos") / PLACES).alias("start"), "pos", "row")
    contents = written(segments_.groupBy("gram", "digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies")), "contents")
    crowded = contents.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select(F.col("gram").alias("g"), F.lit(True).alias("crowded"))
    # a text's own segments only: the list is as long as the text
    wanted = (contents.join(crowded, F.col("gram") == F.col("g"), "left")
              .groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"))
              .agg(F.collect_list(F.struct("gram", "digest", "copies", F.col("first.pos").alias("pos"), F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("wanted")))
    concerned = segments_.select("doc_id", "row").distinct()
    concerned = concerned.join(wanted, same_row(concerned, wanted), "left").select(concerned["doc_id"], concerned["row"], "wanted")
    held = written(texts.join(concerned, same_row(texts, concerned)).select(texts["doc_id"], texts["row"], "text", "wanted"), "held")
    discard(texts)
    spelled = written(held.where("wanted IS NOT NULL").select("doc_id", "text", "wanted").mapInArrow(contents_of, CONTENTS), "spelled")
    shards = max(n, contents.count() // SHARD + 1)
    dealt = spelled.where("not crowded").withColumn("unit", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    firsts = (dealt.repartition(n, "unit").sortWithinPartitions("unit").mapInArrow(searched, FIRSTS)
              .unionByName(crowded_firsts(spelled)))
    firsts = written(firsts, "firsts")
    discard(spelled, contents)
    hits = segments_.join(firsts.withColumnsRenamed({"gram": "fg", "digest": "fd"}), (F.col("gram") == F.col("fg")) & (F.col("digest") == F.col("fd")))
    found = written(covered(hits).groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("stretches")), "stretches")
    discard(segments_, firsts)
    return held, found


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (null: nothing was removed) of every row of ``docs``.

    A null or empty text has no words. A row without id comes before all ids. Rows that share an id are one document: a window of one is
    earlier than the same window of another only where it starts earlier, so equal rows remove nothing from each other. Other columns
    are left out.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("mark"), text.alias("text"))
    least = F.when(~F.bool_or(F.col("doc_id").isNull()), F.min("doc_id"))
    texts = written(narrow.groupBy("mark").agg(least.alias("doc_id"), F.first("text").alias("text")).withColumn("row", F.xxhash64("text")), "texts")
    cuts = written(texts.select("doc_id", "row", "mark", "text").mapInArrow(cut, SEGMENTS), "cuts")
    held, found = stretches(texts, cuts)
    changed = (held.join(found, same_row(held, found)).select(held["doc_id"], held["row"], "text", "stretches")
               .mapInArrow(without, "doc_id bigint, row bigint, n_removed bigint, cut_sha256 string, kept_text string"))
    each = cuts.select("doc_id", "row", "mark", "n_words", "whole_sha256")
    each = written(each.join(changed, same_row(each, changed), "left")
                   .select(each["doc_id"].alias("of"), F.col("mark").alias("m"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                           F.coalesce("cut_sha256", "whole_sha256").alias("sha"), "kept_text"), "judged")
    discard(cuts, held, found)
    copy = ~F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("n_words") >= WINDOW)
    return (narrow.select("doc_id", "mark").join(each, F.col("mark") == F.col("m"))
            .select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
                    F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"),
                    F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")))


def op11_fm_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLE_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT rid, doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w
), g AS (
  SELECT rid, doc_id, s, md5(array_to_string(list_slice(words, s, s + 19), ' ')) AS win FROM p
), first AS (
  SELECT win, min({'known': doc_id IS NOT NULL, 'doc': coalesce(doc_id, 0), 's': s}) AS f FROM g GROUP BY 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(s, s + 20)) AS i FROM g JOIN first USING (win)
  WHERE f < {'known': doc_id IS NOT NULL, 'doc': coalesce(doc_id, 0), 's': s}
), spelled AS (
  SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS t FROM spelled ANTI JOIN gone USING (rid, i) GROUP BY 1
), lost AS (
  SELECT rid, count(*) AS n FROM gone GROUP BY 1
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (rid) LEFT JOIN kept USING (rid)
"""
