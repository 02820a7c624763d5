"""Prefix trie of conversations, built and summed by van Emde Boas recursion.

All sequences are cut at half of the depth that holds the longest. The part above the cut is the upper trie; what hangs below a cut is a
forest, named after the prefix that was cut off. Upper trie and forests are cut again in the same way, all of them at once, until a
piece has ``BASE`` turns: so there are as many rounds as the depth has binary digits, however long a conversation is, and every round works
on rows of (conversation, piece), spread over all tasks.

1. Way up: digests of whole pieces from the digests of their halves. Way down: a right half's forest is named by the digest of its left
   half and the name of the piece's own forest. A node's name follows from its forest's name and its turns inside the piece.
2. Nodes are the distinct names. The smallest member owns a node; the path of its owner lists a node's ancestors.
3. Totals are summed inside the pieces. Then round by round the totals of a lower forest are summed per cut prefix and grafted upward: they go
   to the prefix and its ancestors in the upper half of the piece, found on the owner's path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrain.llm.common import filled, ship, table, written

ship(__name__)

#: Turns of the pieces that are not cut again.
BASE = 4
#: Name of the textless root.
ROOT = ""
GROUP, SHARED = 20, 4


def short(value: Column) -> Column:
    """128 bits of the SHA-256, in hex."""
    return F.substring(F.sha2(value, 256), 1, 32)


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``nth`` (from 1, by turn, null first; ties by the turn's digest), ``mark`` (digest of role and text) and ``words`` of every turn.

    Ranges of (conversation, turn) are numbered by themselves and joined by sums over the ranges, so a long conversation is ordered by many tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    mark = short(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), mark.alias("mark"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = written(narrow.repartitionByRange(n, "conv_id", "turn", "mark").withColumn("part", F.spark_partition_id()), "turns")
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
            .select("c", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "mark")
    return (rows.withColumn("nth", F.row_number().over(inside)).join(sums, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")))
            .select("conv_id", (F.col("nth") + F.col("before")).alias("nth"), "mark", "words"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: ``(conv_id, length)``, and the turns as ``(conv_id, pos, mark, words)`` with ``pos`` from 0."""
    turns = written(ordered(conversations), "ordered")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("taken")
    convs = sizes.select("conv_id", "n", taken, (F.col("conv_id") - F.col("conv_id") % GROUP).alias("source"))
    of = sizes.select(F.col("conv_id").alias("s"), F.col("n").alias("there"))
    convs = written(convs.join(of, F.col("source") == F.col("s"), "left")
                    .select("conv_id", "source", "taken", F.least("taken", F.coalesce("there", F.lit(0))).alias("opening"), "n"), "conversations")
    lengths = convs.select("conv_id", (F.col("opening") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("length"))
    heads = turns.where(F.col("nth") < SHARED).select(F.col("conv_id").alias("s"), "nth", "mark", "words")
    opened = (convs.join(heads, (F.col("source") == F.col("s")) & (F.col("nth") <= F.col("taken")))
              .select("conv_id", (F.col("nth") - 1).alias("pos"), "mark", "words"))
    mine = convs.select(F.col("conv_id").alias("c"), "taken", "opening")
    own = (turns.join(mine, F.col("conv_id") == F.col("c")).where("nth > taken")
           .select("conv_id", (F.col("opening") + F.col("nth") - F.col("taken") - 1).alias("pos"), "mark", "words"))
    return lengths, opened.unionByName(own)


def named(lengths: DataFrame, turns: DataFrame, base: int) -> tuple[DataFrame, int]:
    """Pieces ``(conv_id, piece, length, above, names, words)`` of ``base`` turns, where ``above`` names the prefix before the piece, and the rounds."""
    longest = lengths.agg(F.max("length")).first()[0] or 0
    rounds = max(0, (-(-longest // base) - 1).bit_length())
    known = lengths.select(F.col("conv_id").alias("c"), "length")
    pieces = (turns.groupBy("conv_id", F.floor(F.col("pos") / base).alias("piece")).agg(F.array_sort(F.collect_list(F.struct("pos", "mark", "words"))).alias("t"))
              .join(known, F.col("conv_id") == F.col("c")).select("conv_id", "piece", "length", F.col("t.mark").alias("marks"), F.col("t.words").alias("words")))
    pieces = written(pieces, "pieces")

    # way up: digests of the left halves that something hangs below
    digests, size = [], base
    for k in range(rounds):
        if k == 0:
            whole = pieces.where(F.size("marks") == base).select("conv_id", "piece", "length", short(F.array_join("marks", "")).alias("digest"))
        else:
            both = F.array_sort(F.collect_list(F.struct("piece", "digest")))["digest"]
            whole = (digests[-1].groupBy("conv_id", F.floor(F.col("piece") / 2).alias("piece")).agg(both.alias("halves"), F.first("length").alias("length"))
                     .where("size(halves) = 2").select("conv_id", "piece", "length", short(F.array_join("halves", "")).alias("digest")))
        # what ends with its piece has nothing below, now or in a later round
        digests.append(written(whole.where(F.col("length") > (F.col("piece") + 1) * size), "digests"))
        size *= 2

    # way down: names of the forests
    above = lengths.where("length > 0").select("conv_id", F.lit(0).cast("long").alias("piece"), F.lit(ROOT).alias("above"))
    for k in reversed(range(rounds)):
        left = above.select("conv_id", (F.col("piece") * 2).alias("piece"), "above")
        cut = digests[k].select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "digest")
        right = (left.join(cut, (F.col("conv_id") == F.col("c")) & (F.col("piece") == F.col("p")))
                 .select("conv_id", (F.col("piece") + 1).alias("piece"), short(F.concat("above", "digest")).alias("above")))
        above = written(left.unionByName(right), "forests")
    forest = above.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "above")
    # the last name of a whole piece is the name of the forest below it only where no half is cut there, so forests keep names of their own
    inside = F.transform(F.sequence(F.lit(1), F.size("marks")), lambda i: short(F.concat(F.col("above"), F.lit("/"), F.array_join(F.slice("marks", F.lit(1), i), ""))))
    return written(pieces.join(forest, (F.col("conv_id") == F.col("c")) & (F.col("piece") == F.col("p")))
                   .select("conv_id", "piece", "length", "above", inside.alias("names"), "words"), "named"), rounds


def trie(lengths: DataFrame, turns: DataFrame, base: int = BASE) -> DataFrame:
    """All nodes: ``name, conv_id`` (smallest member)``, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``.

    ``lengths`` has ``conv_id`` and ``length`` of every conversation, ``turns`` its turns as ``(conv_id, pos, mark, words)``. Without conversations
    there is no root.
    """
    pieces, rounds = named(lengths, turns, base)
    ends = pieces.where("size(names) > 0").select(F.col("conv_id").alias("c"), (F.col("piece") + 1).alias("p"), F.element_at("names", -1).alias("upper"))
    linked = (pieces.join(ends, (F.col("conv_id") == F.col("c")) & (F.col("piece") == F.col("p")), "left")
              .withColumn("upper", F.coalesce("upper", F.lit(ROOT))))
    steps = (linked.select("conv_id", "piece", "upper", "names", F.posexplode(F.arrays_zip("names", "words")).alias("i", "s"))
             .select("conv_id", (F.col("piece") * base + F.col("i") + 1).alias("depth"), F.col("s.names").alias("name"), F.col("s.words").alias("words"),
                     F.when(F.col("i") == 0, F.col("upper")).otherwise(F.get("names", F.col("i") - 1)).alias("parent")))
    nodes = written(steps.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
                                              F.first("words").alias("words"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    children = nodes.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, F.col("name") == F.col("of"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("of"), "nodes")

    path = pieces.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "names")

    def given(weights: DataFrame) -> DataFrame:
        """Weights of ``(conv_id, piece, upto)`` for the first ``upto`` nodes of the piece."""
        met = weights.join(path, (F.col("conv_id") == F.col("c")) & (F.col("piece") == F.col("p")))
        each = met.select(F.explode(F.slice("names", F.lit(1), F.col("upto"))).alias("name"), "leaves", "saved")
        return each.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    place = F.col("depth") - 1
    own = nodes.select("conv_id", F.floor(place / base).alias("piece"), (place % base + 1).cast("int").alias("upto"),
                       F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = written(given(own), "totals")
    owner = nodes.select(F.col("name").alias("at"), "conv_id", "depth", "parent")
    for k in range(rounds):
        size = base << k
        tops = owner.where((F.col("depth") > size) & (F.floor((F.col("depth") - 1) / size) % 2 == 1) & ((F.col("depth") - 1) % size == 0))
        forests = (tops.join(totals, F.col("at") == F.col("name")).groupBy(F.col("parent").alias("cut"))
                   .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        last = F.floor((F.col("depth") - 1) / base)
        grafts = (forests.join(owner, F.col("cut") == F.col("at"))
                  .select("conv_id", F.explode(F.sequence(last - (1 << k) + 1, last)).alias("piece"), F.lit(base).alias("upto"), "leaves", "saved"))
        both = totals.unionByName(given(grafts))
        totals = written(both.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")

    summed = nodes.join(totals.withColumnRenamed("name", "t"), F.col("name") == F.col("t")).drop("t")
    first = nodes.where("depth = 1").join(totals.withColumnRenamed("name", "t"), F.col("name") == F.col("t"))
    below = first.agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = written(root.withColumn("one", F.lit(1)).join(below.withColumn("one", F.lit(1)), "one")
                   .select(F.lit(ROOT).alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"), "n_convs", "n_children", "leaves", "saved"), "root")
    every = summed.select("name", "conv_id", "depth", "parent", "n_convs", "n_children", "leaves", "saved").unionByName(root)
    up = every.where("n_children > 0").select(F.col("name").alias("u"), F.col("conv_id").alias("parent_conv_id"))
    return (every.join(up, F.col("parent") == F.col("u"), "left")
            .select("name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))), pieces


def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids, from rows sorted by node and id: a digest cannot be split, but its ids stream by."""
    node, sha = None, None
    for batch in filled(rows, 8192):
        done = []
        for name, conv in zip(batch.column("end").to_pylist(), batch.column("c").to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = name, hashlib.sha256(str(conv).encode())
            else:
                sha.update(f",{conv}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*done)], ["end", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()])], ["end", "ends_sha256"])


def with_ends(nodes: DataFrame, pieces: DataFrame, lengths: DataFrame, base: int = BASE) -> DataFrame:
    """``nodes`` with the digest of the ids of the conversations that end there."""
    last = pieces.where(F.col("piece") == F.floor((F.col("length") - 1) / base)).select(F.element_at("names", -1).alias("end"), F.col("conv_id").alias("c"))
    none = lengths.where("length = 0").select(F.lit(ROOT).alias("end"), F.col("conv_id").alias("c"))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shas = last.unionByName(none).repartition(n, "end").sortWithinPartitions("end", "c").mapInArrow(listed, "end string, ends_sha256 string")
    return (nodes.join(shas, F.col("name") == F.col("end"), "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).drop("end"))


def prefix_trie(conversations: DataFrame, base: int = BASE) -> DataFrame:
    """The trie of rebuilt ``conversations``: null roles and texts are empty, rows without conv_id belong to no conversation and are left out,
    repeated rows are turns like others, an empty table has no nodes, other columns are left out."""
    lengths, turns = rebuilt(conversations)
    nodes, pieces = trie(lengths, turns, base)
    return with_ends(nodes, pieces, lengths, base)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("name")


ORACLE_SQL = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), marks AS (
  SELECT conv_id, turn, sha256(length(role)::VARCHAR || ':' || role || text)[1:32] AS mark, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM raw
), lists AS (
  SELECT conv_id, list({'mark': mark, 'words': words} ORDER BY turn NULLS FIRST, mark) AS t FROM marks GROUP BY 1
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT), lambda c, b:
    list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295::BIGINT)) % 4 AS h FROM lists
), again AS (
  SELECT x.conv_id, list_concat(list_slice(coalesce(y.t, []), 1, x.h), list_slice(x.t, x.h + 1, len(x.t))) AS t
  FROM hashed x LEFT JOIN lists y ON y.conv_id = x.conv_id - x.conv_id % 20
), steps AS (
  SELECT conv_id, len(t) AS n, unnest(range(0, len(t) + 1)) AS depth, t FROM again
), named AS (
  SELECT conv_id, n, depth, array_to_string(list_transform(list_slice(t, 1, depth), lambda x: x.mark), ' ') AS name,
    array_to_string(list_transform(list_slice(t, 1, depth - 1), lambda x: x.mark), ' ') AS parent,
    CASE WHEN depth > 0 THEN t[depth].words ELSE 0 END AS words FROM steps
), nodes AS (
  SELECT name, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, min(words) AS words, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM named GROUP BY 1
), kids AS (
  SELECT parent AS name, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_ AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (name)
), totals AS (
  SELECT p.name, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM full_ u JOIN named p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY 1
)
SELECT v.conv_id, v.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM full_ v JOIN totals USING (name) LEFT JOIN full_ q ON v.depth > 0 AND q.name = v.parent
"""
