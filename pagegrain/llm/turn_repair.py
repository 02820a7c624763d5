"""Cheapest repair of damaged conversations, by depth-first branch-and-bound.

Rows are classed in SQL (blank, truncated, role initial). A first shuffle brings the narrow facts of each conversation together in turn order: a few
bytes a row, from which the search finds the edits. A second one brings the texts behind their conversation's edits, and they are edited as
they stream by: no conversation's texts are held.

Search: a node is a row and what the output ends with. Branches are tried in the order of their letters (Delete, Insert, Keep, Rerole) from an
explicit stack, so nodes come up in the order of their audits. A node is cut off if its cost and the suffix bound exceed the incumbent, or equal
it (an audit that comes later is greater), or if its row and ending were reached before at no higher cost (dominance). The suffix bounds
leave nothing out but the audit, so the first row's bound is the first ceiling, and the search is linear in the rows. When the stack is
empty, the incumbent is proved.

Ties in turn go by role, then by the text's SHA-256. A null conv_id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm.common import filled, ship, table, written

ship(__name__)

# Costs of the edits, and of leaving a truncated row in.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SOUND, UNFIT, CUT_OFF = 0, 1, 2
#: What the output ends with: nothing, a system row, a user row, an assistant row; the one that follows an insertion.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
#: What it costs to close the output with nothing or after an assistant row.
CLOSING = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
#: Conversations of so many rows are looked up: most are short, and many have the same roles and faults.
SHORT = 64
REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
EDITED = "conv_id bigint, position bigint, edit string, role string, text string"


def kept_as(ends: int, initial: str) -> int | None:
    """What the output ends with after keeping a row; None where its role cannot follow."""
    if initial == "s":
        return SYSTEM if ends == NOTHING else None
    if initial == "u":
        return USER if ends != USER else None
    return ASSISTANT if initial == "a" and ends == USER else None


def moves(ends: int, initial: str, fault: int) -> list[tuple[str, int, int, int]]:
    """Edits of the next row and insertions before it, by letter: (letter, cost, rows taken, what the output ends with)."""
    out = [("D", DELETE, 1, ends), ("I", INSERT, 0, NEXT[ends])]
    if fault != UNFIT:
        extra = TRUNCATED if fault == CUT_OFF else 0
        if (after := kept_as(ends, initial)) is not None:
            out.append(("K", extra, 1, after))
        if initial != "_ua"[NEXT[ends] - 1]:
            out.append(("R", REROLE + extra, 1, NEXT[ends]))
    return out


MOVES = {(e, i, f): moves(e, i, f) for e in range(4) for i in "sua?" for f in (SOUND, UNFIT, CUT_OFF)}
AT_END = [[("I", INSERT, 0, NEXT[e])] for e in range(4)]


def suffix_bounds(initials: str, faults: bytes) -> list[tuple[int, ...]]:
    """Least cost of the rows from each one on, by what the output ends with before it."""
    bounds = [CLOSING]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        after = bounds[-1]
        own = [min(c + after[e2] for _, c, taken, e2 in MOVES[e, initial, fault] if taken) for e in range(4)]
        bounds.append(tuple(min(own[e], INSERT + own[NEXT[e]], 2 * INSERT + own[NEXT[NEXT[e]]]) for e in range(4)))
    bounds.reverse()
    return bounds


def search(initials: str, faults: bytes) -> tuple[int, str]:
    """The least cost and the ASCII-least edits that reach it."""
    rows, bounds = len(initials), suffix_bounds(initials, faults)
    # nothing is cheaper than the first row's bound, and the bounds can be met: costlier nodes are cut off before there is an incumbent
    best_cost, best_audit = bounds[0][NOTHING] + 1, ""
    reached = [NEVER] * (4 * (rows + 1))
    path = bytearray()
    stack = [(0, NOTHING, 0, 0, "")]
    while stack:
        row, ends, cost, depth, letter = stack.pop()
        if cost + bounds[row][ends] >= best_cost or cost >= reached[4 * row + ends]:
            continue
        reached[4 * row + ends] = cost
        if depth:
            del path[depth - 1:]
            path += letter.encode()
        if row == rows and ends in (NOTHING, ASSISTANT):
            best_cost, best_audit = cost, path.decode()
            continue
        branches = MOVES[ends, initials[row], faults[row]] if row < rows else AT_END[ends]
        stack.extend((row + taken, after, cost + c, depth + 1, x) for x, c, taken, after in reversed(branches))
    return best_cost, best_audit


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by a checksum of conversation and turn; dropped ones are marked ``gone``. Nulls are one space."""
    def shown(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def reports(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and cheapest edits of conversations whose rows come in order."""
    def closed() -> tuple:
        joined = "".join(initials)
        cost, audit = (remembered if len(joined) <= SHORT else search)(joined.translate(known), bytes(faults))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit

    known, remembered = Roles(), lru_cache(1 << 16)(search)
    conv, initials, faults, seen, turns, counts, started = None, [], bytearray(), set(), None, {}, False
    for batch in filled(rows, 4096):
        out = []
        for c, turn, role, mark, fault, gone in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "mark", "fault", "gone"))):
            if not started or c != conv:
                if started:
                    out.append(closed())
                conv, initials, faults, seen, turns, started = c, [], bytearray(), set(), None, True
                counts = {"blank": 0, "duplicate": 0, "truncated": 0}
            if gone:
                continue
            if turn is not None:
                turns = (turn, turn, 1) if turns is None else (turns[0], turn, turns[2] + (turn != turns[1]))
            twin = hashlib.blake2b(f"{mark}{role}".encode(), digest_size=16).digest()
            if fault != "blank" and twin in seen:
                fault = "duplicate"
            seen.add(twin)
            if fault != "none":
                counts[fault] += 1
            initials.append(role[:1] or "?")
            faults.append({"none": SOUND, "truncated": CUT_OFF}.get(fault, UNFIT))
        if out:
            yield table_of(out)
    if started:
        yield table_of([closed()])


class Roles(dict):
    """Initials that no role has become a question mark."""

    def __missing__(self, key: int) -> str:
        return chr(key) if chr(key) in "sua" else "?"


def table_of(out: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in REPORT.split(", ")]
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)


def edited(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come behind their conversation's edits, edited one by one. Each conversation starts with a row at position -1."""
    out: list[tuple] = []
    conv = audit = None
    at = position = 0
    ends = NOTHING

    def put(letter: str, role: str, text: str) -> None:
        nonlocal position, ends
        out.append((conv, position, letter, role, text))
        position += 1
        ends = kept_as(ends, role[:1]) if letter == "K" else NEXT[ends]

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put("I", "_,user,assistant".split(",")[NEXT[ends] - 1], "")
            at += 1

    def flushed() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], [c.split()[0] for c in EDITED.split(", ")])
        out.clear()
        return batch

    for batch in filled(rows, 512):
        for c, head, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text"))):
            if head is not None:
                if audit is not None:
                    inserted()
                conv, audit, at, position, ends = c, head, 0, 0, NOTHING
                out.append((conv, -1, None, None, None))
                continue
            inserted()
            letter = audit[at]
            at += 1
            if letter == "K":
                put("K", role, text)
            elif letter == "R":
                put("R", "_,user,assistant".split(",")[NEXT[ends] - 1], text)
        if out:
            yield flushed()
    if audit is not None:
        inserted()
    if out:
        yield flushed()


def digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, from rows in order."""
    conv, sha, started = None, None, False
    for batch in filled(rows, 512):
        done = []
        for c, position, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "position", "role", "text"))):
            if position < 0:
                if started:
                    done.append((conv, sha.hexdigest()))
                conv, sha, started = c, hashlib.sha256(), True
            else:
                sha.update((f"\n{role}:" if position else f"{role}:").encode())
                sha.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])
    if started:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()])], ["conv_id", "repaired_sha256"])


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation: its faults, and the cost and letters of the cheapest edits. ``rows`` as ``damaged`` gives them."""
    white = "' \\t\\n\\u000b\\f\\r'"
    bare = F.expr(f"rtrim({white}, text)")
    fault = F.when(bare == "", "blank").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "none").otherwise("truncated")
    narrow = rows.select("conv_id", "turn", "role", F.sha2("text", 256).alias("mark"), fault.alias("fault"), "gone")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return narrow.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "mark").mapInArrow(reports, REPORT)


def apply_repairs(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired rows in order (``position`` from 0, ``edit``, ``role``, ``text``), each conversation behind a row at position -1."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = plans.select("conv_id", "audit", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("mark"),
                         F.lit(None).cast("string").alias("text"))
    behind = rows.where("not gone").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", F.sha2("text", 256).alias("mark"), "text")
    both = heads.unionByName(behind).repartition(n, "conv_id")
    order = ["conv_id", F.col("audit").isNull(), "turn", "role", "mark"]
    return both.sortWithinPartitions(*order).select("conv_id", "audit", "role", "text").mapInArrow(edited, EDITED)


def repaired(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after damage and repair: ``conv_id``, ``position``, ``edit`` (K, R or I), ``role``, ``text``.

    Nulls in role and text are one space; null turns come first; an empty table gives no rows; other columns are left out.
    """
    rows = damaged(conversations)
    return apply_repairs(rows, plan_repairs(rows)).where("position >= 0")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    plans = written(plan_repairs(rows), "plans")
    shas = apply_repairs(rows, plans).mapInArrow(digests, "conv_id bigint, repaired_sha256 string")
    return plans.join(shas.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


ORACLE_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS id,
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key FROM conversations
), kinds AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(key, lambda x: ord(x)::BIGINT), lambda c, b:
    list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295::BIGINT)) % 20 AS kind FROM raw
), rows AS (
  SELECT conv_id, turn, id, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 0 THEN []::INT[] WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds
), convs AS (
  SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)
), sorted AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), id, copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, left(role, 1) AS initial
  FROM rows JOIN convs ON rows.conv_id IS NOT DISTINCT FROM convs.conv_id
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lead(initial) OVER (PARTITION BY conv ORDER BY i) AS following FROM sorted
), inserts(q, q1, added, c) AS (
  VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 3), (1, 2, 'I', 3), (2, 3, 'I', 3), (3, 2, 'I', 3),
    (0, 3, 'II', 6), (1, 3, 'II', 6), (2, 2, 'II', 6), (3, 3, 'II', 6)
), edits(q1, initial, letter, q2, cc) AS (
  VALUES (0, NULL, 'D', 0, 4), (1, NULL, 'D', 1, 4), (2, NULL, 'D', 2, 4), (3, NULL, 'D', 3, 4),
    (0, 's', 'K', 1, 0), (0, 'u', 'K', 2, 0), (1, 'u', 'K', 2, 0), (3, 'u', 'K', 2, 0), (2, 'a', 'K', 3, 0),
    (0, NULL, 'R', 2, 3), (1, NULL, 'R', 2, 3), (2, NULL, 'R', 3, 3), (3, NULL, 'R', 2, 3)
), best AS (
  SELECT conv, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit FROM convs
  UNION ALL
  SELECT conv, i, q2, cost, audit FROM (
    SELECT *, row_number() OVER (PARTITION BY conv, q2 ORDER BY cost, audit) AS place FROM (
      SELECT b.conv, r.i, e.q2, b.cost + n.c + e.cc + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
        b.audit || n.added || e.letter AS audit
      FROM best b JOIN faults r ON r.conv = b.conv AND r.i = b.i + 1 JOIN inserts n ON n.q = b.q JOIN edits e ON e.q1 = n.q1
      WHERE (e.initial IS NULL OR e.initial = r.initial) AND (e.letter = 'D' OR r.fault IN ('none', 'truncated'))))
  WHERE place = 1
), counted AS (
  SELECT conv, max(i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal,
    max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps
  FROM faults GROUP BY 1
), final AS (
  SELECT conv, min({'cost': cost + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 'audit': audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS f
  FROM best JOIN convs USING (conv) LEFT JOIN counted USING (conv) WHERE i = coalesce(n, 0) GROUP BY 1
), letters AS (
  SELECT conv, unnest(string_split(f.audit, '')) AS letter, unnest(range(1, len(f.audit) + 1)) AS p FROM final WHERE f.audit <> ''
), placed AS (
  SELECT conv, letter, p, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY conv ORDER BY p)
), shown AS (
  SELECT p.conv, place, letter, CASE letter WHEN 'I' THEN '' ELSE text END AS text, role,
    max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv) AS system
  FROM placed p LEFT JOIN faults f ON f.conv = p.conv AND f.i = p.i WHERE letter <> 'D'
), texts AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS t
  FROM shown GROUP BY 1
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, f.cost::BIGINT AS cost, f.audit AS audit,
  sha256(coalesce(t, '')) AS repaired_sha256
FROM convs JOIN final USING (conv) LEFT JOIN counted USING (conv) LEFT JOIN texts USING (conv)
"""
