"""Passages, conversation repair and prefix tries against brute-force versions: nulls, long and empty texts, ties, repeated rows, clashing columns."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagegrain.llm import passages, prefix_trie, turn_repair
from pagegrain.llm.fm_index import FMIndex

DOCS = "doc_id bigint, text string, lang string"
TALK = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11

def some_words(seed, n, kinds=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


PASSAGE = some_words(1, 70)
LINE = some_words(2, 30)


def passage_rows():
    out = [(0, None), (1, ""), (2, " \n "), (3, "few words only"), (4, " ".join(PASSAGE)), (5, "\t".join(some_words(3, 40) + PASSAGE + some_words(4, 40))),
           (6, " ".join(PASSAGE[5:24])), (7, " ".join(PASSAGE[5:25])), (8, "a " * 500), (9, "b a " + "a " * 300), (10, " ".join(some_words(5, 25) * 4)),
           (10, "another text of the same id " + " ".join(PASSAGE)), (None, " ".join(some_words(6, 20) + PASSAGE[:30])), (None, None),
           (4, " ".join(PASSAGE)), (11, " ".join(some_words(7, 9000) + PASSAGE[20:] + some_words(7, 200)))]
    out += [(100 + i, " ".join(some_words(100 + i, 15) + LINE + some_words(300 + i, 15))) for i in range(60)]
    return [(d, t, "en") for d, t in out]


def passages_by_hand(rows):
    key = lambda d: (d is not None, d or 0)
    first = {}
    for doc, text, _ in rows:
        words = passages.words_of(text)
        for i in range(len(words) - 19):
            window, here = tuple(words[i:i + 20]), (key(doc), i)
            first[window] = min(first.get(window, here), here)
    out = []
    for doc, text, _ in rows:
        words = passages.words_of(text)
        gone = set()
        for i in range(len(words) - 19):
            if first[tuple(words[i:i + 20])] < (key(doc), i):
                gone.update(range(i, i + 20))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


@pytest.mark.parametrize("crowded", [2048, 8])
def test_passages(spark, monkeypatch, crowded):
    monkeypatch.setattr(passages, "CROWDED", crowded)
    rows = passage_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns({"row": F.lit(1), "gram": F.lit("x"), "n_words": F.lit(7)})
    got = [tuple(r) for r in passages.deduplicated(docs).collect()]
    want = passages_by_hand(rows)
    order = lambda r: (str(r[0]), r[1], r[2], r[3])
    assert sorted((r[:4] for r in got), key=order) == sorted((r[:4] for r in want), key=order)
    texts = {r[3]: r[4] for r in want}
    assert all(r[4] is None or r[4] == texts[r[3]] for r in got)
    removed = {r[0]: r[2] for r in got}
    assert removed[5] == 70 and removed[6] == 0 and removed[7] == 20 and removed[100] == 0 and removed[101] == 30


def test_passages_of_nothing(spark):
    assert passages.deduplicated(spark.createDataFrame([], DOCS)).collect() == []
    got = passages.deduplicated(spark.createDataFrame([(1, None, None)], DOCS)).first()
    assert (got.n_words, got.n_removed, got.kept_sha256) == (0, 0, sha(""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=20), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=20), max_size=4), st.integers(1, 7))
def test_matching_statistics(texts, queries, depth):
    """Also of words and queries that the index does not hold."""
    queries = queries + texts
    index = FMIndex(np.array(sum(texts, []), np.uint64), np.array([len(t) for t in texts]), depth)
    index.least(np.arange(sum(map(len, texts))))
    found, rows = index.statistics(np.array(sum(queries, []), np.uint64), np.array([len(q) for q in queries]))
    starts = np.cumsum([0] + [len(t) for t in texts])
    at = 0
    for q in queries:
        for i in range(len(q)):
            places = lambda k: [starts[x] + j for x, t in enumerate(texts) for j in range(len(t) - k + 1) if t[j:j + k] == q[i:i + k]]
            most = max((k for k in range(1, min(depth, len(q) - i) + 1) if places(k)), default=0)
            assert found[at] == most
            if most == depth:
                assert index.smallest_at(rows[at:at + 1])[0] == min(places(depth))
            at += 1


# --- 12

def cheapest(initials, faults):
    """Best-first over all edit strings: the first complete one is the cheapest and ASCII-least."""
    queue = [(0, "", 0, "")]
    while queue:
        cost, audit, i, out = heapq.heappop(queue)
        if i == len(initials) and (not out or out[-1] == "a"):
            return cost, audit
        ways = [(3, "I", 0, "u" if not out or out[-1] != "u" else "a")]
        if i < len(initials):
            ways.append((4, "D", 1, ""))
            if faults[i] != turn_repair.UNFIT:
                extra = 3 * (faults[i] == turn_repair.CUT_OFF)
                ways += [(extra, "K", 1, initials[i])] + [(3 + extra, "R", 1, x) for x in "ua" if x != initials[i]]
        for c, letter, taken, added in ways:
            new = out + added
            # only the first and the last two letters matter
            fits = (not added) or (added in "sua" and (len(new) == 1 and added != "a" or len(new) > 1 and new[-2:] in ("su", "ua", "au")))
            if fits:
                heapq.heappush(queue, (cost + c, audit + letter, i + taken, new))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua?"), st.integers(0, 2)), max_size=5))
def test_search(rows):
    initials, faults = "".join(r[0] for r in rows), bytes(r[1] for r in rows)
    assert turn_repair.search(initials, faults) == cheapest(initials, faults)


def test_search_is_linear():
    rng = random.Random(5)
    rows = [(rng.choice("sua?"), rng.randrange(3)) for _ in range(50_000)]
    cost, audit = turn_repair.search("".join(r[0] for r in rows), bytes(r[1] for r in rows))
    assert len(audit) >= 50_000 and cost > 0


def crc(text):
    return zlib.crc32(text.encode())


def talk_rows():
    rng = random.Random(9)
    said = ["Hello there.", "How so?", "no end", "", "   ", "Fine!", "What. ", "tail . x", None, "long " * 3000 + "."]
    out = []
    for conv in range(60):
        turn = 0
        for _ in range(rng.randrange(1, 9)):
            out.append((conv, turn if rng.random() > 0.05 else None, rng.choice(["user", "assistant", "system", "tool", None, "user", "assistant"]), rng.choice(said)))
            turn += rng.choice([1, 1, 1, 2, 0])
    out += [(None, 1, "user", "No conversation."), (None, None, "assistant", "None."), (77, None, None, None)] + [out[3]] * 2
    return out + [(500, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(300)]


def repairs_by_hand(rows):
    shown = lambda v: " " if v is None else str(v)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = crc(f"{shown(conv)}:{shown(turn)}") % 20
        role, text = shown(role), shown(text)
        text = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(kind, text)
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))
        seen, faults = set(), []
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            faults.append({None: 0, "truncated": 2}.get(fault, 1))
        known = [t[0] for t in turns if t[0] is not None]
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = turn_repair.search("".join(i if i in tuple("sua") else "?" for i in initials), bytes(faults))
        repaired, i = [], 0
        for letter in audit:
            following = "user" if not repaired or repaired[-1][0][:1] != "u" else "assistant"
            if letter == "I":
                repaired.append((following, ""))
                continue
            if letter != "D":
                repaired.append((turns[i][1] if letter == "K" else following, turns[i][2]))
            i += 1
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts.values(), illegal, cost, audit,
                     sha("\n".join(f"{r}:{t}" for r, t in repaired)))
    return out


def test_repair(spark, tmp_path):
    rows = talk_rows()
    spark.createDataFrame(rows, TALK).withColumns({"audit": F.lit("x"), "kind": F.lit(1)}).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in turn_repair.op12_turn_repair(spark, str(tmp_path)).collect()}
    assert got == repairs_by_hand(rows)


def test_repaired_rows(spark):
    rows = turn_repair.repaired(spark.createDataFrame(talk_rows(), TALK)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    for turns in by.values():
        turns.sort(key=lambda r: r.position)
        roles = "".join(r.role[0] for r in turns).removeprefix("s")
        assert roles and roles == "ua" * (len(roles) // 2) and [r.position for r in turns] == list(range(len(turns)))
    assert turn_repair.repaired(spark.createDataFrame([], TALK)).collect() == []


# --- 13

def trie_by_hand(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, sha(f"{len(r[1])}:{r[1]}{r[2]}")))
    again = {}
    for conv, turns in convs.items():
        h = crc(str(conv)) % 4
        again[conv] = tuple(t[1:] for t in convs.get(conv - int(np.fmod(conv, 20)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for conv, seq in sorted(again.items()):
        ends[seq].append(conv)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(passages.words_of(node[-1][1])) if node else 0
        below = [totals[k] for k in kids[node]]
        totals[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[node]) - 1) * words)
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(kids[n]), *totals[n], sha(",".join(map(str, ends[n])))) for n, m in members.items())


def trie_rows():
    rng = random.Random(4)
    said = ["yes", "no", "well then, go on", "", None]
    out = [(conv, t, "user" if t % 2 == 0 else "assistant", rng.choice(said)) for conv in range(-25, 130) for t in range(rng.randrange(1, 8)) if conv % 37 != 0]
    out += [(c, t, "user", f"turn {t % 7}") for c in (200, 201, 202, 203) for t in range(rng.randrange(60, 90))]
    return out + [(None, 0, "user", "yes"), (300, None, None, None), (301, None, "user", "b"), (301, None, "user", "a"), (301, 0, "user", "a")] + [out[0]] * 3


@pytest.mark.parametrize("base", [1, 4])
def test_trie(spark, base):
    rows = trie_rows()
    talk = spark.createDataFrame(rows, TALK).withColumns({"name": F.lit("x"), "nth": F.lit(0), "part": F.lit("y")})
    got = prefix_trie.prefix_trie(talk, base).collect()
    assert sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got) == trie_by_hand(rows)
    assert [r.parent_conv_id for r in got if r.depth == 0] == [None]


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TALK)).collect() == []
    turnless = next(c for c in range(1, 20) if crc(str(c)) % 4 > 0)
    got = prefix_trie.prefix_trie(spark.createDataFrame([(turnless, 0, "user", "hi")], TALK)).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got] == [(turnless, 0, 1, 0, 1, 0, sha(str(turnless)))]
