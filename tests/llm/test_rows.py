"""Every operator and stage on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import bisect
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagegrain.llm import language, maxscore, near_dedup, packing, pii, piece_codec, quality_rules, sharding, token_orc, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals look on from under the old oak tree"


def rows(*texts, start=0):
    return [(start + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]


ODD = rows(None, "", "   ", "a", "one two three", PROSE, PROSE, PROSE + " now", "x" * 30000, "1 " * 4000,
           "mail a.b@c.org or +1 (212) 555-0100, ip 10.0.0.1 and 4111 1111 1111 1111.", "$$$ %%%\n\nlast  line \n", "é ß ＡＢ 😀 ﬁ ▁x ▁ y",
           (PROSE + "\n") * 30, "<|endoftext|> a<|endoftext|>b", " lead and trail ", "tab\tand\r\nmore   space")


@pytest.fixture(scope="module")
def odd(spark):
    table = ODD + [(3, "repeated id", "en", None, 11), (None, "no id at all", None, None, None), (None, None, None, None, None), ODD[5], ODD[5]]
    return spark.createDataFrame(table, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clash(df, *names):
    """``df`` with text columns of an operator's own output names."""
    return df.withColumns({n: F.lit("theirs") for n in names})


def ids_of(name, text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- 1

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_are_those_of_the_plain_patterns(spark, odd):
    rng = np.random.default_rng(5)
    bits = ["a", "b", "@", "@", ".", ".", "-", "+", "+1", "1", "2", "55", "255", "256", "0255", " ", " ", "(", ")", "_", "%", "4111111111111111", "x@y.z", "[at]",
            "10.0.0.1", "é", "😀", "\n", "+49 (30) 1234567", "555-1234", "(212) 555-1234", "a@b.c@d.e"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 40))) for _ in range(1500)] + ["a" * 20000, "1." * 8000, "a.b@c" + ".d" * 5000, "1 " * 9000, "+1" + "(" * 5000 + "2"]
    docs = spark.createDataFrame(rows(*texts), DOCS).unionByName(odd)
    out = pii.tagged(clash(docs, "base", "spans", "c", "t"), pii.train(docs)).select("text", "base", "spans").collect()
    assert len(out) == docs.count()
    for r in out:
        assert [tuple(s) for s in r["base"]] == base_spans(r["text"])
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_pii_redaction(spark, odd, empty):
    model = pii.train(odd)
    out = {r["doc_id"]: r for r in pii.redacted(odd, model).collect()}
    assert out[10]["text"] == "mail [EMAIL] or [PHONE], ip [IP] and [CARD]." and out[10]["n_chars"] == len(out[10]["text"])
    assert out[0]["text"] is None and out[1]["text"] == "" and out[5]["text"] == PROSE
    assert pii.redacted(empty, pii.train(empty)).count() == 0


def test_pii_reliability_is_learned():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.5
    right = np.array([0.95, 0.9, 0.6])
    votes = np.where(rng.random((4000, 3)) < right, truth[:, None], ~truth[:, None]) * 2
    patterns = Counter(map(tuple, votes.tolist()))
    q, given = pii.maximise(np.array(list(patterns)), np.array(list(patterns.values()), float))
    assert abs(given[0, 1, 2] - 0.95) < 0.06 and abs(given[2, 1, 2] - 0.6) < 0.06
    assert q[list(patterns).index((2, 2, 2))] > 0.95


# --- 2

def sets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_components(table):
    known = [(i, sets(t)) for i, t in table if i is not None]
    parent = {i: i for i, _ in known}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(known):
        for j, t in known[a + 1:]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_near_duplicates_have_all_links(spark, odd, empty):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(400)]
    base = list(rng.choice(vocabulary, 160))
    texts = []
    for i in range(140):  # one large group whose members are close to some others only
        copy = list(base)
        for at in rng.integers(0, len(copy), rng.integers(0, 12)):
            copy[at] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    for i in range(40):  # a chain: neighbours are close, its ends are not
        texts.append(" ".join(f"c{j}" for j in range(6 * i, 6 * i + 100)))
    texts += [" ".join(rng.choice(vocabulary, 60)) for _ in range(60)] + ["A b", "a  B", "a b c", ""]
    table = [r[:2] for r in rows(*texts, start=100)] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    # one id with three texts: each of them links it
    table += [(5000, " ".join(f"p{j}" for j in range(90))), (5000, ""), (5000, " ".join(f"q{j}" for j in range(90))),
              (5001, " ".join(f"q{j}" for j in range(3, 90))), (4999, " ".join(f"p{j}" for j in range(90)))]
    docs = clash(spark.createDataFrame(table, "doc_id bigint, text string"), "id", "rep", "comp", "digest", "kept")
    found = near_dedup.near_duplicates(docs).collect()
    want = brute_components(table)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in found) == Counter((i, len(sets(t))) for i, t in table)
    for r in found:
        assert r["component_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else None)
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    kept = near_dedup.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))
    assert near_dedup.near_duplicates(empty).count() == 0


def test_estimate_follows_similarity():
    s = near_dedup.Sketcher()
    rng = np.random.default_rng(3)
    for j in (0.3, 0.6, 0.75, 0.9):
        common, own = int(4000 * j), int(4000 * (1 - j) / 2)
        x = rng.integers(0, 2**63, common + 2 * own, dtype=np.uint64)
        a, b = (np.frombuffer(s.packed(s.minima(y)), np.uint8) for y in (x[:common + own], np.append(x[:common], x[common + own:])))
        assert abs(float(near_dedup.similarity(a, b)) - j) < near_dedup.MARGIN


def test_estimate_loses_no_more_than_the_bands():
    """Chances that a pair at the threshold is lost: in the estimate (binomial count of equal minima) and in all bands."""
    j, chance = near_dedup.PERCENT / 100, 1 / (1 << near_dedup.BITS)
    equal = chance + (1 - chance) * j
    need = math.ceil(near_dedup.HASHES * (chance + (1 - chance) * (j - near_dedup.MARGIN)) - 1e-9)
    lost = sum(math.comb(near_dedup.HASHES, i) * equal**i * (1 - equal) ** (near_dedup.HASHES - i) for i in range(need))
    assert lost <= (1 - j**near_dedup.BAND_ROWS) ** near_dedup.BANDS


# --- 3

def test_token_files_round_trip(spark, odd, empty, tmp_path):
    path = public_tokenizers.path(token_orc.VOCABULARY)
    docs = clash(odd, "ids", "first", "file", "__tie")
    token_orc.write_tokens(docs, f"{tmp_path}/tokens", path, files=3)
    back = token_orc.read_tokens(spark, f"{tmp_path}/tokens").collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in back) == Counter((r["doc_id"], tuple(ids_of(token_orc.VOCABULARY, r["text"], 2))) for r in odd.collect())
    back.sort(key=lambda r: r["start"])
    assert [r["start"] for r in back] == [sum(r["n_tokens"] for r in back[:i]) for i in range(len(back))]
    assert [r["doc_id"] for r in back] == sorted((r["doc_id"] for r in back), key=lambda i: (i is not None, i))
    token_orc.write_tokens(empty, f"{tmp_path}/none", path)
    assert token_orc.read_tokens(spark, f"{tmp_path}/none").count() == 0


def test_token_files_prune_by_id(spark, odd, tmp_path):
    token_orc.write_tokens(odd.where("doc_id IS NOT NULL"), f"{tmp_path}/tokens", public_tokenizers.path(token_orc.VOCABULARY), files=4)
    found = token_orc.read_files(spark, f"{tmp_path}/tokens").where("doc_id = 7")
    assert "EqualTo(doc_id,7)" in found._jdf.queryExecution().toString()
    assert [r["doc_id"] for r in found.collect()] == [7]


def walked_by_hand(keys: list[tuple[int, tuple]], owners: list[int], room: list[int]) -> dict[int, int]:
    """Key by key: ``keys`` are (node, priority) in any order; returns shard by position in ``keys``."""
    room, out, late = list(room), {}, []
    for i in sorted(range(len(keys)), key=lambda i: keys[i]):
        shard = owners[keys[i][0]]
        if room[shard]:
            room[shard] -= 1
            out[i] = shard
        else:
            late.append(i)
    for i in late:
        at = keys[i][0]
        while not room[owners[at]]:
            at = (at + 1) % len(owners)
        room[owners[at]] -= 1
        out[i] = owners[at]
    return out


def place_by_hand(shards: int, virtual_nodes: int, place: int) -> int:
    """Node of one place."""
    ends = [p for p, _ in sharding.ring(shards, virtual_nodes)]
    return bisect.bisect_left(ends, place) % len(ends)


# --- 4

def test_ring_is_the_key_by_key_walk(spark, odd, empty):
    docs = spark.createDataFrame(rows(*[f"t{i % 7}" for i in range(400)], start=1000), DOCS).unionByName(odd)
    got = sharding.ring_shards(clash(docs, "shard", "slot", "node", "size"), shards=5, virtual_nodes=8)
    found = got.collect()
    nodes = sharding.ring(5, 8)
    counts = Counter(r["shard"] for r in found)
    assert sum(counts.values()) == docs.count() and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(counts[shard]))
    for r in found:
        text = r["text_crc32"]
        assert r["size"] >= 1 and text >= 0
    # how many of a node's keys go where equals the key-by-key walk
    owners = [s for _, s in nodes]
    keys = sorted(r["node"] for r in found)
    walked = walked_by_hand([(n, (i,)) for i, n in enumerate(keys)], owners, sharding.capacities(len(keys), 5))
    assert Counter((r["node"], r["shard"]) for r in found) == Counter((keys[i], s) for i, s in walked.items())
    place = {r["doc_id"]: r["h"] for r in docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    assert all(r["node"] == place_by_hand(5, 8, place[r["doc_id"]]) for r in found if r["doc_id"] is not None)
    assert sharding.ring_shards(empty).count() == 0


def test_ring_moves_little(spark):
    docs = spark.createDataFrame(rows(*["t"] * 4000), DOCS)
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.ring_shards(docs, shards=n).collect()} for n in (16, 17))
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.3 * len(before)  # counts that differ by one at most cost more than 1/17, but far less than a new hash would


# --- 5

def check_packing(found, table, window):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    want = defaultdict(list)
    for i, text in table:
        ids = ids_of(packing.VOCABULARY, text, 1)
        want[i] += [(s, len(ids[s:s + window]), crc(ids[s:s + window]), len(ids)) for s in range(0, len(ids), window)]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    return sum(n for p in by_sequence.values() for _, n in p) / (window * len(by_sequence))


def test_packing_holds_every_id_once(spark, odd, empty):
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame(rows(*[" ".join(["fox"] * int(n)) for n in rng.integers(1, 300, 600)], start=1000), DOCS).unionByName(odd)
    pieces = packing.cut_documents(clash(docs, "ids", "start", "offset"), public_tokenizers.path(packing.VOCABULARY), window=256)
    packed = packing.pack(pieces, window=256, step=4)
    fill = check_packing(packed.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 256)
    assert fill > 0.95
    whole = packing.sequences(pieces, packed).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == pieces.agg(F.sum("length")).first()[0]
    none = packing.cut_documents(empty, public_tokenizers.path(packing.VOCABULARY))
    assert packing.pack(none).count() == 0


def test_short_pieces_fill_their_sequences(spark):
    short = [(i, 0, 1 + 7 * (i % 2), 1, None, i, i) for i in range(6000)]
    pieces = spark.createDataFrame(short, packing.PIECES + ", ids_crc32 bigint, piece_id bigint")
    packed = packing.pack(pieces).collect()
    assert Counter(r["doc_id"] for r in packed) == Counter(range(6000))
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= packing.WINDOW
    assert len(by_sequence) == -(-(3000 * 9) // packing.WINDOW)


def test_least_squares_fits_and_stays_positive():
    a = np.array([[1.0, 0, 2], [0, 1, 1], [1, 1, 0]])
    x = packing.least_squares(a, a @ np.array([3.0, 0, 2]))
    assert np.allclose(x, [3, 0, 2]) and (packing.least_squares(a, np.array([-1.0, -2, -3])) == 0).all()


def test_patterns_use_the_histogram_up():
    rng = np.random.default_rng(6)
    histogram = {k: int(rng.integers(0, 50)) for k in range(1, 33)}
    used = Counter()
    for lengths, n in packing.patterns(histogram, 32):
        assert sum(lengths) <= 32
        used.update({k: n * m for k, m in Counter(lengths).items()})
    assert +used == +Counter(histogram)


# --- 6

def brute_top(table, k=5, every=50):
    vectors = {}
    for i, v in table:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([int(np.floor(256 * float(x))) for x in v])
    out = []
    for q, own in vectors.items():
        if q % every == 0:
            scores = sorted(((-sum(a * b for a, b in zip(min(own), v)), i) for i, vs in vectors.items() if i != q for v in vs))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_maxscore_is_exact(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "VECTORS_PER_BLOCK", 97)
    monkeypatch.setattr(maxscore, "QUERIES_PER_BLOCK", 3)
    rng = np.random.default_rng(7)
    table = [(i, [float(x) for x in rng.normal(0, 0.3, 24).astype(np.float32)]) for i in range(600)]
    table += [(700 + i, table[0][1]) for i in range(40)] + [(50, table[3][1]), (900, None), (950, [1.0, None]), (1000, [float("nan")] * 24), (1050, [float("inf")]), (None, [1.0] * 24),
                                                            (1100, []), (1150, [0.5, -0.5]), (1200, [1e6] * 24)]
    docs = spark.createDataFrame(table, "vec_id bigint, embedding array<float>").withColumns({"score": F.lit("x"), "vector": F.lit(1)})
    got = sorted(tuple(r) for r in maxscore.top_k(docs, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    table = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in table]
    assert got == brute_top(table)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in maxscore.top_k(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 131072)]
    assert maxscore.top_k(few.where("vec_id > 5"), F.col("vec_id") % 50 == 0).count() == 0


# --- 7

def test_archive_rebuilds_records(spark, tmp_path):
    table = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u\r\nWARC-Type: forged", "é"), (0, "http://z", "<p>x</p>"), (0, "http://z", "<p>x</p>"),
             (None, "n", "<p>x</p>"), (None, "n", "only"), (None, None, "only"), (9, "long", "y" * 100000)]
    pages = spark.createDataFrame(table, "page_id bigint, url string, html string").withColumns({"digest": F.lit("x"), "payload": F.lit("x")})
    warc.write_archive(pages, f"{tmp_path}/archive")
    got = warc.read_archive(spark, f"{tmp_path}/archive").collect()
    assert warc.read_payloads(spark, f"{tmp_path}/archive").count() == 5
    firsts = {"<p>x</p>": 0, "": 3, "é": 5, "y" * 100000: 9}
    want = Counter()
    for i, _, html in table:
        html = html or ""
        first = firsts.get(html)
        revisit = first is not None and i != first
        want[i, html, "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter((r["page_id"], bytes(r["payload"]).decode(), r["record_type"], r["refers_to"]) for r in got) == want
    for r in got:
        head, _, block = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode()) and block.endswith(b"\r\n\r\n")
        digest = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest())
        assert b"WARC-Payload-Digest: sha1:" + digest in head and f"Content-Length: {len(block) - 4}".encode() in head
    none = pages.where("page_id > 100")
    warc.write_archive(none, f"{tmp_path}/none")
    assert warc.read_archive(spark, f"{tmp_path}/none").count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "xx"), (4, "a", "xx")], "page_id bigint, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/archive", least_bytes=2)
    assert {r["page_id"]: r["record_type"] for r in warc.read_headers(spark, f"{tmp_path}/archive").collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_damaged_payload_is_refused(spark, tmp_path):
    spark.createDataFrame([("00", bytearray(b"x"))], "digest string, payload binary").write.parquet(f"{tmp_path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_payloads(spark, str(tmp_path)).collect()


# --- 8

def brute_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_counts(spark, odd, empty):
    rng = np.random.default_rng(8)
    bits = ["a", "b", "cc", "é", " ", " ", "\n", "\t", "#", "$|", " ", "\x0b"]
    docs = spark.createDataFrame(rows(*["".join(rng.choice(bits, rng.integers(0, 120))) for _ in range(400)], start=1000), DOCS).unionByName(odd)
    out = quality_rules.judged(clash(docs, "n_words", "kept", "h", "w"), []).collect()
    assert len(out) == docs.count()
    for r in out:
        want = brute_counts(r["text"])
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r["kept"] == (not r["base_failed"])
    assert quality_rules.judged(empty, []).count() == 0


def test_decision_list_learns_and_drops(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(500)]

    def text(low):
        return " ".join(w + ("###" if low and rng.random() < 0.7 else "") for w in rng.choice(words, 60, replace=False))

    low = rng.random(400) < 0.3
    docs = spark.createDataFrame(rows(*[text(x) for x in low]), DOCS)
    labels = spark.createDataFrame([(i, int(not x), 0) for i, x in enumerate(low)] + [(None, 1, 0), (5, None, 0), (7777, 1, 1)], "doc_id bigint, quality int, toxic int")
    rules = quality_rules.train(docs, labels)
    assert rules and {r["doc_id"] for r in quality_rules.judged(docs, rules).collect() if not r["kept"]} == set(np.flatnonzero(low).tolist())
    assert quality_rules.train(docs, labels.where("doc_id < 0")) == []


# --- 9

def test_piece_codec_is_the_library(spark, odd, empty):
    import sentencepiece

    path = public_tokenizers.path(piece_codec.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(10)
    bits = [" ", " ", "  ", "a", "B", "é", "\n", "\t", ".", "1", "<s>", "</s>", " ", "日", "▁", "the", "😀", "ﬁ", "<0x0A>"]
    docs = spark.createDataFrame(rows(*["".join(rng.choice(bits, rng.integers(0, 25))) for _ in range(1500)], start=1000), DOCS).unionByName(odd)
    out = piece_codec.decode(piece_codec.encode(docs.withColumn("kept", F.col("text")), path), path)
    for r in out.collect():
        want = library.encode(r["kept"] or "", add_eos=True)
        assert r["ids"] == want and r["decoded"] == library.decode(want)
    assert out.count() == docs.count()
    assert piece_codec.digests(piece_codec.decode(piece_codec.encode(empty.select("doc_id", "text"), path), path)).count() == 0


# --- 10

def test_language_by_family_and_pair(spark, odd, empty):
    rng = np.random.default_rng(11)
    parts = {"en": ["the", "ing", "and", "th", "ou"], "de": ["der", "ung", "sch", "ein", "ö"], "fr": ["eau", "le", "ê", "oi", "que"], "es": ["ción", "el", "ñ", "rr", "os"]}
    docs = [(i, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(20)), lang, "s", 1) for i in range(400) for lang in [list(parts)[i % 4]]]
    table = spark.createDataFrame(docs, DOCS).unionByName(odd.withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 1000))
    model = language.train(table, ~language.held_out())
    assert model.langs == sorted(parts) and set(model.families) == {"germanic", "romance"}
    out = language.identify(clash(table, "lang_pred", "score"), model).collect()
    assert len(out) == table.count()
    for r in out:
        letters = re.search(r"[^\W\d_]", r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        if r["lang"]:
            assert r["lang_pred"] == r["lang"]
    assert language.identify(empty, model).count() == 0
    nothing = language.train(empty, ~language.held_out())
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
