"""Personal data, language and near copies against plain versions: many spans in one text, numerals, ids with several texts, models by value."""

import pickle
import random
import subprocess
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagegrain.llm import common, language, near_dedup, pii

DOCS = "doc_id bigint, text string, lang string"


def spans_by_hand(found, model):
    """Base spans, and of the sure others those that overlap no base span and no earlier one, all pairs compared."""
    def score(c):
        odds = model.bias[c.k] + model.shapes[c.k * pii.SHAPES + c.h] + sum(w[c.k * 3 + c.v // 3 ** i % 3] for i, w in enumerate(model.votes))
        return 1 / (1 + np.exp(-odds))

    base = sorted((c.s, c.k, c.e) for c in found if c.ok)
    sure = sorted((c.s, c.k, c.e) for c in found if not c.ok and score(c) >= pii.SURE)
    free = [x for x in sure if not any(y[0] < x[2] and x[0] < y[2] for y in base)]
    kept = [x for i, x in enumerate(free) if not any(y[0] < x[2] and x[0] < y[2] for y in free[:i])]
    return base, sorted(base + kept)


def redacted_by_hand(text, spans):
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{pii.KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def personal_texts():
    rng = random.Random(8)
    parts = ["mail a.b@c.org", "x (at) y (dot) de", "ip 10.0.0.1", "300.1.1.1", "4111 1111 1111 1111", "1234 5678 9012 3456", "+1 (212) 555-0100", "212-555-0199",
             "(212) 555-0100 4111111111111111", "a@b.c@d.e", "😀 é", "order 123-456-7890", "version 1.2.3.4", "words", "\n"]
    out = [" ".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(200)]
    return out + [" ".join(f"u{i}@m{i}.org" for i in range(300)), " ".join(f"212-555-{i:04d}" for i in range(300)) + " end", "😀" * 5000 + " a@b.org " + "é" * 5000]


@pytest.mark.parametrize("keen", [False, True])
def test_spans_and_redaction(spark, keen):
    texts = personal_texts()
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    model = pii.train(docs)
    if keen:  # every candidate is sure
        model = pii.SpanModel(bias=[9.0] * len(pii.KINDS))
    rows = pii.tagged(docs.withColumn("c", F.expr(pii.candidates("text"))), model).collect()
    clean = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    added = 0
    for r in rows:
        base, spans = spans_by_hand(r.c, model)
        assert [tuple(x) for x in r.base] == base and [tuple(x) for x in r.spans] == spans
        assert clean[r.doc_id] == redacted_by_hand(r.text, spans)
        added += len(spans) - len(base)
    assert added > 0 or not keen


def test_letters_are_of_category_l(spark):
    texts = ["²³ ½", "①", "12 345", "", None, "Ⅷ", "ª", "中", "é", "ʰ", "_", "۳", "ǅ"]
    model = language.Model(np.stack([language.features("the house is here"), language.features("das Haus ist hier")]), ["en", "de"])
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS)
    for r in language.identify(docs.select("doc_id", "text"), model).collect():
        letter = any(unicodedata.category(c).startswith("L") for c in r.text or "")
        assert (r.lang_pred != language.UNKNOWN) == letter, r.text
    kept = {r.doc_id for r in language.recognised(docs.select("doc_id", "text"), model).collect()}
    assert kept == {i for i, t in enumerate(texts) if any(unicodedata.category(c).startswith("L") for c in t or "")}


def test_predictions_equal_a_plain_version(spark):
    """Grams counted in dictionaries, machines as plain sums."""
    words = {"en": "the and of house with this", "de": "der und das haus mit dieser", "fr": "le et la maison avec cette", "es": "el y la casa con esta"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(words[lang].split()) for _ in range(30)), lang) for i, lang in enumerate(sorted(words) * 12)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.train(docs, F.lit(True))

    def vector(text):
        raw = b" ".join([b"", *text.lower().encode().translate(language.GAPS).split(), b""])
        out = [0.0] * language.BUCKETS
        for n, seed in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
            counts = {}
            for i in range(len(raw) - n + 1):
                h = 0
                for byte in raw[i:i + n]:
                    h = (h * 257 + byte) % 2**32
                bucket = h * seed % 2**32 >> 20
                counts[bucket] = counts.get(bucket, 0) + 1
            total = sum(counts.values())
            for bucket, c in counts.items():
                out[bucket] += (c / total) ** 0.5
        return out + [1.0]

    def plain(text):
        x = vector(text)
        dot = lambda w: sum(float(a) * b for a, b in zip(w, x) if b)
        family = max(range(len(model.families)), key=lambda i: dot(model.between[i]))
        p, q = model.members[model.families[family]]
        return p if dot(model.inside[p, q]) >= 0 else q

    got = {r.doc_id: r.lang_pred for r in language.identify(docs.select("doc_id", "text"), model).collect()}
    assert got == {i: plain(t) for i, t, _ in rows}
    assert sum(got[i] == lang for i, _, lang in rows) == len(rows)


def test_repeated_rows_do_not_fill_the_sample(spark):
    rows = [(1, "the house is here", "en")] * 3000 + [(None, "das Haus ist hier", "de")] * 50 + [(i, f"the house number {i} word", "en") for i in range(10, 20)]
    model = language.train(spark.createDataFrame(rows, DOCS).repartition(3), F.lit(True), sample=5)
    assert set(model.langs) <= {"en", "de"} and len(model.grams) > 0


def test_model_needs_no_installed_package(tmp_path):
    """What is sent to the tasks loads where the package is not."""
    model = language.Model(np.stack([language.features("the house"), language.features("das Haus")]), ["en", "de"])
    (tmp_path / "model").write_bytes(cloudpickle.dumps(model))
    (tmp_path / "load.py").write_text("import pickle\nm = pickle.load(open('model', 'rb'))\nprint(m.langs)\ntry:\n    import pagegrain\n    print('there')\nexcept ImportError:\n    pass\n")
    said = subprocess.run([sys.executable, "load.py"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert said.stdout.split("\n")[0] == "['de', 'en']" and "there" not in said.stdout, said.stderr
    assert pickle.loads(cloudpickle.dumps(model)).langs == model.langs


def test_one_row_per_id_stays_whatever_the_order(spark):
    text = "one two three four five six seven"
    rows = [(5, text, "en"), (5, "another text of the same id here", "de"), (5, None, "fr"), (7, text, "en"), (7, text, "en")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = near_dedup.keep_one(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
        assert [(r.doc_id, r.text) for r in kept] == [(5, "another text of the same id here")]


def test_small_batches_of_long_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c" * 5, "d" * 5]})
    assert [b.num_rows for b in common.light(iter([batch]), "text", 20)] == [2, 1, 2]


def test_ranks_are_positions(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("aab"), rng.randrange(50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, g string, x int").repartition(5, "id")
    got = common.ranked(df, "g", F.xxhash64("id"), ["x", "id"], len(rows), rows_per_bucket=16).collect()
    for g in "ab":
        assert sorted(r["__rank"] for r in got if r.g == g) == list(range(sum(r[1] == g for r in rows)))
