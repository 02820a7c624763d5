"""The pipeline's stages against brute-force versions, on the smallest tables and on odd rows."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagegrain.llm import bpe_tables, language, packing, pii, quality_rules
from tests.llm.test_rows import DOCS, ODD, base_spans, brute_components, brute_counts, check_packing

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = ODD + [(None, "a row without an id, which has some words of its own to be kept by all stages of it", "en", "s", 1), (None, None, None, None, None)]
    shifted = [(None if r[0] is None else r[0] + 10**6, *r[1:]) for r in odd]
    # columns under the operators' own names must come through
    return given.unionByName(spark.createDataFrame(shifted + shifted[5:6], DOCS)).withColumns({"score": F.lit("theirs"), "kept": F.lit(7), "spans": F.col("doc_id")})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_language_stage(spark, docs):
    out = STAGE["language"](spark, docs, SF)
    assert out.columns == docs.columns
    assert rows(out) == sorted((tuple(r) for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")), key=repr)


def test_language_stage_drops_unlearned(spark, docs):
    """Texts in languages that no row is labelled with, and letter junk, go; held-out texts in learned languages stay."""
    texts = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
             "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
             "Все люди рождаются свободными и равными в своем достоинстве и правах.",
             "zxqv kjwq xzvk qqjx wvzk jxqk vvkz qxjw zkvx jqwk xvqz kkzj wqxv", "qz" * 20000]
    odd = spark.createDataFrame([(2 * 10**6 + i, t, None, "s", len(t)) for i, t in enumerate(texts)], DOCS).withColumns(
        {"score": F.lit("theirs"), "kept": F.lit(7), "spans": F.col("doc_id")})
    out = STAGE["language"](spark, docs.unionByName(odd), SF)
    assert rows(out) == rows(STAGE["language"](spark, docs, SF))


def test_language_stage_asks_the_machines(spark):
    """A text is judged by the n-grams of the language that the machines predict, not by those of whichever language knows most of them."""
    texts = [(lang, " ".join(words[(i * 7 + j * j) % len(words)] for j in range(40))) for lang, words in (
        ("en", "the house and water with their other people which would".split()), ("de", "das haus und wasser mit ihren anderen leuten welche".split())) for i in range(12)]
    x = np.array([language.features(t) for _, t in texts])
    model = language.Model(x, [lang for lang, _ in texts], [np.unique(language.trigrams(t)) for _, t in texts])
    english = texts[0][1]
    assert model.predict(language.features(english))[0] == "en" and model.recognised(english)
    model.predict = lambda x: ("de", 1.0)
    assert not model.recognised(english)


def test_quality_stage(spark, docs):
    out = STAGE["quality"](spark, docs, SF)
    assert out.columns == docs.columns
    kept = {tuple(r) for r in out.collect()}
    rules = quality_rules.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    judged = {tuple(r[c] for c in docs.columns[:5]) for r in quality_rules.judged(docs.select(docs.columns[:5]), rules).where("kept").collect()}
    assert {r[:5] for r in kept} == judged
    for r in docs.collect():
        n, _, _, _, repeated = brute_counts(r["text"])
        assert not (tuple(r) in kept and (n < 10 or 100 * repeated > 20 * n))


def test_near_copies_stage(spark, docs):
    out = STAGE["near_copies"](spark, docs, SF)
    assert out.columns == docs.columns
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in found if i is not None) == sorted(set(want.values())) and found.count(None) == 2


def test_personal_data_stage(spark, docs):
    out = {r["doc_id"]: r for r in STAGE["personal_data"](spark, docs, SF).where("doc_id IS NOT NULL").collect()}
    for r in docs.where("doc_id IS NOT NULL").collect():
        got, spans = out[r["doc_id"]], base_spans(r["text"])
        assert got["score"] == "theirs" and got["spans"] == r["doc_id"]
        for start, _, end in spans:
            assert r["text"][start:end] not in got["text"]
        if r["text"] is None:
            assert got["text"] is None
        elif not spans and "[" not in got["text"]:
            assert got["text"] == r["text"] and got["n_chars"] == len(r["text"])


def test_packing_stage(spark, docs):
    check_packing(STAGE["packing"](spark, docs, SF).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], packing.WINDOW)


def test_packing_stage_remembers_less():
    """The bound on a worker's tables holds, and the ids do not depend on it."""
    path = public_tokenizers.path(packing.VOCABULARY)
    texts = [[" ".join(f"w{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}" for k in range(26)) for j in range(4)] for i in range(26)]
    rows = [pa.record_batch({"doc_id": pa.array([4 * i + j for j in range(4)]), "text": t}) for i, t in enumerate(texts)]
    whole, few = ([b for b in packing.cut(path, 1, 64, n)(iter(rows))] for n in (bpe_tables.ENTRIES, 500))
    assert pa.Table.from_batches(whole) == pa.Table.from_batches(few)
    held = bpe_tables.encoder(path, 500)
    assert len(held.table) + len(held.table.old) <= 500 + 4 * 26 and corpus_pipeline.ENTRIES < bpe_tables.ENTRIES


def test_stages_stand_empty_tables(spark, docs, tmp_path):
    none = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_run_keeps_clean_documents(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in out}
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert ids <= set(given) and len(ids) > 0.5 * len(given)
    assert sum(r["length"] for r in out) == sum({r["doc_id"]: r["doc_tokens"] for r in out}.values())
    fill = sum(r["length"] for r in out) / (packing.WINDOW * len({r["sequence_id"] for r in out}))
    assert fill > 0.9
    assert np.isfinite(fill) and language.UNKNOWN == "und" and pii.KINDS
