"""Language of each text in two steps: the family first, then pairwise linear support vector machines inside it.

A text becomes the relative frequencies of its hashed byte n-grams (1 to 3 bytes of the lower-cased text, everything but
letters as one gap). One-versus-rest machines choose the family. Inside a family each pair of languages has its own
machine, and the language with the most pair wins is predicted (ties: larger margin sum, then the smaller name).

The machines always choose one of the learned languages. Whether a text is in it is told apart by the share of
its 3-byte n-grams that occur in learned texts of that language (``Model.recognised``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm.common import filled, ship, table

ship(__name__)

BUCKETS = 4096
#: Bound of the training sample: about so many labelled documents per language.
SAMPLE = 500
EPOCHS = 30
UNKNOWN = "und"
#: Least share of known n-grams, as a part of the median share that a language's learned texts have in each other. On sf0.01 held-out texts
#: have 0.86 or more, Finnish, Turkish and Polish 0.44 or less, real English 0.71. Close relatives of a learned language can reach it.
LEAST_KNOWN = 0.6

# Language families by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indo-aryan": ["hi", "ur", "bn", "mr", "ne", "pa", "gu"],
}

#: Any ASCII byte that is no lower-case letter becomes a blank.
GAPS = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def has_letter(text: str | None) -> bool:
    """Whether a character is of Unicode category L; numerals such as superscripts and circled digits are not."""
    return bool(text) and any(map(str.isalpha, text))


def letters(text: str) -> np.ndarray:
    """The bytes of the lower-cased text, everything but letters as one gap."""
    packed = b" ".join([b"", *text.lower().encode("utf-8", "replace").translate(GAPS).split(), b""])
    return np.frombuffer(packed, np.uint8).astype(np.uint32)


def trigrams(text: str) -> np.ndarray:
    """The 3-byte n-grams of the text as numbers, one per position."""
    b = letters(text)
    return (b[:-2] << 16) + (b[1:-1] << 8) + b[2:]


def features(text: str) -> np.ndarray:
    """Square roots of the relative n-gram frequencies: a vector of length 1 per gram size, over the whole text."""
    b = letters(text)
    out = np.zeros(BUCKETS, np.float32)
    for n, seed in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        if len(b) < n:
            break
        h = b[:len(b) - n + 1].copy()
        for i in range(1, n):
            h = h * np.uint32(257) + b[i:len(b) - n + 1 + i]
        h = (h * np.uint32(seed)) >> np.uint32(20)  # 12 bits
        counts = np.bincount(h, minlength=BUCKETS)
        out += np.sqrt(counts / len(h), dtype=np.float32)
    return out


def machine(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, c: float = 10.0) -> np.ndarray:
    """Linear support vector machine (dual coordinate descent, squared hinge); the last weight is the bias. ``y`` is 1 or -1."""
    w, bias, a = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x))
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    diagonal = np.einsum("ij,ij->i", x, x).astype(np.float64) + 1 + 1 / (2 * c * share)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            step = max(a[i] - (y[i] * (float(x[i] @ w) + bias) - 1 + a[i] / (2 * c * share[i])) / diagonal[i], 0.0) - a[i]
            if step:
                a[i] += step
                w += np.float32(step * y[i]) * x[i]
                bias += step * y[i]
    return np.append(w, np.float32(bias))


class Model:
    """Weights per family and per pair of languages, and the n-grams of the learned texts per language."""

    def __init__(self, x: np.ndarray, langs: list[str], grams: list[np.ndarray] = ()):
        labels = np.array(langs, dtype=object)
        self.langs = sorted(set(langs))
        of = {lang: family_of(lang) for lang in self.langs}
        self.families = sorted(set(of.values()))
        fam = np.array([of[lang] for lang in langs], dtype=object)
        self.members = {f: [lang for lang in self.langs if of[lang] == f] for f in self.families}
        self.between = np.array([machine(x, np.where(fam == f, 1.0, -1.0)) for f in self.families]) if len(self.families) > 1 else None
        self.inside = {}
        for f, members in self.members.items():
            for p, q in combinations(members, 2):
                pick = (labels == p) | (labels == q)
                self.inside[p, q] = machine(x[pick], np.where(labels[pick] == p, 1.0, -1.0))
        self.grams = np.unique(np.concatenate(grams)) if len(grams) else np.zeros(0, np.uint32)
        self.seen, self.least = np.zeros((len(self.langs), len(self.grams)), bool), np.zeros(len(self.langs))
        for i, lang in enumerate(self.langs if len(grams) else ()):
            own = [np.searchsorted(self.grams, g) for g, of_lang in zip(grams, langs) if of_lang == lang and len(g)]
            texts = np.bincount(np.concatenate(own), minlength=len(self.grams)) if own else np.zeros(len(self.grams), int)
            self.seen[i] = texts > 0
            # what a text shares with the others: a language with a single learned text has nothing to compare with and rejects nothing
            self.least[i] = LEAST_KNOWN * np.median([(texts[g] > 1).mean() for g in own]) if own else 0.0

    def recognised(self, text: str) -> bool:
        """Whether enough n-grams of the text are known in the language that the machines predict for it; short texts get two standard errors of
        their share."""
        g = trigrams(text)
        if not len(self.grams) or not len(g):
            return True
        own = self.langs.index(self.predict(features(text))[0])
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        share, least = self.seen[own, at[self.grams[at] == g]].sum() / len(g), self.least[own]
        return bool(share >= least - 2 * np.sqrt(least * (1 - least) / len(g)))

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Language, and the product of the two steps' sigmoid confidences."""
        x = np.append(x, np.float32(1))
        family, sure = self.families[0] if self.families else UNKNOWN, 1.0
        if self.between is not None:
            margins = self.between @ x
            at = int(margins.argmax())
            family, sure = self.families[at], float(1 / (1 + np.exp(-2 * (margins[at] - np.delete(margins, at).max()))))
        members = self.members.get(family, [])
        if len(members) < 2:
            return (members[0] if members else UNKNOWN), sure if members else 0.0
        wins = {m: [0, 0.0, np.inf] for m in members}
        for p, q in combinations(members, 2):
            margin = float(self.inside[p, q] @ x)
            for lang, m in ((p, margin), (q, -margin)):
                wins[lang] = [wins[lang][0] + (m > 0 or (m == 0 and lang == p)), wins[lang][1] + m, min(wins[lang][2], m)]
        lang = min(members, key=lambda m: (-wins[m][0], -wins[m][1], m))
        return lang, sure / (1 + float(np.exp(-4 * wins[lang][2])))


def measured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in filled(rows):
        texts = batch.column(0).to_pylist()
        each, grams = [features(t).tobytes() for t in texts], [np.unique(trigrams(t)).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(each, pa.binary()), pa.array(grams, pa.binary()), batch.column(1)], ["x", "grams", "lang"])


def fitted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of the bounded sample, made in a task: the driver holds the weights, not the sample."""
    given = sorted((r for batch in rows for r in zip(*[c.to_pylist() for c in (batch.column(2), batch.column(0), batch.column(1))])), key=lambda r: r[:2])
    if given:
        x, grams = np.empty((len(given), BUCKETS), np.float32), [np.frombuffer(r[2], np.uint32) for r in given]
        langs = [r[0] for r in given]
        for i in range(len(given)):
            x[i], given[i] = np.frombuffer(given[i][1], np.float32), None  # one copy at a time
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(Model(x, langs, grams)))], pa.binary())], ["model"])


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """From a sample of the texts where ``learn`` holds, of about ``sample`` per language, drawn by a hash of the text: equal texts count once.

    Rows without language, text or letter teach nothing. Languages are so few that their counts are read by the driver.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    if not counts:
        return Model(np.zeros((0, BUCKETS), np.float32), [])
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)
    sampled = labelled.where(drawn & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang").distinct()
    learned = sampled.mapInArrow(measured, "x binary, grams binary, lang string").repartition(1).mapInArrow(fitted, "model binary").collect()
    model = Model(np.zeros((0, BUCKETS), np.float32), [])
    for r in learned:
        vars(model).update(pickle.loads(r["model"]))
    return model


def sent(spark: SparkSession, model: Model) -> Callable[[], Model]:
    """The model for the tasks, with its class, so that executors need no installed package. Its size goes with the languages, not with the rows."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    def load() -> Model:
        return pickle.loads(shared.value)

    return load


def recognised(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter and is in the learned language predicted for it, as far as its n-grams tell."""
    load = sent(docs.sparkSession, model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in filled(rows):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([has_letter(t) and m.recognised(t) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1). A null text or one without a letter is ``und`` with score 0."""
    from pyspark.sql import types as T

    load = sent(docs.sparkSession, model)
    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in filled(rows):
            said = [m.predict(features(t)) if has_letter(t) else (UNKNOWN, 0.0)
                    for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                [f.name for f in kept] + ["lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType(list(kept)).add("lang_pred", T.StringType()).add("score", T.DoubleType()))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~held_out())
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
