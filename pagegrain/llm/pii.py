"""Personal data by weak supervision, in SQL expressions only.

Patterns propose candidates in every whole text. Five labelers vote on each (yes, no or abstain): its shape, a gazetteer, words
before it, its edges, and words that speak against it. Expectation-maximisation estimates how reliable each labeler is from the
counts of vote patterns, whose number does not grow with the corpus; the posteriors then train a linear span
classifier. Valid candidates of the base patterns are always spans; others become spans where the classifier is sure.

Where the patterns are written with possessive runs and a look-behind, they match what the plain ones do: the look-behind (or the end of the
last match) only skips starts inside a run that has failed already, so a text is read in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm.common import let, table

KINDS = ["email", "ip", "card", "phone"]
LABELERS = 5
SHAPES = 8
#: Least probability of an added span.
SURE = 0.9

# Patterns in Java's syntax.
LOCAL = "[A-Za-z0-9._%+-]"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Further candidates: addresses written out, numbers without a plus.
LOOSE = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
#: What a text must hold for the pattern to be tried.
GUARDS = {
    "email": "contains(t, '@')", "ip": r"t RLIKE '[0-9]\\.[0-9]'", "card": "t RLIKE '[0-9](?:[ -]?[0-9]){13}'", "phone": "contains(t, '+')",
    "loose email": r"t RLIKE '(?i)[\\[(]at[\\])]'", "loose phone": "t RLIKE '[0-9]{3}[ .-][0-9]{4}'",
}
#: Gazetteers.
DOMAINS = "com|org|net|edu|gov|info|biz|io|de|fr|es|it|uk|eu|us|ch|at|nl|be|pt|pl|ru|cn|jp|in|br|mx|ca|au"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|30|35|36|38|6011|64|65|62"
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|97[0-9]"
SPEAK_FOR = {
    "email": "e-?mail|mail|contact|write|correo|courriel|kontakt", "ip": "ip|host|server|addr|client|login",
    "card": "card|visa|master|amex|credit|debit|carte|tarjeta|karte|kreditkarte", "phone": "phone|tel|call|mobile|fax|tél|teléfono|telefon|handy|sms",
}
SPEAK_AGAINST = "version|order|invoice|isbn|issn|serial|sku|build|release|commit|ticket|ref"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def luhn(digits: str) -> str:
    """SQL text: do the digits pass the checksum?"""
    digit = "cast(substr(r, i + 1, 1) AS int)"
    total = f"aggregate(sequence(0, length(r) - 1), 0, (a, i) -> a + CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)"
    return let(f"reverse({digits})", "r", f"{total} % 10 = 0")


def numbers(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


VALID = {
    "email": "true",
    "ip": rf"m RLIKE {quoted(rf'^{OCTET}(?:\.{OCTET}){{3}}$')}",
    "card": let(numbers("m"), "d", f"CASE WHEN length(d) BETWEEN 14 AND 19 THEN {luhn('d')} ELSE false END"),
    "phone": f"length({numbers('m')}) BETWEEN 10 AND 15",
}
GAZETTEER = {
    "email": f"CASE WHEN m RLIKE '(?i)[.\\\\])] ?(?:{DOMAINS})$' THEN 2 ELSE 1 END",
    "ip": "CASE WHEN m RLIKE '^(?:0|22[4-9]|23[0-9]|24[0-9]|25[0-9])[.]' THEN 0 WHEN m RLIKE '^(?:10|127|172|192)[.]' THEN 2 ELSE 1 END",
    "card": f"CASE WHEN {numbers('m')} RLIKE '^(?:{ISSUERS})' THEN 2 ELSE 0 END",
    "phone": f"CASE WHEN m RLIKE '^[+](?:{CALLING_CODES})' THEN 2 ELSE 1 END",
}


def candidate(kind: str, base: bool) -> str:
    """SQL text of one candidate from its text ``m``, start ``s`` and the texts around it, ``b`` and ``f``."""
    valid = VALID[kind]
    # the shape of a number without a plus is that of a number; a written-out address is shaped as one
    shape = f"CASE WHEN {valid} THEN 2 ELSE 0 END"
    before = f"CASE WHEN right(b, 32) RLIKE '(?i)(?:^|[^A-Za-z])(?:{SPEAK_FOR[kind]})[^A-Za-z0-9]' THEN 2 ELSE 1 END"
    edges = "CASE WHEN right(b, 1) RLIKE '[A-Za-z0-9_#$=/]' OR left(f, 1) RLIKE '[A-Za-z0-9_%=/]' THEN 0 ELSE 2 END"
    against = f"CASE WHEN right(b, 24) RLIKE '(?i)(?:^|[^A-Za-z])(?:{SPEAK_AGAINST})[^A-Za-z0-9]' THEN 0 ELSE 1 END"
    votes = " + ".join(f"{3 ** i} * ({v})" for i, v in enumerate([shape, GAZETTEER[kind], before, edges, against]))
    return (f"named_struct('s', s, 'k', {KINDS.index(kind)}, 'e', s + length(m), 'ok', {f'({valid})' if base else 'false'}, "
            f"'v', {votes}, 'h', least({SHAPES - 1}, cast(length(m) div 4 AS int)))")


EMPTY = "cast(array() AS array<struct<s:int,k:int,e:int,ok:boolean,v:int,h:int>>)"
#: Shorter or longer matches are no candidates: they cannot be valid, and no labeler would speak for them.
PLAUSIBLE = {"email": "true", "ip": "true", "card": "length(m) BETWEEN 13 AND 40", "phone": "true"}


def running(values: str, name: str, whole: str, body: str) -> str:
    """SQL text of ``body`` in which ``upto(name, i, whole)`` is what ``whole`` gives of the numbers in ``values`` before place i.

    By blocks of about the square root of their number, since no built-in function scans an array.
    """
    v, w, x = name, f"{name}_w", f"{name}_x"
    blocks = f"transform(sequence(0, greatest(size({v}) - 1, 0) div {w}), i_ -> {whole.format(f'slice({v}, i_ * {w} + 1, {w})')})"
    before = f"transform({x}, (x_, i_) -> {whole.format(f'slice({x}, 1, i_)')})"
    return let(values, v, let(f"greatest(1, cast(sqrt(size({v})) AS int))", w, let(blocks, x, let(before, f"{name}_b", body))))


def upto(name: str, i: str, whole: str) -> tuple[str, str]:
    """SQL texts of the parts that make up what ``whole`` gives before place i: of the earlier blocks, and of its own block."""
    v, w = name, f"{name}_w"
    return f"get({name}_b, ({i}) div {w})", whole.format(f"slice({v}, (({i}) div {w}) * {w} + 1, ({i}) % {w})")


TOTAL, LARGEST = "aggregate({}, 0, (p_, q_) -> p_ + q_)", "array_max({})"


def largest_before(name: str, i: str) -> str:
    """SQL text: the largest of the numbers before place i, 0 without one."""
    return f"coalesce(greatest({', '.join(upto(name, i, LARGEST))}), 0)"


def found(kind: str, base: bool) -> str:
    """SQL text: the candidates of one pattern in ``t``. The gaps between the matches give their starts in code points."""
    pattern = quoted((PATTERNS if base else LOOSE)[kind])
    start = f"{' + '.join(upto('n', 'i', TOTAL))} + length(get(g, i))"
    one = let(start, "s", let("get(g, i)", "b", let("get(g, i + 1)", "f", f"CASE WHEN {PLAUSIBLE[kind]} THEN {candidate(kind, base)} END")))
    each = running("transform(m_, (m, i) -> length(m) + length(get(g, i)))", "n", TOTAL, f"array_compact(transform(m_, (m, i) -> {one}))")
    body = let(f"regexp_extract_all(t, {pattern}, 0)", "m_", f"CASE WHEN size(m_) = 0 THEN {EMPTY} ELSE {let(f'split(t, {pattern})', 'g', each)} END")
    return f"CASE WHEN {GUARDS[kind if base else f'loose {kind}']} THEN {body} ELSE {EMPTY} END"


def candidates(text: str) -> str:
    """SQL text: all candidates of a text (null: none)."""
    parts = [found(k, True) for k in KINDS] + [found(k, False) for k in LOOSE]
    return let(f"coalesce({text}, '')", "t", f"concat({', '.join(parts)})")


@dataclass
class SpanModel:
    """Log-odds of a span: a bias per kind, a weight per labeler, kind and vote, and one per kind and length class."""

    bias: list[float] = field(default_factory=lambda: [-9.0] * len(KINDS))
    votes: list[list[float]] = field(default_factory=lambda: [[0.0] * 3 * len(KINDS) for _ in range(LABELERS)])
    shapes: list[float] = field(default_factory=lambda: [0.0] * SHAPES * len(KINDS))
    #: By kind and labeler: estimated probability of the right vote, where it votes.
    reliability: dict[str, list[float]] = field(default_factory=dict)

    def score(self, x: str) -> str:
        """SQL text of the probability of candidate ``x``."""
        def pick(values: list[float], at: str) -> str:
            return f"get(array({', '.join(f'{v:.6f}D' for v in values)}), {at})"

        terms = [pick(self.bias, f"{x}.k"), pick(self.shapes, f"{x}.k * {SHAPES} + {x}.h")]
        terms += [pick(w, f"{x}.k * 3 + ({x}.v div {3 ** i}) % 3") for i, w in enumerate(self.votes)]
        return f"1 / (1 + exp(-({' + '.join(terms)})))"


def maximise(votes: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of "is a span" by vote pattern, and each labeler's vote probabilities by class, from pattern counts.

    ``votes`` has a row per pattern with 0 (no), 1 (abstains), 2 (yes). Votes are smoothed towards labelers that are right more often than not.
    """
    q = 1 / (1 + np.exp(-2.0 * (votes - 1).sum(axis=1)))
    prior = np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])
    given = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        for j in range(votes.shape[1]):
            for c, weight in enumerate(((1 - q) * n, q * n)):
                counts = np.bincount(votes[:, j], weights=weight, minlength=3) + prior[c]
                given[j, c] = counts / counts.sum()
        share = ((q * n).sum() + 1) / (n.sum() + 2)
        odds = np.log(share / (1 - share)) + sum(np.log(given[j, 1, votes[:, j]] / given[j, 0, votes[:, j]]) for j in range(votes.shape[1]))
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return q, given


def regress(x: np.ndarray, q: np.ndarray, n: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels with counts (Newton's method)."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - q)) + ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, text: str = "text") -> SpanModel:
    """Reads the counts of vote patterns over all documents: at most 3^5 votes x 8 lengths per kind, whatever the corpus."""
    counts = (docs.select(F.explode(F.expr(candidates(f"`{text}`"))).alias("c"))
              .groupBy("c.k", "c.v", "c.h").agg(F.count(F.lit(1)).alias("n")).collect())
    model = SpanModel()
    for k, kind in enumerate(KINDS):
        rows = sorted((r["v"], r["h"], r["n"]) for r in counts if r["k"] == k)
        if not rows:
            continue
        votes = np.array([[v // 3 ** i % 3 for i in range(LABELERS)] for v, _, _ in rows])
        n = np.array([r[2] for r in rows], float)
        q, given = maximise(votes, n)
        model.reliability[kind] = [float((given[j, 0, 0] + given[j, 1, 2]) / (given[j, :, 0] + given[j, :, 2]).sum()) for j in range(LABELERS)]
        hot = np.zeros((len(rows), 1 + 3 * LABELERS + SHAPES))
        hot[:, 0] = 1
        for i, (v, h, _) in enumerate(rows):
            for j in range(LABELERS):
                hot[i, 1 + 3 * j + votes[i, j]] = 1
            hot[i, 1 + 3 * LABELERS + h] = 1
        w = regress(hot, q, n)
        model.bias[k] = float(w[0])
        for j in range(LABELERS):
            model.votes[j][3 * k:3 * k + 3] = w[1 + 3 * j:4 + 3 * j].tolist()
        model.shapes[SHAPES * k:SHAPES * (k + 1)] = w[1 + 3 * LABELERS:].tolist()
    return model


#: Code points of the parts that a text is cut into before its spans are replaced.
PART = 4096
NAMES = f"array({', '.join(map(repr, KINDS))})"


def listed(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(get({NAMES}, x.k), ':', x.s, ':', x.e)), ',')"


def tagged(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (s, k, e), by start, then kind. Added spans overlap no other span of their kind or base span.

    A null or empty text has none; repeated rows have the same; an empty table stays empty; other columns of these names are replaced.
    Generated columns: a later filter or projection does not evaluate the patterns again.
    """
    plain = "named_struct('s', x.s, 'k', x.k, 'e', x.e)"
    base = f"array_sort(transform(filter(c, x -> x.ok), x -> {plain}))"
    sure = f"array_sort(transform(filter(c, x -> NOT x.ok AND {model.score('x')} >= {SURE}D), x -> {plain}))"
    # in the order of ends and starts, a span is free if no base span that starts before its end reaches over its start
    marks = ("array_sort(concat(transform(b, y -> named_struct('p', y.s, 'j', -1, 'e', y.e)), "
             "transform(n, (x, j) -> named_struct('p', x.e - 1, 'j', j, 'e', 0))))")
    taken = f"filter(transform(z, (m, i) -> CASE WHEN m.j >= 0 AND {largest_before('ze', 'i')} <= get(n, m.j).s THEN m.j END), j -> j IS NOT NULL)"
    free = let(marks, "z", running("transform(z, m -> m.e)", "ze", LARGEST, f"transform(array_sort({taken}), j -> get(n, j))"))
    first = running("transform(r, x -> x.e)", "re", LARGEST, f"filter(r, (x, i) -> x.s >= {largest_before('re', 'i')})")
    both = let(sure, "n", f"CASE WHEN size(n) = 0 THEN b ELSE {let(free, 'r', f'array_sort(concat(b, {first}))')} END")
    body = let(candidates(f"`{text}`"), "c", let(base, "b", f"named_struct('base', b, 'spans', {both})"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans")]
    return docs.select(*kept, F.expr(f"inline(array({body}))"))


def redacted(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in capitals, such as [EMAIL]; of overlapping spans the first names the stretch.

    ``n_chars``, where there is such a column, is counted again. A null text stays null.
    """
    def cut(start: str, end: str) -> str:
        """SQL text: the text from place ``start`` to ``end``, from the parts it is cut into once."""
        piece = f"substr(get(o, k), greatest({start} - k * {PART}, 0) + 1, least({end} - k * {PART}, {PART}) - greatest({start} - k * {PART}, 0))"
        return f"CASE WHEN {end} > {start} THEN array_join(transform(sequence(({start}) div {PART}, ({end} - 1) div {PART}), k -> {piece}), '') ELSE '' END"

    ended = largest_before("e", "i")
    each = f"transform(spans, (x, i) -> {let(ended, 'p', 'CASE WHEN x.s >= p THEN concat(' + cut('p', 'x.s') + f', chr(91), upper(get({NAMES}, x.k)), chr(93)) END')})"
    rest = let("array_max(e)", "p", let("length(t)", "q", cut("p", "q")))
    whole = running("transform(spans, x -> x.e)", "e", LARGEST, f"concat(array_join(array_compact({each}), ''), {rest})")
    body = let(f"`{text}`", "t", let(f"regexp_extract_all(t, '(?s).{{1,{PART}}}', 0)", "o", whole))
    clean = F.expr(f"CASE WHEN size(spans) = 0 THEN `{text}` ELSE {body} END")
    out = tagged(docs, model, text).withColumn(text, clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def counted(kind: str) -> Column:
    return F.expr(f"cast(size(filter(base, x -> x.k = {KINDS.index(kind)})) AS bigint)").alias(f"n_{kind}")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tagged(docs, train(docs)).select("doc_id", *[counted(k) for k in KINDS], F.sha2(F.expr(listed("base")), 256).alias("base_sha256"),
                                            F.expr(listed("spans")).alias("spans"))
