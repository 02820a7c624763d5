"""Quality rules: a decision list learned by sequential covering, applied as one conditional expression.

Every text is measured by SQL expressions over its word and line arrays, in its own row and without a shuffle. Rules for
low quality are learned from labelled documents: a rule grows condition by condition on two thirds of them and is pruned on the rest,
the documents it covers are set aside, and the next rule is learned until no precise rule is left.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm.common import let, table

#: Bound of the training sample: about so many labelled documents, drawn by a hash of the id.
SAMPLE = 6000
MOST_RULES = 12
MOST_CONDITIONS = 4
#: A rule must be so precise on the documents that it was not grown on, and cover so many of them.
PRECISION = 0.95
SUPPORT = 5
THRESHOLDS = 32

BLANK = r"[ \\t-\\r]"
WORD = r"[^ \\t-\\r]"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct_words"]
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "words": "cast(n_words as double)",
}


def repeated_words(words: str) -> str:
    """SQL text: number of words in 5-word windows that occur twice or more in the array ``words``.

    Windows are hashed to 64 bits. Only where some repeat are their positions sorted by hash; the positions of repeated windows,
    in order, then cover 5 words each, less what the next one covers as well.
    """
    hashes = (f"CASE WHEN size({words}) < 5 THEN array() ELSE transform(sequence(0, size({words}) - 5), i -> "
              f"xxhash64({words}[i], {words}[i + 1], {words}[i + 2], {words}[i + 3], {words}[i + 4])) END")
    twins = ("transform(filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR (j < size(s) - 1 AND s[j + 1].h = x.h)), x -> x.p)")
    cover = ("aggregate(transform(p, (x, j) -> CASE WHEN j = size(p) - 1 THEN 5 ELSE least(5, p[j + 1] - x) END), 0L, (a, x) -> a + x)")
    sort = "sort_array(transform(h, (x, j) -> named_struct('h', x, 'p', j)))"
    exact = let(sort, "s", let(f"sort_array({twins})", "p", cover))
    return let(hashes, "h", f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {exact} END")


def measures(text: str) -> str:
    """SQL text: an array of one struct with the counts of a text (null: no word, no line)."""
    words = f"array_remove(split(t, '{BLANK}+'), '')"
    lines = rf"filter(split(t, '\\n'), l -> l RLIKE '{WORD}')"
    body = let(words, "w", let(lines, "l", (
        "named_struct('n_words', cast(size(w) as bigint), 'word_chars', cast(length(array_join(w, '')) as bigint), "
        r"'n_symbols', cast(length(regexp_replace(t, '[^#*$%&|<>]+', '')) as bigint), "
        "'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint), "
        f"'n_repeat_words', {repeated_words('w')}, "
        "'n_lines', cast(size(l) as bigint), 'n_distinct_words', cast(size(array_distinct(w)) as bigint))")))
    return let(f"coalesce({text}, '')", "t", body)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts as columns; columns of these names are replaced.

    The counts are generated, so that a later filter on them is not pushed below and computed again.
    """
    kept = [c for c in docs.columns if c not in COUNTS + MORE]
    return docs.select(*[F.col(f"`{c}`") for c in kept], F.expr(f"inline(array({measures(f'`{text}`')}))"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.limit if self.above else x[self.feature] <= self.limit

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.limit if self.above else value <= self.limit


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(lambda a, c: a & c.holds(x), rule, np.ones(n, bool))


def grow(x: dict[str, np.ndarray], low: np.ndarray) -> Rule:
    """Adds the condition with the largest information gain until the rule covers low quality only."""
    rule: Rule = ()
    inside = np.ones(len(low), bool)
    while len(rule) < MOST_CONDITIONS and inside.any() and not low[inside].all():
        p0, n0 = low[inside].sum(), (~low[inside]).sum()
        if not p0:
            break
        best, gain = None, 1e-9
        for name in FEATURES:
            values = x[name][inside]
            for limit in np.unique(np.quantile(values[low[inside]], np.linspace(0, 1, THRESHOLDS)).tolist() + np.quantile(values, np.linspace(0, 1, THRESHOLDS)).tolist()):
                for above in (True, False):
                    hit = values > limit if above else values <= limit
                    p, n = (hit & low[inside]).sum(), (hit & ~low[inside]).sum()
                    if p and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Condition(name, above, float(limit)), g
        if best is None:
            break
        # between the limit and where all but a few of the covered low documents lie: stray values on either side do not move it
        hit = best.holds(x) & inside & low
        edge = np.quantile(x[best.feature][hit], 0.05 if best.above else 0.95)
        best = Condition(best.feature, best.above, float((best.limit + edge) / 2))
        rule += (best,)
        inside &= best.holds(x)
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], low: np.ndarray) -> Rule:
    """Drops last conditions while that does not worsen (hits - misses) / (hits + misses) on the pruning rows."""
    def worth(r: Rule) -> float:
        c = covered(r, x, len(low))
        return ((c & low).sum() - (c & ~low).sum()) / max(1, c.sum())

    cuts = [rule[:i] for i in range(1, len(rule) + 1)]
    return max(cuts, key=lambda r: (round(worth(r), 6), -len(r))) if cuts else rule


def learn(x: dict[str, np.ndarray], low: np.ndarray) -> list[Rule]:
    """Ordered rules for low quality; rows are split for growing and pruning by their position."""
    rules: list[Rule] = []
    left = np.ones(len(low), bool)
    third = np.arange(len(low)) % 3 == 2
    while len(rules) < MOST_RULES:
        a, b = left & ~third, left & third
        if not low[a].any() or not low[b].any():
            break
        rule = prune(grow({k: v[a] for k, v in x.items()}, low[a]), {k: v[b] for k, v in x.items()}, low[b])
        hit = covered(rule, x, len(low))
        if not rule or (hit & b).sum() < SUPPORT or low[hit & b].mean() < PRECISION or low[hit & left].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list: the first rule that holds drops the document; without one it stays."""
    if not rules:
        return F.lit(True)
    chain = None
    for rule in rules:
        both = reduce(lambda a, c: a & c.column(), rule[1:], rule[0].column())
        chain = F.when(both, False) if chain is None else chain.when(both, False)
    return chain.otherwise(True)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """From about ``sample`` labelled documents (null labels and ids teach nothing); without labels there are no rules.

    An id counts once, however often it is labelled (its least label) or stands in ``docs`` (its least features).
    """
    sound = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("quality")))
    n = sound.count()
    if not n:
        return []
    drawn = sound.where(F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(1 << 20)) < min(1.0, sample / n) * (1 << 20))
    # bounded by the sample
    pick = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__id"))
    each = measured(pick).select("doc_id", "quality", F.struct(*[F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()]).alias("x"))
    rows = each.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).select("doc_id", "quality", "x.*").collect()
    rows.sort(key=lambda r: (hash((r["doc_id"], 1)), r["doc_id"]))
    x = {k: np.array([r[k] for r in rows], float) for k in FEATURES}
    return learn(x, np.array([r["quality"] == 0 for r in rows], bool))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``: a null or empty text has no words and fails, repeated rows are judged alike, an empty
    table stays empty, other columns of these names are replaced."""
    return measured(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = train(docs, table(spark, sf_dir, "labels"))
    return judged(docs.select("doc_id", "text"), rules).select("doc_id", *COUNTS, "base_failed", "kept")
