"""Quality rules: decision lists learned by sequential covering, run as ordered Spark conditional expressions.

Rules are learned one after the other from labelled statistics of documents. A rule grows condition by condition: each
time the threshold (a quantile of a statistic) is added that most raises the rule's information gain, until it covers
no good one. It is then pruned: last conditions go as long as its value on held-out rows does not fall.
Rows that it covers are set aside, and the next rule is learned from the rest. The finished list is one ``CASE``
expression of threshold conjunctions, in order, that anyone can read; a document that no rule covers is kept.

All of it is DataFrame work: statistics are column expressions, and each step of growing or pruning is one aggregate
over the labelled rows that returns a histogram of fixed size.

Defined results: a null, empty or blank text has no words and fails the base rules. Without labels of both kinds the
list is empty and the base rules decide alone. Labels of documents that are absent, and null labels, are not used; a
document with several labels counts once for each. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edilake.llm.io import keep

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "shout_share",
            "distinct_share", "digit_share")


def let(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(hashes: Column, n: int = WINDOW) -> Column:
    """Words in ``n``-word windows found twice or more. Most texts have none, which one set of window hashes tells;
    else windows are sorted with their places, so the cost is n log n in the words of a text."""
    def of_windows(w):
        def of_sorted(s):
            twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            return let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))), F.lit(0), lambda a, b: a + b))

        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(
            let(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted))

    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n)))))
    return F.when(F.size(hashes) > n, let(windows, of_windows)).otherwise(0).cast("bigint")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and the features that rules may test, of every whole text."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", text.alias("t"))
    per_text = let(words, lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.size(F.array_distinct(w)).alias("n_distinct"),
        repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words")))
    per_line = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup")))
    length = F.length("t")
    counted = rows.select(
        "doc_id", per_text.alias("w"), per_line.alias("l"), length.alias("n_chars"),
        F.length(F.translate("t", BLANKS, "")).cast("bigint").alias("word_chars"),
        (length - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (length - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_upper"),
        (length - F.length(F.translate("t", "0123456789", ""))).alias("n_digit"),
        (length - F.length(F.translate("t", "!", ""))).alias("n_shout"))
    n, chars = F.greatest("w.n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", F.col("l.n_dup").alias("n_dup_lines"), "w.n_repeat_words",
        (F.col("word_chars") / n).alias("mean_word"), (F.col("n_symbols") / n).alias("symbol_share"),
        (F.col("l.n_dup") / F.greatest("l.n", F.lit(1))).alias("dup_line_share"), (F.col("w.n_repeat_words") / n).alias("repeat_share"),
        (F.col("n_upper") / chars).alias("upper_share"), (F.col("n_shout") / n).alias("shout_share"),
        (F.col("w.n_distinct") / n).alias("distinct_share"), (F.col("n_digit") / chars).alias("digit_share"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.at_least else F.col(self.feature) < self.threshold

    def __str__(self):
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


def both(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _counts(rows: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
    """(bad, good) rows that meet each test."""
    found = rows.agg(*(F.sum(F.when(t, F.lit(1) - F.col("label")).otherwise(0)) for t in tests),
                     *(F.sum(F.when(t, F.col("label")).otherwise(0)) for t in tests)).first()
    return [(found[i] or 0, found[len(tests) + i] or 0) for i in range(len(tests))]


def _threshold_counts(rows: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[Condition, int, int]]:
    """(bad, good) rows under every single condition: one histogram over the cuts of all features."""
    def place(f, at):
        return F.size(F.filter(F.array(*map(F.lit, at)), lambda c: c <= F.col(f)))

    bins = [F.struct(F.lit(f).alias("f"), place(f, at).alias("b")) for f, at in cuts.items()]
    counts: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(at) + 1)] for f, at in cuts.items()}
    for r in rows.select("label", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b", "label").count().collect():
        counts[r["f"]][r["b"]][r["label"]] += r["count"]
    out = []
    for f, at in cuts.items():
        total = [sum(x[k] for x in counts[f]) for k in (0, 1)]
        below = [0, 0]
        for i, t in enumerate(at):
            below = [below[k] + counts[f][i][k] for k in (0, 1)]
            out.append((Condition(f, True, t), total[0] - below[0], total[1] - below[1]))
            out.append((Condition(f, False, t), *below))
    return out


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def learn(labelled: DataFrame, features=FEATURES, max_rules: int = 8, max_conditions: int = 3, quantiles: int = 20,
          precision: float = 0.95, least: int = 8) -> list[list[Condition]]:
    """Rules for documents to drop, from rows of features with ``label`` (1 good, 0 bad) and boolean ``grow``: two thirds
    of the rows to grow rules on, the others to prune them. A rule that covers fewer than ``least`` bad rows, or whose
    covered rows are bad in less than ``precision`` of either part, ends the list."""
    cuts = labelled.agg(*(F.percentile_approx(f, [i / quantiles for i in range(1, quantiles)], 1000).alias(f) for f in features)).first()
    cuts = {f: sorted({float(t) for t in cuts[f]}) for f in features if cuts[f]}
    rules, rest = [], F.lit(True)
    while cuts and len(rules) < max_rules:
        growing = labelled.where(F.col("grow") & rest)
        (bad, good), = _counts(growing, [F.lit(True)])
        if bad < least:
            break
        rule: list[Condition] = []
        while len(rule) < max_conditions and good > 0:
            options = _threshold_counts(growing.where(both(rule)), cuts)
            value, best = max((_gain(b, g, bad, good), -i) for i, (_, b, g) in enumerate(options))
            if value <= 0:
                break
            test, bad, good = options[-best]
            rule.append(test)
        if not rule:
            break
        held = _counts(labelled.where(~F.col("grow") & rest), [both(rule[:k]) for k in range(1, len(rule) + 1)])
        worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in held]
        k = max(range(len(rule)), key=lambda j: (worth[j], -j))
        grown, = _counts(growing, [both(rule[:k + 1])])
        covered = [n for n in (grown, held[k]) if sum(n)]
        if grown[0] < least or any(b < precision * (b + g) for b, g in covered):
            break
        rules.append(rule[:k + 1])
        rest = rest & ~both(rules[-1])
    return rules


def verdict(rules: list[list[Condition]]) -> tuple[Column, Column]:
    """The list as conditional expressions: is a document kept, and the number of the rule that fired (0: none)."""
    kept, fired = F.lit(True), F.lit(0)
    for number in range(len(rules), 0, -1):
        test = both(rules[number - 1])
        kept, fired = F.when(test, False).otherwise(kept), F.when(test, number).otherwise(fired)
    return kept, fired


def labelled_statistics(stats: DataFrame, labels: DataFrame, label: str = "quality", most: int = 50_000) -> DataFrame:
    """Statistics of labelled documents, at most about ``most`` of them, chosen by a hash of the id."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    share = min(1.0, most / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    return stats.join(chosen, "doc_id").select(*FEATURES, "label", (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(3)) > 0).alias("grow"))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, rule (number of the learned rule that fired, 0 for none)."""
    stats = keep(statistics(docs), "statistics")
    labelled = keep(labelled_statistics(stats, labels).repartition(8), "labelled")
    kept, fired = verdict(learn(labelled, **options))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        (~failed & kept).alias("kept"), fired.alias("rule"))
