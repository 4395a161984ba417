"""Quality rules: a decision list learned from labelled documents, as one Spark conditional expression.

Statistics of a text are native expressions. Sequential covering then learns rules for bad documents
from labelled ones: a rule grows by the threshold condition of most FOIL gain, on two thirds of the rows, is
pruned to the prefix of its conditions that does best on the other third, and is kept if it is
precise there; its documents leave, and the next rule grows on the rest. Documents without a rule are good.

The data stays in Spark. Thresholds are quantiles of the labelled rows; rows are counted by the bins they
fall in, and each step of growing or pruning is one grouped count over those cells, of which the driver
gets a number for each statistic and bin.

Nulls and edge cases: a null text has no words; it fails the base rule, as do other texts of less than 50 words.
Labels without a value or without a document are not used; of repeated labels each counts. Without labels of
both kinds there is no rule and the base rule decides alone. Repeated documents get equal results. Very long texts are counted whole. An empty
table of documents gives an empty result, and an empty table of labels no rule. Statistics
have names of their own, prefixed in wider tables, so columns of the documents cannot clash.

Windows of three words are compared by 64-bit hashes within a text: at 20,000 words two different windows
fall together once in 10^11 texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import WORD, working_table

SYMBOLS = r"[#*$%&|<>]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
MOST_REPEATED = 50

#: What rules look at, by name, over the base statistics.
STATISTICS = {
    "words": "cast(n_words as double)",
    "mean_word": "word_chars / n_words",
    "symbols": "n_symbols / n_words",
    "dup_lines": "n_dup_lines / n_words",
    "repeats": "n_repeat_words / n_words",
}
#: Quantiles of each class that thresholds are taken from.
QUANTILES = 24
MAX_CONDITIONS = 3
MAX_RULES = 10
#: A rule must be this precise, on the rows it grew on and on those it was pruned on.
MIN_PRECISION = 0.95
MIN_ROWS = 5


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def sql(self) -> str:
        return f"({STATISTICS[self.statistic]}) {'>=' if self.at_least else '<'} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def with_statistics(docs: DataFrame, prefix: str = "", text: str = "text") -> DataFrame:
    """docs with the five base statistics, long columns named prefix + name. One pass, no shuffle."""
    p = prefix + "__"
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda line: line.rlike(WORD))
    windows = F.size(p + "hashes") - 2
    hashed = (
        docs.withColumn(p + "hashes", F.transform(F.regexp_extract_all(value, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
        .withColumn(p + "lines", lines)
        .withColumn(
            p + "windows",
            F.when(
                windows >= 1,
                F.transform(
                    F.sequence(F.lit(1), windows),
                    lambda i: F.xxhash64(
                        F.element_at(p + "hashes", i), F.element_at(p + "hashes", i + 1), F.element_at(p + "hashes", i + 2)
                    ),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        )
    )
    # only texts that repeat a window sort theirs; equal neighbours are repeats
    repeats = F.size(F.array_distinct(p + "windows")) < F.size(p + "windows")
    ordered = F.sort_array(F.transform(F.col(p + "windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = hashed.withColumn(p + "sorted", F.when(repeats, ordered))
    s = F.col(p + "sorted")
    twice = F.filter(
        F.transform(
            s,
            lambda x, k: F.when(
                F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))
    out = sorted_.withColumns(
        {
            prefix + "n_words": F.size(p + "hashes").cast("long"),
            prefix + "word_chars": F.length(F.regexp_replace(value, r"[\x20\x09-\x0D]+", "")).cast("long"),
            prefix + "n_symbols": F.regexp_count(value, F.lit(SYMBOLS)).cast("long"),
            prefix + "n_dup_lines": (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long"),
            prefix + "n_repeat_words": F.when(s.isNotNull(), covered).otherwise(0).cast("long"),
        }
    )
    return out.drop(*(p + x for x in ("hashes", "lines", "windows", "sorted")))


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MOST_REPEATED * n)


def verdict(rules: list[Rule]) -> Column:
    """The decision list: null for good documents, else the number of the rule that rejects."""
    if not rules:
        return F.lit(None).cast("int")
    first, *rest = rules
    out = F.when(F.expr(first.sql()), F.lit(1))
    for number, rule in enumerate(rest, 2):
        out = out.when(F.expr(rule.sql()), F.lit(number))
    return out


def learn(statistics: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Rules for label 0 from documents that pass the base rule. statistics: doc_id and the base columns."""
    rows = statistics.where(~base_failed()).select(F.col(doc_id).alias("__id"), *BASE)
    marked = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("__label_id"), (F.col(label) == 0).alias("bad"))
    values = {f"s_{name}": F.expr(sql) for name, sql in STATISTICS.items()}
    labelled = working_table(
        rows.join(marked, F.col("__id") == F.col("__label_id")).select(
            "bad", (F.pmod(F.xxhash64("__id"), F.lit(3)) > 0).alias("grow"), *(v.alias(k) for k, v in values.items())
        ),
        "rules-labelled",
    )
    names = list(STATISTICS)
    at = [q / QUANTILES for q in range(QUANTILES + 1)]
    found = labelled.groupBy("bad").agg(*(F.percentile_approx(f"s_{n}", at, 10_000).alias(n) for n in names)).collect()
    if len(found) < 2:
        return []
    cuts = {n: sorted({float(x) for row in found for x in row[n] or []}) for n in names}
    # midpoints part the classes with a margin
    cuts = {n: [(a + b) / 2 for a, b in zip(c, c[1:])] for n, c in cuts.items()}

    def bin_of(name: str) -> Column:
        bounds = F.array(*[F.lit(x) for x in cuts[name]]) if cuts[name] else F.array().cast("array<double>")
        return F.size(F.filter(bounds, lambda t: t <= F.col(f"s_{name}")))

    cells = working_table(
        labelled.select("bad", "grow", *(bin_of(n).alias(n) for n in names))
        .groupBy("grow", *names)
        .agg(F.sum(F.col("bad").cast("long")).alias("bad"), F.sum((~F.col("bad")).cast("long")).alias("good")),
        "rules-cells",
    )

    def on_bins(c: Condition) -> Column:
        below = sum(1 for t in cuts[c.statistic] if t <= c.threshold)
        return (F.col(c.statistic) >= below) if c.at_least else (F.col(c.statistic) < below)

    def holds(conditions) -> Column:
        out = F.lit(True)
        for c in conditions:
            out = out & on_bins(c)
        return out

    rules: list[Rule] = []
    rest = cells
    while len(rules) < MAX_RULES:
        conditions = _grow(rest.where("grow"), names, cuts, holds)
        conditions = _prune(rest.where("not grow"), conditions, holds)
        if not conditions:
            break
        both = rest.where(holds(conditions)).groupBy("grow").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
        n_bad = sum(r["bad"] for r in both)
        if n_bad < MIN_ROWS or any(r["bad"] < MIN_PRECISION * (r["bad"] + r["good"]) for r in both):
            break
        rules.append(Rule(tuple(conditions)))
        rest = rest.where(~holds(conditions))
    return rules


def _grow(cells: DataFrame, names: list[str], cuts: dict, holds) -> list[Condition]:
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        wide = cells.where(holds(conditions))
        pairs = ", ".join(f"'{n}', {n}" for n in names)
        counts = wide.selectExpr("bad", "good", f"stack({len(names)}, {pairs}) as (statistic, bin)")
        grouped = counts.groupBy("statistic", "bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
        by = {n: [(0, 0)] * (len(cuts[n]) + 1) for n in names}
        for row in grouped:
            by[row["statistic"]][row["bin"]] = (row["bad"], row["good"])
        bad, good = (sum(x[k] for x in by[names[0]]) for k in (0, 1))
        if not bad or not good:
            break
        best, best_gain = None, 1e-9
        for name in names:
            below_bad = below_good = 0
            for threshold, (b, g) in zip(cuts[name], by[name]):
                below_bad, below_good = below_bad + b, below_good + g
                for at_least, p, n in ((False, below_bad, below_good), (True, bad - below_bad, good - below_good)):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                        if gain > best_gain + 1e-9:
                            best, best_gain = Condition(name, at_least, threshold), gain
        if best is None or best in conditions:
            break
        conditions.append(best)
    return conditions


def _prune(cells: DataFrame, conditions: list[Condition], holds) -> list[Condition]:
    """The prefix with the highest (bad - good) / (bad + good) on rows the rule did not grow on; the shortest of equals."""
    if not conditions:
        return []
    passed = F.lit(0)
    for n in range(1, len(conditions) + 1):
        passed = passed + holds(conditions[:n]).cast("int")
    rows = cells.groupBy(passed.alias("passed")).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    best, best_worth = [], 0.0
    for n in range(1, len(conditions) + 1):
        bad = sum(r["bad"] for r in rows if r["passed"] >= n)
        good = sum(r["good"] for r in rows if r["passed"] >= n)
        worth = (bad - good) / (bad + good) if bad + good else 0.0
        if worth > best_worth + 1e-12:
            best, best_worth = conditions[:n], worth
    return best


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """statistics with base_failed, rule (the rejecting rule's number) and kept."""
    rejected = F.when(~base_failed(), verdict(rules))
    return statistics.withColumns(
        {"base_failed": base_failed(), "rule": rejected, "kept": ~base_failed() & rejected.isNull()}
    )


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, rule and kept of every document.

    Statistics are written once to the shared folder: learning and judging both read that table.
    """
    statistics = working_table(
        with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"), "rules-statistics"
    )
    return judge(statistics, learn(statistics, labels)).select("doc_id", *BASE, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base rule and the learned rules keep, with their own columns."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(F.col("doc_id").cast("long").alias("__id"), *(F.col(c).alias(n) for c, n in names.items()))
    # labels join the statistics, a few numbers, and not the texts, which are read a second time instead of shuffled
    statistics = with_statistics(plain.select("__id", names["text"]), text=names["text"])
    rules = learn(working_table(statistics.select(F.col("__id").alias("doc_id"), *BASE), "rules-statistics"), labels)
    # a filter moves below columns by copying their expressions into itself, but not below a number of rows: without
    # this, the planner would multiply the statistics' expressions out
    scored = with_statistics(plain, text=names["text"]).withColumn("__row", F.monotonically_increasing_id())
    kept = judge(scored, rules).where(F.col("kept") & (F.col("__row") >= 0))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
