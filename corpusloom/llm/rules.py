"""Quality rules: a decision list learned by sequential covering, emitted as ordered Spark conditions.

Statistics of labelled documents are bounded rows of numbers. Covering grows a conjunction of thresholds that best
separates poor documents from the rest (information gain), prunes it on rows set aside, keeps it if it is precise
enough there, removes what it covers and goes on. The list becomes one CASE expression, first match wins; statistics
and verdict are DataFrame expressions throughout.

Null and empty texts have no words and fail the base rule; repeated rows and equal texts get equal verdicts, and a text
of any length is counted whole. Of rules that hold at once the first decides; of conditions of equal gain the first
found is grown. Without labels of both classes the list is empty and the base rule alone decides; an empty table gives
an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.training import labelled_sample

SPACES = r"[ \t\n\x0B\f\r]+"
RUN = 8


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text beside the columns of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("_w", F.filter(F.split(text, SPACES), lambda w: w != ""))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    df = df.withColumn("_lines", lines)
    df = df.withColumn("n_lines", F.size("_lines").cast("long")).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    df = df.withColumn("word_chars", F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)))
    df = df.withColumn("n_symbols", F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"))
    df = df.withColumn("n_marks", F.length(F.regexp_replace(text, r"[^!?]+", "")).cast("long"))
    df = df.withColumn("n_upper", F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long"))
    df = df.withColumn("n_distinct", F.size(F.array_distinct("_w")).cast("long"))
    # hashes of all windows; most texts have no two alike and need no positions
    df = df.withColumn("_h", F.when(F.col("n_words") > RUN, F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - (RUN - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("_w", i, RUN)))))
    df = df.withColumn("_again", F.coalesce(F.size("_h") > F.size(F.array_distinct("_h")), F.lit(False)))
    at = F.array_sort(F.when(F.col("_again"), F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_at", at)
    # after sorting, a window found twice has an equal neighbour
    near = F.zip_with("_at", F.slice("_at", 2, F.size("_at")), lambda a, b: F.struct(a.i.alias("i"), (a.h == b.h).alias("after")))
    df = df.withColumn("_near", near)
    df = df.withColumn(
        "_starts",
        F.array_sort(F.transform(F.filter(F.transform("_near", lambda x, k: F.struct(x.i.alias("i"), (x.after | F.when(k > 0, F.get("_near", k - 1).after).otherwise(F.lit(False))).alias("twice"))), lambda x: F.coalesce(x.twice, F.lit(False))), lambda x: x.i)),
    )
    # words covered by windows in order of their start: each adds what the one before has not covered
    covered = F.aggregate("_starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-RUN).alias("last")), lambda a, i: F.struct((a.n + F.least(F.lit(RUN), i - a["last"])).alias("n"), i.alias("last")), lambda a: a.n)
    df = df.withColumn("n_repeat_words", F.when(F.col("_again"), covered).otherwise(F.lit(0)).cast("long"))
    return df.drop("_w", "_lines", "_h", "_again", "_at", "_near", "_starts")


#: Shares that rules may bound, each of columns of ``statistics``.
SHARES = {
    "symbols_a_word": ("n_symbols", "n_words"),
    "marks_a_word": ("n_marks", "n_words"),
    "upper_a_char": ("n_upper", "word_chars"),
    "distinct_a_word": ("n_distinct", "n_words"),
    "repeat_a_word": ("n_repeat_words", "n_words"),
    "dup_lines_a_line": ("n_dup_lines", "n_lines"),
    "chars_a_word": ("word_chars", "n_words"),
    "words": ("n_words", None),
}


def share(name: str) -> Column:
    top, bottom = SHARES[name]
    return F.col(top).cast("double") if bottom is None else F.coalesce(F.col(top) / F.nullif(F.col(bottom), F.lit(0)), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def holds(self, row: dict) -> bool:
        return row[self.name] > self.bound if self.above else row[self.name] <= self.bound

    def column(self) -> Column:
        return share(self.name) > self.bound if self.above else share(self.name) <= self.bound


def _entropy_gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: list[tuple[dict, int]], most: int) -> list[Condition]:
    """Add the condition of highest gain until no good row is covered."""
    rule: list[Condition] = []
    while len(rule) < most:
        p0, n0 = sum(y for _, y in rows), sum(1 - y for _, y in rows)
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name in SHARES:
            values = sorted((r[name], y) for r, y in rows)
            p = n = 0
            for k in range(len(values) - 1):
                p, n = p + values[k][1], n + 1 - values[k][1]
                if values[k][0] == values[k + 1][0]:
                    continue
                middle = (values[k][0] + values[k + 1][0]) / 2
                for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                    if (g := _entropy_gain(a, b, p0, n0)) > gain:
                        best, gain = Condition(name, above, middle), g
        if best is None:
            break
        rule.append(best)
        rows = [x for x in rows if best.holds(x[0])]
    return rule


def _worth(rule: list[Condition], rows: list[tuple[dict, int]]) -> tuple[float, int]:
    got = [y for r, y in rows if all(c.holds(r) for c in rule)]
    return ((sum(got) + 1) / (len(got) + 2), len(got))


def learn(rows: list[tuple[dict, int]], precision: float = 0.9, most_rules: int = 12, most_conditions: int = 4) -> list[list[Condition]]:
    """Ordered conjunctions that cover rows of class 1; two rows in three grow a rule, the third prunes it."""
    rules: list[list[Condition]] = []
    while len(rules) < most_rules:
        grow, prune = [x for i, x in enumerate(rows) if i % 3], [x for i, x in enumerate(rows) if not i % 3]
        rule = _grow(grow, most_conditions)
        if not rule:
            break
        # the shortest prefix that is no worse on rows the rule has not seen
        best = max(range(len(rule), 0, -1), key=lambda k: (_worth(rule[:k], prune)[0], -k))
        rule = rule[:best]
        value, covered = _worth(rule, rows)
        if value < precision or not covered:
            break
        rules.append(rule)
        rows = [x for x in rows if not all(c.holds(x[0]) for c in rule)]
        if not any(y for _, y in rows):
            break
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds, from 1; null if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        every = rule[0].column()
        for c in rule[1:]:
            every = every & c.column()
        out = F.when(every, F.lit(k)) if out is None else out.when(every, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learned_rules(docs: DataFrame, labels: DataFrame, most: int = 2000, most_chars: int = 100_000) -> list[list[Condition]]:
    """Rules for poor documents, from at most ``most`` labelled rows that the base rule lets pass."""
    sample = statistics(labelled_sample(docs, labels, "quality", 4, 2, most, most_chars)).drop("text").withColumn("base_failed", base_failed())
    # a filter here would be pushed below the statistics and repeat them; the sample is bounded, so it is filtered on arrival
    rows = [r for r in sample.select("doc_id", "label", "base_failed", *[share(n).alias(n) for n in SHARES]).collect() if not r.base_failed]
    rows.sort(key=lambda r: (r.doc_id, r.label, r.words, r.symbols_a_word))
    return learn([(r.asDict(), 1 - r.label) for r in rows])


def judge(docs: DataFrame, labels: DataFrame, rules: list[list[Condition]] | None = None) -> DataFrame:
    """doc_id, statistics, base_failed, rule (the first of the list that holds) and kept, for every row."""
    rules = learned_rules(docs, labels) if rules is None else rules
    df = statistics(docs.select("doc_id", "text")).drop("text").withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return df.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
