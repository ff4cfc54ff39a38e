"""Quality rules: a decision list learned by sequential covering.

Statistics of whole texts are DataFrame expressions. On the statistics of a
bounded sample of labelled rows, rules (conjunctions of thresholds) for the
bad class are grown one condition at a time, pruned on rows set apart, and the
rows they cover are taken out; the list becomes one ordered chain of Spark
conditional expressions, evaluated over every document. DataFrame functions
only; the sample is at most ``SAMPLE`` rows of numbers.

Defined results: a null text is an empty one (no words, not kept); an empty
text has no lines with a word; repeated rows get equal results; without
labelled rows the list is empty and only the base decides; an empty table gives
no rows; a row without an id is judged like any other, but learned from by no
label; of ids with equal hashes the smaller is learned from first, and conditions
of equal gain are taken in the order they are tried, so the list is the same in
every run; other columns are not read. No text is cut.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the list is learned from, at most: those with the smallest hashes of their ids.
SAMPLE = 8000
WINDOW = 5
SPACE = r"[\x20\x09-\x0D]"
#: Statistics the conditions may test, made from the counted ones; none divides by zero.
FEATURES = ("n_words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "distinct")


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the counts of each text, and the features."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    rows = rows.withColumn("words", F.when(trimmed != "", F.split(trimmed, SPACE + "+")).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    at = F.col("words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(at) - WINDOW), lambda i: F.xxhash64(*[F.get(at, i + k) for k in range(WINDOW)])
    )
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count("text", F.lit("[0-9]")).alias("n_digits"),
        F.regexp_count("text", F.lit("[.,;:!?]")).alias("n_marks"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        lines.alias("lines"),
        F.when(F.size("words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # windows found twice: only texts that have any are sorted, by hash and then place
    marked = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("marked", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), marked))
    m = F.col("marked")
    twice = F.filter(m, lambda x, j: (F.get(m, j + 1)["h"] == x["h"]) | ((j > 0) & (F.get(m, j - 1)["h"] == x["h"])))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    counted = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper", "n_digits", "n_marks", "n_distinct", F.size("lines").alias("n_lines"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.withColumns(
        {
            "mean_word": F.col("word_chars") / words,
            "symbols": F.col("n_symbols") / words,
            "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeats": F.col("n_repeat_words") / words,
            "upper": F.col("n_upper") / chars,
            "digits": F.col("n_digits") / chars,
            "marks": F.col("n_marks") / words,
            "distinct": F.col("n_distinct") / words,
        }
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.limit if self.above else row[self.feature] <= self.limit

    def column(self) -> Column:
        return F.col(self.feature) >= self.limit if self.above else F.col(self.feature) <= self.limit


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _grow(rows: list[dict]) -> Rule:
    """Add the condition with the largest FOIL gain until the rule covers bad rows only, or none gains."""
    rule: list[Condition] = []
    while len(rule) < 6:
        bad, n = sum(r["bad"] for r in rows), len(rows)
        if not bad or bad == n:
            break
        before, best = math.log2(bad / n), (1e-9, None)
        for feature in FEATURES:
            ordered = sorted((r[feature], r["bad"]) for r in rows)
            seen = 0
            for i in range(1, n):
                seen += ordered[i - 1][1]
                if ordered[i][0] == ordered[i - 1][0]:
                    continue
                limit = (ordered[i][0] + ordered[i - 1][0]) / 2
                for above, p, size in ((False, seen, i), (True, bad - seen, n - i)):
                    if p and (gain := p * (math.log2(p / size) - before)) > best[0]:
                        best = (gain, Condition(feature, above, limit))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = _covered((best[1],), rows)
    return tuple(rule)


def _worth(rule: Rule, rows: list[dict]) -> float:
    got = _covered(rule, rows)
    bad = sum(r["bad"] for r in got)
    return (2 * bad - len(got)) / len(got) if got else -1.0


def learn(rows: list[dict], precision: float = 0.9, least: float = 0.01) -> list[Rule]:
    """Rules for ``bad`` rows, in order. Two thirds of the rows grow rules, one third prunes them.

    A rule enters if ``precision`` of what it covers among the pruning rows is
    bad; covering stops when it doesn't, or when under ``least`` of the bad
    rows is left.
    """
    grow, prune = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    rules: list[Rule] = []
    stop = least * sum(r["bad"] for r in grow)
    while sum(r["bad"] for r in grow) > stop and len(rules) < 32:
        rule = _grow(grow)
        while len(rule) > 1 and _worth(rule[:-1], prune) >= _worth(rule, prune):
            rule = rule[:-1]
        if not rule or _worth(rule, prune) < 2 * precision - 1:
            break
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn the list from at most ``sample`` labelled rows (quality 0 is bad, 1 good; others are left out)."""
    chosen = (
        labels.select(F.col("doc_id"), F.col("quality").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")  # ``sample`` ids at most
    known = statistics(picked).join(F.broadcast(chosen), "doc_id")
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).select((1 - F.col("label")).alias("bad"), *FEATURES)
    return learn([r.asDict() for r in rows.limit(2 * sample).collect()])


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: false where a rule holds, true where none does."""
    out: Column | None = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per document: the counts, base_failed and kept, and the features the rules read."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return statistics(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
