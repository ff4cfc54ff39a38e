"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked until their
marginals meet the targets; a document is drawn with the probability of its
cell, the fitted weight over the present one, scaled so that none exceeds 1.
The draw is a hash of the document, so it repeats. DataFrame functions only;
the driver never sees documents, and cells only up to ``CELLS``: more cells
than that are raked as a DataFrame, so the number of values needs no bound.

A marginal's target shares are given, or tempered: share**temperature,
normalised.

Defined results: null source, language or topic count as the value ``none``;
a null text is empty and weighs one token, as does one without words, so every
row has a chance; a null id is drawn by its text; equal rows are drawn alike;
target shares of values that don't occur are dealt to those that do; occurring
values without a target keep their present share; an empty table gives no
rows. Columns of the input named like the result's are not mixed up with it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocart.llm.store import stored

MARGINS = ("source", "lang", "topic")
#: Cells that are raked on the driver, at most; more are raked by Spark, with the same result.
CELLS = 200_000
#: Passes over the marginals; scales that one job of Spark tries.
ROUNDS, TRIED = 30, 64


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the whole text."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(text, F.lit("License")), "legal")
        .when(F.contains(text, F.lit(" | ")), "tables")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(text.rlike("[0-9]"), "figures")
        .otherwise("prose")
    )


def weigh(docs: DataFrame, topic: Column | None = None, *more: Column) -> DataFrame:
    """doc_id, source, lang, topic, tokens and the draw (0 to 1) of each document, and ``more``."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), text))
    return docs.select(
        F.col("doc_id"),
        F.coalesce("source", F.lit("none")).alias("source"),
        F.coalesce("lang", F.lit("none")).alias("lang"),
        F.coalesce(topic_of(F.col("text")) if topic is None else topic, F.lit("none")).alias("topic"),
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0).alias("draw"),
        *more,
    )


def shares(present: Mapping[str, float], targets: Mapping[str, float] | float) -> dict[str, float]:
    """Target share of every present value; ``targets`` are shares by value, or a temperature."""
    total = sum(present.values())
    if not isinstance(targets, Mapping):
        raw = {v: (n / total) ** targets for v, n in present.items()}
    else:
        free = {v: n / total for v, n in present.items() if v not in targets}
        named = {v: targets[v] for v in present if v in targets}
        scale = (1 - sum(free.values())) / sum(named.values()) if named else 1.0
        raw = {**free, **{v: t * scale for v, t in named.items()}}
    whole = sum(raw.values())
    return {v: t / whole for v, t in raw.items()}


def rake(cells: Mapping[tuple[str, ...], int], targets: list[Mapping[str, float] | float], rounds: int = ROUNDS) -> dict[tuple[str, ...], float]:
    """Fitted weight of every cell after ``rounds`` passes over the marginals."""
    order = sorted(cells)
    total = float(sum(cells.values()))
    goal = []
    for m, target in enumerate(targets):
        present: dict[str, float] = {}
        for c in order:
            present[c[m]] = present.get(c[m], 0.0) + cells[c]
        goal.append({v: s * total for v, s in shares(present, target).items()})
    weight = {c: float(cells[c]) for c in order}
    for _ in range(rounds):
        for m, wanted in enumerate(goal):
            now: dict[str, float] = {}
            for c in order:
                now[c[m]] = now.get(c[m], 0.0) + weight[c]
            for c in order:
                weight[c] *= wanted[c[m]] / now[c[m]]
    return weight


def probabilities(cells: Mapping[tuple[str, ...], int], weight: Mapping[tuple[str, ...], float], budget: float | None) -> dict:
    """Calibrated probability of each cell.

    Without a budget the scale is the largest that keeps all at most 1, so the
    expected marginals are the targets. With a budget (a share of all tokens)
    the scale grows until that share is expected; cells that reach 1 stay there.
    """
    ratio = {c: weight[c] / cells[c] for c in cells}
    if not ratio:
        return {}
    scale = 1 / max(ratio.values())
    if budget is not None:
        wanted = budget * sum(cells.values())
        low, high = scale, 1 / min(ratio.values())
        for _ in range(100):
            scale = (low + high) / 2
            got = sum(n * min(1.0, scale * ratio[c]) for c, n in cells.items())
            low, high = (scale, high) if got < wanted else (low, scale)
    return {c: min(1.0, scale * ratio[c]) for c in ratio}


Targets = Mapping[str, Mapping[str, float] | float]
KEYS = list(MARGINS)


def goals(cells: DataFrame, margin: str, target: Mapping[str, float] | float, total: int) -> DataFrame:
    """``shares`` of every present value of a marginal, times ``total``, as a DataFrame: margin, goal."""
    present = cells.groupBy(margin).agg((F.sum("n") / F.lit(float(total))).alias("part"))
    if isinstance(target, Mapping):
        given = cells.sparkSession.createDataFrame([(v, float(t)) for v, t in target.items()], f"{margin} string, named double")
        present = stored(present.join(given, margin, "left"), "mix-shares")
        sums = present.agg(F.sum("named").alias("named"), F.sum(F.when(F.col("named").isNull(), F.col("part"))).alias("free")).first()
        scale = (1 - (sums["free"] or 0.0)) / sums["named"] if sums["named"] else 1.0
        present = present.select(margin, F.coalesce(F.col("named") * F.lit(scale), F.col("part")).alias("raw"))
    else:
        present = present.select(margin, F.pow("part", F.lit(float(target))).alias("raw"))
    present = stored(present, "mix-shares")
    whole = present.agg(F.sum("raw")).first()[0]
    return stored(present.select(margin, (F.col("raw") / F.lit(whole) * F.lit(float(total))).alias("goal")), "mix-goals")


def rake_cells(cells: DataFrame, targets: Targets, budget: float | None) -> DataFrame:
    """``rake`` and ``probabilities`` of any number of cells (MARGINS, n): each pass is a sum by one marginal and a join."""
    total = cells.agg(F.sum("n")).first()[0]
    wanted = {m: goals(cells, m, targets[m], total) for m in MARGINS}
    weighed = cells.withColumn("w", F.col("n").cast("double"))
    for _ in range(ROUNDS):
        for m in MARGINS:
            factor = weighed.groupBy(m).agg(F.sum("w").alias("now")).join(wanted[m], m).select(m, (F.col("goal") / F.col("now")).alias("factor"))
            weighed = weighed.join(factor, m).select(*KEYS, "n", (F.col("w") * F.col("factor")).alias("w"))
        weighed = stored(weighed, "mix-raked")
    ratio = F.col("w") / F.col("n")
    least, most = weighed.agg(F.min(ratio), F.max(ratio)).first()
    scale = 1 / most
    if budget is not None:
        low, high = scale, 1 / least
        for _ in range(10):  # 65**10 steps: finer than a double
            tried = [low + (high - low) * (k + 1) / (TRIED + 1) for k in range(TRIED)]
            got = weighed.agg(*[F.sum(F.col("n") * F.least(F.lit(1.0), F.lit(x) * ratio)) for x in tried]).first()
            under = sum(g < budget * total for g in got)
            low, high = [low, *tried][under], [*tried, high][under]
        scale = (low + high) / 2
    return weighed.select(*KEYS, F.least(F.lit(1.0), F.lit(scale) * ratio).alias("probability"))


def chances(rows: DataFrame, targets: Targets, budget: float | None) -> DataFrame:
    """The probability of each cell of weighed ``rows``."""
    spark = rows.sparkSession
    cells = stored(rows.groupBy(*KEYS).agg(F.sum("tokens").alias("n")), "mix-cells")
    if cells.count() > CELLS:
        return rake_cells(cells, targets, budget)
    found = {tuple(r[k] for k in KEYS): r["n"] for r in cells.collect()}
    weight = rake(found, [targets[m] for m in MARGINS]) if found else {}
    table = [(*c, p) for c, p in sorted(probabilities(found, weight, budget).items())]
    return F.broadcast(spark.createDataFrame(table, ", ".join(f"{k} string" for k in KEYS) + ", probability double"))  # at most CELLS rows


def mix(docs: DataFrame, targets: Targets, topic: Column | None = None, budget: float | None = None) -> DataFrame:
    """Per document: doc_id, source, lang, topic, tokens, probability, sampled."""
    rows = stored(weigh(docs, topic), "mix-weighed")
    out = rows.join(chances(rows, targets, budget), KEYS)
    return out.select(
        "doc_id", "source", "lang", "topic", "tokens",
        F.round("probability", 9).alias("probability"),
        (F.col("draw") < F.col("probability")).alias("sampled"),
    )


def keep(docs: DataFrame, targets: Targets, topic: Column | None = None, budget: float | None = None) -> DataFrame:
    """The rows of ``docs``, with their columns, that are drawn."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    chance = chances(weigh(docs, topic), targets, budget)
    drawn = weigh(docs, topic, whole).join(chance, KEYS).filter("draw < probability")
    return drawn.select("document.*")


def mix_sql(temperature: Mapping[str, float], rounds: int = 30) -> str:
    """The same as DuckDB SQL for tempered targets: one step of raking a CTE."""
    steps, last = [], "cells"
    for i in range(rounds):
        for m in MARGINS:
            name = f"r{i}_{m}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.* EXCLUDE (w), c.w * t.goal / sum(c.w) OVER (PARTITION BY c.{m}) AS w"
                f" FROM {last} c JOIN goal_{m} t USING ({m}))"
            )
            last = name
    goals = ", ".join(
        f"goal_{m} AS MATERIALIZED (SELECT {m}, pow(sum(n), {temperature[m]}) / sum(pow(sum(n), {temperature[m]})) OVER ()"
        f" * sum(sum(n)) OVER () AS goal FROM cells GROUP BY {m})"
        for m in MARGINS
    )
    return f"""
WITH weighed AS (
  SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang,
         CASE WHEN contains(coalesce(text, ''), 'License') THEN 'legal'
              WHEN contains(coalesce(text, ''), ' | ') THEN 'tables'
              WHEN contains(coalesce(text, ''), '@') THEN 'contact'
              WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures'
              ELSE 'prose' END AS topic,
         greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS tokens,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS draw
  FROM documents
),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS n, sum(tokens)::DOUBLE AS w FROM weighed GROUP BY ALL
),
{goals},
{", ".join(steps)},
chance AS (SELECT source, lang, topic, least(1, w / n / max(w / n) OVER ()) AS probability FROM {last})
SELECT doc_id, source, lang, topic, tokens, round(probability, 9) AS probability, draw < probability AS sampled
FROM weighed JOIN chance USING (source, lang, topic)
"""
