"""Mixing sources to target weights by iterative proportional fitting.

Tokens (words) are summed to cells of source, language and topic. The cells' token weights are raked
to the three margins' targets in ``ROUNDS`` rounds; a margin's target shares are its token shares to
a power below 1, which lifts small sources, languages and topics. A cell's sampling probability is its
raked tokens over its tokens, scaled so that ``RATE`` of all tokens is expected; cells that would pass 1
are kept whole and the rest is raised (``CAPPING`` rounds). What is left of such a cell's weight comes as
``weight``, by which the kept tokens meet the margins; rows asked for without weights are sampled by ``bounded`` instead. A document stays if a hash of its id, uniform
on [0, 1), lies below its cell's probability.

Everything is DataFrame functions. Documents are read twice: once for the sums, combined before the
shuffle, and once, narrow, to be sampled, as the written cell table is small and joined by broadcast
while Spark knows it to be (a cell table beyond the session's limit is joined by a shuffle whose hot cells are
split). Between rounds the cell table is written to the shared folder; one row of sums reaches the driver.

Results for odd input: a null source, language or topic is the value ''; a null text has no tokens;
cells without tokens get probability 1 and weight 1 (they cost nothing); a null id draws as the
empty text; equal ids draw alike; no rows give no rows; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import WORD, fresh, written

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
RATE, ROUNDS, CAPPING = 0.5, 10, 6
#: Most rounds of the bounded raking, and the share of the sample by which every margin may then be off.
BOUNDED, CLOSE = 30, 1e-3
SALT = "mix:"


def surface_topic(text: Column) -> Column:
    """A topic by surface cues, for tables without one: tables, marked-up text, licences, contacts, prose."""
    return (F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(text, F.lit("%%%")), "marked")
            .when(F.contains(text, F.lit("icense")), "licence").when(F.contains(text, F.lit("@")), "contact").otherwise("prose"))


def draw(id_: Column) -> Column:
    """A number from [0, 1) by the id: 52 bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(SALT), F.coalesce(id_.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rake(cells: DataFrame, powers: dict[str, float], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margins, tokens) with ``raked``: tokens moved to the targets of all margins, the total unchanged."""
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0.0
    now = cells.withColumn("raked", F.col("tokens"))
    for m, power in powers.items():
        sums = cells.groupBy(m).agg(F.pow(F.sum("tokens") / max(total, 1.0), F.lit(power)).alias("share"))
        all_shares = sums.agg(F.sum("share").alias("s")).first().s or 1.0
        now = now.join(sums.select(m, (F.col("share") * (total / all_shares)).alias(f"target_{m}")), m)
    now = written(now, "raked")
    for _ in range(rounds):
        for m in powers:  # one small sum and one join a step; written, so that plans stay small
            factor = now.groupBy(m).agg((F.first(f"target_{m}") / F.sum("raked")).alias("factor"))
            now = written(now.join(factor, m).withColumn("raked", F.col("raked") * F.col("factor")).drop("factor"), "raked")
    return now.drop(*[f"target_{m}" for m in powers])


def probabilities(cells: DataFrame, rate: float = RATE, capping: int = CAPPING) -> DataFrame:
    """Raked cells with ``ratio`` (wanted over present tokens) and ``probability``."""
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0.0
    ratio = cells.withColumn("ratio", rate * F.col("raked") / F.col("tokens"))
    scale = 1.0
    for _ in range(capping):
        full = F.col("ratio") * scale >= 1
        got = ratio.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("ratio") * F.col("tokens"))).alias("open")).first()
        scale = max(scale, (rate * total - got.full) / got.open) if got.open else scale
    return ratio.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * scale))


def bounded(cells: DataFrame, powers: dict[str, float], rate: float = RATE, rounds: int = BOUNDED, close: float = CLOSE) -> tuple[DataFrame, float]:
    """Cells with ``ratio`` and ``probability``, equal here, and the largest share by which a margin of the expected sample is off.

    ``rate`` of the tokens are raked to the margins' targets, but no cell beyond its own tokens: a cell that would
    pass them is frozen there and the rest of its margin is raked to what remains. A value whose tokens fall short of its
    target is wanted whole, and the other values take the difference by their shares.
    """
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0.0
    now = cells.withColumn("raked", F.col("tokens") * rate)
    for m, power in powers.items():
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("own"))
        sums = written(sums.withColumn("share", F.pow(F.col("own") / max(total, 1.0), F.lit(power))), "targets")
        scale, before = 0.0, -1.0
        while scale > before:  # ends when no further value falls short
            before = scale
            short = F.col("share") * scale >= F.col("own")
            got = sums.agg(F.sum(F.when(short, F.col("own")).otherwise(0.0)).alias("full"), F.sum(F.when(short, 0.0).otherwise(F.col("share"))).alias("open")).first()
            scale = max(scale, (rate * total - got.full) / got.open) if got.open else scale
        now = now.join(sums.select(m, F.least(F.col("own"), F.col("share") * scale).alias(f"target_{m}")), m)
    now = written(now, "bounded")
    off = 0.0
    for _ in range(rounds):
        for m in powers:
            full = F.col("raked") >= F.col("tokens")
            sums = now.groupBy(m).agg(F.first(f"target_{m}").alias("want"), F.sum("raked").alias("all"), F.sum(F.when(full, F.col("raked")).otherwise(0.0)).alias("full"))
            rest = F.col("all") - F.col("full")
            up = F.when(rest > 0, (F.col("want") - F.col("full")) / rest).otherwise(1.0)
            sums = sums.select(m, (F.col("want") < F.col("all")).alias("down"), F.when(F.col("want") < F.col("all"), F.col("want") / F.col("all")).otherwise(up).alias("factor"))
            moved = F.when(full & ~F.col("down"), F.col("tokens")).otherwise(F.least(F.col("tokens"), F.col("raked") * F.col("factor")))
            now = written(now.join(sums, m).withColumn("raked", moved).drop("down", "factor"), "bounded")
        off = max(now.groupBy(m).agg(F.abs(F.sum("raked") - F.first(f"target_{m}")).alias("d")).agg(F.max("d").alias("d")).first().d or 0.0 for m in powers) / max(rate * total, 1.0)
        if off < close:
            break
    p = F.least(F.lit(1.0), F.col("raked") / F.col("tokens"))
    return now.drop(*[f"target_{m}" for m in powers]).withColumn("ratio", p).withColumn("probability", p), off


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        topic: Column | None = None, powers: dict[str, float] | None = None, rate: float = RATE, rounds: int = ROUNDS, report: bool = True) -> DataFrame:
    """The sampled rows of ``docs``; with ``report`` as (id, source, lang, topic, weight, probability), else with their own columns.

    Rows without a weight have to meet the margins by themselves: their probabilities are raked within bounds.
    A margin that is off by more than ``CLOSE`` of the sample is warned of.
    """
    powers = powers or POWERS
    text = F.col(f"`{text_col}`").cast("string")
    margins = {"source": F.col(f"`{source_col}`").cast("string"), "lang": F.col(f"`{lang_col}`").cast("string"), "topic": topic if topic is not None else surface_topic(text)}
    margins = {m: F.coalesce(c, F.lit("")) for m, c in margins.items()}
    counted = docs.select(*[c.alias(m) for m, c in margins.items()], F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).alias("tokens"))
    cells = written(counted.groupBy(*margins).agg(F.sum("tokens").cast("double").alias("tokens")), "cells")
    if report:
        filled = probabilities(rake(cells.where("tokens > 0"), powers, rounds), rate)
    else:
        filled, off = bounded(cells.where("tokens > 0"), powers, rate)
        if off >= CLOSE:
            warnings.warn(f"mixing: a margin of the sample is off by {off:.4f} of its tokens", stacklevel=2)
    empty = cells.where("tokens = 0").select(*margins, F.lit(1.0).alias("ratio"), F.lit(1.0).alias("probability"))
    names = {n: fresh(docs, f"cell_{n}") for n in (*margins, "ratio", "probability")}
    of = written(filled.select(*margins, "ratio", "probability").unionByName(empty).select(*[F.col(n).alias(names[n]) for n in names]), "cells")
    on = None
    for m, c in margins.items():
        on = (c == F.col(names[m])) if on is None else on & (c == F.col(names[m]))
    kept = docs.join(of, on).where(draw(F.col(f"`{id_col}`")) < F.col(names["probability"]))
    if not report:
        return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
    p = F.col(names["probability"])
    return kept.select(F.col(f"`{id_col}`"), *[F.col(names[m]).alias(m) for m in margins], F.round(F.col(names["ratio"]) / p, 6).alias("weight"), F.round(p, 6).alias("probability"))


def sql() -> str:
    """The same over ``documents`` for DuckDB: the rounds written out."""
    steps = ["""docs AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '%%%') THEN 'marked' WHEN contains(text, 'icense') THEN 'licence'
       WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END AS topic,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents)""",
             "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM docs GROUP BY ALL)",
             "r0 AS MATERIALIZED (SELECT *, tokens AS raked, sum(tokens) OVER () AS total FROM cells WHERE tokens > 0)"]
    for m, power in POWERS.items():
        steps += [f"s_{m} AS (SELECT {m}, pow(sum(tokens) / any_value(total), {power}) AS share, any_value(total) AS total FROM r0 GROUP BY {m})",
                  f"t_{m} AS MATERIALIZED (SELECT {m}, share * total / sum(share) OVER () AS target_{m} FROM s_{m})"]
    k = 0
    for _ in range(ROUNDS):
        for m in POWERS:
            steps.append(f"r{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (raked * target_{m} / sum(raked) OVER (PARTITION BY {m}) AS raked) FROM r{k} r JOIN t_{m} USING ({m}))")
            k += 1
    steps += [f"ratios AS MATERIALIZED (SELECT *, {RATE} * raked / tokens AS ratio FROM r{k})", "c0 AS (SELECT 1.0::DOUBLE AS scale)"]
    for i in range(CAPPING):
        steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT coalesce(greatest(any_value(scale), ({RATE} * any_value(total) - sum(CASE WHEN ratio * scale >= 1 THEN tokens ELSE 0 END))
  / nullif(sum(CASE WHEN ratio * scale >= 1 THEN 0 ELSE ratio * tokens END), 0)), any_value(scale)) AS scale FROM ratios, c{i})""")
    return "WITH " + ",\n".join(steps) + f""",
p AS (SELECT source, lang, topic, ratio, least(1.0, ratio * scale) AS probability FROM ratios, c{CAPPING}
      UNION ALL SELECT source, lang, topic, 1.0, 1.0 FROM cells WHERE tokens = 0)
SELECT doc_id, source, lang, topic, round(ratio / probability, 6) AS weight, round(probability, 6) AS probability FROM docs JOIN p USING (source, lang, topic)
WHERE ('0x' || substr(md5('{SALT}' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {1 << 52}::DOUBLE < probability"""
