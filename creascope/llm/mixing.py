"""Mixing sources to target weights: raking by iterative proportional fitting, then sampling.

The corpus is reduced to one row per cell (source, language, topic) with its tokens. Raking
multiplies the cells' weights by one factor per source, language and topic in turn until the weighted
tokens have the target shares in all three margins. A document's sampling probability is its cell's
weight, scaled so that the expected sample has the share ``keep`` of all tokens. A cell whose weight
asks for more than it has is taken whole, and the others make up for it, so that ``keep`` is held and
the targets can be missed. With ``meet_targets`` it is the other way round: ``keep`` is lowered to what the
scarcest source, language and topic allow, and the probabilities are raked under their bound of 1.
``expected_margins`` tells what either leaves over. Documents are drawn by a hash of their id, so the
sample does not depend on partitions.

Default targets flatten the observed shares: share ** ``temper``, normalised. Cells grow with
sources times languages times topics, never with documents; raking runs as joins and sums on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creascope.llm.common import stored

MARGINS = ("source", "lang", "topic")
ROUNDS = 6
TEMPER = 0.5
KEEP = 0.5
SCALE_ROUNDS = 12


def token_count(text: Column) -> Column:
    """Runs without ASCII white space; NULL has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def text_form(text: Column) -> Column:
    """A topic for corpora without one: what kind of text it is by its marks."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(text.contains(" | "), "table").when(text.contains("!! "), "shout")
            .when(text.contains("### "), "marked").when(text.contains("@"), "contact").otherwise("prose"))


def draw(id_column: Column) -> Column:
    """Uniform number in [0, 1) from an id: 13 hex digits of its MD5 digest."""
    digest = F.md5(id_column.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def tempered_targets(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """(margin, target): shares of tokens to the power ``temper``, normalised over all values."""
    shares = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    shares = shares.select(margin, F.pow(F.col("tokens").cast("double"), F.lit(temper)).alias("part"))
    whole = shares.agg(F.sum("part").alias("whole"))
    return shares.join(F.broadcast(whole)).select(margin, (F.col("part") / F.col("whole")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, the product of its factors.

    A value without a target, or a target without tokens, gets the factor 0: the mix leaves it out.
    """
    state = cells.withColumn("weight", F.lit(1.0))
    for margin in MARGINS:
        aimed = targets[margin].select(margin, F.col("target").alias(f"to_{margin}"))
        state = state.join(aimed, margin, "left")
    state = stored(state, "cells")
    for _ in range(rounds):
        for margin in MARGINS:
            mass = state.groupBy(margin).agg(F.sum(F.col("weight") * F.col("tokens")).alias("mass"))
            state = state.join(mass, margin).withColumn(
                "weight", F.when(F.col("mass") > 0, F.col("weight") * F.col(f"to_{margin}") / F.col("mass"))
                .otherwise(0.0)).withColumn("weight", F.coalesce("weight", F.lit(0.0))).drop("mass")
        # each margin reads the state twice; a stored table per round keeps the plan small
        state = stored(state, "cells")
    return state.drop(*(f"to_{m}" for m in MARGINS))


def scale_for(weights: DataFrame, keep: float) -> float:
    """The factor at which cells, taken at most whole, give ``keep`` of all tokens."""
    scale = 0.0
    for _ in range(SCALE_ROUNDS):
        whole = F.col("weight") * F.lit(scale) >= 1
        row = weights.agg(
            F.sum("tokens").alias("tokens"), F.sum(F.when(whole, F.col("tokens"))).alias("taken"),
            F.sum(F.when(~whole, F.col("tokens") * F.col("weight"))).alias("mass")).first()
        if not row["mass"]:
            break
        found = (keep * row["tokens"] - (row["taken"] or 0)) / row["mass"]
        if found <= scale:
            break
        scale = found
    return scale


def feasible_keep(cells: DataFrame, targets: dict[str, DataFrame], keep: float) -> float:
    """``keep``, or the largest share at which every value of every margin has tokens for its target."""
    whole = cells.agg(F.sum("tokens")).first()[0]
    if not whole:
        return keep
    for margin in MARGINS:
        held = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0").join(targets[margin], margin)
        most = held.filter("target > 0").agg(F.min(F.col("tokens") / F.col("target"))).first()[0]
        keep = keep if most is None else min(keep, most / whole)
    return keep


def rake_bounded(weights: DataFrame, targets: dict[str, DataFrame], keep: float, rounds: int = ROUNDS) -> DataFrame:
    """``weights`` (of ``rake``) with ``probability``, at most 1, whose expected margins are raked to the targets.

    A factor works on the cells below the bound, those at it count as taken; where they alone hold
    more than the target, all cells of the value are lowered.
    """
    whole = weights.agg(F.sum("tokens")).first()[0] or 0.0
    state = weights.withColumn("chance", F.col("weight") * F.lit(keep * whole))
    for margin in MARGINS:
        state = state.join(targets[margin].select(
            margin, (F.col("target") * F.lit(keep * whole)).alias(f"to_{margin}")), margin, "left")
    state = stored(state, "cells")
    for _ in range(rounds):
        for margin in MARGINS:
            full = F.col("chance") >= 1
            mass = state.groupBy(margin).agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("taken"),
                F.sum(F.when(full, 0.0).otherwise(F.col("chance") * F.col("tokens"))).alias("free"))
            wanted = F.col(f"to_{margin}")
            factor = F.when((F.col("free") > 0) & (wanted > F.col("taken")), (wanted - F.col("taken")) / F.col("free")).when(
                F.col("taken") + F.col("free") > 0, wanted / (F.col("taken") + F.col("free")))
            # a cell at the bound holds what it has, unless its value has too much
            factor = F.when(full & (wanted >= F.col("taken")), F.greatest(factor, F.lit(1.0))).otherwise(factor)
            state = state.join(mass, margin).withColumn(
                "chance", F.coalesce(F.col("chance") * factor, F.lit(0.0))).drop("taken", "free")
        state = stored(state, "cells")
    return state.withColumn("probability", F.least(F.lit(1.0), "chance")).drop("chance", *(f"to_{m}" for m in MARGINS))


def expected_margins(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, target, share): what the sample of ``cells`` (tokens, probability) is expected to hold."""
    mass = F.sum(F.col("tokens") * F.col("probability"))
    out = None
    for margin in MARGINS:
        part = cells.groupBy(margin).agg(mass.alias("mass")).crossJoin(F.broadcast(cells.agg(mass.alias("whole"))))
        part = part.join(targets[margin], margin, "full").select(
            F.lit(margin).alias("margin"), F.col(margin).alias("value"), F.coalesce("target", F.lit(0.0)).alias("target"),
            F.coalesce(F.col("mass") / F.col("whole"), F.lit(0.0)).alias("share"))
        out = part if out is None else out.unionByName(part)
    return out


def sample_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", topic: Column | None = None, targets: dict[str, DataFrame] | None = None,
    temper: float = TEMPER, rounds: int = ROUNDS, keep: float = KEEP,
    meet_targets: bool = False,
) -> DataFrame:
    """The sampled rows of ``docs`` with the columns ``mix_tokens`` and ``mix_probability`` added.

    NULL sources and languages form a value of their own, the empty string. Documents without words
    have no tokens to weigh; they are sampled with the probability of their cell, too. A row with
    a NULL id is never drawn; rows that repeat an id are drawn together. Columns of ``docs`` that
    have the name of an added one are replaced.
    """
    topic = text_form(F.col(text_col)) if topic is None else topic
    labelled = docs.drop("mix_tokens", "mix_probability").select(
        "*", F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"),
        F.coalesce(topic.cast("string"), F.lit("")).alias("_topic"),
        token_count(F.col(text_col)).alias("mix_tokens"))
    cells = stored(labelled.groupBy(
        F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")).agg(
        F.sum("mix_tokens").cast("double").alias("tokens")), "cells")
    targets = targets or {m: tempered_targets(cells, m, temper) for m in MARGINS}
    weights = rake(cells, targets, rounds)
    if meet_targets:
        chances = rake_bounded(weights, targets, feasible_keep(cells, targets, keep), rounds)
    else:
        scale = scale_for(weights, keep)
        chances = weights.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))
    chances = chances.select(
        F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("topic").alias("_topic"),
        F.col("probability").alias("mix_probability"))
    return labelled.join(chances, ["_source", "_lang", "_topic"]).filter(
        draw(F.col(id_col)) < F.col("mix_probability")).select(*docs.drop("mix_tokens", "mix_probability").columns,
                                                          "mix_tokens", "mix_probability")


def mix_sql(rounds: int = ROUNDS, temper: float = TEMPER, keep: float = KEEP) -> str:
    """The same over ``documents`` as SQL, the rounds written out."""
    steps = []
    last = "c0"
    for number in range(rounds * len(MARGINS)):
        margin, name = MARGINS[number % len(MARGINS)], f"c{number + 1}"
        steps.append(
            f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, CASE WHEN m.mass > 0 THEN "
            f"coalesce(c.weight * t.target / m.mass, 0) ELSE 0 END AS weight FROM {last} c JOIN (SELECT {margin}, "
            f"sum(weight * tokens) AS mass FROM {last} GROUP BY {margin}) m ON m.{margin} = c.{margin} "
            f"LEFT JOIN to_{margin} t ON t.{margin} = c.{margin})")
        last = name
    aims = [
        f"to_{m} AS (SELECT {m}, pow(sum(tokens), {temper}) / sum(pow(sum(tokens), {temper})) OVER () AS target "
        f"FROM cells GROUP BY {m} HAVING sum(tokens) > 0)" for m in MARGINS]
    scales = [
        f"s{n + 1} AS MATERIALIZED (SELECT greatest(any_value(s), coalesce(({keep} * sum(tokens) - coalesce(sum(tokens) FILTER "
        f"(weight * s >= 1), 0)) / sum(tokens * weight) FILTER (weight * s < 1), 0)) AS s FROM {last}, s{n})"
        for n in range(SCALE_ROUNDS)]
    return f"""
WITH labelled AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '!! ') THEN 'shout'
      WHEN contains(coalesce(text, ''), '### ') THEN 'marked' WHEN contains(coalesce(text, ''), '@') THEN 'contact'
      ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM labelled GROUP BY ALL),
{", ".join(aims)},
c0 AS (SELECT *, 1.0::DOUBLE AS weight FROM cells),
{", ".join(steps)},
s0 AS (SELECT 0.0::DOUBLE AS s),
{", ".join(scales)},
chance AS (SELECT source, lang, topic, least(1.0, weight * (SELECT s FROM s{SCALE_ROUNDS})) AS p FROM {last})
SELECT d.doc_id, d.tokens AS mix_tokens, round(p, 6) AS mix_probability
FROM labelled d JOIN chance USING (source, lang, topic)
WHERE ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < p"""
