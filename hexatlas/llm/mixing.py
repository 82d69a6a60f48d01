"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only.

Documents are counted into cells (source, language, topic) of tokens. Raking multiplies the cells' weights, each bounded at 1 as a
probability, until the kept tokens of every source, language and topic meet their targets: the bound stands inside the loop, so that
what one full cell can't give its neighbours do. Whether a document stays is decided by a hash of its doc_id.

Targets are tempered shares: a value with t of the tokens wants t^POWER, normalised, so that a source with a third of all rows gives
way to small ones. A value can't have more than all its tokens; what it can't take goes to the others, so that the kept tokens are KEEP of
all. Such targets of three columns may still exclude each other. They are therefore also fitted blended with plain KEEP of each value's
tokens, in quarters (LEVELS), which always can be met in the end; the boldest level that is met counts.

Other targets can be given as {column: {value: share}}. They are fitted as they are, at ten sizes up to the largest that the values'
tokens allow (at most KEEP); the largest that is met counts, and where none is a ValueError is raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, load, stash, unpacked, whole_row

MARGINALS = ("source", "lang", "topic")
POWER, KEEP, ROUNDS, SEED = 0.7, 0.9, 10, "mix-1"
MISS, MOST = 1e-3, 1e9  # what the kept tokens of a value may miss of all kept tokens; the largest weight
LEVELS = (1.0, 0.75, 0.5, 0.25, 0.0)
SIZES = tuple(i / 10 for i in range(10, 0, -1))
#: documents has no topics: the first pattern that a text matches names its topic, "prose" where none does.
TOPICS = (("table", " \\| "), ("legal", "[Ll]icense|[Cc]opyright"), ("contact", "@[A-Za-z]"))


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Words between spaces and line ends; none in a null text."""
    words = F.filter(F.split(F.translate(text, "\n", " "), " "), lambda w: w != "")
    return F.coalesce(F.size(words), F.lit(0)).cast("double")


def described(docs: DataFrame) -> DataFrame:
    """docs with _source, _lang, _topic (null: "none"), _tokens and _u, a number in [0, 1) from doc_id (null: from the text)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    u = F.conv(F.substring(F.md5(F.concat(key, F.lit(":" + SEED))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    text = docs["text"]
    return docs.withColumns({"_source": F.coalesce(docs["source"].cast("string"), F.lit("none")),
                             "_lang": F.coalesce(docs["lang"].cast("string"), F.lit("none")),
                             "_topic": topic(text), "_tokens": tokens(text), "_u": u})


def filled(have: DataFrame, total: float, keep: float) -> float:
    """The scale at which least(t, scale * w), summed over the values, is `keep` of all tokens. Only sums reach the driver."""
    scale, before = None, 0
    while True:  # values that the scale fills up are set aside; their number only grows
        full = F.lit(False) if scale is None else F.col("w") * F.lit(scale) >= F.col("t")
        row = have.agg(F.sum(F.when(full, F.col("t")).otherwise(0.0)).alias("full"), F.sum(F.when(full, 1).otherwise(0)).alias("n"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("rest")).first()
        if not row["rest"] or (scale is not None and row["n"] == before):
            return scale
        before, scale = row["n"], (keep * total - row["full"]) / row["rest"]


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, keep: float = KEEP,
         rounds: int = ROUNDS) -> DataFrame:
    """cells (_source, _lang, _topic, tokens) with prob, and factor, prob over the share of all tokens kept. Cells of no tokens follow along.

    Targets that name values without tokens, or that can't be met together at any size, raise a ValueError.
    """
    names = [f"_{c}" for c in MARGINALS]
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    if not total:
        return cells.select(*names, "tokens", F.lit(1.0).alias("prob"), F.lit(1.0).alias("factor"))
    fitted, highest = cells, keep
    for c in MARGINALS:  # totals by value, then the values' goals; joined on the value, a row each
        have = cells.groupBy(f"_{c}").agg(F.sum("tokens").alias("t"))
        weight = F.pow("t", F.lit(power))
        if given := (targets or {}).get(c):
            held = {r[0] for r in have.where("t > 0").where(F.col(f"_{c}").isin(list(given))).collect()}  # no more than were given
            if empty := sorted(v for v, share in given.items() if share > 0 and v not in held):
                raise ValueError(f"no tokens of {c} {', '.join(empty)}, for which there is a target")
            known = F.create_map(*[F.lit(x) for value, share in given.items() for x in (value, float(share))])
            weight = F.coalesce(known[F.col(f"_{c}")], F.lit(0.0))
        have = have.withColumn("w", weight)
        if targets:
            row = have.agg(F.sum("w").alias("w"), F.min(F.when(F.col("w") > 0, F.col("t") / F.col("w"))).alias("r")).first()
            highest = min(highest, row["r"] * row["w"] / total)
            goal = have.select(f"_{c}", (F.col("w") / F.lit(row["w"]) * F.lit(total)).alias(f"_bold_{c}"), F.lit(0.0).alias(f"_plain_{c}"))
        else:
            scale = filled(have, total, keep)
            goal = have.select(f"_{c}", F.least("t", F.col("w") * F.lit(scale)).alias(f"_bold_{c}"), (F.col("t") * F.lit(keep)).alias(f"_plain_{c}"))
        fitted = fitted.join(goal, f"_{c}")
    levels = [highest * x for x in SIZES] if targets else list(LEVELS)
    fitted = fitted.withColumn("level", F.explode(F.array(*map(F.lit, levels)))).withColumn("weight", F.lit(keep))
    fitted = stash(fitted.select(*names, "tokens", "level", "weight", *[
        (F.col("level") * F.col(f"_bold_{c}") + (1 - F.col("level")) * F.col(f"_plain_{c}")).alias(f"_goal_{c}") for c in MARGINALS]))

    def now(c: str) -> Column:
        return F.expr(f"sum(tokens * least(1D, weight)) OVER (PARTITION BY level, _{c})")

    for i in range(rounds):
        for c in MARGINALS:
            raked = F.least(F.col("weight") * F.col(f"_goal_{c}") / F.col("_now"), F.lit(MOST))
            fitted = fitted.withColumn("_now", now(c)).withColumn("weight", F.when(F.col("_now") > 0, raked).otherwise(F.col("weight"))).drop("_now")
        if i % 5 == 4 or i == rounds - 1:
            fitted = stash(fitted)
    missed = fitted.select("level", F.greatest(*[F.abs(now(c) - F.col(f"_goal_{c}")) for c in MARGINALS]).alias("miss"))
    share = F.col("level") if targets else F.lit(keep)
    met = missed.groupBy("level").agg(F.max("miss").alias("miss")).where(F.col("miss") <= F.lit(MISS * total) * share).agg(F.max("level")).first()[0]
    if met is None:
        raise ValueError("the targets can't be met together")
    prob = F.least(F.lit(1.0), F.col("weight"))
    return fitted.where(F.col("level") == F.lit(met)).select(*names, "tokens", prob.alias("prob"), (prob / share).alias("factor"))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, keep: float = KEEP) -> DataFrame:
    """doc_id, text, source and lang (and _row, if there) of docs with _source, _lang, _topic, _tokens, factor, prob and kept.

    Cells are pre-aggregated before any shuffle of rows; texts are not shuffled where Spark sees that the table of cells is small.
    Null or empty texts weigh nothing and share their cell's probability; an empty table stays empty; repeated rows stay or go together.
    """
    told = described(docs.select("doc_id", "text", "source", "lang", *[c for c in docs.columns if c == "_row"]))
    cells = stash(told.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")))
    chosen = stash(rake(cells, targets, power, keep).drop("tokens"))
    discard(cells)
    return told.join(chosen, ["_source", "_lang", "_topic"]).withColumn("kept", F.col("_u") < F.col("prob"))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, keep: float = KEEP) -> DataFrame:
    """The rows of docs that stay; the columns of docs."""
    row = docs.select(whole_row(docs).alias("_row"), *[docs[c] for c in ("doc_id", "text", "source", "lang")])
    return unpacked(mixed(row, targets, power, keep).where("kept"), "_row", docs)


def op8_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs).select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
                              F.col("_tokens").cast("long").alias("tokens"), F.round("factor", 6).alias("factor"),
                              F.round("prob", 6).alias("prob"), "kept")


def op8_sql() -> str:
    case = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)

    def now(c: str) -> str:
        return f"sum(tokens * least(1, weight)) OVER (PARTITION BY level, {c})"

    steps, last = [], "goals"
    for i in range(ROUNDS):
        for c in MARGINALS:
            steps.append(f"r{i}_{c} AS (SELECT * REPLACE (CASE WHEN {now(c)} > 0 THEN least(weight * goal_{c} / {now(c)}, {MOST}) "
                         f"ELSE weight END AS weight) FROM {last})")
            last = f"r{i}_{c}"
    fills = ", ".join(f"""have_{c} AS (SELECT {c}, sum(tokens) AS t, pow(sum(tokens), {POWER}) AS w FROM cells GROUP BY {c}),
tried_{c} AS (SELECT t, w, ({KEEP} * sum(t) OVER () - coalesce(sum(t) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS scale
  FROM have_{c} WHERE t > 0 WINDOW before AS (ORDER BY t, {c} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fill_{c} AS (SELECT {c}, least(t, w * (SELECT max(scale) FROM tried_{c} WHERE scale * w <= t)) AS bold_{c}, {KEEP} * t AS plain_{c} FROM have_{c})"""
                      for c in MARGINALS)
    goals = ", ".join(f"level * bold_{c} + (1 - level) * plain_{c} AS goal_{c}" for c in MARGINALS)
    joins = " ".join(f"JOIN fill_{c} USING ({c})" for c in MARGINALS)
    levels = ", ".join(f"({x}::DOUBLE)" for x in LEVELS)
    return f"""
WITH told AS (
  SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang, CASE {case} ELSE 'prose' END AS topic,
    coalesce(len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '')), 0)::DOUBLE AS tokens,
    ('0x' || md5(coalesce(doc_id::VARCHAR, md5(text), '') || ':{SEED}')[1:12])::BIGINT / {1 << 48}.0::DOUBLE AS u
  FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens FROM told GROUP BY ALL),
{fills},
goals AS (SELECT source, lang, topic, tokens, level, {KEEP}::DOUBLE AS weight, {goals} FROM cells {joins}, (VALUES {levels}) AS levels(level)),
{", ".join(steps)},
raked AS MATERIALIZED (SELECT *, greatest({", ".join(f"abs({now(c)} - goal_{c})" for c in MARGINALS)}) AS miss FROM {last}),
met AS (SELECT level FROM raked GROUP BY level HAVING max(miss) <= {MISS * KEEP} * (SELECT sum(tokens) FROM cells)),
chosen AS (SELECT source, lang, topic, least(1, weight) AS prob FROM raked WHERE level = (SELECT max(level) FROM met))
SELECT doc_id, source, lang, topic, t.tokens::BIGINT AS tokens, round(prob / {KEEP}, 6) AS factor, round(prob, 6) AS prob, u < prob AS kept
FROM told t JOIN chosen USING (source, lang, topic)"""
