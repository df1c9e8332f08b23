"""Mixing sources to target weights by iterative proportional fitting, with DataFrame operations only.

Documents are summed to cells of (source, language, topic). Raking scales the cells' token weights to each margin's targets in
turn until all three hold; a document is kept when its own random number lies below its cell's calibrated probability, so a
lost executor changes nothing.

Targets are tempered shares of the budget: each value's share of all tokens to the power ``temperature``, brought to sum 1. No
value can give more tokens than it has, so what such values lack is spread over the other ones by their targets. In the same
way a cell gives all its tokens at most: a cell at that bound stays there while the other cells of its value are scaled to
what is missing. Raking ends when every margin is within ``TOLERANCE`` of the budget, or after ``ROUNDS`` rounds: margins that
contradict one another (each source in one language, say) have no solution, and ``margins_of`` reports what each value got.

The topic is the class that ``labels`` gives a document (quality and toxicity), ``unlabelled`` for the others; any other table
of topics can be given. Null source or language is a value of its own. Empty texts have no tokens: they get their cell's
probability, and a cell without any token is kept whole. Repeated rows share their fate, as the random number comes from the
id and ``seed``; if an id has several labels, the largest values count. An empty table gives an empty table. The result has all
columns of ``docs`` and three more; columns of ``docs`` with their names give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.shared import written

#: Cells up to which one task rakes all of them without a shuffle; beyond, values are summed on the map side and joined back. The
#: numbers are the same but for the order of sums.
ONE_TASK_CELLS = 20_000
#: Rounds of raking at most and in one plan, and the share of the budget by which margins may miss their targets.
ROUNDS, PLAN_ROUNDS, TOLERANCE = 64, 4, 1e-4
#: How far a cell's weight may grow over its bound, and decimals of a probability.
OVER, DECIMALS = 1e6, 6
RESULT = ("mix_topic", "mix_tokens", "mix_probability")


def n_words(text: Column) -> Column:
    """Words of a text: runs of characters other than 0x20 and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def label_topics(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, topic) of every labelled id."""
    part = lambda name: F.concat(F.lit(f"{name} "), F.coalesce(F.max(name).cast("string"), F.lit("unknown")))
    return labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.concat_ws(", ", part("quality"), part("toxic")).alias("topic"))


def unit_number(key: Column, seed: str) -> Column:
    """A number in [0, 1) that the key and seed decide."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 8), 16, 10).cast("double") / 2**32


def _level_by_sort(values: DataFrame, budget: float) -> DataFrame:
    """``values`` with ``first``, the tokens that a weight of 1 gets, from one ordered window: for few values."""
    # Values that lack most come first. With those before a value at their bounds, the level is what a weight of 1 gets.
    before = Window.partitionBy().orderBy(F.when(F.col("w") > 0, F.col("m") / F.col("w")).asc_nulls_last(), F.col("_value")).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"{c}_before") for c in ("m", "w")]
    values = values.select("*", *sums).withColumn("rest", F.lit(1.0) - F.col("w_before"))
    level = (F.lit(budget) * F.col("all") - F.col("m_before")) / F.col("rest")
    values = values.withColumn("level", F.when((F.col("w") > 0) & (F.col("rest") > 0) & (level * F.col("w") <= F.col("m") * (1 + 1e-12)), level))
    return values.withColumn("first", F.first("level", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def _level_by_sums(values: DataFrame, budget: float) -> DataFrame:
    """The same for any number of values: the level rises from the budget as values reach their bounds, by sums alone, until none
    more does."""
    level = rest = None
    while True:
        full = F.lit(False) if level is None else F.col("m") < level * F.col("w")
        given, weight, every = values.where("w > 0").agg(F.sum(F.when(full, F.col("m")).otherwise(0.0)), F.sum(F.when(full, F.col("w")).otherwise(0.0)), F.max("all")).first()
        rest = 1.0 - (weight or 0.0)
        if every is None or rest <= 1e-12:  # no tokens, or every value at its bound
            return values.withColumn("first", F.lit(None).cast("double"))
        raised = (budget * every - given) / rest
        if level is not None and raised <= level * (1 + 1e-12):
            return values.withColumn("first", F.lit(level))
        level = raised


def _targets(cells: DataFrame, margin: str, budget: float, temperature: float, small: bool) -> DataFrame:
    """(value, target in tokens) of a margin: tempered shares of the budget, with no value over its mass."""
    values = cells.groupBy(F.col(margin).alias("_value")).agg(F.sum("mass").alias("m"))
    shares = lambda df, w, total: df.withColumn(w, F.when(F.col(total) > 0, F.col(w) / F.col(total)).otherwise(0.0))
    if small:
        every = Window.partitionBy()
        values = values.withColumn("all", F.sum("m").over(every)).withColumn("w", F.when(F.col("all") > 0, F.pow(F.col("m") / F.col("all"), temperature)).otherwise(0.0))
        values = _level_by_sort(shares(values.withColumn("sum_w", F.sum("w").over(every)), "w", "sum_w"), min(budget, 1.0))
    else:
        values = written(values)
        every = values.agg(F.sum("m")).first()[0]
        values = values.withColumn("all", F.lit(every)).withColumn("w", F.when(F.col("all") > 0, F.pow(F.col("m") / F.col("all"), temperature)).otherwise(0.0))
        values = values.withColumn("sum_w", F.lit(values.agg(F.sum("w")).first()[0]))
        values = _level_by_sums(shares(values, "w", "sum_w"), min(budget, 1.0))
    want = F.coalesce(F.least(F.col("m"), F.col("first") * F.col("w")), F.col("m")).cast("double")
    return values.select("_value", want.alias(f"want_{margin}"), (want >= F.col("m") * (1 - 1e-9)).alias(f"full_{margin}"))


def _scaled(now: DataFrame, m: str, kept: list[str], small: bool) -> DataFrame:
    """One step of raking: the cells that are not at their bounds are scaled to what the margin lacks."""
    fixed_part = F.when(F.col("z") >= F.col("mass"), F.col("mass")).otherwise(0.0)
    free_part = F.when(F.col("z") < F.col("mass"), F.col("z")).otherwise(0.0)
    if small:
        value = Window.partitionBy(m)
        now = now.withColumns({"_fixed": F.sum(fixed_part).over(value), "_free": F.sum(free_part).over(value)})
    else:  # a value's cells are summed where they are, and its two sums join them
        sums = now.groupBy(F.col(m).alias("_value")).agg(F.sum(fixed_part).alias("_fixed"), F.sum(free_part).alias("_free"))
        now = now.join(sums, now[m].eqNullSafe(sums["_value"])).drop("_value")
    want, fixed, free = F.col(f"want_{m}"), F.col("_fixed"), F.col("_free")
    factor = F.when((free > 0) & (want > fixed), (want - fixed) / free).when(fixed + free > 0, want / (fixed + free)).otherwise(1.0)
    return now.select(*kept, F.least(F.col("z") * factor, F.col("mass") * OVER).alias("z"))


def rake(cells: DataFrame, margins: tuple[str, ...], budget: float, temperature: float = 0.5) -> DataFrame:
    """``cells`` (margins..., mass) with want_{margin} and ``raked``: the tokens to take from each, never more than its mass."""
    small = cells.count() <= ONE_TASK_CELLS
    now = cells
    for m in margins:
        wants = _targets(cells, m, budget, temperature, small)
        now = now.join(wants, now[m].eqNullSafe(wants["_value"])).drop("_value")
    full = F.greatest(*[F.col(f"full_{m}") for m in margins])  # a value that gives all it has takes its cells to their bounds
    now = now.withColumn("z", F.col("mass") * F.when(full, OVER).otherwise(min(budget, 1.0))).drop(*[f"full_{m}" for m in margins])
    taken = F.least(F.col("z"), F.col("mass").cast("double"))
    kept = [c for c in now.columns if c != "z"]
    for _ in range(0, ROUNDS, PLAN_ROUNDS):
        now = now.coalesce(1) if small else now
        for k, m in enumerate(list(margins) * PLAN_ROUNDS):
            now = _scaled(now, m, kept, small)
            if not small and k % len(margins) == len(margins) - 1:  # a plan of one round: each step reads its input twice
                now = written(now)
        if small:
            now = written(now)
        misses = [now.groupBy(m).agg(F.abs(F.sum(taken) - F.max(f"want_{m}")).alias("miss")).agg(F.max("miss").alias("miss")) for m in margins]
        most = misses[0]
        for x in misses[1:]:
            most = most.unionByName(x)
        worst = most.agg(F.max("miss")).first()[0], now.agg(F.sum("mass")).first()[0]
        if not worst[1] or worst[0] <= TOLERANCE * budget * worst[1]:
            break
    return now.select(*margins, "mass", *[f"want_{m}" for m in margins], taken.alias("raked"))


def margins_of(raked: DataFrame, margins: tuple[str, ...]) -> DataFrame:
    """(margin, value, mass, target, raked) of every value of every margin: what raking reached."""
    parts = [raked.groupBy(F.col(m).cast("string").alias("value")).agg(F.sum("mass").alias("mass"), F.max(f"want_{m}").alias("target"), F.sum("raked").alias("raked")).select(F.lit(m).alias("margin"), "value", "mass", "target", "raked") for m in margins]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mix(docs: DataFrame, budget: float, topics: DataFrame | None = None, temperature: float = 0.5, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The sampled rows of ``docs`` with mix_topic, mix_tokens and mix_probability.

    ``budget`` is the wanted share of all tokens; ``topics`` has the id and topic of some documents, once each.
    """
    docs = docs.drop(*RESULT)
    own = lambda name: f"{'_' * (1 + max(len(c) - len(c.lstrip('_')) for c in [*docs.columns, '']))}{name}"  # noqa: E731 - a name that docs doesn't have
    source, lang, topic, chance, key = map(own, ("source", "lang", "topic", "chance", "key"))
    marked = docs.withColumn("mix_tokens", n_words(F.col(text_col)))  # before the join, which then needs no texts
    if topics is not None:
        named = topics.select(F.col(id_col).alias(key), F.col("topic").alias(topic)).hint("merge")
        marked = marked.join(named, marked[id_col] == named[key], "left").drop(key)
    marked = marked.withColumn("mix_topic", F.coalesce(F.col(topic), F.lit("unlabelled")) if topics is not None else F.lit("unlabelled")).drop(topic)
    margins = ("source", "lang", "topic")
    keys = marked.select(F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"))
    raked = rake(written(keys.groupBy(*margins).agg(F.sum("tokens").alias("mass"))), margins, budget, temperature)
    p = F.when(F.col("mass") > 0, F.least(F.lit(1.0), F.round(F.col("raked") / F.col("mass"), DECIMALS))).otherwise(1.0)
    cells = written(raked.select(F.col("source").alias(source), F.col("lang").alias(lang), F.col("topic").alias(topic), p.alias(chance)))
    same = marked[source_col].eqNullSafe(cells[source]) & marked[lang_col].eqNullSafe(cells[lang]) & marked["mix_topic"].eqNullSafe(cells[topic])
    joined = marked.join(F.broadcast(cells) if cells.count() <= ONE_TASK_CELLS else cells, same)
    return joined.where(unit_number(F.col(id_col), seed) < F.col(chance)).select(*docs.columns, "mix_topic", "mix_tokens", F.col(chance).alias("mix_probability"))
