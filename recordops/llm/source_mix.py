"""Mixing sources to target weights by Pareto order sampling.

Sources in the order of their code points (null last) have the given weights in turn and
share `share` percent of all words. A target stops at `most` times its source's words;
what is above goes to the others by weight until none is above (closed form: sources in
the order of cap / weight, running sums).

A document's expected number of copies is its source's target over the source's words,
or in proportion to a positive weight column, at most `most`. Its whole part is certain.
The rest is its inclusion probability p of one more copy: documents are ranked by random
odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the first of the order are
taken until their words make up what the certain copies leave of the target, the cut
being the nearest one. The sample so has a fixed size in words, and its inclusion
probabilities are those asked for up to the small error of Pareto's order. u comes from
a digest of seed, id and text, so reruns agree; rows of the same id and text are taken
one by one, each of them like any other row.

Running sums go over ranges of the order, each summed by itself, with the sums of earlier
ranges added: a source with a third of all rows lies in many ranges. Null and empty texts
have size 0 and are never taken; null ids are allowed; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm.base import settle

DIGITS = 13  # hexadecimal digits of a digest that make a random number
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    """Number of words between blanks, counted as their first characters."""
    padded = F.concat(F.lit(" "), F.coalesce(text, F.lit("")))
    return F.regexp_count(padded, F.lit(r"[\x20\x09-\x0D][^\x20\x09-\x0D]")).cast("long")


def random_odds(seed: str, *columns: Column) -> Column:
    """u / (1 - u) for a number u strictly between 0 and 1 that the columns fix."""
    parts = [F.coalesce(c.cast("string"), F.lit("-")) for c in columns]
    digest = F.md5(F.concat_ws("\n", F.lit(seed), *parts))
    u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    return u / (1 - u)


def running(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Sums (of SQL expressions) up to and with each row in the order within its keys, beside the row's own columns.

    `rows` come from a stored table, so that their numbers, which settle ties, stay what they are.
    """
    order = [*order, F.asc("_tie")]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*[F.asc_nulls_last(k) for k in keys], *order)
    ranged = settle(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = ranged.withColumns({name: F.sum(F.expr(value)).over(within) for name, value in sums.items()})
    # One row for each range and key in it.
    parts = ranged.groupBy("_range", *keys).agg(*[F.sum(F.expr(v)).alias(n) for n, v in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    before = parts.select(
        F.col("_range").alias("_at"),
        *[F.col(k).alias(n) for k, n in names.items()],
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    match = own["_range"] == before["_at"]
    for k, n in names.items():
        match &= own[k].eqNullSafe(before[n])
    totals = {n: F.col(n) + F.col(f"_before_{n}") for n in sums}
    return own.join(before, match).withColumns(totals).select(*rows.columns, *sums)


def source_targets(rows: DataFrame, weights: tuple[int, ...], share: int, most: int) -> DataFrame:
    """For each source its words and its target: source, source_size, target."""
    sources = settle(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    turns = F.array(*[F.lit(int(w)) for w in weights])
    numbered = running(sources, [], [F.asc_nulls_last("source")], {"position": "1"})
    numbered = numbered.withColumn("weight", F.element_at(turns, (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int")))
    numbered = numbered.withColumn("cap", F.lit(most) * F.col("source_size"))
    numbered = settle(numbered.withColumn("ratio", F.col("cap") / F.col("weight")), "sources")
    whole = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    budget = whole["size"] * share / 100
    filled = running(numbered, [], [F.asc("ratio"), F.asc("position")], {"caps": "cap", "weights": "weight"})
    left = F.lit(budget) - (F.col("caps") - F.col("cap"))
    rate = left / (F.lit(whole["weight"]) - (F.col("weights") - F.col("weight")))
    filled = filled.withColumn("rate", rate).withColumn("full", F.col("rate") * F.col("weight") > F.col("cap"))
    free = filled.filter("not full").agg(F.min_by("rate", F.struct("ratio", "position")).alias("rate")).first()["rate"]
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.lit(free) * F.col("weight"))
    return settle(filled.select("source", "source_size", target.alias("target")), "targets")


def with_targets(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Goals hold one row for each source."""
    named = goals.withColumnRenamed("source", "_source")
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")


def weighted_rates(rows: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """Copies for each unit of a document's weight, so that expected copies, `most` at the most, add up to the targets.

    Rows that reach `most` are set aside and the rate is worked out again for the others,
    until no further row reaches it; each round is one aggregate.
    """
    goals, reached = goals.withColumn("rate", F.lit(0.0)), -1
    while True:
        full = F.col("rate") * F.col("value") >= most
        sums = with_targets(rows, goals).groupBy("source").agg(
            F.sum(F.when(full, F.col("size")).otherwise(0)).alias("aside"),
            F.sum(F.when(full, 0.0).otherwise(F.col("value") * F.col("size"))).alias("open"),
            F.count_if(full & (F.col("size") > 0)).alias("n"),
        )
        sums = with_targets(sums, goals.drop("rate"))
        rate = F.when(F.col("open") > 0, (F.col("target") - most * F.col("aside")) / F.col("open")).otherwise(F.lit(float(most)))
        after = settle(sums.select("source", "source_size", "target", rate.alias("rate"), "n"), "rates")
        now = after.agg(F.sum("n").alias("n")).first()["n"]
        goals = after.drop("n")
        if now is None or now == reached:
            return goals
        reached = now


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: int = 150,
    most: int = 2,
    value: Column | None = None,
    seed: str = "mix",
    carry: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """For each row doc_id, source, size, source_size, target, expected copies, copies and taken words.

    `value` (positive) makes expected copies unequal within a source. With `carry` the
    whole row comes along as `row`; `repeated` then writes out the mix.
    """
    text = F.col(text_column)
    columns = [
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        n_words(text).alias("size"),
        random_odds(seed, F.col(id_column), text).alias("odds"),
        (F.lit(1.0) if value is None else value.cast("double")).alias("value"),
    ]
    rows = settle(docs.select(*columns, *([F.struct("*").alias("row")] if carry else [])), "sizes")
    goals = source_targets(rows.select("source", "size"), weights, share, most)
    if value is None:
        expected = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    else:
        goals = weighted_rates(rows.select("source", "size", "value"), goals, most)
        expected = F.least(F.lit(float(most)), F.col("rate") * F.col("value"))
    planned = with_targets(rows, goals).withColumn("expected", expected)
    planned = planned.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    planned = planned.withColumn("order", F.when((F.col("p") > 0) & (F.col("size") > 0), F.col("odds") * (1 - F.col("p")) / F.col("p")))
    certain = settle(planned.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain")), "certain")
    ordered = running(planned.drop("odds", "value", "rate", "p"), ["source"], [F.asc_nulls_last("order"), F.asc_nulls_last("doc_id")], {"run": "size"})
    ordered = with_targets(ordered, certain)
    nearest = F.col("order").isNotNull() & (2 * F.col("run") - F.col("size") <= 2 * (F.col("target") - F.col("certain")))
    copies = F.col("whole") + nearest.cast("long")
    out = ordered.select("doc_id", "source", "size", "source_size", "target", "expected", copies.alias("copies"), *(["row"] if carry else []))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of a mix (made with `carry`), each as often as the mix takes it."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
