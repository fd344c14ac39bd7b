"""Local regression at the points of a series, or on an even grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordops.operators.columns import computed_once, same_keys

#: Numbers in a block of points; a fitted point meets its neighbours block by block.
BLOCK = 256
MOMENTS = ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")


def _numbered(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """The complete points of each series with their number in the order of x, and how many there are.

    Windows of running values over sorted rows, so a series is never held in one value.
    """
    ordered = Window.partitionBy(*series).orderBy("_x", "_y")
    points = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *series, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    points = points.withColumn("_number", F.row_number().over(ordered))
    return points.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*series)))


def _on(left: DataFrame, right: DataFrame, series: list[str], number: str, other: str) -> Column:
    """Same series and same number; the series of the right are named `_other_0`, `_other_1`, .."""
    pairs = [(s, f"_other_{i}") for i, s in enumerate(series)]
    return same_keys(left, right, pairs) & (F.col(number) == F.col(other))


def _others(df: DataFrame, series: list[str], **columns: Column) -> DataFrame:
    names = [F.col(s).alias(f"_other_{i}") for i, s in enumerate(series)]
    return df.select(*names, *[c.alias(n) for n, c in columns.items()])


def _runs(points: DataFrame, series: list[str]) -> DataFrame:
    """Points with the first number (`_first`) of the run of their `_near` nearest and the distance `_h` of the farthest.

    The nearest points of x lie in one run of numbers. A run may begin one
    further to the right as long as the point it would gain is nearer than the
    one it would lose: x(a) + x(a + near) < 2 x. These sums rise with a, so the
    first number is one more than the count of sums below 2 x, which a running
    count over the sums and the points, sorted together, gives for all of them.
    """
    later = _others(points, series, _gained=F.col("_x"), _at=F.col("_number") - F.col("_near"))
    later = later.filter("_at >= 1")
    sums = points.select(*series, "_x", "_number").join(
        later, _on(points, later, series, "_number", "_at")
    )
    blank = [F.lit(None).cast(t).alias(c) for c, t in points.dtypes if c not in series]
    sums = sums.select(*series, *blank, (F.col("_x") + F.col("_gained")).alias("_value"))
    both = points.withColumn("_value", 2 * F.col("_x")).unionByName(sums)
    ordered = Window.partitionBy(*series).orderBy(
        "_value", F.col("_number").isNull(), "_number"
    )
    ordered = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = F.count_if(F.col("_number").isNull()).over(ordered)
    points = both.withColumn("_first", passed + 1).filter("_number IS NOT NULL").drop("_value")
    low = _others(points, series, _low=F.col("_x"), _at=F.col("_number"))
    high = _others(points, series, _high=F.col("_x"), _at=F.col("_number"))
    points = points.withColumn("_last", F.col("_first") + F.col("_near") - 1)
    points = points.join(low, _on(points, low, series, "_first", "_at")).drop(*_names(series), "_at")
    points = points.join(high, _on(points, high, series, "_last", "_at")).drop(*_names(series), "_at")
    farthest = F.greatest(F.col("_x") - F.col("_low"), F.col("_high") - F.col("_x"))
    return points.withColumn("_h", farthest).drop("_low", "_high")


def _names(series: list[str]) -> list[str]:
    return [f"_other_{i}" for i in range(len(series))]


def _fitted(points: DataFrame, chosen: DataFrame, series: list[str]) -> DataFrame:
    """Value (`_fit`) and slope (`_slope`) of the weighted parabola at the chosen points.

    Each chosen point goes to the blocks of numbers that its run touches and
    meets the points of such a block by equality; the eight sums are combined
    in the map tasks, so the memory of a task does not depend on the run.
    """
    block = lambda c: F.floor((F.col(c) - 1) / BLOCK)
    neighbours = _others(
        points, series, _px=F.col("_x"), _py=F.col("_y"), _place=F.col("_number"), _at=block("_number")
    )
    spread = chosen.withColumn("_block", F.explode(F.sequence(block("_first"), block("_last"))))
    pairs = spread.join(neighbours, _on(spread, neighbours, series, "_block", "_at"))
    pairs = pairs.filter(F.col("_place").between(F.col("_first"), F.col("_last")))
    d = (F.col("_px") - F.col("_x")) / F.nullif(F.col("_h"), F.lit(0.0))
    pairs = pairs.select(*series, "_number", "_x", "_y", "_h", "_py", d.alias("_d"))
    d = F.col("_d")
    closeness = F.lit(1.0) - F.abs(d) * F.abs(d) * F.abs(d)
    w = F.when(F.abs(d) < 1, closeness * closeness * closeness).otherwise(F.lit(0.0))
    pairs = pairs.withColumn("_w", w)
    w, v = F.col("_w"), F.col("_py")
    terms = [w, w * d, w * d * d, w * d * d * d, w * d * d * d * d, w * v, w * d * v, w * d * d * v]
    sums = pairs.groupBy(*series, "_number", "_x", "_y", "_h").agg(
        *[F.coalesce(F.sum(t), F.lit(0.0)).alias(m) for m, t in zip(MOMENTS, terms)]
    )
    m = {k: F.col(k) for k in MOMENTS}
    # With x measured from the point itself, value and slope are the constant and
    # the linear term of the weighted normal equations, by Cramer's rule.
    a, b, c = m["s2"] * m["s4"] - m["s3"] * m["s3"], m["s1"] * m["s4"] - m["s2"] * m["s3"], m["s1"] * m["s3"] - m["s2"] * m["s2"]
    whole = m["s0"] * a - m["s1"] * b + m["s2"] * c
    value = (
        m["t0"] * a
        - m["s1"] * (m["t1"] * m["s4"] - m["s3"] * m["t2"])
        + m["s2"] * (m["t1"] * m["s3"] - m["s2"] * m["t2"])
    )
    slope = (
        m["s0"] * (m["t1"] * m["s4"] - m["s3"] * m["t2"])
        - m["t0"] * b
        + m["s2"] * (m["s1"] * m["t2"] - m["t1"] * m["s2"])
    )
    solved = lambda part: F.when(F.abs(whole) > 1e-12, part / F.nullif(whole, F.lit(0.0)))
    sums = computed_once(sums, _fit=solved(value), _slope=solved(slope) / F.nullif(F.col("_h"), F.lit(0.0)))
    return sums.drop(*MOMENTS)


def _prepared(df: DataFrame, series: list[str], x: str, y: str, span: float) -> DataFrame:
    points = _numbered(df, series, x, y)
    near = F.greatest(F.floor(F.col("_n") * F.lit(span) + F.lit(1e-5)).cast("int"), F.lit(1))
    return points.withColumn("_near", F.least(near, F.col("_n").cast("int")))


def local_regression(
    df: DataFrame,
    series: list[str],
    x: str,
    y: str,
    span: float = 0.35,
    name: str = "trend",
) -> DataFrame:
    """Locally fitted parabola at every point of a series.

    The nearest `span` part of the points is weighted by (1 - (d/h)^3)^3, with h
    the distance to the farthest of them. Rows without x or y are left out. The
    work is the number of points times that of their neighbours, in bounded
    memory for a series of any length.
    """
    points = _prepared(df, series, x, y, span)
    fitted = _fitted(points, _runs(points, series), series)
    # Points that agree in series, x and y have the same fit.
    fitted = _others(
        fitted.groupBy(*series, "_x").agg(F.max("_fit").alias(name)),
        series, _at_x=F.col("_x"), **{name: F.col(name)},
    )
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    rows = rows.withColumn("_x", F.col(x).cast("double"))
    out = rows.join(fitted, _on(rows, fitted, series, "_x", "_at_x"))
    return out.select(*df.columns, name)


def regression_grid(
    df: DataFrame,
    series: list[str],
    x: str,
    y: str,
    span: float = 0.35,
    points: int = 80,
    cell: float = 0.2,
    name: str = "trend",
) -> DataFrame:
    """The local trend on an even grid from the first to the last x of a series: series, `place`, x, trend.

    Parabolas are fitted at vertices only: every m-th point and the last one, m
    the `cell` part of a neighbourhood. Between two vertices runs the cubic that
    has their values and slopes, as in the drawn curve. The work grows with the
    points times a constant number of vertices.
    """
    known = _prepared(df, series, x, y, span)
    step = F.greatest(F.floor(F.col("_near") * F.lit(cell)), F.lit(1))
    at_vertex = ((F.col("_number") - 1) % step == 0) | (F.col("_number") == F.col("_n"))
    vertices = _fitted(known, _runs(known, series).filter(at_vertex), series)
    vertices = vertices.groupBy(*series, "_x").agg(
        F.max("_fit").alias("_fit"), F.max("_slope").alias("_slope")
    )
    ordered = Window.partitionBy(*series).orderBy("_x")  # a bounded number of vertices
    whole = Window.partitionBy(*series)
    names = ("_x", "_fit", "_slope")
    pieces = vertices.withColumns(
        {f"_next{c}": F.lead(c).over(ordered) for c in names}
        | {"_from": F.min("_x").over(whole), "_to": F.max("_x").over(whole)}
    )
    width = (F.col("_to") - F.col("_from")) / F.lit(points - 1)
    # Each grid point belongs to the piece it lies in, the last one to the last piece.
    place = lambda at: F.ceil((at - F.col("_from")) / F.nullif(width, F.lit(0.0)) - F.lit(1e-9))
    first = F.coalesce(place(F.col("_x")), F.lit(0))
    after = F.when(F.col("_next_x") < F.col("_to"), place(F.col("_next_x"))).otherwise(F.lit(points))
    last = F.coalesce(after, F.lit(points)) - 1
    pieces = pieces.filter(F.col("_next_x").isNotNull() | (F.col("_from") == F.col("_to")))
    pieces = pieces.withColumn("_places", F.when(first <= last, F.sequence(first, last)))
    grid = pieces.withColumn("place", F.explode("_places"))
    grid = computed_once(grid, _gx=F.col("_from") + F.col("place") * width)
    gap = F.col("_next_x") - F.col("_x")
    grid = computed_once(grid, _u=(F.col("_gx") - F.col("_x")) / F.nullif(gap, F.lit(0.0)))
    u = F.col("_u")
    cubic = (
        F.col("_fit") * (1 + 2 * u) * (1 - u) * (1 - u)
        + F.col("_slope") * gap * u * (1 - u) * (1 - u)
        + F.col("_next_fit") * u * u * (3 - 2 * u)
        + F.col("_next_slope") * gap * u * u * (u - 1)
    )
    trend = F.when(F.col("_next_x").isNull(), F.col("_fit")).otherwise(cubic)
    return grid.select(*series, "place", F.col("_gx").alias(x), trend.alias(name))
