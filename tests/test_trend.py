"""Local regression against a plain version, its grid, and series that are long."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordops.operators import trend


def plain_fit(xs, ys, at, span):
    """Value and slope of the weighted parabola at one place."""
    near = max(int(np.floor(len(xs) * span + 1e-5)), 1)
    h = np.sort(np.abs(xs - at))[near - 1]
    if not h:
        return None, None
    d = (xs - at) / h
    w = np.where(np.abs(d) < 1, (1 - np.minimum(np.abs(d), 1) ** 3) ** 3, 0)
    design = np.vander(d, 3, increasing=True)
    normal = design.T @ (design * w[:, None])
    if abs(np.linalg.det(normal)) <= 1e-12:
        return None, None
    fit = np.linalg.solve(normal, design.T @ (w * ys))
    return fit[0], fit[1] / h


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, j int, x double, y double, _n long").repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    rows = [("uneven", None, rng.uniform(0, 9) ** 3, rng.gauss(0, 5), 1) for _ in range(300)]
    rows += [(None, 1, float(i), i * i / 7 - 3 * i, 1) for i in range(60)]
    rows += [("ties", 2, float(rng.randint(0, 40)), rng.random(), 1) for _ in range(400)]
    rows += [("single", 1, 4.0, 2.0, 1), ("equal", 1, 3.0, 1.0, 1), ("equal", 1, 3.0, 2.0, 1)]
    return rows + [("uneven", None, None, 1.0, 1), ("uneven", None, 2.0, None, 1)]


@pytest.mark.parametrize("span", [0.35, 0.08, 1.0])
@pytest.mark.parametrize("block", [256, 7])
def test_fits_equal_a_plain_version(spark, rows, span, block, monkeypatch):
    monkeypatch.setattr(trend, "BLOCK", block)
    out = trend.local_regression(table(spark, rows), ["k", "j"], "x", "y", span)
    assert out.columns == ["k", "j", "x", "y", "_n", "trend"]
    got = out.collect()
    known = [r for r in rows if r[2] is not None and r[3] is not None]
    assert len(got) == len(known)
    for k, j in {r[:2] for r in known}:
        xs = np.array([r[2] for r in known if r[:2] == (k, j)])
        ys = np.array([r[3] for r in known if r[:2] == (k, j)])
        for r in got:
            if (r["k"], r["j"]) == (k, j):
                want = plain_fit(xs, ys, r["x"], span)[0]
                assert r["trend"] == (want if want is None else pytest.approx(want, rel=1e-5, abs=1e-5))


def test_grid_follows_the_fits(spark, rows):
    got = trend.regression_grid(table(spark, rows), ["k", "j"], "x", "y", 0.35, points=33).collect()
    for k, j in (("uneven", None), (None, 1), ("ties", 2)):
        mine = sorted((r["place"], r["x"], r["trend"]) for r in got if (r["k"], r["j"]) == (k, j))
        xs = np.array([r[2] for r in rows if r[:2] == (k, j) and None not in r[2:4]])
        ys = np.array([r[3] for r in rows if r[:2] == (k, j) and None not in r[2:4]])
        assert [p for p, *_ in mine] == list(range(33))
        assert np.allclose([x for _, x, _ in mine], np.linspace(xs.min(), xs.max(), 33))
        order = np.argsort(xs, kind="stable")
        near = int(np.floor(len(xs) * 0.35 + 1e-5))
        numbers = sorted({*range(0, len(xs), max(int(near * 0.2), 1)), len(xs) - 1})
        vertices = sorted({xs[order[i]] for i in numbers})
        fits = [plain_fit(xs, ys, v, 0.35) for v in vertices]
        for _, x, value in mine:
            i = min(max(int(np.searchsorted(vertices, x, side="right")) - 1, 0), len(vertices) - 2)
            gap, u = vertices[i + 1] - vertices[i], (x - vertices[i]) / (vertices[i + 1] - vertices[i])
            (f, s), (g, t) = fits[i], fits[i + 1]
            want = f * (1 + 2 * u) * (1 - u) ** 2 + s * gap * u * (1 - u) ** 2 + g * u * u * (3 - 2 * u) + t * gap * u * u * (u - 1)
            assert value == pytest.approx(want, rel=1e-4, abs=1e-4)
    # A parabola is its own trend, also between the vertices.
    for r in got:
        if r["k"] is None:
            assert r["trend"] == pytest.approx(r["x"] ** 2 / 7 - 3 * r["x"], abs=1e-6)


def test_no_rows(spark, rows):
    empty = table(spark, rows).limit(0)
    assert trend.local_regression(empty, ["k"], "x", "y").count() == 0
    assert trend.regression_grid(empty, ["k"], "x", "y").count() == 0


def test_a_long_series_is_never_one_value(spark):
    """100,000 points: the plan collects nothing, and a grid over all of them is made."""
    long = spark.range(100_000).select(
        F.lit("s").alias("k"), (F.col("id") / 50).alias("x"), F.sin(F.col("id") / 9000).alias("y")
    )
    grid = trend.regression_grid(long, ["k"], "x", "y", 0.1, points=80)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    out = grid.collect()
    assert len(out) == 80
    assert max(abs(r["trend"] - np.sin(r["x"] * 50 / 9000)) for r in out) < 0.02
