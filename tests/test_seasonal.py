"""Forecasts with weekdays against a plain loop, and against the straight line."""

from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidex.operators import kpi
from evidex.operators import seasonal as S
from evidex.plans import inputs as I

SERIES = "kpi_id string, ts date, value double"
START = date(2023, 12, 27)


def plain(points, horizon):
    """One series as (day, value) pairs: a loop per pair of the grid."""
    points = sorted(points)
    zero = date(2000, 1, 1)
    first = [p for p in points if (p[0] - points[0][0]).days < 7]
    rest = points[len(first) :]
    if len(points) < 14 or not rest:
        return []
    best = None
    for alpha, gamma, weekly in S.GRID:
        level = sum(v for _, v in first) / len(first)
        effect = [0.0] * 7
        for d, v in first:
            if weekly:
                effect[(d - zero).days % 7] = v - level
        squares = 0.0
        for d, v in rest:
            e = v - (level + effect[(d - zero).days % 7])
            squares, level = squares + e * e, level + alpha * e
            effect[(d - zero).days % 7] += gamma * e
        if best is None or squares < best[0]:
            best = (squares, level, effect, alpha, gamma)
    squares, level, effect, alpha, gamma = best
    out, variance, z = [], 1.0, NormalDist().inv_cdf(0.975)
    for h in range(1, horizon + 1):
        day = points[-1][0] + timedelta(days=h)
        mean, half = level + effect[(day - zero).days % 7], z * (squares / len(rest) * variance) ** 0.5
        out.append((day, mean, mean - half, mean + half))
        variance += (alpha + (gamma if h % 7 == 0 else 0)) ** 2
    return out


def some_series():
    rng = np.random.default_rng(8)
    days = [START + timedelta(days=int(i)) for i in range(60)]
    out = {"noise": [(d, float(v)) for d, v in zip(days, rng.poisson(20, 60))]}
    out["weekly"] = [(d, 100.0 + 40 * (d.weekday() >= 5) + float(rng.normal())) for d in days]
    out["gaps"] = [p for i, p in enumerate(out["weekly"]) if i % 5 and not 10 < i < 22]
    out["flat"] = [(d, 3.0) for d in days[:14]]
    out["short"] = out["noise"][:13]
    out["early"] = [(date(1995, 3, 1) + timedelta(days=i), float(i % 7)) for i in range(30)]
    return out


def rows_of(series):
    return [(k, d, v) for k, points in series.items() for d, v in points]


def test_equals_a_plain_loop(spark):
    series = some_series()
    odd = [("noise", START, None), ("noise", None, 5.0), ("weekly", START + timedelta(days=70), float("nan")), (None, START, 1.0)]
    df = spark.createDataFrame(rows_of(series) + odd, SERIES).repartition(5)
    found = {}
    for r in S.seasonal_forecast(df, 10).collect():
        found.setdefault(r.kpi_id, []).append((r.ts, r.predicted, r.lower, r.upper))
    assert set(found) == set(series) - {"short"}
    for name, rows in found.items():
        wanted = plain(series[name], 10)
        assert [r[0] for r in sorted(rows)] == [w[0] for w in wanted]
        assert np.allclose([r[1:] for r in sorted(rows)], [w[1:] for w in wanted], rtol=1e-9, atol=1e-9)


def test_backtests_refit_on_what_was_known(spark):
    series = {"weekly": some_series()["weekly"]}
    df = spark.createDataFrame(rows_of(series), SERIES)
    rows = S.seasonal_backtest(df, 3, 5).collect()
    values = dict(series["weekly"])
    assert len(rows) == 15 and all(r.backtest and r.actual == values.get(r.ts) for r in rows)
    for split in {r.split_ts for r in rows}:
        wanted = plain([p for p in series["weekly"] if p[0] <= split], 5)
        mine = sorted((r.ts, r.predicted, r.lower, r.upper) for r in rows if r.split_ts == split)
        assert np.allclose([m[1:] for m in mine], [w[1:] for w in wanted])


def test_weekdays_beat_the_line(spark):
    df = spark.createDataFrame(rows_of({"weekly": some_series()["weekly"]}), SERIES)
    errors = {}
    for name, made in (("line", kpi.forecast_backtest(df, 14)), ("seasonal", S.seasonal_backtest(df, 14))):
        errors[name] = S.backtest_errors(made).first()
    assert errors["seasonal"].mae < 0.25 * errors["line"].mae and errors["seasonal"].coverage > 0.8


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_events_are_forecast_better_than_by_the_line(spark, sf):
    series = I.kpi_series(spark, f"/root/testdata/{sf}").filter(F.col("kpi_id").startswith("events:"))
    mean = [S.backtest_errors(made).agg(F.sum(F.col("mae") * F.col("n")) / F.sum("n")).first()[0] for made in (kpi.forecast_backtest(series, 14), S.seasonal_backtest(series, 14))]
    assert mean[1] < mean[0]


def test_no_series_no_forecast(spark):
    empty = spark.createDataFrame([], SERIES)
    assert S.seasonal_forecast(empty).count() == 0 and S.seasonal_backtest(empty).count() == 0
