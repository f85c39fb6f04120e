"""Forecasts that know weekdays: exponential smoothing of a level and of seven weekday effects per KPI.

    e = value - (level + effect[weekday]);  level += alpha * e;  effect[weekday] += gamma * e

Every pair of a small fixed grid runs over the whole series, with and without weekdays, and the pair with the smallest
sum of squared one-step errors is taken. A KPI's series has one row per day, so that a group is as long as its days.
"""

from __future__ import annotations

from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import stable_id
from evidex.operators.kpi import BACKTEST_SPLITS, HORIZON_DAYS, LEVEL, training_points

# Fixed values (the grid the results depend on; equal errors go to the first pair).
ALPHAS = (0.02, 0.05, 0.1, 0.2, 0.4)
GAMMAS = (0.05, 0.1, 0.2, 0.4)
GRID = [(a, 0.0, False) for a in ALPHAS] + [(a, g, True) for a in ALPHAS for g in GAMMAS]
WEEK = 7
MIN_SEASON_POINTS = 14
DAY_ZERO = np.datetime64("2000-01-01", "D")

_ROWS = "last_ts date, ts date, predicted double, lower double, upper double, alpha double, gamma double"


def smooth(days: np.ndarray, values: np.ndarray) -> tuple[int, float, np.ndarray, float, int] | None:
    """(number in the grid, level, effects by weekday, sum of squared errors, errors) of the best pair for one series.

    `days` are day numbers in ascending order; a weekday is their rest by seven. The days of the first week give the first
    level and effects. Days without a value change nothing. None without `MIN_SEASON_POINTS` values or one after that week.
    """
    first = days < days[0] + WEEK if days.size else np.empty(0, bool)
    if days.size < MIN_SEASON_POINTS or first.all():
        return None
    alpha, gamma, weekly = (np.array(x) for x in zip(*GRID))
    level = np.full(len(GRID), values[first].sum() / first.sum())
    effect = np.zeros((len(GRID), WEEK))
    for day, value in zip(days[first], values[first]):
        effect[weekly, day % WEEK] = value - level[0]
    squares = np.zeros(len(GRID))
    for day, value in zip(days[~first], values[~first]):
        error = value - (level + effect[:, day % WEEK])
        squares += error * error
        level = level + alpha * error
        effect[:, day % WEEK] += gamma * error
    best = int(np.argmin(squares))
    return best, float(level[best]), effect[best], float(squares[best]), int((~first).sum())


def _ahead(horizon: int, level: float) -> Callable[[tuple, pa.Table], pa.Table]:
    z = NormalDist().inv_cdf(0.5 + level / 2)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.lexsort((np.asarray(table["value"]), np.asarray(table["ts"])))
        dates, values = np.asarray(table["ts"])[order].astype("datetime64[D]"), np.asarray(table["value"])[order]
        days = (dates - DAY_ZERO).astype(np.int64)
        made = smooth(days, values)
        names = [*key_names(len(key)), "last_ts", "ts", "predicted", "lower", "upper", "alpha", "gamma"]
        if made is None:
            empty = [pa.array([], type=k.type) for k in key] + [pa.array([], type=pa.date32())] * 2 + [pa.array([], type=pa.float64())] * 5
            return pa.table(dict(zip(names, empty)))
        best, mean, effect, squares, n = made
        alpha, gamma, _ = GRID[best]
        ahead = np.arange(1, horizon + 1)
        predicted = mean + effect[(days[-1] + ahead) % WEEK]
        # What an error of a day ahead adds to the days after it.
        weight = (alpha + gamma * (ahead[:-1] % WEEK == 0)) ** 2
        half = z * np.sqrt(squares / n * (1.0 + np.concatenate([[0.0], np.cumsum(weight)])))
        columns = [pa.array([k.as_py()] * horizon, type=k.type) for k in key]
        columns += [pa.array(np.repeat(dates[-1], horizon)), pa.array(dates[-1] + ahead)]
        columns += [pa.array(x) for x in (predicted, predicted - half, predicted + half, np.full(horizon, alpha), np.full(horizon, gamma))]
        return pa.table(dict(zip(names, columns)))

    return run


def key_names(n: int) -> list[str]:
    return ["kpi_id", "split_ts"][:n]


def _usable(series: DataFrame) -> DataFrame:
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    return series.filter(F.col("ts").isNotNull() & finite).select("kpi_id", F.col("ts").cast("date").alias("ts"), F.col("value").cast("double").alias("value"))


def seasonal_forecast(series: DataFrame, horizon: int = HORIZON_DAYS, level: float = LEVEL) -> DataFrame:
    """(run_id, kpi_id, ts, predicted, lower, upper, backtest) for the `horizon` days after each KPI's last day.

    KPIs with fewer than 14 values, or none after their first week, get no forecast; null and non-finite values and rows
    without a day take no part.
    """
    rows = _usable(series).groupBy("kpi_id").applyInArrow(_ahead(horizon, level), f"kpi_id string, {_ROWS}")
    run = stable_id("kpi_id", F.lit("|"), "last_ts", F.lit("|seasonal"))
    return rows.select(run.alias("run_id"), "kpi_id", "ts", "predicted", "lower", "upper", F.lit(False).alias("backtest"))


def seasonal_backtest(series: DataFrame, splits: int = BACKTEST_SPLITS, horizon: int = HORIZON_DAYS, level: float = LEVEL) -> DataFrame:
    """Refit on the data up to each of the last `splits` days of a KPI; adds split_ts and the actual, if known."""
    points = _usable(series)
    rows = training_points(points, splits).groupBy("kpi_id", "split_ts").applyInArrow(_ahead(horizon, level), f"kpi_id string, split_ts date, {_ROWS}")
    run = stable_id("kpi_id", F.lit("|"), "split_ts", F.lit("|seasonal|backtest"))
    return rows.join(points.withColumnRenamed("value", "actual"), ["kpi_id", "ts"], "left").select(
        run.alias("run_id"), "kpi_id", "split_ts", "ts", "predicted", "lower", "upper", F.lit(True).alias("backtest"), "actual",
    )


def backtest_errors(backtests: DataFrame, *by: str) -> DataFrame:
    """Per KPI (and `by`): compared days, mean absolute error, and the share of days inside the interval."""
    inside = (F.col("actual") >= F.col("lower")) & (F.col("actual") <= F.col("upper"))
    return backtests.filter("actual is not null").groupBy(*by, "kpi_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"), F.avg(inside.cast("double")).alias("coverage")
    )


__all__ = ["backtest_errors", "seasonal_backtest", "seasonal_forecast", "smooth"]
