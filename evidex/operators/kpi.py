"""KPI series, trend forecasts with intervals, backtests and their reports. All KPIs go through at once."""

from __future__ import annotations

from datetime import date
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import as_column, stable_id
from evidex.operators.groups import topk_per_group

# Fixed values (defaults the results depend on).
HORIZON_DAYS = 30
BACKTEST_SPLITS = 3
MIN_POINTS = 3
SERIES_DAYS = 180
CARD_ROWS = 100
PREVIEW_ROWS = 48
LEVEL = 0.95
DAY_ZERO = "2000-01-01"


def kpi_daily_counts(df: DataFrame, ts: str, kpi_id: Column | str, as_of: Column | date | None = None, days: int | None = SERIES_DAYS) -> DataFrame:
    """(kpi_id, ts, value, tags): rows per day from `days` days before `as_of` on; the whole series without `days`.

    The first day is compared with the plain column, so that the filter reaches the files' statistics.
    """
    kpi = F.lit(kpi_id) if isinstance(kpi_id, str) else kpi_id
    if days is not None:
        last = as_of if isinstance(as_of, Column) else F.lit(as_of)
        df = df.filter(F.col(ts) >= F.date_sub(last, days).cast(df.schema[ts].dataType))
    day = F.to_date(F.col(ts))
    return (
        df.groupBy(kpi.alias("kpi_id"), day.alias("ts"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .withColumn("tags", F.array().cast("array<string>"))
    )


def kpi_from_facts(facts: DataFrame, as_of: Column | date, kpi_id: Column | str = "demo_kpi") -> DataFrame:
    """Sum of the facts' numbers per date; a fact without a date counts for `as_of`.

    Numbers are added as decimals, so a re-run gives the same value whatever the order of the rows; only
    numbers beyond that range are added as doubles.
    """
    kpi = F.lit(kpi_id) if isinstance(kpi_id, str) else kpi_id
    last = as_of if isinstance(as_of, Column) else F.lit(as_of)
    exact = F.col("object_number").try_cast("decimal(28,10)")
    exact_sum = F.coalesce(F.sum(exact).cast("double"), F.lit(0.0))
    other_sum = F.coalesce(F.sum(F.when(exact.isNull(), F.col("object_number"))), F.lit(0.0))
    return (
        facts.groupBy(kpi.alias("kpi_id"), F.coalesce("object_date", last).alias("ts"))
        .agg((exact_sum + other_sum).alias("value"))
        .withColumn("tags", F.array().cast("array<string>"))
    )


def _day_number(ts: Column | str) -> Column:
    return F.datediff(as_column(ts), F.lit(DAY_ZERO).cast("date")).cast("double")


def _fit(points: DataFrame, keys: list[str]) -> DataFrame:
    """Straight line per group from mergeable sums, so a long series is reduced before the shuffle."""
    y, x = F.col("value"), _day_number("ts")
    return (
        points.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("ts").alias("last_ts"),
            F.avg(x).alias("mean_x"),
            F.avg(y).alias("mean_y"),
            F.regr_sxx(y, x).alias("sxx"),
            F.regr_sxy(y, x).alias("sxy"),
            F.regr_syy(y, x).alias("syy"),
        )
        .filter((F.col("n") >= MIN_POINTS) & (F.col("sxx") > 0))
        .withColumn("slope", F.col("sxy") / F.col("sxx"))
        .withColumn(
            "sigma",
            F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (F.col("n") - 2)),
        )
    )


def _project(fit: DataFrame, horizon: int, level: float) -> DataFrame:
    z = NormalDist().inv_cdf(0.5 + level / 2)
    days = F.sequence(F.date_add("last_ts", 1), F.date_add("last_ts", horizon))
    off = _day_number("ts") - F.col("mean_x")
    half = F.lit(z) * F.col("sigma") * F.sqrt(F.lit(1.0) + 1.0 / F.col("n") + off * off / F.col("sxx"))
    return (
        fit.withColumn("ts", F.explode(days))
        .withColumn("predicted", F.col("mean_y") + F.col("slope") * off)
        .withColumn("lower", F.col("predicted") - half)
        .withColumn("upper", F.col("predicted") + half)
    )


def _points(series: DataFrame) -> DataFrame:
    return series.filter(F.col("ts").isNotNull()).select("kpi_id", "ts", "value")


def training_points(points: DataFrame, splits: int) -> DataFrame:
    """Every point once for each of its KPI's last `splits` days that it is not after, as `split_ts`."""
    last = topk_per_group(points.select("kpi_id", "ts"), ["kpi_id"], [F.desc("ts")], splits, "_n")
    per_kpi = last.groupBy("kpi_id").agg(F.collect_list("ts").alias("splits"))
    return (
        points.join(per_kpi, "kpi_id")
        .withColumn("split_ts", F.explode(F.filter("splits", lambda s: s >= F.col("ts"))))
        .drop("splits")
    )


def forecast(series: DataFrame, horizon: int = HORIZON_DAYS, level: float = LEVEL) -> DataFrame:
    """(run_id, kpi_id, ts, predicted, lower, upper, backtest) for the `horizon` days after each KPI's last day.

    KPIs with fewer than 3 points get no forecast.
    """
    rows = _project(_fit(_points(series), ["kpi_id"]), horizon, level)
    run = stable_id("kpi_id", F.lit("|"), "last_ts")
    return rows.select(
        run.alias("run_id"), "kpi_id", "ts", "predicted", "lower", "upper", F.lit(False).alias("backtest")
    )


def forecast_backtest(
    series: DataFrame, splits: int = BACKTEST_SPLITS, horizon: int = HORIZON_DAYS, level: float = LEVEL
) -> DataFrame:
    """Refit on the data up to each of the last `splits` days of a KPI; adds split_ts and the actual, if known.

    The split days travel as a short array per KPI, so the one join is on kpi_id and every fit of every KPI
    is part of the same aggregation.
    """
    points = _points(series)
    rows = _project(_fit(training_points(points, splits), ["kpi_id", "split_ts"]), horizon, level)
    actual = points.withColumnRenamed("value", "actual")
    run = stable_id("kpi_id", F.lit("|"), "split_ts", F.lit("|backtest"))
    return rows.join(actual, ["kpi_id", "ts"], "left").select(
        run.alias("run_id"), "kpi_id", "split_ts", "ts", "predicted", "lower", "upper",
        F.lit(True).alias("backtest"), "actual",
    )


def kpi_cards(forecasts: DataFrame, n: int = CARD_ROWS) -> DataFrame:
    """The n latest production forecast rows."""
    return (
        forecasts.filter(~F.col("backtest")).orderBy(F.desc("ts"), "kpi_id").limit(n)
        .select("kpi_id", "ts", "predicted", "lower", "upper")
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Rows, first and last day and quartiles of the production forecast per KPI."""
    own = ~F.col("backtest")
    value = F.when(own, F.col("predicted"))
    return forecasts.groupBy("kpi_id").agg(
        F.count_if(own).alias("rows_prod"),
        F.min(F.when(own, F.col("ts"))).cast("string").alias("min_ts"),
        F.max(F.when(own, F.col("ts"))).cast("string").alias("max_ts"),
        *[F.percentile(value, q / 100).alias(f"p{q}") for q in (25, 50, 75)],
    )


def forecast_preview(forecasts: DataFrame, kpi_id: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first n forecast days of one KPI."""
    rows = forecasts.filter(~F.col("backtest") & (F.col("kpi_id") == kpi_id))
    return rows.select("ts", "predicted").orderBy("ts").limit(n)
