"""Unusual days in each repository's daily activity.

A series is one repository's daily counts, so it never holds more rows than the
history has days; everything runs inside one shuffle by repository.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the detection rules.
MIN_POINTS = 3
Z_95 = 1.96
FALLBACK_WIDTH = 1.5
FALLBACK_FLOOR = 5.0
FALLBACK_SPREAD = 0.2
ROUND_DIGITS = 6

BOUNDED = "repo_id long, repo_name string, ds date, y double, yhat_lower double, yhat_upper double"


def series(daily: DataFrame) -> DataFrame:
    """Daily facts as (repo_id, repo_name, ds, y).  Rows that belong to no
    repository or no day cannot form a series."""
    return daily.filter(F.col("repo_id").isNotNull() & F.col("event_date").isNotNull()).select(
        "repo_id", "repo_name", F.col("event_date").alias("ds"),
        F.col("total_events").cast("double").alias("y"),
    )


def _over(value: Column) -> Column:
    """``value`` over the whole series of the row."""
    return value.over(Window.partitionBy("repo_id"))


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def trend_state(points: DataFrame, weight: Column | None = None) -> DataFrame:
    """What a straight line and a deviation need to know of each series, as exact sums.

    Rows of sums add up (:func:`merge_trend_states`), so points can be taken in, or out
    with ``weight`` -1, without the rest of their series.  ``x`` counts days from a fixed
    day and ``y`` must be whole numbers, hence every sum is exact in any order.
    """
    w = F.lit(1) if weight is None else weight
    x, y = F.unix_date("ds"), F.col("y").cast("bigint")
    terms = {"n": F.lit(1), "sx": x, "sy": y, "sxy": x * y, "sxx": x.cast("bigint") * x, "syy": y * y}
    return points.groupBy("repo_id").agg(*[F.sum(_whole(w * t)).cast("decimal(38,0)").alias(c) for c, t in terms.items()])


TREND_SUMS = ["n", "sx", "sy", "sxy", "sxx", "syy"]
TREND_STATE = T.StructType(
    [T.StructField("repo_id", T.LongType())] + [T.StructField(c, T.DecimalType(38, 0)) for c in TREND_SUMS]
)


def merge_trend_states(parts: DataFrame) -> DataFrame:
    """One row of sums per series; series whose points were all taken out go."""
    return parts.groupBy("repo_id").agg(*[_whole(F.sum(c)).alias(c) for c in TREND_SUMS]).filter("n > 0")


def fits(state: DataFrame) -> DataFrame:
    """Line and deviations of each series, from its sums alone.

    ``repo_id, points, x_mean, mean, slope, residual, spread``: the slope is NULL where
    all points lie on one day, the sample deviation ``spread`` for a single point.
    """
    n = F.col("n")
    times, minus = F.try_multiply, F.try_subtract
    xx = minus(times(n, F.col("sxx")), times(F.col("sx"), F.col("sx")))
    xy = minus(times(n, F.col("sxy")), times(F.col("sx"), F.col("sy")))
    yy = minus(times(n, F.col("syy")), times(F.col("sy"), F.col("sy")))
    parts = state.select("*", xx.alias("xx"), xy.alias("xy"), yy.alias("yy"))
    d = {c: F.col(c).cast("double") for c in ("n", "sx", "sy", "xx", "xy", "yy")}
    # Exact down to the division, or a perfect line would show a residual.
    left = minus(times("yy", "xx"), times("xy", "xy")).cast("double")
    left = F.coalesce(left, F.greatest(d["yy"] * d["xx"] - d["xy"] * d["xy"], F.lit(0.0)))
    return parts.select(
        "repo_id", n.cast("bigint").alias("points"), (d["sx"] / d["n"]).alias("x_mean"), (d["sy"] / d["n"]).alias("mean"),
        F.when(d["xx"] != 0, d["xy"] / d["xx"]).alias("slope"),
        F.when(d["xx"] != 0, F.sqrt(left / d["xx"]) / d["n"]).alias("residual"),
        F.when(n > 1, F.sqrt(d["yy"] / (d["n"] * (d["n"] - 1)))).alias("spread"),
    )


def with_fits(points: DataFrame, state: DataFrame) -> DataFrame:
    """Points with ``_fit``, the fit of their series; nothing is fitted again."""
    known = fits(state)
    fit = known.select(F.col("repo_id").alias("_of"), F.struct(*known.columns[1:]).alias("_fit"))
    return points.join(fit, F.col("repo_id") == F.col("_of")).drop("_of")


def with_trend_bounds(points: DataFrame, z: float = Z_95) -> DataFrame:
    """Straight-line trend per series, band of ``z`` residual deviations."""
    if "_fit" in points.columns:
        yhat = F.col("_fit.mean") + F.col("_fit.slope") * (F.unix_date("ds") - F.col("_fit.x_mean"))
        band = z * F.col("_fit.residual")
        return points.withColumns({
            "yhat_lower": F.round(yhat - band, ROUND_DIGITS), "yhat_upper": F.round(yhat + band, ROUND_DIGITS),
        })
    x = F.datediff("ds", _over(F.min("ds"))).cast("double")
    fitted = (
        points.withColumn("_x", x)
        .withColumn(
            "_yhat",
            _over(F.regr_slope("y", "_x")) * F.col("_x") + _over(F.regr_intercept("y", "_x")),
        )
        .withColumn("_band", z * F.sqrt(_over(F.avg(F.pow(F.col("y") - F.col("_yhat"), F.lit(2))))))
    )
    return fitted.withColumns({
        "yhat_lower": F.round(F.col("_yhat") - F.col("_band"), ROUND_DIGITS),
        "yhat_upper": F.round(F.col("_yhat") + F.col("_band"), ROUND_DIGITS),
    }).drop("_x", "_yhat", "_band")


def with_fallback_bounds(points: DataFrame) -> DataFrame:
    """Mean plus or minus 1.5 deviations, for short series and failed fits."""
    known = "_fit" in points.columns
    mean = F.col("_fit.mean") if known else _over(F.avg("y"))
    spread = F.col("_fit.spread") if known else _over(F.stddev_samp("y"))
    spread = F.when(
        spread.isNull() | F.isnan(spread) | (spread == 0),
        F.when(mean > 0, mean * FALLBACK_SPREAD).otherwise(1.0),
    ).otherwise(spread)
    return points.withColumns({"_mean": mean, "_spread": spread}).withColumns({
        "yhat_upper": F.round(
            F.greatest(F.col("_mean") + FALLBACK_WIDTH * F.col("_spread"), F.lit(FALLBACK_FLOOR)),
            ROUND_DIGITS,
        ),
        "yhat_lower": F.round(
            F.greatest(F.col("_mean") - FALLBACK_WIDTH * F.col("_spread"), F.lit(0.0)), ROUND_DIGITS
        ),
    }).drop("_mean")


def _outside(lower: str = "yhat_lower", upper: str = "yhat_upper") -> Column:
    """How far outside the band, as a share of its width; NULL inside it."""
    width = F.col(upper) - F.col(lower)
    width = F.when(width > 0, width).otherwise(1.0)
    return F.when(F.col("y") > F.col(upper), (F.col("y") - F.col(upper)) / width).when(
        F.col("y") < F.col(lower), (F.col(lower) - F.col("y")) / width
    )


def _above(spread: str = "_spread") -> Column:
    return F.when(F.col("y") > F.col("yhat_upper"), (F.col("y") - F.col("yhat_upper")) / F.col(spread))


def piecewise_fit(days: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Fitted values and noise deviation of a trend whose slope may change.

    The public model of Taylor and Letham (2018) without seasonality: up to 25
    possible slope changes in the first 80 % of the series, a Laplace prior on
    the changes, normal priors on slope and offset, half-normal on the noise,
    fitted to the mode.  The absolute values of the Laplace prior are handled
    by reweighted least squares, which is deterministic.
    """
    n = len(y)
    scale = float(np.abs(y).max()) or 1.0
    if n < 2 or y.min() == y.max():
        return y.astype(float), 0.0
    t = (days - days.min()) / (days.max() - days.min())
    early = int(np.floor(n * 0.8))
    count = min(25, early - 1)
    picks = np.linspace(0, early - 1, count + 1).round().astype(int)[1:] if count > 0 else []
    hinges = np.maximum(t[:, None] - t[picks][None, :], 0.0) if count > 0 else np.zeros((n, 0))
    basis = np.column_stack([t, np.ones(n), hinges])
    target = y / scale
    penalty = np.full(basis.shape[1], 1.0 / 25.0)
    changes = np.full(hinges.shape[1], 0.05)
    variance = max(float(target.var()), 1e-8)
    fitted = target
    for _ in range(50):
        penalty[2:] = 1.0 / (0.05 * np.maximum(np.abs(changes), 1e-6))
        weights = np.linalg.solve(
            basis.T @ basis / variance + np.diag(penalty), basis.T @ target / variance
        )
        changes = weights[2:]
        fitted = basis @ weights
        error = float(((target - fitted) ** 2).sum())
        variance = max((np.sqrt(n * n + 16 * error) - n) / 8, 1e-10)
    return fitted * scale, float(np.sqrt(variance)) * scale


def grouped_bounds(
    points: DataFrame, fit: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float]] = piecewise_fit,
    z: float = Z_95,
) -> DataFrame:
    """Bounds from a Python model per series, NULL where the model fails.

    A fit fails by ``ValueError`` (singular systems included) or ``ArithmeticError``;
    any other error is a bug of the model and ends the job.
    ``fit(days, y)`` returns fitted values and a noise deviation; any
    forecaster with that shape can be passed.
    """
    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        try:
            days = pd.to_datetime(pdf["ds"]).to_numpy().astype("datetime64[D]").astype(float)
            fitted, sigma = fit(days, pdf["y"].to_numpy())
            lower, upper = fitted - z * sigma, fitted + z * sigma
        except (ArithmeticError, ValueError):  # what a failed fit raises; the deviation rule follows
            lower = upper = np.full(len(pdf), np.nan)
        return pdf.assign(
            yhat_lower=np.round(lower, ROUND_DIGITS), yhat_upper=np.round(upper, ROUND_DIGITS)
        )

    return points.groupBy("repo_id").applyInPandas(bounds, BOUNDED)


def anomalies(
    points: DataFrame, method: str = "auto", run_ts: datetime | None = None,
    min_points: int = MIN_POINTS, z: float = Z_95, fit: Callable = piecewise_fit,
    state: DataFrame | None = None,
) -> DataFrame:
    """Points outside their series' band, in the shape of the anomaly table.

    ``trend`` and ``zscore`` apply one rule to every series.  ``auto`` uses the
    trend from ``min_points`` days on and the deviation rule below;
    ``piecewise`` does the same with the Python model, and also falls back
    where it fails.  With the sums of :func:`trend_state` the bounds come from them, and
    ``points`` may be any part of the series.
    """
    if state is not None and method != "piecewise":
        points = with_fits(points, state)
    if method == "trend":
        scored = with_trend_bounds(points, z).withColumn("anomaly_score", _outside())
    elif method == "zscore":
        scored = with_fallback_bounds(points).withColumn("anomaly_score", _above())
    elif method in ("auto", "piecewise"):
        modelled = with_trend_bounds(points, z) if method == "auto" else grouped_bounds(points, fit, z)
        modelled = modelled.withColumnsRenamed({"yhat_lower": "_lower", "yhat_upper": "_upper"})
        count = F.col("_fit.points") if "_fit" in points.columns else _over(F.count("*"))
        usable = (
            (count >= min_points)
            & F.col("_lower").isNotNull() & ~F.isnan("_lower")
        )
        scored = with_fallback_bounds(modelled.withColumn("_usable", usable))
        score = F.when(F.col("_usable"), _outside("_lower", "_upper")).otherwise(_above())
        scored = scored.withColumn("anomaly_score", score).withColumns({
            "yhat_lower": F.when(F.col("_usable"), F.col("_lower")).otherwise(F.col("yhat_lower")),
            "yhat_upper": F.when(F.col("_usable"), F.col("_upper")).otherwise(F.col("yhat_upper")),
        })
    else:
        raise ValueError(f"unknown method {method!r}")
    return scored.filter(F.col("anomaly_score").isNotNull()).select(
        "repo_id", "repo_name", "ds", "y", "yhat_lower", "yhat_upper",
        F.round("anomaly_score", ROUND_DIGITS).alias("anomaly_score"),
        F.lit(run_ts).cast("timestamp").alias("run_timestamp"),
    )
