from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest

from pyspark.sql import functions as F

from eventloom.operators.anomaly import anomalies, merge_trend_states, piecewise_fit, trend_state

RUN = datetime(2024, 2, 1)
POINTS = "repo_id bigint, repo_name string, ds date, y double"


@pytest.fixture
def points(spark):
    def make(**named):
        rows = [
            (i, name, date(2024, 1, 1) + timedelta(days=d), float(y))
            for i, (name, ys) in enumerate(named.items()) for d, y in enumerate(ys)
        ]
        return spark.createDataFrame(rows, POINTS)

    return make


def found(df):
    return sorted((r.repo_name, r.y) for r in df.collect())


def test_zscore_rule(points):
    df = points(
        one=[50], two=[1, 60], four=[6, 6, 6, 60], six=[6, 6, 6, 6, 6, 60], flat=[7] * 5,
        zero=[0] * 5, small=[1, 1, 1, 1, 1, 4],
    )
    out = anomalies(df, "zscore", RUN)
    # With fewer than five points no value can be 1.5 deviations up, and a
    # value of 5 or less is never reported.
    assert found(out) == [("six", 60.0)]
    row = out.first()
    mean, sd = 15.0, np.std([6] * 5 + [60], ddof=1)
    assert row.yhat_upper == pytest.approx(mean + 1.5 * sd, abs=1e-5)
    assert row.yhat_lower == 0.0
    assert row.anomaly_score == pytest.approx((60 - mean - 1.5 * sd) / sd, abs=1e-5)
    assert row.run_timestamp == RUN


def test_trend_rule_flags_both_sides_and_not_a_perfect_line(points):
    line = [10 + 3 * i for i in range(30)]
    high, low = list(line), list(line)
    high[15] += 60
    low[20] -= 50
    out = anomalies(points(line=line, high=high, low=low, flat=[4] * 9), "trend", RUN)
    assert found(out) == [("high", 115.0), ("low", 20.0)]
    for r in out.collect():
        width = r.yhat_upper - r.yhat_lower
        beyond = r.y - r.yhat_upper if r.y > r.yhat_upper else r.yhat_lower - r.y
        assert r.anomaly_score == pytest.approx(beyond / width, abs=1e-5)


@pytest.mark.parametrize("method", ["auto", "piecewise"])
def test_dispatch_by_length(points, method):
    spike = [5.0] * 40
    spike[25] = 90.0
    df = points(short=[1, 100], spike=spike, flat=[3] * 10)
    assert found(anomalies(df, method, RUN)) == [("spike", 90.0)]


def test_failed_fit_falls_back(points):
    def broken(days, y):
        raise ValueError("no fit")

    df = points(six=[6, 6, 6, 6, 6, 60])
    fallen = anomalies(df, "piecewise", RUN, fit=broken).collect()
    assert fallen == anomalies(df, "zscore", RUN).collect()


def test_bug_in_a_model_is_not_hidden(points):
    def wrong(days, y):
        return y.no_such_member, 0.0

    with pytest.raises(Exception, match="no_such_member"):
        anomalies(points(six=[6, 6, 6, 6, 6, 60]), "piecewise", RUN, fit=wrong).collect()


def test_piecewise_follows_a_change_of_slope():
    days = np.arange(60.0)
    y = np.where(days < 30, 100 + days, 130 + 6 * (days - 30))
    fitted, sigma = piecewise_fit(days, y)
    straight = np.polyval(np.polyfit(days, y, 1), days)
    assert np.abs(fitted - y).mean() < 0.4 * np.abs(straight - y).mean()
    assert sigma < y.std()


def test_piecewise_constant_and_deterministic():
    fitted, sigma = piecewise_fit(np.arange(5.0), np.full(5, 3.0))
    assert (fitted == 3.0).all() and sigma == 0.0
    days, y = np.arange(20.0), np.random.default_rng(1).poisson(9, 20).astype(float)
    a, b = piecewise_fit(days, y), piecewise_fit(days, y)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_unknown_method(points):
    with pytest.raises(ValueError):
        anomalies(points(a=[1]), "other", RUN)


def sums_of(df):
    return {r.repo_id: tuple(map(int, r[1:])) for r in df.collect()}


@pytest.mark.parametrize("method", ["trend", "zscore", "auto"])
def test_bounds_from_sums_equal_those_from_points(points, method):
    rng = np.random.default_rng(3)
    ys = {f"r{i}": rng.poisson(20 + i, 50).tolist() for i in range(8)}
    ys["r1"][20], ys["r2"][30], ys["r3"][3] = 400, 0, 10**7
    df = points(one=[4], two=[1, 60], line=[10**6 + 7 * i for i in range(40)], flat=[3] * 9, six=[6] * 5 + [60], **ys)
    want = anomalies(df, method, RUN)
    got = anomalies(df, method, RUN, state=trend_state(df))
    assert found(got) == found(want) != []
    for a, b in zip(*(sorted(x.collect(), key=lambda r: (r.repo_id, r.ds)) for x in (got, want))):
        assert a[:4] == b[:4] and a[4:7] == pytest.approx(b[4:7], abs=2e-6, rel=1e-9)


def test_sums_follow_changes(points):
    old = points(a=[5, 6, 7], b=[1, 2])
    new = points(a=[5, 9, 7, 8], b=[], c=[4])
    parts = trend_state(old).unionByName(trend_state(old, F.lit(-1))).unionByName(trend_state(new))
    assert sums_of(merge_trend_states(parts)) == sums_of(trend_state(new))
    half = points(a=[5, 6], b=[1]).filter("ds < '2024-01-02'")
    rest = points(a=[5, 6], b=[1, 7]).filter("ds >= '2024-01-02'")
    whole = merge_trend_states(trend_state(half).unionByName(trend_state(rest)))
    assert sums_of(whole) == sums_of(trend_state(half.unionByName(rest)))
