"""Models and metrics against brute force on small fixtures."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide.plans import metrics, models, ols


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_matches_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), rnd.randint(0, 1), float(rnd.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: r.auc for r in metrics.auc(df, "y", "s", by="g", rows_per_bucket=7).collect()}
    for g in "ab":
        ys = [y for gg, y, _ in rows if gg == g]
        ss = [s for gg, _, s in rows if gg == g]
        assert got[g] == pytest.approx(_brute_auc(ys, ss), abs=1e-12)


def test_auc_invariant_under_monotone_map(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), rnd.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double").withColumn("s2", F.exp(F.col("s") * 3) + 1)
    a = metrics.auc(df, "y", "s").collect()[0].auc
    b = metrics.auc(df, "y", "s2").collect()[0].auc
    assert a == pytest.approx(b, abs=1e-12)


def test_regression_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    rnd = random.Random(3)
    rows = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = metrics.regression_metrics(df, "label").collect()[0]
    ev = RegressionEvaluator(labelCol="label")
    assert m.r2 == pytest.approx(ev.setMetricName("r2").evaluate(df), rel=1e-9)
    assert m.mse == pytest.approx(ev.setMetricName("mse").evaluate(df), rel=1e-9)
    assert m.rmse == pytest.approx(ev.setMetricName("rmse").evaluate(df), rel=1e-9)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_closed_form_ols_matches_lstsq(spark, k):
    rnd = np.random.default_rng(k)
    rows = []
    truth = {}
    for g in range(3):
        beta = rnd.normal(size=k + 1)
        truth[g] = beta
        for _ in range(60):
            x = rnd.normal(size=k)
            rows.append((g, *map(float, x), float(beta[0] + x @ beta[1:] + rnd.normal(scale=0.1))))
    feats = [f"x{i}" for i in range(k)]
    df = spark.createDataFrame(rows, ["g", *feats, "y"])
    coefs = {r.g: r for r in ols.fit_closed_form(df, feats, "y", by="g").collect()}
    for g in range(3):
        X = np.array([[1.0, *r[1:1 + k]] for r in rows if r[0] == g])
        y = np.array([r[-1] for r in rows if r[0] == g])
        want, *_ = np.linalg.lstsq(X, y, rcond=None)
        got = [coefs[g][f"b_{i}"] for i in range(k + 1)]
        assert np.allclose(got, want, rtol=1e-8, atol=1e-10)
        assert coefs[g].n_train == 60


def test_constant_feature_gets_no_weight(spark):
    rows = [(1, 2.0, float(i % 4), 3.0 + 2.0 * (i % 4)) for i in range(10)]
    df = spark.createDataFrame(rows, "g int, x double, z double, y double")
    r = ols.fit_closed_form(df, ["x", "z"], "y", by="g").collect()[0]
    assert (r.b_1, r.b_2, r.b_0) == pytest.approx((0.0, 2.0, 3.0))
    flagged = df.withColumn("t", F.col("z") < 3)
    m = ols.fit_evaluate_closed_form(flagged, ["x", "z"], "y", "t", by="g").collect()[0]
    assert m.mse == pytest.approx(0.0, abs=1e-12) and m.rmse is not None and m.n_test == 2


@pytest.mark.parametrize("seed", range(4))
def test_exact_fits_have_no_negative_error(spark, seed):
    rnd = np.random.default_rng(seed)
    rows = [(g, bool(i < 20), float(x[0]), float(x[1]), float(1e3 * g + x[0] - 5 * x[1]))
            for g in range(10) for i, x in enumerate(rnd.normal(size=(30, 2)) * 100)]
    df = spark.createDataFrame(rows, "g int, t boolean, a double, b double, y double")
    for m in ols.fit_evaluate_closed_form(df, ["a", "b"], "y", "t", by="g").collect():
        assert 0 <= m.mse < 1e-6 and m.rmse >= 0


def test_lag_sweep_takes_tickers(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "AAPL", float(i % 7), float((i * 5) % 11)) for i in range(40)]
    df = spark.createDataFrame(rows, "Date date, Stock string, f double, label double")
    assert [r.Stock for r in ols.lag_sweep_per_stock(df, ["f"], "label", lags=[1]).collect()] == ["AAPL"]


def test_null_labels_take_no_part(spark):
    rows = [(dt.date(2020, 1, 1 + i), "AB"[i % 2], float(i), None if i == 3 else float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "Date date, Category string, x double, buySell double")
    for fit in (models.linear_probability, models.logistic, models.random_forest, models.poly_logistic):
        assert fit(df, df).count() == 20
    pred = df.withColumn("prediction", F.col("x") / 20)
    one = metrics.regression_metrics(pred, "buySell").first()
    both = metrics.regression_metrics(pred.where("buySell IS NOT NULL"), "buySell").first()
    assert one == both and one.n == 19


def test_prediction_without_groups_needs_no_join(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    out = ols.predict_closed_form(df, ols.fit_closed_form(df, ["x"], "y"), ["x"])
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.prediction for r in out.orderBy("x").collect()] == pytest.approx([3.0, 5.0, 7.0])


def test_linear_regression_matches_closed_form(spark):
    rnd = np.random.default_rng(0)
    rows = [(float(a), float(b), float(1 + 2 * a - b + rnd.normal(scale=0.05))) for a, b in rnd.normal(size=(80, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    pred = models.linear(df, df, ["a", "b"], "y").select("prediction").collect()
    coefs = ols.fit_closed_form(df, ["a", "b"], "y")
    mine = ols.predict_closed_form(df, coefs, ["a", "b"]).select("prediction").collect()
    assert np.allclose([p[0] for p in pred], [p[0] for p in mine], rtol=1e-7)


def test_lag_sweep_one_stock_against_numpy(spark):
    rnd = np.random.default_rng(5)
    n = 40
    base = rnd.normal(size=(n, 1))
    y = rnd.normal(size=n)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    rows = [(days[i], 1, float(base[i, 0]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "Date date, Stock long, f double, label double")
    got = {r.lag: r for r in ols.lag_sweep_per_stock(df, ["f"], "label", lags=[1, 3]).collect()}
    for L in (1, 3):
        X = np.hstack([base[L:], np.column_stack([y[L - i:n - i] for i in range(1, L + 1)])])
        yy = y[L:]
        m = len(yy)
        ntr = int(np.floor(m * 0.8))
        lo, hi = X[:ntr].min(0), X[:ntr].max(0)
        Xs = (X - lo) / (hi - lo)
        A = np.hstack([np.ones((m, 1)), Xs])
        beta, *_ = np.linalg.lstsq(A[:ntr], yy[:ntr], rcond=None)
        err = yy[ntr:] - A[ntr:] @ beta
        assert got[L].n_train == ntr and got[L].n_test == m - ntr
        assert got[L].mse == pytest.approx(float(np.mean(err ** 2)), rel=1e-9)


def test_lag_sweep_short_stock_has_null_metrics(spark):
    rows = [(dt.date(2020, 1, i), 9, 1.0 * i, 0.5 * i) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "Date date, Stock long, f double, label double")
    r = ols.lag_sweep_per_stock(df, ["f"], "label", lags=[5]).collect()[0]
    assert r.mse is None and r.r2 is None and r.n_test == 0


def test_auc_of_empty_input_is_empty(spark):
    df = spark.createDataFrame([], "g string, y int, s double")
    assert metrics.auc(df, "y", "s", by="g").count() == 0


def plain_sweep(days, base, y, L, frac=0.8):
    """(n_train, n_test, mse, r2) of lag count L by lstsq on the rows themselves."""
    n = len(y)
    lagged = np.full((n, L), np.nan)
    for i in range(1, min(L, n - 1) + 1):
        lagged[i:, i - 1] = y[:-i]
    X = np.hstack([base, lagged])
    keep = ~np.isnan(X).any(axis=1) & ~np.isnan(y)
    X, y = X[keep], y[keep]
    cut = int(np.floor(len(y) * frac))
    if cut < 1 or len(y) - cut < 1:
        return cut, len(y) - cut, None, None
    spread = X[:cut].std(axis=0)
    A = np.hstack([np.ones((len(y), 1)), (X - X[:cut].mean(axis=0))[:, spread > 1e-12] / spread[spread > 1e-12]])
    err = y[cut:] - A[cut:] @ np.linalg.lstsq(A[:cut], y[:cut], rcond=None)[0]
    sst = np.sum((y[cut:] - y[cut:].mean()) ** 2)
    return cut, len(y) - cut, np.mean(err ** 2), 1 - np.sum(err ** 2) / sst if len(y) - cut >= 2 and sst > 0 else None


@pytest.mark.parametrize("shape", ["walk", "holes in front", "holes inside", "constant feature", "copied feature", "short", "far level"])
def test_all_lags_against_plain_least_squares(spark, shape):
    rnd = np.random.default_rng(3)
    n = 100 if shape == "short" else 420
    base = rnd.normal(size=(n, 3)) * [1.0, 50.0, 1e-3]
    y = np.convolve(rnd.normal(size=n + 6), np.ones(7) / 7, mode="valid") + 0.3 * base[:, 0]
    if shape == "holes in front":
        base[:6, 1] = np.nan
    if shape == "holes inside":
        base[50:53, 2] = np.nan
        y[200] = np.nan
    if shape == "constant feature":
        base[:, 2] = 4.0
        base[: n - 30, 1] = 0.0  # varies in the test rows only
    if shape == "copied feature":
        base[:, 2] = 2 * base[:, 1] + 1
    if shape == "far level":
        y += 1e6
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    none = lambda x: None if np.isnan(x) else float(x)
    rows = [(days[i], 1, *map(none, base[i]), none(y[i])) for i in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r[:1], int(r[1]), *r[2:]) for r in map(list, rows)], "Date date, Stock long, a double, b double, c double, label double")
    got = {r.lag: r for r in ols.lag_sweep_per_stock(df, ["a", "b", "c"], "label").collect()}
    assert sorted(got) == sorted(set(ols.LAG_VALUES)) and len(got) == 32
    for L, r in got.items():
        n_train, n_test, mse, r2 = plain_sweep(days, base, y, L)
        assert (r.n_train, r.n_test) == (n_train, n_test)
        if n_train <= 4 + L:  # as many columns as rows: least squares of minimum norm depends on the scaling
            continue
        assert r.mse == (None if mse is None else pytest.approx(mse, rel=1e-6, abs=1e-14))
        assert r.r2 == (None if r2 is None else pytest.approx(r2, rel=1e-6, abs=1e-6))


def test_near_lag_counts_are_solved_together(monkeypatch):
    rnd = np.random.default_rng(11)
    base, y = rnd.normal(size=(400, 3)), rnd.normal(size=400)
    calls, solve = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: calls.append(a.shape) or solve(a, b))
    got = ols.sweep_one_stock(base, y, sorted(set(ols.LAG_VALUES)), 0.8)
    assert len(got) == 32 and len(calls) <= 4
    for lag, *metrics_ in got:
        assert metrics_ == pytest.approx(list(plain_sweep(None, base, y, lag)), rel=1e-8)


def test_lag_sweep_takes_null_keys_and_dates(spark):
    rnd = np.random.default_rng(12)
    rows = []
    for stock in (None, 1):
        for i in range(60):
            day = None if stock == 1 and i == 59 else dt.date(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((day, stock, float(rnd.normal()), float(rnd.normal())))
    df = spark.createDataFrame(rows[::-1], "Date date, Stock long, f double, label double")
    got = {(r.Stock, r.lag): r for r in ols.lag_sweep_per_stock(df, ["f"], "label", lags=[1, 20]).collect()}
    assert set(got) == {(s, lag) for s in (None, 1) for lag in (1, 20)}
    for k, stock in enumerate((None, 1)):
        mine = rows[60 * k: 60 * k + 60]  # a row without a date comes last
        for lag in (1, 20):
            r = got[stock, lag]
            n_train, n_test, mse, r2 = plain_sweep(None, np.array([[x[2]] for x in mine]), np.array([x[3] for x in mine]), lag)
            assert (r.n_train, r.n_test) == (n_train, n_test)
            assert (r.mse, r.r2) == pytest.approx((mse, r2), rel=1e-8)
