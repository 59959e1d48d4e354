"""Grouped ordinary least squares.

Small models are solved from grouped sufficient statistics -- means and
population covariances, all partial aggregates. numpy solves the one row of
moments of each group, with the minimum norm where features are constant or
collinear.

The lag sweep needs up to 123 features; it groups one stock's *daily*
series (at most one row per calendar day, whatever the data volume) into
an Arrow batch and solves every lag in the same task: stacks of normal
equations, and numpy ``lstsq`` where they are near to singular.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SINGULAR_TOL = 1e-12


def _safe(x: str) -> str:
    return re.sub(r"\W", "_", x)


def _m(x):
    return f"m_{_safe(x)}"


def _c(a, b):
    a, b = sorted((_safe(a), _safe(b)))
    return f"c_{a}__{b}"


def stat_exprs(features: list[str], label: str, where: str | None = None, prefix: str = "") -> dict[str, str]:
    """Aggregate SQL (name -> expression) of the sufficient statistics: means and
    population covariances, optionally over the rows where ``where`` holds."""
    if where is None:
        q = lambda c: f'"{c}"'
    else:
        q = lambda c: f'CASE WHEN {where} THEN "{c}" END'
    out = {prefix + _m(f): f"avg({q(f)})" for f in features + [label]}
    cols = features + [label]
    for i, a in enumerate(features + [label]):
        for b in cols[i:]:
            out[prefix + _c(a, b)] = f"covar_pop({q(a)}, {q(b)})"
    return out


def _column(pdf: pd.DataFrame, name: str) -> np.ndarray:
    return pdf[name].to_numpy(dtype="float64", na_value=np.nan)


def solve_moments(pdf: pd.DataFrame, features: list[str], label: str) -> np.ndarray:
    """(rows, 1 + k): intercept and coefficients from the moments of each row.

    Minimum norm on the standardised features, so a feature without variance (constant) gets 0. NaN
    where a group has no rows to fit on.
    """
    k = len(features)
    cov = np.stack([np.stack([_column(pdf, _c(f, g)) for g in features], 1) for f in features], 1)
    with_y = np.stack([_column(pdf, _c(f, label)) for f in features], 1)
    out = np.full((len(pdf), 1 + k), np.nan)
    ok = np.isfinite(cov).all(axis=(1, 2)) & np.isfinite(with_y).all(axis=1)
    if ok.any():
        sd = np.sqrt(np.maximum(np.einsum("nii->ni", cov[ok]), 0))
        unit = np.where(sd > 0, sd, 1.0)
        corr = cov[ok] / unit[:, :, None] / unit[:, None, :]
        b = np.einsum("nij,nj->ni", np.linalg.pinv(corr, rcond=SINGULAR_TOL, hermitian=True), with_y[ok] / unit) / unit
        out[ok, 1:] = np.where(sd > 0, b, 0.0)
        means = np.stack([_column(pdf, _m(f)) for f in features], 1)
        out[ok, 0] = _column(pdf, _m(label))[ok] - (out[ok, 1:] * means[ok]).sum(axis=1)
    return out


def moments_mse(pdf: pd.DataFrame, coefs: np.ndarray, features: list[str], label: str, prefix: str = "t_") -> np.ndarray:
    """Test-set MSE of the coefficients from test-set moments only:
    var(y) - 2 b.cov(x, y) + b'cov(x)b + (mean y - b_0 - b.mean x)^2, never below 0."""
    t = lambda name: _column(pdf, prefix + name)
    b = coefs[:, 1:]
    cov = np.stack([np.stack([t(_c(f, g)) for g in features], 1) for f in features], 1)
    with_y = np.stack([t(_c(f, label)) for f in features], 1)
    means = np.stack([t(_m(f)) for f in features], 1)
    bias = t(_m(label)) - coefs[:, 0] - (b * means).sum(axis=1)
    mse = t(_c(label, label)) - 2 * (b * with_y).sum(axis=1) + np.einsum("ni,nij,nj->n", b, cov, b) + bias * bias
    return np.maximum(mse, 0.0)


def prediction_expr(features: list[str]) -> str:
    return "b_0 + " + " + ".join(f'b_{i + 1} * "{f}"' for i, f in enumerate(features))


def fit_evaluate_closed_form(df: DataFrame, features: list[str], label: str, train_flag: str, by=()) -> DataFrame:
    """Fit on rows where ``train_flag`` is true, score the others, in ONE grouped
    aggregate: per group n_train, n_test, b_0..b_k, mse, rmse, r2 (test set).

    The test metrics follow exactly from the test rows' means and covariances,
    so no join of coefficients back to the rows is needed.
    """
    by = [by] if isinstance(by, str) else list(by)
    sq = lambda s: s.replace('"', "`")
    plain = stat_exprs(features, label)
    # level 1: moments per (group, side); clustered like the group, so no new shuffle
    per_side = df.groupBy(*by, train_flag).agg(
        F.count(F.lit(1)).alias("__n"), *[F.expr(sq(e)).alias(n) for n, e in plain.items()])
    # level 2: the two sides of a group next to each other (cheap max of at most one value)
    side = lambda flag, c: F.max(F.when(F.col(train_flag) == flag, F.col(c)))
    stats = per_side.groupBy(*by).agg(
        F.coalesce(side(True, "__n"), F.lit(0)).alias("n_train"),
        F.coalesce(side(False, "__n"), F.lit(0)).alias("n_test"),
        *[side(True, n).alias(n) for n in plain],
        *[side(False, n).alias("t_" + n) for n in plain],
    )
    names = [f"b_{i}" for i in range(len(features) + 1)]

    def solve(batches):
        for pdf in batches:
            coefs = solve_moments(pdf, features, label)
            mse = np.where(pdf["n_test"].to_numpy() > 0, moments_mse(pdf, coefs, features, label), np.nan)
            var_y = _column(pdf, "t_" + _c(label, label))
            r2 = np.where(var_y > 0, 1.0 - mse / np.where(var_y > 0, var_y, 1.0), np.nan)
            yield pd.concat([pdf[[*by, "n_train", "n_test"]], pd.DataFrame(coefs, columns=names, index=pdf.index),
                             pd.DataFrame({"mse": mse, "rmse": np.sqrt(mse), "r2": r2}, index=pdf.index)], axis=1)

    schema = T.StructType([df.schema[c] for c in by] + [T.StructField(c, T.LongType()) for c in ("n_train", "n_test")]
                          + [T.StructField(c, T.DoubleType()) for c in (*names, "mse", "rmse", "r2")])
    return stats.mapInPandas(solve, schema)


def fit_closed_form(train: DataFrame, features: list[str], label: str, by=()) -> DataFrame:
    """One row per group: n_train, b_0..b_k (0 for a feature without variance of its own)."""
    by = [by] if isinstance(by, str) else list(by)
    sq = lambda s: s.replace('"', "`")  # noqa: E731  (Spark quotes identifiers with backticks)
    stats = train.groupBy(*by).agg(*[F.expr(sq(e)).alias(n) for n, e in stat_exprs(features, label).items()],
                                   F.count(F.lit(1)).alias("n_train"))
    names = [f"b_{i}" for i in range(len(features) + 1)]

    def solve(batches):
        for pdf in batches:
            coefs = pd.DataFrame(solve_moments(pdf, features, label), columns=names, index=pdf.index)
            yield pd.concat([pdf[[*by, "n_train"]], coefs], axis=1)

    schema = T.StructType([train.schema[c] for c in by] + [T.StructField("n_train", T.LongType())]
                          + [T.StructField(c, T.DoubleType()) for c in names])
    return stats.mapInPandas(solve, schema)


def predict_closed_form(df: DataFrame, coefs: DataFrame, features: list[str], by=(), out="prediction") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    names = [f"b_{i}" for i in range(len(features) + 1)]
    if by:
        j = df.join(coefs, by)
    else:  # one row of coefficients: a scalar subquery
        one = coefs.select(F.struct(*names).alias("b")).scalar()
        j = df.withColumns({n: one.getField(n) for n in names})
    return j.withColumn(out, F.expr(prediction_expr(features).replace('"', "`")))


# ---- lag sweep: per stock, every lag in one task --------------------------

LAG_VALUES = list(range(1, 31)) + [30, 90, 120]  # fixed values: the reference's sweep (30 twice)

SWEEP_FIELDS = [
    T.StructField("lag", T.IntegerType()),
    T.StructField("n_train", T.IntegerType()),
    T.StructField("n_test", T.IntegerType()),
    T.StructField("mse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
]


def _solve(A: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least squares: Cholesky on the normal equations, ``lstsq`` (minimum norm)
    when the Gram matrix is not numerically positive definite."""
    G = A.T @ A
    try:
        L = np.linalg.cholesky(G)
        d = np.diag(L)
        if d.min() > 1e-7 * d.max():
            z = np.linalg.solve(L, A.T @ y)
            return np.linalg.solve(L.T, z)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(A, y, rcond=None)[0]


def _one_lag(X: np.ndarray, y: np.ndarray, n_train: int) -> np.ndarray:
    """Test errors of least squares fitted on the first ``n_train`` rows (minimum norm if need be)."""
    lo, hi = X[:n_train].min(axis=0), X[:n_train].max(axis=0)
    # MinMaxScaler fitted on train; a train-constant column scales to 0.5
    # everywhere, collinear with the intercept: dropping it leaves the
    # minimum-norm predictions unchanged
    var = hi > lo
    A = np.hstack([np.ones((len(y), 1)), (X[:, var] - lo[var]) / (hi[var] - lo[var])])
    return y[n_train:] - A[n_train:] @ _solve(A[:n_train], y[:n_train])


def _metrics_row(lag: int, n_train: int, sse: float | None, y: np.ndarray) -> tuple:
    """(lag, n_train, n_test, mse, r2); ``sse`` is the sum of squared test errors, ``y`` holds the test labels."""
    if sse is None:
        return lag, n_train, len(y), None, None
    off = y - y.mean()
    sst = float(off @ off)
    return lag, n_train, len(y), sse / len(y), 1.0 - sse / sst if len(y) >= 2 and sst > 0 else None


STACKED = 16  # the models of so many consecutive lag counts are solved together


class NestedGram:
    """Normal equations of all lag counts from few Gram matrices.

    Columns: 1, the base features, lag 1, lag 2, ..., and the label. A model of L lags uses the leading block, on rows
    from max(L, first whole row) on; its train rows are a range, and both ends only move forward as L grows. So the
    next model's matrix is this one less the rows that it loses (one for each lag) plus those it gains. The matrices
    of near lag counts are stacked, and the stack is solved at once. Columns are centred and scaled once, which leaves predictions as they are.
    """

    def __init__(self, base: np.ndarray, y: np.ndarray, max_lag: int, begin: int):
        self.n, self.nb = len(y), base.shape[1]
        whole = base[begin:]
        self.scale = float(y.std()) or 1.0
        z = (y - y.mean()) / self.scale
        spread = whole.std(axis=0)
        scaled = np.where(np.isnan(base), 0.0, (base - whole.mean(axis=0)) / np.where(spread > 0, spread, 1.0))
        # the label stands after the base features: a block of any number of lags has it at one place
        self.z = np.empty((self.n, 2 + self.nb + max_lag))
        self.z[:, 0], self.z[:, 1 + self.nb] = 1.0, z
        self.z[:, 1: 1 + self.nb] = np.where(np.isfinite(whole).all(axis=0), scaled, 0.0)  # infinite values: no part in any model
        before = np.concatenate([np.zeros(max_lag), z[:-1]])
        self.z[:, 2 + self.nb:] = np.lib.stride_tricks.sliding_window_view(before, max_lag)[:, ::-1]

    @staticmethod
    def grams(z: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Gram matrices of the rows from each of the ``starts`` to its end; both ascend."""
        out = np.empty((len(starts), z.shape[1], z.shape[1]))
        lo, hi = starts[0], starts[0]
        for i, (start, end) in enumerate(zip(starts, ends)):
            if start >= hi:
                out[i], gone, come = 0.0, z[:0], z[start:end]
            else:
                out[i], gone, come = out[i - 1], z[lo:start], z[hi:end]
            if len(come):
                out[i] += come.T @ come
            if len(gone):
                out[i] -= gone.T @ gone
            lo, hi = start, end
        return out

    def errors(self, lags: np.ndarray, starts: np.ndarray, n_train: np.ndarray) -> list[float | None]:
        """Sums of squared test errors of the models of ascending ``lags``; None where the normal equations are too near to singular."""
        at_y, k = 1 + self.nb, 2 + self.nb + int(lags[-1])
        z, ends = self.z[:, :k], starts + n_train
        G = self.grams(z, starts, ends)
        r = G[:, :, at_y]
        # a column takes part if the model has it and it varies in the train rows; the others stand for themselves
        own = np.einsum("lii->li", G) - G[:, 0] ** 2 / n_train[:, None] > 1e-9 * n_train[:, None]
        own &= np.arange(k) < 2 + self.nb + lags[:, None]
        own[:, 0], own[:, at_y] = True, False
        G = np.where(own[:, :, None] & own[:, None, :], G, 0.0)
        r = np.where(own, r, 0.0)
        np.einsum("lii->li", G)[...] += ~own
        ok = np.ones(len(lags), dtype=bool)
        try:
            d = np.linalg.cholesky(G)
        except np.linalg.LinAlgError:
            d = np.zeros_like(G)
            for i in range(len(lags)):
                try:
                    d[i] = np.linalg.cholesky(G[i])
                except np.linalg.LinAlgError:
                    ok[i] = False
        d = np.einsum("lii->li", d)
        ok &= np.where(own, d, np.inf).min(axis=1) > 1e-5 * np.where(own, d, 0.0).max(axis=1)
        beta = np.zeros_like(r)
        if ok.any():
            beta[ok] = np.linalg.solve(G[ok], r[ok][:, :, None])[:, :, 0]
        test = z[ends[0]:]
        err = test[:, at_y, None] - test @ beta.T
        err[np.arange(ends[0], self.n)[:, None] < ends] = 0.0
        sse = np.einsum("nl,nl->l", err, err) * self.scale ** 2
        return [float(e) if fine else None for e, fine in zip(sse, ok)]


def _stacks(lags: list[int]) -> list[list[int]]:
    """Runs of ascending lag counts less than ``STACKED`` apart."""
    out = []
    for lag in lags:
        if out and lag - out[-1][0] < STACKED:
            out[-1].append(lag)
        else:
            out.append([lag])
    return out


def _nested_sweep(X_base: np.ndarray, y_all: np.ndarray, begin: int, lags: list[int], frac: float) -> list[tuple]:
    """Rows of the sweep where the whole rows are those from ``begin`` on."""
    n, rows = len(y_all), []
    nested = NestedGram(X_base, y_all, max(lags), begin)
    for some in _stacks(lags):
        L = np.array(some)
        starts = np.maximum(L, begin)
        n_train = np.floor(np.maximum(n - starts, 0) * frac).astype(int)
        fits = (n_train >= 1) & (n - starts - n_train >= 1)
        sse = iter(nested.errors(L[fits], starts[fits], n_train[fits]) if fits.any() else [])
        for lag, start, cut, fit in zip(some, starts.tolist(), n_train.tolist(), fits):
            if not fit:
                rows.append((lag, cut, max(n - start, 0) - cut, None, None))
                continue
            e = next(sse)
            if e is None:  # collinear or more columns than rows: minimum norm over the rows themselves
                X = np.hstack([X_base[start:], np.stack([y_all[start - i: n - i] for i in range(1, lag + 1)], axis=1)])
                e = float(np.sum(_one_lag(X, y_all[start:], cut) ** 2))
            rows.append(_metrics_row(lag, cut, e, y_all[start + cut:]))
    return rows


def _plain_sweep(X_base: np.ndarray, y_all: np.ndarray, lags: list[int], frac: float) -> list[tuple]:
    """Rows of the sweep where nulls stand anywhere: each lag count from its own rows."""
    n, rows = len(y_all), []
    for L in lags:
        lagged = np.full((n, L), np.nan)
        for i in range(1, min(L, n - 1) + 1):
            lagged[i:, i - 1] = y_all[:-i]
        X = np.hstack([X_base, lagged])
        keep = ~np.isnan(X).any(axis=1) & ~np.isnan(y_all)
        X, y = X[keep], y_all[keep]
        n_train = int(np.floor(len(y) * frac))
        if n_train < 1 or len(y) - n_train < 1:
            rows.append((L, n_train, len(y) - n_train, None, None))
            continue
        rows.append(_metrics_row(L, n_train, float(np.sum(_one_lag(X, y, n_train) ** 2)), y[n_train:]))
    return rows


def sweep_one_stock(X_base: np.ndarray, y_all: np.ndarray, lags: list[int], frac: float) -> list[tuple]:
    """(lag, n_train, n_test, mse, r2) for each of the ascending ``lags``, of one stock's rows by date."""
    holes = np.isnan(X_base).any(axis=1)
    begin = int(np.argmin(holes)) if not holes.all() else len(y_all)
    if begin < len(y_all) and not holes[begin:].any() and not np.isnan(y_all).any():
        return _nested_sweep(X_base, y_all, begin, lags, frac)
    return _plain_sweep(X_base, y_all, lags, frac)


def lag_sweep_per_stock(features: DataFrame, base: list[str], label: str, lags=None,
                        frac: float = 0.8) -> DataFrame:
    """(Stock, lag, n_train, n_test, mse, r2) for every stock and lag value.

    Per stock, rows are ordered by Date; lags are row lags of the label; rows
    with any null are dropped; the first ``floor(frac*n)`` rows train a
    min-max-scaled OLS, the rest test it.
    """
    lags = sorted(set(lags or LAG_VALUES))  # the reference runs lag 30 twice; once is enough
    data = features.select("Date", "Stock", *[F.col(f"`{c}`").cast("double").alias(c) for c in [*base, label]])
    fields = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in SWEEP_FIELDS])

    def fn(rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows["Date"], null_placement="at_end").to_numpy()  # a stable sort
        column = lambda c: rows[c].to_numpy()[order]  # noqa: E731  (null: NaN)
        found = sweep_one_stock(np.stack([column(c) for c in base], axis=1), column(label), lags, frac)
        out = pa.Table.from_arrays([pa.array(v, f.type, from_pandas=True) for v, f in zip(zip(*found), fields)], schema=fields)
        return out.add_column(0, "Stock", pa.repeat(rows["Stock"][0], len(found)))

    schema = T.StructType([features.schema["Stock"], *SWEEP_FIELDS])  # a key or a ticker
    return data.groupBy("Stock").applyInArrow(fn, schema)


def lag_sweep_summary(per_stock: DataFrame) -> DataFrame:
    """Mean (over stocks) mse and r2 per lag value: the lag-vs-metric table."""
    return per_stock.groupBy("lag").agg(
        F.avg("mse").alias("avg_mse"), F.avg("r2").alias("avg_r2"), F.count("mse").alias("n_stocks")
    )
