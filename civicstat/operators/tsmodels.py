"""Per-series model fits used inside ``applyInPandas`` (numpy only).

Each function receives one short series (months or days of one scope),
never a whole table. Deviations D5/D10: same model classes and contracts
as the reference's libraries, own estimators, values not digit for digit.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

Z95 = 1.959963984540054   # two-sided 95 % normal quantile
Z80 = 1.2815515655446004  # two-sided 80 % normal quantile
KPSS_CRIT_5PCT = 0.463    # level-stationarity critical value at 5 %
MIN_KPSS_ROWS = 8         # a test on fewer rows says nothing


# ------------------------------------------------------------------ ARIMA
def _kpss(x: np.ndarray) -> float:
    n = len(x)
    e = x - x.mean()
    s = np.cumsum(e)
    lags = int(math.ceil(12 * (n / 100.0) ** 0.25)) if n >= 4 else 0
    lags = min(lags, n - 1)
    s2 = float(e @ e) / n
    for k in range(1, lags + 1):
        s2 += 2.0 * (1 - k / (lags + 1)) * float(e[k:] @ e[:-k]) / n
    if s2 <= 0:
        return 0.0
    return float(s @ s) / (n * n * s2)


def _choose_d(y: np.ndarray, max_d: int = 2, min_rows: int = MIN_KPSS_ROWS) -> int:
    """Differences until the level is stationary; a series of ``min_rows`` or
    fewer is too short to test and stays as it is."""
    d, x = 0, y.astype(float)
    while d < max_d and len(x) > min_rows and np.ptp(x) > 0 and _kpss(x) > KPSS_CRIT_5PCT:
        x = np.diff(x)
        d += 1
    return d


def _lags(v: np.ndarray, k: int, start: int) -> np.ndarray:
    return np.column_stack([v[start - i:len(v) - i] for i in range(1, k + 1)]) if k else np.empty((len(v) - start, 0))


def _innovations(x: np.ndarray, m: int) -> np.ndarray:
    """Residuals of a long autoregression of order ``m``; 0 before it starts."""
    e = np.zeros(len(x))
    if m:
        X = np.column_stack([np.ones(len(x) - m), _lags(x, m, m)])
        e[m:] = x[m:] - X @ np.linalg.lstsq(X, x[m:], rcond=None)[0]
    return e


def _stable(coefs: np.ndarray) -> bool:
    """Whether all roots of 1 - c1 z - c2 z^2 - ... lie outside the unit circle."""
    return not len(coefs) or bool(np.all(np.abs(np.roots([1.0, *(-coefs)])) < 1.0))


def _fit_arma(x: np.ndarray, e: np.ndarray, p: int, q: int, const: bool, start: int):
    """Least squares on lags of x and of the innovations, from row ``start`` on."""
    cols = [_lags(x, p, start), _lags(e, q, start)]
    if const:
        cols.insert(0, np.ones((len(x) - start, 1)))
    X = np.column_stack(cols)
    b = np.linalg.lstsq(X, x[start:], rcond=None)[0] if p or q else np.full(X.shape[1], x[start:].mean())
    resid = x[start:] - X @ b
    nobs, k = len(resid), X.shape[1] + 1
    sigma2 = float(resid @ resid) / nobs
    off = 1 if const else 0
    phi, theta = b[off:off + p], b[off + p:off + p + q]
    if not _stable(-theta):
        raise ValueError("not invertible")
    floor = 1e-12 * max(float(x @ x) / len(x), np.finfo(float).tiny)  # relative, so units do not matter
    aicc = nobs * math.log(max(sigma2, floor)) + 2 * k + (2 * k * (k + 1)) / max(nobs - k - 1, 1)
    full_e = np.zeros(len(x))
    full_e[start:] = resid
    return dict(c=b[0] if const else 0.0, phi=phi, theta=theta, sigma2=sigma2, aicc=aicc, e=full_e, order=(p, q), stationary=_stable(phi))


def _select_arma(x: np.ndarray, const: bool, max_p: int, max_q: int, stationary: bool = True) -> dict | None:
    """The order of least AICc, by default of the stationary ones. All orders are scored on the same rows, those
    that the largest one leaves; a short series tries fewer orders."""
    n = len(x)
    while True:
        m = min(max(max_p + max_q + 2, int(round(math.log(max(n, 2)) ** 2))), n // 3) if max_q else 0
        start = max(max_p, max_q) + m
        if n - start >= max_p + max_q + 3:
            break
        if not max_p and not max_q:
            return None
        max_p, max_q = (max_p - 1, max_q) if max_p >= max_q else (max_p, max_q - 1)
    e, best = _innovations(x, m), None
    for p in range(max_p + 1):
        for q in range(max_q + 1):
            try:
                f = _fit_arma(x, e, p, q, const, start)
            except (ValueError, np.linalg.LinAlgError):
                continue
            if (f["stationary"] or not stationary) and (best is None or f["aicc"] < best["aicc"]):
                best = f
    return best


def arima_forecast(y: np.ndarray, steps: int, max_p: int = 5, max_q: int = 2):
    """Non-seasonal ARIMA with automatic (p, d, q) by AICc; 95 % interval."""
    y = np.asarray(y, dtype=float)
    d = _choose_d(y)
    x = np.diff(y, n=d) if d else y.copy()
    best = _select_arma(x, d < 2, max_p, max_q, stationary=False)
    while best is not None and not best["stationary"] and d < 2:  # a unit root: difference once more
        d, x = d + 1, np.diff(x)
        best = _select_arma(x, d < 2, max_p, max_q, stationary=False)
    if best is not None and not best["stationary"]:
        best = _select_arma(x, d < 2, max_p, max_q)
    if best is None:
        raise ValueError("no ARIMA order could be fitted")
    phi, theta, c = best["phi"], best["theta"], best["c"]
    xs, es = list(x), list(best["e"])
    for _ in range(steps):
        v = c + sum(phi[i] * xs[-1 - i] for i in range(len(phi))) \
            + sum(theta[j] * es[-1 - j] for j in range(len(theta)))
        xs.append(v)
        es.append(0.0)
    fx = np.array(xs[len(x):])
    fy = fx
    hist = y
    for k in range(d, 0, -1):  # undo differencing level by level
        last = np.diff(hist, n=k - 1)[-1] if k > 1 else hist[-1]
        fy = last + np.cumsum(fy)
    # psi weights of the integrated model for the forecast variance
    ar = np.array([1.0, *(-phi)])
    for _ in range(d):
        ar = np.convolve(ar, [1.0, -1.0])
    psi = np.zeros(steps)
    psi[0] = 1.0
    for j in range(1, steps):
        acc = theta[j - 1] if j - 1 < len(theta) else 0.0
        for i in range(1, min(j, len(ar) - 1) + 1):
            acc -= ar[i] * psi[j - i]
        psi[j] = acc
    se = np.sqrt(best["sigma2"] * np.cumsum(psi ** 2))
    if not (np.isfinite(fy).all() and np.isfinite(se).all()):
        raise ValueError("the forecast is not finite")
    return fy, fy - Z95 * se, fy + Z95 * se


# ----------------------------------------------------------- additive model
def _additive_design(t: np.ndarray, months: np.ndarray, changepoints: np.ndarray, order: int,
                     extra: np.ndarray | None = None):
    cols = [np.ones_like(t), t]
    if extra is not None:
        cols.append(np.asarray(extra, dtype=float))
    cols += [np.maximum(0.0, t - c) for c in changepoints]
    ang = 2 * np.pi * (months - 1) / 12.0
    for k in range(1, order + 1):
        cols += [np.sin(k * ang), np.cos(k * ang)]
    return np.column_stack(cols)


def additive_forecast(y: np.ndarray, ds: pd.Series, steps: int, n_changepoints: int = 5,
                      order: int = 3, ridge: float = 1.0, regressor: np.ndarray | None = None):
    """Piecewise-linear trend + yearly Fourier terms, ridge fit; 80 % interval.

    ``regressor`` (optional, length n + steps) is an extra column such as the
    number of holidays in each month; its future values must be known.
    """
    y = np.asarray(y, dtype=float)
    n = len(y)
    scale = max(np.abs(y).max(), 1.0)
    t = np.arange(n, dtype=float) / max(n - 1, 1)
    months = pd.DatetimeIndex(ds).month.to_numpy()
    ncp = min(n_changepoints, max(n // 4, 0))
    cps = np.linspace(0, 0.8, ncp + 2)[1:-1] if ncp else np.array([])
    reg_hist = None if regressor is None else np.asarray(regressor, dtype=float)[:n]
    reg_fut = None if regressor is None else np.asarray(regressor, dtype=float)[n:n + steps]
    X = _additive_design(t, months, cps, order, reg_hist)
    off = 2 + (regressor is not None)
    pen = np.zeros(X.shape[1])
    pen[off:off + len(cps)] = ridge
    pen[off + len(cps):] = ridge * 0.01
    beta = np.linalg.solve(X.T @ X + np.diag(pen), X.T @ (y / scale))
    resid = y / scale - X @ beta
    sigma = float(np.sqrt(resid @ resid / max(n - X.shape[1], 1)))
    last = pd.Timestamp(pd.DatetimeIndex(ds)[-1])
    fut = pd.DatetimeIndex([last + pd.DateOffset(months=i + 1) for i in range(steps)])
    tf = (n - 1 + np.arange(1, steps + 1)) / max(n - 1, 1)
    Xf = _additive_design(tf, fut.month.to_numpy(), cps, order, reg_fut)
    pred = Xf @ beta * scale
    width = Z80 * sigma * scale * np.sqrt(1 + np.arange(1, steps + 1) / n)
    return pred, pred - width, pred + width


# ------------------------------------------------------------- logistic fit
def _logistic(t, k, t0):
    return 1.0 / (1.0 + np.exp(np.clip(-k * (t - t0), -700, 700)))


def _profile_L(y, g, lo):
    den = float(g @ g)
    return max(lo, float(y @ g) / den) if den > 0 else lo


def logistic_fit(y: np.ndarray):
    """Least-squares fit of L / (1 + e^(−k(t−t0))) with L ≥ max(y), 0 ≤ k ≤ 1.

    L is profiled out (closed form for fixed k, t0); (k, t0) start from a
    grid and are refined by projected Gauss–Newton steps.
    """
    y = np.asarray(y, dtype=float)
    n = len(y)
    ymax = float(y.max())
    if n < 3 or ymax <= 0:
        raise ValueError("series too short or empty")
    ys = y / ymax
    t = np.arange(n, dtype=float)

    def sse(k, t0):
        g = _logistic(t, k, t0)
        L = _profile_L(ys, g, 1.0)
        r = ys - L * g
        return float(r @ r), L

    best = (float("inf"), 0.01, n / 2.0)
    for k in np.geomspace(1e-4, 1.0, 25):
        for t0 in np.linspace(-0.5 * n, 2.5 * n, 31):
            s, _ = sse(k, t0)
            if s < best[0]:
                best = (s, k, t0)
    s0, k, t0 = best
    lam = 1e-3
    for _ in range(200):
        g = _logistic(t, k, t0)
        L = _profile_L(ys, g, 1.0)
        r = ys - L * g
        dg = g * (1 - g)
        J = np.column_stack([L * dg * (t - t0), -L * dg * k])
        A = J.T @ J
        step = np.linalg.solve(A + lam * np.diag(np.diag(A) + 1e-12), J.T @ r)
        k1 = min(max(k + step[0], 0.0), 1.0)
        t1 = t0 + step[1]
        s1, _ = sse(k1, t1)
        if s1 < s0:
            if s0 - s1 < 1e-14 * max(s0, 1e-30):
                k, t0, s0 = k1, t1, s1
                break
            k, t0, s0 = k1, t1, s1
            lam = max(lam / 3, 1e-9)
        else:
            lam *= 4
            if lam > 1e8:
                break
    _, L = sse(k, t0)
    return L * ymax, k, t0
