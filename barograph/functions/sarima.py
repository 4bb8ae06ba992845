"""Seasonal ARIMA on one bounded window of values, by conditional sum of squares."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np

from barograph.params import SarimaParams

_LIMIT = 0.98
_FINEST_STEP = 1e-3
Z_95 = 1.959963984540054


@dataclass(frozen=True)
class SarimaFit:
    """Expanded lag polynomials of a fitted model; index = lag, entry 0 is 1."""

    ar: np.ndarray
    ma: np.ndarray
    diff: np.ndarray
    theta: np.ndarray
    sigma: float


def difference_polynomial(d: int, seasonal_d: int, season: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^season)^D."""
    poly = np.array([1.0])
    step = np.zeros(season + 1)
    step[0], step[-1] = 1.0, -1.0
    for factor in [np.array([1.0, -1.0])] * d + [step] * seasonal_d:
        poly = np.convolve(poly, factor)
    return poly


def lag_polynomials(thetas: np.ndarray, params: SarimaParams, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Expanded AR and MA polynomials, one row per parameter vector."""
    (p, _, q), (sp, _, sq) = params.order, params.seasonal_order
    phi, th, sphi, sth = np.split(np.atleast_2d(thetas).astype(float), np.cumsum([p, q, sp]), axis=1)

    def expand(near: np.ndarray, far: np.ndarray, sign: float) -> np.ndarray:
        one = np.ones((len(near), 1))
        near, far = np.hstack([one, sign * near]), np.hstack([one, sign * far])
        poly = np.zeros((len(near), near.shape[1] + season * (far.shape[1] - 1)))
        for j in range(far.shape[1]):
            poly[:, j * season : j * season + near.shape[1]] += near * far[:, j : j + 1]
        return poly

    return expand(phi, sphi, -1.0), expand(th, sth, 1.0)


def innovations(w: np.ndarray, ars: np.ndarray, mas: np.ndarray, season: int = 1) -> np.ndarray:
    """Innovations of each candidate (column), with zero values before the sample.

    ``w`` is one series for all candidates, or a column for each. Lags of a season and more reach back before the
    current season, so their part is computed for a whole season at once; only the short lags go step by step.
    """
    n, width = len(w), len(ars)
    w = w.reshape(n, -1)
    u = np.zeros((n, width))
    for lag in np.flatnonzero(np.abs(ars).max(axis=0)):
        if lag < n:
            u[lag:] += w[: n - lag] * ars[:, lag]
    lags = [int(lag) for lag in np.flatnonzero(np.abs(mas).max(axis=0)) if lag > 0]
    near, far = [lag for lag in lags if lag < season], [lag for lag in lags if lag >= season]
    weights = {lag: np.ascontiguousarray(mas[:, lag]) for lag in lags}
    pad = max(lags, default=0)
    e, product_ = np.zeros((pad + n, width)), np.empty(width)
    for begin in range(pad, pad + n, season):
        end = min(begin + season, pad + n)
        part = u[begin - pad : end - pad]
        for lag in far:
            part -= weights[lag] * e[begin - lag : end - lag]
        for t in range(begin, end):
            now = part[t - begin]
            for lag in near:
                now -= np.multiply(weights[lag], e[t - lag], out=product_)
            e[t] = now
    return e[pad:]


#: Columns whose innovations are computed at once: few enough for a processor's cache.
_WIDTH = 4096


def _aligned(series: list[np.ndarray]) -> np.ndarray:
    """One column per series, all ending in the last row; zeros before a shorter one, as before any sample."""
    out = np.zeros((max(map(len, series)), len(series)))
    for i, x in enumerate(series):
        out[len(out) - len(x) :, i] = x
    return out


def fit(values: np.ndarray, params: SarimaParams, season: int) -> SarimaFit | None:
    """Fit by a coarse grid and then ever finer grids around the best point."""
    return fit_many([values], params, season)[0]


def fit_many(samples: list[np.ndarray], params: SarimaParams, season: int) -> list[SarimaFit | None]:
    """``fit`` of many samples side by side: each has its own grids, but the steps in time are shared."""
    (p, d, q), (sp, sd, sq) = params.order, params.seasonal_order
    diff = difference_polynomial(d, sd, season)
    k = p + q + sp + sq
    values = [x[~np.isnan(x)] for x in (np.asarray(v, float) for v in samples)]
    fits = [i for i, x in enumerate(values) if len(x) >= params.min_rows and len(x) - len(diff) + 1 >= 8]
    models: list[SarimaFit | None] = [None] * len(samples)
    if not fits:
        return models
    differenced = [np.convolve(values[i], diff, "valid") for i in fits]
    w = _aligned(differenced)

    def costs(of: np.ndarray, thetas: np.ndarray) -> np.ndarray:
        """Sums of squares by (sample, candidate); ``thetas`` are by (sample, candidate, parameter)."""
        many, out = thetas.shape[1], np.empty(thetas.shape[:2])
        at_once = max(1, _WIDTH // many)
        for i in range(0, len(of), at_once):
            part = slice(i, i + at_once)
            rows = np.repeat(w[:, of[part]], many, axis=1)
            e = innovations(rows, *lag_polynomials(thetas[part].reshape(rows.shape[1], k), params, season), season)
            out[part] = np.square(e, out=e).sum(axis=0).reshape(-1, many)
        return np.where(np.isfinite(out), out, np.inf)

    ticks = np.linspace(-0.9, 0.9, 13) if k <= 2 else np.array([-0.6, 0.0, 0.6])
    grid = np.array(list(product(ticks, repeat=k))) if k else np.zeros((1, 0))
    every = np.arange(len(fits))
    found = costs(every, np.broadcast_to(grid, (len(fits), *grid.shape)))
    best, low = grid[found.argmin(axis=1)], found.min(axis=1)
    reach = 2 if k <= 2 else 1
    offsets = np.arange(-reach, reach + 1) / (reach + 1)
    moves = np.array(list(product(offsets, repeat=k)))
    step = np.full(len(fits), ticks[1] - ticks[0] if k else 0.0)
    while len(on := np.flatnonzero(step > _FINEST_STEP)):
        near = np.clip(best[on, None] + moves * step[on, None, None], -_LIMIT, _LIMIT)
        found = costs(on, near)
        at, lowest = found.argmin(axis=1), found.min(axis=1)
        better = lowest < low[on]
        best[on[better]], low[on[better]] = near[better, at[better]], lowest[better]
        # A best point on the rim may have better ones beyond it: stay at this step.
        moved = better & (np.abs(moves[at]).max(axis=1) == np.abs(offsets).max())
        step[on[~moved]] /= reach + 1
    ars, mas = lag_polynomials(best, params, season)
    for i, at in enumerate(fits):
        models[at] = SarimaFit(ars[i], mas[i], diff, best[i], float(np.sqrt(low[i] / len(differenced[i]))))
    return models


def next_values(model: SarimaFit, x: np.ndarray, e: np.ndarray, steps: int) -> np.ndarray:
    """Forecast ``steps`` values after observed ``x`` with innovations ``e``."""
    full = np.convolve(model.ar, model.diff)
    x, e, out = list(x), list(e), []
    for _ in range(steps):
        value = -sum(full[lag] * x[-lag] for lag in np.flatnonzero(full) if 0 < lag <= len(x))
        value += sum(model.ma[lag] * e[-lag] for lag in np.flatnonzero(model.ma) if 0 < lag <= len(e))
        out.append(value)
        x.append(value)
        e.append(0.0)
    return np.array(out)


def observed_innovations(model: SarimaFit, x: np.ndarray) -> np.ndarray:
    w = np.convolve(x, model.diff, "valid")
    return innovations(w, model.ar[None, :], model.ma[None, :])[:, 0]


def spread_of(model: SarimaFit, steps: int) -> np.ndarray:
    """Standard error of the 1..steps ahead forecasts."""
    full = np.convolve(model.ar, model.diff)
    psi = np.zeros(steps)
    for j in range(steps):
        psi[j] = model.ma[j] if j < len(model.ma) else 0.0
        psi[j] -= sum(full[i] * psi[j - i] for i in range(1, min(j, len(full) - 1) + 1))
    return model.sigma * np.sqrt(np.cumsum(psi**2))


def one_step_forecasts(models: list[SarimaFit], histories: list[np.ndarray], aheads: list[np.ndarray]) -> list[np.ndarray]:
    """Forecast each value of ``aheads`` from everything before it; missing values are skipped.

    The models have the same orders and season; each goes on from the history of its own.
    """
    histories = [x[~np.isnan(x)] for x in histories]
    ars, mas = np.array([m.ar for m in models]), np.array([m.ma for m in models])
    w = [np.convolve(x, m.diff, "valid") for x, m in zip(histories, models, strict=True)]
    past = innovations(_aligned(w), ars, mas)
    full = np.array([np.convolve(m.ar, m.diff) for m in models])
    begin, steps, every = max(full.shape[1], mas.shape[1], *map(len, histories)), max(map(len, aheads)), np.arange(len(models))
    x, e = np.zeros((begin + steps, len(models))), np.zeros((begin + steps, len(models)))
    known = _aligned(histories)
    x[begin - len(known) : begin], e[begin - len(past) : begin] = known, past
    ahead, out = np.full((steps, len(models)), np.nan), np.empty((steps, len(models)))
    for i, values in enumerate(aheads):
        ahead[: len(values), i] = values
    end = np.full(len(models), begin)

    def weighted(coefficients: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(models))
        for lag in np.flatnonzero(coefficients.any(axis=0)):
            if lag:
                c = coefficients[:, lag]
                total = total + np.where(c != 0, c * values[end - lag, every], 0.0)
        return total

    for i in range(steps):
        out[i] = -weighted(full, x) + weighted(mas, e)
        seen = ~np.isnan(ahead[i])
        e[end[seen], every[seen]], x[end[seen], every[seen]] = (ahead[i] - out[i])[seen], ahead[i, seen]
        end = end + seen
    return [out[: len(values), i] for i, values in enumerate(aheads)]
