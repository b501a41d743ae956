"""Numpy helpers for one series: the variance recursion, the t likelihood, its score and its maximiser."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

BACKCAST_ROWS = 75
BACKCAST_DECAY = 0.94
PARAMETERS = ("mu", "omega", "alpha", "beta", "nu")
MAX_STEPS, MOST_RESTARTS = 900, 4  # of a simplex search, and of a descent
# Bounds that keep the exponentials finite: omega, alpha and beta up to e^30 before scaling, nu up to 2.05 + e^6 = 405,
# where Student's t is normal for all purposes.
LARGEST_LOG, LARGEST_LOG_NU = 30.0, 6.0
LEAST_NU = 2.05
NEAREST = 1e-4  # how near to a bound a search starts
LARGEST_SCORE = 1e-3  # of a certified maximum: the size of the score, and gains in log likelihood
AT_BOUND, INWARD = 1e-6, 1e-3  # a parameter taken for 0, and what it is compared with then


def start_variance(resid: np.ndarray) -> float:
    """Exponentially weighted mean of the first squared residuals, standing in for the unseen past."""
    head = resid[:BACKCAST_ROWS] ** 2
    weights = BACKCAST_DECAY ** np.arange(len(head))
    return float(head @ weights / weights.sum())


def _accumulate(inputs: np.ndarray, decay: float) -> np.ndarray:
    """out[t] = inputs[t] + decay * out[t-1] along the last axis, summed by doubling: after the pass with stride k each
    entry holds the last 2k terms, so log2(n) vector passes do the whole series."""
    out, stride = inputs, 1
    while stride < out.shape[-1] and decay > 0.0:
        out[..., stride:] = out[..., stride:] + decay * out[..., :-stride]
        stride, decay = stride * 2, decay * decay
    return out


def variances(resid: np.ndarray, omega: float, alpha: float, beta: float) -> np.ndarray:
    """Conditional variances for every row and one step beyond the last: v[t] = omega + alpha * e[t-1]^2 + beta * v[t-1]."""
    past = start_variance(resid)
    inputs = omega + alpha * np.concatenate(([past], resid**2))
    inputs[0] += beta * past
    return _accumulate(inputs, beta)


def _unpack(z: np.ndarray, scale: float) -> tuple[float, float, float, float, float]:
    """Free coordinates -> (mu, omega, alpha, beta, nu) with alpha, beta > 0, alpha + beta < 1, nu > 2. The first one
    is mu in standard deviations, `scale` the variance."""
    a, b = math.exp(min(z[2], LARGEST_LOG)), math.exp(min(z[3], LARGEST_LOG))
    total = 1.0 + a + b
    nu = LEAST_NU + math.exp(min(z[4], LARGEST_LOG_NU))
    return z[0] * math.sqrt(scale), scale * math.exp(min(z[1], LARGEST_LOG)), a / total, b / total, nu


def _place(params: Sequence[float], scale: float) -> np.ndarray:
    """The free coordinates of parameters, a little away from their bounds, where nothing would pull."""
    mu, omega, alpha, beta, nu = params
    rest = max(1 - alpha - beta, NEAREST)
    logs = [math.log(max(x, NEAREST)) for x in (omega / scale, alpha / rest, beta / rest, nu - LEAST_NU)]
    return np.array([mu / math.sqrt(scale), logs[0], logs[1], logs[2], min(logs[3], LARGEST_LOG_NU - 1.0)])


def neg_loglik(y: np.ndarray, mu: float, omega: float, alpha: float, beta: float, nu: float) -> float:
    terms = loglik_terms(y, mu, omega, alpha, beta, nu)
    return math.inf if terms is None else -float(terms.sum())


def loglik_terms(y: np.ndarray, mu: float, omega: float, alpha: float, beta: float, nu: float) -> np.ndarray | None:
    """The log likelihood of every return given those before it; None where a variance is not above 0."""
    resid = y - mu
    v = variances(resid, omega, alpha, beta)[:-1]
    if not (v > 0).all():
        return None
    const = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(math.pi * (nu - 2))
    return const - 0.5 * np.log(v) - (nu + 1) / 2 * np.log1p(resid**2 / (v * (nu - 2)))


def digamma(x: float) -> float:
    """Derivative of lgamma: its asymptotic series above 10, reached by psi(x) = psi(x + 1) - 1 / x."""
    shift = 0.0
    while x < 10.0:
        shift, x = shift + 1.0 / x, x + 1.0
    inverse = 1.0 / (x * x)
    return math.log(x) - 0.5 / x - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252)) - shift


def scores(y: np.ndarray, mu: float, omega: float, alpha: float, beta: float, nu: float) -> np.ndarray:
    """Derivatives of every return's log likelihood by (mu, omega, alpha, beta, nu), one row per parameter.

    The variance's derivatives follow its own recursion, d[t] = input[t] + beta * d[t-1], and are summed like it.
    """
    resid = y - mu
    head = resid[:BACKCAST_ROWS]
    weights = BACKCAST_DECAY ** np.arange(len(head))
    past, past_mu = start_variance(resid), float(-2.0 * (head @ weights) / weights.sum())
    v = variances(resid, omega, alpha, beta)[:-1]
    inputs = np.empty((4, len(y)))
    inputs[0, 0], inputs[0, 1:] = (alpha + beta) * past_mu, -2.0 * alpha * resid[:-1]
    inputs[1] = 1.0
    inputs[2, 0], inputs[2, 1:] = past, resid[:-1] ** 2
    inputs[3, 0], inputs[3, 1:] = past, v[:-1]
    dv = _accumulate(inputs, beta)
    q = resid**2 / (v * (nu - 2))
    pull = (nu + 1) / 2 * q / (1 + q)
    out = np.empty((5, len(y)))
    out[:4] = (pull - 0.5) / v * dv
    out[0] += (nu + 1) * resid / (v * (nu - 2) * (1 + q))
    out[4] = 0.5 * (digamma((nu + 1) / 2) - digamma(nu / 2) - 1 / (nu - 2)) - 0.5 * np.log1p(q) + pull / (nu - 2)
    return out


def _free_scores(y: np.ndarray, z: np.ndarray, scale: float) -> np.ndarray:
    """`scores` by the free coordinates."""
    mu, omega, alpha, beta, nu = _unpack(z, scale)
    by = scores(y, mu, omega, alpha, beta, nu)
    return np.vstack([
        math.sqrt(scale) * by[0], omega * by[1] * (z[1] < LARGEST_LOG), alpha * ((1 - alpha) * by[2] - beta * by[3]) * (z[2] < LARGEST_LOG),
        beta * ((1 - beta) * by[3] - alpha * by[2]) * (z[3] < LARGEST_LOG), (nu - LEAST_NU) * by[4] * (z[4] < LARGEST_LOG_NU),
    ])


def certificate(y: np.ndarray, z: np.ndarray, scale: float, loglik: float) -> tuple[float, bool, tuple | None]:
    """(size of the score, whether this is a maximum, parameters off a bound that are better).

    The size is the sum of the absolute scores by the free coordinates: what a change of mu by a standard deviation and
    of the others by a factor of e promises, to first order, in log likelihood. At a bound the score vanishes by
    itself, so there a step inward must not gain either.
    """
    size = float(np.abs(_free_scores(y, z, scale).sum(axis=1)).sum())
    mu, omega, alpha, beta, nu = _unpack(z, scale)
    inward, room = [], 1 - 2 * INWARD
    if omega < AT_BOUND * scale:
        inward.append((mu, INWARD * scale, alpha, beta, nu))
    if alpha < AT_BOUND:
        inward.append((mu, omega, INWARD, min(beta, room), nu))
    if beta < AT_BOUND:
        inward.append((mu, omega, min(alpha, room), INWARD, nu))
    if 1 - alpha - beta < AT_BOUND:
        inward.append((mu, omega, alpha * (1 - INWARD), beta * (1 - INWARD), nu))
    gains = [(-neg_loglik(y, *params), params) for params in inward]
    best, better = max(gains, default=(-math.inf, None))
    better = better if best > loglik + LARGEST_SCORE else None
    return size, bool(math.isfinite(size) and size <= LARGEST_SCORE and better is None), better


def _climb(loss, slope, start: np.ndarray, max_steps: int = 200) -> tuple[np.ndarray, float]:
    """Quasi-Newton descent (BFGS) with step halving."""
    z, value, g = start, loss(start), slope(start)
    inverse, flat = np.eye(len(z)) / max(1.0, float(np.abs(g).max())), 0
    for _ in range(max_steps):
        step = -inverse @ g
        if g @ step >= 0:
            inverse = np.eye(len(z)) / max(1.0, float(np.abs(g).max()))
            step = -inverse @ g
        step *= min(1.0, 2.0 / max(1e-300, float(np.abs(step).max())))  # at most e^2 in any parameter
        size = 1.0
        while (found := loss(z + size * step)) > value + 1e-4 * size * (g @ step):
            size /= 2
            if size < 1e-10:
                return z, value
        moved, after = size * step, slope(z + size * step)
        turned = after - g
        z, gain, value, g = z + moved, value - found, found, after
        along = moved @ turned
        if along > 1e-12:
            left = np.eye(len(z)) - np.outer(moved, turned) / along
            inverse = left @ inverse @ left.T + np.outer(moved, moved) / along
        flat = flat + 1 if gain <= 1e-12 * (1.0 + abs(value)) else 0
        if flat == 3 or float(np.abs(g).max()) < 1e-5:
            break
    return z, value


def _simplex_search(loss, start: np.ndarray, max_steps: int = MAX_STEPS, tol: float = 1e-8) -> tuple[np.ndarray, float, bool]:
    """Nelder-Mead with the usual coefficients."""
    n = len(start)
    points = np.vstack([start] + [start + 0.4 * np.eye(n)[i] for i in range(n)])
    values = np.array([loss(p) for p in points])
    for _ in range(max_steps):
        order = np.argsort(values, kind="stable")
        points, values = points[order], values[order]
        if values[-1] - values[0] <= tol * (1.0 + abs(values[0])):
            return points[0], float(values[0]), True
        centre = points[:-1].mean(axis=0)

        def towards(t):
            candidate = centre + t * (points[-1] - centre)
            return candidate, loss(candidate)

        reflected = towards(-1.0)
        if reflected[1] < values[0]:
            chosen = min(reflected, towards(-2.0), key=lambda pv: pv[1])
        elif reflected[1] < values[-2]:
            chosen = reflected
        else:
            chosen = towards(-0.5 if reflected[1] < values[-1] else 0.5)
            if chosen[1] >= min(reflected[1], values[-1]):
                points[1:] = points[0] + 0.5 * (points[1:] - points[0])
                values[1:] = [loss(p) for p in points[1:]]
                continue
        points[-1], values[-1] = chosen
    return points[0], float(values[0]), False


@dataclass
class Fit:
    """A maximum likelihood estimate: where it is, how it is certified and what the search cost."""

    params: dict
    loglik: float
    score: float
    certified: bool
    steps: int  # likelihoods and scores computed
    place: np.ndarray = field(repr=False, default=None)


def fit(y: np.ndarray, near: Fit | None = None) -> Fit:
    """The maximum likelihood estimate, from the best of some usual starts and the estimate `near` (of a shorter window).

    The score's descent does nearly all fits in some tens of steps. Where its end is not certified it starts again off
    the bound that held it, or from where a simplex search gets.
    """
    spread = float(y.var()) if len(y) else 0.0
    if not spread > 0.0:
        raise ValueError("constant returns")
    steps = 0

    def loss(z):
        nonlocal steps
        steps += 1
        value = neg_loglik(y, *_unpack(z, spread))
        return value if math.isfinite(value) else 1e300

    def slope(z):
        nonlocal steps
        steps += 1
        return -_free_scores(y, z, spread).sum(axis=1)

    def start(alpha, persistence, nu=8.0):
        rest = 1.0 - persistence
        return np.array([
            float(y.mean()) / math.sqrt(spread), math.log(rest), math.log(alpha / rest), math.log((persistence - alpha) / rest),
            math.log(nu - LEAST_NU),
        ])

    starts = [start(a, p) for a in (0.01, 0.05, 0.1, 0.2) for p in (0.5, 0.7, 0.9, 0.98)]
    if near is not None:
        starts.append(_place([near.params[name] for name in PARAMETERS], spread))
    z, value = _climb(loss, slope, min(starts, key=loss))
    score, certified, better = certificate(y, z, spread, -value)
    for _ in range(MOST_RESTARTS):
        if certified:
            break
        if better is not None:
            z, value = _climb(loss, slope, _place(better, spread))
        else:
            z, value, _ = _simplex_search(loss, z)
            z, value = _climb(loss, slope, z)
        score, certified, better = certificate(y, z, spread, -value)
    params = dict(zip(PARAMETERS, map(float, _unpack(z, spread))))
    return Fit(params, -value, score, certified, steps, z)


def describe(y: np.ndarray, params: dict, status: str, **more) -> dict:
    v = variances(y - params["mu"], params["omega"], params["alpha"], params["beta"])
    told = {**dict.fromkeys(("loglik", "score", "steps")), **more}
    return {"status": status, **params, **told, "next_variance": float(v[-1]), "sigma": np.sqrt(v[:-1]) / 100.0}


def fit_row(y: np.ndarray, near: Fit | None = None) -> tuple[dict, Fit | None]:
    """`describe` of the fitted model, and the fit; on failure a row of nulls that says why.

    An estimate without certificate is marked `not converged`: its path and forecast are used, as they come from the
    largest likelihood found, and the mark is there for whoever wants to leave them out.
    """
    try:
        found = fit(y, near)
    except (ValueError, FloatingPointError, np.linalg.LinAlgError) as cause:
        names = (*PARAMETERS, "loglik", "score", "steps", "next_variance", "sigma")
        return {"status": f"failed: {cause}", **dict.fromkeys(names)}, None
    status = "ok" if found.certified else "not converged"
    return describe(y, found.params, status, loglik=found.loglik, score=found.score, steps=found.steps), found
