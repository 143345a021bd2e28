"""Numeric helpers run inside tasks (numpy only; no scipy in the image).

* Student-t two-sided tail by a power series of the incomplete beta integral;
* Kendall tau-b with tie corrections and its asymptotic two-sided p-value;
* two-sample Kolmogorov-Smirnov statistic with an exact lattice-path p-value
  for small samples and the Kolmogorov limit otherwise;
* Benjamini-Yekutieli adjustment (reference form for tests; the Spark job
  uses window functions, see ``operators.select``).

Sources: Kendall 1945; Benjamini & Yekutieli 2001; the series follows from
expanding the integrand of the incomplete beta integral.
"""

from __future__ import annotations

import math

import numpy as np

# -- Student t ------------------------------------------------------------------


def _beta_share(a: np.ndarray, b: np.ndarray, x: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """I_x(a, b) as x^a (1-x)^b / (a B(a, b)) times the sum over k of the
    products of (a+b+i) / (a+1+i) x, i < k; every term is positive.  ``rest``: 1-x."""
    log_beta = np.array([math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q) for p, q in zip(a, b)])
    term, total, k = np.ones_like(x), np.ones_like(x), 0
    while np.any(term > 1e-17 * total) and k < 200_000:
        term = term * x * (a + b + k) / (a + 1 + k)
        total = total + term
        k += 1
    with np.errstate(divide="ignore"):
        return np.exp(a * np.log(x) + b * np.log(rest) - log_beta) / a * total


def t_two_sided_p(t, df):
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    t, df = (np.array(v, dtype=float) for v in np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float)))
    out = np.full(t.shape, np.nan)
    valid = ~np.isnan(t) & (df > 0)
    out[valid & np.isinf(t)] = 0.0
    out[valid & (t == 0)] = 1.0
    usual = valid & np.isfinite(t) & (t != 0)
    square = np.where(usual, t, 0.0) ** 2
    whole = np.where(usual, df + square, 1.0)
    share, rest = square / whole, df / whole
    near = usual & (np.abs(t) <= 4)        # here 1 - p is far enough from 1; beyond, the tail itself
    tail = usual & ~near
    half = np.full(t.shape, 0.5)
    out[near] = 1.0 - _beta_share(half[near], df[near] / 2, share[near], rest[near])
    out[tail] = _beta_share(df[tail] / 2, half[tail], rest[tail], share[tail])
    return out


# -- Kendall tau-b --------------------------------------------------------------


def _count_inversions(a: np.ndarray) -> int:
    """Pairs i < j with a[i] > a[j]: bottom-up merge counting, vectorised per level.

    At level w the array holds sorted runs of length w; for each element of a
    right run, the left-run elements greater than it are the inversions that
    cross the two runs.  One stable sort per level, O(n log^2 n) in numpy.
    """
    vals = np.asarray(a, dtype=float).copy()
    n = len(vals)
    idx = np.arange(n)
    inv = 0
    w = 1
    while w < n:
        block = idx // (2 * w)
        right = (idx // w) % 2 == 1
        order = np.lexsort((right, vals, block))     # by block, value, lefts first on ties
        lab, blk = right[order], block[order]
        left_cum = np.cumsum(~lab)
        start = np.searchsorted(blk, blk, side="left")
        before = left_cum[start] - (~lab[start])
        left_le = left_cum - before
        left_size = np.minimum(w, n - blk * 2 * w)
        inv += int(np.sum(left_size[lab] - left_le[lab]))
        vals = vals[order]
        w *= 2
    return inv


def _tie_stats(v: np.ndarray):
    _, counts = np.unique(v, return_counts=True)
    c = counts.astype(float)
    return (c * (c - 1) / 2).sum(), (c * (c - 1) * (c - 2)).sum(), (c * (c - 1) * (2 * c + 5)).sum()


def kendall_tau_b(x, y):
    """Kendall's tau-b and its asymptotic two-sided p-value (tie-corrected variance).

    Returns ``(tau, p)``; ``(nan, nan)`` when either variable is constant or n < 2.
    """
    x = np.asarray(x, dtype=float)
    y = np.asarray(y, dtype=float)
    n = len(x)
    if n < 2:
        return math.nan, math.nan
    order = np.lexsort((y, x))
    xs, ys = x[order], y[order]
    tot = n * (n - 1) / 2
    xtie, x0, x1 = _tie_stats(xs)
    ytie, y0, y1 = _tie_stats(ys)
    # joint ties: pairs equal in both
    pairs = np.stack([xs, ys], axis=1)
    _, jc = np.unique(pairs, axis=0, return_counts=True)
    ntie = float((jc * (jc - 1) / 2).sum())
    dis = _count_inversions(ys)  # pairs ordered by x (ties by y) with y decreasing
    con_minus_dis = tot - xtie - ytie + ntie - 2 * dis
    denom = math.sqrt((tot - xtie) * (tot - ytie)) if (tot - xtie) > 0 and (tot - ytie) > 0 else 0.0
    if denom == 0:
        return math.nan, math.nan
    tau = min(1.0, max(-1.0, con_minus_dis / denom))
    m = n * (n - 1)
    var = (m * (2 * n + 5) - x1 - y1) / 18 + 2 * xtie * ytie / m
    if n > 2:
        var += x0 * y0 / (9 * m * (n - 2))
    if var <= 0:
        return tau, math.nan
    z = abs(con_minus_dis) / math.sqrt(var)
    return tau, math.erfc(z / math.sqrt(2))


# -- two-sample Kolmogorov-Smirnov -------------------------------------------------


def ks_2samp(a, b, method: str = "exact"):
    """Two-sided two-sample KS: ``(D, p)``, see :func:`ks_p_value`."""
    a = np.sort(np.asarray(a, dtype=float))
    b = np.sort(np.asarray(b, dtype=float))
    n1, n2 = len(a), len(b)
    if n1 == 0 or n2 == 0:
        return math.nan, math.nan
    allv = np.concatenate([a, b])
    cdf1 = np.searchsorted(a, allv, side="right").astype(np.int64)
    cdf2 = np.searchsorted(b, allv, side="right").astype(np.int64)
    h = int(np.max(np.abs(cdf1 * n2 - cdf2 * n1)))
    return h / (n1 * n2), ks_p_value(n1, n2, h, method)


def ks_p_value(n1: int, n2: int, h: int, method: str = "exact") -> float:
    """p of the distance ``D = h / (n1 n2)``.

    ``exact``: the probability that a uniformly random monotone lattice path
    from (0,0) to (n1,n2) reaches ``|i*n2 - j*n1| >= h`` (integer comparisons, no
    float ties), by a sweep over its diagonals; ``asymptotic``: the Kolmogorov
    limit with the effective-n correction.  The caller chooses; sizes do not.
    """
    if method == "exact":
        return _ks_exact_p(n1, n2, h)
    if method != "asymptotic":
        raise ValueError(f"method must be 'exact' or 'asymptotic': {method!r}")
    en = math.sqrt(n1 * n2 / (n1 + n2))
    return _kolmogorov_q((en + 0.12 + 0.11 / en) * h / (n1 * n2))


def _ks_exact_p(n1: int, n2: int, h: int) -> float:
    """1 - P(path stays strictly inside |i*n2 - j*n1| < h), swept by anti-diagonals."""
    if h <= 0:
        return 1.0
    prob = np.array([1.0])            # diagonal s = 0: state (0, 0)
    lo_prev = 0
    for s_ in range(1, n1 + n2 + 1):
        lo, hi = max(0, s_ - n2), min(n1, s_)
        i = np.arange(lo, hi + 1)
        j = s_ - i
        cur = np.zeros(len(i))
        # from (i-1, j): a step in i, taken with prob (n1-(i-1)) / remaining
        src = i - 1 - lo_prev
        ok = (i - 1 >= lo_prev) & (src < len(prob)) & (i >= 1)
        rem = (n1 + n2 - (s_ - 1))
        cur[ok] += prob[src[ok]] * (n1 - (i[ok] - 1)) / rem
        # from (i, j-1): a step in j
        src2 = i - lo_prev
        ok2 = (j >= 1) & (src2 >= 0) & (src2 < len(prob))
        cur[ok2] += prob[src2[ok2]] * (n2 - (j[ok2] - 1)) / rem
        cur[np.abs(i * n2 - j * n1) >= h] = 0.0
        prob, lo_prev = cur, lo
    inside = float(prob[-1]) if len(prob) else 0.0
    return float(min(1.0, max(0.0, 1.0 - inside)))


def _kolmogorov_q(lam: float) -> float:
    if lam < 1e-10:
        return 1.0
    s, sign = 0.0, 1.0
    for k in range(1, 101):
        term = sign * 2.0 * math.exp(-2.0 * k * k * lam * lam)
        s += term
        if abs(term) < 1e-16:
            break
        sign = -sign
    return float(min(1.0, max(0.0, s)))


# -- Benjamini-Yekutieli ------------------------------------------------------------


def by_adjust(p) -> np.ndarray:
    """BY-adjusted p-values (dependent tests): ``min(1, min_{j>=i} p_(j) m c(m) / j)``."""
    p = np.asarray(p, dtype=float)
    m = len(p)
    if m == 0:
        return p
    cm = sum(1.0 / i for i in range(1, m + 1))
    order = np.argsort(p, kind="stable")
    ranked = p[order] * m * cm / np.arange(1, m + 1)
    adj = np.minimum.accumulate(ranked[::-1])[::-1]
    out = np.empty(m)
    out[order] = np.minimum(adj, 1.0)
    return out
