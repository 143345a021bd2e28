"""Feature calculators that need the window's values as an array.

Each calculator maps one window (a 1-d float array) and a parameter dict to
a float (NaN when undefined).  They run inside ``applyInPandas`` tasks on
blocks of one series (see ``tsengine.plans.extract``); nothing here touches
Spark.  Formulas follow the public definitions of the feature library the
reference calls; the signal-processing pieces (Ricker wavelet transform,
Welch density, ridge-line peak search, Levinson-Durbin, ADF with AIC lag
choice and MacKinnon p-values) are re-derived from their published
descriptions.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd

# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------


def _into_subchunks(x, length, every=1):
    n = len(x)
    shifts = (n - length) // every + 1
    if shifts <= 0:
        return np.empty((0, length))
    idx = np.arange(length)[None, :] + (every * np.arange(shifts))[:, None]
    return np.asarray(x)[idx]


def _ricker(points, a):
    A = 2 / (np.sqrt(3 * a) * (np.pi ** 0.25))
    vec = np.arange(0, points) - (points - 1.0) / 2
    xsq = vec ** 2
    return A * (1 - xsq / a ** 2) * np.exp(-xsq / (2 * a ** 2))


def _cwt(x, widths):
    out = np.empty((len(widths), len(x)))
    for i, w in enumerate(widths):
        n = int(min(10 * w, len(x)))
        wav = _ricker(n, w)[::-1]
        out[i] = np.convolve(x, wav, mode="same")
    return out


def _welch(x, nperseg):
    """One-sided Welch density: periodic Hann window, half overlap, mean detrend."""
    x = np.asarray(x, dtype=float)
    step = nperseg - nperseg // 2
    win = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg) if nperseg > 1 else np.ones(1)
    scale = 1.0 / (win * win).sum() if (win * win).sum() > 0 else 1.0
    starts = range(0, len(x) - nperseg + 1, step)
    acc = None
    k = 0
    for s in starts:
        seg = x[s:s + nperseg]
        seg = (seg - seg.mean()) * win
        p = np.abs(np.fft.rfft(seg)) ** 2 * scale
        acc = p if acc is None else acc + p
        k += 1
    pxx = acc / k
    if nperseg % 2 == 0:
        pxx[1:-1] *= 2
    else:
        pxx[1:] *= 2
    return pxx


def _acf_adjusted(x, nlags):
    x = np.asarray(x, dtype=float)
    n = len(x)
    d = x - x.mean()
    full = np.correlate(d, d, mode="full")[n - 1:]
    acov = full / (n - np.arange(n))
    return acov[:nlags + 1] / acov[0]


def _linregress(xv, yv):
    """slope, intercept, rvalue, pvalue, stderr of y on x (population moments)."""
    from tsengine.functions.stats import t_two_sided_p
    xv = np.asarray(xv, dtype=float)
    yv = np.asarray(yv, dtype=float)
    n = len(xv)
    if n < 2 or np.isnan(yv).any():
        return (math.nan,) * 5
    xm, ym = xv.mean(), yv.mean()
    ssxm = ((xv - xm) ** 2).mean()
    ssym = ((yv - ym) ** 2).mean()
    ssxym = ((xv - xm) * (yv - ym)).mean()
    r = 0.0 if ssxm == 0 or ssym == 0 else max(-1.0, min(1.0, ssxym / math.sqrt(ssxm * ssym)))
    slope = ssxym / ssxm if ssxm != 0 else math.nan
    intercept = ym - slope * xm
    if n == 2:
        p = 1.0 if yv[0] == yv[1] else 0.0
        stderr = 0.0
    else:
        df = n - 2
        t = r * math.sqrt(df / ((1.0 - r + 1e-20) * (1.0 + r + 1e-20)))
        p = float(t_two_sided_p(t, df))
        stderr = math.sqrt((1 - r ** 2) * ssym / ssxm / df)
    return slope, intercept, r, p, stderr


def _binned_entropy(x, max_bins):
    x = np.asarray(x, dtype=float)
    if x.size == 0 or not np.isfinite(x).all():
        return math.nan
    hist, _ = np.histogram(x, bins=max_bins)
    probs = hist / x.size
    probs[probs == 0] = 1.0
    return float(-np.sum(probs * np.log(probs)))


def _norm_cdf(z):
    return 0.5 * math.erfc(-z / math.sqrt(2))


# ---------------------------------------------------------------------------
# ADF (constant, AIC lag choice) and MacKinnon approximate p-value
# ---------------------------------------------------------------------------

# MacKinnon (1994) response-surface constants, constant-only
# regression, one series (bounds, switch point, small-p and large-p polynomials).
_TAU_MAX_C = 2.74
_TAU_MIN_C = -18.83
_TAU_STAR_C = -1.61
_TAU_C_SMALLP = (2.1659, 1.4412, 3.8269e-02)
_TAU_C_LARGEP = (1.7339, 9.3202e-01, -1.2745e-01, -1.0368e-02)


def _mackinnon_p(stat):
    if stat > _TAU_MAX_C:
        return 1.0
    if stat < _TAU_MIN_C:
        return 0.0
    coef = _TAU_C_SMALLP if stat <= _TAU_STAR_C else _TAU_C_LARGEP
    return _norm_cdf(sum(c * stat ** i for i, c in enumerate(coef)))


def _ols(y, X):
    beta, _, rank, _ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    ssr = float(resid @ resid)
    n, k = X.shape
    return beta, ssr, rank, n, k


def _adf(x):
    x = np.asarray(x, dtype=float)
    nobs = len(x)
    maxlag = int(math.ceil(12.0 * (nobs / 100.0) ** 0.25))
    maxlag = min(nobs // 2 - 1 - 1, maxlag)
    if maxlag < 0:
        return (math.nan,) * 3
    xdiff = np.diff(x)

    def design(lag):
        rows = len(xdiff) - lag
        if rows <= 0:
            return None, None
        cols = [x[lag:lag + rows]]  # level x_{t-1}
        for j in range(1, lag + 1):
            cols.append(xdiff[lag - j:lag - j + rows])
        return np.column_stack(cols), xdiff[lag:]

    full, y_full = design(maxlag)
    if full is None:
        return (math.nan,) * 3
    n = len(y_full)
    best = None
    for lag in range(0, maxlag + 1):
        X = np.column_stack([np.ones(n), full[:, :lag + 1]])
        if n <= X.shape[1]:
            continue
        _, ssr, _, nn, k = _ols(y_full, X)
        if ssr <= 0:
            aic = -math.inf
        else:
            llf = -nn / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nn) + 1)
            aic = -2 * llf + 2 * k
        if best is None or aic < best[0]:
            best = (aic, lag)
    if best is None:
        return (math.nan,) * 3
    lag = best[1]
    X, y = design(lag)
    X = np.column_stack([X, np.ones(len(y))])
    if len(y) <= X.shape[1]:
        return (math.nan,) * 3
    beta, ssr, rank, nn, k = _ols(y, X)
    if rank < k:
        return (math.nan,) * 3
    sigma2 = ssr / (nn - k)
    cov = sigma2 * np.linalg.inv(X.T @ X)
    if cov[0, 0] <= 0:
        return (math.nan,) * 3
    stat = beta[0] / math.sqrt(cov[0, 0])
    return stat, _mackinnon_p(stat), float(lag)


# ---------------------------------------------------------------------------
# ridge-line peak search on the wavelet transform
# ---------------------------------------------------------------------------


def _cwt_peaks(x, n):
    """Ridges of the wavelet transform over widths 1..n that count as peaks.

    A ridge starts at a local maximum (over time) of a coarse scale and is
    followed to finer ones: each scale's maxima extend the nearest ridge within
    a quarter of the width, or start one; a ridge idle for more than one scale
    ends.  It counts if it spans a quarter of the scales and its finest point is
    at least the local noise (10th percentile of the finest scale around it).
    """
    if len(x) == 0:
        return 0
    scales = _cwt(np.asarray(x, dtype=float), np.arange(1, n + 1, dtype=float))
    tip, idle, length, finest = (np.empty(0, np.int64) for _ in range(4))
    done: list[np.ndarray] = []
    for level in range(n - 1, -1, -1):
        y = scales[level]
        top = np.ones(len(y), bool)
        top[1:] &= y[1:] > y[:-1]
        top[:-1] &= y[:-1] > y[1:]
        top[[0, -1]] = False                                   # a border has one neighbour only
        at = np.flatnonzero(top)
        idle = idle + 1
        if len(tip) and len(at):
            gap = np.abs(at[:, None] - tip)
            own = gap.argmin(axis=1)
            joined = gap[np.arange(len(at)), own] <= (level + 1) / 4
            length += np.bincount(own[joined], minlength=len(tip))
            tip[own[joined]], finest[own[joined]], idle[own[joined]] = at[joined], level, 0
            at = at[~joined]
        tip, idle = np.append(tip, at), np.append(idle, np.zeros(len(at), np.int64))
        length, finest = np.append(length, np.ones(len(at), np.int64)), np.append(finest, np.full(len(at), level))
        ended = idle > 1
        done.append(np.stack([length, finest, tip])[:, ended])
        tip, idle, length, finest = (v[~ended] for v in (tip, idle, length, finest))
    done.append(np.stack([length, finest, tip]))
    length, finest, tip = np.concatenate(done, axis=1)
    long = length >= math.ceil(n / 4)
    width = math.ceil(scales.shape[1] / 20)
    count = 0
    for level, at in zip(finest[long], tip[long]):
        around = scales[0, max(at - width // 2, 0):at + width // 2 + width % 2]
        with np.errstate(divide="ignore", invalid="ignore"):
            count += not abs(scales[level, at] / np.percentile(around, 10)) < 1
    return count


def _template_matches(x, m, tolerance):
    """For each run of m values, how many other runs stay within the tolerance
    at every place; by the distance between the two runs, in O(n) memory."""
    n = len(x) - m + 1
    out = np.zeros(max(n, 0), np.int64)
    for shift in range(1, n):
        close = np.abs(x[shift:] - x[:-shift]) <= tolerance
        both = close[:n - shift].copy()
        for k in range(1, m):
            both &= close[k:k + n - shift]
        out[:n - shift] += both
        out[shift:] += both
    return out


# ---------------------------------------------------------------------------
# calculators: fn(x, params) -> float
# ---------------------------------------------------------------------------


def _mean_std(x):
    return x.mean(), x.std()


def f_median(x, p):
    return float(np.median(x))


def f_quantile(x, p):
    return float(np.quantile(x, p["q"]))


def f_symmetry_looking(x, p):
    return float(abs(x.mean() - np.median(x)) < p["r"] * (x.max() - x.min()))


def f_has_duplicate(x, p):
    return float(x.size != np.unique(x).size)


def _longest_run(mask):
    best = run = 0
    for v in mask:
        run = run + 1 if v else 0
        best = max(best, run)
    return float(best)


def f_longest_strike_below_mean(x, p):
    return _longest_run(x < x.mean()) if x.size else 0.0


def f_longest_strike_above_mean(x, p):
    return _longest_run(x > x.mean()) if x.size else 0.0


def f_count_above_mean(x, p):
    return float(np.sum(x > x.mean()))


def f_count_below_mean(x, p):
    return float(np.sum(x < x.mean()))


def f_percentage_of_reoccurring_values_to_all_values(x, p):
    _, counts = np.unique(x, return_counts=True)
    return float(np.sum(counts > 1) / counts.shape[0]) if counts.shape[0] else math.nan


def f_percentage_of_reoccurring_datapoints_to_all_datapoints(x, p):
    if x.size == 0:
        return math.nan
    _, counts = np.unique(x, return_counts=True)
    return float(counts[counts > 1].sum() / x.size)


def f_sum_of_reoccurring_values(x, p):
    u, counts = np.unique(x, return_counts=True)
    return float(np.sum(u[counts > 1]))


def f_sum_of_reoccurring_data_points(x, p):
    u, counts = np.unique(x, return_counts=True)
    return float(np.sum((u * counts)[counts > 1]))


def f_ratio_value_number_to_time_series_length(x, p):
    return float(np.unique(x).size / x.size) if x.size else math.nan


def f_sample_entropy(x, p):
    """-ln of the share of pairs of runs of 2 that also match as runs of 3."""
    tolerance = 0.2 * np.std(x)
    pairs, longer = (int(_template_matches(x, m, tolerance).sum()) for m in (2, 3))
    if not pairs:
        return math.nan
    return -math.log(longer / pairs) if longer else math.inf


def f_benford_correlation(x, p):
    ax = np.abs(np.nan_to_num(x))
    digits = np.array([int(np.format_float_scientific(v)[:1]) for v in ax])
    benford = np.log10(1 + 1 / np.arange(1, 10))
    data = np.array([(digits == d).mean() for d in range(1, 10)])
    if data.std() == 0:
        return math.nan
    return float(np.corrcoef(benford, data)[0, 1])


def f_agg_autocorrelation(x, p):
    n = len(x)
    if np.abs(np.var(x)) < 1e-10 or n == 1:
        a = np.zeros(n)
    else:
        a = _acf_adjusted(x, min(p["maxlag"], n - 1))[1:]
    a = a[:p["maxlag"]]
    if len(a) == 0:
        return math.nan
    return float({"mean": np.mean, "median": np.median, "var": np.var}[p["f_agg"]](a))


def f_partial_autocorrelation(x, p):
    lag = p["lag"]
    n = len(x)
    if n <= 1:
        return math.nan
    max_lag = min(9 if lag <= 9 else lag, n // 2 - 1) if n > 2 else 0
    if lag > max_lag:
        return math.nan
    if lag == 0:
        return 1.0
    r = _acf_adjusted(x, max_lag) if np.var(x) > 0 else None
    if r is None:
        return math.nan
    # Levinson-Durbin recursion on the autocorrelations
    phi = np.zeros((max_lag + 1, max_lag + 1))
    pac = np.ones(max_lag + 1)
    phi[1, 1] = r[1]
    pac[1] = r[1]
    sig = 1 - r[1] ** 2
    for k in range(2, max_lag + 1):
        num = r[k] - np.dot(phi[k - 1, 1:k], r[1:k][::-1])
        if sig == 0:
            return math.nan
        phi[k, k] = num / sig
        phi[k, 1:k] = phi[k - 1, 1:k] - phi[k, k] * phi[k - 1, 1:k][::-1]
        sig *= 1 - phi[k, k] ** 2
        pac[k] = phi[k, k]
    return float(pac[lag])


def f_number_cwt_peaks(x, p):
    return float(_cwt_peaks(x, p["n"]))


def f_number_peaks(x, p):
    n = p["n"]
    if len(x) <= 2 * n:
        return 0.0
    core = x[n:-n]
    res = np.ones(len(core), dtype=bool)
    for i in range(1, n + 1):
        res &= core > np.roll(x, i)[n:-n]
        res &= core > np.roll(x, -i)[n:-n]
    return float(np.sum(res))


def f_binned_entropy(x, p):
    return _binned_entropy(x, p["max_bins"])


def f_index_mass_quantile(x, p):
    ax = np.abs(x)
    s = ax.sum()
    if s == 0:
        return math.nan
    mass = np.cumsum(ax) / s
    return float((np.argmax(mass >= p["q"]) + 1) / len(x))


def f_cwt_coefficients(x, p):
    widths = tuple(p["widths"])
    if p["coeff"] >= len(x):
        return math.nan
    i = widths.index(p["w"])
    n = int(min(10 * widths[i], len(x)))
    wav = _ricker(n, widths[i])[::-1]
    return float(np.convolve(x, wav, mode="same")[p["coeff"]])


def f_spkt_welch_density(x, p):
    pxx = _welch(x, min(len(x), 256))
    return float(pxx[p["coeff"]]) if len(pxx) > p["coeff"] else math.nan


def f_ar_coefficient(x, p):
    k, c = p["k"], p["coeff"]
    if c > k:
        return math.nan
    n = len(x)
    rows = n - k
    if rows < k + 1:
        return math.nan
    X = np.column_stack([np.ones(rows)] + [x[k - j:n - j] for j in range(1, k + 1)])
    y = x[k:]
    beta, _, rank, _ = np.linalg.lstsq(X, y, rcond=None)
    if rank < X.shape[1]:
        return math.nan
    return float(beta[c])


def _corridor(x, ql, qh):
    """Values inside the quantile corridor ``[q(ql), q(qh)]`` (first quantile bin,
    lowest edge included); None when the two edges coincide (no corridor)."""
    lo, hi = np.quantile(x, [ql, qh])
    if not lo < hi:
        return None
    return (x >= lo) & (x <= hi)


def f_change_quantiles(x, p):
    ql, qh = p["ql"], p["qh"]
    if ql >= qh:
        return 0.0
    div = np.diff(x)
    if p["isabs"]:
        div = np.abs(div)
    inside = _corridor(x, ql, qh)
    if inside is None:
        return 0.0
    ind = (inside & np.roll(inside, 1))[1:]
    if np.sum(ind) == 0:
        return 0.0
    return float(getattr(np, p["f_agg"])(div[ind]))


def f_fft_coefficient(x, p):
    fft = np.fft.rfft(x)
    k = p["coeff"]
    if k >= len(fft):
        return math.nan
    v = fft[k]
    a = p["attr"]
    if a == "real":
        return float(v.real)
    if a == "imag":
        return float(v.imag)
    if a == "abs":
        return float(abs(v))
    return float(np.angle(v, deg=True))


def f_fft_aggregated(x, p):
    y = np.abs(np.fft.rfft(x))
    if y.sum() == 0:
        return math.nan

    def moment(k):
        return y.dot(np.arange(len(y), dtype=float) ** k) / y.sum()

    c = moment(1)
    var = moment(2) - c ** 2
    t = p["aggtype"]
    if t == "centroid":
        return float(c)
    if t == "variance":
        return float(var)
    if var < 0.5:
        return math.nan
    if t == "skew":
        return float((moment(3) - 3 * c * var - c ** 3) / var ** 1.5)
    return float((moment(4) - 4 * c * moment(3) + 6 * moment(2) * c ** 2 - 3 * c) / var ** 2)


def f_approximate_entropy(x, p):
    """Difference of the mean log shares of matching runs of m and m + 1 values."""
    if x.size <= p["m"] + 1:
        return 0.0
    mean_log = []
    for m in (p["m"], p["m"] + 1):
        share = (_template_matches(x, m, p["r"] * np.std(x)) + 1) / (x.size - m + 1)     # a run matches itself
        mean_log.append(float(np.log(share).mean()))
    return abs(mean_log[0] - mean_log[1])


def _friedrich(x, m, r):
    """Polynomial of degree m through the mean steps of r equally filled value classes."""
    none = [math.nan] * (m + 1)
    if len(x) < 2:
        return none
    here, step = np.asarray(x[:-1], float), np.diff(x)
    edges = np.percentile(here, 100 * np.linspace(0, 1, r + 1))
    if np.any(np.diff(edges) <= 0):
        return none
    cls = np.maximum(np.searchsorted(edges, here, "left") - 1, 0)
    size = np.bincount(cls, minlength=r)
    some = size > 0
    if some.sum() < 1:
        return none
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # ill-conditioned fits still return coefficients
        try:
            return list(np.polyfit(np.bincount(cls, here, r)[some] / size[some],
                                   np.bincount(cls, step, r)[some] / size[some], m))
        except np.linalg.LinAlgError:
            return none


def f_friedrich_coefficients(x, p):
    coeffs = _friedrich(x, p["m"], p["r"])
    return float(coeffs[p["coeff"]]) if p["coeff"] < len(coeffs) else math.nan


def f_max_langevin_fixed_point(x, p):
    coeffs = _friedrich(x, p["m"], p["r"])
    if any(np.isnan(coeffs)):
        return math.nan
    try:
        return float(np.max(np.real(np.roots(coeffs))))
    except (np.linalg.LinAlgError, ValueError):
        return math.nan


def f_agg_linear_trend(x, p):
    cl = p["chunk_len"]
    if cl >= len(x):
        return math.nan
    s = pd.Series(x)
    chunks = [getattr(s.iloc[i * cl:(i + 1) * cl], p["f_agg"])() for i in range(int(math.ceil(len(x) / cl)))]
    slope, intercept, r, pv, se = _linregress(np.arange(len(chunks)), np.asarray(chunks, dtype=float))
    return float({"slope": slope, "intercept": intercept, "rvalue": r, "pvalue": pv, "stderr": se}[p["attr"]])


def f_augmented_dickey_fuller(x, p):
    stat, pv, lag = _adf(x)
    return float({"teststat": stat, "pvalue": pv, "usedlag": lag}[p["attr"]])


def f_energy_ratio_by_chunks(x, p):
    full = np.sum(x ** 2)
    if full == 0:
        return math.nan
    return float(np.sum(np.array_split(x, p["num_segments"])[p["segment_focus"]] ** 2.0) / full)


def f_ratio_beyond_r_sigma(x, p):
    return float(np.sum(np.abs(x - x.mean()) > p["r"] * np.std(x)) / x.size)


def f_lempel_ziv_complexity(x, p):
    """Phrases of the incremental parsing of the binned values, per value: a
    phrase is the shortest run not seen as a phrase yet (kept in a tree)."""
    edges = np.linspace(np.min(x), np.max(x), p["bins"] + 1)[1:]
    tree: dict = {}
    node, phrases = tree, 0
    for symbol in np.searchsorted(edges, x, side="left").tolist():
        if symbol in node:
            node = node[symbol]
        else:
            node[symbol] = {}
            node, phrases = tree, phrases + 1
    return phrases / len(x)


def f_fourier_entropy(x, p):
    pxx = _welch(x, min(len(x), 256))
    mx = np.max(pxx)
    if mx == 0 or not np.isfinite(mx):
        return math.nan
    return _binned_entropy(pxx / mx, p["bins"])


def f_permutation_entropy(x, p):
    X = _into_subchunks(x, p["dimension"], p["tau"])
    if len(X) == 0:
        return math.nan
    perms = np.argsort(np.argsort(X, kind="stable"), kind="stable")
    _, counts = np.unique(perms, axis=0, return_counts=True)
    probs = counts / len(perms)
    return float(-np.sum(probs * np.log(probs)))


def f_query_similarity_count(x, p):
    return math.nan  # undefined without a query


def f_mean_n_absolute_max(x, p):
    k = p["number_of_maxima"]
    return float(np.mean(np.sort(np.abs(x))[-k:])) if len(x) > k else math.nan


# -- the running-sum calculators, per window (used for bounded windows, where a
#    window is a slice of a halo block rather than a prefix) --------------------

def f_sum_values(x, p):
    return float(x.sum())


def f_mean(x, p):
    return float(x.mean())


def f_length(x, p):
    return float(len(x))


def f_standard_deviation(x, p):
    return float(x.std())


def f_variance(x, p):
    return float(x.var())


def f_root_mean_square(x, p):
    return float(math.sqrt((x * x).mean()))


def f_maximum(x, p):
    return float(x.max())


def f_minimum(x, p):
    return float(x.min())


def f_absolute_maximum(x, p):
    return float(np.abs(x).max())


def f_abs_energy(x, p):
    return float((x * x).sum())


def f_absolute_sum_of_changes(x, p):
    return float(np.abs(np.diff(x)).sum())


def f_mean_abs_change(x, p):
    return float(np.abs(np.diff(x)).mean()) if len(x) > 1 else math.nan


def f_mean_change(x, p):
    return float((x[-1] - x[0]) / (len(x) - 1)) if len(x) > 1 else math.nan


def f_mean_second_derivative_central(x, p):
    n = len(x)
    return float((x[-1] - x[-2] - x[1] + x[0]) / (2 * (n - 2))) if n > 2 else math.nan


def f_variation_coefficient(x, p):
    m = x.mean()
    return float(x.std() / m) if m != 0 else math.nan


def f_variance_larger_than_standard_deviation(x, p):
    v = x.var()
    return float(v > math.sqrt(v))


def f_skewness(x, p):
    v = pd.Series(x).skew()
    return float(v) if v is not None else math.nan


def f_kurtosis(x, p):
    v = pd.Series(x).kurt()
    return float(v) if v is not None else math.nan


def f_large_standard_deviation(x, p):
    return float(x.std() > p["r"] * (x.max() - x.min()))


def f_cid_ce(x, p):
    if p["normalize"]:
        s = x.std()
        if s == 0:
            return 0.0
        x = (x - x.mean()) / s
    return float(math.sqrt((np.diff(x) ** 2).sum()))


def f_c3(x, p):
    k, n = p["lag"], len(x)
    if 2 * k >= n:
        return 0.0
    return float(np.mean(x[2 * k:] * x[k:n - k] * x[:n - 2 * k]))


def f_time_reversal_asymmetry_statistic(x, p):
    k, n = p["lag"], len(x)
    if 2 * k >= n:
        return 0.0
    a, b, c = x[2 * k:], x[k:n - k], x[:n - 2 * k]
    return float(np.mean(a * a * b - b * c * c))


def f_autocorrelation(x, p):
    k, n = p["lag"], len(x)
    if n <= k:
        return math.nan
    v = x.var()
    if abs(v) <= 1e-8:
        return math.nan
    m = x.mean()
    return float(np.sum((x[:n - k] - m) * (x[k:] - m)) / ((n - k) * v))


def f_value_count(x, p):
    return float(np.sum(x == p["value"]))


def f_range_count(x, p):
    return float(np.sum((x >= p["min"]) & (x < p["max"])))


def f_count_above(x, p):
    return float(np.sum(x >= p["t"]) / len(x))


def f_count_below(x, p):
    return float(np.sum(x <= p["t"]) / len(x))


def f_number_crossing_m(x, p):
    return float(np.where(np.diff(x > p["m"]))[0].size)


def f_first_location_of_maximum(x, p):
    return float(np.argmax(x) / len(x))


def f_last_location_of_maximum(x, p):
    return float(1.0 - np.argmax(x[::-1]) / len(x))


def f_first_location_of_minimum(x, p):
    return float(np.argmin(x) / len(x))


def f_last_location_of_minimum(x, p):
    return float(1.0 - np.argmin(x[::-1]) / len(x))


def f_has_duplicate_max(x, p):
    return float(np.sum(x == x.max()) >= 2)


def f_has_duplicate_min(x, p):
    return float(np.sum(x == x.min()) >= 2)


def f_linear_trend(x, p):
    res = dict(zip(("slope", "intercept", "rvalue", "pvalue", "stderr"), _linregress(np.arange(len(x)), x)))
    return float(res[p["attr"]])


CALCULATORS = {name[2:]: fn for name, fn in globals().items() if name.startswith("f_") and callable(fn)}


# ---------------------------------------------------------------------------
# batch evaluation: calculators whose parameter grid shares one expensive step
# (a transform, a fit) compute that step once per window
# ---------------------------------------------------------------------------

def _m_fft_coefficient(x, plist):
    fft = np.fft.rfft(x)
    out = []
    for p in plist:
        k = p["coeff"]
        if k >= len(fft):
            out.append(math.nan)
            continue
        v = fft[k]
        a = p["attr"]
        out.append(float(v.real if a == "real" else v.imag if a == "imag" else abs(v) if a == "abs"
                         else np.angle(v, deg=True)))
    return out


def _m_cwt_coefficients(x, plist):
    rows = {}
    out = []
    for p in plist:
        if p["coeff"] >= len(x):
            out.append(math.nan)
            continue
        w = p["w"]
        if w not in rows:
            n = int(min(10 * w, len(x)))
            rows[w] = np.convolve(x, _ricker(n, w)[::-1], mode="same")
        out.append(float(rows[w][p["coeff"]]))
    return out


def _m_spkt_welch_density(x, plist):
    pxx = _welch(x, min(len(x), 256))
    return [float(pxx[p["coeff"]]) if len(pxx) > p["coeff"] else math.nan for p in plist]


def _m_fourier_entropy(x, plist):
    pxx = _welch(x, min(len(x), 256))
    mx = np.max(pxx)
    if mx == 0 or not np.isfinite(mx):
        return [math.nan] * len(plist)
    return [_binned_entropy(pxx / mx, p["bins"]) for p in plist]


def _m_ar_coefficient(x, plist):
    fits = {}
    out = []
    for p in plist:
        k, c = p["k"], p["coeff"]
        if k not in fits:
            n = len(x)
            rows = n - k
            beta = None
            if rows >= k + 1:
                X = np.column_stack([np.ones(rows)] + [x[k - j:n - j] for j in range(1, k + 1)])
                b, _, rank, _ = np.linalg.lstsq(X, x[k:], rcond=None)
                beta = b if rank == X.shape[1] else None
            fits[k] = beta
        beta = fits[k]
        out.append(math.nan if beta is None or c > k else float(beta[c]))
    return out


def _m_partial_autocorrelation(x, plist):
    n = len(x)
    max_lag = max(p["lag"] for p in plist)
    usable = min(max_lag, n // 2 - 1) if n > 2 else 0
    pac = np.full(max_lag + 1, math.nan)
    if n > 1:
        pac[0] = 1.0
    if usable >= 1 and np.var(x) > 0:
        r = _acf_adjusted(x, usable)
        phi_prev = np.array([r[1]])
        pac[1] = r[1]
        sig = 1 - r[1] ** 2
        for k in range(2, usable + 1):
            if sig == 0:
                break
            a = (r[k] - np.dot(phi_prev, r[1:k][::-1])) / sig
            phi_prev = np.concatenate([phi_prev - a * phi_prev[::-1], [a]])
            sig *= 1 - a ** 2
            pac[k] = a
    return [float(pac[p["lag"]]) for p in plist]


def _m_agg_autocorrelation(x, plist):
    n = len(x)
    maxlag = max(p["maxlag"] for p in plist)
    if np.abs(np.var(x)) < 1e-10 or n == 1:
        a = np.zeros(n)
    else:
        a = _acf_adjusted(x, min(maxlag, n - 1))[1:]
    out = []
    for p in plist:
        b = a[:p["maxlag"]]
        out.append(math.nan if len(b) == 0 else
                   float({"mean": np.mean, "median": np.median, "var": np.var}[p["f_agg"]](b)))
    return out


def _m_agg_linear_trend(x, plist):
    fits = {}
    s = pd.Series(x)
    out = []
    for p in plist:
        cl, fa = p["chunk_len"], p["f_agg"]
        if cl >= len(x):
            out.append(math.nan)
            continue
        if (cl, fa) not in fits:
            chunks = [getattr(s.iloc[i * cl:(i + 1) * cl], fa)() for i in range(int(math.ceil(len(x) / cl)))]
            fits[(cl, fa)] = dict(zip(("slope", "intercept", "rvalue", "pvalue", "stderr"),
                                      _linregress(np.arange(len(chunks)), np.asarray(chunks, dtype=float))))
        out.append(float(fits[(cl, fa)][p["attr"]]))
    return out


def _m_friedrich_coefficients(x, plist):
    fits = {}
    out = []
    for p in plist:
        key = (p["m"], p["r"])
        if key not in fits:
            fits[key] = _friedrich(x, p["m"], p["r"])
        coeffs = fits[key]
        out.append(float(coeffs[p["coeff"]]) if p["coeff"] < len(coeffs) else math.nan)
    return out


def _m_augmented_dickey_fuller(x, plist):
    stat, pv, lag = _adf(x)
    vals = {"teststat": stat, "pvalue": pv, "usedlag": lag}
    return [float(vals[p["attr"]]) for p in plist]


def _m_energy_ratio_by_chunks(x, plist):
    full = np.sum(x ** 2)
    if full == 0:
        return [math.nan] * len(plist)
    parts = {}
    out = []
    for p in plist:
        ns = p["num_segments"]
        if ns not in parts:
            parts[ns] = [np.sum(c ** 2.0) for c in np.array_split(x, ns)]
        out.append(float(parts[ns][p["segment_focus"]] / full))
    return out


def _m_change_quantiles(x, plist):
    masks = {}
    diffs = {False: np.diff(x), True: np.abs(np.diff(x))}
    out = []
    for p in plist:
        ql, qh = p["ql"], p["qh"]
        if ql >= qh:
            out.append(0.0)
            continue
        if (ql, qh) not in masks:
            inside = _corridor(x, ql, qh)
            masks[(ql, qh)] = None if inside is None else (inside & np.roll(inside, 1))[1:]
        ind = masks[(ql, qh)]
        if ind is None or np.sum(ind) == 0:
            out.append(0.0)
            continue
        out.append(float(getattr(np, p["f_agg"])(diffs[bool(p["isabs"])][ind])))
    return out


BATCHED = {name[3:]: fn for name, fn in globals().items() if name.startswith("_m_") and callable(fn)}

_ERRORS = (ValueError, ZeroDivisionError, FloatingPointError, np.linalg.LinAlgError, IndexError)


def window_values(x: np.ndarray, specs) -> list[float]:
    """All requested array features of one window, NaN where undefined."""
    out = [math.nan] * len(specs)
    groups: dict[str, list[int]] = {}
    for i, (calc, _, _) in enumerate(specs):
        groups.setdefault(calc, []).append(i)
    with np.errstate(all="ignore"):
        for calc, idx in groups.items():
            if calc in BATCHED and len(idx) > 1:
                try:
                    vals = BATCHED[calc](x, [specs[i][1] or {} for i in idx])
                except _ERRORS:
                    vals = [math.nan] * len(idx)
                for i, v in zip(idx, vals):
                    out[i] = v
                continue
            fn = CALCULATORS[calc]
            for i in idx:
                try:
                    out[i] = fn(x, specs[i][1] or {})
                except _ERRORS:
                    out[i] = math.nan
    return out
