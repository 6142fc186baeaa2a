"""Count distributions as vectorised numpy kernels, used inside Spark tasks.

Quantiles come from the closed form of the distribution function (incomplete beta or gamma), so one method serves every
mean and dispersion, and no mass is cut off.
"""

from __future__ import annotations

import math

import numpy as np

TINY = 1e-300
#: Rounding must not push an exact value of the distribution function to the next count.
EDGE = 1e-12
#: Counts looked up singly before the grid of a quantile search widens, and the ratio of its steps from there.
SINGLE, STEP = 64, 1.1
#: Below this argument the incomplete beta function is close to an incomplete gamma one and is summed as such: the fraction
#: in 1 - x has lost the digits of x.
SMALL = 1e-4

# Rational approximation of the normal distribution function to double precision.
_NUMERATOR = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
              221.213596169931, 220.206867912376)
_DENOMINATOR = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
                637.333633378831, 793.826512519948, 440.413735824752)
# Coefficients of the asymptotic series of log gamma.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def normal_cdf(z: np.ndarray) -> np.ndarray:
    x = np.abs(np.asarray(z, float))
    density = np.exp(-0.5 * np.minimum(x, 39.0) ** 2)
    near = density * np.polyval(_NUMERATOR, x) / np.polyval(_DENOMINATOR, x)
    far = np.maximum(x, 1.0)
    tail = density / (far + 1 / (far + 2 / (far + 3 / (far + 4 / (far + 0.65))))) / math.sqrt(2 * math.pi)
    lower = np.where(x < 7.07, near, tail)
    return np.where(np.asarray(z) > 0, 1 - lower, lower)


def _series(x: np.ndarray) -> np.ndarray:
    """log gamma(x) less its leading term (x - 1/2) log x - x + log(2 pi) / 2, for x >= 10."""
    out, square = np.zeros_like(x), x * x
    power = x.copy()
    for c in _STIRLING:
        out += c / power
        power *= square
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    big = x.copy()
    for _ in range(10):
        small = big < 10
        shift = np.where(small, shift + np.log(np.where(small, big, 1.0)), shift)
        big = np.where(small, big + 1, big)
    return (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + _series(big) - shift


def log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log B(a, b); the large terms of log gamma cancel before they are formed."""
    small, big = np.minimum(a, b), np.maximum(a, b)
    exact = log_gamma(big) - log_gamma(small + big)
    big_ = np.maximum(big, 10.0)
    ratio = small / big_
    far = -(big_ - 0.5) * np.log1p(ratio) - small * np.log(small + big_) + small + _series(big_) - _series(small + big_)
    return log_gamma(small) + np.where(big >= 10, far, exact)


def _fraction(first: np.ndarray, terms, start: float = 1.0) -> np.ndarray:
    """Continued fraction by the modified Lentz method, each element until it has converged."""
    c, d = np.full_like(first, start), 1 / np.where(np.abs(first) > TINY, first, TINY)
    total, at, m = d.copy(), np.arange(len(first)), 0
    while len(at):
        m += 1
        if m > 10_000_000:
            raise ArithmeticError("a distribution function did not converge")
        for numerator, constant in terms(m, at):
            d_ = constant + numerator * d[at]
            d_ = 1 / np.where(np.abs(d_) > TINY, d_, TINY)
            c_ = constant + numerator / c[at]
            c_ = np.where(np.abs(c_) > TINY, c_, TINY)
            c[at], d[at] = c_, d_
            total[at] *= c_ * d_
        at = at[np.abs(c_ * d_ - 1) >= 1e-14]
    return total


def incomplete_beta(a, b, x, y=None) -> np.ndarray:
    """Regularised incomplete beta function, element by element; ``y`` is 1 - x where that is known exactly."""
    a, b, x = (np.atleast_1d(np.asarray(v, float)) for v in (a, b, x))
    a, b, x, y = np.broadcast_arrays(a, b, x, 1 - x if y is None else np.asarray(y, float))
    turn = x > (a + 1) / (a + b + 2)
    p, q = np.where(turn, b, a), np.where(turn, a, b)
    s, t = np.where(turn, y, x), np.where(turn, x, y)
    inside = (s > 0) & (t > 0)
    s_, t_ = np.where(inside, s, 0.5), np.where(inside, t, 0.5)
    log_t = np.where(s_ < 0.5, np.log1p(-s_), np.log(t_))
    log_s = np.where(t_ < 0.5, np.log1p(-t_), np.log(s_))
    front = np.exp(p * log_s + q * log_t - log_beta(p, q)) / p

    def terms(m, at):
        pa, qa, sa = p[at], q[at], s_[at]
        # Ratios, as the products may pass the largest number.
        even = m / (pa + 2 * m - 1) * ((qa - m) / (pa + 2 * m)) * sa
        odd = -(pa + m) / (pa + 2 * m) * ((pa + qa + m) / (pa + 2 * m + 1)) * sa
        return ((even, 1.0), (odd, 1.0))

    summed = turn & (x > 0) & (x < SMALL) & (b >= 10)
    s_ = np.where(summed, 0.0, s_)
    value = front * _fraction(1 - (p + q) * s_ / (p + 1), terms)
    value = np.where(inside, value, np.where(s > 0, 1.0, 0.0))
    value = np.where(turn, 1 - value, value)
    if summed.any():
        value[summed] = _beta_series(a[summed], b[summed], x[summed])
    return value


def _beta_series(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function for small ``x`` above the mean, by its series of positive terms.

    The leading factor is that of the gamma function at x (a + b), with the large terms taken out.
    """
    z = x * (a + b)
    a_ = np.maximum(a, 10.0)
    off = (z - a_) / a_
    large = -a_ * (off - np.log1p(np.maximum(off, -1 + 1e-16))) + 0.5 * np.log(a_ / (2 * math.pi)) - _series(a_)
    gamma = np.where(a >= 10, large, a * np.log(z) - z - log_gamma(a))
    rest = (b - 0.5) * np.log1p(a / b) - a + b * np.log1p(-x) + z - _series(b) + _series(a + b)
    log_front = gamma + rest - np.log(a)
    out = np.ones_like(z)  # as far above the mean as where the factor vanishes
    some = np.flatnonzero(log_front > -600)
    a, b, x, front = a[some], b[some], x[some], np.exp(log_front[some])
    term, total = np.ones_like(a), np.ones_like(a)
    at, n = np.arange(len(a)), 0
    while len(at):
        term[at] *= (a[at] + b[at] + n) / (a[at] + 1 + n) * x[at]
        total[at] += term[at]
        n += 1
        at = at[term[at] > total[at] * 1e-16]
    out[some] = np.minimum(front * total, 1.0)
    return out


def upper_gamma(a, x) -> np.ndarray:
    """Regularised upper incomplete gamma function, element by element."""
    a, x = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, float)) for v in (a, x)))
    # x^a e^-x / gamma(a), with the large terms of log gamma taken out for large a.
    a_ = np.maximum(a, 10.0)
    off = (x - a_) / a_
    big = -a_ * (off - np.log1p(np.maximum(off, -1 + 1e-16))) + 0.5 * np.log(a_ / (2 * math.pi)) - _series(a_)
    front = np.exp(np.where(a >= 10, big, a * np.log(x) - x - log_gamma(a)))
    out = np.empty_like(front)
    high = x >= a + 1
    if high.any():
        ah, xh = a[high], x[high]
        even = lambda m, at: ((m * (ah[at] - m), xh[at] + 2 * m + 1 - ah[at]),)
        out[high] = front[high] * _fraction(xh + 1 - ah, even, 1 / TINY)
    if not high.all():
        al, xl = a[~high], x[~high]
        term, total = 1 / al, 1 / al
        at, k = np.arange(len(al)), 0
        while len(at):
            k += 1
            term[at] *= xl[at] / (al[at] + k)
            total[at] += term[at]
            at = at[term[at] > total[at] * 1e-16]
        out[~high] = 1 - front[~high] * total
    return out


def count_cdf(k, mean, r) -> np.ndarray:
    """P(count <= k) of a negative binomial with this mean and dispersion ``r``; ``r = inf`` is Poisson.

    An infinite mean leaves no finite count any mass; an undefined argument gives an undefined value.
    """
    k, mean, r = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, float)) for v in (k, mean, r)))
    out = np.where(k == np.inf, 1.0, 0.0)
    out[np.isnan(k) | np.isnan(mean) | np.isnan(r)] = np.nan
    for poisson in (True, False):
        here = (k >= 0) & np.isfinite(k) & np.isfinite(mean) & (np.isinf(r) if poisson else np.isfinite(r))
        if not here.any():
            continue
        if poisson:
            out[here] = upper_gamma(k[here] + 1, mean[here])
        else:
            total = r[here] + mean[here]
            out[here] = incomplete_beta(r[here], k[here] + 1, r[here] / total, mean[here] / total)
    return out


def count_quantiles(u, mean, r) -> np.ndarray:
    """Smallest k with P(count <= k) >= u, element by element, among the numbers that doubles can hold.

    Infinite for an infinite mean, undefined where an argument is.
    """
    u, mean, r = np.broadcast_arrays(*(np.atleast_1d(np.asarray(v, float)) for v in (u, mean, r)))
    low, high = np.full(u.shape, -1.0), np.floor(mean)
    high[np.isnan(u) | np.isnan(r)] = np.nan
    at = np.arange(len(u))
    while len(at):
        short = count_cdf(high[at], mean[at], r[at]) < u[at] - EDGE
        at = at[short]
        low[at], high[at] = high[at], 2 * high[at] + 1
    return _bisect(u, mean, r, low, high)


def _bisect(u, mean, r, low, high) -> np.ndarray:
    low, high = low.copy(), high.copy()
    at = np.flatnonzero((high - low > 1) & np.isfinite(high))
    while len(at):
        mid = np.floor(low[at] + (high[at] - low[at]) / 2)
        between = (mid > low[at]) & (mid < high[at])  # whole numbers are further than 1 apart above 2 ** 53
        at, mid = at[between], mid[between]
        enough = count_cdf(mid, mean[at], r[at]) >= u[at] - EDGE
        high[at[enough]] = mid[enough]
        low[at[~enough]] = mid[~enough]
        at = at[high[at] - low[at] > 1]
    return high


def law_quantiles(u: np.ndarray, mean: float, r: float) -> np.ndarray:
    """``count_quantiles`` for many ``u`` of one law: a grid of counts first, then bisection between its points."""
    u = np.asarray(u, float)
    top = count_quantiles(np.array([u.max()]), mean, r)[0]
    if not np.isfinite(top):
        return count_quantiles(u, mean, r)
    steps = max(0, math.ceil(math.log(max(top, 1) / SINGLE) / math.log(STEP))) + 1
    grid = np.unique(np.minimum(np.concatenate((np.arange(SINGLE), np.floor(SINGLE * STEP ** np.arange(steps)), [top])), top))
    at = np.searchsorted(count_cdf(grid, mean, r), u - EDGE, side="left")
    at = np.minimum(at, len(grid) - 1)
    before = np.concatenate(([-1.0], grid))
    return _bisect(u, np.full(u.shape, mean), np.full(u.shape, r), before[at], grid[at])
