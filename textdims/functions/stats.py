"""Numeric helpers (numpy only) used inside Arrow UDFs and on p x p matrices.

No scipy is available; the few special functions needed are written here:
normal CDF / quantile, bivariate normal CDF (Gauss-Legendre on the
correlation integral), tetrachoric correlation by bisection, regularized
incomplete beta (continued fraction) for F-test p-values.
"""

from __future__ import annotations

import math

import numpy as np

_SQRT2 = math.sqrt(2.0)


def norm_cdf(x):
    x = np.asarray(x, dtype=float)
    return 0.5 * (1.0 + np.vectorize(math.erf)(x / _SQRT2))


def norm_ppf(p):
    """Inverse standard normal CDF (rational approximation + two Newton steps)."""
    p = np.asarray(p, dtype=float)
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00]
    plow, phigh = 0.02425, 1 - 0.02425
    x = np.empty_like(p)
    lo = p < plow
    hi = p > phigh
    mid = ~(lo | hi)
    q = np.sqrt(-2 * np.log(np.where(lo, p, 0.5)))
    x[lo] = ((((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1))[lo]
    q = np.sqrt(-2 * np.log(np.where(hi, 1 - p, 0.5)))
    x[hi] = -((((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1))[hi]
    q = np.where(mid, p - 0.5, 0.0)
    r = q * q
    x[mid] = ((((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1))[mid]
    for _ in range(2):
        e = norm_cdf(x) - p
        x = x - e * math.sqrt(2 * math.pi) * np.exp(x * x / 2.0)
    return x


_GL_X, _GL_W = np.polynomial.legendre.leggauss(40)


def bvn_cdf(h, k, r):
    """P(X <= h, Y <= k) for a standard bivariate normal with correlation r (vectorised)."""
    h, k, r = (np.asarray(v, dtype=float) for v in (h, k, r))
    h, k, r = np.broadcast_arrays(h, k, r)
    base = norm_cdf(h) * norm_cdf(k)
    a = np.arcsin(np.clip(r, -0.999999, 0.999999))
    th = 0.5 * a[..., None] * (_GL_X + 1.0)
    s = np.sin(th)
    c2 = np.cos(th) ** 2
    f = np.exp(-(h[..., None] ** 2 - 2 * h[..., None] * k[..., None] * s + k[..., None] ** 2) / (2 * c2))
    integral = 0.5 * a * (f * _GL_W).sum(axis=-1)
    return base + integral / (2 * math.pi)


def tetrachoric(n11, n10, n01, n00, steps: int = 60):
    """Tetrachoric r from 2x2 counts; NaN when a cell is empty (no interior maximum).

    Newton steps in the angle arcsin r, whose derivative is the integrand at the
    end; a step that leaves the bracket is replaced by its middle.
    """
    n11, n10, n01, n00 = (np.asarray(v, dtype=float) for v in (n11, n10, n01, n00))
    n = n11 + n10 + n01 + n00
    ok = (n11 > 0) & (n10 > 0) & (n01 > 0) & (n00 > 0)
    out = np.full(n.shape, np.nan)
    if not ok.any():
        return out
    n11, n10, n01, n = n11[ok], n10[ok], n01[ok], n[ok]
    # X_i = 1 iff Z_i > t_i with P = p_i  =>  P(both) = BVN(-t_i, -t_j; r) and -t_i = Phi^-1(p_i)
    h, k, p11 = norm_ppf((n11 + n10) / n), norm_ppf((n11 + n01) / n), n11 / n
    base = norm_cdf(h) * norm_cdf(k)
    end = math.asin(0.999999)
    lo, hi, angle = np.full(n.shape, -end), np.full(n.shape, end), np.zeros(n.shape)
    todo = np.arange(len(n))
    for _ in range(steps):
        a, x, y = angle[todo], h[todo], k[todo]

        def inside(t, x=x, y=y):
            s = np.sin(t)
            return np.exp(-(x * x - 2 * x * y * s + y * y) / (2 * np.cos(t) ** 2))

        total = sum(w * inside(0.5 * a * (u + 1.0)) for u, w in zip(_GL_X, _GL_W, strict=True))
        f = base[todo] + 0.5 * a * total / (2 * math.pi) - p11[todo]
        hi[todo] = np.where(f > 0, a, hi[todo])
        lo[todo] = np.where(f > 0, lo[todo], a)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = a - f * 2 * math.pi / inside(a)
        good = np.isfinite(step) & (step > lo[todo]) & (step < hi[todo])
        new = np.where(good, step, 0.5 * (lo[todo] + hi[todo]))
        angle[todo] = new
        todo = todo[np.abs(new - a) > 1e-14]
        if not len(todo):
            break
    out[ok] = np.sin(angle)
    return out


def betainc_reg(a, b, x):
    """Regularized incomplete beta I_x(a, b) (Lentz continued fraction), scalar."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log(1 - x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - betainc_reg(b, a, 1 - x)
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(0, 400):
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -((a + m) * (a + b + m) * x) / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + num * d
        d = tiny if abs(d) < tiny else d
        d = 1.0 / d
        c = 1.0 + num / c
        c = tiny if abs(c) < tiny else c
        cd = c * d
        f *= cd
        if abs(1.0 - cd) < 1e-15:
            break
    return front * (f - 1.0) / a


def f_sf(f, df1, df2):
    """P(F > f) for an F(df1, df2) variable."""
    if f is None or not np.isfinite(f) or df1 <= 0 or df2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    x = df2 / (df2 + df1 * f)
    return betainc_reg(df2 / 2.0, df1 / 2.0, x)
