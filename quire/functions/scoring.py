"""Numeric column expressions: rounded term frequency, idf, weights, cosine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
TF_DECIMALS = 6  # term frequencies are stored with six decimals
SCORE_DECIMALS = 9  # scores are compared and reported with nine decimals
# --- end of fixed values ----------------------------------------------------

_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp split constant for IEEE doubles


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded_ratio(cnt, n, decimals: int = TF_DECIMALS) -> Column:
    """``cnt / n`` printed with ``decimals`` places and read back, computed exactly.

    Printing a double with a fixed number of decimals rounds its exact binary
    value half-to-even.  Away from ties the integer remainder decides.  On an
    exact rational tie the printed digit depends on whether the double nearest
    to ``cnt / n`` lies above or below the tie; the sign of the residual
    ``cnt - d * n`` (computed without rounding error by splitting ``d`` into two
    26-bit halves) tells which.  A residual of zero means the tie itself is the
    double, and half-to-even applies.
    """
    cnt_l = _c(cnt).cast("bigint")
    n_l = _c(n).cast("bigint")
    scale = 10**decimals
    scaled = cnt_l * F.lit(scale)
    rem = F.pmod(scaled, n_l)
    # (scaled - rem) is a multiple of n, so the double quotient is exact.
    k = ((scaled - rem) / n_l).cast("bigint")
    rem2 = (scaled - k * n_l) * 2 - n_l
    d = cnt_l.cast("double") / n_l.cast("double")
    c = d * F.lit(_SPLIT)
    dh = c - (c - d)
    dl = d - dh
    nd = n_l.cast("double")
    resid = (cnt_l.cast("double") - dh * nd) - dl * nd
    up = (
        F.when(rem2 > 0, 1)
        .when(rem2 < 0, 0)
        .when(resid < 0, 1)
        .when(resid > 0, 0)
        .otherwise(F.pmod(k, F.lit(2)))
    )
    return (k + up).cast("double") / F.lit(float(scale))


def idf(df_col, n_docs) -> Column:
    """``ln(N / (1 + df))`` -- zero or negative once ``1 + df >= N``."""
    return F.log(_c(n_docs).cast("double") / (F.lit(1.0) + _c(df_col).cast("double")))


def cosine(dot, doc_norm, query_norm) -> Column:
    """``dot / (|d| |q|)``, 0.0 when either norm is zero."""
    dn, qn = _c(doc_norm), _c(query_norm)
    return F.when((dn != 0) & (qn != 0), _c(dot) / (dn * qn)).otherwise(F.lit(0.0))


def round_score(x, decimals: int = SCORE_DECIMALS) -> Column:
    return F.round(_c(x), decimals)
