"""Numeric transforms and score imputation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspan.functions.clean import _col


# F29
def transform_numeric(c, how: str) -> Column:
    """'log1p' (<= 0 -> 0), 'exp', 'sqrt' (< 0 -> 0); other names raise."""
    x = _col(c)
    if how == "log1p":
        return F.when(x > 0, F.log1p(x)).when(x.isNotNull(), F.lit(0.0))
    if how == "exp":
        return F.exp(x)
    if how == "sqrt":
        return F.when(x < 0, F.lit(0.0)).otherwise(F.sqrt(x))
    raise ValueError(f"unknown transform: {how!r}")


# F33 ------------------------------------------------------------------------
def _clip01(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def _logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.least(F.lit(1 - eps), F.greatest(F.lit(eps), p))
    return F.log(q / (1 - q))


def impute_scores(df, cols=("epss_0", "epss_30", "epss_60"), times=(0.0, 30.0, 60.0),
                  method: str = "mean"):
    """Fill one missing score of three from the other two (off in the
    pipeline; the reference's version is disabled).

    * ``mean``: average of the two known values;
    * ``linear``: the line through the two known points;
    * ``sigmoid``: the logistic curve through the two known points (two
      logits fix growth and midpoint; growth clamped to [-10, 10]; equal
      known values return that value).
    Results are clipped to [0, 1]; ``imputation`` names the filled column.
    """
    if method not in ("mean", "linear", "sigmoid"):
        raise ValueError(f"unknown imputation method: {method!r}")
    out = {}
    notes = None
    for i, target in enumerate(cols):
        others = [j for j in range(3) if j != i]
        a, b = F.col(cols[others[0]]), F.col(cols[others[1]])
        ta, tb, tt = times[others[0]], times[others[1]], times[i]
        if method == "mean":
            est = (a + b) / 2.0
        elif method == "linear":
            est = a + (b - a) * ((tt - ta) / (tb - ta))
        else:
            la, lb = _logit(a), _logit(b)
            k = F.least(F.lit(10.0), F.greatest(F.lit(-10.0), (lb - la) / (tb - ta)))
            mid = F.lit(ta) - la / F.when(k != 0, k)
            est = F.when(a == b, a).otherwise(1.0 / (1.0 + F.exp(-k * (F.lit(tt) - mid))))
        can = F.col(target).isNull() & a.isNotNull() & b.isNotNull()
        out[target] = F.when(can, _clip01(est)).otherwise(F.col(target))
        notes = F.when(can, F.lit(f"{target}:{method}")) if notes is None else notes.when(can, F.lit(f"{target}:{method}"))
    out["imputation"] = notes  # evaluated against the unfilled columns
    return df.withColumns(out)
