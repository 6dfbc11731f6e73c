"""Error and quality measures as single aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def halved_mse_expr(y, yhat) -> Column:
    """1/(2m) sum (yhat - y)^2 as an aggregate expression."""
    e = _c(yhat) - _c(y)
    return F.avg(e * e) / F.lit(2.0)


def class_error_expr(y, yhat) -> Column:
    """Fraction misclassified."""
    return F.avg(F.when(_c(y) != _c(yhat), 1.0).otherwise(0.0))


def accuracy_expr(y, yhat) -> Column:
    """E3."""
    return F.avg(F.when(_c(y) == _c(yhat), 1.0).otherwise(0.0))


def confusion_exprs(y, yhat) -> list[Column]:
    """A5: tp, fp, fn, tn counts in one pass."""
    y, p = _c(y), _c(yhat)
    return [F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
            F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 0) & (y == 0)).alias("tn")]


def prf_columns() -> list[Column]:
    """precision, recall, f1 from tp / fp / fn columns (NULL on 0/0)."""
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    f1 = F.try_divide(F.lit(2.0) * prec * rec, prec + rec)
    return [prec.alias("precision"), rec.alias("recall"), f1.alias("f1")]


def precision_recall_f1(df: DataFrame, y, yhat, *extra: Column) -> DataFrame:
    """One-row table tp, fp, fn, tn, precision, recall, f1 (NULL on 0/0),
    plus any ``extra`` aggregates computed in the same pass."""
    c = df.agg(*confusion_exprs(y, yhat), *extra)
    return c.select("*", *prf_columns())


def binary_cross_entropy_expr(y, z, from_logits: bool = True) -> Column:
    """E5 (binary): mean of -[y ln p + (1-y) ln(1-p)]; with logits the
    stable form max(z,0) - z*y + ln(1+e^-|z|)."""
    y, z = _c(y), _c(z)
    if from_logits:
        return F.avg(F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z))))
    return F.avg(-(y * F.ln(z) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - z)))


def sparse_cross_entropy_expr(label, logits, from_logits: bool = True) -> Column:
    """E5 (categorical): mean of -ln softmax(logits)[label] in log-sum-exp form."""
    lg, lab = _c(logits), _c(label)
    if from_logits:
        m = F.array_max(lg)
        lse = m + F.ln(F.aggregate(lg, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))
        return F.avg(lse - F.element_at(lg, lab + 1))
    return F.avg(-F.ln(F.element_at(lg, lab + 1)))
