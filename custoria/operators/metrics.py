"""Classification metrics as single aggregations; exact AUC at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custoria.functions.quantiles import BOUNDED_ROWS
from custoria.functions.ranking import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(bottom == 0, 0.0).otherwise(top / F.when(bottom != 0, bottom))


def confusion(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1."""
    c = {n: F.col(n) for n in ("tp", "fp", "fn", "tn")}
    scored = confusion(df, label, prediction, by).select(
        *by, _ratio(c["tp"] + c["tn"], c["tp"] + c["tn"] + c["fp"] + c["fn"]).alias("accuracy"),
        _ratio(c["tp"], c["tp"] + c["fp"]).alias("precision"), _ratio(c["tp"], c["tp"] + c["fn"]).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(2 * p * r, p + r))


def f2_score(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """F measure that weighs recall over precision."""
    scored = classification_metrics(df, label, prediction, by)
    p, r = F.col("precision"), F.col("recall")
    return scored.select(*by, _ratio(5 * p * r, 4 * p + r).alias("f2"))


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] = (), bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half; null for a single class.

    Rows are counted per distinct score before anything is ordered.
    """
    y = F.col(label) == 1
    counted = df.groupBy(*by, F.col(score).alias("_score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    running = running_totals(counted, ["_score"], ["neg"], list(by), bounded_rows)
    below = F.col("run_neg") - F.col("neg")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    both = F.sum("pos").cast("double") * F.sum("neg")
    return running.groupBy(*by).agg(F.when(both > 0, wins / F.when(both > 0, both)).alias("auc_roc"))


def full_metrics(df: DataFrame, label: str, prediction: str, score: str, by: list[str] = (), bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """All metrics side by side, one row per group of ``by``."""
    keys = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(1))
    plain = classification_metrics(rows, label, prediction, keys)
    out = plain.join(roc_auc(rows, label, score, keys, bounded_rows), keys)
    return out if by else out.drop("_all")
