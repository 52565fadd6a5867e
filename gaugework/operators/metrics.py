"""Model metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.operators.cumulative import running_sums
from gaugework.operators.sizing import attach, sized


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the balanced weight n / (classes * n_class)."""
    counts, _ = sized(df.groupBy(label).agg(F.count(F.lit(1)).alias("__n")))
    whole = counts.agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__k"))
    weights = counts.crossJoin(F.broadcast(whole)).select(
        label, (F.col("__all") / (F.col("__k") * F.col("__n"))).alias(name)
    )
    return attach(df, sized(weights)[0], [label])


def _sum_if(cond: Column) -> Column:
    return F.coalesce(F.sum(cond.cast("long")), F.lit(0))


def confusion(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """Confusion counts and precision, recall, F1 of class 1; an empty denominator gives 0."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    cells = df.groupBy(*(by or [])).agg(
        _sum_if(~y & ~p).alias("tn"),
        _sum_if(~y & p).alias("fp"),
        _sum_if(y & ~p).alias("fn"),
        _sum_if(y & p).alias("tp"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "accuracy": ratio(tp + F.col("tn"), tp + fp + fn + F.col("tn")),
        }
    )


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support of every class."""
    pairs = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0)
    actual = pairs.groupBy(F.col(label).alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    guessed = pairs.groupBy(F.col(pred).alias("__p")).agg(F.sum("n").alias("predicted"))
    both = actual.join(guessed, F.col("class") == F.col("__p"), "left")
    precision = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("predicted")), F.lit(0.0))
    recall = F.col("hits") / F.col("support")
    f1 = F.coalesce(2.0 * F.col("hits") / (F.col("support") + F.coalesce(F.col("predicted"), F.lit(0))), F.lit(0.0))
    return both.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def auc(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve by average ranks; ties are exact. Rows are first collapsed to distinct scores."""
    by = by or []
    y = F.col(label).cast("long")
    counts = df.groupBy(*by, F.col(score).alias("score")).agg(F.sum(y).alias("pos"), F.count(F.lit(1)).alias("n"))
    ranks = running_sums(counts, by, "score", ["pos", "n"])
    before = (F.col("cum_n") - F.col("n")).cast("double")
    rank_sum = F.sum(F.col("pos") * (before + (F.col("n") + 1) / 2.0))
    out = ranks.groupBy(*by).agg(
        F.max("tot_pos").alias("positives"), (F.max("tot_n") - F.max("tot_pos")).alias("negatives"), rank_sum.alias("__r")
    )
    np, nn = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return out.withColumn("auc", F.try_divide(F.col("__r") - np * (np + 1) / 2, np * nn)).drop("__r")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R2 over the rows that have both values."""
    df = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    err = F.col(actual) - F.col(predicted)
    n = F.count(F.lit(1))
    r2 = F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(actual) * n)
    return df.groupBy(*(by or [])).agg(
        n.alias("rows"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), r2.alias("r2")
    )


def fold_summary(df: DataFrame, metric: str = "f1") -> DataFrame:
    """Mean and population spread of a metric over folds."""
    return df.agg(F.avg(metric).alias(f"cv_{metric}_mean"), F.stddev_pop(metric).alias(f"cv_{metric}_std"))
