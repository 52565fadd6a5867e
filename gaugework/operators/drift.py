"""Distribution drift between a reference and a current table, all columns in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.operators.cumulative import running_sums


def _long(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        return wide.unpivot([], cols, "column", "value").withColumn("side", F.lit(name))

    return side(reference, "ref").unionByName(side(current, "cur")).filter(F.col("value").isNotNull())


def _by_value(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    ref = (F.col("side") == "ref").cast("long")
    counts = (
        _long(reference, current, cols)
        .groupBy("column", "value")
        .agg(F.sum(ref).alias("ref"), F.sum(1 - ref).alias("cur"))
    )
    return running_sums(counts, ["column"], "value", ["ref", "cur"])


def ks_and_wasserstein(reference: DataFrame, current: DataFrame, cols: list[str], drift_at: float = 0.1) -> DataFrame:
    """Per column: two-sample KS statistic with its 5 percent bound, and the Wasserstein distance in units of the
    reference's population spread; a column drifts when that is at least `drift_at`. A side without values has 0 rows, and
    nothing is said of the column's drift."""
    steps = _by_value(reference, current, cols)
    gap = F.abs(F.try_divide("cum_ref", "tot_ref") - F.try_divide("cum_cur", "tot_cur"))
    dist = steps.groupBy("column").agg(
        F.max("tot_ref").alias("ref_rows"),
        F.max("tot_cur").alias("cur_rows"),
        F.max(gap).alias("ks"),
        F.when(F.max(gap).isNotNull(), F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0))).alias("wasserstein"),
    )
    spread = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in cols])
    spread = spread.unpivot([], cols, "__c", "__spread")
    n, m = F.col("ref_rows").cast("double"), F.col("cur_rows").cast("double")
    return (
        dist.join(F.broadcast(spread), F.col("column") == F.col("__c"))
        .withColumn("wasserstein_norm", F.col("wasserstein") / F.greatest(F.col("__spread"), F.lit(0.001)))
        .withColumns(
            {
                "ks_drifted": F.col("ks") > F.lit(1.358) * F.sqrt(F.try_divide(n + m, n * m)),
                "drifted": F.col("wasserstein_norm") >= drift_at,
            }
        )
        .drop("__c", "__spread")
    )


def psi(reference: DataFrame, current: DataFrame, cols: list[str], bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """Population stability index over equal bins of the reference's range; values beyond it go to the end bins."""
    ends = reference.agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in cols],
        *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in cols],
    )
    ranges = ends.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("__c"), F.col(f"{c}__lo").alias("lo"), F.col(f"{c}__hi").alias("hi")) for c in cols]
            )
        )
    )
    slot = F.coalesce(F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(0))
    ref = (F.col("side") == "ref").cast("long")
    counts = (
        _long(reference, current, cols)
        .join(F.broadcast(ranges), F.col("column") == F.col("__c"))
        .groupBy("column", F.greatest(F.lit(0), F.least(F.lit(bins - 1), slot)).cast("int").alias("bin"))
        .agg(F.sum(ref).alias("r"), F.sum(1 - ref).alias("c"))
    )
    totals = counts.groupBy(F.col("column").alias("__t")).agg(F.sum("r").alias("tr"), F.sum("c").alias("tc"))
    both = (F.col("tr") > 0) & (F.col("tc") > 0)  # else the index stays null
    p = F.when(both, F.greatest(F.try_divide("r", "tr"), F.lit(eps)))
    q = F.when(both, F.greatest(F.try_divide("c", "tc"), F.lit(eps)))
    joined = counts.join(F.broadcast(totals), F.col("column") == F.col("__t"))
    return joined.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def label_drift(reference: DataFrame, current: DataFrame, label: str, drift_at: float = 0.1) -> DataFrame:
    """Jensen-Shannon distance (base 2) between the label shares."""
    ref = reference.groupBy(F.col(label).alias("__a")).agg(F.count(F.lit(1)).alias("r"))
    cur = current.groupBy(F.col(label).alias("__b")).agg(F.count(F.lit(1)).alias("c"))
    both = ref.join(cur, F.col("__a").eqNullSafe(F.col("__b")), "full_outer")
    totals = both.agg(F.sum("r").alias("tr"), F.sum("c").alias("tc"))
    both = both.crossJoin(F.broadcast(totals))
    p = F.try_divide(F.coalesce(F.col("r"), F.lit(0)), F.col("tr"))
    q = F.try_divide(F.coalesce(F.col("c"), F.lit(0)), F.col("tc"))
    mid = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.log2(x / mid)).when(x == 0, F.lit(0.0))

    out = both.agg(F.sqrt(F.greatest(F.lit(0.0), F.sum(part(p) + part(q)) / 2)).alias("js_distance"))
    return out.withColumn("drifted", F.col("js_distance") >= drift_at)


def dataset_drift(columns: DataFrame, share_at: float = 0.5) -> DataFrame:
    """Share of drifted columns of a `ks_and_wasserstein` result against a threshold."""
    hit = F.sum(F.col("drifted").cast("long"))
    share = hit / F.count(F.lit(1))
    return columns.agg(
        F.count(F.lit(1)).alias("columns"),
        hit.alias("drifted_columns"),
        share.alias("drift_share"),
        (share >= share_at).alias("dataset_drift"),
    )


def missing_comparison(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: missing rows and share on both sides."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        sums = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols], F.count(F.lit(1)).alias("__n"))
        return sums.unpivot(["__n"], cols, f"{tag}_column", f"{tag}_missing").withColumnRenamed("__n", f"{tag}_rows")

    both = side(reference, "ref").join(F.broadcast(side(current, "cur")), F.col("ref_column") == F.col("cur_column"))
    return both.select(
        F.col("ref_column").alias("column"),
        "ref_missing",
        "cur_missing",
        F.try_divide("ref_missing", "ref_rows").alias("ref_share"),
        F.try_divide("cur_missing", "cur_rows").alias("cur_share"),
    )
