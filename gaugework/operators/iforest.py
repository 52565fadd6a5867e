"""Isolation forest: trees are built on small hashed subsamples in parallel, then every row is scored by Arrow batch.

A tree sees at most 256 rows, so a forest is at most trees * 511 nodes whatever the table's size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gaugework.functions.hashing import hash_key, hash_uniform
from gaugework.operators.cumulative import quantiles

#: Rows that take their steps together; with one tree's nodes they fit a core's cache.
ROWS_AT_ONCE = 4096
#: Half the largest number, so that the distance of two such bounds is a number.
FAR = float(np.finfo(float).max) / 2
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double"


def average_path(n: float) -> float:
    """Expected depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, seed: int, tree: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree])
    deepest = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[list] = [[-1, 0.0, -1, -1, 0.0]]
    todo = [(0, np.arange(len(points)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        open_cols = np.flatnonzero(high > low)
        if depth >= deepest or len(rows) <= 1 or not len(open_cols):
            nodes[node][4] = depth + average_path(len(rows))
            continue
        col = int(rng.choice(open_cols))
        # neighbouring numbers round a cut up to the higher one and an endless range has none: both sides must get rows
        cut = float(rng.uniform(*np.clip((low[col], high[col]), -FAR, FAR)))
        cut = float(min(max(cut, low[col]), np.nextafter(high[col], -np.inf)))
        goes_left = points[rows, col] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes[node][:4] = [col, cut, left, right]
        nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
        todo += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return [(tree, i, *n) for i, n in enumerate(nodes)]


@dataclass
class IsolationForest:
    """Fitted forest; `offset` is the score below which a row is an anomaly."""

    cols: list[str]
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    norm: float
    steps: int
    offset: float = field(default=-0.5)

    @classmethod
    def of(cls, nodes: pd.DataFrame, **settings) -> IsolationForest:
        """Forest of a node table as in NODE_SCHEMA."""
        kept = sorted(nodes["tree"].unique())
        width = int(nodes["node"].max()) + 1

        def grid(column: str, fill: float, dtype) -> np.ndarray:
            out = np.full((len(kept), width), fill, dtype=dtype)
            out[np.searchsorted(kept, nodes["tree"]), nodes["node"]] = nodes[column]
            return out

        kinds = {"feature": (-1, np.int64), "cut": (0.0, float), "left": (0, np.int64), "right": (0, np.int64), "path": (0.0, float)}
        return cls(**{name: grid(name, *kind) for name, kind in kinds.items()}, **settings)

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table and one row of settings under a path."""
        trees, width = self.feature.shape
        tree, node = np.divmod(np.arange(trees * width), width)
        columns = {name: getattr(self, name).ravel() for name in ("feature", "cut", "left", "right", "path")}
        nodes = pd.DataFrame({"tree": tree, "node": node, **columns})
        spark.createDataFrame(nodes, NODE_SCHEMA).write.parquet(f"{path}/nodes")
        row = [(self.cols, float(self.norm), self.steps, float(self.offset))]
        spark.createDataFrame(row, "cols array<string>, norm double, steps int, offset double").write.parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        settings = spark.read.parquet(f"{path}/settings").first().asDict()
        return cls.of(spark.read.parquet(f"{path}/nodes").toPandas(), **settings)

    def raw_score(self) -> Column:
        """-2^(-mean depth / expected depth): lower is more unusual."""
        # A leaf asks a column of zeros and leads back to itself, so every row takes the same number of steps. Node i has the
        # places 2i and 2i + 1: a row on the lower side moves to what the first says, else to what the second says.
        trees, width = self.feature.shape
        leaf = self.feature < 0
        here = np.arange(width)
        feature = np.where(leaf, len(self.cols), self.feature)
        children = np.stack([np.where(leaf, here, self.left), np.where(leaf, here, self.right)], axis=2)
        feature, cut, path = (np.repeat(a, 2, axis=1) for a in (feature, np.where(leaf, 0.0, self.cut), self.path))
        children = 2 * children.reshape(trees, 2 * width)
        norm, steps = self.norm, self.steps

        @F.pandas_udf(DoubleType())
        def score(batch: pd.DataFrame) -> pd.Series:
            out = np.empty(len(batch))
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[start : start + ROWS_AT_ONCE].to_numpy(dtype=float)
                n = len(part)
                flat = np.vstack([part.T, np.zeros(n)]).ravel()
                row = np.arange(n)
                depths = np.empty((n, trees))
                for tree in range(trees):
                    starts, at = feature[tree] * n, np.zeros(n, dtype=np.int64)
                    for _ in range(steps):
                        lower = flat.take(starts.take(at) + row) <= cut[tree].take(at)
                        at = children[tree].take(at + ~lower)
                    depths[:, tree] = path[tree].take(at)
                out[start : start + n] = -(2.0 ** (-depths.mean(axis=1) / norm))
            return pd.Series(out)

        return score(F.struct(*[F.col(c).cast("double").alias(c) for c in self.cols]))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `anomaly_score` (score minus offset) and `is_anomaly` (score below the offset)."""
        scored = df.withColumn("anomaly_score", self.raw_score() - F.lit(self.offset))
        return scored.withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int"))


def fit_isolation_forest(
    df: DataFrame, cols: list[str], key: str | list[str], trees: int = 200, sample: int = 256,
    contamination: float = 0.034, seed: int = 42,
) -> IsolationForest:
    """Fit on the given (normal) rows. Each tree takes up to `sample` rows by hash; the offset is the exact
    `contamination` quantile of the training scores."""
    points = df.select(*(key if isinstance(key, list) else [key]), *[F.col(c).cast("double").alias(f"x_{c}") for c in cols])
    points = points.dropna()
    rows = points.count()
    share = min(1.0, sample * trees / max(rows, 1))
    pool = max(rows * share, 1.0)
    digest = hash_key(key, seed)
    pick = min(1.0, 1.15 * sample / pool)

    def chosen(t: Column) -> Column:
        return F.pmod(F.xxhash64(F.col("__h"), t), F.lit(1 << 30)) < int(pick * (1 << 30))

    picked = (
        points.withColumn("__h", digest)
        .filter(hash_uniform(F.col("__h")) < share)
        .withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), chosen)))
    )
    names = [f"x_{c}" for c in cols]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        # rows in an order of their own for every tree, so that taking `sample` of them favours none
        order = pd.util.hash_pandas_object(group["__h"] + f"|{tree}", index=False)
        group = group.assign(__o=order.to_numpy()).sort_values(["__o", "__h"]).head(sample)
        grown = _grow(group[names].to_numpy(dtype=float), seed, tree)
        return pd.DataFrame(grown, columns=["tree", "node", "feature", "cut", "left", "right", "path"])

    nodes = picked.select("tree", "__h", *names).groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    few = min(sample, rows)
    forest = IsolationForest.of(nodes, cols=cols, norm=average_path(few) or 1.0, steps=math.ceil(math.log2(max(few, 2))))
    # the quantile reads the scores several times, so they are kept until it is known
    scores = df.select(forest.raw_score().alias("score")).persist()
    scores.count()
    forest.offset = float(quantiles(scores, ["score"], [contamination]).first()["quantile"])
    scores.unpersist()
    return forest
