"""Fitted models kept under a digest of their input and settings, so that one fit serves every consumer."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.session import shared_root

Model = TypeVar("Model")
#: Part of every digest; a change of a stored form gets a new number.
FORM = 1


def table_digest(df: DataFrame) -> str:
    """Digest of the names, types and rows of a table, whatever the order and partitioning of its rows."""
    row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)) if df.columns else F.lit(0)
    wide = lambda h: F.sum(h.cast("decimal(38,0)"))
    other = F.xxhash64(row, F.lit(FORM))
    found = df.agg(F.count(F.lit(1)).alias("n"), wide(row).alias("a"), wide(other).alias("b")).first()
    return hashlib.sha256(json.dumps([df.dtypes, found["n"], str(found["a"]), str(found["b"])]).encode()).hexdigest()


class ModelStore:
    """Models in the shared folder, `<name>-<digest>` each. A model appears there when it is complete."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/models"

    def path(self, name: str, data: DataFrame, settings: dict) -> str:
        """Where the model of this input and these settings lies or will lie."""
        parts = [FORM, self.spark.version, name, table_digest(data), settings]
        return f"{self.root}/{name}-{hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]}"

    def fitted(
        self, name: str, data: DataFrame, settings: dict, fit: Callable[[DataFrame], Model],
        save: Callable[[Model, str], None] = lambda model, path: model.write().save(path),
        load: Callable[[str], Model] = PipelineModel.load,
    ) -> Model:
        """The stored model of `fit(data)`; fitted and stored first where there is none.

        Consumers always get the model as it was read back. Two writers of one model both fit it, and the first to end
        is kept. `settings` must name all that the fit depends on besides its input.
        """
        path = self.path(name, data, settings)
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(target):
            part = f"{path}.{uuid.uuid4().hex}"
            save(fit(data), part)
            if files.exists(target) or not files.rename(jvm.org.apache.hadoop.fs.Path(part), target):
                files.delete(jvm.org.apache.hadoop.fs.Path(part), True)
        return load(path)
