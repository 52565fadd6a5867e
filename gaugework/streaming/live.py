"""Row-wise operators on streams: the same expressions as in batch, no state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugework.functions import machine
from gaugework.operators.features import live_scale
from gaugework.operators.models import live_machine_features


def score_readings(df: DataFrame) -> DataFrame:
    """Features, rule flags, setpoint bands and scaled inputs of machine readings, batch or stream."""
    featured = df.withColumns(live_machine_features())
    flagged = featured.withColumns(machine.rule_flags())
    bands = {"target_power_w": machine.target_power("tool_wear")}
    scaled = {f"{c}_scaled": live_scale(c, lo, hi) for c, (lo, hi) in machine.LIVE_RANGES.items()}
    return flagged.withColumns({**bands, **scaled})


def stream_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def run_stream(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Append the transformed stream to a Parquet table until the input at hand is used up."""
    return (
        transform(source)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
