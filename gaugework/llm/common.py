"""What the text operators share: reading documents, scratch tables, word arrays over Arrow buffers, prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugework.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 19
SLICE_ROWS = 4096
PREFIX_GROUP = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: the plan is cut and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that have ended.

    They stay on the executors' disks until the driver's JVM has collected those plans, which on a large heap may be after
    the job; so it is asked to.
    """
    spark._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that no later plan reads, and the shuffles behind them."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        free_shuffles(spark)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of up to SLICE_ROWS consecutive texts of at most `most` bytes, or of one longer text; null is empty.

    Only these slices are worked on at once, so memory follows the longest text and not the batch.
    """
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if chunk.null_count:
            chunk = chunk.fill_null("")
        if not len(chunk):
            continue
        wide = pa.types.is_large_string(chunk.type) or pa.types.is_large_binary(chunk.type)
        _, ends, data = chunk.buffers()
        offsets = np.frombuffer(ends, np.int64 if wide else np.int32, len(chunk) + 1 + chunk.offset)[chunk.offset :].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(chunk):
            last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
            last = min(last, first + SLICE_ROWS, len(chunk))
            yield raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words; a word never crosses from one text to the next."""
    inside = ~_SPACE[data]
    edge = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edge[1:] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


_BYTES = np.random.default_rng(20240817).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        full[0] = 1
        np.multiply.accumulate(full, out=full)
        if n <= SLICE_BYTES + 1:
            _powers[base] = full
        return full[:n]
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over the whole value."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def running(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Prefix sums of value_i * base^i modulo 2^64, one longer than the values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, inverse: int = _INVERSE) -> np.ndarray:
    """Hash of each stretch [start, end), whatever its place: equal content gives equal hashes.

    For stretches of some hundred values only: modulo a power of two, certain sequences of two values that are 1,024 long
    or longer have equal sums for every base. Longer content is compared itself or by a digest.
    """
    raw = (sums[ends] - sums[starts]) * powers(inverse, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return running(_BYTES[data])


def prefix_sums(totals: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Sum of `value` over all rows before each row in ascending `order`: one row a shard, added up in two levels.

    `order` counts the shards from 0, so groups of PREFIX_GROUP of them are added up apart and only one row for each
    group meets in one task.
    """
    part = F.floor(F.col(order) / PREFIX_GROUP)
    tagged = totals.withColumn("__part", part)
    parts = tagged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    over = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__part"), F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    inner = Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(parts, "__part")
        .withColumn(out, F.col(out) + F.col("__before"))
        .drop("__part", "__before")
    )
