"""Polynomial (Savitzky-Golay) smoothing with native window functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.operators.ordered import ROWS_PER_SLICE, over_groups


def taps(rows: int, degree: int) -> np.ndarray:
    """Row i holds the weights that give the least-squares polynomial's value at point i from all points."""
    basis = np.vander(np.arange(rows) - rows // 2, degree + 1, increasing=True).astype(float)
    return basis @ np.linalg.pinv(basis)


def savgol(
    df: DataFrame,
    cols: list[str],
    keys: list[str],
    order: list[str],
    rows: int = 11,
    degree: int = 3,
    suffix: str = "_smooth",
    limit: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add `<c>_smooth`. The first and last half window take the fit of the outermost full window; a series
    shorter than the window is returned as it is."""
    weights = taps(rows, degree)
    half = rows // 2

    def near(c: str, k: int) -> str:
        return f"`__{c}_{k}`"

    def build(frame):
        out = {"__p": frame.pos, "__size": frame.size}
        for c in cols:
            out.update({f"__{c}_{k}": F.expr(f"lead(`{c}`, {k})").over(frame.window) for k in range(1 - rows, rows)})
        return out

    # which point of its window the row is: the middle, or less (more) near the start (end) of the series
    from_end = F.col("__size") - F.col("__p")
    point = F.when(F.col("__p") <= half, F.col("__p") - 1).when(from_end < half, rows - 1 - from_end).otherwise(half)
    table = "array(" + ", ".join("array(" + ", ".join(f"{w!r}D" for w in row) + ")" for row in weights.tolist()) + ")"

    def fit(c: str):
        middle = " + ".join(f"{w!r}D * {near(c, j - half)}" for j, w in enumerate(weights[half].tolist()))
        around = ", ".join(f"double({near(c, k)})" for k in range(1 - rows, rows))
        edge = (
            f"aggregate(zip_with(slice(array({around}), {rows} - __point, {rows}), element_at({table}, __point + 1), "
            "(x, w) -> x * w), 0D, (total, term) -> total + term)"
        )
        return F.expr(f"CASE WHEN __size < {rows} THEN double(`{c}`) WHEN __point = {half} THEN {middle} ELSE {edge} END")

    finish = [{"__point": point.cast("int")}, {c + suffix: fit(c) for c in cols}]
    out = over_groups(df, keys, order, build, before=rows - 1, after=rows - 1, limit=limit, finish=finish)
    return out.drop("__point")
