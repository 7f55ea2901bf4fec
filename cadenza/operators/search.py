"""Grid search in blocks: matrices of parameters against samples inside tasks, of which only sums leave.

A grid is given by its axes, so that every task makes its parameters itself from a number. Samples are
cut into blocks; each block meets each chunk of parameters once, in some task, as matrices of bounded
size. A grid of one chunk is measured where the samples are read, else blocks travel to tasks. What leaves is a row of sums per parameter, chunk and block, and those are added up before and after
the exchange. The best parameters come from an aggregate over the grid, without a sort.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Samples in a block, parameters in a chunk, and cells of a matrix that is held at once.
SAMPLES, CHUNK, CELLS = 4096, 8192, 1 << 19

Measure = Callable[[dict[str, np.ndarray], dict[str, np.ndarray]], dict[str, np.ndarray]]


def axis_value(axes: Mapping[str, Sequence[float]], name: str, ordinal: Column) -> Column:
    """The value of an axis at a place in the grid, the last axis turning fastest."""
    names = list(axes)
    below = math.prod(len(axes[n]) for n in names[names.index(name) + 1 :])
    place = F.floor(ordinal / below) % len(axes[name])
    return F.element_at(F.array(*(F.lit(float(v)) for v in axes[name])), (place + 1).cast("int"))


def grid_sums(samples: DataFrame, axes: Mapping[str, Sequence[float]], measure: Measure, names: list[str]) -> DataFrame:
    """(ordinal, one double per axis, samples, one sum per name) of every combination of ``axes`` over all samples.

    ``measure`` gets columns of parameters (as n x 1) and rows of samples (as 1 x m; every column of ``samples`` is
    a double) and gives a matrix per name. An empty table gives no rows.
    """
    columns, total = samples.columns, math.prod(map(len, axes.values()))
    values = {n: np.asarray(v, float) for n, v in axes.items()}

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for at in range(0, batch.num_rows, SAMPLES):
                part = batch.slice(at, SAMPLES)
                yield np.stack([part.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in blocks_of(batches):
            yield pa.record_batch([pa.array([held.tobytes()], pa.binary())], names=["block"])

    def parameters(first: int, last: int) -> dict[str, np.ndarray]:
        place, out = np.arange(first, last), {}
        for n in reversed(list(values)):
            out[n] = values[n][place % len(values[n])][:, None]
            place = place // len(values[n])
        return out

    def measured(held: np.ndarray, first: int, last: int) -> np.ndarray:
        rows, m = dict(zip(columns, held[:, None], strict=True)), held.shape[1]
        sums = np.empty((len(names), last - first))
        step = max(1, CELLS // m)
        for a in range(first, last, step):
            b = min(last, a + step)
            found = measure(parameters(a, b), rows)
            for i, n in enumerate(names):
                sums[i, a - first : b - first] = np.broadcast_to(found[n], (b - a, m)).sum(1)
        return sums

    def told(first: int, last: int, m: int, sums: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.arange(first, last)), pa.array(np.full(last - first, m)), *(pa.array(s) for s in sums)], names=["ordinal", "__m", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, chunk in zip(batch.column("block"), batch.column("chunk").to_pylist(), strict=True):
                held = np.frombuffer(block.as_buffer(), float).reshape(len(columns), -1)
                first, last = chunk * CHUNK, min(total, (chunk + 1) * CHUNK)
                yield told(first, last, held.shape[1], measured(held, first, last))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, m = np.zeros((len(names), total)), 0
        for held in blocks_of(batches):
            sums += measured(held, 0, total)
            m += held.shape[1]
        if m:
            yield told(0, total, m, sums)

    schema, chunks = "ordinal long, __m long, " + ", ".join(f"{n} double" for n in names), -(-total // CHUNK)
    if chunks == 1:
        # samples stay where they are read, a batch at a time
        each = samples.mapInArrow(whole, schema)
    else:
        units = samples.mapInArrow(pack, "block binary").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        each = units.repartition(samples.sparkSession.sparkContext.defaultParallelism * 3).mapInArrow(run, schema)
    summed = each.groupBy("ordinal").agg(F.sum("__m").alias("samples"), *(F.sum(n).alias(n) for n in names))
    return summed.select("ordinal", *(axis_value(axes, n, F.col("ordinal")).alias(n) for n in axes), "samples", *names)


def best_of(found: DataFrame, keys: Mapping[str, list[Column]]) -> DataFrame:
    """(key, and the columns of ``found``): for each named list of columns the row where it is greatest; the first ordinal wins ties."""
    # a struct of falling columns: the smallest is the best, so one aggregate does
    whole = F.struct(*found.columns)
    picked = found.agg(*(F.min_by(whole, F.struct(*(-c for c in columns), "ordinal")).alias(name) for name, columns in keys.items()))
    rows = F.array(*(F.struct(F.lit(name).alias("key"), F.col(name).alias("best")) for name in keys))
    return picked.select(F.inline(rows)).where(F.col("best").isNotNull()).select("key", "best.*")


def square_errors(parameters: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Squares laid by top, scale, xoff and yoff over a face (center, upper, lower, width) against boxes (x1, y1, x2, y2):
    overlap, whether it reaches 0.995, drift of the centre, whether it stays within 1."""
    side = np.rint(rows["width"] * parameters["scale"])
    x1 = np.rint(rows["center"] + parameters["xoff"] - side / 2)
    y1 = np.rint(rows["upper"] + (rows["lower"] - rows["upper"]) * parameters["top"] + parameters["yoff"])
    shared = np.maximum(0, np.minimum(rows["x2"], x1 + side) - np.maximum(rows["x1"], x1)) * np.maximum(0, np.minimum(rows["y2"], y1 + side) - np.maximum(rows["y1"], y1))
    overlap = shared / ((rows["x2"] - rows["x1"]) * (rows["y2"] - rows["y1"]) + side * side - shared)
    drift = np.hypot((rows["x1"] + rows["x2"]) / 2 - x1 - side / 2, (rows["y1"] + rows["y2"]) / 2 - y1 - side / 2)
    return {"iou": overlap, "iou_pass": overlap >= 0.995, "drift": drift, "center_pass": drift <= 1}


def calibrated(samples: DataFrame, axes: Mapping[str, Sequence[float]]) -> DataFrame:
    """The winners of a search of square_errors by mean and by gate: means over all samples, rounded to 12 places before they are compared."""
    names = ["iou", "iou_pass", "drift", "center_pass"]
    sums = grid_sums(samples, axes, square_errors, names)
    mean = sums.select("ordinal", *axes, "samples", *(F.round(F.col(n) / F.col("samples"), 12).alias(n) for n in names))
    return best_of(mean, {"mean": [F.col("iou"), F.col("center_pass")], "gate": [F.col("iou_pass"), F.col("center_pass"), F.col("iou")]})
