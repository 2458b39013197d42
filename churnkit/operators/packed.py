"""Packed partial results of tasks, merged up a tree.

A task reduces all its rows to one flat array per tile (a block of column
pairs) instead of a row per pair.  The arrays meet in two steps: first those
of about ``tasks / fan`` tasks, then ``fan`` of them, one after another
as they stream past, so a merging task holds two arrays at a time and
nothing is written per task and pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "tile int, data binary"


def packed(tiles: dict[int, np.ndarray]) -> pa.RecordBatch:
    """One row per tile."""
    return pa.RecordBatch.from_arrays(
        [pa.array(list(tiles), pa.int32()), pa.array([np.ascontiguousarray(t, np.float64).tobytes() for t in tiles.values()], pa.binary())],
        names=["tile", "data"])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for tile, data in zip(batch["tile"].to_pylist(), batch["data"]):
        yield tile, np.frombuffer(data.as_buffer(), np.float64)


def merge_tree(parts: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray], fan: int = 512) -> DataFrame:
    """One row per tile of ``parts(tile, data)``, the arrays of all tasks merged pairwise in the order of tasks."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, acc = None, None
        for b in batches:
            slots = b["slot"].to_pylist()
            for slot, (tile, data) in zip(slots, unpacked(b)):
                if key == (tile, slot):
                    acc = merge(acc, data)
                    continue
                if key is not None:
                    yield out(key, acc)
                key, acc = (tile, slot), data
        if key is not None:
            yield out(key, acc)

    def out(key: tuple[int, int], acc: np.ndarray) -> pa.RecordBatch:
        b = packed({key[0]: acc})
        return pa.RecordBatch.from_arrays([b["tile"], pa.array([key[1]], pa.int32()), b["data"]], names=["tile", "slot", "data"])

    task = parts.select("tile", F.spark_partition_id().alias("part"), "data")
    some = (task.withColumn("slot", (F.col("part") % fan).cast("int")).repartition("tile", "slot")
            .sortWithinPartitions("tile", "slot", "part").select("tile", "slot", "data")
            .mapInArrow(fold, "tile int, slot int, data binary"))
    one = (some.withColumn("at", F.col("slot")).withColumn("slot", F.lit(0)).repartition("tile")
           .sortWithinPartitions("tile", "at").select("tile", "slot", "data"))
    return one.mapInArrow(fold, "tile int, slot int, data binary").select("tile", "data")
