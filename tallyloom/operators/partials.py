"""Long vectors of sums: one partial per task, packed in pieces, put together on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Numbers in a packed record; the pieces of a vector are put together by different tasks.
PACKED = 1 << 17
_PIECE = "piece int, data binary"
_TOGETHER = {"sum": np.add, "min": np.minimum}


def spread(frame: DataFrame) -> DataFrame:
    """At least as many partitions as cores: the work per row is long where many models read it."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def reduced(frame: DataFrame, numbers: int, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], how: str = "sum") -> np.ndarray:
    """``work`` makes ``numbers`` values from the batches of a partition; the values of all partitions are added (or their least taken)."""
    pieces = max(1, -(-numbers // PACKED))
    join = _TOGETHER[how]

    def partial(batches):
        total = np.asarray(work(batches), np.float64).ravel()
        data = [total[i * PACKED : (i + 1) * PACKED].tobytes() for i in range(pieces)]
        yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array(data, pa.binary())], ["piece", "data"])

    def together(table: pa.Table) -> pa.Table:
        first, *others = (np.frombuffer(d.as_py(), np.float64) for d in table.column("data"))
        total = first.copy()
        for v in others:
            join(total, v, out=total)
        return pa.table({"piece": table.column("piece")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    found = frame.mapInArrow(partial, _PIECE).groupBy("piece").applyInArrow(together, _PIECE).collect()
    return np.concatenate([np.frombuffer(r["data"], np.float64) for r in sorted(found)]) if found else np.zeros(0)
