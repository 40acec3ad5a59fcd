"""Bringing one small array a task together in rounds, so that no task or driver takes all of them at once."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

FAN_IN = 32
_SCHEMA = "number bigint, part array<double>"


def reduced(rows: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None],
            combine: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """``fold`` makes a flat array of a task's rows (None for none), ``combine`` one of up to FAN_IN such arrays.

    Arrays of neighbouring tasks are combined in rounds; each round is staged and leaves a FAN_IN-th of them, until
    the last few are combined into the result. None if no task had rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = fold(batches)
        if part is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([part], pa.list_(pa.float64()))], names=["number", "part"])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        return pd.DataFrame({"number": group["number"].iloc[:1] // FAN_IN, "part": [combine(list(group["part"]))]})

    parts = staged(rows.mapInArrow(run, _SCHEMA))
    while parts.count() > FAN_IN:
        parts = staged(parts.groupBy(F.floor(F.col("number") / FAN_IN).alias("group")).applyInPandas(together, _SCHEMA))
    last = [np.array(row["part"]) for row in parts.orderBy("number").collect()]
    return combine(last) if last else None
