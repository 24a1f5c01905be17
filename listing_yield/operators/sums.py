"""Sums of large arrays over all tasks, added up in a tree.

Each task gives the arrays of its own rows, cut into blocks, as (clave, bloque, tarea, datos): a key, the block's number,
the task's and the block's doubles.  ``FAN`` tasks' blocks are added in one task, again and again, so the driver gets one
array for each key and block, whatever the number of tasks, and fetches it as bytes instead of one row a number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 32
PARTS = "clave int, bloque int, tarea long, datos binary"


def _adder(fan: int | None):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        rows = []
        for batch in batches:
            for key, block, task, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = (key, block, task // fan if fan else 0)
                x = np.frombuffer(data)
                sums[at] = sums[at] + x if at in sums else x
        for (key, block, task), x in sums.items():
            rows.append((key, block, task, x.tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["clave", "bloque", "tarea", "datos"])
    return add


def tree_sums(parts: DataFrame, tasks: int) -> dict[tuple[int, int], np.ndarray]:
    """The sum of each (key, block) over the ``tasks`` tasks that gave ``parts``."""
    while tasks > FAN:
        tasks = math.ceil(tasks / FAN)
        parts = parts.repartition("clave", "bloque", F.floor(F.col("tarea") / FAN)).mapInArrow(_adder(FAN), PARTS)
    last = parts.repartition("clave", "bloque").mapInArrow(_adder(None), PARTS)
    return {(r.clave, r.bloque): np.frombuffer(r.datos) for r in last.collect()}
