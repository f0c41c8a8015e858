"""pandas inside tasks in small frames: a worker's memory follows its largest rows, not the length of Spark's batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of a frame, and its bytes by the mean row of its batch; a row is never cut.
ROWS, BYTES = 256, 4 << 20


def small(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = BYTES) -> Iterator[pd.DataFrame]:
    """All rows of the batches in their order. Integers with nulls stay whole; structs are dicts."""
    for batch in batches:
        step = max(1, min(rows, size * batch.num_rows // max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step).to_pandas(integer_object_nulls=True)


def map_frames(rows: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: StructType | str) -> DataFrame:
    """As ``mapInPandas``, but in small frames; each frame that ``run`` gives goes on at once."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(small(batches)):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return rows.mapInArrow(work, schema)
