"""User functions over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def apply_batches(
    rows: DataFrame, fn: Callable[..., pd.DataFrame], schema: StructType | str, *args: object
) -> DataFrame:
    """Run ``fn(batch, *args)`` on every Arrow batch of ``rows`` and join the results.

    ``fn`` sees rows in no particular order, so it must return their keys with them.
    The batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch, *args)

    return rows.mapInPandas(run, schema)
