"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch. Batches are cut small first, so that long texts never pile up in one."""
    scratch.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield fn(piece)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of about ``most_bytes`` each; a longer single row stays one piece."""
    rows = max(1, batch.num_rows)
    step = max(1, int(most_bytes // max(1, batch.nbytes // rows)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def text_columns(docs: DataFrame, *names: str) -> DataFrame:
    """``doc_id`` and the text with null as empty; every other column is dropped, whatever it is called."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *names)
