"""Reading tables, Arrow passes over rows and writing intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfscan.session import fresh_folder

#: Rows that one Arrow batch hands to Python, and bytes after which Spark ends a batch early.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small, as texts may be long, and let Python workers find this package
    where the driver found it."""
    spark.sparkContext.environment.setdefault(
        "PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts the lineage, so that a
    lost executor costs no recomputation of what lies before."""
    spark = frame.sparkSession
    path = fresh_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_pass(
    frame: DataFrame,
    schema: str,
    make: Callable[[], Callable[[list[list]], list[list]]],
) -> DataFrame:
    """Map rows in Arrow batches.

    ``make`` runs once per task and returns a function from the input columns of a batch,
    as Python lists, to the output columns.
    """
    out = arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            columns = step([column.to_pylist() for column in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(columns, out)],
                schema=out)

    return frame.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
