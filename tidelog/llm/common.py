"""What the operators of this package share: batches for Python tasks, held-out rows, staged tables."""

from __future__ import annotations

import sys
import types as pytypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import shared_dir

#: Limits of one Arrow batch, so that a worker's memory does not follow the length of texts.
BATCH_ROWS = 10_000
BATCH_BYTES = "8m"

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
    "array<float>": pa.list_(pa.float32()),
    "array<double>": pa.list_(pa.float64()),
}


def bounded_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def arrow_schema(columns: dict[str, str]) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in columns.items()])


def map_rows(
    df: DataFrame, inputs: list[str], start: Callable[[], Callable[..., dict]], columns: dict[str, str], drop: tuple = ()
) -> DataFrame:
    """``df`` with the columns that a Python function makes from ``inputs``, batch by batch.

    ``start()`` runs once a task and returns the function; it gets one list for
    each input and returns the lists of the new columns. All other columns pass
    untouched; a new column takes the place of one of the same name, those in
    ``drop`` go.
    """
    bounded_batches(df.sparkSession)
    made_schema = arrow_schema(columns)
    kept = [f for f in df.schema.fields if f.name not in columns and f.name not in drop]
    given = df.select(
        *(F.col(f"`{f.name}`") for f in kept), *(F.col(f"`{name}`").alias(f"in_{i}_") for i, name in enumerate(inputs))
    )
    n = len(kept)

    def task(batches):
        step = start()
        for batch in batches:
            made = step(*(c.to_pylist() for c in batch.columns[n:]))
            arrays = [pa.array(made[f.name], f.type) for f in made_schema]
            fields = [batch.schema.field(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], schema=pa.schema([*fields, *made_schema]))

    return given.mapInArrow(task, T.StructType([*kept, *T.StructType.fromDDL(ddl(columns)).fields]))


def worker_store(name: str) -> dict:
    """A dictionary that outlives the task: later tasks of the same worker find it again."""
    module = sys.modules.setdefault("tidelog_worker_store", pytypes.ModuleType("tidelog_worker_store"))
    return module.__dict__.setdefault(name, {})


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text, whose remainder is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, lost executors cost nothing."""
    path = new_folder(df.sparkSession, label)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def aside(df: DataFrame, *named: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``named`` columns, and all others in one struct, so that no name used on the way clashes with theirs."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in named and c not in drop]
    return df.select(*named, *([F.struct(*others).alias("others_")] if others else []))


def beside(df: DataFrame, *named: str) -> DataFrame:
    """``named`` columns, and those that ``aside`` put away."""
    return df.select(*named, *(["others_.*"] if "others_" in df.columns else []))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
