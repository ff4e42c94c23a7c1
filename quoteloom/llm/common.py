"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def importable(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where it lies.

    Executors on other machines get it with ``--py-files`` or from their image.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, level: int = 3) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    It cuts the lineage: what follows reads the files again after a lost executor and
    sees the same rows, also where the rows carry numbers of the partition they came from.
    ``level`` is that of the zstd codec.
    """
    path = shared_path(df.sparkSession, label)
    df.write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": level}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names; whatever else the table has can't clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of simple ``name type`` pairs, for the batches that tasks emit."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(n, kinds[t]) for n, t in (field.split(" ") for field in ddl.split(", "))])


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows (without copying)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
