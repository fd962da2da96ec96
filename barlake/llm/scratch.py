"""Where operators keep intermediate tables, and how they walk over texts."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset a temporary folder takes its place, but only where all executors are threads
    of this machine; other machines would each see a folder of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="barlake-"))
        base = _LOCAL[0]
        spark.sparkContext.setCheckpointDir(f"file://{base}/checkpoints")
    return f"{base.rstrip('/')}/barlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and kept as Parquet in the shared folder; cuts lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and that column's name.

    Numbers hold for one evaluation only, so the rows are written down. They tell rows apart where
    ids are null or repeated.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    return stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered"), number


def find_package(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep) and root in sys.path:
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, environment.get("PYTHONPATH", "")) if x)


def over_texts(
    docs: DataFrame, work: Callable[[list, list[str]], dict], schema: str, rows: int = 512, arrow: bool = False
) -> DataFrame:
    """Apply ``work(ids, texts)`` to at most ``rows`` documents at a time; null texts become empty.

    Only ``doc_id`` and ``text`` are read, so extra columns of any name do no harm. ``work`` returns
    a dict of the columns of ``schema``; the number of rows is up to it. With ``arrow`` it gets the
    texts as an Arrow array.
    """
    find_package(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = part.column(1).fill_null("")
                out = work(part.column(0).to_pylist(), texts if arrow else texts.to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return narrow.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
