"""Helpers that several operators of this folder share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``. Where that is unset, a local session gets a temporary
    one; a cluster has no folder to share then, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="stayledger-llm-"))
    return _own_folder[0]


def store(df: DataFrame, name: str, by: list[str] | None = None, **options: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder, in parts ``by`` columns, and read it back: it
    is computed once, and lost executors cost no recomputation of what came before."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by or []).options(**({"compression": "zstd"} | options)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, df: DataFrame) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(docs: DataFrame, id: str = "doc_id", text: str = "text", without_id: bool = False) -> DataFrame:
    """``id`` as long and ``text`` as UTF-8 bytes (null: empty), without the other columns.
    Rows without an id stay if ``without_id`` says so; else no result could name them."""
    small_batches(docs.sparkSession)
    return docs.where(F.lit(without_id) | F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows that cross to Python at once: texts can be long, and both sides hold a
    batch in memory. A smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def pieces(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that what Python holds of long texts stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """File of a public vocabulary: in ``folder``, or where the installed package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
