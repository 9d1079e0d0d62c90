"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.staging import shared_folder

#: Spark's setting that deletes the shuffle files of an execution at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for the bytes of an Arrow batch, its default, and what the operators need: a batch of texts is held several times over in both processes.
BATCH, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20
#: What a Python worker remembers from task to task, by operator, and the operator it works for.
_REMEMBERED: dict[str, dict] = {}
_AT_WORK = ""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage like ``checkpoint()``, but computes the plan once instead of twice, keeps
    column pruning, and survives the loss of executors because the files are in shared storage. The shuffle files of the
    write are of no more use then, and Spark deletes them; the session's own setting for that is put back. The tables themselves
    stay, as results are lazy, until ``loomlake.staging.drop_staged``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def remembered(operator: str, table: dict) -> dict:
    """``table``, which ``works_for`` empties when the worker turns to another operator."""
    _REMEMBERED[operator] = table
    return table


def works_for(operator: str) -> None:
    """Spark's Python workers live on from stage to stage: what they remember for other operators goes, so that it does not add up. No result depends on it."""
    global _AT_WORK
    if operator != _AT_WORK:
        _AT_WORK = operator
        for name, table in _REMEMBERED.items():
            if name != operator:
                table.clear()


def free_prefix(df: DataFrame, names: list[str]) -> str:
    """Underscores enough that no column of ``df`` is called prefix + name."""
    prefix, taken = "_", {c.lower() for c in df.columns}
    while any(f"{prefix}{n}".lower() in taken for n in names):
        prefix += "_"
    return prefix


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def doc_crc(doc_id: Column) -> Column:
    """CRC-32 of the id written as decimal text (null: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def batched(docs: DataFrame) -> DataFrame:
    """``docs``, to be handed to Python in batches of BATCH_BYTES. Results are lazy and the setting counts when they run, so the session gets it, unless it has another than Spark's default."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH, f"{DEFAULT_BATCH}b").rstrip("bB") == str(DEFAULT_BATCH):
        conf.set(BATCH, str(BATCH_BYTES))
    return docs
