"""What the operators share: a folder all executors see, stage tables, stable shares and ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.folders import shared_folder

#: White space of the contracts: blank, and tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it, and a lost executor costs only a reread."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Deletes a table of ``written`` that no later step reads."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written in here leave no shuffle files behind, so that many rounds take the disk of one."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Python workers get this many documents at a time, so their memory follows the batch and not the partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def remainder(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % of


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns or ("doc_id", "text"))


def groups_for(rows: int, each: int, least: int = 1) -> int:
    """How many groups hold about ``each`` rows."""
    return max(least, -(-rows // each))


def hash_cutoffs(counts: dict, wanted: Callable[[object], int], factor: int = 2) -> dict:
    """For each key with so many rows: the 64-bit hash below which about ``factor`` times the wanted rows fall."""
    return {k: (1 << 63) - 1 if factor * wanted(k) >= n else -(1 << 63) + (1 << 64) * factor * wanted(k) // n for k, n in counts.items()}


def below_cutoff(key: str, hashed: Column, cutoffs: dict) -> Column:
    """Whether the hash of a row is at most the cutoff of its key; there are few keys."""
    held = [F.when(F.col(key) == k, hashed <= F.lit(cut)) for k, cut in cutoffs.items()]
    return F.coalesce(*held, F.lit(False))
