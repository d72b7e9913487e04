"""What the operators of this subpackage share: table reading, durable intermediate tables, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that contracts of this subpackage speak of.
SPACES = r"[\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. On one machine (a local master) a temporary one where that is unset, on a cluster an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "path" not in _own_folder:
        _own_folder["path"] = tempfile.mkdtemp(prefix="cohortloom-")
    return _own_folder["path"]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: a cut of the lineage that outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one operator, all removed together once its result is a written table itself."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.paths = spark, label, []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/{self.label}-{label}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, but_last: int = 0) -> None:
        keep = self.paths[len(self.paths) - but_last :]
        for path in self.paths[: len(self.paths) - but_last]:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths = keep


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def split_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text, remainder 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def texts_of(batch: pa.RecordBatch, column: str = "text", rows: int = 256) -> Iterator[str]:
    """The texts of a batch, a few rows of which are Python strings at a time."""
    for at in range(0, batch.num_rows, rows):
        yield from batch.column(column).slice(at, rows).to_pylist()


def map_arrow(df: DataFrame, per_batch: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function made once per task by ``per_batch()``, so that its caches and models live that long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = per_batch()
        for batch in batches:
            if batch.num_rows and (out := step(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)
