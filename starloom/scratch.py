"""Tables in the folder that driver and executors share: how long jobs cut their lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in a single-process session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    made = tempfile.mkdtemp(prefix="starloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Paths of the tables that this process wrote and has not removed yet, in their order.
_made: list[str] = []


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write a table into the shared folder and read it again: cuts the lineage, and outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        _remove(spark, path)
        _made[:] = [x for x in _made if x.rsplit("/", 1)[-1] != path.rsplit("/", 1)[-1]]


def mark() -> int:
    """How many tables there are; for clear()."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0, keep: tuple[DataFrame, ...] = ()) -> None:
    """Remove the tables that operators wrote after the mark() `since`, but those that `keep` reads: for when all results built on them are written elsewhere."""
    kept = {f.rsplit("/", 2)[-2] for df in keep for f in df.inputFiles()}
    for path in [x for x in _made[since:] if x.rsplit("/", 1)[-1] not in kept]:
        _remove(spark, path)
        _made.remove(path)
