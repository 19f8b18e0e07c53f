"""Helpers that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []  # folders of this process that are not deleted


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names it. Only in a session of one machine (tests, bench) that has
    neither that setting nor a checkpoint folder, a temporary folder is set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: what was computed survives the loss of executors, and later
    uses read only the columns that they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Delete what ``stored`` writes inside the block, at its end, but for the last folder and those put into the list."""
    begin, keep = len(_written), []
    yield keep
    last = _written[-1:]
    for path in _written[begin:]:
        if path not in keep and path not in last:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _written[begin:] = [x for x in _written[begin:] if x in keep or x in last]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
