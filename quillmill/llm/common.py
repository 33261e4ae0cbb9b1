"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``, read through Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent in a local session (tests) a local folder is made and
    recorded, so that later calls share it; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        base = tempfile.mkdtemp(prefix="quillmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/quillmill-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and a lost
    executor costs a re-read instead of a re-computation.  The table goes when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    """The column as a string, null as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))
