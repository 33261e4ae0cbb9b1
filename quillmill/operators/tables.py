"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def written(df: DataFrame) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back; without that setting a local
    session, as in tests, gets a local folder, and a cluster an error.  The table goes when the
    driver ends."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        base = tempfile.mkdtemp(prefix="quillmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, for costly Python on a small input that came in few partitions;
    a larger one is left as it is and not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
