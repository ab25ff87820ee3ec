"""Tables that a job keeps between its steps, in the folder that all executors share."""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

from edilake.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/llm/{name}-{uuid.uuid4().hex}"


_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: no lineage to replay when executors are lost."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def remove(*kept: DataFrame) -> None:
    """Delete tables that ``keep`` returned. For tables that no later step reads: what was derived from them must be kept
    itself by then."""
    for df in kept:
        path = _path_of.pop(df, None)
        if path is not None:
            jvm, spark = df.sparkSession.sparkContext._jvm, df.sparkSession
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
