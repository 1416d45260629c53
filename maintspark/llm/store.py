"""Tables written to the shared folder (``spark.checkpoint.dir``) to cut lineage.

Executors may be lost at any time: a written table is read again from the folder that
the driver and all executors share, never from an executor's own disk.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table made by :func:`write_table` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(f).getParent()
        if folder.getName().startswith("llm-"):
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs now, instead of
    whenever the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
