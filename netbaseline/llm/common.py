"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netbaseline.session import fresh_folder

# A word is a run of anything but ASCII blanks (space and \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()

# Rows an Arrow batch takes to a Python worker: texts are long, and two workers
# share an executor's memory with its JVM.
ARROW_ROWS = 2_000
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
# And bytes: a batch of long texts exists several times over, in the JVM, in Arrow and as Python objects.
ARROW_BYTES = 1 << 20
_ARROW_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's modules, once per application, and bound Arrow batches.

    The driver zips the sources and Spark's file server hands them out, so
    that Python functions run on executors where the package isn't installed.
    Arrow batches get ``ARROW_ROWS`` rows and about ``ARROW_BYTES`` bytes at most unless the application sets a number.
    """
    for key, value in ((_ARROW_KEY, ARROW_ROWS), (_ARROW_BYTES_KEY, ARROW_BYTES)):
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, str(value))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="netbaseline-"), "netbaseline_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_folders: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared scratch folder and read again.

    Cuts the lineage: a lost executor never forces more than one step to be
    computed again, and several readers share one computation.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables made by :func:`stored` from the scratch folder, once nothing that is still to run reads them."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(_folders.pop(df))
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null: the ends of words are counted in one regex pass."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
