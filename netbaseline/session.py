"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "netbaseline", rocksdb_state: bool = False) -> SparkSession:
    """A session with the settings the engine expects.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle width then should be sized to the input (about 128-256 MB per
    partition after the partial aggregation).  ``rocksdb_state=True`` keeps
    streaming state (one open window per series and level) off the JVM heap
    with incremental commits: the choice for a cluster with millions of
    series; on small local runs its per-partition start-up costs more than it
    saves.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if rocksdb_state:
        builder = (builder
                   .config("spark.sql.streaming.stateStore.providerClass",
                           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
                   .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"))
    return (builder
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``.  Only when
    that is unset in a local session (as in tests) is one chosen here, below
    the warehouse folder, and registered with the SparkContext so that
    ``DataFrame.checkpoint()`` uses the same place.  On a cluster an unset
    folder is an error: no machine's own folder is shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    sc.setCheckpointDir(f"{warehouse.rstrip('/')}/_netbaseline_checkpoints")
    return sc.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of :func:`scratch_root` for one run."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read again: computed once, its lineage cut."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
