"""Session construction and lineage cutting.

On a cluster the session comes from the platform; ``build_session`` is for
local runs and tests.  ``checkpoint`` and ``written`` always write to the shared
folder named by ``spark.checkpoint.dir``; a fresh scratch folder is used only
when that setting is absent on a ``local[...]`` master (tests), else they raise.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "bankspark") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        # checkpoint files are removed once the DataFrames that own them are unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BANKSPARK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder is invented only for ``local[...]`` masters."""
    sc = spark.sparkContext
    path = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"{_CKPT_KEY} must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="bankspark-ckpt-")
        spark.conf.set(_CKPT_KEY, path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB for the Python workers, unless the session has a limit of its own: a batch stands
    in the executor and in the worker at once, so whole texts in Spark's batches (64 MB) take hundreds of MB."""
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts the lineage, survives
    lost executors, and keeps column pruning and filter pushdown for the readers."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/bankspark-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise to the shared folder and cut lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_all(*dfs: DataFrame) -> list[DataFrame]:
    """Checkpoint independent DataFrames concurrently: their jobs share the cluster
    instead of queueing behind each other (same result as checkpointing one by one)."""
    from concurrent.futures import ThreadPoolExecutor

    if len(dfs) <= 1:
        return [checkpoint(d) for d in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(checkpoint, dfs))

