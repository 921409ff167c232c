"""Session construction and the shared work folder.

Scratch data (staged stream inputs, targets, stream checkpoints) goes below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent (local runs, tests) is a private folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 128 MB scan splits; after a shuffle AQE merges small partitions (towards its default
    # advisory size, 64 MB) and splits skewed ones, so the static partition count only has
    # to be large enough: build_session(input_bytes=...) derives it
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Coercion builds wide expression trees; let HotSpot JIT-compile the large methods
    # whole-stage codegen generates instead of interpreting them (applies at JVM start).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}

_LOCAL_WORK: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "keelson",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, input_bytes: int | None = None) -> SparkSession:
    """A session with the settings every operator here assumes (UTC, AQE). ``input_bytes``
    sizes the shuffle partitions for an input of that size."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(input_bytes: int, per_partition: int = 128 << 20,
                           minimum: int = 200) -> int:
    """A ``spark.sql.shuffle.partitions`` that keeps every shuffle partition near
    ``per_partition`` bytes for an input of ``input_bytes`` (100 TB → about 800k).

    AQE coalesces partitions that turn out small, so erring high costs little; erring low
    makes tasks spill.
    """
    return max(minimum, -(-int(input_bytes) // per_partition))


def _configured_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return d or None


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder below the shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only a local master may go without
    it (tests): a private folder is then made once per session and registered as the
    checkpoint folder. On a cluster every machine would write to a disk of its own, so a
    missing setting is an error there.
    """
    base = _configured_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        key = spark.sparkContext.applicationId
        base = _LOCAL_WORK.get(key)
        if base is None:
            base = tempfile.mkdtemp(prefix="keelson-work-")
            _LOCAL_WORK[key] = base
            spark.sparkContext.setCheckpointDir(os.path.join(base, "rdd-checkpoints"))
    base = base.rstrip("/")
    sub = f"{name}-{uuid.uuid4().hex[:12]}" if name else uuid.uuid4().hex[:12]
    return f"{base}/keelson/{sub}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the shared folder."""
    work_dir(df.sparkSession)  # a local session may have no checkpoint folder yet
    return df.checkpoint(eager=True)
