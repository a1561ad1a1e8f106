"""Session helpers. Library code never creates a session; these are for tests, bench and tools."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "cohortflow", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def session_key(spark: SparkSession) -> tuple:
    """Identity of a running application."""
    try:
        return (id(spark), spark.sparkContext.applicationId)
    except Exception:  # noqa: BLE001  (no SparkContext on a remote session)
        return (id(spark), spark.conf.get("spark.app.id", ""))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset (tests)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints must survive executor loss)")
        conf = tempfile.mkdtemp(prefix="cohortflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(conf)
    return conf


_WRITTEN: dict[str, list[str]] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared checkpoint folder and read again.

    They are computed once (an eager ``checkpoint`` computes them twice), their size is known to the
    planner, and a lost executor takes nothing with it. ``drop_intermediates`` removes them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cohortflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def intermediates(spark: SparkSession) -> int:
    """The number of folders that ``cut_lineage`` has written in this application and that are still there."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def drop_intermediates(spark: SparkSession, since: int = 0, keep: list[str] | None = None) -> int:
    """Delete what ``cut_lineage`` wrote in this application, but for the first ``since`` folders and those that
    hold a file of ``keep``; call it when no frame made from it is needed any more. Returns the number of folders."""
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    held = {part for f in keep or () for part in f.split("/")}
    paths = [p for p in written[since:] if p.rsplit("/", 1)[1] not in held]
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        written.remove(p)
    return len(paths)
