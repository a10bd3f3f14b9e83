"""Session helpers."""

import re
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "epigrid", settings: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and the local bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Settings that the operators profit from; values the session already has are kept.

    The threshold lets the runtime re-plan use a hash join where every partition to be hashed is measured to be small.
    Skewed join partitions are split.
    """
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    }
    known = spark.conf.getAll
    for key, value in wanted.items():
        if known.get(key) in (None, "0", "0b"):
            spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession, size: str = "8m") -> SparkSession:
    """Bound the bytes of an Arrow batch, which stands in the executor's memory and in the Python worker's at once; a value that the
    session already has is kept."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, size)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names: executors and driver share it.

    Only a session on a single machine (`local[...]`) may go without; it gets a temporary folder of its own. Elsewhere that is
    an error, because a machine-local folder does not survive the loss of an executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="epigrid-")
        warnings.warn(f"spark.checkpoint.dir is not set; intermediate tables go to {folder}", stacklevel=3)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back; `options` are further ones of the Parquet writer.

    The rest of a query then starts from stored rows: its plan stays small and a lost executor costs a read, not a
    recomputation. The stored tables stay until the owner of the folder cleans it.
    """
    path = f"{shared_folder(df.sparkSession)}/epigrid-{label}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
