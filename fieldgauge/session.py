"""Session settings and the scratch folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings that hold at any scale; those that depend on the input come from sizing().
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
}


MIB = 1024**2
SPLIT_BYTES = (128 * MIB, 1024 * MIB)
SHUFFLE_PARTITION_BYTES = (256 * MIB, 2048 * MIB)
SHUFFLE_BLOCKS = 10**9

# The folder of a local session without spark.checkpoint.dir, which can't be set on a running session.
_local_scratch: dict[str, str] = {}


def sizing(input_bytes: int) -> dict[str, str]:
    """Settings for a run that reads and shuffles about ``input_bytes``.

    Small inputs get splits of 128 MiB and shuffle partitions of 256 MiB, so that a
    sort stays in memory. Both grow together, without a jump, once map tasks times
    partitions would exceed SHUFFLE_BLOCKS, up to 1 and 2 GiB; partitions of that
    size may spill. Beyond, load in steps (``run_daily(max_days=...)``): 100 TiB at
    once would still be five thousand million blocks.
    """
    blocks = (input_bytes / SPLIT_BYTES[0]) * (input_bytes / SHUFFLE_PARTITION_BYTES[0])
    growth = max(1.0, (blocks / SHUFFLE_BLOCKS) ** 0.5)
    split = min(SPLIT_BYTES[1], int(SPLIT_BYTES[0] * growth))
    partition = min(SHUFFLE_PARTITION_BYTES[1], int(SHUFFLE_PARTITION_BYTES[0] * growth))
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // partition))),
        "spark.sql.files.maxPartitionBytes": f"{split // MIB}m",
    }


def build_session(
    app_name: str = "fieldgauge", master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**DEFAULTS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """New empty folder for staged tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so every
    executor sees it and a lost executor loses nothing. Only a local session
    without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_scratch.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="fieldgauge-")
        _local_scratch[spark.sparkContext.applicationId] = base
    path = f"{base.rstrip('/')}/fieldgauge-{label}-{uuid.uuid4().hex}"
    file_system, jvm_path = _hadoop_path(spark, path)
    file_system.mkdirs(jvm_path)
    file_system.deleteOnExit(jvm_path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, jvm_path = _hadoop_path(spark, path)
    return file_system.exists(jvm_path)


def remove_path(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _hadoop_path(spark, path)
    file_system.delete(jvm_path, True)


def _children(spark: SparkSession, path: str) -> list:
    file_system, jvm_path = _hadoop_path(spark, path)
    return list(file_system.listStatus(jvm_path)) if file_system.exists(jvm_path) else []


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, size) of the data files in a folder; none if it doesn't exist."""
    found = [(s.getPath().getName(), s.getLen()) for s in _children(spark, path) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    return sorted(s.getPath().getName() for s in _children(spark, path) if s.isDirectory())


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    file_system, jvm_path = _hadoop_path(spark, path)
    return file_system.getFileStatus(jvm_path).getModificationTime()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with its whole text at once; False if it exists.

    The text is written aside and renamed, which fails where the target exists.
    """
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    file_system, jvm_aside = _hadoop_path(spark, aside)
    stream = file_system.create(jvm_aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    target = file_system.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    refusing = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(file_system.makeQualified(jvm_aside), target, refusing)
    except Py4JJavaError as error:
        file_system.delete(jvm_aside, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    file_system, jvm_path = _hadoop_path(spark, path)
    stream = file_system.open(jvm_path)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text
