"""Shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side of a join is broadcast only when its measured text size stays below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

_COMPLEX = (T.ArrayType, T.MapType, T.StructType)
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sluicemark-")
        spark.sparkContext.setCheckpointDir(f"{_local_dirs[app]}/checkpoints")
    return _local_dirs[app]


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it, if it isn't installed."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def new_folder(spark: SparkSession, label: str) -> str:
    """Fresh path in the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def new_database(spark: SparkSession, label: str) -> str:
    """Fresh catalog database whose tables live in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, label)}'")
    return name


def _size(df: DataFrame) -> Column:
    """Aggregate for the size of a frame: row count times the fixed widths plus the length of every text."""
    size = F.count(F.lit(1)) * (16 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (*_COMPLEX, T.StringType, T.BinaryType, T.VariantType)):
            value = F.to_json(F.struct(f"`{f.name}`")) if isinstance(f.dataType, _COMPLEX) else F.col(f"`{f.name}`").cast("string")
            size = size + F.coalesce(F.sum(F.octet_length(value)), F.lit(0))
    return size.alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """Size of the frame's values, from one scan with map-side sums of the columns whose width varies."""
    return df.agg(_size(df)).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit


def staged_with_size(df: DataFrame, label: str = "staged") -> tuple[DataFrame, int]:
    """The frame written once to the shared folder and read back, and its measured size.

    For a costly frame that a plan reads more than once: it is computed a single time, later
    reads take only the columns they need, and lost executors do not bring the work back.  The
    size is summed by the write itself, in whose last stage each task counts once.
    """
    folder, seen = new_folder(df.sparkSession, label), Observation()
    df.observe(seen, _size(df)).write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), seen.get["bytes"]


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """As ``staged_with_size``, for callers that do not need the size."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def resolve(df: DataFrame, names: list[str]) -> list[str]:
    """Map names to the frame's own spelling, ignoring case; unknown names are an error."""
    own = {c.lower(): c for c in df.columns}
    unknown = [n for n in names if n.lower() not in own]
    if unknown:
        raise ValueError(f"columns {unknown} not found in {df.columns}")
    return [own[n.lower()] for n in names]


def move_partitions(spark: SparkSession, folder: str, column: str, stem: str, suffix: str, parallel: int = 16) -> int:
    """Move the one file of each partition ``column=<n>`` of a written folder to ``<stem><n><suffix>``, and drop the folder.

    Files that already have such a name are removed first; only then are the new ones moved.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    for old in fs.globStatus(path(f"{stem}*{suffix}")) or []:
        fs.delete(old.getPath(), True)
    parts = [p.getPath() for p in fs.listStatus(path(folder)) if p.getPath().getName().startswith(f"{column}=")]

    def move(part) -> None:
        written = [f.getPath() for f in fs.listStatus(part) if not f.getPath().getName().startswith(("_", "."))]
        if len(written) != 1 or not fs.rename(written[0], path(f"{stem}{part.getName().split('=', 1)[1]}{suffix}")):
            raise OSError(f"cannot move the file of {part}")

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(move, parts))
    fs.delete(path(folder), True)
    return len(parts)
