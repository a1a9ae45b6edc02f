"""Tables of parquet files under versions: an upsert reads and rewrites only files that can hold its keys, and commits as a whole.

Layout of a table's folder::

    data/<run>/part-*.parquet       files of one write, sorted by key; never changed
    index/files/run=<run>/          a row per file: rows, and the range of its first key column as a whole number
    index/bits/run=<run>/           Bloom filters of its keys, a 4 KB bitmap per 2,500 keys
    index/removed/run=<run>/        the files that this write replaced
    versions/<n>.json               the runs that make up version n

A version exists once its small JSON file does, which is made complete under another name and then moved in one step that fails if the name is taken.
So a write that dies leaves the table as it was, readers see one version or the next and nothing between, and of two writers that began
from the same version one is refused.  Files that no version names are removed by ``remove_unreferenced``.

Which files can hold a key is worked out by joins: a file's key range becomes dyadic cells (see ``functions.dyadic``), a key asks for one cell per
level, and what meets is checked against the Bloom filter.  Nothing is compared with all files, and no key set is gathered.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dyadic import cells_of_point, cells_of_range, on_axis
from sluicemark.operators.merge import ACTION, INSERT, UPDATE, assert_unique_keys, upsert
from sluicemark.session import BROADCAST_LIMIT_BYTES, resolve, staged, staged_with_size

ROWS_PER_FILE = 1_000_000
# A bitmap of Spark's has 32,768 bits; with 2,500 keys and 4 bits a key, one other key in 200 looks as if it were there.
BITMAP_BITS, KEYS_PER_BITMAP, BITS_PER_KEY = 32_768, 2_500, 4
FILES = "file string, n_rows long, low long, high long, bitmaps int, run string"
BITS = "file string, bitmap int, bits binary, run string"
REMOVED = "file string, run string"


class ConflictError(RuntimeError):
    """Another writer committed first; begin again from the new version."""


@dataclass
class Version:
    """What makes up a version: the runs whose files count, and those whose list of replaced files does."""

    number: int
    keys: list[str]
    schema: dict
    made: str
    runs: list[str] = field(default_factory=list)
    removals: list[str] = field(default_factory=list)


# --- the folder -------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop, jvm


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path, _ = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop, jvm = _fs(spark, path)
    stream = fs.open(hadoop)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file could be made, complete and only if the name was free.

    On a local disk that is a hard link, elsewhere the file system's own rename, which does not replace a file.
    """
    fs, target, jvm = _fs(spark, path)
    parent, name = path.rsplit("/", 1)
    draft = jvm.org.apache.hadoop.fs.Path(f"{parent}/.{name}-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (fs.makeQualified(target), fs.makeQualified(draft))]
            jvm.java.nio.file.Files.createLink(*local)
            return True
        return not fs.exists(target) and fs.rename(draft, target)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(draft, False)


def latest_version(spark: SparkSession, folder: str) -> Version:
    numbers = [int(n[:-5]) for n in _names(spark, f"{folder}/versions") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        raise ValueError(f"no table in {folder}")
    return version(spark, folder, max(numbers))


def version(spark: SparkSession, folder: str, number: int) -> Version:
    return Version(**json.loads(_read_text(spark, f"{folder}/versions/{number}.json")))


def _commit(spark: SparkSession, folder: str, new: Version) -> None:
    if not _create_exclusive(spark, f"{folder}/versions/{new.number}.json", json.dumps(asdict(new))):
        raise ConflictError(f"version {new.number} of {folder} was committed by another writer")


def _schema(of: Version) -> T.StructType:
    return T.StructType.fromJson(of.schema)


# --- files and their index --------------------------------------------------------------------


def _file_name() -> Column:
    """A file's name below the data folder."""
    return F.substring_index(F.col("_metadata.file_path"), "/data/", -1)


def _hashes(keys: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)


def _bit_places(first: Column, second: Column) -> Column:
    """Places of a key in its bitmap."""
    step = second.bitwiseAND(BITMAP_BITS - 1)
    return F.array(*[(first.bitwiseAND(BITMAP_BITS - 1) + step * i + i * i).bitwiseAND(BITMAP_BITS - 1) for i in range(BITS_PER_KEY)])


def _bitmap_of(first: Column, bitmaps: Column) -> Column:
    return F.pmod(F.shiftright(first, 20), bitmaps).cast("int")


def _write_run(df: DataFrame, folder: str, keys: list[str], rows_per_file: int) -> str:
    """Write rows as files sorted by key, and their index; returns the name of the run.  Nothing refers to it yet."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    sort = [F.col(f"`{k}`") for k in keys]
    df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/data/{run}")
    # Only key columns are read back.
    first, second = _hashes(sort)
    written = spark.read.schema(df.schema).parquet(f"{folder}/data/{run}").select(
        _file_name().alias("file"), on_axis(sort[0], df.schema[keys[0]].dataType).alias("axis"), first.alias("h1"), second.alias("h2"),
        F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)).alias("null_key"),
    )
    files = written.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.when(~F.col("null_key"), F.col("axis"))).alias("low"), F.max(F.when(~F.col("null_key"), F.col("axis"))).alias("high")
    ).withColumn("bitmaps", F.ceil(F.col("n_rows") / KEYS_PER_BITMAP).cast("int"))
    files.write.parquet(f"{folder}/index/files/run={run}")
    named = written.filter("NOT null_key").join(spark.read.parquet(f"{folder}/index/files/run={run}").select("file", "bitmaps"), "file")
    places = named.select("file", _bitmap_of(F.col("h1"), F.col("bitmaps")).alias("bitmap"), F.explode(_bit_places(F.col("h1"), F.col("h2"))).alias("place"))
    bits = places.groupBy("file", "bitmap").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
    bits.repartitionByRange("file", "bitmap").sortWithinPartitions("file", "bitmap").write.parquet(f"{folder}/index/bits/run={run}")
    return run


def live_files(spark: SparkSession, folder: str, of: Version) -> DataFrame:
    """A row per file of the version, with its row count and key range."""
    files = spark.read.schema(FILES).parquet(f"{folder}/index/files").where(F.col("run").isin(of.runs))
    return files.join(_removed(spark, folder, of), "file", "left_anti")


def _removed(spark: SparkSession, folder: str, of: Version) -> DataFrame:
    if not of.removals:
        return spark.createDataFrame([], REMOVED)
    return spark.read.schema(REMOVED).parquet(f"{folder}/index/removed").where(F.col("run").isin(of.removals))


def _paths(folder: str, files: DataFrame) -> list[str]:
    """Paths of the files, as the driver's own listing of a scan holds them."""
    return [f"{folder}/data/{row[0]}" for row in files.select("file").collect()]


def _rows(spark: SparkSession, folder: str, of: Version, files: DataFrame) -> DataFrame:
    paths = _paths(folder, files)
    return spark.read.schema(_schema(of)).parquet(*paths) if paths else spark.createDataFrame([], _schema(of))


def read_snapshot(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """Rows of the latest version, or of version ``number``."""
    of = latest_version(spark, folder) if number is None else version(spark, folder, number)
    return _live_rows(spark, folder, of)


def _live_rows(spark: SparkSession, folder: str, of: Version) -> DataFrame:
    """Rows of a whole version.

    The folders of its runs are listed, one call a run, and replaced files are left out by name; naming each file would cost a look-up a file.  Only
    where more files were replaced than are live are the live ones named.
    """
    removed, live = _removed(spark, folder, of).where(F.substring_index("file", "/", 1).isin(of.runs)), live_files(spark, folder, of)
    if not of.runs or removed.count() > live.count():
        return _rows(spark, folder, of, live)
    rows = spark.read.schema(_schema(of)).parquet(*[f"{folder}/data/{run}" for run in of.runs])
    gone = [row[0] for row in removed.select("file").collect()]
    return rows.where(~_file_name().isin(gone)) if gone else rows


def files_for_keys(files: DataFrame, bits: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The files that can hold a key of the batch: key range first, then Bloom filter.  None is missed."""
    columns = [F.col(f"`{k}`") for k in keys]
    first, second = _hashes(columns)
    asked = batch.dropna(subset=keys).select(on_axis(columns[0], batch.schema[keys[0]].dataType).alias("axis"), first.alias("h1"), second.alias("h2"))
    ranges = staged(files.select("file", "bitmaps", F.inline(cells_of_range(F.col("low"), F.col("high")))), "ranges")
    levels = sorted(row[0] for row in ranges.select("level").distinct().collect())  # 64 at most
    points = asked.select("h1", "h2", F.inline(cells_of_point(F.col("axis"), levels)))
    meets = points.join(ranges, ["level", "cell"]).select("file", _bitmap_of(F.col("h1"), F.col("bitmaps")).alias("bitmap"), F.explode(F.array(F.struct("h1", "h2"))).alias("key"))
    at = lambda place: F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(place.cast("int"), 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = lambda place: F.call_function("shiftright", at(place), place.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
    found = meets.join(bits, ["file", "bitmap"]).where(F.forall(_bit_places(F.col("key.h1"), F.col("key.h2")), is_set))
    return found.select("file").distinct()


# --- writes -----------------------------------------------------------------------------------


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def create_snapshot_table(df: DataFrame, folder: str, keys: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """First version of a table; its folder must not hold one."""
    keys = resolve(df, keys)
    run = _write_run(df, folder, keys, rows_per_file)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    _commit(df.sparkSession, folder, Version(1, keys, nullable.jsonValue(), _now(), [run]))


def upsert_snapshot(folder: str, source: DataFrame, rows_per_file: int = ROWS_PER_FILE, base: Version | None = None) -> dict[str, int]:
    """Upsert a frame that holds one row per key; only files that can hold one of its keys are read and written anew.

    Returns version, files_kept, files_rewritten, files_written, rows_inserted and rows_updated.  The commit fails with ``ConflictError`` if another one
    came in since ``base``, by default the version that is the latest now.
    """
    spark = source.sparkSession
    base = base or latest_version(spark, folder)
    schema, keys = _schema(base), base.keys
    typed = source.select(*[F.col(f"`{own}`").cast(f.dataType).alias(f.name) for f, own in zip(schema, resolve(source, schema.names), strict=True)])
    batch, size = staged_with_size(typed)
    assert_unique_keys(batch, keys)
    live = staged(live_files(spark, folder, base), "live")
    bits = spark.read.schema(BITS).parquet(f"{folder}/index/bits").where(F.col("run").isin(base.runs)).drop("run")
    touched = staged(files_for_keys(live, bits, batch, keys), "touched")
    merged = upsert(_rows(spark, folder, base, touched), batch, keys, size <= BROADCAST_LIMIT_BYTES, with_action=True, source_is_unique=True)
    # What is written twice, sorted and as it comes, is counted once.
    counted, seen = staged(merged, "merged"), Observation()
    counts = counted.observe(seen, F.count_if(F.col(ACTION) == INSERT).alias("rows_inserted"), F.count_if(F.col(ACTION) == UPDATE).alias("rows_updated"))
    counts.agg(F.count(F.lit(1))).collect()
    run = _write_run(counted.drop(ACTION), folder, keys, rows_per_file)
    touched.write.parquet(f"{folder}/index/removed/run={run}")
    new = Version(base.number + 1, keys, base.schema, _now(), [*base.runs, run], [*base.removals, run])
    _commit(spark, folder, _pruned(spark, folder, new))
    n_live, gone = live.count(), touched.count()
    written = spark.read.schema(FILES).parquet(f"{folder}/index/files").where(F.col("run") == run).count()
    return {"version": new.number, "files_kept": n_live - gone, "files_rewritten": gone, "files_written": written, **seen.get}


def _pruned(spark: SparkSession, folder: str, of: Version) -> Version:
    """The version without runs that have no file left, and without lists that only name files of such runs: a few names per run."""
    runs = [row[0] for row in live_files(spark, folder, of).select("run").distinct().collect()]
    matters = _removed(spark, folder, of).where(F.substring_index("file", "/", 1).isin(runs)).select("run").distinct().collect()
    return Version(of.number, of.keys, of.schema, of.made, sorted(runs), sorted(row[0] for row in matters))


def remove_unreferenced(spark: SparkSession, folder: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Drop versions replaced longer ago than ``older_than``, and runs no version names; returns the number of runs removed.

    A run that is not yet committed looks like one that never will be, so runs younger than that stay.
    """
    numbers = sorted(int(n[:-5]) for n in _names(spark, f"{folder}/versions") if n.endswith(".json") and n[:-5].isdigit())
    made = [version(spark, folder, n) for n in numbers]
    now = dt.datetime.now(dt.timezone.utc)
    kept = []
    for old, new in zip(made, [*made[1:], None]):
        if new is not None and now - dt.datetime.fromisoformat(new.made) >= older_than:
            fs, path, _ = _fs(spark, f"{folder}/versions/{old.number}.json")
            fs.delete(path, False)
        else:
            kept.append(old)
    named = {run for v in kept for run in [*v.runs, *v.removals]}
    removed = 0
    for run in _names(spark, f"{folder}/data"):
        fs, path, _ = _fs(spark, f"{folder}/data/{run}")
        age = dt.timedelta(milliseconds=now.timestamp() * 1000 - fs.getFileStatus(path).getModificationTime())
        if run not in named and age >= older_than:
            for part in (f"{folder}/data/{run}", *[f"{folder}/index/{kind}/run={run}" for kind in ("files", "bits", "removed")]):
                fs.delete(_fs(spark, part)[1], True)
            removed += 1
    return removed


def compact_snapshot(spark: SparkSession, folder: str, rows_per_file: int = ROWS_PER_FILE, least_files: int = 16) -> int:
    """Write files of under half ``rows_per_file`` rows together, if there are ``least_files`` of them; returns how many were replaced."""
    base = latest_version(spark, folder)
    small = staged(live_files(spark, folder, base).where(F.col("n_rows") * 2 < rows_per_file), "small")
    n = small.count()
    if n < least_files:
        return 0
    run = _write_run(_rows(spark, folder, base, small), folder, base.keys, rows_per_file)
    small.select("file").write.parquet(f"{folder}/index/removed/run={run}")
    new = Version(base.number + 1, base.keys, base.schema, _now(), [*base.runs, run], [*base.removals, run])
    _commit(spark, folder, _pruned(spark, folder, new))
    return n


def lookup_snapshot(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is in ``wanted``; only files that can hold one are read."""
    of = latest_version(spark, folder)
    asked = wanted.select(*[F.col(f"`{own}`").cast(_schema(of)[k].dataType).alias(k) for k, own in zip(of.keys, resolve(wanted, of.keys), strict=True)])
    bits = spark.read.schema(BITS).parquet(f"{folder}/index/bits").where(F.col("run").isin(of.runs)).drop("run")
    files = files_for_keys(staged(live_files(spark, folder, of), "live"), bits, asked, of.keys)
    return _rows(spark, folder, of, files).join(asked, of.keys, "left_semi")
