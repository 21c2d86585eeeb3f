"""Scans and sinks."""
from __future__ import annotations

import os
import uuid
import weakref
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; column pruning and filters reach the scan through Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_source(spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table, or with ``jdbc`` options (url, driver, partitionColumn, ...) a remote
    table, whose filters and column lists Spark pushes into the remote query."""
    if jdbc is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(**jdbc_options(name, jdbc)).load()


class CatalogTables:
    """Base tables of a job in the session catalog, under any databases: indexed by the job's name
    for a table, read as the catalog's."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str], jdbc: Mapping[str, Mapping[str, str]] | None = None):
        """``names``: catalog table of each name; ``jdbc``: options of those that are remote."""
        self.spark, self.names, self.jdbc = spark, names, jdbc or {}

    def __getitem__(self, name: str) -> DataFrame:
        return read_source(self.spark, self.names[name], self.jdbc.get(name))


def add_to_catalog(spark: SparkSession, sf_dir: str, database: str, names: Iterable[str]) -> dict[str, str]:
    """External tables over stored files in a database of the session catalog, made if need be;
    dropping them leaves the files. Returns their names for ``CatalogTables``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_folder(spark, 'database')}'")
    made = {}
    for name in names:
        made[name] = f"{database}.{name}"
        if not spark.catalog.tableExists(made[name]):
            spark.catalog.createTable(made[name], path=os.path.join(sf_dir, f"{name}.parquet"), source="parquet")
    return made


def jdbc_options(name: str, given: Mapping[str, str]) -> dict[str, str]:
    """Options of a remote scan: pushdown on; a parallel read needs its column and both bounds."""
    options = {"dbtable": name, "pushDownPredicate": "true", "pushDownAggregate": "true", "fetchsize": "10000", **given}
    parallel = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} & set(options)
    if parallel and len(parallel) < 4:
        raise ValueError("partitionColumn, lowerBound, upperBound and numPartitions go together")
    return options


def load(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """Lazy handles for many tables at once (nothing is read until an action)."""
    return {n: read_table(spark, sf_dir, n) for n in names}


#: Stored bytes that one task of a shuffle takes; estimates from here on say nothing (a source without sizes).
TASK_BYTES, NO_ESTIMATE = 8 << 20, 1 << 60


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size (from files or literal rows; unknown counts as vast)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(df: DataFrame) -> int:
    """Tasks of a shuffle of ``df``: those of the session, or more where the table is large for them."""
    least, size = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(df)
    return least if size >= NO_ESTIMATE else max(least, -(-size // TASK_BYTES))


def extract_claims(df: DataFrame, since: str | None = None, cols: Iterable[str] | None = None,
                   date_col: str = "clm_from_dt", code_col: str = "clm_line_hcpcs_cd") -> DataFrame:
    """Pruned claim extract: a column list, an optional date floor (strictly after
    ``since``) on the raw column so it is pushed to the Parquet scan, and the procedure
    code trimmed."""
    out = df.select(*cols) if cols else df
    if since is not None:
        out = out.where(F.col(date_col) > F.lit(since).cast("date"))
    return out.withColumn(code_col, F.trim(F.col(code_col)))


class Owned:
    """Persisted intermediates, views and files that belong to one result.

    ``stage``, ``view`` and ``settle`` register with the innermost open owner; ``release``
    drops the frames' blocks, then the views (dropping a view also drops the blocks of its plan, so
    not before), then tables and files. ``owned_by`` ties the release to the result frame's lifetime.
    (A frame derived from the result stays right after that: Spark computes the blocks again.)

    A ``brief`` owner releases all at its end, its scratch folders too: nothing made inside is read later.
    Those of others stay until the driver ends.
    """

    _open: list[Owned] = []

    def __init__(self, brief: bool = False) -> None:
        self.brief = brief
        self.frames: list = []  # their JVM handles: a result may be one of them
        self.views: list[tuple[SparkSession, str]] = []
        self.tables: list[tuple[SparkSession, str]] = []
        self.folders: list = []  # file system and path

    def __enter__(self) -> Owned:
        Owned._open.append(self)
        return self

    def __exit__(self, *exc) -> None:
        Owned._open.remove(self)
        if self.brief:
            self.release()

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()
        while self.views:
            spark, name = self.views.pop()
            spark.catalog.dropTempView(name)
        while self.tables:
            spark, name = self.tables.pop()
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        while self.folders:
            files, path = self.folders.pop()
            files.delete(path, True)


_LOOSE = Owned()  # of frames staged outside any owner


def _owner() -> Owned:
    return Owned._open[-1] if Owned._open else _LOOSE


def owned_by(build, *args) -> DataFrame:
    """``build(*args)``, whose intermediates are released when the frame it returns is gone."""
    with Owned() as own:
        result = build(*args)
    weakref.finalize(result, own.release).atexit = False
    return result


def stage(df: DataFrame) -> DataFrame:
    """Keep an intermediate that several branches of one report read (memory, spilling to
    disk). Nothing runs until an action; lost blocks are recomputed from lineage.

    Its columns are kept as they are: dictionaries and run lengths, which Spark would try on each value,
    cost a third of the claim reports' time and save less than a third of the bytes. A frame keeps
    the setting that it was persisted under, so the session's own is put back at once."""
    _owner().frames.append(df._jdf)
    with setting(df.sparkSession, COMPRESSED, "false"):
        return df.persist(StorageLevel.MEMORY_AND_DISK)


COMPRESSED = "spark.sql.inMemoryColumnarStorage.compressed"
#: Whether a job's shuffle files go as soon as it has ended (else when the driver collects its garbage).
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Files that a task may write side by side.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting ``key`` is ``value`` inside, and as before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settle(df: DataFrame | Iterable[DataFrame], buckets: int | None = None, key: str | None = None, owner: Owned | None = None) -> DataFrame:
    """Write an intermediate to files of the shared folder and read it back: for large ones, whose blocks and
    shuffles would lie on disk side by side. Encoded columns take a fraction of the bytes of blocks, readers take
    the columns that they need, and the shuffle files go when all is written. Several frames are
    written one after the other. ``buckets`` of ``key``: read back dealt by it in so many tasks.
    ``owner``: whose the files are, if not the innermost open one's."""
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark = frames[0].sparkSession
    owner = owner or _owner()
    folder = scratch_folder(spark, "settled", owner)
    table = f"{spark.catalog.currentDatabase()}.caresight_{uuid.uuid4().hex}" if buckets else None
    if table:
        owner.tables.append((spark, table))
    # with writers for several buckets open at a time, a task's rows, which are of one, are not sorted by bucket
    with setting(spark, SHUFFLES_GO, "true"), setting(spark, WRITERS, "8"):
        for frame in frames:
            writer = frame.write.mode("append").option("compression", "zstd")
            if table:
                writer.bucketBy(buckets, key).format("parquet").option("path", folder).saveAsTable(table)
            else:
                writer.parquet(folder)
    return spark.table(table) if table else spark.read.schema(frames[0].schema).parquet(folder)


def view(df: DataFrame) -> str:
    """A name for ``df`` in SQL text, valid as long as the result it belongs to."""
    name = f"caresight_{uuid.uuid4().hex}"
    df.createTempView(name)
    _owner().views.append((df.sparkSession, name))
    return name


def scratch_folder(spark: SparkSession, kind: str, owner: Owned | None = None) -> str:
    """A new folder below the cluster's shared checkpoint folder, deleted when the driver ends or with a brief ``owner``
    (the innermost open one if not given)."""
    from caresight.session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(path)
    if (owner or _owner()).brief:
        (owner or _owner()).folders.append((files, path))
    return folder


def release_staged() -> None:
    """Release what was staged outside any owner."""
    _LOOSE.release()


def save_cohort(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> DataFrame:
    """Write a cohort table to shared storage and read it back (lineage is cut there)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_report(df: DataFrame, path: str, captions: Mapping[str, str] | None = None) -> None:
    """Replace the report at ``path`` (Parquet) in one step, its columns named by ``captions``.

    The new result is written aside; only when all of it is there do the folders change places. A
    write that fails leaves the former result as it was, and readers see one or the other.
    """
    spark = df.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target, aside, former = paths(path), paths(f"{path}.next-{uuid.uuid4().hex}"), paths(f"{path}.former-{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.withColumnsRenamed(dict(captions or {})).write.option("parquet.enable.summary-metadata", "false").parquet(aside.toString())
        had = files.exists(target)
        if had and not files.rename(target, former):
            raise OSError(f"cannot move the former result at {path}")
        if not files.rename(aside, target):
            if had:
                files.rename(former, target)
            raise OSError(f"cannot move the new result to {path}")
    finally:
        files.delete(aside, True)
    files.delete(former, True)


def write_report(df: DataFrame, path: str, fmt: str = "parquet",
                 display_names: Mapping[str, str] | None = None, single_file: bool = False) -> None:
    """Write a final result set; ``display_names`` renames columns to report captions.

    ``single_file`` is for small final reports only (it funnels rows into one task)."""
    out = df.withColumnsRenamed(dict(display_names or {}))
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)
