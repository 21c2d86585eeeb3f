"""Helpers shared by the operators of this package."""
from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType
from xxhash import xxh64_intdigest

from caresight.session import ensure_checkpoint_dir

#: A key that holds at least 1/HOT_SHARE of all rows is hot; there are HOT_SHARE such keys at most.
HOT_SHARE = 1000

#: Words whose hash a worker remembers.
REMEMBERED = 100_000

_shipped: set[str] = set()


class _WordHashes(dict):
    """64-bit hash of each word, remembered within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


word_hashes = _WordHashes()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        to = Path(tempfile.mkdtemp(prefix="caresight-code-")) / "caresight_code.zip"  # on the driver; Spark sends it
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted((root / "caresight").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(to))
        _shipped.add(sc.applicationId)


def map_in_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, whatever the columns' names are
    (``function`` finds and returns columns by position)."""
    ship_code(df.sparkSession)
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = [f"c{i}" for i in range(len(out))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, plain)

    renamed = StructType([StructField(n, f.dataType, True) for n, f in zip(plain, out)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, renamed).toDF(*out.names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the given folder (any path that Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder in ``spark.checkpoint.dir`` and read from there.

    Reliable checkpoint: its files survive lost executors, and Spark removes them when the frame
    is no longer referenced (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under the folder in ``spark.checkpoint.dir`` and read from there.

    For wide rows: columns that a later step doesn't use are not read again. The files are removed
    when the driver ends.
    """
    spark = df.sparkSession
    to = f"{ensure_checkpoint_dir(spark)}/caresight-{uuid.uuid4().hex}"
    df.write.parquet(to)
    path = spark._jvm.org.apache.hadoop.fs.Path(to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.parquet(to)


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def join_by_key(facts: DataFrame, keyed: DataFrame, keys: Sequence[str], total: int) -> DataFrame:
    """Inner join of ``facts`` to ``keyed`` (one row per key, with ``n`` = its rows in ``facts``).

    Keys that hold at least 1/HOT_SHARE of the ``total`` rows are joined by broadcast: there are
    HOT_SHARE of them at most, whatever the data. All other keys are joined by a shuffle in which
    none can fill more than that share of a task. ``facts`` should be cheap to read twice.
    """
    hot = keyed.filter(F.col("n") * HOT_SHARE >= total).drop("n")
    rest = keyed.filter(F.col("n") * HOT_SHARE < total).drop("n")
    keys = list(keys)
    by_broadcast = facts.join(F.broadcast(hot), keys)
    by_shuffle = facts.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return by_broadcast.unionByName(by_shuffle)


def plainly_named(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..: whatever they were called, no name that an operator
    adds clashes with them. ``named_again`` gives the names back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def named_again(df: DataFrame, like: DataFrame) -> DataFrame:
    """The plainly named columns of ``df`` under the names that they have in ``like``."""
    return df.select(*[f"c{i}" for i in range(len(like.columns))]).toDF(*like.columns)


def by_bytes(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of text (UTF-8) each, one row at least."""
    import numpy as np

    for batch in batches:
        col = batch.column(text)
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
