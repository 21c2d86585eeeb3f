"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + w.x + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise
interactions in time linear in a text's features. Words go to 2^BITS buckets by hash; a text's word
counts have length 1 as a vector. Statistics are standardised by the sample's mean and deviation.
The only metadata is the table's n_chars (where there is one); labels, language, source and id are
never inputs.

It is fitted by Adagrad on a bounded sample: the SAMPLE labelled rows of lowest hash among those
outside the held-out fifth (crc32 of the id as text, modulo 5, is 0). All rows are scored in place.

Defined cases: null or empty text: zero words, scored by its statistics. Null id: scored, never
fitted on, not held out. Repeated rows: a row each. Repeated labels: the lowest counts. No labels:
every score is 0.5. Empty table: no rows. Extra columns are not read.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table, word_hashes

BITS, FACTORS, SAMPLE, EPOCHS, BATCH, RATE, SHRINK, SEED = 15, 8, 8_000, 6, 128, 0.08, 1e-5, 7
HELD_OUT = 5
LETTERS, CAPITALS, DIGITS, ENDS = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?"))
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>{}[]\\^~=+_@", np.uint8))
STATISTICS = 15


def features(text: str | None, chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of a text's words, and its statistics (``chars``: the table's n_chars)."""
    raw = (text or "").encode()
    words = raw.lower().split()
    n, size = len(words), max(1, len(raw))
    h = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, n)
    buckets, counts = np.unique(h & np.uint64((1 << BITS) - 1), return_counts=True)
    values = counts / max(1.0, np.sqrt((counts * counts).sum()))
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters, capitals = seen[LETTERS].sum(), seen[CAPITALS].sum()
    distinct = len(np.unique(h))
    statistics = [
        np.log1p(len(raw)), np.log1p(n), np.log1p(len(lines)), np.log1p(len(raw) if chars is None else max(0, chars)),
        size / max(1, n), n / max(1, len(lines)) ** 0.5, letters / size, capitals / max(1, letters + capitals), seen[DIGITS].sum() / size,
        10 * seen[SYMBOLS].sum() / size, 10 * seen[ENDS].sum() / size, seen[128:].sum() / size,
        distinct / max(1, n) ** 0.8, (h[1:] == h[:-1]).mean() if n > 1 else 0.0, 1 - len(set(lines)) / max(1, len(lines))]
    return buckets.astype(np.int32), values.astype(np.float32), np.array(statistics, np.float32)


@dataclass
class Machine:
    """Weights and factors of the words' buckets and, after them, of the statistics."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def inputs(self, buckets: np.ndarray, values: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dense = np.clip((statistics - self.mean) / self.deviation, -4, 4) / 2
        return np.concatenate([buckets, (1 << BITS) + np.arange(STATISTICS, dtype=np.int32)]), np.concatenate([values, dense]).astype(np.float32)

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        sums = vx.sum(axis=0)
        z = self.bias + self.w[at] @ x + 0.5 * float((sums * sums - (vx * vx).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Adagrad on the log loss, both classes of equal total weight at the score of 0.3."""
    rng, n = np.random.default_rng(SEED), (1 << BITS) + STATISTICS
    dense = np.array([r[2] for r in rows]).reshape(-1, STATISTICS)
    m = Machine(0.0, np.zeros(n, np.float32), rng.normal(0, 0.02, (n, FACTORS)).astype(np.float32),
                dense.mean(axis=0) if len(rows) else np.zeros(STATISTICS), dense.std(axis=0) + 1e-3 if len(rows) else np.ones(STATISTICS))
    good = labels.mean() if len(labels) else 0.0
    if not 0 < good < 1:
        m.v[:] = 0
        m.bias = 0.0 if not len(labels) else (30.0 if good else -30.0)
        return m
    weight = np.where(labels == 1, 0.5 / good, 0.5 / (1 - good))
    gw, gv, gb = np.full(n, 1e-2, np.float32), np.full((n, FACTORS), 1e-2, np.float32), 1e-2
    inputs = [m.inputs(*r) for r in rows]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            at, x = (np.concatenate([inputs[i][k] for i in pick]) for k in (0, 1))
            starts = np.concatenate([[0], np.cumsum([len(inputs[i][0]) for i in pick])[:-1]])
            own = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(at))))
            vx = m.v[at] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            z = m.bias + np.add.reduceat(m.w[at] * x, starts) + 0.5 * (sums * sums - np.add.reduceat(vx * vx, starts)).sum(axis=1)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            dz = g[own] * x
            used, where = np.unique(at, return_inverse=True)
            dw = np.bincount(where, dz, len(used)).astype(np.float32) + SHRINK * m.w[used]
            each = dz[:, None] * (sums[own] - vx)
            dv = np.stack([np.bincount(where, each[:, f], len(used)) for f in range(FACTORS)], axis=1).astype(np.float32) + SHRINK * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += float(g.sum()) ** 2
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            m.v[used] -= RATE * dv / np.sqrt(gv[used])
            m.bias -= RATE * float(g.sum()) / gb ** 0.5
    return m


def _read(docs: DataFrame, doc_id: str, text: str, chars: str) -> DataFrame:
    length = column(chars).cast("long") if chars in docs.columns else F.lit(None).cast("long")
    return docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"), length.alias("chars"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars") -> Machine:
    """The machine fitted on at most SAMPLE labelled rows outside the held-out fifth."""
    known = (labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label is not null")
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))  # bounded, and so broadcast

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 1 << 22):
            rows = [features(*r) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(3), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                                              pa.array([r[1] for r in rows], pa.list_(pa.float32())), pa.array([r[2] for r in rows], pa.list_(pa.float32()))],
                                             ["label", "buckets", "vals", "stats"])

    # one row of each id (the least by a hash of its text), so SAMPLE rows at most go to the driver
    sample = (_read(docs, doc_id, text, chars).join(F.broadcast(known), "doc_id")
              .groupBy("doc_id").agg(F.min_by(F.struct("text", "chars", "label"), F.struct(F.xxhash64("text"), F.xxhash64("chars"))).alias("row"))
              .select("doc_id", "row.text", "row.chars", "row.label"))
    got = map_in_arrow(sample, extract, "label int, buckets array<int>, vals array<float>, stats array<float>").toArrow()
    cols = [got.column(c).combine_chunks() for c in ("buckets", "vals", "stats")]
    rows = [tuple(np.asarray(c[i].values) for c in cols) for i in range(got.num_rows)]
    y = np.array(got.column("label").to_pylist(), np.float64)
    order = sorted(range(len(rows)), key=lambda i: (y[i], rows[i][2].tobytes(), rows[i][0].tobytes()))  # whatever order the tasks ended in
    return fit([rows[i] for i in order], y[order])


def quality_scores(docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of each row."""

    def run(m: Machine, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 1 << 22):
            scores = [m.score(*m.inputs(*features(*r))) for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    read = _read(docs, doc_id, text, chars)
    return map_in_arrow(read, functools.partial(run, machine), f"doc_id {read.schema['doc_id'].dataType.simpleString()}, score double")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
