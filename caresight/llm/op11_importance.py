r"""Importance resampling towards a target distribution, by hashed n-gram features.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased; features are all runs of 1
to ``order`` words, joined by a space, each in one of ``buckets`` by its CRC-32. The corpus and the
target are counted by bucket; a bucket's gain is the log of its smoothed share in the target over
that in the corpus, and a document's weight the sum of its features' gains. Gumbel noise from a hash of
the id turns the drawing without replacement into taking the highest scores.

The texts are read twice (counts, weights) by Arrow kernels: ascii_lower, split_pattern_regex,
list_flatten and dictionary_encode make numbers of the words; numbers shifted against each other make
n-grams, of which each different one is named and hashed once; gains are taken by number and summed
by segments. Each task hands on its count per bucket, so at most ``buckets`` rows, and the driver gets the
gains: one number per bucket, whatever the corpus.

The draw numbers the eligible rows (id and score only) by ranges of the score, so no task holds all.

Defined cases: null or empty text, or one without words: no features, weight 0. Null ids hash as an
empty id and come after all others of the same score. Repeated rows each have a row and a rank. An empty
corpus or target: its counts are 0. Extra columns are not read; the output has the operator's only.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, checkpointed, column, map_in_arrow, table
from caresight.operators.scans import global_sequence

ORDER, BUCKETS, SEED, SHARE, LEAST_WORDS = 1, 10_000, 2024, (10, 100), 20
#: Bytes of text per group of rows.
GROUP_BYTES = 1 << 22
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Features:
    """Features of a group of texts: ``bucket`` of each, text by text, and where each text's begin."""

    def __init__(self, texts: pa.Array, order: int, buckets: int):
        # lower first: ascii_lower goes wrong on a large_string array with an offset
        lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string()), BREAKS)
        words = pc.list_flatten(lists)
        full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        coded = words.filter(pa.array(full)).dictionary_encode()
        before = np.concatenate([[0], np.cumsum(full)])
        ends = lists.offsets.to_numpy()
        ends = before[ends - ends[0]]  # words before each text
        which = coded.indices.to_numpy().astype(np.int64)
        names = coded.dictionary.cast(pa.large_binary()).to_pylist()
        words = names
        self.n_words = np.diff(ends)
        text_of = np.repeat(np.arange(len(self.n_words)), self.n_words)
        n_words, grams = len(which), which  # of all texts on end
        found, texts_of = [self._hashed(names, buckets)[which]], [text_of]
        for n in range(2, order + 1):
            # an n-gram: the (n-1)-gram here and the word n - 1 further on, in the same text
            grams = grams[:n_words - n + 1] if len(grams) else grams
            inside = text_of[:len(grams)] == text_of[n - 1:n - 1 + len(grams)]
            pairs = grams * max(1, len(words)) + which[n - 1:n - 1 + len(grams)]
            different, back = np.unique(pairs, return_inverse=True)
            names = [names[p // len(words)] + b" " + words[p % len(words)] for p in different.tolist()]
            grams = back
            found.append(self._hashed(names, buckets)[back][inside])
            texts_of.append(text_of[:len(grams)][inside])
        if order > 1:
            owner = np.concatenate(texts_of)
            by = np.argsort(owner, kind="stable")
            self.bucket, owner = np.concatenate(found)[by], owner[by]
        else:
            self.bucket, owner = found[0], text_of
        self.n = np.bincount(owner, minlength=len(self.n_words))

    @staticmethod
    def _hashed(names: list[bytes], buckets: int) -> np.ndarray:
        return np.array([zlib.crc32(x) % buckets for x in names], np.int64)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """Sum of the gains of each text's features."""
        running = np.concatenate([[0], np.cumsum(gains[self.bucket])])
        ends = np.cumsum(self.n)
        return running[ends] - running[ends - self.n]


def bucket_counts(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """bucket, n: features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in by_bytes(batches, 0, GROUP_BYTES):
            total += np.bincount(Features(batch.column(0), order, buckets).bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = map_in_arrow(docs.select(column(text).cast("string").alias("text")), count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, from the counts of corpus and target."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).union(
        target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    counts = np.zeros((2, buckets), np.int64)
    for bucket, s, t in both.collect():  # a row per bucket at most
        counts[0, bucket], counts[1, bucket] = s, t
    (s, t), (all_s, all_t) = counts.astype(np.float64), counts.sum(axis=1).astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight of each row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            own = Features(batch.column(1), order, len(gain))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (own.n_words, own.n, own.sums(gain))]],
                                             ["doc_id", "n_words", "n_features", "weight"])

    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return map_in_arrow(read, weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def with_scores(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighed`` with score: weight and Gumbel noise, in thousandths, from SHA-256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return weighed.withColumn("score", F.col("weight") + noise)


def resampled(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED, share: tuple[int, int] = SHARE,
              least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row; ``share`` (a fraction) of the rows
    with ``least_words`` or more are drawn and ranked from 1, all others have no rank."""
    gain = gains(bucket_counts(docs, order, buckets, text), bucket_counts(target, order, buckets, target_text), buckets)
    scored = checkpointed(with_scores(weights(docs, gain, order, doc_id, text), seed))
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * share[0] // share[1]
    # rows that repeat an id are told apart by their place in the checkpoint, so ranges stay even
    placed = scored.withColumn("place", F.monotonically_increasing_id()).where(eligible)
    ranked = global_sequence(placed, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place").asc()], "rank").drop("place")
    out = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return out.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# Fixed value: the polynomial of CRC-32, bits reversed.
SQL = r"""
with bits as (select i, list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) as v
              from range(256) t(i)),
crc as (select list(v order by i) as lookup from bits),
low as (select 'd' as kind, doc_id as id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        union all select 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
words as (select kind, id, w, count(*) as n
          from (select kind, id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from low) group by all),
named as (select w, hex(encode(w)) as x from (select distinct w from words)),
hashed as (select w, xor(list_reduce(list_concat([4294967295::ubigint], list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::bigint, 2))::ubigint)),
                  lambda c, b: xor(c >> 8, lookup[(xor(c & 255, b) + 1)::bigint])), 4294967295::ubigint) % 10000 as bucket from named, crc),
counted as (select bucket, sum(n) filter (kind = 'd') as s, sum(n) filter (kind = 'b') as t from words join hashed using (w) group by bucket),
totals as (select coalesce(sum(s), 0) as alls, coalesce(sum(t), 0) as allt from counted),
gain as (select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (alls + 10000)::double) / ((coalesce(s, 0) + 1)::double * (allt + 10000)::double)))::bigint as g from counted, totals),
weighed as (select id, sum(n)::bigint as n_features, sum(n * g)::bigint as weight from words join hashed using (w) join gain using (bucket) where kind = 'd' group by id),
scored as (select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
           coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
           from documents left join weighed on id = doc_id),
drawn as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20
          qualify rank <= count(*) over () * 10 // 100)
select doc_id, n_features, weight, score, rank from scored left join drawn using (doc_id)
"""
