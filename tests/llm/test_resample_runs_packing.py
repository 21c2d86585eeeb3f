"""Importance resampling, periodic runs and packing against brute force, and on odd tables."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from caresight.llm import op11_importance as o11, op12_periodic_runs as o12, op13_packing as o13

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 700}x{i}" for i in range(60_000))
ODD = [(None, "no id, some words here that stand alone in this table", "a", 1), (None, None, "a", 2), (1, None, None, None), (2, "", "b", 3), (3, " \n\t ", "b", 4),
       (4, LONG, "c", 5), (5, "the same text twice over, with the same id as well", "d", 6), (5, "the same text twice over, with the same id as well", "d", 6),
       (6, "ünïcode 🎉 ½ ٣ 漢字 <|endoftext|> it's  we'll\n\n", "e", 7), (7, "a\x00b \x7f" + "ha " * 50 + "ho", "f", 8)]
ODD_SCHEMA = "doc_id long, text string, bucket string, `start.length` long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 11 -----------------------------------------------------------------------------------------

def plain_features(text, order):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain_resampling(rows, targets, order, buckets, share=(10, 100), least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, plain_features(text, order)[1]))
    for text in targets:
        t.update(map(bucket, plain_features(text, order)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        n, features = plain_features(text, order)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in features)
        out.append([i, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r in out if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0]))
    for rank, r in enumerate(able[:len(able) * share[0] // share[1]], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("order,buckets", [(1, 10_000), (2, 500), (3, 10_000)])
def test_resampling_equals_the_plain_sums(spark, docs, order, buckets):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, targets = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()]
    got = sorted(map(tuple, o11.resampled(docs.repartition(5), bench, order, buckets).collect()), key=str)
    assert got == plain_resampling(rows, targets, order, buckets)


def test_features_of_slices(docs):
    import pyarrow as pa
    texts = pa.array([r.text for r in docs.collect()] + ["Ünïcode É漢字 Aé", None, ""], pa.string())
    for order in (1, 2, 3):
        whole = o11.Features(texts, order, 10_000)
        for at in (1, 50, len(texts) - 3):
            part = o11.Features(texts.slice(at), order, 10_000)
            assert part.n_words.tolist() == whole.n_words.tolist()[at:] and part.n.tolist() == whole.n.tolist()[at:]
            assert part.bucket.tolist() == whole.bucket.tolist()[sum(whole.n[:at]):]


def test_resampling_on_odd_tables(spark, odd):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "the same text ha ha"), (None, "ünïcode words")], "item_id long, text string")
    want = plain_resampling([(r[0], r[1]) for r in ODD], [None, "", "the same text ha ha", "ünïcode words"], 2, 50, (1, 2), 9)
    got = sorted(map(tuple, o11.resampled(odd, bench, 2, 50, share=(1, 2), least_words=9).collect()), key=str)
    assert got == want and sum(r[5] is not None for r in got) == len([r for r in got if r[1] >= 9]) // 2
    assert o11.resampled(odd.limit(0), bench).count() == 0
    none = o11.resampled(odd, bench.limit(0))
    assert none.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and none.count() == len(ODD)


def test_rows_of_one_id_all_get_ranks(spark):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("word " * 20).alias("text"))
    ranks = sorted(r["rank"] for r in o11.resampled(df, df.limit(0), share=(1, 1)).collect())
    assert ranks == list(range(1, 3001))


# 12 -----------------------------------------------------------------------------------------

def plain_runs(words, length=6, exponent=4):
    """For each period, the stretches in which words that far apart are equal."""
    numbers = {x: k for k, x in enumerate(dict.fromkeys(words))}
    w, out = np.array([numbers[x] for x in words]), {}
    for q in range(1, len(w) // exponent + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])))
        for s, e in edges.reshape(-1, 2).tolist():
            if e + q - s >= max(length, exponent * q):
                out.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 120)
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            if rng.random() < 0.3:  # runs within the periods of a run
                w += ([rng.randrange(2)] * rng.randint(4, 9) + [rng.randrange(3) for _ in range(rng.randint(1, 4))]) * rng.randint(3, 7) + w[:9]
            texts.append(" ".join(map(str, w)))
        length, exponent = rng.choice([(6, 4), (6, 4), (3, 3), (5, 5)])
        for text, (n, found, left) in zip(texts, o12._group(texts, length, exponent)):
            assert n == len(text.split()) and sorted(found) == plain_runs(text.split(), length, exponent), text
            assert left == plain_collapsed(text.split(), found)


def test_transforms_find_exactly_the_equal_places():
    rng = np.random.default_rng(2)
    for width, most in ((1, 3), (4, 2), (16, 2), (64, 1 << 40), (1024, 1 << 60)):
        blocks, windows = rng.integers(0, most, (7, width)), rng.integers(0, most, (7, 2 * width - 1))
        for r in range(5):
            windows[r, r:r + width][:] = blocks[r, :len(windows[r, r:r + width])]
        want = [[width + x <= 2 * width - 1 and (windows[r, x:x + width] == blocks[r]).all() for x in range(width)] for r in range(7)]
        assert o12.occurrences(blocks, windows).tolist() == want
    for p, root in o12.PRIMES:
        a = rng.integers(0, p, (3, 32)).astype(np.uint64)
        assert pow(root, (p - 1) // 2, p) == p - 1 and (o12.restored(o12.transformed(a, p, root), p, root) == a).all()


def test_long_runs_and_long_texts():
    text = " ".join(f"w{i % 5000}" for i in range(100_000))
    (n, found, left), = o12._group([text], 6, 4)
    assert (n, found) == (100_000, [(0, 100_000, 5000)]) and len(left.split()) == 5000


def test_query_equals_brute_force(spark, docs, odd):
    for df in (docs, odd.where("length(text) < 5000").select("doc_id", "text")):
        want = []
        for r in df.collect():
            words, key = words_of(r.text), "" if r.doc_id is None else str(r.doc_id)
            h = zlib.crc32(key.encode())
            g, n = h // 10, len(words)
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            found = plain_runs(words)
            best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if found else (None, None, None)
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
            want.append((r.doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                         hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest()))
        found = o12.periodic_runs(o12.with_planted_runs(df))
        assert found.where("size(runs) > 0").count() == sum(r[1] > 0 for r in want) > 0
        if df is docs:
            got = o12.op12_periodic_runs(spark, SF).collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_runs_on_odd_tables(odd):
    got = {r.doc_id: r for r in o12.periodic_runs(odd).collect()}
    assert got[7].runs == [(2, 49, 1)] and got[7].strongest.period == 1 and got[7].collapsed == "a\x00b \x7fha ha ho"
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[3].collapsed == "" and got[3].strongest is None
    assert o12.periodic_runs(odd).count() == len(ODD) and o12.periodic_runs(odd.limit(0)).count() == 0


# 13 -----------------------------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(docs, library):
    texts = [r.text for r in docs.collect()] + [r[1] or "" for r in ODD]
    rng = random.Random(4)
    bits = ["a", "B's", "'", "''s", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "漢", "½", "٣", "🎉", "<|endoftext|>", "<|", "12", "...", " ", " ", "ſ", "ª", "̀", "it's", "word"]
    texts += ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += [" ".join(rng.choices([b for b in bits if b.strip()], k=rng.randint(0, 30))) for _ in range(1000)]
    for t, got in zip(texts, o13.encoder(PATH).encode(texts)):
        assert got.tolist() == library(t), t


def test_ids_of_a_text_over_many_spans(library, monkeypatch):
    monkeypatch.setattr("caresight.llm.textunits.spans.__defaults__", (500,))
    monkeypatch.setattr("caresight.llm.unitids.GROUP_BYTES", 2000)
    text = " ".join(["some words, and\nlines", "漢字 かな", "with  gaps"][i % 3] + str(i) for i in range(3000))
    assert o13.encoder(PATH).encode([text])[0].tolist() == library(text)


def test_differencing_merges_by_opposing_imbalance():
    # 8 7 6 5 4 in two windows: 8-7 and 6-5 cancel out, 4 is left against 1 and 1
    sums, held = o13.differenced([8, 7, 6, 5, 4], 2)
    assert sums.tolist() == [16, 14] and sorted(i for x in held for i in x) == [0, 1, 2, 3, 4]
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 512) for _ in range(rng.randint(1, 300))]
        windows = rng.randint(1, 40)
        sums, held = o13.differenced(sizes, windows)
        assert sorted(i for x in held for i in x) == list(range(len(sizes)))
        assert [sum(sizes[i] for i in x) for x in held] == sums.tolist() == sorted(sums.tolist(), reverse=True)
        if len(sizes) > 10 * windows:
            assert sums[0] - sums[-1] <= 64


def test_the_count_of_windows_rises_when_one_is_over_capacity():
    held = o13.balanced([60, 60, 60], 100, 2)
    assert sorted(map(len, held)) == [1, 1, 1]


def checked(rows, texts, library, length=2048):
    """Every id of every document lies in one piece, pieces fill their sequences without gaps."""
    of_doc, of_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_seq[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids, at = [*library(text), 1], 0
        for r in sorted(of_doc[doc], key=lambda r: r.start):
            own = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids) and zlib.crc32(own) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    padded = 0
    for own in of_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
        padded += length - at if at & (at - 1) else 0
    return padded


def test_query_packs_every_id_once(spark, docs, library):
    rows = o13.op13_packing(spark, SF).collect()
    padded = checked(rows, {r.doc_id: r.text for r in docs.collect()}, library)
    assert padded <= 0.02 * sum(r.length for r in rows)


def test_packing_of_small_partitions_and_odd_tables(spark, docs, odd, library):
    some = docs.repartition(60, "doc_id")
    pieces = o13.pack(some, PATH).withColumn("ids_crc32", F.crc32("ids"))
    assert checked(pieces.collect(), {r.doc_id: r.text for r in docs.collect()}, library) <= 60 * 4096
    once = odd.where("doc_id <> 5")
    rows = o13.pack(once, PATH, 64).withColumn("ids_crc32", F.crc32("ids")).collect()
    checked(rows, {r[0]: r[1] for r in ODD if r[0] not in (None, 5)}, library, 64)
    every = o13.pack(odd, PATH).collect()
    assert sum(r.length for r in every if r.doc_id == 5) == 2 * (len(library(ODD[6][1])) + 1)
    assert sum(r.length for r in every if r.doc_id is None) == len(library(ODD[0][1])) + 2
    assert o13.pack(odd.limit(0), PATH).count() == 0


def test_sequences_hold_their_pieces_in_order(spark, docs):
    pieces = o13.pack(docs, PATH)
    rows = pieces.collect()
    for s in o13.sequences(pieces).collect():
        own = sorted([r for r in rows if r.sequence_id == s.sequence_id], key=lambda r: r.offset)
        assert bytes(s.ids) == b"".join(bytes(r.ids) for r in own) and [tuple(p) for p in s.parts] == [(r.doc_id, r.start, r.length) for r in own]
