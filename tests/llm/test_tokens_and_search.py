"""Byte-level BPE, resampling and ranked search, held against public libraries and brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm import SCHEMA, TEXTS

from squall.llm import bpe, resampling, search
from squall.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HARD = [
    "a" * 5000, "ab" * 3000, "<|endoftext|> \r\n\t  x", "naïve Ünïcode 日本語 🙂🙂 é", "\x00\x1c\x85   z",
    "it's we'll I'M 12345 6.7", " " * 300, "!" * 300 + "a1b2", "".join(chr(c) for c in range(1, 0x250)),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def rows():
    return TEXTS + [(100 + k, t) for k, t in enumerate(HARD)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 7, "row", 1, 2) for d, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    """Items with clashing column names, nulls, repeats and ties."""
    texts = [(1, "The one; word1x1 shared7 shared8"), (2, None), (3, " "), (None, "id mail"), (4, "shared1 shared1 ONE"),
             (4, "shared1 shared1 ONE"), (5, "nowhere at_all zzz"), (6, "same")]
    return spark.createDataFrame([(i, t, 3) for i, t in texts], "item_id long, text string, doc_id int")


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    return tiktoken.Encoding("own", pat_str=bpe.piece_pattern(), mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_public_library(spark, docs, rows, empty, encoding):
    encode, decode = bpe.encoder(spark), bpe.decoder(spark)
    ids = docs.select("doc_id", "text", encode("text").alias("ids"))
    got = ids.select("doc_id", "text", "ids", decode("ids").alias("bytes")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    for r in got:
        assert r.ids == encoding.encode_ordinary(r.text or "")
        assert bytes(r.bytes) == (r.text or "").encode()
    assert empty.select(encode("text")).count() == 0


def test_encoding_of_any_bytes_in_one_piece(encoding):
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    r = np.random.default_rng(3)
    for size in [1, 2, 3, 4, 5, 8, 9, 31, 64, 65, 400]:
        for alphabet in (b"a", b"ab", b"the an", bytes(range(256))):
            piece = bytes(r.choice(list(alphabet), size).tolist())
            got = bpe.merged(piece, ranks)
            want = encoding._encode_single_piece(piece)
            assert got == want or piece in ranks


def test_one_long_piece_takes_n_log_n_steps():
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    text = "".join(chr(97 + k * k % 26) for k in range(200_000))
    codec = bpe.Codec(ranks, bpe.piece_pattern())
    assert codec.decode(codec.encode(text).tolist()) == text.encode()


def test_encoding_query(spark, sf_dir, encoding):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(encoding.encode_ordinary(texts[r.doc_id]), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def runs(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def drawn_by_hand(rows, targets, min_words=20, percent=5):
    bucket = lambda run: zlib.crc32(run.encode()) % 10_000
    s = Counter(bucket(r) for _, t in rows for r in runs(t))
    t = Counter(bucket(r) for text in targets for r in runs(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (all_s + 10000) / ((s[k] + 1) * (all_t + 10000)))) for k in range(10000)]
    out = []
    for doc_id, text in rows:
        found = runs(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(r)] for r in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words(text)) >= min_words])
    may = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(may[: percent * len(may) // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in out]


def test_resampling(spark, docs, rows, empty, items, monkeypatch):
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    targets = [r.text for r in items.collect()]
    monkeypatch.setattr(resampling, "DIGIT_BITS", 7)  # more passes
    monkeypatch.setattr(resampling, "CHUNK_ROWS", 4)
    for least, percent in ((20, 5), (1, 60)):
        got = resampling.resample(docs, items, min_words=least, percent=percent).select(*columns).collect()
        want = drawn_by_hand(rows, targets, least, percent)
        assert Counter(map(tuple, got)) == Counter(want)
    assert resampling.resample(empty, items).count() == 0
    assert resampling.resample(docs, items.limit(0)).count() == len(rows)
    picked = resampling.draw(docs, items, min_words=1, percent=60)
    assert picked.columns == docs.columns
    wanted = [r[0] for r in sorted((r for r in drawn_by_hand(rows, targets, 1, 60) if r[4]), key=lambda r: r[4])]
    assert [r.doc_id for r in picked.collect()] == wanted


def test_radix_sort_of_ties_and_extreme_ids(spark):
    ids = [-(1 << 63), (1 << 63) - 1, 0, None, -1, 5, 5, 4096, None, 12345678901]
    data = [(i, s) for i in ids for s in (7, -3, 7, 10**12)]
    rows = spark.createDataFrame(data, "doc_id long, score long").repartition(3)
    placed = resampling.radix_positions(rows, resampling.order_digits(rows, "score", "doc_id"), len(data))
    got = [(r.doc_id, r.score) for r in sorted(placed.collect(), key=lambda r: r.position)]
    assert got == sorted(data, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert sorted(r.position for r in placed.collect()) == list(range(len(data)))


def test_resampling_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    targets = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = QUERIES["op12_resample_to_target"](spark, sf_dir).collect()
    assert Counter(map(tuple, got)) == Counter(drawn_by_hand(rows, targets))


def ranked_by_hand(rows, queries, size=10):
    texts = [(d, words(t)) for d, t in rows]
    texts = [(d, Counter(w), len(w)) for d, w in texts if w]
    n_docs, n_terms = len(texts), sum(n for _, _, n in texts)
    df = Counter(term for _, w, _ in texts for term in w)
    out = []
    for item, text in queries:
        found = []
        for doc_id, tf, n in texts:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (10**9 * tf[term] // (1000 * tf[term] + 8 * m))
                for term in set(words(text))
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:size])]
    return out


@pytest.mark.parametrize("short, stretch, block, size", [(256, 1024, 1 << 14, 10), (0, 2, 5, 1), (2, 3, 1 << 14, 3), (1, 4, 7, 2)])
def test_search(docs, rows, empty, items, monkeypatch, short, stretch, block, size):
    monkeypatch.setattr(search, "SHORT", short)
    monkeypatch.setattr(search, "STRETCH", stretch)
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    queries = [(r.item_id, r.text) for r in items.collect()]
    want = Counter(ranked_by_hand(rows, queries, size))
    for most in (3, 100_000):  # several blocks of queries, and one
        assert Counter(map(tuple, search.rank(docs, items, size, max_terms=most).collect())) == want
    assert search.rank(empty, items).count() == search.rank(docs, items.limit(0)).count() == 0


def test_search_of_random_texts_skips_nothing_it_needs(spark, monkeypatch):
    monkeypatch.setattr(search, "SHORT", 20)
    monkeypatch.setattr(search, "STRETCH", 16)
    r = np.random.default_rng(5)
    rows = [(int(k), " ".join(f"w{x}" for x in r.zipf(1.3, r.integers(0, 60)) if x < 400)) for k in r.permutation(600)]
    queries = [(f"q{k}", " ".join(f"w{x}" for x in r.integers(1, 60, 12))) for k in range(20)]
    got = search.rank(
        spark.createDataFrame(rows, "doc_id int, text string").coalesce(2),
        spark.createDataFrame(queries, "item_id string, text string"),
    )
    assert Counter(map(tuple, got.collect())) == Counter(ranked_by_hand(rows, queries))
    assert got.filter(F.col("score") <= 0).count() == 0
