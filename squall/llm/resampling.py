"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Runs of words are hashed to buckets and counted in the corpus and in the target. A bucket's gain is the log ratio of its
smoothed shares; the gains are one array, and a document's weight is the sum over its runs. Weight and
Gumbel noise make the score, and the highest scores are a draw without replacement in proportion to the weights.

Scores are ranked least significant digit first. A pass is a stable counting sort by one digit of the composite
key: digits are counted by chunk, prefix sums over (digit, chunk) tell where each such run of rows begins, and
a row's destination is that place plus its turn in the run. Rows are dealt by chunk and digit, and a chunk
holds a bounded number of rows, so equal scores or ids are no hot group.
"""

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.llm.common import partitions
from squall.llm.counts import summed
from squall.llm.decontaminate import normalised
from squall.storage import materialise

BUCKETS = 10_000
LONGEST = 3  # words in a run
MIN_WORDS = 20  # of a document that may be drawn
PERCENT = 5  # of these that are drawn
SEED = 42
DIGIT_BITS = 12
CHUNK_ROWS = 1 << 20  # at most

_NUMBERS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
    T.StructField("weight", T.LongType()),
])


def features(text: bytes, buckets: int, longest: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to `longest` words.

    The checksum of a run continues that of the run one word shorter.
    """
    words = normalised(text).split()
    sums = list(map(crc32, words))
    every = sums.copy()
    spaced = [b" " + w for w in words]
    for length in range(1, longest):
        sums = list(map(crc32, spaced[length:], sums))
        every += sums
    return len(words), np.array(every, dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many runs of all `texts (text)` fall in each bucket."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                found = features(text.as_py() or b"", buckets, longest)[1]
                total += np.bincount(found, minlength=buckets)
        return total

    return summed(texts.select(F.col("text").cast("binary").alias("text")), count, buckets)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, for each bucket."""
    size, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], dtype=np.int64)


def weigher(gain: np.ndarray, longest: int = LONGEST):
    """Column function: `n_words`, `n_features` and `weight` of a text."""

    @F.arrow_udf(_NUMBERS)
    def weigh(texts: pa.Array) -> pa.Array:
        n_words, n_features, weight = [], [], []
        for text in texts:
            count, found = features(text.as_py() or b"", len(gain), longest)
            n_words.append(count)
            n_features.append(len(found))
            weight.append(int(gain[found].sum()))
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (n_words, n_features, weight)], names=_NUMBERS.names
        )

    return weigh


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id alone; a null id counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def digits(value: Column, largest: int) -> list[Column]:
    """Digits of numbers from 0 to `largest`, the least significant first."""
    count = -(-largest.bit_length() // DIGIT_BITS)
    return [
        F.shiftrightunsigned(value, DIGIT_BITS * k).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
        for k in range(count)
    ]


def order_digits(rows: DataFrame, score: str, tie: str) -> list[Column]:
    """Composite key: `score` from the highest, then `tie` from the smallest, nulls last."""
    row = rows.agg(
        F.min(score), F.max(score), F.min(tie), F.max(tie), F.max(F.col(tie).isNull().cast("int"))
    ).first()
    low, high, first, last, nulls = row
    out = []
    if last is not None:
        if last - first < 1 << 63:
            out = digits(F.coalesce(F.col(tie) - F.lit(first), F.lit(0)), last - first)
        else:  # the difference overflows: order by the bits, the sign turned round
            flipped = F.coalesce(F.col(tie), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
            out = digits(flipped, (1 << 64) - 1)
    if nulls:
        out.append(F.col(tie).isNull().cast("int"))
    if high is not None:
        out += digits(F.lit(high) - F.col(score), high - low)
    return out


def radix_positions(rows: DataFrame, key: list[Column], count: int) -> DataFrame:
    """`rows` with `position`, 0 to `count` - 1, in the order of `key`, whose least significant digit comes first.

    Rows with equal keys keep some order. Each pass reads and writes a table, so a lost executor costs one pass.
    """
    names = rows.columns
    chunk_rows = min(CHUNK_ROWS, count // (4 * partitions(rows.sparkSession)) + 1)
    held = materialise(rows.withColumn("position", F.monotonically_increasing_id()), "unsorted")
    chunk = F.shiftright("position", 33)  # the partition that wrote the row
    # A pass of one digit alone makes consecutive positions of an unsorted table.
    for digit in key or [F.lit(0)]:
        at = held.withColumn("digit", digit).withColumn("chunk", chunk)
        counts = materialise(at.groupBy("digit", "chunk").agg(F.count("*").alias("n")), "counts")
        so_far = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # over one row a digit
        of_digit = counts.groupBy("digit").agg(F.sum("n").alias("n")).select(
            "digit", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first")
        )
        chunks_before = (
            Window.partitionBy("digit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        )
        offsets = counts.select(
            "digit", "chunk", F.coalesce(F.sum("n").over(chunks_before), F.lit(0)).alias("earlier")
        ).join(of_digit, "digit")
        turn = F.row_number().over(Window.partitionBy("digit", "chunk").orderBy("position"))
        moved = at.withColumn("turn", turn).join(offsets, ["digit", "chunk"])
        place = F.col("first") + F.col("earlier") + F.col("turn") - 1
        held = materialise(moved.select(*names, place.alias("position")), "sorted")
        chunk = F.floor(F.col("position") / chunk_rows)
    return held


def resample(
    docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, longest: int = LONGEST,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED, carry: tuple[str, ...] = (),
) -> DataFrame:
    """`(doc_id, n_words, n_features, weight, score, rank)` for each row of `docs (doc_id, text)`, integer ids.

    `target (text)` is the distribution to come near. Of the rows with at least `min_words` words, `percent`
    in a hundred (rounded down) are drawn: the highest scores, equal scores by smaller id, null ids last.
    `rank` is the turn of a drawn row, else null. Columns named in `carry` go along; others are ignored.

    Null and empty texts have no features and weight 0; an empty target or corpus counts as zeros; equal rows
    are drawn each for itself, in some order; a null id has the noise of an empty one.
    """
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    texts = docs.select(doc_id, text, *carry)
    gain = gains(bucket_counts(texts, buckets, longest), bucket_counts(target, buckets, longest))
    weighed = texts.select("doc_id", *carry, weigher(gain, longest)("text").alias("w"))
    scored = weighed.select("doc_id", *carry, "w.*").withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)
    )
    scored = materialise(scored, "scored")
    long_enough = scored.filter(F.col("n_words") >= min_words)
    count = long_enough.count()
    placed = radix_positions(long_enough, order_digits(long_enough, "score", "doc_id"), count)
    drawn = percent * count // 100
    ranked = placed.withColumn("rank", F.when(F.col("position") < drawn, F.col("position") + 1))
    others = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.drop("position").union(others)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that `resample` draws, whole and in the order drawn."""
    numbered = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    numbered = materialise(numbered, "numbered")
    ranked = resample(numbered.select("row.doc_id", "row.text", "at"), target, carry=("at",), **options)
    drawn = materialise(ranked.filter("rank is not null").select("at", "rank"), "drawn")
    return numbered.join(drawn, "at").sort("rank").select("row.*")
