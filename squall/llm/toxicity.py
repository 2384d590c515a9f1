"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. Every window of a text is
compressed with the ordinary dictionary alone and with the toxic one before it; what the toxic dictionary
saves, in bytes, is the window's distance. The shares of windows beyond each of a row of thresholds make
a text's features, and a logistic calibration on texts the dictionaries have not seen weighs them.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.storage import materialise

WINDOW, STEP = 16, 12  # words
DICTIONARY_BYTES = 4096
THRESHOLDS = tuple(range(1, 11))  # bytes saved
MAX_TEXTS = 3000  # labelled texts of each class to learn from
MAX_CHARS = 12_000_000  # of all texts of a class together
MISS_COSTS = (0.5, 1.0, 2.0, 4.0)  # of a missed toxic text against a false alarm, to choose from
ENRICHED = 10  # times as many contexts in toxic as in ordinary text
MIN_SHARE = 0.02  # of a class's texts that have a word of its dictionary


def _windows(text: str) -> list[bytes]:
    words = text.lower().encode().split()
    count = max(1, -(-(len(words) - WINDOW) // STEP) + 1)
    return [b" ".join(words[i * STEP : i * STEP + WINDOW]) for i in range(count)] if words else []


def _contexts(texts: list[list[bytes]]) -> Counter:
    """In how many texts or contexts (words before), whichever are fewer, each word stands: so neither a
    copied text nor a long one counts for many."""
    pairs, inside = set(), Counter()
    for words in texts:
        pairs.update(zip([b"", *words], words))
        inside.update(set(words))
    contexts = Counter(word for _, word in pairs)
    return Counter({word: min(n, inside[word]) for word, n in contexts.items()})


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; if there is too little to train on, the samples themselves."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstd.train_dictionary(size, samples, k=24, d=6).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b" ".join(dict.fromkeys(samples))[:size]


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary.

    Both learn from words that recur in several contexts of their class; the toxic one only from those that
    do so far more than in ordinary text.
    """
    split_t = [t.lower().encode().split() for t in toxic]
    split_o = [t.lower().encode().split() for t in ordinary]
    in_t, in_o = _contexts(split_t), _contexts(split_o)
    n_t, n_o = max(1, len(toxic)), max(1, len(ordinary))
    bad = {
        w for w, n in in_t.items()
        if n >= max(4, MIN_SHARE * n_t) and n / n_t >= ENRICHED * (in_o[w] + 0.5) / n_o
    }
    common = {w for w, n in in_o.items() if n >= max(4, 0.005 * n_o)} - bad
    of_t = [b" ".join(w for w in words if w in bad) for words in split_t]
    of_o = [
        b" ".join(w for w in words[i : i + 16] if w in common)
        for words in split_o for i in range(0, len(words), 16)
    ]
    return _dictionary(of_t * 3, DICTIONARY_BYTES), _dictionary(of_o, DICTIONARY_BYTES)


def _compressor(content: bytes):
    parameters = zstd.ZstdCompressionParameters(
        window_log=17, strategy=zstd.STRATEGY_BTOPT, min_match=3, search_log=4, hash_log=14, chain_log=14,
        target_length=24, write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    if not content:
        return zstd.ZstdCompressor(compression_params=parameters).compress
    held = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=parameters)
    return zstd.ZstdCompressor(compression_params=parameters, dict_data=held).compress


class Distances:
    """Features of texts under a pair of dictionaries."""

    size = 3 + 2 * len(THRESHOLDS)

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.with_toxic, self.alone = _compressor(toxic + ordinary), _compressor(ordinary)

    def features(self, text: str) -> np.ndarray:
        """A one, then for each threshold the share of windows beyond it and whether there is one, then the
        largest distance and the mean one; zeros for a text without words."""
        out = np.zeros(self.size)
        out[0] = 1
        windows = _windows(text)
        if windows:
            saved = np.array([len(self.alone(w)) - len(self.with_toxic(w)) for w in windows], float)
            for k, threshold in enumerate(THRESHOLDS):
                beyond = saved >= threshold
                out[1 + 2 * k] = min(1.0, 8 * beyond.mean())
                out[2 + 2 * k] = min(3, beyond.sum()) / 3
            out[-2:] = saved.max() / 10, saved.mean()
        return out


@dataclass(frozen=True)
class Toxicity:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 3e-3) -> np.ndarray:
    w, cost = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(40):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (cost * (p - y)) + ridge * w
        hessian = (x * (cost * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w


def calibrated(x: np.ndarray, y: np.ndarray, half: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the features, with the cost of a miss that serves the sample best.

    For each cost either half is judged by a fit to the other, and the cost with the highest F1 of both together wins, the
    first of equals; `weight` is how many labelled texts a text stands for.
    """
    best, chosen = -1.0, MISS_COSTS[0]
    for cost in MISS_COSTS:
        hit = np.zeros(len(y), dtype=bool)
        for k in (0, 1):
            fit, judged = half == k, half != k
            w = _logistic(x[fit], y[fit], weight[fit] * np.where(y[fit] > 0, cost, 1))
            hit[judged] = x[judged] @ w >= 0
        found = (weight * hit * y).sum()
        f1 = 2 * found / max(1e-9, (weight * hit).sum() + (weight * y).sum())
        if f1 > best + 1e-9:
            best, chosen = f1, cost
    return _logistic(x, y, weight * np.where(y > 0, chosen, 1))


def measure(toxic: bytes, ordinary: bytes):
    """Column function: features of a text under a pair of dictionaries."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        distances = Distances(toxic, ordinary)
        return pa.array(
            [distances.features(t.as_py() or "").tolist() for t in texts], pa.list_(pa.float64())
        )

    return of


def train(labelled: DataFrame, max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS) -> Toxicity:
    """Model from rows `labelled (doc_id, text, toxic)`; see `train_from`."""
    return train_from(labelled, labelled.select("doc_id", "toxic"), max_texts, max_chars)


def picked_keys(docs: DataFrame, labels: DataFrame, max_texts: int, max_chars: int) -> DataFrame:
    """`(doc_id, key, toxic, weight)` of the texts to learn from: ids and hashes alone move.

    Of each class the first `max_texts` in order of a hash of the id, as long as they have `max_chars`
    characters together, a text that would go beyond left out; `weight` is how many labelled texts one stands for.
    """
    kinds = F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most")
    sure = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(*kinds)
    sure = sure.filter("toxic = most").drop("most")
    sized = docs.filter("text is not null").select(
        "doc_id", F.xxhash64("text").alias("key"), F.length("text").cast("long").alias("chars")
    ).distinct()
    rows = materialise(
        sized.join(sure, "doc_id").withColumn("h", F.xxhash64(F.col("doc_id"), F.lit(1))), "labelled-keys"
    )
    parts = []
    for k in (0, 1):
        mine = rows.filter(F.col("toxic") == k)
        first = mine.orderBy("h", "key").limit(max_texts)
        so_far = Window.orderBy("h", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fits = first.withColumn("upto", F.sum("chars").over(so_far)).filter(F.col("upto") <= max_chars)
        weight = F.lit(mine.count()) / F.greatest(F.count(F.lit(1)).over(Window.partitionBy("toxic")), F.lit(1))
        parts.append(fits.select("doc_id", "key", "toxic", weight.alias("weight")))
    return materialise(parts[0].union(parts[1]), "picked")


def train_from(
    docs: DataFrame, labels: DataFrame, max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS
) -> Toxicity:
    """Model from `docs (doc_id, text)` and `labels (doc_id, toxic)`.

    It learns from a bounded sample (see `picked_keys`): at most `max_texts` texts and `max_chars`
    characters of each class. Each half of the sample is measured with dictionaries from the other half, and the
    calibration is fitted to both; the final dictionaries come from the whole sample. Without both classes
    all scores are alike. Rows without id, text or label 0 or 1 are not learned from, nor ids labelled both ways; equal
    labels of an id count once, equal rows once; other columns of `docs`, one named `toxic` too, are ignored.
    """
    docs = docs.select("doc_id", "text")
    # At most 2 x max_texts rows of four numbers, so they may go to every task; the texts stay where they are.
    keys = F.broadcast(picked_keys(docs, labels, max_texts, max_chars))
    found = docs.withColumn("key", F.xxhash64("text")).join(keys, ["doc_id", "key"]).distinct()
    half = F.pmod(F.xxhash64("doc_id", "key"), F.lit(2)).cast("int").alias("half")
    sample = materialise(found.select("text", "toxic", "weight", half), "labelled")
    held = sample.collect()  # bounded: 2 x max_chars characters
    texts = {(k, h): [r.text for r in held if (r.toxic, r.half) == (k, h)] for k in (0, 1) for h in (0, 1)}
    n = [len(texts[k, 0]) + len(texts[k, 1]) for k in (0, 1)]
    if not all(n):
        share = n[1] / max(1, sum(n))
        weights = np.zeros(Distances.size)
        weights[0] = np.log((share + 0.01) / (1.01 - share))
        return Toxicity(b"", b"", tuple(weights))
    measured = []
    for h in (0, 1):
        pair = train_dictionaries(texts[1, 1 - h], texts[0, 1 - h])
        unseen = sample.filter(f"half = {h}").repartition(8, F.xxhash64("text"))
        measured += unseen.select("toxic", "half", "weight", measure(*pair)("text").alias("x")).collect()
    final = train_dictionaries(texts[1, 0] + texts[1, 1], texts[0, 0] + texts[0, 1])
    measured.sort(key=lambda r: (r.half, r.toxic, r.x))
    x = np.array([r.x for r in measured])
    y = np.array([r.toxic for r in measured], dtype=float)
    weights = calibrated(
        x, y, np.array([r.half for r in measured]), np.array([r.weight for r in measured])
    )
    return Toxicity(*final, tuple(weights.tolist()))


def scorer(model: Toxicity):
    """Column function: score from 0 to 1 of a text. Null and empty texts get the score of no window.

    A text's score depends on the text alone; the whole of it is read.
    """

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        distances = Distances(model.toxic, model.ordinary)
        weights = np.array(model.weights)
        z = np.array([distances.features(t.as_py() or "") @ weights for t in texts], float)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())

    return score
