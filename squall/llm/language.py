"""Language identification as inference of a mixture of languages.

Hashed three-byte grams are counted for every language over all labelled training rows. In a text,
every word has a likelihood under every language, the product of its grams'. Expectation-maximisation
estimates the proportions in which languages make up the text's words. The language set grows by the one that
raises the likelihood fastest, as long as the penalised likelihood improves.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
SMOOTHING = 0.5
SETTLED = 1e-3  # shares that a round moves by less are settled
ROUNDS = 4  # of expectation-maximisation between two looks at what has settled
NEWCOMER = 0.1  # share a language begins with when it joins the set
TINY = 1e-300
CHUNK_BYTES = 1 << 18  # worked on at once
NONE = "und"  # no letter to go by

PREDICTION = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("languages", T.StringType()),
])

# Words are runs of letters a-z and of bytes beyond ASCII; all else is a blank.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256))


def chunks(texts: list[str], size: int = CHUNK_BYTES) -> Iterator[list[str]]:
    """Texts in turn, in lists of about `size` characters; a long text comes alone."""
    held, used = [], 0
    for text in texts:
        held.append(text)
        used += len(text)
        if used >= size:
            yield held
            held, used = [], 0
    if held:
        yield held


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all grams of the texts, the number of the word each belongs to, and the text of each word.

    Grams of a word cover it with a blank on either side.
    """
    coded = [t.lower().encode().translate(_LETTERS) for t in texts]
    ends = np.cumsum([len(c) + 2 for c in coded])
    data = np.frombuffer(b"\0\0" + b"\0\0".join(coded) + b"\0\0", dtype=np.uint8)
    letter = data != 0
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    text_of = np.searchsorted(ends, starts, side="right")
    # The gram that ends at i belongs to the word of i, or to the one just closed at i - 1.
    inside = letter[2:] | letter[1:-1]
    code = data.astype(np.uint32)
    code = (code[:-2] << 16) | (code[1:-1] << 8) | code[2:]
    bucket = ((code[inside] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)
    at = np.flatnonzero(inside) + 2
    # A blank right after a word counts with it, so look up the place before.
    word = np.searchsorted(starts, at - 1, side="right") - 1
    first = letter[at] & ~letter[at - 1]
    word = np.where(first, word + 1, word)
    return bucket, word, text_of


@dataclass(frozen=True)
class Languages:
    """Log-likelihoods of the grams under each language."""

    names: tuple[str, ...]
    log_p: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, str]]:
        """`(language, its share of the words, all shares)` of each text."""
        out: list[tuple[str, float, str]] = []
        for part in chunks([t or "" for t in texts]):
            out += self._predict(part)
        return out

    def _predict(self, texts: list[str]) -> list[tuple[str, float, str]]:
        lettered = [regex.search(r"\p{L}", t) is not None for t in texts]
        n = len(self.names)
        if not n:
            return [(NONE, 0.0, "")] * len(texts)
        bucket, word, text_of = grams(texts)
        if not len(text_of):
            return [(self.names[0] if ok else NONE, 1 / n if ok else 0.0, "") for ok in lettered]
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        log_word = np.add.reduceat(self.log_p[bucket], begins, axis=0)  # words x languages
        log_word -= log_word.max(axis=1, keepdims=True)
        present, counts = np.unique(text_of, return_counts=True)
        chosen = mixtures(log_word, counts)
        shares = dict(zip(present.tolist(), chosen))
        out = []
        for k, ok in enumerate(lettered):
            if not ok:
                out.append((NONE, 0.0, ""))
            elif k not in shares:
                out.append((self.names[0], 1 / n, ""))
            else:
                s = shares[k]
                main = int(np.argmax(s))
                said = ",".join(
                    f"{self.names[j]}:{s[j]:.3f}" for j in np.argsort(-s, kind="stable") if s[j] > 0
                )
                out.append((self.names[main], float(min(max(s[main], 0.0), 1.0)), said))
        return out


def _firsts(counts: np.ndarray) -> np.ndarray:
    """Where each text's words begin."""
    return np.cumsum(counts) - counts


def settled(like: np.ndarray, counts: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shares of the languages in each text after expectation-maximisation until they settle.

    `like` has the likelihoods of all texts' words in turn, `counts` the words of each text; a language with
    share 0 stays out. Texts drop out as they settle.
    """
    out, todo = share.copy(), np.arange(len(counts))
    while len(todo):
        of, first = np.repeat(np.arange(len(todo)), counts), _firsts(counts)
        for _ in range(ROUNDS):
            before = share
            joint = share[of] * like
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), TINY)
            share = np.add.reduceat(joint, first, axis=0) / counts[:, None]
        out[todo] = share
        moving = np.abs(share - before).max(axis=1) > SETTLED
        like, todo, share, counts = like[np.repeat(moving, counts)], todo[moving], share[moving], counts[moving]
    return out


def mixtures(log_word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of the languages in each text, over the set with the best penalised likelihood.

    A set begins with the one best language and grows by the one towards which the likelihood rises fastest.
    The likelihood is concave in the shares, so where it rises towards none the set is whole. Any
    language may join; each must gain half a log of the words (the Bayesian information criterion).
    """
    n = log_word.shape[1]
    like = np.exp(log_word)
    alone = np.add.reduceat(log_word.astype(np.float64), _firsts(counts), axis=0)
    chosen = np.zeros((len(counts), n))
    chosen[np.arange(len(counts)), np.argmax(alone, axis=1)] = 1
    value, active = alone.max(axis=1), np.arange(len(counts))
    for size in range(1, n):
        of, first = np.repeat(np.arange(len(active)), counts), _firsts(counts)
        share = chosen[active]
        mix = np.maximum((share[of] * like).sum(axis=1), TINY)
        pull = np.add.reduceat(like / mix[:, None], first, axis=0)
        pull[share > 0] = 0
        joins = np.argmax(pull, axis=1)
        rises = pull[np.arange(len(active)), joins] > counts
        like, active, counts = like[np.repeat(rises, counts)], active[rises], counts[rises]
        if not len(active):
            break
        share, joins = (1 - NEWCOMER) * share[rises], joins[rises]
        share[np.arange(len(active)), joins] = NEWCOMER
        fitted = settled(like, counts, share)
        of, first = np.repeat(np.arange(len(active)), counts), _firsts(counts)
        mix = np.maximum((fitted[of] * like).sum(axis=1), TINY)
        penalised = np.add.reduceat(np.log(mix), first) - 0.5 * size * np.log(counts + 1)
        better = penalised > value[active]
        chosen[active[better]], value[active[better]] = fitted[better], penalised[better]
        like, active, counts = like[np.repeat(better, counts)], active[better], counts[better]
        if not len(active):
            break
    return chosen


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of grams by language, one dense vector for each language and task."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for part in chunks(texts):
                bucket, _, _ = grams(part)
                count = np.bincount(bucket, minlength=BUCKETS)
                held[lang] = held[lang] + count if lang in held else count
    for lang, count in held.items():
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(count[seen])],
            names=["lang", "bucket", "n"],
        )


def train(labelled: DataFrame) -> Languages:
    """Language models from all rows of `labelled (text, lang)`; rows with a null are left out.

    Tasks count, Spark adds up; the driver gets at most languages x BUCKETS counts.
    """
    rows = labelled.select("text", "lang").filter("text is not null and lang is not null")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(found["lang"].unique()))
    n = np.zeros((BUCKETS, len(names)))
    column = {name: j for j, name in enumerate(names)}
    n[found["bucket"].to_numpy(), found["lang"].map(column).to_numpy(dtype=int)] = found["n"]
    log_p = np.log(n + SMOOTHING) - np.log(n.sum(axis=0) + SMOOTHING * BUCKETS)
    return Languages(names, log_p.astype(np.float32))


def predictor(model: Languages):
    """Column function: prediction for a text. Null, and a text without a letter, is `und` with score 0.

    Whole texts of any length are read, and nothing but the text counts: equal rows get equal predictions, other
    columns do not matter, an empty table gives an empty one. Of equally likely languages the first by name
    stands. Without a learned language all are `und`.
    """

    @F.arrow_udf(PREDICTION)
    def predict(texts: pa.Array) -> pa.Array:
        rows = model.predict(texts.to_pylist())
        fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.string())]
        columns = [pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(fields)]
        return pa.StructArray.from_arrays(columns, names=[f for f, _ in fields])

    return predict
