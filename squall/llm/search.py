"""Ranked lexical search: every query against all documents, the highest scores of each.

A task reads its documents in blocks and builds an inverted index of the queries' terms over each block, with the
greatest contribution of every list in every stretch of documents. A query is scored in two ways at once.
Its short lists are worked through term at a time into summed accumulators. These then count as one list
with a bound of its own among the long lists, and documents are scored in order, stretch by stretch:
a stretch whose bounds do not reach the query's threshold is skipped, and in the others the lists of least
bound are only looked up for documents that may still reach it. Thresholds stay from block to block.

All documents meet all queries, a bounded block of queries at a time; what leaves a task is its best
documents of each query, so no list of a frequent term is ever gathered.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.counts import summed
from squall.llm.decontaminate import normalised

BEST = 10
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 20  # of one index; whichever is full first
STRETCH = 1024  # documents under one bound
SHORT = 256  # postings of a list that goes into the accumulators
BLOCK_TERMS = 100_000  # different terms of the queries searched at once
SHARES = 64  # of a query's finds, cut to the best before they meet

_FOUND = "q int, item_id string, doc_id long, score long"


@dataclass(frozen=True)
class Queries:
    """A block of queries: the number of each term, and each query's id and terms."""

    terms: dict[bytes, int]
    ids: list[str | None]
    lists: list[np.ndarray]


def query_blocks(queries: DataFrame, max_terms: int = BLOCK_TERMS) -> Iterator[Queries]:
    """All queries, in blocks of a bounded number of terms; the driver holds one at a time."""
    block, used = Queries({}, [], []), 0
    for row in queries.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = dict.fromkeys(normalised((row[1] or "").encode()).split())
        if not words:
            continue
        if used and used + len(words) > max_terms:
            yield block
            block, used = Queries({}, [], []), 0
        used += len(words)
        numbers = [block.terms.setdefault(w, len(block.terms)) for w in words]
        block.ids.append(row[0])
        block.lists.append(np.array(sorted(numbers), dtype=np.int64))
    if block.ids:
        yield block


def count_documents(docs: DataFrame, terms: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """How many documents have a term at all, how many terms all have, and in how many each of `terms` stands."""

    def count(batches):
        total = np.zeros(len(terms) + 2, dtype=np.int64)
        number = terms.get
        for batch in batches:
            for text in batch["text"]:
                words = normalised(text.as_py() or b"").split()
                if words:
                    found = set(map(number, set(words)))
                    found.discard(None)
                    total[list(found)] += 1
                    total[-2] += 1
                    total[-1] += len(words)
        return total

    total = summed(docs, count, len(terms) + 2)
    return int(total[-2]), int(total[-1]), total[:-2]


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Index:
    """Lists of the terms over one block of documents, numbered in order.

    `begins[t, s]` is the first posting of term t in stretch s or later, `peak[t, s]` the greatest
    contribution of t there.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, gain: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((doc, term))
        self.doc, self.gain = doc[order], gain[order]
        stretches = -(-n_docs // STRETCH)
        cell = term[order] * stretches + self.doc // STRETCH
        edges = np.searchsorted(cell, np.arange(n_terms * stretches + 1))
        self.begins = np.empty((n_terms, stretches + 1), dtype=np.int64)
        self.begins[:, :-1] = edges[:-1].reshape(n_terms, stretches)
        self.begins[:, -1] = edges[stretches::stretches]
        self.peak = np.zeros(n_terms * stretches, dtype=np.int64)
        held = np.flatnonzero(np.diff(edges))
        if len(held):
            self.peak[held] = np.maximum.reduceat(self.gain, edges[held])
        self.peak = self.peak.reshape(n_terms, stretches)
        self.length = self.begins[:, -1] - self.begins[:, 0]

    def accumulators(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the lists of `terms`, in order, and their summed contributions."""
        parts = [slice(self.begins[t, 0], self.begins[t, -1]) for t in terms]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, at = np.unique(np.concatenate([self.doc[p] for p in parts]), return_inverse=True)
        sums = np.zeros(len(docs), dtype=np.int64)
        np.add.at(sums, at, np.concatenate([self.gain[p] for p in parts]))
        return docs, sums

    def search(self, terms: np.ndarray, best: "Best", doc_ids: np.ndarray) -> None:
        """Give `best` all documents of the block that reach its threshold."""
        terms = terms[self.length[terms] > 0]
        if not len(terms):
            return
        short = self.length[terms] <= SHORT
        acc_docs, acc_sums = self.accumulators(terms[short])
        long = terms[~short]
        stretches = self.peak.shape[1]
        acc_begins = np.searchsorted(acc_docs, np.arange(stretches + 1) * STRETCH)
        acc_peak = np.zeros(stretches, dtype=np.int64)
        held = np.flatnonzero(np.diff(acc_begins))
        if len(held):
            acc_peak[held] = np.maximum.reduceat(acc_sums, acc_begins[held])
        # The accumulators are the first row of bounds, the long lists the others.
        bounds = np.vstack([acc_peak, self.peak[long]])
        for s in np.flatnonzero(bounds.sum(axis=0) >= best.threshold).tolist():
            bound = bounds[:, s]
            if bound.sum() < best.threshold:  # it may have risen meanwhile
                continue
            order = np.argsort(bound, kind="stable")
            below = np.cumsum(bound[order])  # what the lists up to here can give together
            first = int(np.searchsorted(below, best.threshold))  # lists before it alone reach nothing
            sums = np.zeros(STRETCH, dtype=np.int64)
            for k in order[first:].tolist():
                docs, gains = self._part(k, s, long, acc_docs, acc_sums, acc_begins)
                sums[docs - s * STRETCH] += gains
            alive = np.flatnonzero(sums)
            for k in range(first - 1, -1, -1):
                alive = alive[sums[alive] + below[k] >= best.threshold]
                if not len(alive):
                    break
                docs, gains = self._part(int(order[k]), s, long, acc_docs, acc_sums, acc_begins)
                at = np.searchsorted(docs, alive + s * STRETCH)
                at[at == len(docs)] = 0
                hit = docs[at] == alive + s * STRETCH if len(docs) else np.zeros(len(alive), bool)
                sums[alive[hit]] += gains[at[hit]]
            alive = alive[sums[alive] >= best.threshold]
            if len(alive):
                best.offer(sums[alive], doc_ids[alive + s * STRETCH])

    def _part(self, k, s, long, acc_docs, acc_sums, acc_begins):
        """Documents and contributions in a stretch: of the accumulators for 0, of a long list otherwise."""
        if k == 0:
            part = slice(acc_begins[s], acc_begins[s + 1])
            return acc_docs[part], acc_sums[part]
        part = slice(self.begins[long[k - 1], s], self.begins[long[k - 1], s + 1])
        return self.doc[part], self.gain[part]


class Best:
    """The highest scores met so far, equal ones by smaller id, and the least score that may still enter."""

    def __init__(self, size: int):
        self.size, self.threshold = size, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.size:
            self.threshold = max(1, int(self.scores[-1]))


NO_ID = np.iinfo(np.int64).max  # stands for a null id inside a task, last among equal scores


def searcher(block: Queries, weights: np.ndarray, n_docs: int, n_terms: int, size: int):
    """Best documents of each query of the block among those of a partition."""

    def flush(held, doc_ids, lengths, bests):
        count = len(doc_ids)
        if not held[0] or not count:
            return
        term = np.array(held[0], dtype=np.int64)
        tf = np.array(held[1], dtype=np.int64)
        doc = np.repeat(np.arange(count), np.array(held[2], dtype=np.int64))
        norm = np.array([10 + 90 * n * n_docs // n_terms for n in lengths], dtype=np.int64)
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[doc]))
        index = Index(term, doc, gain, len(weights), count)
        ids = np.array(doc_ids, dtype=np.int64)
        for terms, best in zip(block.lists, bests):
            index.search(terms, best, ids)

    def search(batches):
        number = block.terms.get
        bests = [Best(size) for _ in block.lists]
        held, doc_ids, lengths = ([], [], []), [], []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = normalised(text.as_py() or b"").split()
                found = Counter(map(number, words))
                found.pop(None, None)
                if not found:
                    continue
                held[0].extend(found)
                held[1].extend(found.values())
                held[2].append(len(found))
                doc_ids.append(NO_ID if doc_id is None else doc_id)
                lengths.append(len(words))
                if len(doc_ids) >= BLOCK_DOCS or len(held[0]) >= BLOCK_POSTINGS:
                    flush(held, doc_ids, lengths, bests)
                    held, doc_ids, lengths = ([], [], []), [], []
        flush(held, doc_ids, lengths, bests)
        sizes = [len(b.ids) for b in bests]
        if sum(sizes):
            q = np.repeat(np.arange(len(bests)), sizes)
            ids = np.concatenate([b.ids for b in bests])
            yield pa.RecordBatch.from_arrays([
                pa.array(q.astype(np.int32)), pa.array([block.ids[k] for k in q], pa.string()),
                pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b.scores for b in bests])),
            ], names=["q", "item_id", "doc_id", "score"])

    return search


def best_of(found: DataFrame, size: int) -> DataFrame:
    """The best finds of each query, cut in shares first, with their ranks."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
    in_share = Window.partitionBy("q", share).orderBy(*order)
    cut = found.withColumn("turn", F.row_number().over(in_share)).filter(F.col("turn") <= size).drop("turn")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(*order))
    return cut.withColumn("rank", rank).filter(F.col("rank") <= size)


def rank(
    docs: DataFrame, queries: DataFrame, size: int = BEST, max_terms: int = BLOCK_TERMS
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: the `size` highest-scoring rows of `docs (doc_id, text)` for each row of
    `queries (item_id, text)`, scores above 0, equal ones by smaller id, null ids last.

    Whole texts count. Null and empty texts have no terms, match nothing and are not counted; a query without terms, or
    without any match, has no rows; without documents there are none at all. Equal rows of `docs` are listed each, equal
    rows of `queries` answered each; other columns are ignored. Ids of `docs` are integers.

    Queries of more than `max_terms` terms take several passes over `docs`; nothing is written between them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    kind = queries.schema["item_id"].dataType
    answers = []
    for block in query_blocks(queries, max_terms):
        n_docs, n_terms, df = count_documents(rows.select("text"), block.terms)
        if n_terms:
            search = searcher(block, term_weights(n_docs, df), n_docs, n_terms, size)
            best = best_of(rows.mapInArrow(search, _FOUND), size)
            answers.append(best.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    if not answers:
        none = queries.select("item_id", F.lit(0).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in ("doc_id", "score")])
        return none.filter(F.lit(False))
    out = answers[0]
    for more in answers[1:]:
        out = out.union(more)
    return out
