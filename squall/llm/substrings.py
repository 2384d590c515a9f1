"""Removal of repeated word windows, with a count-min sketch before the exact pass.

Every group of documents sketches its windows: a row of counters for each of two hashes, kept sparse. The
sketches of all groups are merged counter by counter, spread over buckets of counters, so a merged count is
never below a window's true count. Only windows whose counters all say "repeated" enter the second pass,
which groups them exactly, by 128 bits of hash.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.common import grouped, in_order, total_bytes
from squall.llm.packed import (
    deal, inverse, mixed, pack, pack_rising, sums, unpack, unpack_rising,
)

WINDOW = 35
GROUP_BYTES = 6 << 20
BUCKET_WINDOWS = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses


def windows(texts: list[bytes], window: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """First words of all windows, two 64-bit hashes of each, and the number of words of each text."""
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    total = int(counts.sum())
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for words in split for w in words), np.uint64, total)
    ends = np.repeat(np.cumsum(counts), counts)
    first = np.flatnonzero(np.arange(total) + window <= ends)
    lanes = []
    for base, values in zip(BASES, (hashes, mixed(hashes + np.uint64(1)))):
        s = sums(values, base)
        down = np.full(total, inverse(base), dtype=np.uint64)
        down[:1] = 1
        down = np.multiply.accumulate(down)
        lanes.append(mixed((s[first + window] - s[first]) * down[first]))
    return first, lanes, counts


def sketcher(window: int, cell_bits: int, bucket_bits: int):
    """A group's sketch: `(bucket, g, cells, many)`, for either hash its sorted counters and which exceed 1."""

    def sketch(group: pa.Table) -> pa.Table:
        group = in_order(group)
        _, lanes, _ = windows(group["text"].to_pylist(), window)
        rows = []
        for number, lane in enumerate(lanes):
            cells, counts = np.unique(lane >> np.uint64(64 - cell_bits), return_counts=True)
            for bucket, part in deal(cells >> np.uint64(cell_bits - bucket_bits)):
                many = np.packbits(counts[part] > 1)
                rows.append((bucket + (number << bucket_bits), pack_rising(cells[part]), pack(many)))
        return pa.table({
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "g": pa.array([group["g"][0].as_py()] * len(rows), pa.int32()),
            "cells": pa.array([r[1] for r in rows], pa.binary()),
            "many": pa.array([r[2] for r in rows], pa.binary()),
        })

    return sketch


def merge(bucket: pa.Table) -> pa.Table:
    """Merges the sketches of one bucket of counters; tells each group which of its counters reach 2."""
    cells = [unpack_rising(c.as_py()) for c in bucket["cells"]]
    many = [
        np.unpackbits(unpack(m.as_py(), "u1"), count=len(c)).astype(bool)
        for m, c in zip(bucket["many"], cells)
    ]
    together, counts = np.unique(np.concatenate(cells), return_counts=True)
    repeated = counts > 1
    answers = [
        pack(np.packbits(repeated[np.searchsorted(together, c)] | m)) for c, m in zip(cells, many)
    ]
    return pa.table({
        "g": bucket["g"], "bucket": bucket["bucket"], "repeated": pa.array(answers, pa.binary()),
    })


def exact_dealer(window: int, cell_bits: int, bucket_bits: int):
    """The windows whose counters all say "repeated": `(bucket, g, first, second, place)`."""

    def dealt(group: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if len(group):
            group = in_order(group)
            first, lanes, _ = windows(group["text"].to_pylist(), window)
            said = dict(zip(answers["bucket"].to_pylist(), answers["repeated"].to_pylist()))
            suspect = np.ones(len(first), dtype=bool)
            for number, lane in enumerate(lanes):
                of = lane >> np.uint64(64 - cell_bits)
                cells = np.unique(of)
                repeated = np.concatenate([np.zeros(0, bool)] + [
                    np.unpackbits(
                        unpack(said[bucket + (number << bucket_bits)], "u1"),
                        count=part.stop - part.start,
                    ).astype(bool)
                    for bucket, part in deal(cells >> np.uint64(cell_bits - bucket_bits))
                ])
                suspect &= repeated[np.searchsorted(cells, of)] if len(cells) else suspect
            place, a, b = first[suspect], lanes[0][suspect], lanes[1][suspect]
            order = np.lexsort((b, a))
            place, a, b = place[order].astype("<u4"), a[order], b[order]
            for bucket, part in deal(a >> np.uint64(64 - bucket_bits)):
                rows.append((bucket, pack_rising(a[part]), pack(b[part]), pack(place[part])))
        g = group["g"][0].as_py() if len(group) else 0
        return pa.table({
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "g": pa.array([g] * len(rows), pa.int32()),
            "first": pa.array([r[1] for r in rows], pa.binary()),
            "second": pa.array([r[2] for r in rows], pa.binary()),
            "place": pa.array([r[3] for r in rows], pa.binary()),
        })

    return dealt


def group_exactly(bucket: pa.Table) -> pa.Table:
    """Places of the windows that occur twice or more, for each group."""
    a = [unpack_rising(x.as_py()) for x in bucket["first"]]
    b = [unpack(x.as_py(), "<u8") for x in bucket["second"]]
    sizes = [len(x) for x in a]
    first, second = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((second, first))
    same = (np.diff(first[order]) == 0) & (np.diff(second[order]) == 0)
    repeated = np.zeros(len(first), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    at, answers = 0, []
    for place, size in zip(bucket["place"], sizes):
        answers.append(pack_rising(np.sort(unpack(place.as_py(), "<u4")[repeated[at : at + size]])))
        at += size
    return pa.table({"g": bucket["g"], "places": pa.array(answers, pa.binary())})


def remover(window: int):
    """`(doc_id, n_words, n_removed, kept)` of a group, given the places of repeated windows."""

    def remove(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table({
                "doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.binary()),
            })
        group = in_order(group)
        split = [t.split() for t in group["text"].to_pylist()]
        ends = np.cumsum([len(w) for w in split])
        change = np.zeros(int(ends[-1]) + window + 1, dtype=np.int64)
        for packed in answers["places"].to_pylist():
            places = unpack_rising(packed).astype(np.int64)
            change[places] += 1
            change[places + window] -= 1
        removed = (np.cumsum(change) > 0)[: int(ends[-1])]
        kept, gone, at = [], [], 0
        for words in split:
            cut = removed[at : at + len(words)]
            at += len(words)
            n = int(cut.sum())
            gone.append(n)
            kept.append(b" ".join(words if not n else [w for w, c in zip(words, cut.tolist()) if not c]))
        return pa.table({
            "doc_id": group["doc_id"], "n_words": pa.array([len(w) for w in split], pa.int64()),
            "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.binary()),
        })

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`(doc_id, n_words, n_removed, kept)` for each row of `docs (doc_id, text, …)`.

    Every word covered by a window of `window` words that also starts anywhere else is removed; `kept` holds
    the other words, joined by one space. Null and short texts have no window and keep all their words;
    equal rows repeat each other; an empty table gives no rows; other columns are ignored.

    The number of counters follows the bytes of all texts, so the sketch is as sharp at any size. Texts are
    shuffled once, into groups a task can hold; the three passes over them read that shuffle again.
    """
    size = total_bytes(docs)
    cell_bits = max(24, int(math.log2(size + 1)) + 2)
    bucket_bits = max(1, int(math.log2(size / 6 / BUCKET_WINDOWS + 1)) + 1)
    groups = grouped(docs, GROUP_BYTES, size)
    sketches = groups.groupBy("g").applyInArrow(
        sketcher(window, cell_bits, bucket_bits), "bucket int, g int, cells binary, many binary"
    )
    merged = sketches.groupBy("bucket").applyInArrow(merge, "g int, bucket int, repeated binary")
    suspects = groups.groupBy("g").cogroup(merged.groupBy("g")).applyInArrow(
        exact_dealer(window, cell_bits, bucket_bits),
        "bucket int, g int, first binary, second binary, place binary",
    )
    places = suspects.groupBy("bucket").applyInArrow(group_exactly, "g int, places binary")
    return groups.groupBy("g").cogroup(places.groupBy("g")).applyInArrow(
        remover(window), "doc_id long, n_words long, n_removed long, kept binary"
    )
