"""SimHash near-duplicates, linked by way of pivot distance tables.

The Hamming distances of every fingerprint to many fixed reference fingerprints form its row in the
pivot table. Two fingerprints that differ in k bits differ by at most k in every coordinate, so pairs
with a larger difference anywhere are discarded and only survivors are compared bit by bit.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.llm.components import components
from squall.storage import materialise

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
PIVOTS = 16
BANDS = 5
CELL_ROWS = 16_384  # fingerprints compared at once; a fuller cell is dealt to several tasks


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, from a fixed rule."""
    return np.array(
        [xxhash.xxh64_intdigest(f"pivot {k}".encode(), seed=SEED) for k in range(count)], np.uint64
    )


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, lower-cased in A-Z, repeats counted; 0 for no words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-size].tolist()]
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at : at + 65_536], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(size: int = SHINGLE):
    """Column function: fingerprint of a binary text, as a signed long."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t.as_py() or b"", size) for t in texts], dtype=np.uint64)
        return pa.array(found.view(np.int64))

    return of


def band_masks(bands: int = BANDS) -> list[int]:
    """Cuts 64 bits into `bands` runs of near equal length."""
    cuts = [64 * k // bands for k in range(bands + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def keyed(max_distance: int = MAX_DISTANCE, bands: int = BANDS):
    """Maps fingerprints to the cells in which they may meet others.

    Of `bands` runs of bits, two fingerprints within `max_distance` agree in at least
    `bands - max_distance`; so they meet under one choice of that many runs. The first coordinates of the
    pivot table cut these cells: a fingerprint stands in its own interval of `max_distance + 1` distances
    and in the next lower one, and two whose coordinates are close enough share one.
    """
    masks = band_masks(bands)
    keys = [sum(c) for c in combinations(masks, bands - max_distance)]
    first = pivots(1)[0]
    width = max_distance + 1

    def deal(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            interval = np.bitwise_count(fp ^ first).astype(np.int64) // width
            for number, mask in enumerate(keys):
                value = (fp & np.uint64(mask)).view(np.int64)
                for shift in (0, 1):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(interval - shift + 64 * number, pa.int32()),
                            pa.array(value), pa.array(fp.view(np.int64)),
                        ], names=["part", "band", "fp"],
                    )

    return deal


def near(left: np.ndarray, right: np.ndarray, max_distance: int, refs: np.ndarray):
    """Pairs `(i, j)` of places in `left` and `right` within `max_distance`, by way of the pivot table."""
    table_l = np.bitwise_count(left[:, None] ^ refs[None, :]).astype(np.int16)
    table_r = np.bitwise_count(right[:, None] ^ refs[None, :]).astype(np.int16)
    order = np.argsort(table_r[:, 0], kind="stable")
    column = table_r[order, 0]
    low = np.searchsorted(column, table_l[:, 0] - max_distance, side="left")
    high = np.searchsorted(column, table_l[:, 0] + max_distance, side="right")
    step = max(1, 2_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        counts = (high - low)[at : at + step]
        i = np.repeat(np.arange(at, at + len(counts)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        j = order[np.repeat(low[at : at + step], counts) + offset]
        for k in range(1, len(refs)):
            keep = np.abs(table_l[i, k] - table_r[j, k]) <= max_distance
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(left[i] ^ right[j]) <= max_distance
        yield i[keep], j[keep]


def linker(max_distance: int = MAX_DISTANCE):
    """Links within one cell, or between two shares of a fuller one, thinned to what keeps them connected."""
    refs = pivots()

    def link(group: pa.Table) -> pa.Table:
        fp = np.unique(group["fp"].to_numpy().view(np.uint64))
        side = group["side"].to_numpy()
        both = group["fp"].to_numpy().view(np.uint64)
        left = np.unique(both[side != 1]) if (side == 1).any() else fp
        right = np.unique(both[side == 1]) if (side == 1).any() else fp
        root = np.arange(len(fp))
        to_l, to_r = np.searchsorted(fp, left), np.searchsorted(fp, right)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in near(left, right, max_distance, refs):
            a, b = to_l[i], to_r[j]
            for x, y in zip(a[a != b].tolist(), b[a != b].tolist()):
                x, y = top(x), top(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        tops = np.array([top(x) for x in range(len(fp))], dtype=np.int64)
        apart = tops != np.arange(len(fp))
        return pa.table({
            "a": pa.array(fp[tops[apart]].view(np.int64)), "b": pa.array(fp[apart].view(np.int64)),
        })

    return link


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """`(a, b)`: links between fingerprints `fps (fp)` that keep connected what lies within `max_distance`.

    Cells with one fingerprint are dropped before any comparison. A cell with more than CELL_ROWS is
    split into shares, and each pair of shares is a task of its own.
    """
    cells = fps.select("fp").mapInArrow(keyed(max_distance), "part int, band long, fp long")
    cells = materialise(cells, "cells")
    sizes = cells.groupBy("part", "band").agg(F.count("*").alias("n")).filter("n > 1")
    placed = cells.join(sizes, ["part", "band"])
    shares = F.ceil(F.col("n") / F.lit(CELL_ROWS)).cast("int")
    placed = placed.withColumn("shares", shares).withColumn(
        "share", F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")
    )
    # Share s takes part in the pairs (s, t) for t >= s as the left and (t, s) for t < s as the right side.
    pairs = F.expr(
        "if(shares = 1, array(struct(0 as p, 0 as q, 0 as side)), transform(sequence(0, shares - 1), "
        "t -> struct(least(t, share) as p, greatest(t, share) as q, if(t < share, 1, 0) as side)))"
    )
    dealt = placed.select("part", "band", "fp", F.explode(pairs).alias("x")).select(
        "part", "band", "fp", "x.p", "x.q", "x.side"
    )
    return dealt.groupBy("part", "band", "p", "q").applyInArrow(linker(max_distance), "a long, b long")


def _classified(docs: DataFrame, shingle: int, max_distance: int) -> DataFrame:
    """`(doc_id, text_hash, fp, root, component_id)` for each row of `docs`, from a written table."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    of = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), fingerprints(shingle)(text).alias("fp")
    )
    of = materialise(of, "fingerprints")
    classes = materialise(of.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = materialise(components(links(classes, max_distance)), "components")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return of.join(named, "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """`(doc_id, fingerprint, component_id)` for each row of `docs (doc_id, text, …)`.

    Fingerprints link at `max_distance` or fewer differing bits; `component_id` is the smallest id
    reachable, null where no row of the component has one. Null and empty texts have fingerprint zero
    and link like any other; equal ids and equal rows keep a row each; other columns are ignored.
    """
    return _classified(docs, shingle, max_distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """Rows of `docs`, of each group of near duplicates only one: that with the smallest id.

    Rows without an id come last, and the text's hash decides among equal ids; of rows equal in both, one
    stays. Ids, fingerprints and hashes find who stays; the texts move once, to meet the answer.
    """
    of = _classified(docs, shingle, max_distance)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    stay = of.groupBy("root").agg(F.min(order).alias("s")).select("s.doc_id", "s.text_hash")
    stay = materialise(stay.distinct(), "stay")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")
    )
    same = (F.col("hash") == F.col("text_hash")) & F.col("id").eqNullSafe(F.col("doc_id"))
    kept = rows.join(stay, same, "left_semi")
    return kept.dropDuplicates(["hash", "id"]).select("row.*")
