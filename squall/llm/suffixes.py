"""Removal of repeated byte strings by sorting suffixes.

Every string of `length` bytes holds an anchor: of the runs of KEY bytes in it, the one with the smallest
hash. Equal strings have equal anchors at equal places, so only suffixes that begin at anchors need to be
compared. Anchors whose run occurs once are dropped; those whose whole surroundings recur are repeated
throughout. The rest are sorted: sampled splitters range-partition them by their leading bytes, each bucket
sorts its own by multikey quicksort and compares neighbours, and runs that reach a bucket's edge are
compared across the boundaries.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.common import buffer_of, grouped, in_order, partitions, total_bytes
from squall.llm.packed import deal, inverse, mixed, pack, powers, sums, unpack

LENGTH = 200
KEY = 64  # bytes of an anchor's run
GROUP_BYTES = 3 << 20
BLOCK = 1 << 18  # positions hashed at once
BUCKET_ANCHORS = 1 << 17
CROSS = 4  # bytes before an anchor by which a family of suffixes may be cut
BASE = 0x9E3779B97F4A7C15
DROP, REPEATED, PARTNER, OPEN = 0, 1, 2, 3  # what becomes of an anchor


def anchors(data: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Places of all anchors, the hash of each one's run, and a hash of its surroundings.

    The surroundings are the bytes that strings of `length` bytes around the run may take in, within the text.
    """
    width = length - KEY + 1  # runs in a string
    reach = length - KEY
    places, runs, around = [], [], []
    down = np.full(BLOCK + 3 * length, inverse(BASE), dtype=np.uint64)
    down[:1] = 1
    down = np.multiply.accumulate(down)
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        left = max(0, low - length)
        part = data[left : high + 2 * length]
        usable = np.zeros(high - low, dtype=bool)  # begins of whole strings
        for k in range(int(np.searchsorted(begins, low, "right")) - 1, len(begins) - 1):
            if begins[k] >= high:
                break
            a, b = max(int(begins[k]), low), min(int(begins[k + 1]) - length + 1, high)
            if a < b:
                usable[a - low : b - low] = True
        if not usable.any():
            continue
        s = sums(part.astype(np.uint64) + np.uint64(1), BASE)
        n = len(part) - KEY + 1
        run = mixed((s[KEY:] - s[:-KEY]) * down[:n])
        # The smallest hash of `width` runs, ties to the first: place in the low bits, minimum by doubling.
        best = (run[low - left :] & ~np.uint64((1 << 22) - 1)) | np.arange(
            n - (low - left), dtype=np.uint64
        )
        span = 1
        while 2 * span <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
        at = np.unique(best[: high - low][usable[: len(best)]] & np.uint64((1 << 22) - 1)).astype(np.int64) + low
        text = np.searchsorted(begins, at, "right") - 1
        a = np.maximum(begins[text], at - reach)
        b = np.minimum(begins[text + 1], at + length)
        places.append(at)
        runs.append(run[at - left])
        whole = (s[b - left] - s[a - left]) * down[a - left]
        shape = ((at - a) * 1024 + (b - at)).astype(np.uint64)
        around.append(mixed(whole ^ mixed(shape + np.uint64(7))))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, once = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(runs)[once], np.concatenate(around)[once]


def anchor_dealer(length: int, bucket_bits: int):
    """A group's anchors, dealt to buckets by the hash of their run: `(bucket, g, run, around, place)`."""

    def dealt(group: pa.Table) -> pa.Table:
        group = in_order(group)
        place, run, around = anchors(*buffer_of(group["text"]), length)
        order = np.argsort(run, kind="stable")
        place, run, around = place[order].astype("<u4"), run[order], around[order]
        rows = [
            (bucket, pack(run[part]), pack(around[part]), pack(place[part]))
            for bucket, part in deal(run >> np.uint64(64 - bucket_bits))
        ]
        return pa.table({
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "g": pa.array([group["g"][0].as_py()] * len(rows), pa.int32()),
            "run": pa.array([r[1] for r in rows], pa.binary()),
            "around": pa.array([r[2] for r in rows], pa.binary()),
            "place": pa.array([r[3] for r in rows], pa.binary()),
        })

    return dealt


def sift(bucket: pa.Table) -> pa.Table:
    """What becomes of each anchor, for each group: `(g, place, fate)`; dropped ones are left out.

    Anchors with equal runs and equal surroundings are REPEATED, and where the run has other surroundings
    too, the first of them is a PARTNER, to be compared with those. Anchors whose run recurs in other
    surroundings only are OPEN.
    """
    runs = [unpack(x.as_py(), "<u8") for x in bucket["run"]]
    run = np.concatenate(runs)
    around = np.concatenate([unpack(x.as_py(), "<u8") for x in bucket["around"]])
    order = np.lexsort((around, run))
    new_run = np.diff(run[order], prepend=~run[order[:1]]) != 0
    new_both = new_run | (np.diff(around[order], prepend=~around[order[:1]]) != 0)
    run_of, both_of = np.cumsum(new_run) - 1, np.cumsum(new_both) - 1
    in_run, in_both = np.bincount(run_of), np.bincount(both_of)
    kinds = np.bincount(run_of[new_both])  # different surroundings of each run
    same = in_both[both_of] > 1
    fate = np.where(same, REPEATED, np.where(in_run[run_of] > 1, OPEN, DROP))
    fate[same & new_both & (kinds[run_of] > 1)] = PARTNER
    fates = np.empty(len(run), dtype=np.uint8)
    fates[order] = fate
    at, answers = 0, []
    for packed, part in zip(bucket["place"], runs):
        mine = fates[at : at + len(part)]
        at += len(part)
        keep = mine != DROP
        answers.append((pack(unpack(packed.as_py(), "<u4")[keep]), pack(mine[keep])))
    return pa.table({
        "g": bucket["g"], "place": pa.array([x[0] for x in answers], pa.binary()),
        "fate": pa.array([x[1] for x in answers], pa.binary()),
    })


def _fates(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = [
        (unpack(p.as_py(), "<u4").astype(np.int64), unpack(f.as_py(), "u1"))
        for p, f in zip(answers["place"], answers["fate"])
        if p.as_py() is not None
    ]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])


def suffix_reader(length: int):
    """Suffixes of the partners and open anchors, with what precedes them: `(g, place, partner, left, suffix)`."""

    def read(group: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if len(group):
            group = in_order(group)
            data, begins = buffer_of(group["text"])
            raw = data.tobytes()
            place, fate = _fates(answers)
            keep = fate >= PARTNER
            place, fate = place[keep], fate[keep]
            text = np.searchsorted(begins, place, "right") - 1
            low = np.maximum(begins[text], place - (length - KEY)).tolist()
            high = np.minimum(begins[text + 1], place + length).tolist()
            rows = [
                (p, f == PARTNER, raw[a:p], raw[p:b])
                for p, f, a, b in zip(place.tolist(), fate.tolist(), low, high)
            ]
        g = group["g"][0].as_py() if len(group) else 0
        return pa.table({
            "g": pa.array([g] * len(rows), pa.int32()),
            "place": pa.array([r[0] for r in rows], pa.int64()),
            "partner": pa.array([r[1] for r in rows], pa.bool_()),
            "left": pa.array([r[2] for r in rows], pa.binary()),
            "suffix": pa.array([r[3] for r in rows], pa.binary()),
        })

    return read


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian 8-byte characters, by three-way multikey quicksort."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == keys.shape[1]:
            continue
        part = order[low:high]
        if high - low <= 64:
            rest = keys[part, depth:]
            order[low:high] = part[np.lexsort(rest.T[::-1])]
            continue
        column = keys[part, depth]
        pivot = np.partition(column, (high - low) // 2)[(high - low) // 2]
        less, more = column < pivot, column > pivot
        equal = ~(less | more)
        a, b = low + int(less.sum()), low + int(less.sum() + equal.sum())
        order[low:high] = np.concatenate([part[less], part[equal], part[more]])
        todo += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _matrix(strings: list[bytes], width: int, from_end: bool = False) -> np.ndarray:
    """Strings as rows of bytes, padded with zeros; from their ends backwards if asked."""
    padded = [s[::-1].ljust(width, b"\0") if from_end else s.ljust(width, b"\0") for s in strings]
    return np.frombuffer(b"".join(padded), dtype=np.uint8).reshape(len(strings), width)


def comparer(length: int):
    """Compares the suffixes of a bucket: `(g, place, most, least, offset, first, second, weight)`.

    An open anchor that lies within repeated strings gives one row with the `most` and `least` bytes by which
    such strings begin before it. Buckets cut a family of suffixes with equal leading bytes only between
    different bytes before the anchor, so strings that begin CROSS or more bytes before it meet in one bucket.
    Of the families at a bucket's ends, the shorter ones may have equals across the boundary: those give a row
    for every different string, with its hash.
    """
    reach = length - KEY
    names = ("g", "place", "most", "least", "offset", "first", "second", "weight")
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def rows_of(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def compare(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        suffixes, lefts = table["suffix"].to_pylist(), table["left"].to_pylist()
        right = _matrix(suffixes, -(-length // 8) * 8)
        order = multikey_order(right.view(">u8").astype(np.uint64))
        right = right[order]
        r_size = np.array([len(x) for x in suffixes])[order]
        l_size = np.array([len(x) for x in lefts])[order]
        left = _matrix(lefts, reach, from_end=True)[order]
        weight = np.where(table["partner"].to_numpy()[order], 2, 1)
        g, place = table["g"].to_numpy()[order], table["place"].to_numpy()[order]
        differ = right[1:] != right[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), right.shape[1])
        common = np.minimum(common, np.minimum(r_size[1:], r_size[:-1]))
        family = np.concatenate([[0], np.cumsum(common < KEY)])
        edge = (family == 0) | (family == family[-1])
        alone = np.bincount(family)[family] == 1
        most, least = np.full(len(order), -1), np.full(len(order), length)
        before = np.zeros(len(order), dtype=np.uint64)
        for offset in range(reach + 1):
            if offset:
                before = before * np.uint64(BASE) + left[:, offset - 1] + np.uint64(1)
            fits = (l_size >= offset) & (r_size >= length - offset) & ~alone
            if not fits.any():
                continue
            kind = np.concatenate([[0], np.cumsum(common < length - offset)]).astype(np.uint64)
            key = mixed(before ^ mixed(kind))[fits]
            _, of = np.unique(key, return_inverse=True)
            twice = np.bincount(of, weights=weight[fits])[of] >= 2
            rows = np.flatnonzero(fits)[twice]
            most[rows] = np.maximum(most[rows], offset)
            least[rows] = np.minimum(least[rows], offset)
        found = np.flatnonzero((most >= 0) & (weight == 1))
        none = np.zeros(len(found), np.int64)
        # Answers spread over the partitions by their place.
        yield rows_of(g[found], place[found], most[found], least[found], none - 1, place[found], g[found], none)
        for offset in range(CROSS):
            seen: dict[bytes, list[int]] = {}
            for k in np.flatnonzero(edge & (l_size >= offset) & (r_size >= length - offset)).tolist():
                cut = lefts[order[k]]
                string = cut[len(cut) - offset :] + suffixes[order[k]][: length - offset]
                # Equal strings count only at equal places about their anchor: so no place counts twice.
                entry = seen.setdefault(xxhash.xxh3_128_digest(string, seed=offset), [k, 0])
                entry[1] += int(weight[k])
            if seen:
                n = len(seen)
                both = np.frombuffer(b"".join(seen), dtype="<i8").reshape(-1, 2)
                at = np.array([k for k, _ in seen.values()])
                total = np.array([w for _, w in seen.values()])
                yield rows_of(
                    g[at], place[at], np.full(n, -1), np.full(n, -1), np.full(n, offset),
                    both[:, 0], both[:, 1], total,
                )

    return compare


def settle(batches):
    """`(g, at, most, least)`: answers from within the buckets, and those found across boundaries.

    A string that one bucket has twice was answered there; here it only counts for the others.
    """
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    column = {n: table[n].to_numpy() for n in table.column_names}
    inside = column["offset"] < 0
    at = np.flatnonzero(~inside)
    key = mixed(column["first"][at].view(np.uint64)) ^ column["second"][at].view(np.uint64)
    _, of = np.unique(key, return_inverse=True)
    total = np.bincount(of, weights=column["weight"][at]) if len(at) else np.zeros(0)
    crossing = at[(total[of] > 1) & (column["weight"][at] == 1)]
    rows = np.concatenate([np.flatnonzero(inside), crossing])
    offset = column["offset"][rows]
    for name in ("most", "least"):
        column[name] = np.where(offset < 0, column[name][rows], offset)
    yield pa.RecordBatch.from_arrays([
        pa.array(column["g"][rows], pa.int32()), pa.array(column["place"][rows], pa.int64()),
        pa.array(column["most"], pa.int32()), pa.array(column["least"], pa.int32()),
    ], names=["g", "at", "most", "least"])


def byte_remover(length: int):
    """`(doc_id, n_bytes, n_removed, n_spans, kept)` of a group, given what is known of its anchors."""
    reach = length - KEY

    def remove(group: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = {
            "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(),
            "n_spans": pa.int64(), "kept": pa.binary(),
        }
        if not len(group):
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        group = in_order(group)
        data, begins = buffer_of(group["text"])
        place, fate = _fates(answers)
        place = place[(fate == REPEATED) | (fate == PARTNER)]
        text = np.searchsorted(begins, place, "right") - 1
        low = [np.maximum(begins[text], place - reach)]
        high = [np.minimum(begins[text + 1], place + length)]
        for at, most, least in zip(answers["at"], answers["most"], answers["least"]):
            if at.as_py() is not None:
                low.append(np.array([at.as_py() - most.as_py()]))
                high.append(np.array([at.as_py() - least.as_py() + length]))
        change = np.zeros(len(data) + 1, dtype=np.int32)
        np.add.at(change, np.concatenate(low), 1)
        np.add.at(change, np.concatenate(high), -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        rows = []
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
            cut = gone[a:b]
            spans = int(np.count_nonzero(cut[1:] & ~cut[:-1])) + int(b > a and cut[0])
            rows.append((b - a, int(cut.sum()), spans, data[a:b][~cut].tobytes()))
        columns = [group["doc_id"].combine_chunks()] + [
            pa.array([r[i] for r in rows], t) for i, t in enumerate(list(kinds.values())[1:])
        ]
        return pa.table(dict(zip(kinds, columns)))

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, n_spans, kept)` for each row of `docs (doc_id, text, …)`.

    Every byte of a text's UTF-8 that is covered by a string of `length` bytes which also starts anywhere else
    is removed; `kept` holds the other bytes, `n_spans` counts the removed runs. Matches end with the text.
    Null counts as empty; texts shorter than `length` stay whole; equal rows repeat each other; an empty table
    gives no rows; other columns are ignored.
    """
    size = total_bytes(docs)
    bucket_bits = max(1, int(np.log2(size / 64 / BUCKET_ANCHORS + 1)) + 1)
    groups = grouped(docs, GROUP_BYTES, size)
    dealt = groups.groupBy("g").applyInArrow(
        anchor_dealer(length, bucket_bits), "bucket int, g int, run binary, around binary, place binary"
    )
    fates = dealt.groupBy("bucket").applyInArrow(sift, "g int, place binary, fate binary")
    suffixes = groups.groupBy("g").cogroup(fates.groupBy("g")).applyInArrow(
        suffix_reader(length), "g int, place long, partner boolean, left binary, suffix binary"
    )
    n = partitions(docs.sparkSession)
    # Spark samples the suffixes for splitters.
    compared = suffixes.repartitionByRange(
        n, F.substring("suffix", 1, KEY), F.substring("left", -CROSS, CROSS)
    ).mapInArrow(
        comparer(length),
        "g int, place long, most int, least int, offset int, first long, second long, weight long",
    )
    answers = compared.repartition(n, "first", "second").mapInArrow(
        settle, "g int, at long, most int, least int"
    )
    known = answers.select(
        "g", F.lit(None).cast("binary").alias("place"), F.lit(None).cast("binary").alias("fate"),
        "at", "most", "least",
    )
    settled = fates.select(
        "g", "place", "fate", F.lit(None).cast("long").alias("at"),
        F.lit(None).cast("int").alias("most"), F.lit(None).cast("int").alias("least"),
    )
    return groups.groupBy("g").cogroup(settled.union(known).groupBy("g")).applyInArrow(
        byte_remover(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
