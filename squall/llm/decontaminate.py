"""Benchmark decontamination with a generalised suffix automaton of the test items.

Training tokens stream through the automaton, which knows at every token the longest run that ends
there and stands in some item. Runs as long as a window, and whole items shorter than a window, are hits.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.storage import materialise

WINDOW = 10
MAX_AUTOMATON_WORDS = 200_000  # of the items in one automaton; more items make more automata

# Lower-case A-Z, and a blank for every ASCII byte that is neither letter nor digit.
_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("begins", T.ArrayType(T.IntegerType())),  # of hit runs, in words
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def normalised(text: bytes) -> bytes:
    """The text with its words alone, byte for byte at the same places."""
    return text.translate(_KEPT)


class Automaton:
    """Suffix automaton of many word sequences; words are known by small numbers."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.shortest = window
        self.whole: dict[int, set[tuple[int, str | None]]] = {}  # short items that end in a state
        held: dict[int, set[str | None]] = {}
        read: list[tuple[str | None, list[int]]] = []
        for item, words in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if numbers:
                read.append((item, numbers))
                self._insert(numbers)
        for item, numbers in read:
            state = 0
            for number in numbers:
                state = self.step[state][number]
                up = state
                while up > 0 and self.length[up] >= window and item not in held.get(up, ()):
                    held.setdefault(up, set()).add(item)
                    up = self.link[up]
            if len(numbers) < window:
                self.shortest = min(self.shortest, len(numbers))
                self.whole.setdefault(state, set()).add((len(numbers), item))
        self.held = held

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, before: int, number: int) -> int:
        """The state of the run that ends `before` one step on, parted from longer runs if need be."""
        old = self.step[before][number]
        if self.length[old] == self.length[before] + 1:
            return old
        part = self._new(self.length[before] + 1, dict(self.step[old]), self.link[old])
        self.link[old] = part
        while before >= 0 and self.step[before].get(number) == old:
            self.step[before][number] = part
            before = self.link[before]
        return part

    def _insert(self, numbers: list[int]) -> None:
        last = 0
        for number in numbers:
            if number in self.step[last]:
                last = self._split(last, number)
                continue
            new = self._new(self.length[last] + 1, {}, 0)
            at = last
            while at >= 0 and number not in self.step[at]:
                self.step[at][number] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, number)
            last = new

    def stream(self, numbers: list[int], offset: int, runs: list, items: set) -> None:
        """Follow `numbers`, which begin at word `offset`, and note hit runs and items."""
        state, matched = 0, 0
        for place, number in enumerate(numbers, start=offset + 1):
            while state and number not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if number not in self.step[state]:
                matched = 0
                continue
            state = self.step[state][number]
            matched += 1
            longest = 0
            if matched >= self.window:
                longest = self.window
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                items |= self.held[at]
            if self.whole:
                at = state
                while at > 0:
                    for size, item in self.whole.get(at, ()):
                        if size <= matched:
                            items.add(item)
                            longest = max(longest, size)
                    at = self.link[at]
            if longest:
                if runs and runs[-1][1] >= place - longest:
                    # A short item may begin before the run noted last.
                    begin = place - longest
                    while len(runs) > 1 and runs[-2][1] >= begin:
                        runs.pop(-2)
                    runs[-1] = (min(runs[-1][0], begin), place)
                else:
                    runs.append((place - longest, place))

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str | None]]:
        """Number of words, hit runs `[begin, end)` in order, and the items they come from."""
        words = normalised(text).split()
        runs: list[tuple[int, int]] = []
        items: set[str | None] = set()
        if len(words) >= self.shortest and self.vocabulary:
            known = self.vocabulary
            numbers = [known.get(w, -1) for w in words]
            # A hit lies within a stretch of known words at least as long as the shortest window.
            edges = np.flatnonzero(np.diff(np.array(numbers, dtype=np.int32) >= 0, prepend=0, append=0))
            for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - begin >= self.shortest:
                    self.stream(numbers[begin:end], begin, runs, items)
        return len(words), runs, items


def automata(benchmark: DataFrame, window: int, max_words: int) -> Iterator[Automaton]:
    """Automata over all items, each over a bounded number of words; the driver holds one at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = normalised((row[1] or "").encode()).split()
        if held and size + len(words) > max_words:
            yield Automaton(held, window)
            held, size = [], 0
        held.append((row[0], words))
        size += len(words)
    yield Automaton(held, window)


def in_order(items: set[str | None]) -> list[str | None]:
    """Ids as strings, null last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def finder(automaton: Automaton):
    """Column function: what the automaton finds in a binary text."""

    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            n_words, runs, items = automaton.find(text.as_py() or b"")
            rows.append({
                "n_words": n_words,
                "begins": [r[0] for r in runs],
                "ends": [r[1] for r in runs],
                "items": in_order(items),
            })
        return pa.array(rows, type=pa.struct([
            ("n_words", pa.int64()), ("begins", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
        ]))

    return find


def hit_words(found: Column) -> Column:
    """Number of words inside the runs."""
    return F.aggregate(
        F.zip_with(found["begins"], found["ends"], lambda b, e: (e - b).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )


def merged(found: list[Column]) -> Column:
    """What several automata found, as one: runs united, items together."""

    @F.arrow_udf(FOUND)
    def unite(*parts: pa.Array) -> pa.Array:
        rows = []
        for finds in zip(*[p.to_pylist() for p in parts]):
            runs: list[list[int]] = []
            for begin, end in sorted(r for f in finds for r in zip(f["begins"], f["ends"])):
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([begin, end])
            rows.append({
                "n_words": finds[0]["n_words"],
                "begins": [r[0] for r in runs],
                "ends": [r[1] for r in runs],
                "items": in_order({i for f in finds for i in f["items"]}),
            })
        return pa.array(rows, type=parts[0].type)

    return found[0] if len(found) == 1 else unite(*found)


def screen(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    max_words: int = MAX_AUTOMATON_WORDS,
) -> DataFrame:
    """`(row, found)`: every row of `docs` as a struct, with what the benchmark shares with its text.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one
    window. Null and empty texts have no words and no hit; an empty benchmark hits nothing; items
    without an id hit and are listed as one null; equal ids count once. More than `max_words` words of items
    take several automata, one after the other, with the rows written in between, so that no worker
    holds more than one.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    out = docs.select(F.struct("*").alias("row"), text.alias("text"))
    names = []
    for k, automaton in enumerate(automata(benchmark, window, max_words)):
        if names:
            out = materialise(out, "screened")
        names.append(f"found{k}")
        out = out.withColumn(names[-1], finder(automaton)("text"))
    return out.select("row", merged([F.col(n) for n in names]).alias("found"))


def without(text: Column, found: Column) -> Column:
    """The text without its hit runs, from the first byte of a run's first word to its last word's end."""

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array, founds: pa.Array) -> pa.Array:
        out = []
        for text, find in zip(texts.to_pylist(), founds.to_pylist()):
            if text is None or not find["begins"]:
                out.append(text)
                continue
            data = text.encode()
            blank = np.frombuffer(normalised(data), dtype=np.uint8) == 32
            edges = np.flatnonzero(np.diff(~blank, prepend=False, append=False))
            at, kept = 0, []
            for begin, end in zip(find["begins"], find["ends"]):
                kept.append(data[at : edges[2 * begin]])
                at = edges[2 * end - 1]
            out.append(b"".join([*kept, data[at:]]).decode())
        return pa.array(out, type=pa.string())

    return cut(text, found)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, window: int = WINDOW
) -> DataFrame:
    """`docs` without benchmark passages: hit runs leave the text, and rows of which more than
    `max_coverage` of the words are hit go whole. `n_chars`, if there, follows the text."""
    found = screen(docs, benchmark, window)
    kept = found.filter(hit_words(F.col("found")) <= max_coverage * F.col("found.n_words"))
    fields = [f.name for f in docs.schema]
    kept = kept.withColumn("text", F.when(
        F.size("found.begins") > 0, without(F.col("row.text"), F.col("found"))
    ).otherwise(F.col("row.text")))
    return kept.select(*[
        F.col("text") if f == "text"
        else F.when(F.size("found.begins") > 0, F.length("text").cast(docs.schema[f].dataType))
        .otherwise(F.col("row")[f]).alias(f) if f == "n_chars"
        else F.col("row")[f].alias(f)
        for f in fields
    ])
