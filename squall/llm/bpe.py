"""Byte-level BPE: encoding by ranks and decoding, with a segment tree over byte positions.

A text is cut into pieces by a pattern, and every piece is encoded for itself. A leaf of the tree stands for a
byte position: while a token begins there, the leaf holds the rank of that token joined with the next one.
Inner nodes hold the least rank below them, the leftmost of equals, so the root names the next merge. A merge
changes the leaves of the two tokens joined and of the token before: point updates of logarithmic cost, so
a piece of n bytes takes n log n steps however long it is.
"""

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_PIECES = 1 << 19  # in a task's table of pieces met before
KEPT_CHARS = 64  # longer pieces are not kept there
UNRANKED = 1 << 32  # above every rank


def vocabulary_path() -> str:
    """The public byte-level vocabulary of 50,256 ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def piece_pattern() -> str:
    """The pattern that goes with the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of tokens from a file of `base64 rank` lines."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    lacking = [b for b in range(256) if bytes([b]) not in ranks]
    if lacking:
        raise ValueError(f"{path}: no rank for the single bytes {lacking[:5]}")
    return ranks


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the tokens of a piece after all merges, least rank first, the leftmost of equals.

    A node of the tree holds `rank * leaves + position`, so that the lesser number is the lesser rank and,
    among equal ranks, the position further left.
    """
    count, rank_of = len(piece), ranks.get
    leaves = 1 << max(0, count - 2).bit_length()
    place, none = leaves - 1, UNRANKED * leaves
    tree = [none] * (2 * leaves)
    for at in range(count - 1):
        rank = rank_of(piece[at : at + 2])
        if rank is not None:
            tree[leaves + at] = rank * leaves + at
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    ends = list(range(1, count + 1))  # where the token that begins here ends
    before = list(range(-1, count))  # where the token before it begins
    while tree[1] < none:
        at = tree[1] & place
        joined = ends[at]
        end = ends[at] = ends[joined]
        before[end] = at
        changes = []
        if joined < count - 1:  # no token begins there any more
            changes.append((joined, none))
        if end < count:
            rank = rank_of(piece[at : ends[end]])
            changes.append((at, none if rank is None else rank * leaves + at))
        else:
            changes.append((at, none))
        if at:
            first = before[at]
            rank = rank_of(piece[first:end])
            changes.append((first, none if rank is None else rank * leaves + first))
        for leaf, value in changes:
            node = leaves + leaf
            if tree[node] == value:
                continue
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value
    out, at = [], 0
    while at < count:
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return out


class Pieces(dict):
    """Packed ids of pieces; short pieces met before are kept, as many as a bound allows."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else merged(data, self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pieces = Pieces(ranks)
        self.cut = regex.compile(re.sub(r"^\(\?u\)", "", pattern)).findall

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.cut(text))), dtype="<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _shared_ranks(spark: SparkSession, vocabulary: str | None):
    """The ranks as a broadcast variable: its size is that of the vocabulary file, whatever the corpus."""
    return spark.sparkContext.broadcast(read_ranks(vocabulary or vocabulary_path()))


def encoder(spark: SparkSession, vocabulary: str | None = None, pattern: str | None = None):
    """Column function: the ids of a text, as `array<int>`.

    Every match of `pattern` is encoded for itself, without special tokens: their strings are ordinary text.
    Null and empty texts have no ids. The whole text is read; equal texts get equal ids, and nothing but the
    text counts, so nulls, repeats or clashing names in other columns do not matter. Letters and digits are those of
    the `regex` library's Unicode version.
    """
    shared, cut = _shared_ranks(spark, vocabulary), pattern or piece_pattern()

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec(shared.value, cut)
        for texts in batches:
            found = [codec.encode(t.as_py() or "") for t in texts]
            begins = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([len(f) for f in found], out=begins[1:])
            ids = np.concatenate(found) if found else np.zeros(0, dtype="<u4")
            yield pa.ListArray.from_arrays(pa.array(begins), pa.array(ids.astype(np.int32)))

    return encode


def decoder(spark: SparkSession, vocabulary: str | None = None):
    """Column function: the bytes that ids stand for. Null ids stay null; an id without a token is an error."""
    shared = _shared_ranks(spark, vocabulary)

    @F.arrow_udf(T.BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = {rank: token for token, rank in shared.value.items()}
        for lists in batches:
            ids = (numbers.values.to_numpy().tolist() if numbers.is_valid else None for numbers in lists)
            out = [None if some is None else b"".join(map(tokens.__getitem__, some)) for some in ids]
            yield pa.array(out, type=pa.binary())

    return decode


@F.arrow_udf(T.BinaryType())
def packed(lists: pa.Array) -> pa.Array:
    """Ids as little-endian unsigned numbers of 32 bits, end to end."""
    out = [ids.values.to_numpy().astype("<u4").tobytes() if ids.is_valid else None for ids in lists]
    return pa.array(out, type=pa.binary())


def digests(ids: Column, decode) -> list[Column]:
    """Number of ids and the digests of the ids and of what they stand for."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(packed(ids), 256).alias("ids_sha256"),
        F.sha2(decode(ids), 256).alias("decoded_sha256"),
    ]
