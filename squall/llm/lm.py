"""Language-model scoring: a causal self-attention model over subword ids, in numpy.

Words are cut into ids of a public vocabulary. The next id either begins a word (or is the end) or goes on with
the present one. One head of masked self-attention reads the context and adds to the logits of classes, whose
start is the log shares of the classes after the last id; counts over all training ids tell the id within its
class. What is seen often needs no model: the frequent words, as a tree of their ids, say how often a word goes on
with an id or ends after the ids read so far. Both opinions are mixed; the share of either, by how often the ids
read so far were seen, is learned with the weights, each training word being left out of its own counts.

Training parts hold about PART_WORDS words each whatever the files, and Spark averages their weights by the blocks
behind them.

A text is cut into overlapping context windows of 2 * STRIDE ids, STRIDE apart; each id is scored once, in
the window in which it lies in the later half.
"""

import base64
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import in_fold
from squall.storage import materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r" ?[^\x20\x09-\x0D]+"  # a word with its blank
STRIDE = 16
WIDTH = 16  # of the model
STARTS = 64  # classes of ids that begin a word, the first ones
CLASSES = 128
OWN_ROWS = 1024  # ids with a row of their own, by count; the others share their class's
ROWS = OWN_ROWS + CLASSES
TRUST = 5.0  # pseudo-counts of the shares without regard to the last id
SEEN = 20  # levels of how often the ids of a word so far were seen: 0 never, then by powers of two
DEEPEST = 32  # ids of a frequent word that are kept; what follows more than these is the attention's alone
BEGIN = SEEN  # the level of a text's first id, which begins a word for sure
ROUNDS = 1
PART_WORDS = 1_000_000  # of training texts in a part
SHUFFLED = 8192  # blocks in random order at once; a task trains on all it has
STEP_BLOCKS = 128
SLOWER = 256  # steps; well beyond them the rate falls as one over their root
FREQUENT = 1 << 16  # words whose counts are sent to every task; the others are joined
KEPT_WORDS = 200_000  # in a task's tables of words
WORDS_AT_ONCE = 1 << 15  # looked up together, so that the new ones are cut in one call
SCORED_AT_ONCE = 128  # blocks, so that their logits stay in a core's cache
LARGE = 60.0  # logits beyond are shifted before they are raised

FOLDS, HELD_OUT = 7, 2


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file; read by the driver, sent to the tasks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Remembered(dict):
    """Values of words, found by `find(words)` many at once and kept as long as they are few."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def of(self, words: list[bytes]) -> list:
        out = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            values = list(map(self.get, part))
            new = {word for word, value in zip(part, values) if value is None}
            if new:
                if len(self) + len(new) > KEPT_WORDS:
                    self.clear()
                    new = set(part)
                new = list(new)
                self.update(zip(new, self.find(new)))
                values = map(self.__getitem__, part)
            out += values
        return out


class Subwords:
    """Ids of words, each with what the frequent words say of the id after it.

    `frequent` are counts of words. With `leave_one_out` a word's own occurrence does not count.
    """

    def __init__(self, ranks: dict[bytes, int], frequent: dict[bytes, int] | None = None, leave_one_out=False):
        import tiktoken

        self.encode = tiktoken.Encoding(
            "subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.end = len(ranks)
        self.begins = begin_words(ranks)
        self.frequent, self.less = frequent or {}, int(leave_one_out)
        self.plant()
        self.packed = Remembered(self.pack)
        self.first = np.array([0, _bits(1.0), BEGIN], dtype=np.int32).tobytes()[4:]
        self.last = np.array([self.end], dtype=np.int32).tobytes()

    def of(self, word: bytes) -> tuple[int, ...]:
        return tuple(self.encode(" " + word.decode()))

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and where each word begins (plus the end)."""
        ids = np.array(self.encode(" " + b" ".join(words).decode()) if words else [], dtype=np.int64)
        return ids, np.append(np.flatnonzero(self.begins[ids]), len(ids))

    def plant(self) -> None:
        """The tree of the frequent words' ids. `edges` are sorted, the k-th leads to node k + 1; `through` counts the
        words that pass a node. Node 0 is the root, and where no edge leads: nothing passes it."""
        ids, begins = self.cut(list(self.frequent))
        n = np.fromiter(self.frequent.values(), dtype=np.int64, count=len(self.frequent))
        length, node = np.diff(begins), np.zeros(len(n), dtype=np.int64)
        edges, through, nodes = [np.zeros(0, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], 1
        on = np.arange(len(n))
        for k in range(DEEPEST):
            on = on[length[on] > k]
            found, which = np.unique(node[on] * (self.end + 1) + ids[begins[on] + k], return_inverse=True)
            passing = np.zeros(len(found), dtype=np.int64)
            np.add.at(passing, which, n[on])
            node[on] = nodes + which
            nodes += len(found)
            edges.append(found)
            through.append(passing)
        self.edges, self.through = np.concatenate(edges), np.concatenate(through)

    def child(self, node: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.zeros(len(node), dtype=np.int64)
        edge = node * (self.end + 1) + ids
        at = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
        return np.where(self.edges[at] == edge, at + 1, 0)

    def pack(self, words: list[bytes]) -> list[bytes]:
        """For each id of each word: the id, the share of what follows it, and the level of that share."""
        ids, begins = self.cut(words)
        own = np.array([self.frequent.get(word, 0) for word in words], dtype=np.int64)
        less, length = np.minimum(self.less, own), np.diff(begins)
        out = np.zeros((len(ids), 3), dtype=np.int32)
        out[:, 0] = ids
        shares = out.view(np.float32)
        on = np.arange(len(words))
        node = self.child(np.zeros(len(words), dtype=np.int64), ids[begins[:-1]])
        for k in range(1, DEEPEST):
            before = self.through[node] - less[on]
            seen = before > 0
            on, node, before = on[seen], node[seen], before[seen]
            if not len(on):
                break
            at, inner = begins[on] + k - 1, length[on] > k
            after = own[on]
            node = self.child(node[inner], ids[at[inner] + 1])
            after[inner] = self.through[node]
            shares[at, 1] = (after - less[on]) / before
            out[at, 2] = np.minimum(np.frexp(before)[1], SEEN - 1)  # its bits
            on = on[inner]
        data, places = out.tobytes(), (begins * out[:1].nbytes).tolist()
        return [data[a:b] for a, b in zip(places, places[1:])]

    def text(self, words: list[bytes]) -> np.ndarray:
        """Rows `(share, level, id)` of a text, the end included: `share` is of the id itself, or of any
        beginning if it begins a word."""
        return self.texts([words])[0]

    def texts(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The rows of each text, the words of all looked up together."""
        packed, out, at = self.packed.of(list(chain.from_iterable(texts))), [], 0
        for words in texts:
            data = b"".join([self.first, *packed[at : at + len(words)], self.last])
            out.append(np.frombuffer(data, dtype=np.int32).reshape(-1, 3))
            at += len(words)
        return out


def _bits(share: float) -> int:
    """The bits of a float32, as an int32."""
    return int(np.float32(share).view(np.int32))


def tokens(text: bytes | None) -> list[bytes]:
    """Words, lower-cased in A-Z; the end is left to the caller."""
    return (text or b"").lower().split()


def in_groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of each text, in lists of texts that hold about WORDS_AT_ONCE together."""
    held, n = [], 0
    for text in texts:
        held.append(tokens(text.as_py()))
        n += len(held[-1])
        if n >= WORDS_AT_ONCE:
            yield held
            held, n = [], 0
    if held:
        yield held


@dataclass(frozen=True)
class Classes:
    """Class and row of each id, its log share of the row, and each row's class and share of the class."""

    of: np.ndarray
    row: np.ndarray
    log_share: np.ndarray
    class_of_row: np.ndarray
    row_share: np.ndarray
    class_share: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, begins: np.ndarray) -> "Classes":
        """The most frequent ids that begin words, and that do not, have classes of their own; the others share
        classes of like frequency."""
        weight = counts + 1.0
        order = np.argsort(-weight, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        of = np.empty(len(order), dtype=np.int64)
        for kind, first, n in ((begins, 0, STARTS), (~begins, STARTS, CLASSES - STARTS)):
            ids = order[kind[order]]
            own = n * 3 // 4
            of[ids[:own]] = first + np.arange(min(own, len(ids)))
            mass = np.cumsum(weight[ids[own:]])
            if len(mass):
                shared = np.minimum(mass * (n - own) // mass[-1], n - own - 1).astype(np.int64)
                of[ids[own:]] = first + own + shared
        row = np.where(rank < OWN_ROWS, rank, OWN_ROWS + of)
        in_row = np.bincount(row, weights=weight, minlength=ROWS)
        class_of_row = np.zeros(ROWS, dtype=np.int64)
        class_of_row[row] = of
        in_class = np.bincount(of, weights=weight, minlength=CLASSES)
        return Classes(
            of, row, np.log(weight / in_row[row]).astype(np.float32), class_of_row,
            in_row / np.maximum(in_class[class_of_row], 1), (in_class + 1) / (in_class + 1).sum(),
        )


def begin_words(ranks: dict[bytes, int]) -> np.ndarray:
    """Which ids begin a word: those that begin with a blank, and the end."""
    out = np.ones(len(ranks) + 1, dtype=bool)
    for token, i in ranks.items():
        out[i] = token.startswith(b" ")
    return out


@dataclass(frozen=True)
class Pairs:
    """Log share of each class after a row, and of each row within its class after a row."""

    classes: np.ndarray
    rows: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, classes: Classes) -> "Pairs":
        """From `counts`, ROWS x ROWS: how often a row follows another in the training ids."""
        by_class = np.zeros((ROWS, CLASSES))
        for row in range(ROWS):
            by_class[:, classes.class_of_row[row]] += counts[:, row]
        of_class = (by_class + TRUST * classes.class_share) / (
            by_class.sum(axis=1, keepdims=True) + TRUST
        )
        within = (counts + TRUST * classes.row_share) / (by_class[:, classes.class_of_row] + TRUST)
        return Pairs(
            np.log(of_class).astype(np.float32), np.log(np.maximum(within, 1e-12)).astype(np.float32)
        )


@dataclass(frozen=True)
class Blocks:
    """Windows of inputs, and their targets with what the frequent words say of them; -1 is no id.

    A row of targets holds STRIDE ids, and its inputs the STRIDE ids before those of the targets as well.
    """

    inputs: np.ndarray
    targets: np.ndarray
    shares: np.ndarray
    levels: np.ndarray
    owner: np.ndarray  # number of the text

    def __len__(self) -> int:
        return len(self.inputs)

    def part(self, rows) -> "Blocks":
        return Blocks(*(v[rows] for v in self.__dict__.values()))

    def and_then(self, more: "Blocks") -> "Blocks":
        return Blocks(*(np.concatenate(p) for p in zip(self.__dict__.values(), more.__dict__.values())))


def blocks(texts: list[np.ndarray], end: int) -> Blocks:
    """Blocks of texts as `Subwords.text` gives them; inputs begin with an end."""
    held = []
    for k, rows in enumerate(texts):
        n = -(-len(rows) // STRIDE)
        padded = np.full((n * STRIDE, 3), -1, dtype=np.int32)
        padded[: len(rows)] = rows
        padded[len(rows) :, :2] = 0
        read = np.full((n + 1) * STRIDE, -1, dtype=np.int32)
        read[STRIDE] = end
        read[STRIDE + 1 : STRIDE + len(rows)] = rows[:-1, 2]
        read = read.reshape(-1, STRIDE)
        held.append((np.hstack([read[:-1], read[1:]]), padded, np.full(n, k)))
    padded = np.vstack([h[1] for h in held])
    share, level, target = (np.ascontiguousarray(padded[:, c]).reshape(-1, STRIDE) for c in range(3))
    return Blocks(
        np.vstack([h[0] for h in held]), target, share.view(np.float32), level,
        np.concatenate([h[2] for h in held]),
    )


SHAPES = {
    "embed": (ROWS, WIDTH), "place": (2 * STRIDE, WIDTH), "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "mix": (WIDTH, WIDTH), "out": (WIDTH, CLASSES),
    "counted": (SEEN + 1,),
}
ALLOWED = np.arange(2 * STRIDE)[None, :] <= STRIDE + np.arange(STRIDE)[:, None]
MASK = np.where(ALLOWED, 0, -1e9).astype(np.float32)
ALLOWED = ALLOWED.astype(np.float32)
SCALE = np.float32(1 / math.sqrt(WIDTH))
PLACES = np.arange(ROWS * WIDTH).reshape(ROWS, WIDTH)  # of weights in "embed"
TRAINED = [k for k in SHAPES if k != "counted"]  # by steps


def row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], dtype=np.float32)


def start(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    scale = {"embed": 0.1, "place": 0.02, "out": 0.02}
    out = {k: (r.standard_normal(s) * scale.get(k, 0.25)).astype(np.float32) for k, s in SHAPES.items()}
    out["counted"] = np.full(SEEN + 1, 0.5, dtype=np.float32)  # share of the frequent words' opinion, by level
    out["counted"][0] = 0
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        out[k] = values[at : at + math.prod(shape)].reshape(shape).astype(np.float32)
        at += math.prod(shape)
    return out


class Attention:
    """One head of causal self-attention with a residual, over classes."""

    def __init__(self, weights: dict[str, np.ndarray], classes: Classes, pairs: Pairs):
        self.w, self.classes, self.pairs = weights, classes, pairs
        self.share = np.exp(pairs.classes)
        self.counted = pairs.rows + pairs.classes[:, classes.class_of_row]  # log share of a row after a row

    def projections(self) -> np.ndarray:
        """Keys, values and scaled queries of an input side by side."""
        return np.hstack([self.w["key"], self.w["value"], self.w["query"] * SCALE])

    def forward(self, inputs: np.ndarray, projections: np.ndarray) -> dict[str, np.ndarray]:
        """All values on the way; `added` is what the model adds to the class logits after a row."""
        w = self.w
        row = self.classes.row[inputs]
        x = np.take(w["embed"], row, axis=0)
        x += w["place"]
        projected = (x.reshape(-1, WIDTH) @ projections).reshape(*row.shape, -1)
        k, v = projected[:, :, :WIDTH], projected[:, :, WIDTH : 2 * WIDTH]
        q = projected[:, STRIDE:, 2 * WIDTH :]
        s = q @ k.transpose(0, 2, 1)
        there = inputs >= 0
        partly = np.flatnonzero(~there.all(axis=1))
        if max(s.max(), -s.min()) > LARGE:
            s += MASK
            s[partly] += np.where(there[partly], 0, -1e9).astype(np.float32)[:, None, :]
            s -= s.max(axis=2, keepdims=True)
        a = np.exp(s, out=s)
        a *= ALLOWED
        a[partly] *= there[partly][:, None, :]
        a *= (1 / row_sums(a.reshape(-1, 2 * STRIDE))).reshape(*a.shape[:2], 1)
        read = (a @ v).reshape(-1, WIDTH)
        h = read @ w["mix"]
        h += x[:, STRIDE:].reshape(-1, WIDTH)
        last = row[:, STRIDE:].ravel()
        added = h @ w["out"]
        if max(added.max(), -added.min()) > LARGE:
            added -= added.max(axis=1, keepdims=True)
        return {
            "row": row, "x": x, "q": q, "k": k, "v": v, "a": a, "read": read, "h": h, "last": last, "added": added,
        }

    def masses(self, f: dict[str, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """Mass of each class (in place of `added`), the log of the target's, and those of all beginnings and of all
        ids."""
        added, last, classes = f["added"], f["last"], self.classes
        chosen = added[np.arange(len(wanted)), classes.of[wanted]]
        chosen += self.counted[last, classes.row[wanted]]
        chosen += classes.log_share[wanted]
        mass = np.exp(added, out=added)
        mass *= np.take(self.share, last, axis=0)
        starts = row_sums(mass[:, :STARTS])
        return mass, chosen, starts, starts + row_sums(mass[:, STARTS:])

    def log_p(self, b: Blocks) -> np.ndarray:
        """Natural log probability of each target; 0 where there is none."""
        out, projections = np.zeros(b.targets.shape), self.projections()
        for at in range(0, len(b), SCORED_AT_ONCE):
            part = b.part(slice(at, at + SCORED_AT_ONCE))
            wanted = part.targets.ravel()
            _, chosen, starts, total = self.masses(self.forward(part.inputs, projections), wanted)
            begins, mine, both = self.mixed(part, chosen, starts, total)
            got = np.where(begins, chosen - np.log(starts), 0) + np.log(both)
            out[at : at + SCORED_AT_ONCE] = np.where(wanted >= 0, got, 0).reshape(part.targets.shape)
        return out

    def mixed(self, b: Blocks, chosen, starts, total) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which targets begin a word, and the attention's part of the mixed opinion and the whole of it.

        `chosen` is the log of the attention's mass of the target; `starts` and `total` are its masses of all
        beginnings and of all ids. The two opinions are mixed on whether a word begins; which one, the attention
        tells.
        """
        begins = self.classes.of[b.targets.ravel()] < STARTS
        counted = self.w["counted"][b.levels.ravel()]
        mine = (1 - counted) * (np.where(begins, starts, np.exp(chosen)) / total)
        return begins, mine, np.maximum(mine + counted * b.shares.ravel(), 1e-30)

    def gradient(self, b: Blocks) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean loss, and for each target how much the attention answers for it."""
        w, inputs, wanted, projections = self.w, b.inputs, b.targets.ravel(), self.projections()
        f = self.forward(inputs, projections)
        p, chosen, starts, total = self.masses(f, wanted)
        begins, mine, both = self.mixed(b, chosen, starts, total)
        mine /= both
        # The gradient of the logits is `p` with its beginnings times `lead` and the others times `rest`.
        rest = mine / total
        lead = rest + np.where(begins, (1 - mine) / starts, 0)
        p[np.arange(len(wanted)), self.classes.of[wanted]] -= np.where(begins, 1 / lead, total)
        there = wanted >= 0
        there = there / np.float32(max(1, there.sum()))
        g, dh = {"out": np.empty_like(w["out"])}, 0
        for part, times in ((slice(0, STARTS), lead), (slice(STARTS, CLASSES), rest)):
            times = (times * there)[:, None]
            g["out"][:, part] = (p[:, part].T @ (f["h"] * times)).T
            dh += (p[:, part] @ w["out"][:, part].T) * times
        g["mix"] = f["read"].T @ dh
        dread = dh @ w["mix"].T
        along = np.einsum("ij,ij->i", dread, f["read"]).reshape(-1, STRIDE, 1)
        dread = dread.reshape(-1, STRIDE, WIDTH)
        ds = dread @ f["v"].transpose(0, 2, 1)
        ds -= along
        ds *= f["a"]
        d = np.zeros((len(b), 2 * STRIDE, 3 * WIDTH), dtype=np.float32)
        np.matmul(ds.transpose(0, 2, 1), f["q"], out=d[:, :, :WIDTH])
        np.matmul(f["a"].transpose(0, 2, 1), dread, out=d[:, :, WIDTH : 2 * WIDTH])
        np.matmul(ds, f["k"], out=d[:, STRIDE:, 2 * WIDTH :])
        d = d.reshape(-1, 3 * WIDTH)
        projected = (d.T @ f["x"].reshape(-1, WIDTH)).T
        g["key"], g["value"] = projected[:, :WIDTH], projected[:, WIDTH : 2 * WIDTH]
        g["query"] = projected[:, 2 * WIDTH :] * SCALE
        dx = (d @ projections.T).reshape(-1, 2 * STRIDE, WIDTH)
        dx[:, STRIDE:] += dh.reshape(-1, STRIDE, WIDTH)
        dx[inputs < 0] = 0
        g["place"] = dx.sum(axis=0)
        place = np.take(PLACES, f["row"], axis=0)
        g["embed"] = np.bincount(place.ravel(), dx.ravel(), ROWS * WIDTH).reshape(ROWS, WIDTH).astype(np.float32)
        return g, mine


class Learner:
    """Adam steps on a model's weights over a stream of blocks; `seen` of them so far."""

    def __init__(self, model: Attention, seed: int, rate: float = 0.01):
        self.model, self.rate, self.random = model, rate, np.random.default_rng(seed)
        self.weights = np.concatenate([model.w[k].ravel() for k in TRAINED])
        parts = np.split(self.weights, np.cumsum([model.w[k].size for k in TRAINED])[:-1])
        model.w.update({k: part.reshape(SHAPES[k]) for k, part in zip(TRAINED, parts)})
        self.first, self.second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.steps = self.seen = 0
        self.counted, self.levels = np.zeros(SEEN + 1), np.zeros(SEEN + 1)
        self.rest: Blocks | None = None

    def learn(self, new: Blocks) -> None:
        """Whole steps over the blocks in random order; what is left over waits for the next ones."""
        if self.rest is not None:
            new = self.rest.and_then(new)
        order = self.random.permutation(len(new))
        whole = len(order) - len(order) % STEP_BLOCKS
        for at in range(0, whole, STEP_BLOCKS):
            self.step(new.part(order[at : at + STEP_BLOCKS]))
        self.rest = new.part(order[whole:])

    def finish(self) -> None:
        """A last step over what is left."""
        if self.rest is not None and len(self.rest):
            self.step(self.rest)
        self.rest = None

    def step(self, b: Blocks) -> None:
        first, second, w = self.first, self.second, self.model.w
        rate = self.rate / math.sqrt(1 + self.steps / SLOWER)
        self.steps += 1
        self.seen += len(b)
        gradient, mine = self.model.gradient(b)
        g = np.concatenate([gradient[k].ravel() for k in TRAINED])
        first *= 0.9
        first += 0.1 * g
        g *= g
        second *= 0.99
        second += 0.01 * g
        np.sqrt(second / (1 - 0.99**self.steps), out=g)
        g += 1e-8
        np.divide(first, g, out=g)
        g *= rate / (1 - 0.9**self.steps)
        self.weights -= g
        # The shares of the two opinions by expectation-maximisation; old steps fade.
        there = b.targets.ravel() >= 0
        levels = b.levels.ravel()[there]
        self.counted = 0.98 * self.counted + np.bincount(levels, 1 - mine[there], SEEN + 1)
        self.levels = 0.98 * self.levels + np.bincount(levels, minlength=SEEN + 1)
        w["counted"] = ((self.counted + 1) / (self.levels + 2)).astype(np.float32)
        w["counted"][0] = 0


def _rows(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`(word, n)` of a task's texts, in parts; the null word is the end."""
    held: Counter = Counter()
    ends = 0
    for batch in batches:
        for text in batch["text"]:
            held.update(tokens(text.as_py()))
            ends += 1
            if len(held) > KEPT_WORDS:
                yield _rows(word=pa.array(list(held), pa.binary()), n=pa.array(list(held.values()), pa.int64()))
                held = Counter()
    if ends:
        yield _rows(
            word=pa.array([*held, None], pa.binary()), n=pa.array([*held.values(), ends], pa.int64())
        )


def cut_words(subwords: Subwords, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids of a batch's words `(word, n)` end to end, the n of each id's word, and the n of the null word."""
    known = batch.filter(batch["word"].is_valid())
    ids, begins = subwords.cut(known["word"].to_pylist())
    n = known["n"].to_numpy()
    return ids, np.repeat(n, np.diff(begins)), sum(batch["n"].to_pylist()) - int(n.sum())


def count_ids(ranks: dict[bytes, int]):
    """`(id, n)` from the words of the corpus and their counts, a dense vector for each task."""

    def count(batches):
        subwords = Subwords(ranks)
        held = np.zeros(subwords.end + 1, dtype=np.int64)
        for batch in batches:
            ids, n, ends = cut_words(subwords, batch)
            np.add.at(held, ids, n)
            held[subwords.end] += ends
        seen = np.flatnonzero(held)
        yield _rows(id=pa.array(seen.astype(np.int32)), n=pa.array(held[seen]))

    return count


def pairs_within(ranks: dict[bytes, int], classes: Classes):
    """`(id, n)`: how often a row follows another inside words, from the words and their counts."""

    def count(batches):
        subwords = Subwords(ranks)
        held = np.zeros(ROWS * ROWS, dtype=np.int64)
        for batch in batches:
            ids, n, _ = cut_words(subwords, batch)
            inner = np.flatnonzero(~subwords.begins[ids])
            np.add.at(held, classes.row[ids[inner - 1]] * ROWS + classes.row[ids[inner]], n[inner])
        seen = np.flatnonzero(held)
        yield _rows(id=pa.array(seen.astype(np.int32)), n=pa.array(held[seen]))

    return count


def pairs_between(ranks: dict[bytes, int], classes: Classes):
    """`(id, n)`: how often a word's first row, or the end, follows a word's last row in a task's texts."""

    def count(batches):
        subwords = Subwords(ranks)
        held = np.zeros(ROWS * ROWS, dtype=np.int64)
        end = classes.row[subwords.end]

        def ends(words: list[bytes]) -> list[int]:
            ids, begins = subwords.cut(words)
            return (classes.row[ids[begins[:-1]]] * ROWS + classes.row[ids[begins[1:] - 1]]).tolist()

        known = Remembered(ends)
        for batch in batches:
            for group in in_groups(batch["text"]):
                both = np.array(known.of(list(chain.from_iterable(group))), dtype=np.int64)
                # A text of n words has n + 1 pairs.
                place = np.arange(len(both)) + np.repeat(np.arange(len(group)), list(map(len, group)))
                before, after = (np.full(len(both) + len(group), end) for _ in range(2))
                before[place + 1], after[place] = both % ROWS, both // ROWS
                np.add.at(held, before * ROWS + after, 1)
        seen = np.flatnonzero(held)
        yield _rows(id=pa.array(seen.astype(np.int32)), n=pa.array(held[seen]))

    return count


def train_part(
    ranks: dict[bytes, int], frequent: dict[bytes, int], classes: Classes, pairs: Pairs, weights: np.ndarray,
    seed: int = 0,
):
    """`(id, w, n)`: the weights after one pass over all blocks of a task's texts, and how many those are.

    Blocks are made and shuffled about SHUFFLED at once, so that memory does not grow with the partition.
    """

    def train(batches):
        subwords, learner, texts, n = None, None, [], 0
        for batch in batches:
            if subwords is None:
                subwords = Subwords(ranks, frequent, leave_one_out=True)
                learner = Learner(Attention(unflat(weights), classes, pairs), seed)
            for text in chain.from_iterable(map(subwords.texts, in_groups(batch["text"]))):
                texts.append(text)
                n += -(-len(text) // STRIDE)
                if n >= SHUFFLED:
                    learner.learn(blocks(texts, subwords.end))
                    texts, n = [], 0
        if texts:
            learner.learn(blocks(texts, subwords.end))
        if learner is not None:
            learner.finish()
            found = flat(learner.model.w)
            yield _rows(
                id=pa.array(np.arange(len(found), dtype=np.int32)), w=pa.array(found.astype(np.float64)),
                n=pa.array(np.full(len(found), learner.seen)),
            )

    return train


@dataclass(frozen=True)
class Model:
    ranks: dict[bytes, int]
    frequent: dict[bytes, int]
    classes: Classes
    pairs: Pairs
    weights: np.ndarray


def in_parts(texts: DataFrame, words: int) -> DataFrame:
    """`texts (doc_id, text)` dealt into parts of about PART_WORDS of the corpus's `words`, in an order of their
    own: which texts a part holds, and their order in it, do not depend on the files."""
    parts = max(1, -(-words // PART_WORDS))
    place = F.xxhash64("doc_id", "text")
    return texts.repartition(parts, place).sortWithinPartitions(place, "doc_id").select("text")


def train(
    texts: DataFrame, counts: DataFrame, frequent: dict[bytes, int], words: int, vocabulary: str = VOCABULARY,
    rounds: int = ROUNDS,
) -> Model:
    """Model from all rows of `texts (doc_id, text)` (binary), their `words` words and the counts `(word, n)`.

    Ids and pairs of rows are counted over the whole corpus. In every round all its blocks are trained on, each
    part's in another order than before, and the mean of the parts' weights, by their blocks, starts the next
    round. The driver gets sums and means of fixed size: 50,257 counts, ROWS ** 2 pairs, and the weights.
    """
    ranks = read_vocabulary(vocabulary)

    def summed(rows: DataFrame, size: int) -> np.ndarray:
        out = np.zeros(size)
        found = rows.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
        out[found["id"].to_numpy(dtype=int)] = found["n"].to_numpy()
        return out

    classes = Classes.fit(
        summed(counts.mapInArrow(count_ids(ranks), "id int, n long"), len(ranks) + 1), begin_words(ranks)
    )
    within = counts.mapInArrow(pairs_within(ranks, classes), "id int, n long")
    between = texts.select("text").mapInArrow(pairs_between(ranks, classes), "id int, n long")
    counted = summed(within.union(between), ROWS**2)
    pairs = Pairs.fit(counted.reshape(ROWS, ROWS), classes)
    weights = flat(start())
    parts = in_parts(texts, words)
    for k in range(rounds):
        part = train_part(ranks, frequent, classes, pairs, weights, k)
        trained = parts.mapInArrow(part, "id int, w double, n long")
        by_blocks = (F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")
        mean = trained.groupBy("id").agg(by_blocks).toPandas().sort_values("id")
        if len(mean):
            weights = mean["w"].to_numpy()
    return Model(ranks, frequent, classes, pairs, weights)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, known double, score double, "
    "rare array<binary>, rare_n array<long>"
)


def score_part(model: Model, ends: int):
    """Scores of the model, and what the frequent words add to the base score; other words are listed.

    Texts are scored in lists of about WORDS_AT_ONCE words, a long text in parts.
    """

    def score(batches):
        frequent = model.frequent
        subwords = Subwords(model.ranks, frequent)
        attention = Attention(unflat(model.weights), model.classes, model.pairs)
        for batch in batches:
            doc_ids, held_out = batch["doc_id"], batch["held_out"]
            n_tokens, n_known, known, scores, rare, rare_n = [], [], [], [], [], []
            for group in in_groups(batch["text"]):
                for words in group:
                    counts = Counter(words)
                    other = {w: n for w, n in counts.items() if w not in frequent}
                    seen = [(n, frequent[w]) for w, n in counts.items() if w in frequent]
                    n_tokens.append(len(words) + 1)
                    n_known.append(sum(n for n, _ in seen) + (ends > 0))
                    known.append(math.fsum(n * math.log10(c + 1) for n, c in seen) + math.log10(ends + 1))
                    rare.append(list(other))
                    rare_n.append(list(other.values()))
                rows = blocks(subwords.texts(group), subwords.end)
                of_blocks = attention.log_p(rows).sum(axis=1)
                scores += (np.bincount(rows.owner, of_blocks, len(group)) / math.log(10)).tolist()
            yield _rows(
                doc_id=doc_ids, held_out=held_out, n_tokens=pa.array(n_tokens, pa.int64()),
                n_known=pa.array(n_known, pa.int64()), known=pa.array(known, pa.float64()),
                score=pa.array(scores, pa.float64()), rare=pa.array(rare, pa.list_(pa.binary())),
                rare_n=pa.array(rare_n, pa.list_(pa.int64())),
            )

    return score


def score_texts(docs: DataFrame, held_out: Column | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """`(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)` of each row of `docs`.

    Learns from the rows that are not `held_out` (by default: crc32 of the id modulo 7 is 2). Null and empty
    texts are an end alone. Without any training row the base score is that of a uniform choice of one.
    Equal ids and equal rows are scored each for itself; other columns are ignored.
    """
    if held_out is None:
        held_out = in_fold(F.col("doc_id"), FOLDS, HELD_OUT)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    training = rows.filter("not held_out").select("doc_id", "text")
    counts = materialise(
        training.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    sums = counts.agg(
        F.sum("n"), F.count("*"), F.sum(F.when(F.col("word").isNull(), F.col("n")))
    ).first()
    total, distinct, ends = sums[0] or 0, sums[1], sums[2] or 0
    words = counts.filter("word is not null")
    top = words.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {bytes(r.word): r.n for r in top}
    model = train(training, counts, frequent, total, vocabulary)
    scored = rows.mapInArrow(score_part(model, ends), SCORED)
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times")
    )
    found = rare.join(words, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("add")
    )
    level = math.log10(total + distinct + 1)
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known") + F.coalesce("add", F.lit(0.0)) - level * F.col("n_tokens")).alias("base_score"),
        "score",
    )
