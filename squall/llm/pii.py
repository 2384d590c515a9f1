"""Personal data by weak supervision.

Strict patterns give the base spans. Wider patterns give more candidates; regular-expression,
gazetteer, context, shape and boundary labelers vote on every candidate or abstain, each on evidence of its own.
Expectation-maximisation over the vote patterns of all candidates estimates the labelers' reliabilities
kind by kind, and a logistic classifier of spans learns from the posteriors. Candidates it accepts are
added to the base.

Patterns with an open beginning would be tried again from every character of a long run. Their matches are
found from what they must hold instead (an `@`, a chain of numbers, a bracketed `at`), in linear time.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.storage import materialise

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "national_phone", "hidden_email", "social", "person", "street")
KINDS = BASE_KINDS + MORE_KINDS
LABELERS = ("regex", "gazetteer", "context", "shape", "boundary")

# The base kinds, as stated: email `LOCAL@DOMAIN`, ip four NUMBERS, card, phone.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])")
NATIONAL = re.compile(r"(?<![0-9+)(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
HIDDEN_AT = re.compile(r" ?[\[(] ?at ?[\])] ?")
HIDDEN_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)+")
SOCIAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
PERSON = re.compile(r"\b([A-Z][a-z]{1,15}) (?:[A-Z]\. )?[A-Z][a-z]{1,20}\b")
STREET = re.compile(r"\b[0-9]{1,5} (?:[A-Z][a-z]{1,15} ){1,3}([A-Z][a-z]{1,9})\b")

# Common top-level domains, and words that stand before personal data.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
NAMES = frozenset(
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Christopher Lisa Daniel Nancy Matthew Betty Anthony Margaret Mark Sandra "
    "Donald Ashley Steven Kimberly Paul Emily Andrew Donna Joshua Michelle Hans Peter Anna Klaus Ursula Monika "
    "Jean Marie Pierre Claire Carlos Maria Jose Carmen Luis Ana".split()
)
STREETS = frozenset(
    "Street Avenue Road Lane Drive Boulevard Court Place Square Terrace Way Parkway Highway Alley Crescent".split()
)
CITIES = frozenset(
    "London Paris Berlin Madrid Rome Vienna Dublin Lisbon Brussels Amsterdam Boston Chicago Houston Dallas Seattle "
    "Denver Miami Atlanta Phoenix Detroit Toronto Sydney Munich Hamburg Cologne Lyon Barcelona Valencia".split()
)
TITLES = ("mr", "mrs", "ms", "dr", "prof", "name", "named", "called", "contact", "sincerely", "signed")
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write"),
    "hidden_email": ("mail", "email", "e-mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "account", "credit"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "national_phone": ("phone", "tel", "call", "fax", "mobile"),
    "secret": ("token", "key", "secret", "password", "passwd", "apikey", "api_key", "bearer"),
    "social": ("ssn", "social", "security"),
    "person": TITLES,
    "street": ("address", "lives", "live", "at", "home", "located", "street"),
}
WORD = re.compile(r"[a-z_-]+")

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
    T.StructField("votes", T.StringType()), T.StructField("shape", T.StringType()),
]))
_SPAN = pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
    ("votes", pa.string()), ("shape", pa.string()),
])


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ip_ok(s: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in s.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 12 <= len(d) <= 19 and luhn(d)


def _strict(kind: str, s: str) -> bool:
    """Whether a match of the pattern of a kind is personal data by rule."""
    if kind == "ip":
        return _ip_ok(s)
    if kind == "card":
        return _card_ok(s)
    if kind == "phone":
        return 9 <= len(_digits(s)) <= 15
    return kind == "email"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of `LOCAL@DOMAIN`: each run of local characters before an `@`."""
    at = 0
    for run in LOCAL.finditer(text) if "@" in text else ():
        if text[run.end() : run.end() + 1] == "@":
            domain = DOMAIN.match(text, run.end() + 1)
            if domain and max(run.start(), at) < run.end():
                yield max(run.start(), at), domain.end()
                at = domain.end()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping runs of four numbers with single dots between: four by four along a chain."""
    for chain in NUMBERS.finditer(text):
        if chain[0].count(".") >= 3:
            ends, at = [], chain.start()
            for part in chain[0].split("."):
                ends.append((at, at + len(part)))
                at += len(part) + 1
            for k in range(0, len(ends) - 3, 4):
                yield ends[k][0], ends[k + 3][1]


def hidden_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a bracketed `at`: from each such word to the left and to the right."""
    done = 0
    for at in HIDDEN_AT.finditer(text):
        begin = at.start()
        while begin > done and text[begin - 1] in _LOCAL_CHARACTERS:
            begin -= 1
        domain = HIDDEN_DOMAIN.match(text, at.end()) if begin < at.start() else None
        if domain:
            yield begin, domain.end()
            done = domain.end()


_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _gazetteer(kind: str, s: str, digits: str, after: str) -> str:
    if kind in ("email", "hidden_email"):
        return "+" if re.split(r"[^a-z0-9]+", s.lower().strip("])"))[-1] in DOMAINS else "0"
    if kind == "card":
        return "+" if digits[:1] in "3456" else "-"
    if kind == "secret":
        return "+" if re.fullmatch(r"[0-9a-f]{32,}", s) else "0"
    if kind == "person":
        return "+" if s.split(" ")[0] in NAMES else "-"
    if kind == "street":
        known = s.rsplit(" ", 1)[-1] in STREETS
        return "+" if known or any(w in CITIES for w in re.findall(r"[A-Z][a-z]+", after)) else "-"
    return "0"


def _form(kind: str, s: str, digits: str) -> str:
    """How the span is written, whatever its numbers add up to."""
    if kind == "secret":
        return "+" if digits and len(digits) < len(s) and len(set(s)) >= 8 else "-"
    if kind == "card":
        signs = set(s) - set("0123456789")
        groups = re.split(r"[ -]", s)
        return "+" if len(signs) <= 1 and all(len(g) >= 3 for g in groups) else "-"
    if kind == "ip":
        parts = s.split(".")
        plain = all(p == "0" or not p.startswith("0") for p in parts)
        return "+" if plain and parts[0] != "0" and len(set(parts)) > 1 else "-"
    if kind == "phone":
        return "+" if s[1] != "0" and s.count("(") == s.count(")") <= 1 and ".." not in s else "-"
    if kind == "social":
        return "-" if digits[:3] in ("000", "666") or digits[3:5] == "00" else "+"
    if kind in ("person", "street"):
        return "+" if len(s) >= 8 else "0"
    return "+"


def _vote(kind: str, text: str, start: int, end: int) -> str:
    """Votes of the labelers on a candidate: `+`, `-` or `0` each, as listed in LABELERS."""
    s = text[start:end]
    digits = _digits(s)
    if kind in BASE_KINDS:
        regex = "+" if _strict(kind, s) else "-"
    else:
        regex = "0" if kind in ("secret", "person", "street") else "+"
    before = WORD.findall(text[max(0, start - 32) : start].lower())
    context = "+" if any(w in HINTS[kind] for w in before[-3:]) else "0"
    if kind == "secret":
        quoted = text[start - 1 : start] in "\"'" and text[end : end + 1] in ("'", '"')
        context = "+" if context == "+" or (start and quoted) else "-"
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    boundary = "-" if any(c.isalnum() for c in around) else "+"
    gazetteer = _gazetteer(kind, s, digits, text[end : end + 32])
    return regex + gazetteer + context + _form(kind, s, digits) + boundary


def _shape(text: str, start: int, end: int) -> str:
    """Features of the span itself: length, share of digits, whether it is broken by signs."""
    s = text[start:end]
    share = sum(c.isdigit() for c in s) * 4 // len(s)
    return f"{min(len(s) // 8, 7)}{share}{int(any(not c.isalnum() for c in s))}"


def _spans(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def candidates(text: str) -> list[tuple]:
    """`(kind, start, end, base, votes, shape)` in order of start and kind."""
    found, taken = [], []
    if re.search(r"[0-9@]", text):
        cards = _spans(CARD, text)
        phones = _spans(PHONE, text) if "+" in text else ()
        for k, spans in enumerate((emails(text), addresses(text), cards, phones)):
            for a, b in spans:
                s = text[a:b]
                base = _strict(KINDS[k], s)
                if base or (k == 2 and 12 <= len(_digits(s)) <= 19) or k == 1:
                    found.append((k, a, b, base))
                if base:
                    taken.append((a, b))
        more = [_spans(SECRET, text), _spans(NATIONAL, text), hidden_emails(text), _spans(SOCIAL, text)]
    else:
        hidden = "at" in text and ("(" in text or "[" in text)
        more = [(), (), hidden_emails(text) if hidden else (), ()]
    people = (m.span() for m in PERSON.finditer(text) if m[1] in NAMES or _titled(text, m.start()))
    streets = (m.span() for m in STREET.finditer(text) if m[1] in STREETS or m[1] in CITIES)
    begins, reach = _merged(taken)
    for k, spans in enumerate([*more, people, streets], start=len(BASE_KINDS)):
        for a, b in spans:
            at = bisect_left(begins, b) - 1  # the last taken stretch that begins before the end
            if at < 0 or reach[at] <= a:
                found.append((k, a, b, False))
    return [
        (k, a, b, base, _vote(KINDS[k], text, a, b), _shape(text, a, b))
        for k, a, b, base in sorted(found, key=lambda x: (x[1], x[0]))
    ]


def _titled(text: str, start: int) -> bool:
    words = WORD.findall(text[max(0, start - 12) : start].lower())
    return bool(words) and words[-1] in TITLES


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Begins and ends of the stretches that spans cover together."""
    begins: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    return begins, ends


@F.arrow_udf(SPANS)
def find_candidates(texts: pa.Array) -> pa.Array:
    names = ("kind", "start", "end", "base", "votes", "shape")
    rows = [[dict(zip(names, c)) for c in candidates(t.as_py() or "")] for t in texts]
    return pa.array(rows, type=pa.list_(_SPAN))


@dataclass(frozen=True)
class SpanClassifier:
    """Logistic model over kind, shape and votes, and the reliabilities it was taught with: for each kind
    each labeler's shares of right votes on true and on false spans."""

    weights: tuple[float, ...]
    reliabilities: tuple[tuple[tuple[float, float], ...], ...]

    @staticmethod
    def features(kind: int, votes: str, shape: str) -> np.ndarray:
        x = np.zeros(1 + len(KINDS) + 2 * len(LABELERS) + 8 + 5 + 1)
        x[0] = 1
        x[1 + kind] = 1
        at = 1 + len(KINDS)
        for i, v in enumerate(votes):
            x[at + 2 * i] = v == "+"
            x[at + 2 * i + 1] = v == "-"
        at += 2 * len(LABELERS)
        x[at + int(shape[0])] = 0.25
        x[at + 8 + int(shape[1])] = 0.25
        x[at + 13] = 0.25 * int(shape[2])
        return x

    def probability(self, kind: int, votes: str, shape: str) -> float:
        z = float(np.dot(self.weights, self.features(kind, votes, shape)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(patterns: list[tuple[int, str, str, int]], rounds: int = 25) -> SpanClassifier:
    """From `(kind, votes, shape, n)`, which have a bounded number of values, all candidates counted.

    Reliabilities stay between 0.55 and 0.99, so a labeler is never read the other way round.
    """
    n_labelers = len(LABELERS)
    if not patterns:
        return SpanClassifier((0.0,) * len(SpanClassifier.features(0, "0" * n_labelers, "000")), ())
    n = np.array([p[3] for p in patterns], dtype=float)
    votes = np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in p[1]] for p in patterns])
    kind = np.array([p[0] for p in patterns])
    prior = np.full(len(KINDS), 0.5)
    right = np.full((len(KINDS), n_labelers, 2), 0.8)  # right on true spans, right on false ones
    posterior = np.zeros(len(n))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior))[kind]
        for j in range(n_labelers):
            a, b = right[kind, j, 0], right[kind, j, 1]
            odds = odds + np.where(votes[:, j] > 0, np.log(a / (1 - b)), 0)
            odds = odds + np.where(votes[:, j] < 0, np.log((1 - a) / b), 0)
        posterior = 1 / (1 + np.exp(-odds))
        true, false = n * posterior, n * (1 - posterior)

        def by_kind(values, chosen=slice(None)):
            return np.bincount(kind[chosen], weights=values[chosen], minlength=len(KINDS))

        prior = np.clip((by_kind(true) + 1) / (by_kind(n) + 2), 0.05, 0.95)
        for j in range(n_labelers):
            plus, minus = votes[:, j] > 0, votes[:, j] < 0
            right[:, j, 0] = (by_kind(true, plus) + 8) / (by_kind(true, plus | minus) + 10)
            right[:, j, 1] = (by_kind(false, minus) + 8) / (by_kind(false, plus | minus) + 10)
        right = np.clip(right, 0.55, 0.99)
    x = np.array([SpanClassifier.features(*p[:3]) for p in patterns])
    share = n / n.sum()
    # Rare patterns count for something too, or a flood of one kind decides for all.
    share = 0.5 * share + 0.5 / len(n)
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps with a light ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - posterior)) + 1e-3 * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    of_kinds = tuple(tuple(map(tuple, of_kind)) for of_kind in right.tolist())
    return SpanClassifier(tuple(w.tolist()), of_kinds)


def train(found: DataFrame) -> SpanClassifier:
    """Classifier from the candidates of all rows of `found (spans, …)`.

    The driver gets the counts of (kind, votes, shape): at most 10 kinds x 3 ** 5 votes x 80 shapes.
    """
    span = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.shape")
    counts = span.groupBy("kind", "votes", "shape").count()
    return learn(sorted(map(tuple, counts.collect())))


def accepted(spans: Column, model: SpanClassifier) -> Column:
    """Base spans and those the classifier accepts, as `kind:start:end` comma-joined; and the base alone."""
    kind = T.StructType([
        T.StructField("base", T.StringType()), T.StructField("all", T.StringType()),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ])

    @F.arrow_udf(kind)
    def choose(lists: pa.Array) -> pa.Array:
        rows = []
        for spans in lists.to_pylist():
            base, every, counts = [], [], [0] * len(BASE_KINDS)
            for s in spans or ():
                text = f"{KINDS[s['kind']]}:{s['start']}:{s['end']}"
                if s["base"]:
                    base.append(text)
                    counts[s["kind"]] += 1
                if s["base"] or model.probability(s["kind"], s["votes"], s["shape"]) >= 0.5:
                    every.append(text)
            rows.append({"base": ",".join(base), "all": ",".join(every), "counts": counts})
        return pa.array(rows, type=pa.struct([
            ("base", pa.string()), ("all", pa.string()), ("counts", pa.list_(pa.int64())),
        ]))

    return choose(spans)


@F.arrow_udf(T.StringType())
def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out = []
    for text, listed in zip(texts.to_pylist(), spans.to_pylist()):
        if text and listed:
            parts, at = [], 0
            for kind, start, end in (s.split(":") for s in listed.split(",")):
                if int(start) >= at:
                    parts += [text[at : int(start)], f"[{kind}]"]
                at = max(at, int(end))
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pa.array(out, type=pa.string())


def find_personal_data(docs: DataFrame) -> DataFrame:
    """`(doc_id, n_email, n_ip, n_card, n_phone, base, spans)` for each row of `docs (doc_id, text, …)`.

    `base` and `spans` list `kind:start:end` by start, then kind, in code points, end exclusive. Null text
    counts as empty and has no span; equal ids and equal rows are treated each for itself; an empty table gives
    an empty one; other columns are ignored. Whole texts are read, in time linear in their length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = materialise(docs.select("doc_id", find_candidates(text).alias("spans")), "candidates")
    out = found.select("doc_id", accepted(F.col("spans"), train(found)).alias("a"))
    return out.select(
        "doc_id",
        *[F.col("a.counts")[k].alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.col("a.base").alias("base"), F.col("a.all").alias("spans"),
    )


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with personal data replaced by its kind in brackets; `n_chars`, if there, follows the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = materialise(
        docs.select(F.struct("*").alias("row"), find_candidates(text).alias("spans")), "candidates"
    )
    listed = accepted(F.col("spans"), train(found))["all"]
    out = found.select("row", listed.alias("listed"))
    out = out.withColumn("text", masked(F.col("row.text"), F.col("listed")))
    changed = F.col("listed") != ""
    return out.select(*[
        F.col("text") if f.name == "text"
        else F.when(changed, F.length("text").cast(f.dataType)).otherwise(F.col("row")[f.name])
        .alias(f.name) if f.name == "n_chars"
        else F.col("row")[f.name].alias(f.name)
        for f in docs.schema
    ])
