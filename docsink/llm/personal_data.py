"""Personal data: high-recall generators propose overlapping spans, boosted trees judge them by format and context.

Fixed formats (the base) always count. Looser generators add candidates: addresses spelled out, digit groups
inside longer runs, numbers with other separators. The trees learn from all candidates of all documents: a feature has a few whole
values, so candidates are counted by their features, and the counts are all that the trees need. What is positive is decided by checks of the kind (`passes`), whichever generator proposed a span; base spans also count spelled in other
ways, and spoilt ones as negatives, as a corpus may have few of either.
The threshold is the lowest score from which candidates are as precise as asked for, each being scored by trees of the other
folds, so that all candidates calibrate too; candidates from there on that overlap nothing accepted are added, best first.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts_of

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
PRECISION = 0.99
ROUNDS, DEPTH, RATE, LEAST = 40, 3, 0.2, 10
FOLDS = 3

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN_RE = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_RE = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD_RE = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE_RE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]|[\[(]at[\])]")
AT_RE = re.compile(r" ?[\[(]at[\])] ?")
SPELLED_DOMAIN_RE = re.compile(r"[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)+")
DOTTED_RE = re.compile(r"(?<![0-9.])[0-9]+(?:\.[0-9]+){2,}")
# Digits in these are what the kind can have at most: a card 19, a phone 15 and some signs.
GROUPS_RE = re.compile(r"(?<![0-9])(?:[0-9]{4}[ ./_-]?){3}[0-9]{1,7}(?![0-9])")
LOOSE_PHONE_RE = re.compile(r"(?<![0-9])(?:\+|00)?[ ]?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9])")
CUES = (re.compile(r"mail|e-?mail|contact|write", re.I), re.compile(r"\bip\b|host|address|server", re.I), re.compile(r"card|visa|credit|account", re.I), re.compile(r"(?<![A-Za-z])(?:tel|telephone|phone|call|fax|mobile)(?![A-Za-z])", re.I))
# Digits that a kind can have.
DIGITS = ((0, 64), (4, 12), (13, 19), (8, 15))
AGAINST = re.compile(r"token|version|licen[sc]e|isbn|=\s*\"?$|\bv$", re.I)


def luhn(digits: str) -> bool:
    own = [int(x) for x in digits[::-1]]
    return (sum(own[::2]) + sum(sum(divmod(2 * x, 10)) for x in own[1::2])) % 10 == 0


def digits_of(span: str) -> str:
    return "".join(x for x in span if "0" <= x <= "9")


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain in time linear in the text: a local part ends at its sign, so signs are walked."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN_RE.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed formats, in code points."""
    found = [(EMAIL, *x) for x in base_emails(text)]
    found += [(IP, m.start(), m.end()) for m in IP_RE.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in CARD_RE.finditer(text):
        if 16 <= len(m[0]) and 16 <= len(own := digits_of(m[0])) <= 19 and luhn(own):
            found.append((CARD, m.start(), m.end()))
    if "+" in text:
        found += [(PHONE, m.start(), m.end()) for m in PHONE_RE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


def spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses whose sign is spelled out, from each such sign to both sides, in time linear in the text."""
    free = 0
    for m in AT_RE.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = SPELLED_DOMAIN_RE.match(text, m.end()) if start < m.start() else None
        if found:
            if cut := re.search(r"[.] ", text[m.end() : found.end()]):  # a sentence may end there
                if SPELLED_DOMAIN_RE.fullmatch(text, m.end(), m.end() + cut.start()):
                    yield start, m.end() + cut.start()
            yield start, found.end()
            free = found.end()


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    yield from ((EMAIL, *x) for x in spelled_emails(text))
    for kind, pattern in ((IP, DOTTED_RE), (CARD, GROUPS_RE), (PHONE, LOOSE_PHONE_RE)):
        for m in pattern.finditer(text):
            yield kind, m.end() - len(m[0].lstrip()), m.end()


def unspelled(span: str) -> str:
    return re.sub(r" ?[\[(]dot[\])] ?", ".", re.sub(r" ?[\[(]at[\])] ?", "@", span))


def is_address(span: str) -> bool:
    return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}", unspelled(span)))


def abroad(span: str) -> bool:
    return span.startswith(("+", "00"))


def passes(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a span is personal data by its kind's checks and cues, which are not its generator's pattern."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    own, parts = digits_of(span), [x for x in re.split(r"[^0-9]+", span) if x]
    if kind == EMAIL:
        return is_address(span)
    if AGAINST.search(before) or text[end : end + 1].isalnum() or text[start - 1 : start].isalnum():
        return False
    if kind == IP:
        return len(parts) == 4 and all(len(x) < 4 and int(x) <= 255 for x in parts) and not re.match(r"\.[0-9]", text[end : end + 2])
    if kind == CARD:
        return DIGITS[CARD][0] <= len(own) <= DIGITS[CARD][1] and own[0] in "23456" and luhn(own)
    return DIGITS[PHONE][0] <= len(own) <= DIGITS[PHONE][1] and (abroad(span) or bool(CUES[PHONE].search(before))) and not own.startswith(("978", "979"))


def variants(text: str, kind: int, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """A base span spelled in another way, and spoilt, in its place: (text, start, end)."""
    span = text[start:end]
    own = digits_of(span)
    if kind == EMAIL:
        other, bad = span.replace("@", " [at] ").replace(".", " [dot] "), re.sub(r"[A-Za-z-]+$", "7", span)
    elif kind == IP:
        other, bad = span, span + ".1"
    elif kind == CARD:
        other, bad = ".".join(own[k : k + 4] for k in range(0, len(own), 4)), span[:-1] + str((int(span[-1]) + 1) % 10)
    else:
        other, bad = "00" + span[1:], span[1:]
    for new in (other, bad):
        if new != span:
            yield text[max(0, start - 24) : start] + new + text[end : end + 1], min(24, start), min(24, start) + len(new)
    if kind == PHONE:
        yield f"phone {span[1:]}{text[end : end + 1]}", 6, 5 + len(span)


def _class(sign: str) -> int:
    return 0 if not sign or sign.isspace() else 1 if sign.isalpha() else 2 if sign.isdigit() else 3


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """WIDTH whole numbers, each of a few values."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    own = digits_of(span)
    parts = [x for x in re.split(r"[^0-9]+", span) if x]
    return [
        kind,
        float(DIGITS[kind][0] <= len(own) <= DIGITS[kind][1]),
        min(len(parts), 5) if kind == IP else 0,  # an address has four: five says more
        float(kind == CARD and len(own) <= 32 and luhn(own)) if own else 0.0,
        float(kind == IP and all(len(x) < 4 and int(x) <= 255 for x in parts)) if parts else 0.0,
        float(kind == PHONE and abroad(span)),
        float(kind == EMAIL and is_address(span)),
        float(kind == CARD and own[:1] in tuple("23456")) + 2.0 * (kind == PHONE and own.startswith(("978", "979"))),
        _class(text[start - 1 : start]),
        _class(text[end : end + 1]),
        float(bool(CUES[kind].search(before))),
        float(bool(AGAINST.search(before))),
    ]


WIDTH = 12


def candidates_in(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base), base first; a loose span that is just a base span is not repeated."""
    if not HINT.search(text):
        return []
    base = base_spans(text)
    known = set(base)
    return [(*x, True) for x in base] + [(*x, False) for x in dict.fromkeys(loose_spans(text)) if x not in known]


class Trees:
    """Boosted regression trees for the logistic loss, over features of few values; row k stands for n[k] equal ones."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.cuts = [np.unique(x[:, j])[:-1] for j in range(x.shape[1])]
        self.bias, self.trees = float(np.log((n @ y + 1) / (n @ (1 - y) + 1))), []
        binned, z = self.bin(x), np.full(len(y), self.bias)
        for _ in range(ROUNDS if len(y) else 0):
            p = 1 / (1 + np.exp(-z))
            tree = self.grow(binned, n * (y - p), n * p * (1 - p), n, np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            z = z + self.walk(tree, binned)

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1) if len(x) else np.zeros(x.shape, int)

    def grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, rows: np.ndarray, depth: int):
        whole, total = (g[rows].sum(), h[rows].sum()), n[rows].sum()
        gain = lambda a, b: a * a / (b + 1)
        best = (1e-6, None)
        for j in range(binned.shape[1]) if depth and total >= 2 * LEAST else ():
            own = binned[rows, j]
            a, b, count = (np.cumsum(np.bincount(own, w[rows], len(self.cuts[j]) + 1)) for w in (g, h, n))
            ok = (count >= LEAST) & (total - count >= LEAST)
            gains = np.where(ok, gain(a, b) + gain(whole[0] - a, whole[1] - b) - gain(*whole), 0)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                best = (gains[k], (j, k))
        if best[1] is None:
            return RATE * whole[0] / (whole[1] + 1)
        j, k = best[1]
        left = binned[rows, j] <= k
        return j, k, self.grow(binned, g, h, n, rows[left], depth - 1), self.grow(binned, g, h, n, rows[~left], depth - 1)

    def walk(self, tree, binned: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(binned), tree)
        j, k, low, high = tree
        left = binned[:, j] <= k
        out = np.empty(len(binned))
        out[left], out[~left] = self.walk(low, binned[left]), self.walk(high, binned[~left])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self.bin(x)
        return 1 / (1 + np.exp(-sum((self.walk(t, binned) for t in self.trees), np.full(len(x), self.bias))))


class Cover:
    """Disjoint stretches of a text, as sorted begins and ends."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.begins, self.ends = [], []
        for _, start, end in sorted(spans, key=lambda x: x[1]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Whether the stretch overlapped none; then it is one of them."""
        k = bisect.bisect_left(self.begins, end)
        if k and self.ends[k - 1] > start:
            return False
        self.begins.insert(k, start)
        self.ends.insert(k, end)
        return True


class Model:
    """Trees and, by kind, the score from which a candidate is added (over 1: none is)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, fold: np.ndarray | None = None, precision: float = PRECISION):
        """n: how many candidates a row stands for (1); fold: 0 to FOLDS - 1, rows that are scored by the trees of all others (dealt in turn)."""
        n = np.ones(len(y)) if n is None else n
        fold = np.arange(len(y)) % FOLDS if fold is None else fold
        scores = np.zeros(len(y))
        for k in range(FOLDS):
            out = fold == k
            scores[out] = Trees(x[~out], y[~out], n[~out]).score(x[out])
        self.trees = Trees(x, y, n)
        self.thresholds = [2.0] * len(KINDS)
        for kind in range(len(KINDS)):
            own = x[:, 0] == kind
            order = np.argsort(-scores[own], kind="stable")
            ranked, right, many = scores[own][order], y[own][order], n[own][order]
            precise = np.cumsum(right * many) / np.cumsum(many) >= precision
            last = np.append(ranked[1:] != ranked[:-1], True)[: len(ranked)]  # equal scores stand or fall together
            if (found := np.flatnonzero(precise & last)).size:
                below = ranked[found[-1] + 1] if found[-1] + 1 < len(ranked) else 0.0  # between what passes and the next
                self.thresholds[kind] = max(0.5, float(ranked[found[-1]] + below) / 2)

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all accepted ones; each by kind, then start."""
        found = candidates_in(text)
        base = sorted(x[:3] for x in found if x[3])
        loose = [x[:3] for x in found if not x[3]]
        taken = list(base)
        if loose:
            cover = Cover(base)
            scores = self.trees.score(np.array([features(text, *x) for x in loose], float))
            for k in np.argsort(-scores, kind="stable"):
                kind, start, end = loose[k]
                if scores[k] >= self.thresholds[kind] and cover.add(start, end):
                    taken.append(loose[k])
        return base, sorted(taken)


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, x, y, n): how many candidates of a fold have these features and this label."""
    counts: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for kind, start, end, base in candidates_in(text):
                for k, (t, a, b) in enumerate([(text, start, end), *(variants(text, kind, start, end) if base else ())]):
                    fold = xxhash.xxh3_64_intdigest(f"{doc_id}:{kind}:{start}:{end}:{k}".encode()) % FOLDS
                    counts[fold, tuple(int(v) for v in features(t, kind, a, b)), passes(t, kind, a, b)] += 1
    fold, x, y = zip(*counts, strict=True) if counts else ((), (), ())
    columns = [pa.array(fold, pa.int32()), pa.array(x, pa.list_(pa.int32())), pa.array(y, pa.bool_()), pa.array(list(counts.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["fold", "x", "y", "n"])


def train(docs: DataFrame) -> Model:
    """From all candidates of all documents: a row for each combination of features and label reaches the driver."""
    rows = texts_of(docs).where(F.col("text").rlike(r"[0-9@]|[\[(]at[\])]")).mapInArrow(_propose, "fold int, x array<int>, y boolean, n long")
    found = rows.groupBy("fold", "x", "y").agg(F.sum("n").alias("n")).orderBy("fold", "x", "y").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, WIDTH)
    return Model(x, found["y"].to_numpy(float), found["n"].to_numpy(float), found["fold"].to_numpy(int))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _finder(model: Model):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [model.spans(t) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(x[0] == k for x in base) for base, _ in both], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([_joined(b) for b, _ in both], pa.string()), pa.array([_joined(a) for _, a in both], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return find


def personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, counts of base spans, base_sha256, spans.

    A null or empty text has none; repeated rows, and rows without a doc_id, each have a row; no rows give none; other columns stay out.
    Of overlapping candidates the better scored stays, of equal ones the one proposed first; base spans all stay.
    """
    found = texts_of(docs).mapInArrow(_finder(model), "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def redacted_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each stretch that spans cover becomes the name, in brackets, of the kind that begins it."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs, its text redacted and every other column as it is. Null texts stay null."""
    schema, place = docs.schema, docs.columns.index(text_col)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None or not (s := model.spans(t)[1]) else redacted_text(t, s) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, text_col, pa.array(texts, batch.column(place).type))

    return docs.mapInArrow(rewrite, schema)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data(docs, train(docs))
