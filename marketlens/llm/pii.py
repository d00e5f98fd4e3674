"""Personal data: base patterns, and a skip-chain conditional random field that carries their labels on.

Nodes are the white-space tokens that hold a digit or ``@``. Labels are the four kinds and none. A node
covered by a base span is observed. The others have a unary potential (multinomial logistic regression
over the token's form and its neighbours'), chain potentials with the next token, and skip potentials
with the next token of the same text, the same digits or the same mailbox name, however far away. Each such
token is also tied to one in a base span of each kind, or where none is in one, to the first, so a label needs
no more hops in a longer text. Loopy message passing, until settled, gives marginals; a node that is surely of a kind becomes an added span, and
neighbours of one kind become one span. Base spans always stay.

All potentials are fitted on the base labels of the whole table; nodes outside base spans that are tied to
one inside teach nothing. The forms are coarse, so what reaches
the driver is a table of counts whose size is bounded by the number of forms, not by the documents.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, freeing, private, table

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_EDGE = "\"'.,;:()[]{}<>!?*|&%$#="

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@`` outwards, so that long runs cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        if first < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield first, 0, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) in code points, by start, then kind."""
    found = list(_emails(text))
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(found)


def tokens(text: str) -> list[tuple[int, int]]:
    """Bounds of the tokens that hold a digit or ``@``, without punctuation at their ends."""
    found, done = [], 0
    m = _MARK.search(text)
    while m:
        first, last = m.start(), m.end()
        while first > done and not text[first - 1].isspace():
            first -= 1
        while last < len(text) and not text[last].isspace():
            last += 1
        done = last
        token = text[first:last]
        found.append((first + len(token) - len(token.lstrip(_EDGE)), last - len(token) + len(token.rstrip(_EDGE))))
        m = _MARK.search(text, last)
    return [(a, b) for a, b in found if a < b]


def _size(n: int) -> int:
    return sum(n >= k for k in (1, 3, 4, 7, 12, 20))


def form(token: str) -> tuple[int, ...]:
    digits = re.sub("[^0-9]", "", token)
    letters = sum(c.isalpha() for c in token)
    return (
        token.count("@") and 1 + ("." in token[token.index("@") :]),
        _size(len(digits)),
        min(token.count("."), 4),
        0 if not letters else 1 + (2 * letters > len(token)),
        12 <= len(digits) <= 19 and letters == 0 and 1 + luhn(digits),
        token.count(".") == 3 and bool(re.fullmatch(r"[0-9.]+", token)) and not re.search(r"^\.|\.\.|\.$", token) and 1 + octets(token),
    )


class Graph:
    """Nodes and edges of one text."""

    def __init__(self, text: str, base: list[Span]):
        self.bounds = tokens(text)
        words = [text[a:b] for a, b in self.bounds]
        n = len(words)
        self.seen = np.full(n, NONE)
        at = 0
        for i, (a, b) in enumerate(self.bounds):
            while at < len(base) and base[at][2] <= a:
                at += 1
            for start, kind, end in itertools.takewhile(lambda s: s[0] < b, itertools.islice(base, at, None)):
                if a < end:
                    self.seen[i] = kind
                    break
        follows = [i + 1 < n and self.bounds[i + 1][0] - self.bounds[i][1] <= 3 and text[self.bounds[i][1] : self.bounds[i + 1][0]].strip(_EDGE + " \t\n") == "" for i in range(n)]
        forms = [form(w) for w in words]
        plus = [a > 0 and text[a - 1] == "+" or text[a : a + 1] == "+" for a, _ in self.bounds]
        self.forms = [
            (*map(int, f), int(plus[i]), 1 + forms[i - 1][1] + 7 * plus[i - 1] if i and follows[i - 1] else 0, 1 + forms[i + 1][1] if follows[i] else 0)
            for i, f in enumerate(forms)
        ]
        self.chain = [(i, i + 1) for i in range(n) if follows[i]]
        self.skip, last, places = [], {}, {}
        for i, w in enumerate(words):
            digits = re.sub("[^0-9]", "", w)
            keys = {("text", w.lower())} | ({("digits", digits)} if len(digits) >= 6 else set()) | ({("name", w.lower().split("@")[0])} if "@" in w else set())
            if len(w) < 5:
                keys = set()
            for key in keys | ({("name", w.lower())} if keys else set()):
                if last.get(key, i) != i:
                    self.skip.append((last[key], i))
                last[key] = i
                places.setdefault(key, []).append(i)
        self.skip = sorted(set(self.skip))
        star = set()
        for at in places.values():
            hubs = {int(self.seen[i]): i for i in reversed(at) if self.seen[i] != NONE}.values() or at[:1]
            star |= {(min(h, i), max(h, i)) for h in hubs for i in at if h != i and self.seen[i] == NONE}
        self.star = sorted(star - set(self.skip))

    def unlabelled(self) -> set[int]:
        """Nodes outside base spans that skip edges tie to one inside: whether they are personal data is what
        is asked, so they teach nothing."""
        near: dict[int, list[int]] = {}
        for a, b in self.skip:
            near.setdefault(a, []).append(b)
            near.setdefault(b, []).append(a)
        tied: set[int] = set()
        todo = [i for i in near if self.seen[i] != NONE]
        while todo:
            for i in near[todo.pop()]:
                if self.seen[i] == NONE and i not in tied:
                    tied.add(i)
                    todo.append(i)
        return tied


class Potentials:
    """Fitted on counts: forms by label, and label pairs over chain and skip edges."""

    def __init__(self, forms: dict[tuple[tuple[int, ...], int], int], chain: dict, skip: dict, steps: int = 400):
        self.chain, self.skip = self._pairs(chain, 0.1, 0.1), self._pairs(skip, 5.0, 0.05)
        fields = sorted({(k, v) for f, _ in forms for k, v in enumerate(f)})
        self.index = {x: i for i, x in enumerate(fields)}
        kinds = sorted({f for f, _ in forms})
        row = {f: i for i, f in enumerate(kinds)}
        counts = np.zeros((len(kinds), LABELS))
        for (f, label), n in forms.items():
            counts[row[f], label] += n
        x = np.zeros((len(kinds), len(fields)))
        for f, i in row.items():
            x[i, [self.index[k, v] for k, v in enumerate(f)]] = 1
        self.weights = np.zeros((len(fields) + 1, LABELS))
        x = np.hstack([x, np.ones((len(kinds), 1))])
        squares = np.full_like(self.weights, 1e-8)
        total = max(counts.sum(), 1)
        for _ in range(steps if len(kinds) else 0):
            p = self._softmax(x @ self.weights)
            gradient = x.T @ (counts - p * counts.sum(1, keepdims=True)) / total - 1e-5 * self.weights
            squares += gradient**2
            self.weights += 0.5 * gradient / np.sqrt(squares)

    @staticmethod
    def _pairs(counts: dict, same: float, other: float) -> np.ndarray:
        """How much more often two labels meet than by chance. ``same`` and ``other`` are counted for each
        pair beforehand: a repeated token has the same label unless the data say otherwise."""
        n = np.full((LABELS, LABELS), other) + np.eye(LABELS) * (same - other)
        for (a, b), v in counts.items():
            n[a, b] += v
        n = (n + n.T) / 2
        return np.log(n * n.sum() / np.outer(n.sum(0), n.sum(1)))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def unary(self, graph: Graph) -> np.ndarray:
        z = np.array([self.weights[[self.index[k, v] for k, v in enumerate(f) if (k, v) in self.index] + [-1]].sum(0) for f in graph.forms])
        z = np.log(self._softmax(z) + 1e-9)
        observed = graph.seen != NONE
        z[observed] = -1e9  # however many repeats say otherwise
        z[observed, graph.seen[observed]] = 0.0
        return z

    def marginals(self, graph: Graph, rounds: int | None = None) -> np.ndarray:
        """Loopy sum-product with damping, until settled or for ``rounds``; by default 100 and four for each node."""
        unary = self.unary(graph)
        rounds = 100 + 4 * len(unary) if rounds is None else rounds
        far = graph.skip + graph.star
        pairs = np.array(graph.chain + far, int).reshape(-1, 2)
        if not len(pairs):
            return self._softmax(unary)
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        back = (np.arange(len(source)) + len(pairs)) % len(source)
        is_far = np.arange(len(source)) % len(pairs) >= len(graph.chain)
        kinds = [(np.flatnonzero(at), np.exp(theta)) for at, theta in ((~is_far, self.chain), (is_far, self.skip)) if at.any()]  # both are symmetric
        by = np.argsort(target, kind="stable")
        held, first = np.unique(target[by], return_index=True)
        messages = np.zeros((len(source), LABELS))

        def beliefs() -> np.ndarray:
            out = unary.copy()
            out[held] += np.add.reduceat(messages[by], first, axis=0)
            return out

        for _ in range(rounds):
            out = beliefs()[source] - messages[back]
            top = out.max(1, keepdims=True)
            weight, new = np.exp(out - top), np.empty_like(messages)
            for at, kernel in kinds:
                new[at] = np.log(weight[at] @ kernel)
            new = 0.5 * messages + 0.5 * (new - new.max(1, keepdims=True))
            settled = np.abs(new - messages).max() < 1e-6
            messages = new
            if settled:
                break
        return self._softmax(beliefs())

    def added(self, text: str, base: list[Span], sure: float = 0.9) -> list[Span]:
        graph = Graph(text, base)
        if not (graph.seen == NONE).any():
            return []
        p = self.marginals(graph)
        label = np.where((p.max(1) >= sure) & (graph.seen == NONE), p.argmax(1), NONE)
        spans: list[Span] = []
        joined = set(graph.chain)
        for i, kind in enumerate(label.tolist()):
            if kind == NONE:
                continue
            if i and (i - 1, i) in joined and label[i - 1] == kind:
                spans[-1] = (spans[-1][0], kind, graph.bounds[i][1])
            else:
                spans.append((graph.bounds[i][0], kind, graph.bounds[i][1]))
        return spans


def fit(docs: DataFrame) -> Potentials:
    """Counts of forms and label pairs over all texts; null and empty texts have none."""

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            n: Counter = Counter()
            for text in batch["text"]:
                if text and _MARK.search(text):
                    graph = Graph(text, base_spans(text))
                    labels = graph.seen.tolist()
                    open_ = graph.unlabelled()
                    n.update(("form", " ".join(map(str, f)), y) for i, (f, y) in enumerate(zip(graph.forms, labels)) if i not in open_)
                    n.update(("chain", str(labels[a]), labels[b]) for a, b in graph.chain if not {a, b} & open_)
                    n.update(("skip", str(labels[a]), labels[b]) for a, b in graph.skip if not {a, b} & open_)
            yield {"part": [k[0] for k in n], "form": [k[1] for k in n], "label": [k[2] for k in n], "n": list(n.values())}

    rows = arrow_map(private(docs, text="text"), count, "part string, form string, label int, n long")
    found = rows.groupBy("part", "form", "label").agg(F.sum("n").alias("n")).collect()
    of = {part: {(tuple(map(int, r.form.split())), r.label): r.n for r in found if r.part == part} for part in ("form", "chain", "skip")}
    return Potentials(of["form"], *({(f[0], y): n for (f, y), n in of[p].items()} for p in ("chain", "skip")))


def find(docs: DataFrame, potentials: Potentials) -> DataFrame:
    """Rows (doc_id, text, starts, kinds, ends, based): all spans of each text in order; ``based`` is 1
    for a base span. Null texts count as empty and have none. Other columns are ignored."""
    model = docs.sparkSession.sparkContext.broadcast(potentials)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {c: [] for c in ("starts", "kinds", "ends", "based")}
            for text in batch["text"]:
                base = base_spans(text) if text else []
                more = model.value.added(text, base) if text and _MARK.search(text) else []
                spans = sorted([(*s, 1) for s in base] + [(*s, 0) for s in more])
                for k, c in enumerate(("starts", "kinds", "ends", "based")):
                    out[c].append([s[k] for s in spans])
            yield {"doc_id": batch["doc_id"], "text": batch["text"], **out}

    own = private(docs, doc_id="doc_id", text="text")
    return arrow_map(own, run, f"doc_id {dict(own.dtypes)['doc_id']}, text string, starts array<long>, kinds array<long>, ends array<long>, based array<long>")


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets; spans that overlap become one."""
    if not spans:
        return text
    out, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact_documents(docs: DataFrame, potentials: Potentials) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced, and ``n_chars`` set to the new length where the column
    is there. All other columns are passed through as they are; null texts stay null."""
    model = docs.sparkSession.sparkContext.broadcast(potentials)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, old = batch.schema.get_field_index("text"), batch.column("text").to_pylist()
            new = []
            for text in old:
                base = base_spans(text) if text else []
                new.append(redact(text, base + (model.value.added(text, base) if text and _MARK.search(text) else [])))
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if (size := batch.schema.get_field_index("n_chars")) >= 0:
                kind, was = batch.schema.field(size), batch.column(size).to_pylist()
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, was)]
                batch = batch.set_column(size, kind, pa.array(sizes, kind.type))
            yield batch

    return docs.mapInArrow(lambda batches: freeing(run(batches)), docs.schema)


def op9_skipchain_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = find(docs, fit(docs))

    def digest(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            rows = [list(zip(*x)) for x in zip(b["starts"], b["kinds"], b["ends"], b["based"])]
            name = lambda s: f"{KINDS[s[1]]}:{s[0]}:{s[2]}"
            base = [[s for s in r if s[3]] for r in rows]
            yield {
                "doc_id": b["doc_id"],
                **{f"n_{k}": [sum(s[1] == i for s in r) for r in base] for i, k in enumerate(KINDS)},
                "base_sha256": [hashlib.sha256(",".join(map(name, r)).encode()).hexdigest() for r in base],
                "spans": [",".join(map(name, r)) for r in rows],
            }

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_map(spans.drop("text"), digest, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
