"""Personal data by fixed forms and a skip-chain conditional random field.

Base spans have fixed forms (e-mail, IP address, payment card, phone) and are always kept. The field
finds further mentions that have no such form by themselves but stand like one or repeat one: it
labels the document's marked words (those with a digit or an ``@``).

Nodes are marked words. Neighbouring ones (at most ``NEAR`` characters apart) share a chain
potential. Repeated or similar ones (equal letters and digits, or an equal run of seven digits or
more at the end) share a skip potential however far apart; each occurrence is tied to the one
before it, so a word that occurs n times costs n - 1 potentials. Words under a base span are
observed. Loopy belief propagation (sum-product, damped, ``ROUNDS`` rounds at most) gives each
word's label distribution; runs of words that have the same personal label with probability
``LEAST`` become spans, unless they overlap a base span.

The weights are trained piece by piece on the base spans of at most ``TRAIN_DOCS`` documents chosen
by hash: a multinomial logistic model of a word's shape, label bigrams of neighbours, and the
agreement of similar words. They are a few hundred numbers. Labelling is one pass in Arrow
batches without a shuffle; a document is the unit, and work within it is linear in its words.

Nulls and repeats: a null text is empty and has no span. Every row gives one row, whatever its
id. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, text_column

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
TRAIN_DOCS = 4000
NEAR = 3
ROUNDS = 20
DAMPING = 0.3
LEAST = 0.9
# Weight of the ridge in training.
RIDGE = 1.0

# The base forms.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits starts, which the look-behind says.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
NOT_DIGIT = re.compile(r"[^0-9]+")
NOT_WORD = re.compile(r"[\W_]+")
EDGES = ".,;:!?\"'()[]{}<>#$%&*|"

Span = tuple[int, int, int]


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if i % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    spans = [(0, start, end) for start, end in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def marked_words(text: str) -> list[tuple[int, int]]:
    """Start and end of the words with a digit or ``@``, less punctuation at their edges."""
    found, end = [], 0
    for mark in MARK.finditer(text):
        if mark.start() < end:
            continue
        space = SPACE.search(text, mark.start())
        last = space.start() if space else len(text)
        first = mark.start()
        while first > end and not text[first - 1].isspace():
            first -= 1
        end = last
        word = text[first:last]
        left = len(word) - len(word.lstrip(EDGES))
        right = len(word.rstrip(EDGES))
        if right > left:
            found.append((first + left, first + right))
    return found


FEATURES = 29


def shape(word: str) -> list[int]:
    """Indices of the features a word has; none tells a base form from the same without its marks."""
    digits = sum(c in "0123456789" for c in word)
    has = [0, 1 + min(digits, 16)]
    has += [18 + min(word.count("."), 3)]
    marks = ("@" in word, "-" in word, any(c.isalpha() for c in word), word.isdecimal())
    has += [22 + i for i, m in enumerate(marks) if m]
    has += [26 + min(len(word) // 8, 2)]
    return has


def ties(words: list[str]) -> list[tuple[int, int]]:
    """Pairs of a word and the one before it that it repeats or resembles."""
    last: dict[str, int] = {}
    pairs = []
    for i, word in enumerate(words):
        plain = NOT_WORD.sub("", word.lower())
        digits = NOT_DIGIT.sub("", word)
        keys = [plain] if len(plain) > 3 else []
        if len(digits) >= 7 and digits[-7:] != plain:
            keys.append("#" + digits[-7:])
        for before in {last[k] for k in keys if k in last}:
            pairs.append((before, i))
        for key in keys:
            last[key] = i
    return pairs


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray

    def _edges(self, places, words):
        chain = [
            (i, i + 1) for i in range(len(places) - 1) if places[i + 1][0] - places[i][1] <= NEAR
        ]
        skip = ties(words)
        return np.array(chain + skip, np.int64).reshape(-1, 2), len(chain)

    def marginals(self, places, words, observed: np.ndarray) -> np.ndarray:
        """Label probabilities; ``observed`` is a label per word, or -1."""
        scores = np.stack([self.unary[shape(w)].sum(axis=0) for w in words])
        fixed = observed >= 0
        scores[fixed] = -50.0
        scores[fixed, observed[fixed]] = 0.0
        edges, chained = self._edges(places, words)
        if not len(edges):
            return _softmax(scores)
        table = np.where(
            (np.arange(len(edges)) < chained)[:, None, None], self.chain, self.skip
        )
        table = np.exp(np.concatenate([table, table.transpose(0, 2, 1)]))
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        reverse = np.roll(np.arange(len(source)), len(edges))
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = scores.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[reverse]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("es,est->et", out, table))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if change < 1e-3:
                break
        belief = scores.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def observed_labels(places: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """The label of each word's base span, the first listed if several, or -1."""
    labels = np.full(len(places), -1)
    starts = np.array([p[0] for p in places])
    ends = np.array([p[1] for p in places])
    for kind, start, end in reversed(spans):
        # Words do not overlap, so those of a span are a range.
        labels[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end)] = kind + 1
    return labels


def further_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """Spans of words that the field labels as personal and no base span covers."""
    places = marked_words(text)
    observed = observed_labels(places, spans)
    if not (observed < 0).any():
        return []
    words = [text[start:end] for start, end in places]
    chances = field.marginals(places, words, observed)
    label = np.where(chances.max(axis=1) >= LEAST, chances.argmax(axis=1), 0)
    found: list[Span] = []
    for i in np.flatnonzero((label > 0) & (observed < 0)).tolist():
        start, end = places[i]
        kind = int(label[i]) - 1
        if found and found[-1][0] == kind and last == i - 1 and start - found[-1][2] <= NEAR:
            found[-1] = (kind, found[-1][1], end)
        else:
            found.append((kind, start, end))
        last = i
    return found


def train(docs: DataFrame) -> Field:
    """Weights from a bounded sample of documents, counted in the tasks."""
    total = docs.count()
    share = min(1.0, TRAIN_DOCS / max(total, 1))
    chosen = located(docs).filter(
        F.pmod(F.xxhash64(*ROW), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    )

    def run(batches):
        shapes: dict[tuple, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                places = marked_words(text)
                if not places:
                    continue
                words = [text[start:end] for start, end in places]
                labels = np.maximum(observed_labels(places, base_spans(text)), 0).tolist()
                seen = [("u", *shape(w), y) for w, y in zip(words, labels)]
                seen += [
                    ("c", labels[i], labels[i + 1])
                    for i in range(len(places) - 1)
                    if places[i + 1][0] - places[i][1] <= NEAR
                ]
                seen += [("s", labels[i], labels[j]) for i, j in ties(words)]
                for key in seen:
                    shapes[key] = shapes.get(key, 0) + 1
        keys = pa.array([" ".join(map(str, key)) for key in shapes], pa.string())
        counts = pa.array(list(shapes.values()), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, counts], ["key", "n"])

    counted = chosen.select(text_column().alias("text")).mapInArrow(run, "key string, n long")
    # Bounded by the number of different shapes.
    rows = counted.groupBy("key").agg(F.sum("n").alias("n")).collect()
    k = len(LABELS)
    pairs = {"c": np.ones((k, k)), "s": np.ones((k, k)) + 4 * np.eye(k)}
    features, labels, weights = [], [], []
    for row in rows:
        kind, *values = row["key"].split()
        if kind == "u":
            vector = np.zeros(FEATURES)
            vector[[int(v) for v in values[:-1]]] = 1
            features.append(vector)
            labels.append(int(values[-1]))
            weights.append(row["n"])
        else:
            pairs[kind][int(values[0]), int(values[1])] += row["n"]
    features = np.array(features, float).reshape(-1, FEATURES)
    unary = _multinomial(features, np.array(labels, int), np.array(weights, float))
    return Field(unary, _lift(pairs["c"]), _lift(pairs["s"]))


def _lift(counts: np.ndarray) -> np.ndarray:
    """Log of how much likelier label pairs are than by chance."""
    total = counts.sum()
    chance = counts.sum(axis=1, keepdims=True) * counts.sum(axis=0, keepdims=True) / total
    return np.clip(np.log(counts / chance), -4, 4)


def _multinomial(features, labels, weights) -> np.ndarray:
    theta = np.zeros((FEATURES, len(LABELS)))
    if not len(features):
        return theta
    target = np.eye(len(LABELS))[labels]
    # Newton steps per label on the diagonal blocks.
    for _ in range(60):
        p = _softmax(features @ theta)
        slope = features.T @ (weights[:, None] * (p - target)) + RIDGE * theta
        step = np.empty_like(theta)
        for y in range(len(LABELS)):
            scale = weights * p[:, y] * (1 - p[:, y])
            curve = (features * scale[:, None]).T @ features + RIDGE * np.eye(FEATURES)
            step[:, y] = np.linalg.solve(curve, slope[:, y])
        theta -= np.clip(0.5 * step, -2, 2)
        if np.abs(step).max() < 1e-4:
            break
    return theta


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, a count per kind of base span, ``base_sha256``, ``spans`` and ``n_further``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    counts = [f"n_{kind}" for kind in KINDS]

    def run(batches):
        field = shared.value
        for batch in batches:
            found, hashes, written, further = [], [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                more = further_spans(text, base, field)
                found.append([sum(s[0] == k for s in base) for k in range(len(KINDS))])
                hashes.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(sorted(base + more)))
                further.append(len(more))
            columns = np.array(found, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(columns[:, k]) for k in range(len(KINDS))),
                    pa.array(hashes, pa.string()),
                    pa.array(written, pa.string()),
                    pa.array(further, pa.int64()),
                ],
                ["doc_id", *counts, "base_sha256", "spans", "n_further"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts)
    return rows.mapInArrow(run, schema + ", base_sha256 string, spans string, n_further long")
