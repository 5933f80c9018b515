"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and telephone numbers. The
random field labels the words around digits and at-signs: neighbours share a
transition potential, and repeated or similar words, however far apart, share an
agreement potential. Loopy belief propagation makes labels consistent across the
document, with the patterns' findings as evidence. Its potentials are fitted to the
patterns' findings in a bounded sample.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)

# What the base patterns accept. Guards before a digit only save time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

AGREEING = 1_000  # agreeing pairs of alike words that training starts from, for each label
WORD = re.compile(r"[^ \t-\r]+")
FEATURES = 44
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the patterns' findings, by start and then by kind."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in match[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return sorted(found, key=_order)


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches, from one at-sign to the next, so that long words cost no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


@dataclass
class Field:
    """Nodes of one text: words with a digit or an at-sign, in order."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    evidence: np.ndarray  # label of words that lie in a base span, else -1
    edges: np.ndarray  # pairs of nodes
    skip: np.ndarray  # whether an edge joins alike words, not neighbours


def field_of(text: str, base: list[Span]) -> Field | None:
    """The field of a text, or None where no word could be personal data."""
    words = [m.span() for m in _signal_words(text)]
    if not words:
        return None
    shapes = [_shape(text[a:b]) for a, b in words]
    n = len(words)
    own = np.array(shapes, dtype=np.float64)
    features = np.zeros((n, FEATURES))
    width = own.shape[1]
    features[:, :width] = own
    beside = np.array([text[b:c].isspace() for (_, b), (c, _) in zip(words, words[1:])], dtype=bool)
    joins = np.flatnonzero(beside)
    features[joins + 1, width : 2 * width] = own[joins]
    features[joins, 2 * width : 3 * width] = own[joins + 1]
    features[:, -2] = [text[max(0, a - 2) : a].strip() in ("", ",") for a, _ in words]
    features[:, -1] = 1.0
    evidence = np.full(n, -1)
    starts = [a for a, _ in words]
    for kind, start, end in base:
        first = max(0, bisect.bisect_right(starts, start) - 1)
        for k in range(first, n):
            if words[k][0] >= end:
                break
            if words[k][1] > start:
                evidence[k] = LABELS.index(kind)
    chain = np.stack([joins, joins + 1], axis=1)
    alike: dict[str, int] = {}
    linked = []
    for k, (a, b) in enumerate(words):
        key = _likeness(text[a:b])
        if key:
            if key in alike:
                linked.append((alike[key], k))
            alike[key] = k
    distant = np.array(linked, dtype=np.int64).reshape(-1, 2)
    skip = np.concatenate([np.zeros(len(chain), bool), np.ones(len(distant), bool)])
    return Field(words, features, evidence, np.concatenate([chain, distant]), skip)


def _signal_words(text: str):
    """Words with a digit or an at-sign; the search jumps from one such sign to the next."""
    at = _next_sign(text, 0)
    while at >= 0:
        start = at
        while start and text[start - 1] not in " \t\n\r\x0b\x0c":
            start -= 1
        match = WORD.match(text, start)
        yield match
        at = _next_sign(text, match.end())


_SIGN = re.compile(r"[0-9@]")


def _next_sign(text: str, start: int) -> int:
    match = _SIGN.search(text, start)
    return match.start() if match else -1


def _shape(word: str) -> list[float]:
    """What a word looks like: lengths in steps and the signs it holds."""
    digits = len(_digits(word))
    steps = [digits == 0, digits <= 2, digits <= 4, digits <= 9, digits <= 13, digits <= 19]
    dots = word.count(".")
    return [
        *map(float, steps),
        float("@" in word),
        float(word.startswith("+")),
        float("(" in word or ")" in word),
        float("-" in word),
        float(dots == 1),
        float(dots == 3),
        float(any(c.isalpha() for c in word)),
        float(digits > len(word) // 2),
    ]


def _likeness(word: str) -> str:
    """Words of one key are alike: the same digits, or the same letters and digits."""
    digits = _digits(word)
    if len(digits) >= 7:
        return digits
    plain = "".join(c for c in word.lower() if c.isalnum())
    return plain if "@" in word and len(plain) >= 6 else ""


@dataclass(frozen=True)
class SkipChain:
    """Potentials: labels by features, neighbouring labels, and labels of alike words."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    threshold: float = 0.8
    rounds: int = 12

    def beliefs(self, field: Field) -> np.ndarray:
        """Label probabilities of each node by loopy sum-product messages."""
        unary = field.features @ self.weights
        known = field.evidence >= 0
        unary[known] = -50.0
        unary[np.flatnonzero(known), field.evidence[known]] = 0.0
        unary -= unary.max(axis=1, keepdims=True)
        edges = field.edges
        if not len(edges):
            return _softmax(unary)
        a = np.concatenate([edges[:, 0], edges[:, 1]])
        b = np.concatenate([edges[:, 1], edges[:, 0]])
        forward = np.where(field.skip[:, None, None], self.skip, self.chain)
        pair = np.concatenate([forward, forward.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(a), len(LABELS)))
        for _ in range(self.rounds):
            gathered = unary.copy()
            np.add.at(gathered, b, messages)
            into = gathered[a] - messages[back]
            sent = np.logaddexp.reduce(into[:, :, None] + pair, axis=1)
            sent -= sent.max(axis=1, keepdims=True)
            moved = np.abs(sent - messages).max()
            messages = 0.5 * messages + 0.5 * sent
            if moved < 1e-4:
                break
        gathered = unary.copy()
        np.add.at(gathered, b, messages)
        return _softmax(gathered)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and base spans with those that the field adds."""
        base = base_spans(text)
        field = field_of(text, base)
        if field is None:
            return base, base
        beliefs = self.beliefs(field)
        labels = beliefs.argmax(axis=1)
        sure = (labels > 0) & (field.evidence < 0) & (beliefs.max(axis=1) >= self.threshold)
        added: list[Span] = []
        for k in np.flatnonzero(sure).tolist():
            start, end = field.spans[k]
            kind = LABELS[labels[k]]
            word = text[start:end]
            end = start + len(word.rstrip(".,;:!?"))
            joins = added and added[-1][0] == kind and text[added[-1][2] : start].isspace()
            if joins:
                added[-1] = (kind, added[-1][1], end)
            elif end > start:
                added.append((kind, start, end))
        return base, sorted(base + added, key=_order)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def fit(texts: Iterable[str], steps: int = 300, penalty: float = 1e-3) -> SkipChain:
    """Piecewise training: features on single words, transitions and agreement on edges.

    Labels are the base patterns' findings, which are not features.
    """
    rows, labels = [], []
    chain = np.ones((len(LABELS), len(LABELS)))
    alike = np.ones((len(LABELS), len(LABELS)))
    for text in texts:
        field = field_of(text, base_spans(text))
        if field is None:
            continue
        label = np.maximum(field.evidence, 0)
        rows.append(field.features)
        labels.append(label)
        for counts, edges in ((chain, field.edges[~field.skip]), (alike, field.edges[field.skip])):
            np.add.at(counts, (label[edges[:, 0]], label[edges[:, 1]]), 1)
    weights = np.zeros((FEATURES, len(LABELS)))
    if rows:
        x, y = np.concatenate(rows), np.concatenate(labels)
        target = np.eye(len(LABELS))[y]
        speed = np.zeros_like(weights)
        for _ in range(steps):
            gradient = x.T @ (_softmax(x @ weights) - target) / len(x) + penalty * weights
            speed = 0.9 * speed - 0.5 * gradient
            weights += speed
    else:
        weights[-1, 0] = 5.0  # nothing seen: every word is an ordinary one
    alike += alike.T + AGREEING * np.eye(len(LABELS))
    return SkipChain(weights, _pointwise(chain), _pointwise(alike))


def _pointwise(counts: np.ndarray) -> np.ndarray:
    """Log of joint over independent frequency of two labels, kept within bounds."""
    joint = counts / counts.sum()
    free = joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)
    return np.clip(np.log(joint / free), -4.0, 4.0)


TRAINING_TEXTS = 2_000  # the bound of the sample that potentials are fitted to
TRAINING_LENGTH = 20_000  # and of the texts in it, in code points


def fit_on(docs: DataFrame, texts: int = TRAINING_TEXTS) -> SkipChain:
    """Potentials from at most ``texts`` different texts with digits: those of least hash,
    so any order and partitioning of the documents gives the same model. The driver
    gets hashes first, and then the texts of that sample alone."""
    signed = docs.select(F.col("text").cast("string").alias("text")).where(
        F.col("text").rlike("[0-9]") & (F.length("text") < TRAINING_LENGTH)
    )
    signed = signed.withColumn("mark", F.xxhash64("text"))
    marks = signed.select("mark").distinct().orderBy("mark").limit(texts).collect()
    if not marks:
        return fit([])
    sample = signed.where(F.col("mark") <= marks[-1]["mark"]).groupBy("mark").agg(F.min("text").alias("text"))
    return fit(row["text"] for row in sample.orderBy("mark").collect())


PII = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"


def find_pii(text: Column, model: SkipChain) -> Column:
    """Struct of base counts, the base spans' SHA-256, all spans, and the masked text.

    Spans are ``kind:start:end`` in code points, joined by commas in order of start;
    in the masked text each stretch of spans, also of overlapping ones, is replaced by
    its first kind in brackets. A null text counts as empty and stays null when masked.
    Repeated rows get equal results. A text is searched whole; the field has a node for
    each word with a digit or an at-sign, and memory grows with these.
    """
    names = [part.split()[0] for part in PII.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 3

    @F.arrow_udf(PII)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for raw in utf8(texts):
            text = raw.decode(errors="replace") if raw is not None else None
            base, spans = model.spans(text or "")
            counts = [sum(kind == own for own, _, _ in base) for kind in KINDS]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*counts, digest, joined(spans), mask(text, spans) if spans else None))
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    found = find(text)
    return found.withField("masked", F.coalesce(found["masked"], text))


def mask(text: str | None, spans: list[Span]) -> str | None:
    """The text with ``[KIND]`` in place of each stretch of spans."""
    if not spans:
        return text
    parts, done, k = [], 0, 0
    while k < len(spans):
        kind, start, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < end:
            end = max(end, spans[k][2])
            k += 1
        parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(parts) + text[done:]
