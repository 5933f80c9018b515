from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import pii
from tests.llm.data import words

CARD = "4539 1488 0343 6467"


def plain(text):
    """The base patterns as they are worded."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=1000, deadline=None)
@given(st.text(st.sampled_from("ab12345670.@+- ()_%\n\tß😀"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for piece in ("1", "a", "1.", "+1 ", "a@", "1-", "@"):
        pii.base_spans(piece * 60_000)
        pii.SkipChain(np.zeros((pii.FEATURES, 5)), np.zeros((5, 5)), np.zeros((5, 5))).spans(piece * 5_000)


def test_luhn():
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")


def training_texts():
    texts = []
    for k in range(60):
        body = words(k, 30)
        body[5] = f"u{k}.x@mail{k % 7}.example.org"
        body[9] = f"10.{k}.3.{k * 4 % 256}"
        body[13] = f"+1 (212) 555-{1000 + k}"
        body[17] = CARD
        body[21] = str(k * 37)
        texts.append(" ".join(body))
    return texts


def test_repeated_words_take_the_label_of_their_like():
    """A number without its plus sign is a telephone number where it also stands with one."""
    model = pii.fit(training_texts())
    text = "call +12125550187 today , " + " ".join(words(5, 300)) + " again 12125550187 tomorrow"
    base, spans = model.spans(text)
    assert [s[0] for s in base] == ["phone"]
    assert set(base) <= set(spans)
    added = [s for s in spans if s not in base]
    assert [text[a:b] for _, a, b in added] == ["12125550187"] and added[0][0] == "phone"
    alone = "and again 12125550187 tomorrow"
    chance = pii.field_of(alone, [])
    together = pii.field_of(text, base)
    assert model.beliefs(together)[-1, 4] > model.beliefs(chance)[-1, 4]


def test_beliefs_equal_enumeration_on_a_tree():
    """Without loops, propagation is exact."""
    model = pii.fit(training_texts())
    field = pii.field_of("12 3456 789 0", [])
    unary = field.features @ model.weights
    n, k = unary.shape
    total = np.zeros((n, k))
    for labels in np.ndindex(*[k] * n):
        score = sum(unary[i, l] for i, l in enumerate(labels))
        score += sum(model.chain[labels[a], labels[b]] for a, b in field.edges)
        for i, label in enumerate(labels):
            total[i, label] += np.exp(score)
    model = pii.SkipChain(model.weights, model.chain, model.skip, rounds=200)
    assert np.allclose(model.beliefs(field), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_held_out_accuracy():
    """Words of held-out texts, judged without the patterns' evidence."""
    texts = training_texts()
    model = pii.fit(texts[:40])
    right = total = 0
    for text in texts[40:]:
        base = pii.base_spans(text)
        truth = pii.field_of(text, base)
        guess = model.beliefs(pii.field_of(text, [])).argmax(axis=1)
        right += int((guess == np.maximum(truth.evidence, 0)).sum())
        total += len(guess)
    assert right / total > 0.9


def test_messy_documents(clashing, messy_rows, spark):
    model = pii.fit_on(clashing)
    rows = clashing.select("doc_id", "text", pii.find_pii(F.col("text"), model).alias("f")).select("*", "f.*")
    for r in rows.collect():
        base = plain(r.text or "")
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))
        assert (r.masked is None) == (r.text is None)


def test_mask_replaces_stretches():
    text = f"mail a@b.cd, {CARD} or 1.2.3.4!"
    assert pii.mask(text, pii.base_spans(text)) == "mail [EMAIL], [CARD] or [IP]!"
    assert pii.mask(None, []) is None
    overlapping = [("card", 0, 6), ("phone", 3, 9)]
    assert pii.mask("123456789 x", overlapping) == "[CARD] x"


def test_empty_table(no_docs):
    model = pii.fit_on(no_docs)
    assert no_docs.select(pii.find_pii(F.col("text"), model)).count() == 0
    assert model.spans("call +1 212 555 0187")[0] == model.spans("call +1 212 555 0187")[1]


def test_the_sample_does_not_depend_on_partitions(messy):
    first, again = (pii.fit_on(f).weights for f in (messy, messy.repartition(2)))
    assert np.array_equal(first, again)


def test_counts_of_words_in_fields():
    field = pii.field_of("a1 b , 22 33 xx@yy.zzz xx@yy.zzz", [])
    assert Counter(field.skip.tolist()) == {False: 3, True: 1}
