"""Documents with everything that operators must bear, and plain models of the operators."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCS + ", kept string, verdict int, shard string, sequence_id string, _host string"


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n)]


def edited(tokens: list[str], seed: int, changes: int) -> list[str]:
    draw = random.Random(seed)
    out = list(tokens)
    for at in draw.sample(range(len(out)), changes):
        out[at] = f"x{seed}y{at}"
    return out


def messy_documents() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, chains of near copies."""
    rows: list[tuple] = []

    def add(text, doc_id="next", source="s0"):
        doc_id = len(rows) + 100 if doc_id == "next" else doc_id
        rows.append((doc_id, text, "en", source, len(text) if text is not None else None))

    for text in (None, None, "", " \n\t ", "one", "one two three", "A b\u00a0c", "\n\n"):
        add(text)
    add("null id text " * 5, doc_id=None)
    add("null id text " * 5, doc_id=None)
    base = words(1, 300)
    for seed in range(30):  # a group of near copies, about 0.8 to 0.9 alike
        add(" ".join(edited(base, seed, 2 + seed % 5)), source=f"s{seed % 3}")
    chain = words(2, 200)
    for step in range(8):  # neighbours are linked, ends are not
        chain = chain[3:] + words(50 + step, 3)
        add(" ".join(chain))
    for _ in range(6):
        add("Copy  of\nTHE same words " + " ".join(words(3, 80)))
    add("copy of the SAME words " + " ".join(words(3, 80)))
    rows += [rows[-1]] * 3
    rows.append((rows[-1][0], "same id, other text " + " ".join(words(4, 70)), "en", None, 1))
    passage = " ".join(words(5, 60))
    for seed in range(6):
        add(" ".join(words(60 + seed, 40)) + "\n" + passage + "\n" + " ".join(words(80 + seed, 45)))
    add(" ".join(words(6, 30_000)))
    add("zz " * 400)
    add("line one here\n" * 30 + " ".join(words(7, 100)))
    return rows


def shingles(text: str | None, width: int = 5) -> frozenset:
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return frozenset()
    span = min(width, len(tokens))
    return frozenset(tuple(tokens[i : i + span]) for i in range(len(tokens) - span + 1))


def components(texts: list[str | None], numerator: int) -> list[int]:
    """Component number of each text by comparing all pairs; -1 without words."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, common in shared.items():
            if 100 * common >= numerator * (len(own) + len(sets[j]) - common):
                parent[root(i)] = root(j)
        for s in own:
            holders[s].append(i)
    return [root(i) if sets[i] else -1 for i in range(len(texts))]
