"""Fill-in-middle against slices of Python strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import infill as im
from strata.llm.infill import FORMS, Infill, infill, restore


def model(doc_id, text, rules=Infill()):
    text = text or ""
    key = "" if doc_id is None else doc_id
    seed = hashlib.sha256(f"{rules.salt}{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(seed[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in rules.markers) or h3 % 100 >= rules.plain_from:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, s, m = rules.markers
    if h4 % 100 < rules.spm_below:
        return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def odd_texts(seed, n):
    draw = random.Random(seed)
    letters = ["a", "é", "漢", "😀", "<", "P>", "S", ">M", "\n", "\x00", "<M"]
    texts = []
    for _ in range(n):
        text = "".join(draw.choices(letters, k=draw.choice([0, 1, 2, 5, 40, 300])))
        texts.append(draw.choice([text, text, text, text + draw.choice(Infill().markers), None]))
    return texts


def run(spark, rows, rules=Infill()):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = docs.select("doc_id", "text", infill(F.col("doc_id"), F.col("text"), rules).alias("m"))
    made = made.select("doc_id", "text", "m.*")
    return made.withColumn("back", restore(F.col("output"), F.col("form"), rules)).collect()


def test_equals_slices_and_restores(spark):
    rows = list(enumerate(odd_texts(1, 600))) + [(None, "no id"), (7, "twice"), (7, "twice")]
    found = run(spark, rows)
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[2:7] == model(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in found} == set(FORMS)


def test_other_markers_and_shares(spark):
    rules = Infill(("[prefix]", "→", "{m}"), plain_from=100, spm_below=60, salt="x")
    rows = [(i, t) for i, t in enumerate(odd_texts(2, 200) + ["[prefix] here", "[prefix", "→"])]
    for r in run(spark, rows, rules):
        assert tuple(r)[2:7] == model(r.doc_id, r.text, rules)
        assert r.back == (r.text or "")


def test_messy_documents(messy_rows, clashing):
    made = clashing.select("doc_id", "text", infill(F.col("doc_id"), F.col("text")).alias("m"))
    back = made.select("*", restore(F.col("m.output"), F.col("m.form")).alias("back")).collect()
    assert len(back) == len(messy_rows)
    for r in back:
        assert tuple(r.m) == model(r.doc_id, r.text) and r.back == (r.text or "")


def test_empty_table_and_null_outputs(spark, no_docs):
    made = no_docs.select(infill(F.col("doc_id"), F.col("text")).alias("m"))
    assert made.collect() == []
    nulls = spark.createDataFrame([(None, "psm"), ("kept", None)], "o string, f string")
    got = nulls.select(restore(F.col("o"), F.col("f")).alias("t"))
    with pytest.raises(Exception, match="without its three markers"):
        got.where("f is not null").collect()
    assert [r.t for r in got.where("f is null").collect()] == ["kept"]


@pytest.mark.parametrize("window", [1, 3, 7, 1000])
def test_windows_and_slices_change_nothing(monkeypatch, window):
    monkeypatch.setattr(im, "WINDOW", window)
    texts = odd_texts(3, 300)
    array = pa.array(["before", *texts], pa.string()).slice(1)
    seeds = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i in range(len(texts))]
    drawn = np.array([[int(s[8 * k : 8 * k + 8], 16) for s in seeds] for k in range(4)])
    columns = im.rewritten(array, drawn, Infill())
    assert list(zip(*(c.to_pylist() for c in columns))) == [model(i, t) for i, t in enumerate(texts)]
    codes = np.array([FORMS.index(f) for f in columns[1].to_pylist()])
    assert im.restored(columns[4], codes, Infill()).to_pylist() == [t or "" for t in texts]
    monkeypatch.setattr(im, "SLICE", 100)
    ranges = list(im.slices(array))
    assert [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]] and ranges[-1][1] == len(texts)


def test_overlapping_markers_are_refused():
    for markers in (("<P>", "<P>", "<M>"), ("<P", "<P>", "<M>"), ("ab", "bc", "x"), ("", "a", "b"), ("aba", "x", "y")):
        with pytest.raises(ValueError, match="markers"):
            Infill(markers)
