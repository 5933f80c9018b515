from __future__ import annotations

import json
import os
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm import pii
from strata.llm.queries import vocabulary
from strata.llm.quality import LineRules, normal_line
from tests.llm.data import DOCS, components, edited, messy_documents, words
from tests.llm.test_decontaminate import plain as leaks
from tests.llm.test_packing import first_fit
from tests.llm.test_quality import frequent_lines
from tests.llm.test_quality import plain as judged


def corpus():
    rows = messy_documents()
    item = words(700, 40)
    for k in range(6):
        rows.append((900 + k, " ".join(words(710 + k, 60) + edited(item, k, k % 2) + words(720 + k, 60)), "en", "s9", 5))
    for k in range(6):
        text = " ".join(words(730 + k, 70)) + f" mail u{k}@ex{k}.org or +1 212 555 01{k:02d} "
        rows.append((950 + k, text, "en", "s9", 5))
    return rows, [(1, " ".join(item)), (2, " ".join(words(701, 30)))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_equal_plain_models(spark, folder):
    rows, items = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    frequent = frequent_lines(rows, LineRules())
    kept = []
    for doc_id, text, lang, host, _ in rows:
        if judged(text, frequent[host])[-1]:
            lines = [x for x in text.split("\n") if normal_line(x.encode()) not in frequent[host]]
            clean = "\n".join(lines)
            kept.append((doc_id, clean, lang, host, len(clean)))
    after = stages["quality"](spark, docs, folder)
    assert after.columns == docs.columns
    assert Counter(map(tuple, after.collect())) == Counter(kept)

    docs = after.cache()
    after = stages["near_duplicates"](spark, docs, folder)
    labels = components([r[1] for r in kept], 80)
    by_text = dict(zip((r[1] for r in kept), labels))
    left = after.collect()
    assert after.columns == docs.columns
    assert Counter(by_text[r.text] for r in left) == Counter(set(labels))

    docs = after.cache()
    after = stages["decontamination"](spark, docs, folder)
    bad = {doc for doc, *_ in leaks([(r.doc_id, r.text) for r in left], items)}
    assert bad and Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in left if r.doc_id not in bad)

    docs = after.cache()
    after = stages["personal_data"](spark, docs, folder)
    masked = {r.doc_id: r for r in after.collect()}
    assert after.columns == docs.columns
    for r in docs.collect():
        own = masked[r.doc_id]
        for _, a, b in pii.base_spans(r.text):
            assert r.text[a:b] not in own.text
        if not any(c.isdigit() or c == "@" for c in r.text):
            assert own.text == r.text
        assert own.n_chars == len(own.text)

    packed = stages["packing"](spark, after, folder).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(list(masked))
    sizes = Counter(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= first_fit(sizes, corpus_pipeline.CAPACITY)


def test_run_writes_every_stage(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    again = corpus_pipeline.run(spark, folder)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, got.select(*pieces).collect())) == Counter(map(tuple, again.select(*pieces).collect()))


def test_empty_documents(spark, folder, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_contract_of_the_pipeline():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.oracle_sql() == {}
    path = vocabulary("byte_bpe_50k.json")
    assert os.path.exists(path) and json.load(open(path))["model"]["type"] == "BPE"
