"""The corpus pipeline, stage by stage, against what each stage must keep."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
from panelspark.llm import langid, tokens, toxicity
from test_llm_operators import brute_classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage, written and read as the driver does."""
    out = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{out}/{name}")
        after = spark.read.parquet(f"{out}/{name}")
        kept.append((docs, after))
        docs = after
    return kept


def test_stage_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "packing"]
    for before, after in stages[:-1]:
        assert sorted(before.columns) == sorted(after.columns)
        assert before.count() >= after.count() > 0
        assert after.join(before, before.columns, "left_semi").count() == after.count()


def test_language_stage_rejects_only_unidentified_texts(stages):
    before, after = stages[0]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    model = langid.learn(before)
    floors = langid.learn_floors(before, model)
    want = set()
    for r in before.collect():
        best, score, ngrams = model.nearest([r.text])
        size = [k for k, n in enumerate(langid.SIZES) if 2**n <= ngrams[0]]
        if best[0] < 0 or size and score[0] < floors[best[0], size[-1]]:
            want.add(r.doc_id)
    assert gone == want and len(gone) <= 0.001 * before.count() + sum(not r.text for r in before.collect())


def test_toxicity_stage(spark, stages):
    before, after = stages[1]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lexicon = toxicity.learn(before, labels)
    toxic = {r.doc_id for r in toxicity.score_toxicity(before, lexicon).collect() if r.predicted}
    left = {r.doc_id for r in after.collect()}
    assert toxic and left == {r.doc_id for r in before.collect()} - toxic
    label = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [i for i in label if not label[i] and i in {r.doc_id for r in before.collect()}]
    assert len(left.intersection(clean)) >= 0.99 * len(clean)


def test_one_document_of_each_class_stays(stages):
    before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(brute_classes(rows)))


def test_packing_holds_every_id_once(stages):
    before, after = stages[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    ids = {d: len(e.ids) + 1 for d, e in zip(texts, tokens.library("byte_bpe_50k.json").encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    spans = {}
    for r in after.collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.length))
    assert set(spans) == set(ids)
    for d, parts in spans.items():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [s for s, _ in parts] == [0, *ends[:-1].tolist()] and ends[-1] == ids[d]


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    done = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect())
    assert done == sorted(tuple(r) for r in stages[-1][1].select("doc_id", "doc_tokens").distinct().collect())
    assert set(columns) <= set(stages[-1][1].columns)


def test_pipeline_on_difficult_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows; no labels of either kind."""
    rows = [(1, "a few words in here", "en"), (1, "a few words in here", "en"), (2, None, "en"), (3, "", None), (None, "some words", "en"), (4, "x " * 50_000, "en")]
    path = str(tmp_path)
    frame = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    found = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in found.collect()} == {1, None, 4}
    empty = str(tmp_path / "none")
    frame.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
