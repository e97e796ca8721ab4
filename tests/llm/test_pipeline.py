"""Every stage on what its predecessor kept, against brute force over the smallest test tables."""

import os

import pytest
import test_decontamination
import test_line_dedup
import test_ngram_jaccard_join
import test_packing

import corpus_pipeline
from cardledger.llm import line_dedup, packing, quality_rules
from cardledger.llm.queries import table
from cardledger.llm.texts import fold_words
from cardledger.sources.scratch import saved

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing",
    ]
    raw = table(spark, SF_DIR, "documents")
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = saved(stages[0](spark, raw, SF_DIR), "stage")
    assert kept.columns == raw.columns
    models = quality_rules.train(*quality_rules.labelled_rows(raw, table(spark, SF_DIR, "labels")))
    before = by_id(raw)
    verdict = quality_rules.judge([(r.text or "").encode() for r in before.values()], models)["kept"]
    assert set(by_id(kept)) == {i for i, ok in zip(before, verdict) if ok}

    lined = saved(stages[1](spark, kept, SF_DIR), "stage")
    assert lined.columns == raw.columns
    before = dict(sorted(by_id(kept).items()))
    want = dict(zip(before, test_line_dedup.brute([r.text for r in before.values()])))
    want = {i: text for i, (text, _, gone) in want.items() if not gone or fold_words(text.encode())}
    assert {i: r.text for i, r in by_id(lined).items()} == want

    single = saved(stages[2](spark, lined, SF_DIR), "stage")
    assert single.columns == raw.columns
    before = dict(sorted(by_id(lined).items()))
    groups = test_ngram_jaccard_join.brute(list(before), [r.text for r in before.values()])
    assert set(by_id(single)) == {group for _, _, group, _ in groups}

    clean = saved(stages[3](spark, single, SF_DIR), "stage")
    assert clean.columns == raw.columns
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    hit = {i: test_decontamination.brute(r.text, items, 10)[-1] for i, r in by_id(single).items()}
    assert set(by_id(clean)) == {i for i, h in hit.items() if not h}

    rows = stages[4](spark, clean, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(by_id(clean))
    test_packing.check(rows, packing.SIZE)
    assert line_dedup.MIN_WORDS > 1

    again = corpus_pipeline.run(spark, SF_DIR).select(*rows[0].__fields__).collect()
    assert sorted(again) == sorted(rows)


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF_DIR, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
