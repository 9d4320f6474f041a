"""Register, SQL agreement on sf0.001, and the pipeline's stages."""

import pytest
from oracle_check import compare, duck

import __spark_entry__
import corpus_pipeline
from tastegraph.llm import catalog, linededup, mixing

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(n for n, sql in catalog.oracle_sql().items() if sql))
def test_sql_agrees(spark, name):
    res = compare(spark, SMALL, name, duck(SMALL))
    assert res["status"] == "OK", res


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_return_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns, name


def test_toxicity_stage_keeps_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    gone = stages["documents"].join(stages["toxicity"], "doc_id", "left_anti")
    marks = [r.toxic for r in gone.join(labels, "doc_id").where("toxic is not null").collect()]
    assert sum(marks) >= 0.9 * len(marks)


def test_line_stage_changes_texts_only(stages):
    assert ids(stages["line_dedup"]) == ids(stages["toxicity"])
    want = {r.doc_id: r.text for r in linededup.dedup_lines(stages["toxicity"]).collect()}
    assert {r.doc_id: r.text for r in stages["line_dedup"].collect()} == want
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"].collect())


def test_near_stage_keeps_one_of_each_class(stages):
    from test_duplicates import near_truth

    rows = [(r.doc_id, r.text) for r in stages["line_dedup"].collect()]
    assert ids(stages["near_duplicates"]) == sorted({c for c, _, _ in near_truth(rows).values()})


def test_mix_stage_repeats_rows(stages):
    taken = {r.doc_id: (r.taken // r.size if r.size else 0) for r in mixing.mix(stages["near_duplicates"]).collect()}
    assert ids(stages["mix"]) == sorted(i for i, n in taken.items() for _ in range(n))


def test_piece_stage_encodes_every_row(stages):
    assert ids(stages["pieces"]) == ids(stages["mix"])
    assert all(r.n_pieces == len(r.ids) for r in stages["pieces"].collect())


def test_run_is_the_stages(spark, stages):
    assert ids(corpus_pipeline.run(spark, SMALL)) == ids(stages["pieces"])
