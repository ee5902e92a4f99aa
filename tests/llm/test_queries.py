"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from checks.compare import compare
from curbsight.llm import decontamination, line_dedup, near_dedup
from curbsight.llm.oracle import ORACLE
from curbsight.llm.registry import QUERIES
from tests.llm.conftest import documents, prose

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLE[name]) == ""


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_are_the_operators_on_what_is_left(spark, tmp_path):
    """Good texts, junk, copies and a benchmark passage, followed through all stages."""
    item = prose(700, 30)
    rows = [(i, prose(i, 90)) for i in range(60)]
    rows += [(100 + i, prose(200 + i, 60).replace(" ", "$$$ ").upper()) for i in range(60)]
    rows += [(200, rows[3][1]), (201, rows[4][1].replace("the", "thee", 1)),
             (202, " ".join([prose(300, 40), item, prose(301, 40)])), (203, prose(5, 90) + " " + prose(400, 70))]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], shape)
    labels = spark.createDataFrame([(i, int(i < 100 or i >= 200), 0) for i, _ in rows],
                                   "doc_id long, quality int, toxic int")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    states = [docs]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{number}")
        stage(spark, states[-1], sf).write.parquet(path)
        states.append(spark.read.parquet(path))
        if number < 4:
            assert states[-1].columns == docs.columns
    good, cut, single, clean, packed = states[1:]
    assert {r["doc_id"] for r in good.collect()} == {i for i, _ in rows if i < 100 or i >= 200}
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[200] == "" and texts[203] == prose(400, 70) and texts[202] == dict(rows)[202]
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    assert {r["doc_id"] for r in single.collect()} >= {*range(60), 200, 202, 203}
    assert {r["doc_id"] for r in single.collect()} - {r["doc_id"] for r in clean.collect()} == {202}
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in clean.collect()}
    whole = corpus_pipeline.run(spark, sf).drop("sequence_id", "offset")
    assert sorted(whole.collect()) == sorted(packed.drop("sequence_id", "offset").collect())


def test_stages_of_an_empty_table(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    sf = str(tmp_path)
    spark.createDataFrame([], shape).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_plans_have_no_cross_join(spark):
    docs = documents(spark, [(i, prose(i % 3, 60)) for i in range(6)])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for frame in (line_dedup.dedup_lines(docs), near_dedup.near_duplicates(docs),
                  decontamination.find_benchmark(docs, items, ["doc_id"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


#: Names that operators and stages use for columns of their own.
USED = ("key", "row", "node", "score", "predicted", "kept", "class_id", "root", "n_removed", "starts", "n_words", "n_hit", "spans",
        "items", "contaminated", "kept_text", "document", "_row", "_rest", "_text", "_no", "_id", "_key", "piece", "start",
        "length", "sequence_id", "offset", "ids", "bucket", "features", "label")


def test_stages_keep_columns_with_names_of_their_own(spark, tmp_path):
    item = prose(700, 30)
    rows = [(i, prose(i, 80)) for i in range(40)] + [(100 + i, prose(200 + i, 60).replace(" ", "$$$ ").upper()) for i in range(40)]
    rows += [(200, rows[3][1]), (202, " ".join([prose(300, 40), item, prose(301, 40)])), (203, None)]
    shape = "doc_id long, text string, n_chars long" + "".join(f", `{c}` string" for c in USED)
    docs = spark.createDataFrame([(i, t, len(t or ""), *(f"{c} of {i}" for c in USED)) for i, t in rows], shape)
    sf = str(tmp_path)
    spark.createDataFrame([(i, int(i < 100 or i >= 200), 0) for i, _ in rows], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(f"{sf}/stage{number}")
        left = spark.read.parquet(f"{sf}/stage{number}")
        assert left.schema == docs.schema, name
        for r in left.collect():
            assert [r[c] for c in USED] == [f"{c} of {r['doc_id']}" for c in USED], name
        assert 20 < left.count() <= len(rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in rows}
    found = decontamination.contaminated(decontamination.find_benchmark(
        docs, spark.read.parquet(f"{sf}/benchmark.parquet"), docs.columns)).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} == {202} and len(found[0]["key"]) > 3
