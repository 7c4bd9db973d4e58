import corpus_pipeline as cp
from likeness.llm import near_duplicates as nd
from likeness.llm.common import materialize, table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, TEXTS, docs
from tests.llm.test_near_duplicates import brute


def test_stages_on_the_whole_table(spark):
    d = table(spark, SF_ORACLE, "documents")
    good = {r.doc_id for r in table(spark, SF_ORACLE, "labels").where("quality = 1").collect()}
    before = {r.doc_id: r.text for r in d.collect()}
    for name, stage in cp.STAGES[:-1]:
        was, d = before, materialize(stage(spark, d, SF_ORACLE), name)
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        before = {r.doc_id: r.text for r in d.collect()}
        assert set(before) <= set(was) and len(before) == d.count()
        if name == "quality":
            assert len(good & set(before)) >= 0.95 * len(good) and len(before) < len(was)
        if name == "near_duplicates":
            kept = {i for i, (_, root) in brute(was, words=5).items() if i == root}
            assert set(before) == kept
        if name == "secrets":
            assert set(before) == set(was) and any(before[i] != was[i] for i in was)
    out = cp.STAGES[-1][1](spark, d, SF_ORACLE)
    assert {r.doc_id for r in out.collect()} == set(before)


def test_edge_rows_and_empty_table(spark):
    d = docs(spark)
    for name, stage in cp.STAGES:
        d = materialize(stage(spark, d, SF_ORACLE), name)
        if name != "packing":
            assert d.columns == DOCS.names
    d = spark.createDataFrame([], DOCS)
    for name, stage in cp.STAGES:
        d = materialize(stage(spark, d, SF_ORACLE), name)
        assert d.count() == 0


def test_one_row_of_each_group_stays(spark):
    d = docs(spark, TEXTS + ["a b c d e f g", "A B c d e f g"])
    out = nd.keep_one(d.union(d))
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    gone = {14, 16}     # "same text twice" and the copy that differs in case
    assert ids == [i for i in range(len(TEXTS) + 2) if i not in gone]
