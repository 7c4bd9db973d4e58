from likeness.sources import tables


def test_words_of_documents_with_and_without_their_id_alone(spark, tmp_path):
    rows = [(1, "a  b a"), (2, ""), (3, "x\ny z"), (3, "z z"), (None, "q"), (4, None), (5, " ".join(f"w{i % 900}" for i in range(4000)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.user_id, r["item"]): r.rating for r in tables.doc_terms(spark, str(tmp_path)).collect()}
    want = {}
    for i, text in rows:
        for word in (text.split(" ") if i is not None and text is not None else ()):
            want[i, word] = want.get((i, word), 0) + 1
    assert got == want


def test_only_documents_of_a_repeated_id_are_shuffled(spark, tmp_path):
    spark.createDataFrame([(i, "a b c") for i in range(40)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    df = tables.doc_terms(spark, str(tmp_path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.split("Initial Plan")[0].replace("mapInArrow", "MapInArrow")
