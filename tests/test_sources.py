"""Fixture readers: nulls removed, duplicates kept where they should be,
CSV round trip with float-string ids."""

import os
import tempfile

import pandas as pd

from likeness.sources import files, tables

SF = "/root/testdata/sf0.001"


def test_ratings_raw_keeps_duplicates(spark):
    raw = tables.ratings_raw(spark, SF)
    li = tables.read_table(spark, SF, "lineitem")
    assert raw.count() == li.count()
    r = tables.ratings(spark, SF)
    assert r.count() == raw.select("user_id", "item_id").distinct().count()
    vals = {x["rating"] for x in r.select("rating").distinct().collect()}
    assert vals <= {i / 2 for i in range(1, 11)}


def test_null_keys_removed(spark):
    d = tempfile.mkdtemp(prefix="likeness-src-")
    pd.DataFrame({"doc_id": [1, None, 3], "text": ["a b a", "x", None],
                  "lang": ["en"] * 3, "source": ["s"] * 3, "n_chars": [5, 1, 0]}).to_parquet(
        os.path.join(d, "documents.parquet"))
    out = {(r["user_id"], r["item"], r["rating"]) for r in tables.doc_terms(spark, d).collect()}
    assert out == {(1, "a", 2.0), (1, "b", 1.0)}


def test_empty_string_is_a_word(spark):
    d = tempfile.mkdtemp(prefix="likeness-src-")
    pd.DataFrame({"doc_id": [1], "text": ["a  b\nc"], "lang": ["en"], "source": ["s"],
                  "n_chars": [6]}).to_parquet(os.path.join(d, "documents.parquet"))
    items = {r["item"] for r in tables.doc_terms(spark, d).collect()}
    assert items == {"a", "", "b\nc"}


def test_pair_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="likeness-csv-")
    path = os.path.join(d, "pairs.csv")
    pd.DataFrame({"userId1": ["103191.0", "5.0"], "userId2": [7, 9],
                  "estimated_jaccard": [1.0, 0.5], "user1_ratings": [6, 7],
                  "user2_ratings": [8, 9]}).to_csv(path, index=False)
    got = sorted(map(tuple, files.read_pairs_csv(spark, path).collect()))
    assert got == [(5, 9, 0.5, 7, 9), (103191, 7, 1.0, 6, 8)]


def test_split_sink_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "train"), (1, 2, "val"), (2, 3, "test")],
                               "user_id long, item_id long, split string")
    path = str(tmp_path / "split")
    files.write_split(df, path)
    val = files.read_split(spark, path, "val")
    assert [(r["user_id"], r["item_id"]) for r in val.collect()] == [(1, 2)]
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_top_pairs_sink_one_folder_per_threshold(spark, tmp_path):
    df = spark.createDataFrame(
        [(5, 1, 10, 11, 1.0, 6, 7), (5, 2, 10, 12, 0.9, 6, 8), (50, 1, 20, 21, 1.0, 60, 61)],
        "min_ratings long, rank long, id1 long, id2 long, estimated_jaccard double, n1 long, n2 long")
    path = str(tmp_path / "top")
    files.write_top_pairs(df, path)
    assert sorted(p for p in os.listdir(path) if p.startswith("min_ratings=")) == [
        "min_ratings=5", "min_ratings=50"]
    back = files.read_pairs_csv(spark, os.path.join(path, "min_ratings=5"))
    assert sorted((r["id1"], r["id2"]) for r in back.collect()) == [(10, 11), (10, 12)]
    assert files.result_path("/x", "als_result", rank=10, reg=0.1) == "/x/als_result_rank10_reg0.1"


def test_ratings_file_with_faults(spark, tmp_path):
    good = ["1,10,3.5,99", "2.0,11.00,4,", " 3 , 12 ,0.5,5", f"{2**62},7,1e0,1"]
    bad = {"fields": ["1,2,3,4,5", "1,2"], "userId": ["x,1,1,1", "1.5,1,1,1", ",1,1,1", "99999999999999999999,1,1,1"],
           "movieId": ["1,,1,1", "1,1e3,1,1"], "rating": ["1,1,n/a,1", "1,1,NaN,1", "1,1,,1", "1,1,Infinity,1"]}
    path = tmp_path / "ratings.csv"
    path.write_text("\n".join(["userId,movieId,rating,timestamp", *good, *(x for v in bad.values() for x in v)]) + "\n")
    found = files.read_ratings_csv(spark, str(path))
    rows = sorted(tuple(r)[:3] for r in found.where("reason is null").collect())
    assert rows == [(1, 10, 3.5), (2, 11, 4.0), (3, 12, 0.5), (2**62, 7, 1.0)]
    counts = {r.reason: r["count"] for r in found.groupBy("reason").count().collect() if r.reason}
    assert counts == {k: len(v) for k, v in bad.items()}
    # a query that asks for the good lines' ids alone still sees the wrong number of fields
    assert found.where("reason is null").select("user_id").count() == len(good)


def test_header_with_other_names_is_refused(spark, tmp_path):
    import pytest

    path = tmp_path / "r.csv"
    path.write_text("movieId,userId,rating,timestamp\n1,2,3,4\n")
    with pytest.raises(Exception):
        files.read_ratings_csv(spark, str(path)).collect()


def test_replacing_one_split_leaves_the_others(spark, tmp_path):
    df = spark.createDataFrame([(u, i, s) for u in range(9) for i, s in enumerate(("train", "val", "test"))],
                               "user_id long, item_id long, split string")
    path = str(tmp_path / "split")
    files.write_split(df, path)
    names = lambda s: sorted(os.listdir(os.path.join(path, f"split={s}")))
    before = {s: names(s) for s in ("train", "val", "test")}
    files.replace_split(df.where("split = 'val' and user_id < 4"), path)
    assert names("train") == before["train"] and names("test") == before["test"] and names("val") != before["val"]
    val = files.read_split(spark, path, "val")
    assert val.count() == 4 and files.read_split(spark, path, "train").count() == 9
    scan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in scan
    scanned = {f.split("split=")[1].split("/")[0] for f in val.inputFiles()}
    relation = val._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert "val" in scanned and relation.selectedPartitions().partitionCount() == 1


def test_saving_a_configuration_again_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "results")
    row = lambda x: spark.createDataFrame([(x,)], "ndcg double")
    files.save_result(row(0.1), path, {"rank": 10, "reg": 0.1, "alpha": 40.0})
    files.save_result(row(0.2), path, {"rank": 20, "reg": 0.1, "alpha": None})
    files.save_result(row(0.3), path, {"reg": 0.1, "alpha": 40.0, "rank": 10})
    got = sorted((r["rank"], r.alpha, r.ndcg) for r in files.read_results(spark, path).collect())
    assert got == [(10, 40.0, 0.3), (20, None, 0.2)]
