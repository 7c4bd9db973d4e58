from likeness.operators import buckets


def test_cells_are_dealt_to_tasks_by_their_members(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 4)
    sig = [(i, [i % 2] * 128, [1], [i]) for i in range(60)]
    groups = spark.createDataFrame(sig, "group_id long, sig array<long>, e array<long>, lo array<long>")
    found = buckets.all_pairs(groups)
    assert found.rdd.getNumPartitions() > 8 * 2
    assert found.count() == 2 * (30 * 29 // 2)
