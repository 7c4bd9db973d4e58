from pyspark.sql import functions as F

from likeness.operators import split


def _written(monkeypatch, module):
    """The names of the tables that ``module`` writes."""
    names, real = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: names.append(name) or real(df, name))
    return names


def test_keys_of_a_split_are_neither_written_nor_shuffled(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 7).alias("user_id"), F.col("id").alias("item_id"))
    names = _written(monkeypatch, split)
    for heavy in (10 ** 6, 20):
        plan = split.assign_split(rows, heavy_rows=heavy)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        dealt = max(i for i, x in enumerate(lines) if "REPARTITION_BY_COL" in x)
        assert any("md5" in x for x in lines[:dealt]) and not any("unhex" in x for x in lines[dealt:])
    assert "keyed-rows" not in names
