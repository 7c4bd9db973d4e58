"""likeness: Spark-native similarity and recommendation analytics over
interaction tables ``(entity, item, value)``.

Layout
------
sources/    table readers, derived fixtures, CSV/Parquet sinks
functions/  column expressions (element hash, MinHash parameters, NDCG terms)
operators/  DataFrame operators (signatures, LSH, pair statistics, sampling,
            splits, popularity, ranking metrics, ALS)
plans/      the registered queries and their DuckDB oracle text
"""

__all__ = ["session"]
