"""DataFrame operators.  Every function takes and returns DataFrames and
leaves physical planning to Catalyst/AQE."""
