"""Sources and sinks: driver tables, derived interaction fixtures, CSV I/O."""

from likeness.sources.tables import (  # noqa: F401
    doc_terms,
    ratings,
    ratings_raw,
    read_table,
    tags,
)
from likeness.sources.files import (  # noqa: F401
    read_pairs_csv,
    read_split,
    result_path,
    write_csv,
    write_split,
    write_top_pairs,
)
