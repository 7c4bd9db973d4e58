"""Fixture tables shared by several reports, written once per input files."""

from __future__ import annotations

import os

from likeness.session import written
from likeness.sources import tables


def docs(spark, sf_dir):
    """doc_terms (user_id, item, rating), written once: the pair checks, the
    random control group and the document split all read it."""
    return written(spark, "doc_terms", [os.path.join(sf_dir, "documents.parquet")], (),
                   lambda: tables.doc_terms(spark, sf_dir))
