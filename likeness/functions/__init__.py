"""Column expressions shared by the operators."""

from likeness.functions.hashing import (  # noqa: F401
    MERSENNE_PRIME,
    element_hash,
    minhash_params,
    seeded_hash,
)
from likeness.functions.scalar import (  # noqa: F401
    discount,
    ideal_dcg,
    safe_jaccard,
)
