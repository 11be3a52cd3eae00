"""Scalar column expressions (all built-in Spark functions)."""

from unilake.functions.exprs import (  # noqa: F401
    date_rejects,
    first_name,
    full_name,
    iso_date,
    last_name,
    one_flag,
    positive_flag,
    row_hash,
    surrogate_key,
    to_text,
    typed_null,
)
