"""Column expressions used by staging and unification.

All of these are built-in Spark expressions (no Python UDF), so they stay in
whole-stage codegen and fold into the scan's projection.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# --- fixed values -----------------------------------------------------------
# Surrogate keys follow the common warehouse recipe: md5 over the key parts
# cast to text, parts joined by '-', NULL parts replaced by a marker (only
# used when a key part is NULL; the separator makes non-NULL keys
# byte-identical with keys built by that recipe).
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL_MARKER = "_null_key_part_"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_text(c: Column | str) -> Column:
    """Key normalisation: integer (or any) id -> string."""
    return _col(c).cast("string")


def iso_date(c: Column | str, lenient: bool = False) -> Column:
    """ISO date or datetime text -> date; the time part is dropped.

    Strict (default): malformed text fails the job under ANSI mode.
    Lenient: malformed text becomes NULL (count the rejects with
    :func:`date_rejects`).
    """
    c = _col(c)
    return c.try_cast("date") if lenient else c.cast("date")


def date_rejects(c: Column | str) -> Column:
    """1 when non-NULL text does not parse as a date, else 0 (sum it)."""
    c = _col(c)
    return F.when(c.isNotNull() & c.try_cast("date").isNull(), 1).otherwise(0)


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first || ' ' || last``: NULL if either side is NULL (not concat_ws)."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def first_name(full: Column | str) -> Column:
    """Text before the first space; the whole text if there is none."""
    return F.split_part(_col(full), F.lit(" "), F.lit(1))


def last_name(full: Column | str) -> Column:
    """Everything after the first space; NULL for a single word (or NULL)."""
    full = _col(full)
    return F.when(F.contains(full, F.lit(" ")),
                  F.substr(full, F.position(F.lit(" "), full) + F.lit(1)))


def positive_flag(q: Column | str) -> Column:
    """``q > 0``: NULL and non-positive quantities are false."""
    return F.when(_col(q) > 0, F.lit(True)).otherwise(F.lit(False))


def one_flag(flag: Column | str) -> Column:
    """Only exactly 1 is true; NULL, 0, 2 ... are false (not a boolean cast)."""
    return F.when(_col(flag) == 1, F.lit(True)).otherwise(F.lit(False))


def typed_null(dtype: DataType | str) -> Column:
    """A NULL of a given type, to align a field a source does not have."""
    return F.lit(None).cast(dtype)


def composite_id(*parts: str) -> Column:
    """Readable id of several columns; a NULL part keeps its place."""
    pieces = [F.coalesce(F.col(p).cast("string"), F.lit(SURROGATE_KEY_NULL_MARKER)) for p in parts]
    out = pieces[0]
    for piece in pieces[1:]:
        out = F.concat(out, F.lit(SURROGATE_KEY_SEPARATOR), piece)
    return out


def surrogate_key(*parts: Column | str,
                  separator: str = SURROGATE_KEY_SEPARATOR,
                  null_marker: str = SURROGATE_KEY_NULL_MARKER,
                  framing: str = "separator") -> Column:
    """Deterministic md5 key over N columns.

    ``framing='separator'`` is the usual recipe; parts that hold the separator
    can alias (``('a-b', 'c')`` and ``('a', 'b-c')``), and so can a part equal to
    the NULL marker.  ``framing='length'`` hashes every part behind its length
    in characters, and a NULL as a sign of its own: different part tuples
    never give the same text.

    ``concat`` + ``coalesce`` (never ``concat_ws``, which skips NULLs and so
    makes ``('a', NULL)`` equal ``('a')``).  Cast only integer / string parts:
    text forms of doubles and timestamps differ between engines.
    """
    if framing not in ("separator", "length"):
        raise ValueError(f"framing {framing!r} is neither 'separator' nor 'length'")
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if framing == "length":
            text = _col(p).cast("string")
            pieces.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n;")))
            continue
        if i:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(_col(p).cast("string"), F.lit(null_marker)))
    return F.md5(F.concat(*pieces))


def row_hash(cols: Iterable[Column | str]) -> Column:
    """64-bit content hash of a row, NULL-position aware.

    Spark's hash functions skip NULL inputs, so ``(NULL, 'a')`` and
    ``('a', NULL)`` would collide; the trailing NULL-mask array separates
    them.  Stays JVM-side (no string formatting of values).
    """
    cs = [_col(c) for c in cols]
    return F.xxhash64(*cs, F.array(*[c.isNull() for c in cs]))
