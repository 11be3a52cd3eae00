"""Schema drift between loads of one raw table: a widening lattice and a policy.

A new load's schema is held against the known one (a declared contract, or that
of the table's newest load).  Each column is ``extra``, ``missing``, ``widened``
(the known type fits into the new one, or both into a third), ``narrower`` (the
new type fits into the known one) or ``clash`` (no common type without loss).
The policy says what is done with each kind; whatever happens is written into
the audit.  ``AS_LANDED`` lands every table as it comes and only reports.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# exact steps only: a long does not fit into a double, nor a zoned into an unzoned time
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_STEPS = {("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"),
          ("tinyint", "float"), ("smallint", "float"), ("tinyint", "double"), ("smallint", "double"), ("int", "double")}


def widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds both without loss, or None."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    for x, y in ((a, b), (b, a)):
        if (x.simpleString(), y.simpleString()) in _STEPS:
            return y
        if isinstance(x, T.DecimalType):
            p, s = (y.precision, y.scale) if isinstance(y, T.DecimalType) else (_DIGITS.get(y.simpleString()), 0)
            if p is None:
                continue
            scale, whole = max(x.scale, s), max(x.precision - x.scale, p - s)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if {type(a), type(b)} == {T.IntegerType, T.FloatType}:
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        of = widen(a.elementType, b.elementType)
        return of and T.ArrayType(of, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        k, v = widen(a.keyType, b.keyType), widen(a.valueType, b.valueType)
        return T.MapType(k, v, a.valueContainsNull or b.valueContainsNull) if k and v else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have = {f.name.lower(): f for f in b.fields}
        fields = []
        for f in a.fields:
            g = have.pop(f.name.lower(), None)
            of = f.dataType if g is None else widen(f.dataType, g.dataType)
            if of is None:
                return None
            fields.append(T.StructField(f.name, of, True))
        return T.StructType(fields + [T.StructField(g.name, g.dataType, True) for g in have.values()])
    return None


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every nested value nullable, as files store it."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    return kind


@dataclass(frozen=True)
class DriftPolicy:
    """What happens to drifted columns.

    extra: ``keep`` | ``drop`` | ``reject``; missing: ``absent`` (stays away) |
    ``null`` (a typed NULL column) | ``reject``; widened (and narrower):
    ``as_is`` (lands with its own type) | ``widen`` (lands with the common type) |
    ``reject``; clash: ``as_is`` | ``text`` (lands as string) | ``reject``.
    A rejected table is audited as such and its previous load stays current.
    """

    extra: str = "keep"
    missing: str = "absent"
    widened: str = "as_is"
    clash: str = "as_is"

    def __post_init__(self) -> None:
        allowed = {"extra": ("keep", "drop", "reject"), "missing": ("absent", "null", "reject"),
                   "widened": ("as_is", "widen", "reject"), "clash": ("as_is", "text", "reject")}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name}: {getattr(self, name)!r} is none of {', '.join(values)}")


AS_LANDED = DriftPolicy()
RECONCILE = DriftPolicy(missing="null", widened="widen", clash="reject")


@dataclass(frozen=True)
class Drift:
    """How a schema differs from the known one, and what it is to become."""

    notes: tuple[str, ...]            # '<kind>:<column>[ <known> -> <new>]', in column order
    rejected: bool
    target: T.StructType

    @property
    def text(self) -> str | None:
        return "; ".join(self.notes) or None


def compare(known: T.StructType | None, new: T.StructType, policy: DriftPolicy = AS_LANDED) -> Drift:
    """Drift of ``new`` against ``known`` (None: nothing is known yet).

    Names compare without case.  Two columns of one name leave no way to tell
    them apart: the table is rejected under any policy.
    """
    names = [f.name.lower() for f in new.fields]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        return Drift(tuple(f"repeated:{n}" for n in twice), True, new)
    if known is None:
        return Drift((), False, new)
    notes, rejected, fields = [], False, []
    have = {f.name.lower(): f for f in new.fields}

    def note(kind: str, field: T.StructField, action: str, types: str = "") -> None:
        nonlocal rejected
        notes.append(f"{kind}:{field.name}{types}")
        rejected |= action == "reject"

    for f in known.fields:
        g = have.pop(f.name.lower(), None)
        if g is None:
            note("missing", f, policy.missing)
            if policy.missing == "null":
                fields.append(T.StructField(f.name, f.dataType, True))
            continue
        a, b = nullable(f.dataType), nullable(g.dataType)
        if a == b:
            fields.append(g)
            continue
        of, types = widen(a, b), f" {a.simpleString()} -> {b.simpleString()}"
        if of is None:
            note("clash", g, policy.clash, types)
            fields.append(T.StructField(g.name, T.StringType() if policy.clash == "text" else g.dataType, True))
        else:
            note("narrower" if of == a else "widened", g, policy.widened, types)
            fields.append(T.StructField(g.name, of if policy.widened == "widen" else g.dataType, True))
    for g in have.values():
        note("extra", g, policy.extra)
        if policy.extra == "keep":
            fields.append(g)
    return Drift(tuple(notes), rejected, T.StructType(fields))


def reconciled(df: DataFrame, drift: Drift) -> DataFrame:
    """``df`` in the drift's target schema: columns by name, upcasts, typed NULLs."""
    if df.schema == drift.target:
        return df
    text = {f.name.lower() for f in drift.target.fields if isinstance(f.dataType, T.StringType)}
    cols = [F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name.lower() in text
            and not isinstance(f.dataType, (T.StringType, T.NullType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols).to(drift.target)
