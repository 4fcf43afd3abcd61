"""Column functions for JSON-path extraction and the scalar casts the
staging models apply.  All are built-in Spark expressions (codegen'd,
JVM-side); nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reference strips this prefix from every reference string.
URN_PREFIX = "urn:uuid:"


def json_scalar(v: Column | str, path: str) -> Column:
    """``json_extract_scalar`` semantics on a VARIANT column.

    Missing path -> NULL, JSON null -> NULL, scalar -> its text, and an
    object or array at the path -> NULL.  ``try_variant_get(...,
    'string')`` renders objects/arrays as JSON text, so those are caught
    by a type probe that only runs when the text starts with ``{`` or
    ``[`` (the common scalar case pays nothing extra).
    """
    v = F.col(v) if isinstance(v, str) else v
    s = F.try_variant_get(v, path, "string")
    nested = F.schema_of_variant(F.try_variant_get(v, path, "variant")).rlike("^(OBJECT|ARRAY)")
    return (F.when(F.substring(s, 1, 1).isin("{", "[") & nested, F.lit(None).cast("string"))
            .otherwise(s))


def guard_scalar(text: Column, v: Column | str, path: str) -> Column:
    """Second half of ``json_scalar`` for an already extracted ``text``
    (``try_variant_get(v, path, 'string')``): NULL when the value at the
    path is an object or array.  Lets a projection extract each path once
    and reference the text twice without re-walking the variant."""
    v = F.col(v) if isinstance(v, str) else v
    nested = F.schema_of_variant(F.try_variant_get(v, path, "variant")).rlike("^(OBJECT|ARRAY)")
    return F.when(F.substring(text, 1, 1).isin("{", "[") & nested, F.lit(None).cast("string")).otherwise(text)


def strip_ref(c: Column) -> Column:
    """``REPLACE(ref, 'urn:uuid:', '')`` - every occurrence, NULL stays NULL."""
    return F.replace(c, F.lit(URN_PREFIX), F.lit(""))


def _as(kind: str):
    return lambda s, lenient=False: s.try_cast(kind) if lenient else s.cast(kind)


def date_prefix(c: Column, lenient: bool = False) -> Column:
    """``CAST(SUBSTR(x, 1, 10) AS DATE)``: the written local date, offset dropped."""
    return CASTS["date"](F.substring(c, 1, 10), lenient)


# kind -> (text, lenient) -> typed value; strict casts fail on bad text
CASTS = {
    "date": _as("date"),
    "date10": date_prefix,
    "ts": _as("timestamp"),  # an instant: Z and offsets are honoured
    "double": _as("double"),
    "int": _as("int"),
}


def age_in_years(birth: Column, at: Column) -> Column:
    """``DATE_DIFF('year', birth, at)``: elapsed whole years, truncated
    toward zero (negative when birth is after ``at``).  A birthday is the
    birth date moved by whole years, so one of February 29 falls on the 28th
    in other years."""
    first, last = F.least(birth, at), F.greatest(birth, at)
    years = F.year(last) - F.year(first)
    elapsed = years - (F.add_months(first, years * 12) > last).cast("int")
    both = birth.isNotNull() & at.isNotNull()  # least and greatest skip nulls
    return F.when(both, F.when(at >= birth, elapsed).otherwise(-elapsed)).cast("long")
