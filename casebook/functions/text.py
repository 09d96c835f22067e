"""Text helpers. An empty string and NULL count as the same missing value on read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that trimming removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def filled(value: Column) -> Column:
    """The value, or NULL where it is the empty string."""
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[filled(v) for v in values], F.lit(""))


def is_filled(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def rstrip(value: Column, chars: str = WHITESPACE) -> Column:
    return F.rtrim(value, F.lit(chars))


def join_filled(separator: str, *values: Column) -> Column:
    """Join the values that are not empty; the empty string when none is left."""
    return F.concat_ws(separator, *[filled(v) for v in values])


def non_empty_parts(value: Column, pattern: str = "_") -> Column:
    """Split, strip every part and drop the empty ones."""
    return F.filter(F.transform(F.split(value, pattern), strip), lambda part: part != "")


def safe_date(value: Column) -> Column:
    """First ten characters as a date; anything that is not a date becomes NULL."""
    return F.try_to_date(F.substring(value, 1, 10), "yyyy-M-d")


def name_hints(project_name: Column) -> Column:
    """Contact and colleague named in `Deliverable_Contact_Colleague` project names."""
    parts = non_empty_parts(F.coalesce(project_name, F.lit("")))
    contact = F.when(F.size(parts) >= 2, F.get(parts, 1)).otherwise("")
    colleague = F.when(F.size(parts) >= 3, F.get(parts, 2)).otherwise("")
    return F.struct(contact.alias("contact"), colleague.alias("colleague"))


# Fixed value: a name segment made of one to three capitalised words.
PERSON_SEGMENT = r"(?U)^[A-ZŁŻŚĆ][\w'’.-]*(?:\s+[A-ZŁŻŚĆ][\w'’.-]*){0,2}$"


def clean_project_name(project_name: Column) -> Column:
    """Drop the later segments of a project name that read like people's names."""
    name = F.coalesce(project_name, F.lit(""))
    parts = non_empty_parts(name)
    deliverable = F.filter(
        parts,
        lambda part, at: (at == 0) | part.rlike(r"(?U)\d") | ~part.rlike(PERSON_SEGMENT),
    )
    return F.when(F.size(parts) <= 1, name).otherwise(F.array_join(deliverable, " "))
