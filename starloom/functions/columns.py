"""Expressions shared by several operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def combine(conditions: Iterable[Column], how: str) -> Column:
    """AND for ``how="all"``, OR for ``how="any"``."""
    if how not in ("all", "any"):
        raise ValueError(f"how must be 'all' or 'any', not {how!r}")
    return (all_of if how == "all" else any_of)(conditions)


def normalise_text(c: Column | str) -> Column:
    """The matching form of free text: lower case, outer spaces removed."""
    return F.trim(F.lower(column(c)))


def concat_key(*parts: Column | str, digits: int | None = None) -> Column:
    """``a_b`` text key; NULL when any part is NULL.

    Floats print differently from doubles, so both sides of a join must build
    the key from one type; ``digits`` fixes the printed precision instead.
    """
    cols = [column(p) for p in parts]
    if digits is None:
        texts = [F.trim(c.cast("string")) for c in cols]
    else:
        texts = [c.cast(f"decimal(38,{digits})").cast("string") for c in cols]
    joined = [texts[0]]
    for t in texts[1:]:
        joined += [F.lit("_"), t]
    return F.concat(*joined)


def text_identifier(cols: Iterable[str], sep: str = "-") -> Column:
    """Column values joined with ``sep``; NULLs are skipped, so rows may collide."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def hash_identifier(cols: Iterable[str]) -> Column:
    """Collision-free identity of a row: digest of its JSON, NULLs included."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def month_start(c: Column | str) -> Column:
    return F.trunc(column(c), "month")


def clock_text(c: Column | str, pattern: str = "H:mm") -> Column:
    """``9:05`` as ``09:05:00``; NULL where the text is no time of day."""
    return F.date_format(F.try_to_timestamp(column(c), F.lit(pattern)), "HH:mm:ss")


def iso_date(c: Column | str) -> Column:
    """Date of an ISO date or date-time text; NULL where it is malformed."""
    return column(c).try_cast("date")
