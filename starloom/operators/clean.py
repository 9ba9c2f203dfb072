"""Cleaning as one declared sequence of steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from starloom.operators.columns import Cast, cast_schema, fill
from starloom.operators.keys import dedupe
from starloom.operators.predicates import drop_nulls, drop_values


@dataclass(frozen=True)
class CleanSpec:
    """Cast, drop rows with missing or sentinel values, dedupe, fill; in that order.

    ``dedupe_order`` makes the surviving copy repeatable.
    """

    casts: Mapping[str, Cast] = field(default_factory=dict)
    required: Sequence[str] = ()
    sentinels: Mapping[str, Any] = field(default_factory=dict)
    dedupe_keys: Sequence[str] = ()
    dedupe_order: Sequence[str | Column] | None = None
    defaults: Mapping[str, Any] = field(default_factory=dict)


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    out = cast_schema(df, spec.casts) if spec.casts else df
    if spec.required:
        out = drop_nulls(out, spec.required)
    for col, value in spec.sentinels.items():
        out = drop_values(out, [col], value)
    if spec.dedupe_keys:
        out = dedupe(out, spec.dedupe_keys, spec.dedupe_order)
    return fill(out, spec.defaults) if spec.defaults else out
