"""Helpers for higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Lambda bodies are not searched for common subexpressions, so a value used twice there is
    computed twice, and nesting multiplies that.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def record(**fields: Column) -> Column:
    """A struct with explicit names: an alias on a bare lambda variable does not reach the struct."""
    return F.named_struct(*[x for n, c in fields.items() for x in (F.lit(n), c)])


def first_of_key(entries: Column) -> Column:
    """Map of ``array<struct<k, v>>``; of a repeated key the first entry counts."""
    keys = F.transform(entries, lambda e: e["k"])
    return let(keys, lambda ks: F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(ks, e["k"]) == i + 1)))
