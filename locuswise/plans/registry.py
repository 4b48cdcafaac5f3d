"""Query registry: name, Spark builder and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from locuswise.plans.fixtures import SQL


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def with_fixtures(names: str, body: str) -> str:
    """Prefix ``body`` (which may open with its own CTEs, written ``x AS (...), ... SELECT``) with fixture CTEs."""
    ctes = [f"{n} AS ({SQL[n]})" for n in _closure(names.split())]
    body = body.strip()
    word = "WITH RECURSIVE" if "/* recursive */" in body else "WITH"
    head = f"{word} " + ",\n".join(ctes) if ctes else word
    if body[:6].upper() == "SELECT":
        return head + "\n" + body if ctes else body
    return head + (",\n" if ctes else " ") + body


def _closure(names: list[str]) -> list[str]:
    needs = {
        "pileup": ["reads"],
        "clean": ["reads", "pileup", "refseq"],
        "ap": ["reads", "pileup", "refseq", "clean"],
        "asites": ["refseq"], "aligned": ["reads"], "cohort": ["genotypes", "variants"], "sites": ["variants"], "gv": ["genotypes", "variants", "cohort"], "exons": ["regions"], "feats": ["regions", "exons"], "dups": ["reads"]}
    out: list[str] = []
    for n in names:
        for m in [*needs.get(n, []), n]:
            if m not in out:
                out.append(m)
    return out


def query(name: str, fixtures: str = "", sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its SQL counterpart over fixture CTEs."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, with_fixtures(fixtures, sql) if sql else None)
        return fn

    return wrap
