"""Registered queries: each one builds its input from the given tables and runs operators on it."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "read_queries", "interval_queries", "coverage_queries", "variant_queries", "calling_queries", "annotation_queries",
    "recalibration_queries", "sv_queries", "vqsr_queries", "cohort_queries", "effect_queries", "table_queries",
]


def load_all():
    for m in MODULES:
        import_module(f"locuswise.plans.{m}")
    from locuswise.plans.registry import REGISTRY

    return REGISTRY
