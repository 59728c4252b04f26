"""Every query of the library and its SQL twin, by name."""

from __future__ import annotations

from .bindings import WITH, Tables

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None, extra: str = ""):
    """Register a function of Tables as query `name`; sql follows the canonical CTEs (and `extra` ones)."""

    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = WITH + (", " + extra if extra else "") + "\n" + sql
        return build

    return add


def load() -> None:
    """Import the modules that register queries."""
    from . import curve_plans, forecast_plans, report_plans, shape_plans, slot_plans, source_plans, streaming_plans, table_plans, time_plans, window_plans  # noqa: F401
