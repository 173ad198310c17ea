"""The registered queries: name, inventory ids, DataFrame form, check in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    ids: tuple[str, ...]
    plan: Plan
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Registered(name, tuple(ids.split()), plan, sql)
        return plan

    return add


def load_all() -> dict[str, Registered]:
    from seriesforge.plans import (  # noqa: F401
        q_documents,
        q_ingest,
        q_joins,
        q_merge,
        q_scalar,
        q_series,
        q_tables,
    )

    return REGISTRY
