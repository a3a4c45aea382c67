"""The query catalogue: one Spark query per operator, keyed by the operator
id of the survey, each with its DuckDB twin where one exists.

Every query reads the whole driver tables (or frames Spark derives from
them). Doubles are rounded to 9 places in both engines: sums of doubles in
different orders differ in the last bits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.plans.driver import driver

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r9(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


def D(spark, sf):
    return driver(spark, sf)


# modules that register queries
from timeloom.plans import q_core, q_domain, q_eval, q_models  # noqa: E402,F401
