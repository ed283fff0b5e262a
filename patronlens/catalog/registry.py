"""Named queries: a Spark build, its output columns, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]

_SQL_TYPES = {"long": "BIGINT", "int": "INTEGER", "str": "VARCHAR", "date": "DATE", "bool": "BOOLEAN"}
_SPARK_TYPES = {"long": "bigint", "int": "int", "str": "string", "date": "date", "bool": "boolean"}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(":")) for part in spec.split(",")]


@dataclass(frozen=True)
class Query:
    """``columns`` is 'name:type, ...'; type double may end in its digits (double2)."""

    name: str
    columns: str
    build: Build
    sql: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        out = []
        for name, kind in _columns(self.columns):
            ref = f"`{name}`"
            if kind.startswith("double"):
                out.append(f"round(CAST({ref} AS DOUBLE), {kind[6:] or 4}) AS {ref}")
            else:
                out.append(f"CAST({ref} AS {_SPARK_TYPES[kind]}) AS {ref}")
        return self.build(spark, folder).selectExpr(*out)

    def check_sql(self) -> str | None:
        if self.sql is None:
            return None
        out = []
        for name, kind in _columns(self.columns):
            if kind.startswith("double"):
                out.append(f'round(CAST("{name}" AS DOUBLE), {kind[6:] or 4}) AS "{name}"')
            else:
                out.append(f'CAST("{name}" AS {_SQL_TYPES[kind]}) AS "{name}"')
        return f"SELECT {', '.join(out)} FROM ({self.sql}) checked"


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register the decorated build under ``name``."""

    def keep(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, columns, build, sql)
        return build

    return keep
