"""Registry of named queries over the driver tables.

A query is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
semantics are expressible in plain SQL, the equivalent DuckDB SQL string that
serves as the correctness oracle.  Keys are the lower-case inventory id plus
a short name, so a key leads straight back to its inventory row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so that its queries register themselves."""
    import importlib
    import pkgutil

    import quarry.plans as pkg

    for mod in pkgutil.iter_modules(pkg.__path__):
        if mod.name.startswith("q_"):
            importlib.import_module(f"quarry.plans.{mod.name}")
    return REGISTRY


def normalize_types(df: DataFrame) -> DataFrame:
    """Widen top-level int/short/byte columns to long and float to double,
    the types the SQL oracle reports for the same values."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ByteType, FloatType, IntegerType, ShortType

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
