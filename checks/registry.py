"""Pairs of a Spark query and its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .views import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return keep


def _used(sql: str) -> list[str]:
    """Views a text names, each after those it needs."""
    out: list[str] = []
    for name, body in SQL_VIEWS.items():
        if re.search(rf"\b{name}\b", sql):
            for inner in [*_used(body), name]:
                if inner not in out:
                    out.append(inner)
    return out


def with_views(sql: str) -> str:
    body = sql.strip()
    views = [f"{name} AS ({SQL_VIEWS[name].strip()})" for name in _used(body)]
    if body.upper().startswith("WITH "):
        views.append(body[5:])
        return "WITH " + ",\n".join(views)
    return ("WITH " + ",\n".join(views) + "\n" + body) if views else body


def rounded(c: Column, digits: int) -> Column:
    """Half away from zero on the scaled double, as SQL's ``round`` does it;
    adding 0 turns a negative zero into zero."""
    scale = F.lit(10.0**digits)
    return F.signum(c) * (F.floor(F.abs(c) * scale + 0.5) / scale) + F.lit(0.0)


def plain(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """Widest number types; doubles rounded, so that the order in which two
    engines add up does not show."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType) and digits is not None:
            c = rounded(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)
