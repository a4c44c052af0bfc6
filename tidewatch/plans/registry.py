"""Registry of named queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.tables import CTES, Tables
from tidewatch.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 4
# Means of two-digit values often lie halfway between roundings, where the last bit of
# a sum would decide; both engines round from slightly above.
NUDGE = 1e-9


def presentable(df: DataFrame) -> DataFrame:
    """Round doubles and drop the zone from timestamps, for comparison of engines."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c + F.lit(NUDGE), DIGITS)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)


def with_ctes(uses: str, body: str) -> str:
    wanted: list[str] = []

    def need(name: str) -> None:
        if name not in wanted:
            for other in CTES[name][0].split():
                need(other)
            wanted.append(name)

    for name in uses.split():
        need(name)
    if not wanted:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in wanted)
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None, uses: str = "", doubles: str = ""):
    """Register a query; ``doubles`` names the SQL columns to round as Spark's are."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(Tables(prepare(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            text = with_ctes(uses, sql)
            if doubles:
                cut = ", ".join(f'round("{c}" + {NUDGE}, {DIGITS}) + 0.0 AS "{c}"' for c in doubles.split())
                text = f"SELECT * REPLACE ({cut}) FROM (\n{text}\n)"
            ORACLES[name] = text
        return fn

    return register
