"""Registered queries: one Spark callable (spark, sf_dir) -> DataFrame per SURVEY §2
operator, each with the DuckDB SQL that must give the same rows.

Every query reads the driver's tables (or views Spark derives from them) in
full. Double outputs are rounded through ``decimal(28,8)`` to 4 places on
both sides (see ``stable_round``) so the engines agree bit for bit; the
library operators themselves keep full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.scalar import sig_round, stable_round

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 4, significant=()) -> DataFrame:
    """Round every double column through a decimal (engine-stable); columns in
    ``significant`` (large magnitudes) keep 9 significant digits instead."""
    def r(f):
        if f.name in significant:
            return sig_round(f"`{f.name}`").alias(f.name)
        return stable_round(f"`{f.name}`", digits).alias(f.name)

    return df.select(
        *[
            r(f) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else df[f"`{f.name}`"]
            for f in df.schema.fields
        ]
    )


def _load_all():
    # Import modules that register queries (side effect: fill QUERIES/ORACLES).
    from . import q_market, q_tone, q_text, q_relational, q_ml  # noqa: F401
