"""Deterministic keyed draws.

A random draw is a pure function of a record key: ``u = first 32 bits of md5(key) / 2^32``.
Any executor recomputing a lost partition gets the same value, and plain SQL engines can
compute the same number, so sampled and imputed results are checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def keyed_uniform(salt: str, *cols: str | Column) -> Column:
    """Uniform in [0, 1) from ``md5(salt|col1|col2|...)``."""
    parts = [F.lit(salt)] + [F.col(c) if isinstance(c, str) else c for c in cols]
    hexdigits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)
    return F.conv(hexdigits, 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def keyed_uniform_sql(salt: str, *cols: str) -> str:
    """The same draw as DuckDB SQL text (used by the oracle queries)."""
    inner = ", ".join([f"'{salt}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE))"
