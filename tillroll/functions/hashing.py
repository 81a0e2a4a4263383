"""Deterministic pseudo-random numbers derived from keys.

``unit_hash(k1, k2, ..., seed)`` maps a key to [0, 1): the first 32 bits of
md5 over the '|'-joined key and seed, divided by 2**32.  It is a pure
function of the row, so re-running a task after an executor loss yields the
same value (``rand()`` does not promise that once partitioning changes), and
the same number can be written in any SQL engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_hex(*parts, seed: str | int = "") -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def unit_hash(*parts, seed: str | int = "") -> Column:
    """u in [0, 1) from md5(key|seed); identical in DuckDB as
    ``('0x' || substr(md5(...), 1, 8))::BIGINT / 4294967296``."""
    h = hash_hex(*parts, seed=seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def unit_hash_sql(key_sql: str, seed: str | int) -> str:
    """DuckDB text of :func:`unit_hash` for oracle SQL (key already '|'-joined)."""
    return (f"(('0x' || substr(md5(concat_ws('|', {key_sql}, '{seed}')), 1, 8))::BIGINT"
            f" / 4294967296.0)")
