"""Column expressions for derived features (JVM-side, no UDFs)."""

from __future__ import annotations

import hashlib

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token(c: str | Column, n: int) -> Column:
    """n-th whitespace-separated token (0-based); null when absent (FUN-1)."""
    return F.get(F.split(F.trim(col_(c)), r"\s+"), n)


def ym_year(c: str | Column) -> Column:
    """First four characters of a yyyymm value as text (FUN-2)."""
    return F.substring(col_(c).cast("string"), 1, 4)


def ym_month(c: str | Column) -> Column:
    """Characters after the fourth of a yyyymm value as text (FUN-2)."""
    return F.substr(col_(c).cast("string"), F.lit(5))


def in_list_flag(c: str | Column, values: Iterable) -> Column:
    """1 when the value is in the list, else 0; null counts as not in (FUN-3/FIL-5)."""
    return F.coalesce(col_(c).isin(list(values)), F.lit(False)).cast("int")


def at_least_flag(c: str | Column, threshold) -> Column:
    """1 when ``c >= threshold`` else 0; null gives 0 (FUN-4)."""
    return F.coalesce(col_(c) >= F.lit(threshold), F.lit(False)).cast("int")


def epoch_seconds(c: str | Column) -> Column:
    """Timestamp (NTZ) or date-like text to epoch seconds as double (FUN-6).

    Time-zone free: difference to 1970-01-01 00:00 of the same (naive) type.
    Null stays null.
    """
    ts = F.try_to_timestamp(col_(c).cast("string")).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts).cast("double")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km, atan2 form, R = 6371.0 (GEO-1)."""
    la1, lo1, la2, lo2 = (F.radians(col_(x)) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def hash_multiplier(seed: int = 0) -> int:
    """Odd 32-bit multiplier of a seed; another seed deals rows out anew."""
    if seed == 0:
        return 2654435761
    return int.from_bytes(hashlib.sha256(str(seed).encode()).digest()[:4], "big") | 1


def hash_unit(row_id: str | Column, seed: int = 0) -> Column:
    """Stable pseudo-random integer in [0, 2^32) from an integer key.

    Multiplicative hashing with plain BIGINT arithmetic, identical in any SQL
    engine, and free of overflow for any 64-bit key, negative ones too.
    """
    low = F.pmod(col_(row_id).cast("bigint"), F.lit(2147483648).cast("bigint"))
    return (low * hash_multiplier(seed)) % 4294967296


def fold_of(row_id: str | Column, k: int, seed: int = 0) -> Column:
    """Fold number in [0, k) from the row key (SPL-2)."""
    return hash_unit(row_id, seed) % k


def is_holdout(row_id: str | Column, test_ratio: float = 0.2, seed: int = 0) -> Column:
    """Hold-out membership by hashed key (SPL-1): stable under repartitioning."""
    cut = int(round(test_ratio * 1000))
    return hash_unit(row_id, seed) % 1000 < cut


def nan_to_null(c: str | Column) -> Column:
    x = col_(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def inf_to_null(c: str | Column) -> Column:
    """+-inf and NaN to null (NUL-7)."""
    x = col_(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def comma_list(c: str | Column) -> Column:
    """'a, b ,c' -> ['a','b','c'] (FUN-11)."""
    return F.transform(F.split(col_(c), ","), lambda s: F.trim(s))
