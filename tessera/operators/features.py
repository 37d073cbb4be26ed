"""Derived features (FUN-*): address tokens, contract date parts, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import at_least_flag, epoch_seconds, in_list_flag, token, ym_month, ym_year

# The seven districts the reference flags as the southern core
# region (its default list; pass another list for other data).
CORE_DISTRICTS = ("강서구", "영등포구", "동작구", "서초구", "강남구", "송파구", "강동구")


def prep_feat(df: DataFrame, year: int = 2009, addr_col: str = "addr", ym_col: str = "contract_ym",
              built_col: str = "built_year", core: Sequence[str] = CORE_DISTRICTS,
              lot_col: str | None = None) -> DataFrame:
    """FUN-12: one projection adding

    - ``gu`` / ``dong``: tokens 1 and 2 of the address (FUN-1),
    - ``contract_year`` / ``contract_month``: text parts of yyyymm (FUN-2),
    - ``is_core``: ``gu`` in the core list (FUN-3),
    - ``is_new``: built year >= ``year`` (FUN-4),
    - ``addr_lot``: address + lot number when ``lot_col`` is given (FUN-5),

    then dropping the address and yyyymm source columns.  Steps whose source
    column is missing are skipped explicitly (no silent failure).
    """
    cols = set(df.columns)
    out = []
    if addr_col in cols:
        if "gu" not in cols:
            out.append(token(addr_col, 1).alias("gu"))
        if "dong" not in cols:
            out.append(token(addr_col, 2).alias("dong"))
    if ym_col in cols:
        out += [ym_year(ym_col).alias("contract_year"), ym_month(ym_col).alias("contract_month")]
    gu = F.col("gu") if "gu" in cols else (token(addr_col, 1) if addr_col in cols else None)
    if gu is not None:
        out.append(in_list_flag(gu, core).alias("is_core"))
    if built_col in cols:
        out.append(at_least_flag(built_col, int(year)).alias("is_new"))
    if lot_col and addr_col in cols and lot_col in cols:
        out.append(F.concat(F.col(addr_col), F.col(lot_col).cast("string")).alias("addr_lot"))
    keep = [F.col(c) for c in df.columns if c not in (addr_col, ym_col)]
    return df.select(*keep, *out)


def address(df: DataFrame, parts: Sequence[str], sep: str | None = " ", out: str = "address") -> DataFrame:
    """FUN-5: address text from parts; null in any part gives null (as pandas +)."""
    if sep is None:
        expr = F.concat(*[F.col(p) for p in parts])
    else:
        pieces = []
        for i, p in enumerate(parts):
            if i:
                pieces.append(F.lit(sep))
            pieces.append(F.col(p))
        expr = F.concat(*pieces)
    return df.withColumn(out, expr)


def dates_to_epoch(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FUN-6: date / timestamp columns to epoch seconds (null stays null)."""
    out = df
    for c in cols:
        out = out.withColumn(c, epoch_seconds(c))
    return out


def polynomial(df: DataFrame, cols: Sequence[str], interaction_only: bool = False) -> DataFrame:
    """FUN-9: degree-2 products of numeric columns in one projection."""
    extra = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            if a == b and interaction_only:
                continue
            name = f"{a}^2" if a == b else f"{a} {b}"
            extra.append((F.col(a) * F.col(b)).alias(name))
    return df.select("*", *extra)
