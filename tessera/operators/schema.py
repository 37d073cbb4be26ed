"""Projection and schema operators (PRJ-*, TYP-*).

These act on ``df.columns`` / ``df.schema`` (metadata, sized by the column
count) plus, where data decides (PRJ-8, TYP-2..4), one aggregation over all
columns at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_COLS = ("row_id", "target", "is_test")

# Column-name replacement map of the reference's cleaner.
NAME_REPLACEMENTS = {"+": "plus", "-": "minus", "[": "_", "]": "_", " ": "_", "/": "_", "(": "_", ")": "_", ",": "_"}


def drop_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PRJ-2: drop the listed columns that exist (no error otherwise)."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """PRJ-3: drop columns whose name starts with 'Unnamed'."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.match(r"^Unnamed", c)])


def dedupe_names(df: DataFrame) -> DataFrame:
    """PRJ-4: keep the first of columns sharing a name (positional)."""
    seen, idx = set(), []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            idx.append(i)
    tmp = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"_c{i}").alias(df.columns[i]) for i in idx])


def rename_on_clash(df: DataFrame, prefix: str = "feature_") -> tuple[DataFrame, dict]:
    """PRJ-4 (second form): when any names clash, rename every column to
    ``feature_i`` and return the position -> old name mapping."""
    if len(set(df.columns)) == len(df.columns):
        return df, {}
    mapping = {f"{prefix}{i}": c for i, c in enumerate(df.columns)}
    return df.toDF(*mapping), mapping


def _unique(names: Sequence[str]) -> list[str]:
    out, used = [], {}
    for n in names:
        base = n or "col"
        k = used.get(base, 0)
        new = base if k == 0 else f"{base}_{k}"
        while new in used:
            k += 1
            new = f"{base}_{k}"
        used[base] = k + 1
        used[new] = used.get(new, 1)
        out.append(new)
    return out


def clean_names_map(df: DataFrame, replacements: dict[str, str] = NAME_REPLACEMENTS) -> tuple[DataFrame, dict]:
    """PRJ-5: replace listed characters, strip '_' at the ends; returns the mapping."""
    new = []
    for c in df.columns:
        n = c
        for a, b in replacements.items():
            n = n.replace(a, b)
        new.append(n.strip("_"))
    new = _unique(new)
    return df.toDF(*new), dict(zip(df.columns, new))


def clean_names_word(df: DataFrame) -> DataFrame:
    """PRJ-6: '-' -> '_', then any non-word character -> '_'; de-duplicated
    (names that become empty or equal get suffixes)."""
    new = [re.sub(r"[^\w]", "_", c.replace("-", "_")) for c in df.columns]
    return df.toDF(*_unique(new))


def cast_columns(df: DataFrame, to_string: Sequence[str] = (), to_double: Sequence[str] = ()) -> DataFrame:
    """PRJ-7: cast lists of columns (invalid numbers become null: try_cast)."""
    out = df
    for c in to_string:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("string"))
    for c in to_double:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).try_cast("double"))
    return out


def to_numeric_if_possible(df: DataFrame, cols: Sequence[str] | None = None, coerce: bool = False) -> DataFrame:
    """PRJ-8: text columns become DOUBLE when every non-null value parses
    (``errors='ignore'``: otherwise the column is left whole); ``coerce``
    casts anyway with failures as null.  One aggregation decides all columns."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
            and (cols is None or f.name in cols)]
    if not cols:
        return df
    if coerce:
        ok = set(cols)
    else:
        row = df.agg(*[(F.count(F.col(c)) == F.count(F.col(c).try_cast("double"))).alias(c) for c in cols]).first()
        ok = {c for c in cols if row[c]}
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in ok else F.col(c) for c in df.columns])


def xy_split(df: DataFrame, target: str = "target", id_cols: Sequence[str] = ID_COLS) -> tuple[DataFrame, DataFrame]:
    """PRJ-9: features and target (both keep the row key)."""
    feats = [c for c in df.columns if c not in id_cols or c == "row_id"]
    return df.select(*feats), df.select("row_id", target)


def align_to(df: DataFrame, train_cols: Sequence[str]) -> DataFrame:
    """PRJ-10: error on missing model columns, drop extras, model order."""
    missing = [c for c in train_cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for scoring: {missing}")
    return df.select(*train_cols)


def coverage(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
             groups: Sequence[str] = ()) -> dict[str, list[str]]:
    """PRJ-11: group columns absent, columns in neither list, listed but absent."""
    have = set(df.columns)
    return {"absent_groups": [g for g in groups if g not in have],
            "unlisted": [c for c in df.columns if c not in set(numeric) | set(categorical)],
            "listed_absent": [c for c in [*numeric, *categorical] if c not in have]}


def numeric_categorical(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """TYP-1: numeric dtype -> continuous, otherwise categorical."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (num if isinstance(f.dataType, T.NumericType) else cat).append(f.name)
    return num, cat


def find_columns(df: DataFrame, part: str) -> list[str]:
    """FUN-10: names of the columns that contain ``part``."""
    return [c for c in df.columns if part in c]


_BASE = ["district", "area", "contract_ym", "built_year", "hood", "complex"]
_EXTRA = ["bal", "contract_day"]
# Feature presets over the trades view.
PRESETS = {
    "baseline": {"drop": ["addr", "deal_type", "mostly_null"]},
    "manual": {"keep": ["area", "contract_ym", "contract_day", "district", "hood", "built_year"]},
    "minimum": {"keep": [*_BASE, "heating", "lat", "lon"]},
    "features_all": {"keep": [*_BASE, *_EXTRA]},
    "remove_all": {"drop": ["addr", "deal_type", "mostly_null", "heating", "district", "complex"]},
    "wrapper": {"keep": [*_BASE, *_EXTRA]},
}


def select_preset(df: DataFrame, preset: str, keep_list: Sequence[str] | None = None,
                  id_cols: Sequence[str] = ID_COLS) -> DataFrame:
    """PRJ-1: column preset; lists are intersected with the existing columns
    and the id columns are always kept.  ``keep_list`` replaces the list of
    ``wrapper``."""
    spec = {"keep": list(keep_list)} if preset == "wrapper" and keep_list is not None else PRESETS[preset]
    ids = [c for c in id_cols if c in df.columns]
    if "drop" in spec:
        return df.select(*[c for c in df.columns if c in ids or c not in spec["drop"]])
    keep = [c for c in spec["keep"] if c in df.columns and c not in ids]
    return df.select(*ids, *keep)
