"""Every registered query builds and runs on the smallest tables; the
entry point returns rows; SQL-expressible queries match their oracle."""

import os
import sys

import pytest

from places import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

FAST = ["flagship_region_rmse", "fun_address_date_flags", "nul_interpolate", "nul_hierarchical_fill",
        "enc_label_unseen", "agg_profile", "geo_subway_features", "sel_cramers_v", "scl_yeo_johnson",
        "eva_kfold_group_mean", "src_csv_roundtrip", "agg_word_counts_top100"]


def test_entry_returns_rows(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_sf0001(spark, name):
    from oracle_check import compare, duck
    import pandas as pd
    from tessera.plans.registry import load_all
    q = load_all()[name]
    sp = q.fn(spark, SF001).toArrow().to_pandas(types_mapper=pd.ArrowDtype)
    dk = duck(SF001).execute(q.oracle).to_arrow_table().to_pandas(types_mapper=pd.ArrowDtype)
    r = compare(sp, dk)
    assert r.get("exact"), r
