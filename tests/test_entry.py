import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_imports_without_llm():
    from matchloom.plans.registry import ORACLE_SQL, QUERIES

    assert QUERIES.keys() <= entry.queries().keys() and ORACLE_SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["flagship_history", "score_grammar", "name_match_audit", "upsert_master", "elo_global", "common_opponents", "calibration_bins", "rating_snapshot_fallback", "matches_enriched", "match_table", "opponent_side", "pair_rows", "page_records", "ranking_tables", "json_rows", "tournament_metadata", "guess_city", "rated_profiles", "meeting_summary", "latest_of_names"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events pages".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols

    def cell(v):
        if pd.isna(v):
            return ""
        if hasattr(v, "year"):
            return str(v)[:10]
        return f"{float(v):.6f}" if isinstance(v, (int, float, np.number)) else str(v)

    def text(df):
        return sorted(tuple(map(cell, r)) for r in df[cols].itertuples(index=False))

    assert text(got) == text(want)
