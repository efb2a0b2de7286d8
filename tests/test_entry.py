import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_core_loads_without_the_optional_part():
    import subprocess
    import sys

    code = "import strataline.registry as r, sys; assert not any(m.startswith('strataline.llm') for m in sys.modules); print(len(r.QUERIES))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(__file__))).stdout) > 60


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="standard tables are absent")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="standard tables are absent")
@pytest.mark.parametrize("name", ["topic_terms", "family_split_groups", "chunk_qc_summary", "evaluation_summary", "mixture_selection"])
def test_queries_match_sql(spark, name):
    import duckdb

    from strataline import registry

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    got = registry.QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({registry.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))
