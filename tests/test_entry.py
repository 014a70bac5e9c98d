"""Driver contract: entry, queries and oracle keys; a sample against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ridelens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _key(t):
    return tuple((v is None, repr(v)) for v in t)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["type", "year"]


def test_every_trip_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 50


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = entry.queries()[key](spark, SF)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=_key)
    rel = con.sql(entry.oracle_sql()[key])
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    exp = sorted((tuple(row[i] for i in order) for row in rel.fetchall()), key=_key)
    assert len(got) == len(exp)
    assert got == exp


def test_readme_usage_imports_resolve():
    readme = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")
    text = open(readme).read()
    block = text.split("## Usage", 1)[1].split("```python", 1)[1].split("```", 1)[0]
    imports = [line for line in block.splitlines() if line.startswith(("from ", "import "))]
    assert imports
    exec("\n".join(imports), {})


def test_missing_optional_libraries_leave_the_trip_queries():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['public_tokenizers'] = sys.modules['tokenizers'] = None; import __spark_entry__ as e; print(*e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert set(out) == set(QUERIES)
