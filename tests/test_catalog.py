"""Every query of the engine against its SQL twin, at the smallest scale."""

import glob
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from recordwatch.plans import catalog, item_queries, monitoring_queries, open_queries, stateful, stored_pages  # noqa: F401

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    columns = sorted(frame.columns)

    def plain(v):
        if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
            v = v.tolist()
        if not isinstance(v, (list, dict)) and pd.isna(v):
            return None
        # A whole-number column with nulls comes as floats from one side only.
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return columns, sorted(repr([plain(x) for x in r]) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name not in catalog.ORACLE_SQL:
        assert len(got)
        return
    assert rows_of(got) == rows_of(duck.execute(catalog.ORACLE_SQL[name]).df())


def test_entry_without_the_subpackage(spark):
    import __spark_entry__

    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_with_the_subpackage_blocked():
    """What the entry gives where the training-data operators can't be imported."""
    code = "import sys; sys.modules['recordwatch.llm'] = sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    queries, oracles = (line.split() for line in done.stdout.strip().split("\n")[-2:])
    assert queries == sorted(catalog.QUERIES) and oracles == sorted(catalog.ORACLE_SQL)
