"""The driver contract and the DuckDB oracle on the smallest driver tables."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = [pytest.mark.oracle,
              pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")]


def reference_names(e):
    """Queries outside the subpackage llm, which has tests of its own."""
    return {n for n in e.queries() if not n.startswith("op") and n != "pipeline"}


def gold_rows():
    import duckdb

    from stratus.oracle import with_layers

    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF}/lineitem.parquet')")
    return con.execute(with_layers("SELECT COUNT(*) FROM gold")).fetchone()[0]


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["weather_pattern", "occurrences", "percentage", "avg_temp_for_pattern",
                          "avg_precip_for_pattern"]
    assert sum(r.occurrences for r in rows) == gold_rows()


def test_every_query_has_oracle():
    import __spark_entry__ as e

    assert reference_names(e) <= set(e.oracle_sql()) and set(e.oracle_sql()) <= set(e.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.slow
def test_spark_matches_duckdb(spark):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF}/lineitem.parquet')")
    failures = []
    sqls = e.oracle_sql()
    for name, fn in sorted((n, f) for n, f in e.queries().items() if n in reference_names(e)):
        df = fn(spark, SF)
        s_rows = [tuple(r) for r in df.collect()]
        rel = con.execute(sqls[name])
        d_cols = [c[0] for c in rel.description]
        d_rows = rel.fetchall()
        if sorted(df.columns) != sorted(d_cols) or _key(s_rows, df.columns) != _key(d_rows, d_cols):
            failures.append(name)
    assert failures == []
