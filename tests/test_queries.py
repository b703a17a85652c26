import math
import os

import pytest

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(ROOT), reason="no test tables")


def normal(v):
    import datetime
    import decimal

    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


def test_core_queries_equal_their_sql(spark):
    import duckdb

    from quarrymill.plans import catalog

    con = duckdb.connect()
    for f in os.listdir(ROOT):
        con.execute(f"create view {f[:-8]} as select * from '{ROOT}/{f}'")
    for name, sql in catalog.ORACLES.items():
        df = catalog.QUERIES[name](spark, ROOT)
        cols = sorted(df.columns)
        got = sorted((tuple(map(normal, r)) for r in df.select(*cols).collect()), key=repr)
        out = con.execute(sql)
        at = [[d[0] for d in out.description].index(c) for c in cols]
        want = sorted((tuple(normal(r[i]) for i in at) for r in out.fetchall()), key=repr)
        assert got == want, name


def test_entry(spark, monkeypatch):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["query_id", "doc_id", "score", "rank"]
