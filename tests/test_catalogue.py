import datetime

import duckdb
import pytest

from sonalyze.plans import file_queries  # noqa: F401: it registers its queries
from sonalyze.plans.catalogue import ORACLE, QUERIES

AT = "/root/testdata/sf0.001"
#: Queries that find nothing in the smallest tables.
LARGER = {"audit_recovery": "/root/testdata/sf0.01", "news_dedup_reasons": "/root/testdata/sf0.01"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def dbs():
    out = {at: duckdb.connect() for at in {AT, *LARGER.values()}}
    for at, con in out.items():
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}/{t}.parquet')")
    return out


def key(row):
    return tuple((x is not None, str(type(x)), x) if x is not None else (False, "", 0) for x in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, dbs, name):
    at = LARGER.get(name, AT)
    df, db = QUERIES[name](spark, at), dbs[at]
    assert name in ORACLE
    columns = sorted(df.columns)
    assert columns == sorted(db.sql(ORACLE[name]).columns)

    def value(x):
        if isinstance(x, float):
            return round(x, 9)
        return x.isoformat() if isinstance(x, (datetime.date, datetime.datetime)) else x

    mine = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=key)
    theirs = sorted((tuple(map(value, r)) for r in db.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()), key=key)
    assert len(mine) == len(theirs) > 0
    assert mine == theirs
