import duckdb
import pytest

from sonalyze.llm import queries

AT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{AT}/{t}.parquet')")
    df = queries.queries()[name](spark, AT)
    columns = sorted(df.columns)
    sql = queries.oracle_sql()[name]
    assert columns == sorted(db.sql(sql).columns)
    value = lambda x: round(x, 9) if isinstance(x, float) else x
    mine = sorted(tuple(value(r[c]) for c in columns) for r in df.collect())
    assert mine == sorted(tuple(map(value, r)) for r in db.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()) and mine
