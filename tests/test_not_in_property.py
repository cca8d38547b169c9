"""``keys.not_in`` equals SQL ``NOT IN`` (DuckDB) on random lists with NULLs."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwatch.operators.keys import not_in

values = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=8)


def _duck_not_in(left, right):
    con = duckdb.connect()
    con.execute("CREATE TABLE l (k INTEGER)")
    con.execute("CREATE TABLE r (k INTEGER)")
    if left:
        con.executemany("INSERT INTO l VALUES (?)", [(v,) for v in left])
    if right:
        con.executemany("INSERT INTO r VALUES (?)", [(v,) for v in right])
    return sorted(con.execute("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)").fetchall(),
                  key=lambda t: (t[0] is None, t[0] or 0))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=values, right=values)
def test_not_in_matches_sql(spark, left, right):
    ldf = spark.createDataFrame([(v,) for v in left], "k int")
    rdf = spark.createDataFrame([(v,) for v in right], "k int")
    got = sorted((tuple(r) for r in not_in(ldf, rdf, "k").collect()), key=lambda t: (t[0] is None, t[0] or 0))
    assert got == _duck_not_in(left, right)
