"""Calls and their histogram at the edges: no calls, equal ones."""

import duckdb
import pytest

from molcount.operators import variants
from molcount.plans import registry


@pytest.mark.parametrize("qs", [[], [60.0], [60.0, 60.0, 60.0], [1.0, 2.0, 1.51], [0.01, 60.0, 59.41]])
def test_histogram_of_few_calls_is_that_of_its_sql(spark, qs):
    got = variants.q_histogram(spark.createDataFrame([(q,) for q in qs], "q double")).select("bin", "n").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE bb (q DOUBLE)")
    con.executemany("INSERT INTO bb VALUES (?)", [(q,) for q in qs]) if qs else None
    # the query's own last step, over given calls
    last = registry.ORACLES["q_q_histogram"].rsplit("\nSELECT", 1)[1]
    want = con.execute("SELECT" + last).fetchall()
    assert len(got) == 100 and sorted(map(tuple, got)) == sorted(want) and sum(r["n"] for r in got) == len(qs)
