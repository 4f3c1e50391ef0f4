import math
import os

import duckdb
import pytest

from glyphmill.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(frame):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "__len__") and not isinstance(v, str):
            return [value(x) for x in v]
        return str(v) if isinstance(v, (str, bool)) else round(float(v), 6)

    return sorted(repr([value(v) for v in row]) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    expected = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert plain(got) == plain(expected)
