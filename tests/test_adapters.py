"""The oracle starts from the same inputs: each derived input is identical
when built by Spark and by DuckDB from the driver tables."""

import pytest

from oracle_compare import compare, duck
from cadence import schemas
from cadence.sources import adapters

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(schemas.INPUTS))
def test_input_identical_in_both_engines(spark, con, name):
    df = adapters._derive(spark, SF)[name]
    assert [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in schemas.INPUTS[name].fields]
    ok, msg = compare(df, con, f"WITH {adapters.duckdb_input_ctes()} SELECT * FROM {name}")
    assert ok, msg
