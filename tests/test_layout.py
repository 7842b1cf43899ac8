"""Results do not depend on whether a table is one file or a folder of files."""

import os

import pyarrow.parquet as pq
import pytest

from profilekit.plans.catalog import QUERIES
from profilekit.sources.tables import TABLES
from tests.test_oracle import _canon

ONE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("folders")
    for name in TABLES:
        table = pq.read_table(f"{ONE}/{name}.parquet")
        os.makedirs(base / f"{name}.parquet")
        step = -(-table.num_rows // 4) or 1
        for i in range(4):
            pq.write_table(table.slice(i * step, step), base / f"{name}.parquet" / f"part-{i}.parquet")
    return str(base)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_from_a_folder(spark, folders, name):
    one = _canon(QUERIES[name](spark, ONE).toPandas())
    many = _canon(QUERIES[name](spark, folders).toPandas())
    assert one[0] == many[0] and len(one[1]) == len(many[1])
    for a, b in zip(one[1], many[1], strict=True):
        assert a == b or all(x == y or abs(float(x) - float(y)) < 1e-9 for x, y in zip(a, b, strict=True))
