"""Every registered query against its SQL on the same files."""

from __future__ import annotations

import pytest

import oracle
from auditloom.workload import load
from auditloom.workload.binding import Tables

REGISTRY = load()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(name, spark, folder, con):
    entry = REGISTRY[name]
    got = oracle.spark_table(entry.build(Tables(spark, folder)))
    if entry.sql is None:
        assert got[1]
        return
    assert oracle.differences(got, oracle.sql_table(con, entry.sql)) == []
