"""Replacing tables as a whole and by partition."""

import os

import pytest

from opinara.sources import sinks


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("n long, year int").parquet(path).collect())


def test_refresh_and_what_it_leaves_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table = lambda pairs: spark.createDataFrame(pairs, "n long, year int")
    sinks.full_refresh(table([(1, 2000), (2, 2001)]), path, ["year"])
    assert rows(spark, path) == [(1, 2000), (2, 2001)]
    # from its own rows
    sinks.full_refresh(spark.read.schema("n long, year int").parquet(path).selectExpr("n + 10 AS n", "year"), path, ["year"])
    assert rows(spark, path) == [(11, 2000), (12, 2001)]
    with pytest.raises(ValueError):
        sinks.full_refresh(table([]), path, ["year"])
    with pytest.raises(ValueError):
        sinks.full_refresh(table([(5, 2000)]), path, ["year"], lambda t: t.count() == 2)
    with pytest.raises(Exception, match="boom"):
        sinks.full_refresh(table([(5, 2000)]).selectExpr("CASE WHEN n > 0 THEN raise_error('boom') ELSE n END AS n", "year"), path, ["year"])
    assert rows(spark, path) == [(11, 2000), (12, 2001)]
    sinks.refresh_partitions(table([(7, 2001), (8, 2002)]), path, ["year"])
    assert rows(spark, path) == [(7, 2001), (8, 2002), (11, 2000)]
    assert os.listdir(tmp_path) == ["t"]
