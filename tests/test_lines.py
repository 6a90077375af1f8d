"""Lines of files with their numbers."""

import pytest
from pyspark.sql import types as T

from opinara.sources.jsonl import bad_lines, numbered_lines, require_valid

SCHEMA = T.StructType([T.StructField("a", T.LongType())])


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    names = {"x.json": 900, "y.json": 3}
    for name, n in names.items():
        (tmp_path / name).write_text("".join("\n" if i == 2 else ('{"a": ' + str(i) + ("}" if i % 300 else "") + "\n") for i in range(n)))
    (tmp_path / "z.json").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # a file over many splits
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        rows = numbered_lines(spark, str(tmp_path)).collect()
        bad = sorted((r["file"].rsplit("/", 1)[1], r["line"], r["_bad"]) for r in bad_lines(spark, str(tmp_path), SCHEMA).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 903
    for r in rows:
        assert r["line"] == 3 if not r["value"] else r["value"].startswith(f'{{"a": {r["line"] - 1}')
    assert bad == [("x.json", 1, '{"a": 0'), ("x.json", 301, '{"a": 300'), ("x.json", 601, '{"a": 600'), ("y.json", 1, '{"a": 0')]


def test_the_first_bad_line_is_named(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text('{"a": 1}\n\n{"a": 2\n{"a"\n')
    with pytest.raises(ValueError, match=r"one\.json, line 3: '\{\"a\": 2'"):
        require_valid(spark, str(path), SCHEMA)
    path.write_text('{"a": 1}\n\n')
    require_valid(spark, str(path), SCHEMA)
