import random

import numpy as np
from pyspark.sql import functions as F

from opinara.operators import eda, lookups, profile
from opinara.operators import toprows as TR
from opinara.operators.quantiles import below_quantile, exact_quantiles, histogram
from opinara.sources import jsonl, sinks


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int, ts long")


def test_sample_ignores_partitioning(spark):
    df = spark.range(500)
    a = {r["id"] for r in TR.seeded_sample(df.repartition(7), "id", 40).collect()}
    b = {r["id"] for r in TR.seeded_sample(df.coalesce(1), "id", 40).collect()}
    assert a == b and len(a) == 40
    assert a != {r["id"] for r in TR.seeded_sample(df, "id", 40, seed=1).collect()}


def test_positions(spark):
    df = spark.createDataFrame([(i * 37 % 101,) for i in range(101)], "v int").repartition(5)
    got = {r["v"]: r["position"] for r in TR.with_position(df, ["v"]).collect()}
    assert got == {v: v for v in range(101)}
    assert TR.row_at_position(df, ["v"], lambda n: n - 1)["v"] == 100
    assert TR.row_at_position(df, ["v"], lambda n: n) is None


def test_temporal_split(spark):
    rows = [(i % 3, i, 1, i // 4) for i in range(50)]
    train, test = TR.temporal_split(ratings(spark, rows), ["ts", "item_id"], 0.3)
    assert sorted(r["item_id"] for r in train.collect()) == list(range(35))
    assert test.count() == 15


def test_user_halves_of_hot_users(spark):
    rows = [(0, i, 1, 1000 - i) for i in range(41)] + [(u, i, 1, i) for u in (1, 2) for i in range(3)]
    df = ratings(spark, rows)
    pick = lambda d: sorted((r["user_id"], r["item_id"], r["position"], r["n_reviews"], r["is_later_half"]) for r in d.collect())
    assert pick(TR.user_halves(df, ["ts"], hot_limit=10)) == pick(TR.user_halves(df, ["ts"]))


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    values = [rng.choice([1.0, 2.0, rng.random() * 10]) for _ in range(333)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(6)
    points = [0.0, 0.05, 0.5, 0.95, 1.0]
    assert np.allclose(exact_quantiles(df, F.col("v"), points), np.quantile(values, points))
    assert below_quantile(df.filter("v is not null and not isnan(v)"), "v", 0.95).count() == sum(v < np.quantile(values, 0.95) for v in values)
    assert exact_quantiles(df.limit(0), F.col("v"), [0.5]) == [None]


def test_histogram_counts_everything(spark):
    values = [0.0, 1.0, 2.0, 2.5, 10.0, 10.0]
    h = histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in h] == list(np.histogram(values, 4)[0])
    assert histogram(spark.createDataFrame([(3.0,)], "v double"), "v", 2).agg(F.sum("n")).first()[0] == 1


def test_star_median_and_mode(spark):
    rows = [(1, 1, 5, 0), (2, 1, 5, 0), (3, 1, 1, 0), (4, 1, 2, 0), (1, 2, 3, 0), (2, 2, 4, 0)]
    got = {r["item_id"]: (r["median_rating"], r["mode_rating"]) for r in eda.star_median_mode(ratings(spark, rows)).collect()}
    assert got == {1: (3.5, 5), 2: (3.5, 3)}


def test_title_terms_fall_back(spark):
    df = spark.createDataFrame([(1, "Leather Care"), (2, "Soap"), (3, None)], "item_id long, title string")
    assert [r["item_id"] for r in eda.title_has_all(df, ["LEATHER", "conditioner"]).collect()] == [1]
    assert eda.title_has_all(df, ["none"]).count() == 0


def test_profile_and_quality(spark):
    df = spark.createDataFrame(
        [(1, "a", None, [1]), (1, "", 2.0, [1, 2]), (2, "bb", None, []), (3, "a", None, None)], "k int, s string, x double, l array<int>"
    )
    p = {r["column_name"]: r for r in profile.column_profile(df).collect()}
    assert (p["s"]["unique_count"], p["s"]["empty_count"], p["s"]["max_length"]) == (3, 1, 2)
    assert p["x"]["null_rate"] == 0.75 and p["x"]["max_value"] == 2.0
    assert p["l"]["null_count"] == 1 and p["l"]["max_length"] == 2
    q = profile.quality_report(df, ["k"]).first()
    assert (q["total_records"], q["n_issues"], q["is_valid"]) == (4, 1, False)
    assert {f["check_name"] for f in q["findings"]} == {"null_rate", "empty_text", "duplicate_rate"}
    assert profile.quality_report(df.select("k").distinct(), ["k"]).first()["is_valid"]
    d = {r["field_name"]: r for r in profile.data_dictionary(df).collect()}
    assert d["k"]["sample_values"].split("; ")[:2] == ["1", "2"]


def test_json_fields(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5, "b": null}',), ('{"a": 3}',), ("broken",)], "j string")
    p = {r["field"]: r for r in profile.json_field_profile(df, "j").collect()}
    assert p["a"]["max_value"] == 3.0 and p["a"]["n_rows"] == 3 and p["a"]["data_type"] == "BIGINT"
    assert p["b"]["null_count"] == 1 and p["b"]["data_type"] == "STRING"


def test_insert_ignore_and_counter(spark):
    new = spark.createDataFrame([(1, 9), (2, 5), (2, 3)], "k int, v int")
    target = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in sinks.rows_to_insert(new, target, ["k"], [F.asc("v")]).collect()] == [(2, 3)]
    assert sinks.rows_to_insert(new, target, ["k"]).count() == 1
    old = spark.createDataFrame([(1, 2, 5)], "src int, dst int, frequency long")
    more = spark.createDataFrame([(1, 2, 1), (2, 3, 1)], "src int, dst int, frequency long")
    got = sorted(tuple(r) for r in sinks.merge_counts(old, more, ["src", "dst"]).collect())
    assert got == [(1, 2, 6), (2, 3, 1)]


def test_sinks_round_trip(spark, tmp_path):
    products = spark.createDataFrame(
        [(1, "t", "c", 4.567, 3, 10.0, "s", ["f"])],
        "item_id long, title string, main_category string, average_rating double, rating_number int, price double, store string, features array<string>",
    )
    reviews = spark.sql("""select 7L user_id, 1L item_id, 5.0D rating, 'a' title, cast(null as string) text, 1 helpful_vote, true verified_purchase,
        timestamp'2001-02-03 04:05:06' ts union all select 7L, 99L, 4.0D, 'b', 'x', 0, false, timestamp'1999-01-01 00:00:00'""")
    sinks.load_relational(reviews, products, str(tmp_path / "rel"))
    p = spark.read.parquet(str(tmp_path / "rel/products"))
    assert dict(p.dtypes)["average_rating"] == "decimal(3,2)" and str(p.first()["average_rating"]) == "4.57"
    assert p.first()["features"] == '["f"]'
    r = spark.read.parquet(str(tmp_path / "rel/reviews"))
    assert r.count() == 1 and r.first()["year"] == 2001 and dict(r.dtypes)["rating"] == "smallint"
    assert (tmp_path / "rel/reviews/year=2001").exists()
    sinks.load_documents(reviews, products, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "doc/products")).first()["features"] == ["f"]
    sinks.write_csv(products.drop("features"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["title"] == "t"
    sinks.write_report(eda.summary_report_lines(eda.rating_summary(reviews)), str(tmp_path / "txt"))
    assert any(line["value"].startswith("n_reviews: 2") for line in spark.read.text(str(tmp_path / "txt")).collect())


def test_audits(spark):
    child = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert tuple(lookups.foreign_key_audit(child, parent, "k").first()) == (2, 1)
    assert tuple(lookups.key_violations(child, ["k"]).first()) == (2, 2)


def test_intermediate_tables_can_be_deleted(spark):
    import os
    from urllib.parse import urlparse

    from opinara import session

    session.clear_intermediates(spark)
    df = session.materialise(spark.range(10))
    folder = os.path.dirname(urlparse(df.inputFiles()[0]).path)
    assert df.count() == 10 and os.path.isdir(folder)
    assert session.clear_intermediates(spark) == 1 and not os.path.exists(folder)
    assert session.clear_intermediates(spark) == 0


def test_lines_of_any_table_are_parsed(spark):
    from opinara.sources.jsonl import parse_lines

    lines = spark.createDataFrame([('{"asin": "a", "rating": 4.0}',), ('{"asin": "b"',), ("  ",)], "value string")
    kept = parse_lines(lines, jsonl.REVIEW_SCHEMA, "keep").collect()
    assert sorted((r["asin"] or "", r["_bad"] or "") for r in kept if r["_bad"] is None) == [("a", "")]
    assert [r["_bad"] for r in kept if r["_bad"]] == ['{"asin": "b"']
    assert [r["asin"] for r in parse_lines(lines, jsonl.REVIEW_SCHEMA).collect()] == ["a"]


def test_graph_load_round_trip(spark, tmp_path):
    edges = spark.createDataFrame([(1, 2, 3)], "src long, dst long, frequency long")
    sinks.load_graph({"users": spark.range(2)}, {"bought_together": edges}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "users")).count() == 2
    assert tuple(spark.read.parquet(str(tmp_path / "bought_together")).select("src", "dst", "frequency").first()) == (1, 2, 3)


def test_user_text_vectors_sum_words(spark):
    import hashlib

    from opinara.operators import features

    rows = spark.createDataFrame([(1, "red", "red bolt"), (1, None, "Bolt"), (2, None, None)], "user_id long, title string, text string")
    got = {r["id"]: r["vector"] for r in features.user_text_vectors(rows, dim=16).collect()}
    want = [0.0] * 16
    for w in ("red", "red", "bolt", "bolt"):
        want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16] += 1
    length = sum(x * x for x in want) ** 0.5
    assert set(got) == {1} and all(abs(a - b / length) < 1e-12 for a, b in zip(got[1], want, strict=True))
