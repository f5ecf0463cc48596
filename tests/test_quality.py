from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shiplake.operators import keys, quality, reconcile


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, "a", 0.5), (2, "b", 1.5), (2, None, None), (None, "z", 0.1)], "id int, kind string, p double"
    )


def violations(report):
    return {r["check_name"]: r["violations"] for r in report.collect()}


def test_checks_count_violations(spark, frame):
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    report = quality.run_checks([
        quality.not_null("null", frame, "id"),
        quality.unique("unique", frame, "id"),
        quality.accepted_values("accepted", frame, "kind", ["a", "b"]),
        quality.relationship("parent", frame, "kind", parent, "k"),
        quality.relationship("parent or null", frame, "kind", parent, "k", null_is_orphan=True),
        quality.expression("range", frame, F.col("p").between(0, 1)),
        quality.row_count("rows", frame, 6),
        quality.column_order("order", frame, ["id", "kind", "p"]),
        quality.column_order("wrong order", frame, ["kind", "id", "p"]),
    ])
    assert violations(report) == {
        "null": 1, "unique": 1, "accepted": 1, "parent": 1, "parent or null": 2, "range": 1, "rows": 2,
        "order": 0, "wrong order": 1,
    }
    with pytest.raises(RuntimeError, match="unique"):
        quality.require_passed(report)


def test_row_checks_of_a_table_share_one_scan(frame):
    report = quality.run_checks([
        quality.not_null("a", frame, "id"), quality.not_null("b", frame, "kind"), quality.not_null("c", frame, "p")
    ])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_null_counts_and_profile(frame):
    assert quality.null_counts(frame).first().asDict() == {"id": 1, "kind": 1, "p": 1}
    with pytest.raises(RuntimeError, match="kind"):
        quality.require_no_nulls(frame, ["kind"])
    profile = {r["column_name"]: r for r in quality.table_profile(frame, "t").collect()}
    assert profile["kind"]["sample_value"] == "a" and profile["p"]["data_type"] == "double"
    assert profile["id"]["row_count"] == 4 and profile["id"]["column_count"] == 3


def test_profile_sample_is_cut_and_free_of_pipes(spark):
    frame = spark.createDataFrame([("a|b" + "x" * 60,)], "s string")
    assert quality.table_profile(frame, "t").first()["sample_value"] == ("a/b" + "x" * 60)[:50]


def test_shape_guard(frame):
    quality.require_shape(frame, 4, 3)
    with pytest.raises(RuntimeError):
        quality.require_shape(frame, 4, 53)


def test_violation_rows(frame):
    assert quality.null_rows(frame, "kind").count() == 1
    assert [r["kind"] for r in quality.unaccepted_rows(frame, "kind", ["a", "b"]).collect()] == ["z"]
    assert [r["p"] for r in quality.failing_rows(frame, F.col("p") < 1).collect()] == [1.5]


def test_required_tables(spark, frame):
    frame.createOrReplaceTempView("quality_there")
    quality.require_tables(spark, ["quality_there"])
    with pytest.raises(RuntimeError, match="quality_absent"):
        quality.require_tables(spark, ["quality_there", "quality_absent"])


def test_prediction_checks(spark):
    good = spark.createDataFrame(
        [("1", 0.0, False, "LOW"), ("2", 1.0, True, "HIGH")],
        "shipment_id string, late_risk_probability double, predicted_is_late boolean, risk_level string",
    )
    quality.require_passed(quality.run_checks(quality.prediction_checks(good)))
    bad = good.union(spark.createDataFrame([("2", None, True, "SEVERE"), (None, 1.1, True, "HIGH")], good.schema))
    assert violations(quality.run_checks(quality.prediction_checks(bad))) == {
        "shipment_id not null": 1, "shipment_id unique": 1, "probability in range": 2, "risk_level accepted": 1
    }
    with pytest.raises(ValueError, match="risk_level"):
        quality.prediction_checks(good.drop("risk_level"))


def test_reconcile_finds_each_kind_of_mismatch(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, "c", 1.0), (5, "e", 2.0)], "id int, s string, x double")
    right = spark.createDataFrame([(1, "a", None), (2, "B", None), (4, "d", 1.0), (5, "e", 2.0), (5, "e", 2.0)], left.schema)
    rows = {r["id"]: r for r in reconcile.reconcile_rows(left, right, ["id"], ["s", "x"]).collect()}
    assert set(rows) == {2, 3, 4, 5}
    assert rows[2]["s_differs"] and rows[2]["x_differs"] and rows[5]["right_rows"] == 2
    assert reconcile.reconcile_counts(left, right, ["id"], ["s", "x"]).first().asDict() == {
        "mismatched_keys": 4, "left_only": 1, "right_only": 1, "s_mismatches": 1, "x_mismatches": 1
    }
    assert reconcile.reconcile_rows(left, left, ["id"], ["s", "x"]).isEmpty()


def test_symmetric_difference(spark):
    left, right = spark.range(0, 6).unionAll(spark.range(3)), spark.range(4, 9)
    found = reconcile.symmetric_difference(left, right, ["id"]).collect()
    assert {(r["id"], r["in_left"]) for r in found} == {(i, True) for i in range(4)} | {(i, False) for i in (6, 7, 8)}


def test_row_count_reconciliation(spark):
    report = reconcile.reconcile_row_counts(
        {"a": spark.range(3), "b": spark.range(2)}, {"a": spark.range(3), "c": spark.range(1)}
    )
    assert {r["table_name"]: r["matches"] for r in report.collect()} == {"a": True, "b": False, "c": False}
    with pytest.raises(RuntimeError, match="came back"):
        reconcile.require_round_trip(spark.range(3), spark.range(2), "x")


def test_size_checked_broadcast(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100).select((F.col("id") % 10).alias("k"))
    hinted = lambda f: "strategy=broadcast" in f._jdf.queryExecution().analyzed().toString()
    assert hinted(big.join(keys.lookup_table(small, ["k"], "d"), "k"))
    assert not hinted(big.join(keys.lookup_table(small, ["k"], "d", max_rows=5), "k"))
    assert hinted(big.join(keys.broadcast_if_small(small), "k"))
    assert not hinted(big.join(keys.broadcast_if_small(small, 9), "k"))
    with pytest.raises(ValueError):
        keys.lookup_table(big, ["k"], "d")


def test_input_faults_are_listed_together(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    keys.check_inputs(("x", frame, ["a"]), ("y", frame, ("a", "b")))
    with pytest.raises(keys.InputFault, match=r"x\.c, y\.d, y\.e"):
        keys.check_inputs(("x", frame, ["a", "c"]), ("y", frame, ["d", "b", "e"]))


def test_repeated_keys_reconcile_by_payload(spark):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "k int, v string")

    def check(left, right):
        return [tuple(r) for r in reconcile.reconcile_rows(left, right, ["k"], ["v"]).collect()]

    assert check(rows((1, "a"), (1, "b")), rows((1, "b"), (1, "b"))) == [(1, 2, 2, True)]
    assert check(rows((1, "a"), (1, "b")), rows((1, "b"), (1, "a"))) == []
    assert check(rows((1, "a"), (1, "a")), rows((1, "a"))) == [(1, 2, 1, False)]
    assert check(rows((1, None), (2, "x")), rows((1, None))) == [(2, 1, 0, True)]
