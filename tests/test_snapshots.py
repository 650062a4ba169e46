import pytest

from helpers import rows_of
from tocsin.operators.snapshots import SchemaMismatch, SnapshotTable

DDL = "incident_id string, severity string"


@pytest.fixture
def table(spark, path):
    return SnapshotTable(spark, path("lake"))


def frame(spark, *rows):
    return spark.createDataFrame(rows, DDL)


def test_time_travel(spark, table):
    assert table.overwrite(frame(spark, ("a", "Critical"), ("b", "Low"))) == 0
    assert table.append(frame(spark, ("c", "HIGH"))) == 1
    assert table.update(("severity = 'Critical'", {"severity": "'critical'"})) == 2
    assert table.overwrite(frame(spark, ("z", "low"))) == 3
    assert rows_of(table.read(0)) == [("a", "Critical"), ("b", "Low")]
    assert rows_of(table.read(1)) == [("a", "Critical"), ("b", "Low"), ("c", "HIGH")]
    assert rows_of(table.read(2)) == [("a", "critical"), ("b", "Low"), ("c", "HIGH")]
    assert rows_of(table.read()) == [("z", "low")]
    assert table.latest_version() == 3
    with pytest.raises(ValueError):
        table.read(4)


def test_history_newest_first_with_metrics(spark, table):
    table.overwrite(frame(spark, ("a", "Low"), ("b", None)))
    table.append(frame(spark, ("c", "High")))
    table.update(("severity IS NULL OR severity = 'High'", {"severity": "'x'"}))
    entries = table.history().collect()
    assert [(r["version"], r["operation"]) for r in entries] == [(2, "UPDATE"), (1, "APPEND"), (0, "OVERWRITE")]
    assert entries[0]["operation_metrics"] == {"rows": "3", "updated_rows": "2"}
    assert entries[1]["operation_metrics"] == {"rows": "1"}
    assert entries[0]["timestamp"] > entries[2]["timestamp"]
    assert table.history(1).count() == 1


def test_update_rewrites_only_parts_with_a_hit(spark, table):
    table.append(frame(spark, ("a", "Low")))
    table.append(frame(spark, ("b", "High")))
    table.append(frame(spark, ("c", "Low")))
    table.update(("severity = 'High'", {"severity": "'high'"}))
    assert rows_of(table.parts(), "part_version", "piece", "rows") == [(0, 0, 1), (2, 0, 1), (3, 0, 1)]
    assert rows_of(table.read()) == [("a", "Low"), ("b", "high"), ("c", "Low")]
    assert rows_of(table.read(2)) == [("a", "Low"), ("b", "High"), ("c", "Low")]


def test_rules_apply_in_order_in_one_version(spark, table):
    table.overwrite(frame(spark, ("a", "A"), ("b", "B"), ("c", None)))
    version = table.update(("severity = 'A'", {"severity": "'B'"}), ("severity = 'B'", {"severity": "'C'"}))
    assert version == 1
    assert rows_of(table.read()) == [("a", "C"), ("b", "C"), ("c", None)]


def test_update_without_match_makes_no_version(spark, table):
    table.overwrite(frame(spark, ("a", "low")))
    assert table.update(("severity = 'CRITICAL'", {"severity": "'critical'"})) == 0
    assert table.history().count() == 1


def test_changes_between_versions(spark, table):
    table.overwrite(frame(spark, ("a", "Low"), ("b", "low"), ("b", "low")))
    table.update(("severity = 'Low'", {"severity": "'low'"}))
    assert rows_of(table.changes(0, 1)) == [("a", "Low", 1, 0), ("a", "low", 0, 1)]


def test_schema_is_enforced(spark, table):
    table.overwrite(frame(spark, ("a", "Low")))
    with pytest.raises(SchemaMismatch):
        table.append(spark.createDataFrame([("a", "b", 1)], DDL + ", extra int"))
    with pytest.raises(SchemaMismatch):
        table.append(spark.createDataFrame([(1, "b")], "incident_id int, severity string"))
    with pytest.raises(SchemaMismatch):
        table.overwrite(spark.range(1))
    assert table.latest_version() == 0
    table.append(spark.createDataFrame([("b",)], "incident_id string"))
    assert rows_of(table.read()) == [("a", "Low"), ("b", None)]
    table.overwrite(spark.range(2), new_schema=True)
    assert table.read().columns == ["id"]
    assert table.read(1).columns == ["incident_id", "severity"]


def test_data_without_history_is_invisible_and_replaced(spark, path):
    where = path("lake")
    table = SnapshotTable(spark, where)
    table.overwrite(frame(spark, ("a", "Low")))
    frame(spark, ("lost", "x")).write.parquet(f"{where}/data/snapshot_version=1")
    assert rows_of(table.read()) == [("a", "Low")]
    assert table.append(frame(spark, ("b", "Low"))) == 1
    assert rows_of(table.read()) == [("a", "Low"), ("b", "Low")]


def test_run_id_makes_append_repeatable(spark, table):
    assert table.append(frame(spark, ("a", "Low")), run_id="r1") == 0
    assert table.append(frame(spark, ("a", "Low")), run_id="r1") == 0
    assert table.append(frame(spark, ("b", "Low")), run_id="r2") == 1
    assert table.read().count() == 2


def test_empty_frames(spark, table):
    table.overwrite(frame(spark, ("a", "x")).limit(0))
    assert table.read().count() == 0
    table.append(frame(spark, ("a", "x")).filter("false"))
    assert table.read().count() == 0 and table.latest_version() == 1
    assert [r["operation_metrics"]["rows"] for r in table.history().collect()] == ["0", "0"]


def test_describe(spark, table):
    table.overwrite(frame(spark, ("a", None)))
    assert rows_of(table.describe(), "column_name", "column_type", "nulls") == [
        ("incident_id", "string", 0), ("severity", "string", 1),
    ]


def test_changes_read_only_parts_that_differ(spark, path):
    table = SnapshotTable(spark, path())
    table.append(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
    table.append(spark.createDataFrame([(3, "c")], "k long, v string"))
    table.update(("k = 3", {"v": "'d'"}))
    got = table.changes(1, 2)
    assert sorted((r["k"], r["v"], r["rows_before"], r["rows_after"]) for r in got.collect()) == [(3, "c", 1, 0), (3, "d", 0, 1)]
    read = {f.split("snapshot_version=")[1].split("/")[0] for f in got.inputFiles()}
    assert read == {"1", "2"}


def test_append_may_add_columns(spark, path):
    table = SnapshotTable(spark, path())
    table.append(spark.createDataFrame([(1, "a")], "k long, v string"))
    wider = spark.createDataFrame([(2, 0.5)], "k long, extra double")
    with pytest.raises(SchemaMismatch):
        table.append(wider)
    table.append(wider, evolve=True)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a", None), (2, None, 0.5)]
    assert table.read(0).columns == ["k", "v"]


@pytest.fixture
def split(spark, path):
    table = SnapshotTable(spark, path("lake"), split_by="k", pieces=8)
    table.append(spark.range(800).selectExpr("id AS k", "'old' AS v"))
    return table


def folders(df):
    return {"/".join(f.split("/")[-3:-1]) for f in df.inputFiles()}


def test_update_of_one_row_rewrites_one_part(spark, split):
    before = set(split.read().inputFiles())
    assert split.parts().count() == 8
    assert split.update(("k = 500", {"v": "'new'"})) == 1
    after = set(split.read().inputFiles())
    assert len(folders(split.read())) == 8 and len(before - after) == 1
    assert sum("snapshot_version=1" in f for f in after) == 1
    assert split.read().count() == 800 and split.read().filter("v = 'new'").first()["k"] == 500
    assert rows_of(split.read(0).select("v").distinct()) == [("old",)]
    assert int(split.history(1).first()["operation_metrics"]["rows"]) < 200


def test_ranges_skip_parts(spark, split):
    low, high = 100, 110
    near = split.read(between=(low, high))
    assert len(folders(near)) < 3 and sorted(r["k"] for r in near.collect()) == list(range(100, 111))
    split.update(("v = 'old'", {"v": "concat(v, '!')"}), between=(low, high))
    assert rows_of(split.read().filter("v = 'old!'"), "k") == [(k,) for k in range(100, 111)]
    assert split.update(("v = 'old!'", {"v": "'x'"}), between=(300, 900)) == 1
    assert folders(split.changes(0, 1)) < folders(split.read(0)) | folders(split.read(1))
    assert len(folders(split.changes(0, 1))) < 5


def test_split_tables_append_overwrite_and_null_keys(spark, split):
    split.append(spark.createDataFrame([(None, "n"), (900, "a")], "k long, v string"))
    assert split.read().count() == 802 and split.read(between=(850, 950)).count() == 1
    split.update(("k IS NULL", {"v": "'null'"}))
    assert split.read().filter("v = 'null'").count() == 1
    split.overwrite(spark.range(3).selectExpr("id AS k", "'z' AS v"))
    assert split.read().count() == 3 and split.read(2).count() == 802 and split.read(1).filter("k IS NULL").first()["v"] == "n"
    split.overwrite(spark.range(0).selectExpr("id AS k", "'z' AS v"))
    assert split.read().count() == 0 and split.read(between=(0, 9)).count() == 0


def test_history_rows_do_not_grow_with_the_parts(spark, path):
    table = SnapshotTable(spark, path("lake"))
    for n in range(4):
        table.append(spark.range(n, n + 1))
    logged = spark.read.parquet(f"{table._part_log}")
    assert logged.groupBy("of_version").count().filter("count > 1").isEmpty() and table.read().count() == 4
    with pytest.raises(ValueError, match="split"):
        table.read(between=(0, 1))


def test_change_feed(spark, path):
    table = SnapshotTable(spark, path("lake"))
    shape = "k string, v int, w string"
    table.overwrite(spark.createDataFrame([("same", 1, None), ("gone", 2, "x"), ("mod", 3, None), ("twice", 4, "a"), ("twice", 4, "a"), ("twice", 5, "b"), (None, 6, "n")], shape))
    table.overwrite(spark.createDataFrame([("same", 1, None), ("new", 2, "x"), ("mod", 3, "y"), ("twice", 4, "a"), ("twice", 7, "c"), (None, 8, "n")], shape))
    got = table.change_feed(0, 1, ["k"]).collect()
    plain = sorted([(str(r["k"]), r["change"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in got], key=str)
    assert plain == sorted([
        ("None", "delete", (6, "n"), None), ("None", "insert", None, (8, "n")),
        ("gone", "delete", (2, "x"), None), ("mod", "update", (3, None), (3, "y")), ("new", "insert", None, (2, "x")),
        ("twice", "delete", (4, "a"), None), ("twice", "delete", (5, "b"), None), ("twice", "insert", None, (7, "c")),
    ], key=str)
    assert table.change_feed(0, 0, ["k"]).count() == 0
