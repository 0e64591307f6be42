import pytest

from earshot.operators import similar
from earshot.sources import sinks, tables

ROWS = [
    (1, "plain", 2.5, None), (2, None, None, True), (None, "", 0.0, False), (2, ' "quoted", with\nlines\tand blanks ', -1.0, None),
    (2, "dup", 1e300, True), (2, "dup", 1e300, True), (3, "ünïcode 漢\\", 0.1, False),
]
KIND = "id long, text string, x double, flag boolean"


@pytest.mark.parametrize("fmt", sinks.FORMATS)
def test_every_format_gives_the_rows_back(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS, KIND)
    path = sinks.write(df, str(tmp_path / fmt), fmt)
    again = sinks.read(spark, path, df, fmt)
    assert again.schema == df.schema
    assert sorted(map(repr, again.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write(df, path, fmt)


@pytest.mark.parametrize("fmt", sinks.FORMATS)
def test_empty_tables_can_be_read(spark, tmp_path, fmt):
    df = spark.createDataFrame([], KIND)
    assert sinks.read(spark, sinks.write(df, str(tmp_path / fmt), fmt), df, fmt).count() == 0


def test_parts_by_column_and_refusals(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "id long, text string")
    path = sinks.write(df, str(tmp_path / "parts"), partition_by=["id"])
    assert sorted(map(tuple, sinks.read(spark, path, df).collect())) == [(1, "a"), (1, "c"), (2, "b")]
    with pytest.raises(ValueError, match="nested|cannot hold"):
        sinks.write(spark.createDataFrame([([1],)], "many array<int>"), str(tmp_path / "nested"), "csv")
    with pytest.raises(ValueError, match="format"):
        sinks.write(df, str(tmp_path / "other"), "xml")


def test_printed_rows_in_order(spark):
    df = spark.createDataFrame([(2, None), (1, "a")], "id long, text string").repartition(3)
    assert list(sinks.printed(df, ["id"])) == ["id\ttext", "1\ta", "2\t"]
    assert list(sinks.printed(df.limit(0))) == ["id\ttext"]


def test_input_report_names_all_that_is_missing(spark, tmp_path):
    csv = tmp_path / "plays.csv"
    csv.write_text("user_id,song_id,play_count\n1,2,3\n1,2,3\n")
    report = tables.input_report(spark, {"plays": str(csv), "gone": str(tmp_path / "gone")}, {"users": None})
    assert {tuple(r) for r in report.collect()} == {
        ("plays", True, True, 2), ("gone", True, False, None), ("users", False, False, None)
    }
    assert tables.input_report(spark, {}).count() == 0


def test_many_partitions_search_by_cells(spark):
    vectors = spark.range(60).selectExpr("id", "array(cast(id * id % 17 as double), cast(id % 7 as double)) AS features").repartition(6)
    usual = similar.similar_users(vectors, k=3)
    by_cells = similar.similar_users(vectors, k=3, max_sent_rows=60 * 3 * 6 - 1)
    assert sorted(map(tuple, by_cells.collect())) == sorted(map(tuple, usual.collect()))
    plan = by_cells._jdf.queryExecution().toString()
    assert "MapInArrow" in usual._jdf.queryExecution().toString() and "FlatMapCoGroupsInArrow" in plan + by_cells._jdf.queryExecution().executedPlan().toString()
