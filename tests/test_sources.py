import pytest
from pyspark.sql.types import DoubleType, StringType, StructType

from batchlens.functions.dates import parse_timestamp
from batchlens.functions.jsons import list_to_json, row_from_json, row_to_json
from batchlens.kinds import NUMERIC
from batchlens.operators.batching import BATCH, assign_batches, rows_per_batch, split_batches
from batchlens.sources.csvs import read_csvs


def days(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "day string")


def test_mixed_dates(spark):
    df = days(spark, "08-AUG-13", "07-JUL-95", "2014-01-02", "01/02/2014", None)
    found = {r[BATCH]: r.n_rows for r in rows_per_batch(assign_batches(df, "day")).collect()}
    assert found == {"1995-07": 1, "2013-08": 1, "2014-01": 2, None: 1}
    assert split_batches(df, "day").count() == 4


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01/02/2014", "2014-01-02 00:00:00"),
        ("1/2/2014", "2014-01-02 00:00:00"),
        ("1/2/2014 3:04:05", "2014-01-02 03:04:05"),
        ("2014-1-2", "2014-01-02 00:00:00"),
        ("2014/1/2", "2014-01-02 00:00:00"),
        (" 7-Jul-2014 ", "2014-07-07 00:00:00"),
        ("13/02/2014", "2014-02-13 00:00:00"),
        ("2014-01-02 03:04:05", "2014-01-02 03:04:05"),
        ("2014-01-02T03:04:05", "2014-01-02 03:04:05"),
        ("07-JUL-68", "2068-07-07 00:00:00"),
        ("07-jul-69", "1969-07-07 00:00:00"),
        ("02-Jan-2014", "2014-01-02 00:00:00"),
        ("20140102", "2014-01-02 00:00:00"),
    ],
)
def test_formats(spark, text, expected):
    df = days(spark, text)
    assert str(df.select(parse_timestamp(df.day)).first()[0]) == expected


def test_bad_dates(spark):
    df = days(spark, "soon")
    assert df.select(parse_timestamp(df.day, on_bad="null")).first()[0] is None
    with pytest.raises(Exception, match="unparseable time value"):
        df.select(parse_timestamp(df.day)).collect()


def test_csvs_with_different_columns(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,c\n3,z\nNA,\n")
    (tmp_path / "notes.txt").write_text("a\n9\n")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "3.csv").write_text("a\n9\n")
    df = read_csvs(spark, str(tmp_path), {"a": NUMERIC, "b": NUMERIC})
    assert df.columns == ["a", "b", "c"]
    assert {tuple(r) for r in df.collect()} == {(1.0, 2.0, None), (None, 3.0, "z"), (None, None, None)}


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,t\n1,"x, ""y""\nz"\n')
    (tmp_path / "2.csv").write_text("t,a\nplain,2\n")
    rows = {tuple(r) for r in read_csvs(spark, str(tmp_path), {"a": NUMERIC}).collect()}
    assert rows == {(1.0, 'x, "y"\nz'), (2.0, "plain")}


def test_csv_bad_number(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a\nmany\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csvs(spark, str(tmp_path), {"a": NUMERIC}).collect()
    assert read_csvs(spark, str(tmp_path), {"a": NUMERIC}, on_bad="null").first().a is None


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("\n")
    with pytest.raises(ValueError, match="no header"):
        read_csvs(spark, str(tmp_path))


def test_csv_folder_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csvs(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_csvs(spark, str(tmp_path / "absent"))


def test_list_as_json(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(list_to_json(F.array(F.lit("a=1"), F.lit("b=2")))).first()[0] == '["a=1","b=2"]'


def test_json_roundtrip_of_missing_values(spark):
    schema = StructType().add("x", DoubleType()).add("t", StringType())
    df = spark.createDataFrame([(float("nan"), "NaN"), (1.5, "u")], schema)
    text = df.select(row_to_json(df, ["x", "t"]).alias("row_json"))
    assert {r[0] for r in text.collect()} == {'{"x":null,"t":"NaN"}', '{"x":1.5,"t":"u"}'}
    foreign = spark.createDataFrame([('{"x": NaN, "t": NaN}',), ('{"x": 1.5, "t": "u"}',)], "row_json string")
    for source in (text, foreign):
        rows = {tuple(r) for r in row_from_json(source, "row_json", schema).collect()}
        assert rows == {(None, None), (1.5, "u")}


def test_subfolders_with_partition_names_are_ignored(spark, tmp_path):
    (tmp_path / "p=1").mkdir()
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "p=1" / "b.csv").write_text("a,b\n2,y\n")
    assert [tuple(r) for r in read_csvs(spark, str(tmp_path)).collect()] == [("1", "x")]


@pytest.mark.parametrize("multiline", [True, False])
def test_rows_longer_than_their_header(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,y,EXTRA\n3\n")
    with pytest.raises(Exception, match="more cells than its header"):
        read_csvs(spark, str(tmp_path), multiline=multiline).select("a").collect()
    kept = read_csvs(spark, str(tmp_path), multiline=multiline, on_bad="null").collect()
    assert [tuple(r) for r in kept] == [("1", "x"), ("2", "y"), ("3", None)]


def test_header_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n"x, y",x,x,,"q ""1"""\n1,2,3,4,5\n')
    df = read_csvs(spark, str(tmp_path))
    assert df.columns == ["x, y", "x", "x.1", "_c3", 'q "1"']
    assert [tuple(r) for r in df.collect()] == [("1", "2", "3", "4", "5")]
    (tmp_path / "b.csv").write_text("X\n1\n")
    with pytest.raises(ValueError, match="differ in case only"):
        read_csvs(spark, str(tmp_path))
