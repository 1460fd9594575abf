"""Readers, sinks, cleaning and recodes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.functions import clean, fixed_values, recode
from meanline.functions.calendar import calendar_columns
from meanline.operators import study
from meanline.operators.totals import sum_per_user
from meanline.sources import readers, sinks
from meanline.sources.storage import new_path


def test_hourly_file(spark, tmp_path):
    path = tmp_path / "hour.csv"
    names = ",".join(readers.HOURLY_SCHEMA.names)
    path.write_text(f"{names}\n1,2011-01-01,1,0,1,0,0,6,0,1,0.24,0.2879,0.81,0,3,13,16\n")
    typed = readers.read_csv(spark, str(path), readers.HOURLY_SCHEMA).first()
    assert typed["hr"] == 0.0 and typed["cnt"] == 16.0 and str(typed["dteday"]) == "2011-01-01"
    lines = readers.drop_header_rows(readers.read_lines(spark, str(path)), "instant")
    row = readers.parse_fields(lines, {"hum": (12, "double"), "hr": (5, "int")}).first()
    assert (row["hum"], row["hr"]) == (0.81, 0)


def test_strict_parsing_stops_and_lenient_gives_null(spark):
    lines = spark.createDataFrame([("1,x,",)], "value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.parse_fields(lines, {"b": (1, "double")}).collect()
    assert readers.parse_fields(lines, {"b": (1, "double"), "z": (9, "int")}, strict=False).first() == (None, None)


def test_malformed_record_stops_a_strict_read(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,oops\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception):
        readers.read_csv(spark, str(path), schema).collect()
    assert readers.read_csv(spark, str(path), schema, strict=False).first()["b"] is None


def test_text_sink_appends_and_keeps_positions(spark):
    path = new_path(spark, "test-lines")
    row = readers.literal_rows(spark, [fixed_values.SINK_ROW], "y double, " + ", ".join(f"x{i} int" for i in range(9)))
    sinks.write_text(row, path)
    sinks.write_text(spark.createDataFrame([(1, None, "z")], "a int, b string, c string"), path)
    lines = sorted(r["value"] for r in readers.read_lines(spark, path).collect())
    assert lines == ["1,,z", "28.6826451,11,0,2,1,0,31,37,41,24"]


def test_conform_checks_names(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    wide = T.StructType([T.StructField("y", T.StringType()), T.StructField("x", T.LongType())])
    assert readers.conform(df, wide).dtypes == [("y", "string"), ("x", "bigint")]
    with pytest.raises(Exception):
        readers.conform(df, T.StructType([T.StructField("z", T.StringType(), False)]))


def test_empty_fields(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("3",)], "c string")
    assert [r[0] for r in df.select(clean.fill_empty("c")).collect()] == [0.0, 0.0, 0.0, 3.0]


def test_constant_columns(spark):
    df = spark.createDataFrame([(6, 1, None, None), (6, 2, None, 1)], "m int, v int, e int, half int")
    assert clean.constant_columns(df) == ["m", "e"]
    assert clean.drop_constant_columns(df).columns == ["v", "half"]


def test_purchase_codes(spark):
    df = spark.createDataFrame(
        [("F", "0-17", "A", "4+", "0"), ("M", "51-55", "B", "0", "1"), (None, "55+", "C", "3", None)],
        "g string, a string, c string, s string, m string",
    )
    coded = df.select(
        recode.gender_code("g"), recode.age_code("a"), recode.city_code("c"), recode.topcoded_years("s"),
        recode.marital_code("m"),
    )
    assert [tuple(r) for r in coded.collect()] == [
        (1.0, 1.0, 1.0, 5.0, 1.0), (2.0, 5.0, 2.0, 1.0, 2.0), (2.0, 6.0, 3.0, 4.0, 2.0),
    ]


def test_unlisted_value(spark):
    df = spark.createDataFrame([(1.0,), (99.0,)], "hr double")
    table = fixed_values.HOUR_RANK
    with pytest.raises(Exception, match="no code for 99"):
        recode.recode_fixed(df, "hr", table).collect()
    assert [r[0] for r in recode.recode_fixed(df, "hr", table, on_unknown="null").collect()] == [4.0, None]
    assert [r[0] for r in recode.recode_fixed(df, "hr", table, on_unknown="default").collect()] == [4.0, 0.0]
    assert recode.recode_fixed(df, "hr", table, "code", on_unknown="null").columns == ["hr", "code"]


@pytest.mark.parametrize(
    "table,codes",
    [
        (fixed_values.HOUR_RANK, range(24)),
        (fixed_values.MONTH_RANK, range(1, 13)),
        (fixed_values.TEMPERATURE_RANK, range(50)),
        (fixed_values.FELT_TEMPERATURE_RANK, range(65)),
    ],
)
def test_rank_tables_use_every_code_once(table, codes):
    assert sorted(table.values()) == list(codes)
    assert list(table) == sorted(table)


def test_irregular_tables():
    humidity, wind = fixed_values.HUMIDITY_RANK, fixed_values.WIND_BIN
    assert len(humidity) == 89 and sorted(set(range(89)) - set(humidity.values())) == [75, 76]
    assert humidity[0.26] == humidity[0.34] == 82 and humidity[0.32] == humidity[0.23] == 81
    assert len(wind) == 30 and sorted(wind.values()) == sorted([1.0] * 4 + [float(b) for b in range(2, 15)] * 2)
    assert list(humidity) == sorted(humidity) and list(wind) == sorted(wind)


def test_calendar(spark):
    df = spark.sql(
        "select explode(array(timestamp_ntz'2012-07-04 05:00:00', timestamp_ntz'2011-12-21 23:59:00',"
        " timestamp_ntz'2011-03-20 00:00:00')) as ts"
    )
    rows = [tuple(r) for r in df.select(*calendar_columns(F.col("ts"), 2011)).collect()]
    assert rows == [(3, 1, 7, 5, 1, 3, 0), (1, 0, 12, 23, 0, 3, 1), (1, 0, 3, 0, 0, 0, 0)]


def test_month_mean_uses_nominal_days(spark):
    df = spark.createDataFrame([("2011-02-01", 57.0), ("2011-02-01", 57.0), ("2011-04-02", 60.0)], "d string, y double")
    rows = study.month_mean_per_day(df.withColumn("d", F.col("d").cast("date")), "d", "y").orderBy("mnth").collect()
    assert [(r["mnth"], r["n"], r["n_days"], r["per_row_day"], r["per_day"]) for r in rows] == [
        (2, 2, 1, 2.0, 114.0), (4, 1, 1, 2.0, 60.0),
    ]


def test_user_totals_do_not_overflow(spark):
    df = spark.createDataFrame([(1, 2_000_000_000, "b"), (1, 2_000_000_000, "a")], "u int, p int, g string")
    row = sum_per_user(df, "u", "p", ["g"]).first()
    assert (int(row["total"]), row["g"]) == (4_000_000_000, "a")


def test_summary_profile_both_ways(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    exact = study.summary_profile(df, ["v"]).first()
    assert (exact["n"], exact["mean"], exact["p25"], exact["p50"], exact["max"]) == (100, 50.5, 25.75, 50.5, 100.0)
    assert study.summary_profile(df, ["v"], exact=False).first()["p50"] == 50.0
