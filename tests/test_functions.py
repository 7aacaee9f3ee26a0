import datetime as dt
import hashlib

from pyspark.sql import functions as F

from landstage.functions import (chop_prefix, clock12, format_ts, hash_of, load_dts, parse_date,
                                 to_decimal, to_int, to_long)


def legacy_hash(*parts):
    """hex(sha1(concat)) as the staging tables store it: hex of the sha1 text."""
    if any(p is None for p in parts):
        return None
    text = hashlib.sha1("".join(parts).encode("utf-8")).hexdigest()
    return text.encode("ascii").hex().upper()


def test_hash_is_byte_exact_and_80_chars(spark):
    df = spark.createDataFrame([("A1", "Jane", "Ünïcode")], "a string, b string, c string")
    h = df.select(hash_of("a", "b", "c").alias("h")).first().h
    assert h == legacy_hash("A1", "Jane", "Ünïcode")
    assert len(h) == 80 and h == h.upper()


def test_hash_null_propagates_and_options(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    r = df.select(hash_of("a", "b").alias("h"),
                  hash_of("a", "b", null_as="").alias("h2"),
                  hash_of("a", "b", null_as="", sep="|").alias("h3")).first()
    assert r.h is None
    assert r.h2 == legacy_hash("x", "")
    assert r.h3 == legacy_hash("x", "|", "")


def test_hash_concat_collision_is_kept_faithfully(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    hs = [r.h for r in df.select(hash_of("a", "b").alias("h")).collect()]
    assert hs[0] == hs[1]
    hs_sep = [r.h for r in df.select(hash_of("a", "b", sep="\u001f").alias("h")).collect()]
    assert hs_sep[0] != hs_sep[1]


def test_hash_of_numbers_and_dates_uses_their_text(spark):
    df = spark.createDataFrame([(7, dt.date(2020, 1, 5))], "n int, d date")
    assert df.select(hash_of("n", "d").alias("h")).first().h == legacy_hash("7", "2020-01-05")


def test_tolerant_int_cast(spark):
    vals = ["0821234567", "1000.50", "abc", "99999999999", None, "-7.9", " 12 "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.i for r in df.select(to_int("v").alias("i")).collect()]
    assert got == [821234567, 1000, None, None, None, -7, 12]
    assert df.select(to_long("v").alias("l")).collect()[3].l == 99999999999


def test_tolerant_decimal_rounds_half_up_and_nulls_overflow(spark):
    df = spark.createDataFrame([("1.005",), ("123456.78",), ("premium",), ("-1.005",)], "v string")
    got = [r.d for r in df.select(to_decimal("v", 7, 2).alias("d")).collect()]
    assert [str(x) if x is not None else None for x in got] == ["1.01", None, None, "-1.01"]


def test_parse_date_formats_and_bad_values(spark):
    df = spark.createDataFrame([("01/05/2020",), ("13/01/2020",), ("",), (None,), ("1/5/2020",)],
                               "v string")
    got = [r.d for r in df.select(parse_date("v", "MM/dd/yyyy").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 5), None, None, None, None]
    iso = spark.createDataFrame([("2020-02-29",), ("2021-02-29",), ("1980-13-01",)], "v string")
    got = [r.d for r in iso.select(parse_date("v").alias("d")).collect()]
    assert got == [dt.date(2020, 2, 29), None, None]


def test_parse_date_accepts_date_input(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 4), dt.datetime(2020, 3, 4, 15, 0))], "v date, t timestamp")
    r = df.select(parse_date("v").alias("a"), parse_date("v", "MM/dd/yyyy").alias("b"),
                  parse_date("t", "MM/dd/yyyy").alias("c")).first()
    assert r.a == r.b == r.c == dt.date(2020, 3, 4)


def test_parse_date_fast_path_equals_pattern_parser(spark):
    texts = ["01/05/2020", "02/29/2020", "02/29/2021", "13/01/2020", "00/10/2020", "12/31/9999",
             "1/5/2020", "01/05/20201", "01-05-2020", " 01/05/2020", "01/05/2020 ", "ab/cd/efgh", None,
             "2020-01-05", "2020-02-30", "2020-1-5", "99999-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for fmt in ("MM/dd/yyyy", "yyyy-MM-dd"):
        got = df.select(parse_date("v", fmt).alias("a"), F.try_to_date("v", fmt).alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got], fmt


def test_clock12_matches_text_round_trip(spark):
    rows = [(dt.datetime(2024, 1, 1, 13, 5, 7, 123456),), (dt.datetime(2024, 1, 1, 12, 30, 0),),
            (dt.datetime(2024, 1, 1, 0, 30, 0),), (dt.datetime(2024, 1, 1, 11, 59, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    fmt = "dd-MM-yyyy hh:mm:ss"
    out = df.select(clock12("ts").alias("a"),
                    F.to_timestamp(F.date_format("ts", fmt), fmt).alias("b")).collect()
    assert [r.a for r in out] == [r.b for r in out]
    assert out[0].a == dt.datetime(2024, 1, 1, 1, 5, 7)
    assert out[1].a == dt.datetime(2024, 1, 1, 0, 30, 0)


def test_load_dts_modes(spark):
    df = spark.range(1)
    r = df.select(load_dts("2024-01-01 13:05:07.9", "exact").alias("e"),
                  load_dts("2024-01-01 13:05:07.9", "clock12").alias("c")).first()
    assert r.e == dt.datetime(2024, 1, 1, 13, 5, 7)
    assert r.c == dt.datetime(2024, 1, 1, 1, 5, 7)
    now = df.select(load_dts().alias("n")).first().n
    assert now.microsecond == 0


def test_format_ts_twelve_hour_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 15, 4, 5),)], "ts timestamp")
    assert df.select(format_ts("ts").alias("t")).first().t == "03/09/2024 03:04:05"


def test_chop_prefix_is_null_safe(spark):
    df = spark.createDataFrame([("$12.50",), ("$",), ("",), (None,)], "v string")
    got = [r.c for r in df.select(chop_prefix("v").alias("c")).collect()]
    assert got == ["12.50", "", "", None]


def test_clock12_equals_the_text_round_trip_on_a_clock_change(spark):
    from pyspark.sql import functions as F

    from landstage.functions import clock12
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 13:05:07",), ("2024-03-10 12:30:00",), ("2024-11-03 13:10:00",), ("2024-03-10 01:00:00",)], "t string")
        got = [r[0] for r in df.select(F.date_format(clock12(F.col("t").cast("timestamp")), "yyyy-MM-dd HH:mm:ss")).collect()]
        assert got == ["2024-03-10 01:05:07", "2024-03-10 00:30:00", "2024-11-03 01:10:00", "2024-03-10 01:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_scalar_function_types_and_nulls(spark):
    import pyarrow.compute as pc

    from landstage.functions import scalar_function
    df = spark.createDataFrame([("$12", 1, 2**60), (None, 2, 3), ("$", None, 5), ("ü$9", 4, None)], "s string, a int, b bigint").repartition(2)
    chop = scalar_function(lambda x: x[1:], "string")
    total = scalar_function(lambda a, b: a + b, "bigint")
    told = scalar_function(lambda a: "none" if a is None else str(a), "string", on_null="call")
    twice = scalar_function(lambda a: pc.multiply(a, 2), "bigint", vectorized=True)
    out = df.select("s", chop("s").alias("c"), total("a", "b").alias("t"), told("a").alias("n"), twice("a").alias("w"))
    got = {r.s: (r.c, r.t, r.n, r.w) for r in out.collect()}
    assert got == {"$12": ("12", 2**60 + 1, "1", 2), None: (None, 5, "2", 4), "$": ("", None, "none", None), "ü$9": ("$9", None, "4", 8)}
    assert dict(out.dtypes) == {"s": "string", "c": "string", "t": "bigint", "n": "string", "w": "bigint"}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ArrowEvalPython") == 1              # all calls share one pass through Python
    assert df.where("false").select(chop("s")).collect() == []
    import pytest
    with pytest.raises(ValueError, match="on_null"):
        scalar_function(lambda x: x, "string", on_null="skip")
