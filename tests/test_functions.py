import datetime

from pyspark.sql import functions as F

from strata.functions import columns as C


def value(spark, column, **row):
    types = ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in row.items()) or "x int"
    return spark.createDataFrame([tuple(row.values()) or (1,)], types).select(column).first()[0]


def test_zeros_and_ratios(spark):
    a, b = F.col("a"), F.col("b")
    assert value(spark, C.zero_as_null(a), a=0) is None and value(spark, C.zero_as_null(a), a=3) == 3
    assert value(spark, C.safe_divide(a, b), a=1.0, b=0.0) is None and value(spark, C.safe_divide(a, b), a=1.0, b=4.0) == 0.25
    assert value(spark, C.change_ratio(a, b), a=20.0, b=10.0) == 1.0 and value(spark, C.change_ratio(a, b), a=20.0, b=0.0) == 0.0
    assert value(spark, C.growth_ratio(a, b), a=3.0, b=-1.0) == 0.0 and value(spark, C.influence(a, b, F.lit(None)), a=5.0, b=2.0) == 9.0


def test_dates(spark):
    t = F.col("t")
    assert value(spark, C.parse_date(t), t="2024-02-29") == datetime.date(2024, 2, 29)
    assert value(spark, C.parse_date(t), t="2024-02-30") is None and value(spark, C.parse_date(t), t="") is None
    assert value(spark, C.lenient_date(t), t="2024-01-05T10:00:00Z") == datetime.date(2024, 1, 5)
    assert value(spark, F.date_format(C.parse_instant(t), "yyyy-MM-dd HH"), t="2024-01-05T10:00:00.000Z") == "2024-01-05 10"
    assert value(spark, C.parse_instant(t), t="soon") is None
    assert value(spark, C.dt_from_path(t), t="s3://b/raw/movie/dt=2024-03-01/x.gz") == datetime.date(2024, 3, 1) and value(spark, C.dt_from_path(t),
        t="x") is None
    assert value(spark, C.iso_day_of_week(F.lit("2024-01-01").cast("date"))) == 1


def test_texts(spark):
    t = F.col("t")
    assert value(spark, C.company_name(t), t="Legendary Pictures (US)") == "Legendary Pictures"
    assert value(spark, C.mask_secret(t), t="abcdefghijklmnop") == "abcd****mnop" and value(spark, C.mask_secret(t), t="short") == "****"
    assert value(spark, C.mask_text(t), t="GET http://u:p@h/x?api_key=abc Bearer a.b") == "GET http://****:****@h/x?api_key=**** Bearer ****"
    assert value(spark, C.canonical_json(t), t='{"b": 1, "a": {"d": 2, "c": [3]}}') == '{"a":{"c":[3],"d":2},"b":1}' and value(spark, C.canonical_json(t),
        t="x") is None
    assert value(spark, C.display_name(t, F.lit("n")), t="") == "n"
    assert value(spark, C.is_director(t), t="DIRECTOR") == 1 and value(spark, C.flag(F.lit(None).cast("boolean"))) == 0
    assert value(spark, C.readable_size(F.col("n")), n=3 << 20) == "3.00 MiB"
    assert [value(spark, c, t="a.b") for c in C.split_table_name(t)] == ["a",
        "b"] and [value(spark, c, t="graph:Movie") for c in C.split_table_name(t)] == ["graph", "Movie"]
    assert [value(spark, c, t="b") for c in C.split_table_name(t)] == ["default", "b"]
    assert value(spark, C.content_hash("t"), t="") == value(spark, C.content_hash("u"), u=None)
    assert len(value(spark, C.deterministic_id(t, F.lit(None)), t="x")) == 32


def test_codes(spark):
    n = F.col("n")
    assert [value(spark, C.gender_name(n), n=k) for k in (0, 1, 2, 3)] == ["unknown", "female", "male", "non-binary"]
    assert value(spark, C.release_type_name(n), n=3) == "院线" and value(spark, C.release_type_name(n), n=9) == "其他"
    assert value(spark, C.latency_ms(n, F.lit(5)), n=9) == 0
