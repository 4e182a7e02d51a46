"""Hashing, clock, cleaning and contracts on small literal frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import clean, clock, contracts
from tidemark.functions.hashing import hash_of, with_hashes


def value(spark, expr, **cols):
    df = spark.range(1)
    for name, v in cols.items():
        df = df.withColumn(name, v if hasattr(v, "_jc") else F.lit(v))
    return df.select(expr.alias("v")).first()["v"]


# --- hashing ---------------------------------------------------------------------------------


def test_hash_is_md5_of_pipe_joined_text_with_null_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 1.5, True, date(2024, 1, 2))], "s string, n string, d double, b boolean, t date")
    got = df.select(hash_of(df, df.columns).alias("h")).first()["h"]
    assert got == hashlib.md5(b"a||1.5000|true|2024-01-02").hexdigest()


def test_hash_of_special_doubles_does_not_fail(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e40,), (None,)], "d double")
    assert df.select(hash_of(df, ["d"]).alias("h")).distinct().count() == 4


def test_hashes_do_not_depend_on_row_order(spark):
    data = [(i, i * 0.1, str(i)) for i in range(50)]
    one = with_hashes(spark.createDataFrame(data, "k int, d double, s string"), ["k"], ["k", "d", "s"])
    two = with_hashes(spark.createDataFrame(data[::-1], "k int, d double, s string").repartition(3), ["k"], ["k", "d", "s"])
    assert rows(one) == rows(two)


def test_columns_outside_the_payload_do_not_change_the_row_hash(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], "k int, v string, load string")
    assert with_hashes(df, ["k"], ["k", "v"]).select("_rowhash").distinct().count() == 1


# --- clock -----------------------------------------------------------------------------------


def test_close_rules():
    at = datetime(2024, 1, 3, 3, 20)
    assert clock.close_at(at, "hour") == datetime(2024, 1, 3, 2, 59, 59)
    assert clock.close_at(at, "seamless") == datetime(2024, 1, 3, 3)
    assert clock.close_at(at, "day") == datetime(2024, 1, 2, 23, 59, 59)
    with pytest.raises(ValueError):
        clock.close_at(at, "never")


def test_months_back_clips_to_the_end_of_the_month():
    assert clock.months_back(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert clock.months_back(date(2024, 1, 15), 2) == date(2023, 11, 15)
    assert clock.months_back(date(2024, 12, 31), 12) == date(2023, 12, 31)


@pytest.fixture(scope="module")
def moments(spark):
    data = [(n, datetime.fromisoformat(t) if t else None) for n, t in [
        ("old", "2024-01-20 10:00:00"), ("before", "2024-01-28 23:59:59.999999"), ("first", "2024-01-29 00:00:00"),
        ("last", "2024-01-29 23:59:59.999999"), ("today", "2024-01-30 00:00:00"), ("late", "2024-01-30 23:59:59"),
        ("next", "2024-01-31 00:00:00"), ("none", None),
    ]]
    return spark.createDataFrame(data, "n string, at timestamp_ntz")


@pytest.mark.parametrize("build,expected", [
    (lambda d: clock.opened_on(d, "at", date(2024, 1, 30)), {"first", "last"}),
    (lambda d: clock.in_window(d, "at", date(2024, 1, 30), -1, 0), {"first", "last", "today", "late"}),
    (lambda d: clock.in_window(d, "at", datetime(2024, 1, 30, 17), 0, 0), {"today", "late"}),
    (lambda d: clock.since(d, "at", date(2024, 1, 30), days=1), {"first", "last", "today", "late", "next"}),
    (lambda d: clock.since(d, "at", date(2024, 1, 30), days=7, include_today=False), {"before", "first", "last"}),
    (lambda d: clock.since(d, "at", date(2024, 1, 30), months=2, include_today=False), {"old", "before", "first", "last"}),
])
def test_windows(moments, build, expected):
    assert {r["n"] for r in build(moments).collect()} == expected


def test_since_wants_exactly_one_length(moments):
    with pytest.raises(ValueError):
        clock.since(moments, "at", date(2024, 1, 30))


def test_current_opened_today_checks_flag_day_and_country(spark):
    df = spark.createDataFrame(
        [("ok", True, "fr", datetime(2024, 1, 30, 1)), ("closed", False, "FR", datetime(2024, 1, 30, 1)),
         ("de", True, "DE", datetime(2024, 1, 30, 1)), ("old", True, "FR", datetime(2024, 1, 29, 23))],
        "n string, _valid_flag boolean, country string, _valid_from timestamp_ntz")
    got = clock.current_opened_today(df, date(2024, 1, 30), "country", "fr")
    assert rows(got, "n") == [("ok",)]


# --- cleaning --------------------------------------------------------------------------------


def test_null_texts_become_null_and_numbers_become_text(spark):
    df = spark.createDataFrame([("nan", 1), ("None", 2), ("<NA>", 3), ("salesforce", None), (None, 5)], "s string, n int")
    got = clean.clean_string_nulls(df, ["s", "n"])
    assert {r["s"] for r in got.collect()} == {None, "salesforce"}
    assert dict(got.dtypes)["n"] == "string"


def test_rounding_instead_of_truncation(spark):
    assert value(spark, clean.rounded_long("x"), x=150.6) == 151
    assert value(spark, clean.rounded_long("x"), x=-2.5) == -3
    assert value(spark, clean.parse_quality("x"), x="150.5") == 151
    assert value(spark, clean.parse_quality("x"), x="abc") is None


def test_safe_ratio(spark):
    assert value(spark, clean.safe_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert value(spark, clean.safe_ratio(F.lit(1.0), F.lit(None).cast("double"))) is None
    assert value(spark, clean.safe_ratio(F.lit(1.0), F.lit(4.0))) == 0.25


def test_first_times_defaults_to_zero(spark):
    none = F.lit(None).cast("double")
    assert value(spark, clean.first_times(F.lit(3.0), none, F.lit(2.0))) == 6.0
    assert value(spark, clean.first_times(F.lit(3.0), none, none)) == 0.0


@pytest.mark.parametrize("text,expected", [
    ("None;NoneX; a ;;", ["X", "a"]), ("none", []), ("", []), (None, []), ("NONEabc;B", ["abc", "B"]),
    ("A;A", ["A", "A"]),
])
def test_parse_codes(spark, text, expected):
    assert value(spark, clean.parse_codes(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("code,country,expected", [
    ("POS_L_Package", "de", "POS_L_Package:1:12"), ("POS_L_PackageS", "IT", "POS_L_PackageS:1:12"),
    ("POS_L_Package", "FR", "POS_L_Package:1:1"), ("WEB", "DE", "WEB:1:1"), ("POS_L_Package", None, "POS_L_Package:1:1"),
])
def test_code_variant(spark, code, country, expected):
    assert value(spark, clean.code_variant(F.lit(code), F.lit(country).cast("string"))) == expected


def test_parse_int_list(spark):
    assert value(spark, clean.parse_int_list(F.lit("1, 2,3"))) == [1, 2, 3]
    assert value(spark, clean.parse_int_list(F.lit(""))) is None
    assert value(spark, clean.parse_int_list(F.lit(None).cast("string"))) is None


def test_epoch_day_accepts_dates_timestamps_and_texts(spark):
    for v in (date(1970, 1, 11), datetime(1970, 1, 11, 23, 0), "1970-01-11", "1970-01-11T05:00:00"):
        assert value(spark, clean.epoch_day(F.lit(v))) == 10
    assert value(spark, clean.epoch_day(F.lit(""))) is None
    assert value(spark, clean.epoch_day(F.lit(None).cast("date"))) is None


def test_unscaled_is_half_even_and_null_is_zero(spark):
    assert value(spark, clean.unscaled(F.lit(Decimal("1.005")))) == 100
    assert value(spark, clean.unscaled(F.lit(Decimal("1.015")))) == 102
    assert value(spark, clean.unscaled(F.lit(-1.5))) == -150
    assert value(spark, clean.unscaled(F.lit(None).cast("double"))) == 0
    with pytest.raises(PySparkException):
        value(spark, clean.unscaled(F.lit(1000.0)))


def test_inactive_codes_move_by_700(spark):
    assert value(spark, clean.service_code(F.lit("101"), F.lit(True))) == 101
    assert value(spark, clean.service_code(F.lit("101"), F.lit(False))) == 801


@pytest.mark.parametrize("a,b,expected", [(1, 1, 0.3), (0, 1, 0.4), (1, 0, 0.2), (0, 0, 0.3), (None, None, 0.3), (None, 1, 0.4)])
def test_upsell_probability(spark, a, b, expected):
    df = spark.createDataFrame([(a, 0.2, b, 0.4)], "ra int, pa double, rb int, pb double")
    assert df.select(clean.upsell_probability("ra", "pa", "rb", "pb").alias("p")).first()["p"] == pytest.approx(expected)


def test_manager_information_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert rows(df.select(clean.manager_information("x", "y"))) == [(None,), ("a, b",)]


def test_type_names(spark):
    df = spark.createDataFrame([("Café",), ("Night Club",), ("Restaurant",), (None,)], "t string")
    assert rows(df.select(clean.normalise_type("t"))) == [(None,), ("cafe",), ("nightclub",), ("restaurant",)]


def test_partner_key(spark):
    df = spark.createDataFrame([("Joe's  Bar", None, None, "contact", True)], "n string, z string, v string, t string, c boolean")
    assert df.select(clean.partner_key("n", "z", "v", "t", "c").alias("k")).first()["k"] == "joesbar/contacttrue"


def test_sparse_payload_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(clean.sparse_payload("a", "b").alias("j")).first()["j"] == '{"a":1}'


def test_whitelist_drops_null_codes(spark):
    df = spark.createDataFrame([(1, "1"), (1, "2"), (1, None), (2, "1"), (None, "1")], "s int, c string")
    assert rows(clean.whitelist(df, {"s": 1}, {"c": ["2", "3"]})) == [(1, "1")]


def test_drop_blank_and_exclude_status(spark):
    df = spark.createDataFrame([(" a ", "x"), ("  ", "Inventory"), (None, None)], "id string, st string")
    ok, skipped = clean.drop_blank(df, ["id"])
    assert rows(ok, "id") == [("a",)] and skipped.count() == 1
    assert {r["st"] for r in clean.exclude_status(df, "st", "inventory").collect()} == {"x", None}


def test_iso_country(spark):
    assert value(spark, clean.iso_country(F.lit("France"))) == "FR"
    assert value(spark, clean.iso_country(F.lit("Nowhere"))) is None


# --- contracts -------------------------------------------------------------------------------

CONTRACT = contracts.record("id INT NOT NULL, price DECIMAL(5,2) NOT NULL, day DATE, n INT")


def test_validate_splits_every_row_and_names_reasons(spark):
    df = spark.createDataFrame(
        [("1", 12.345, "2024-01-01", 5.6), (None, 1.0, None, None), ("x", 1.0, None, None), ("2", 1000.0, None, None), ("3", 1.0, "bad", 1e12)],
        "id string, price double, day string, n double")
    ok, bad = contracts.validate(df, CONTRACT)
    assert ok.count() + bad.count() == df.count()
    assert rows(ok) == [(1, Decimal("12.35"), date(2024, 1, 1), 6)]
    assert ok.schema["price"].dataType == CONTRACT["price"].dataType
    reasons = {tuple(r["reject_reasons"]) for r in bad.collect()}
    assert reasons == {
        ("id: missing",), ("id: not a int",), ("price: not a decimal(5,2)",), ("day: not a date", "n: not a int"),
    }


def test_validate_limits(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"), None, 5), (2, Decimal("1.00"), None, 50)], "id int, price decimal(5,2), day date, n int")
    ok, bad = contracts.validate(df, CONTRACT, {"n": (0, 10)})
    assert rows(ok, "id") == [(1,)] and bad.first()["reject_reasons"] == ["n: out of range"]


def test_conform_is_strict_on_request(spark):
    df = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(PySparkException):
        contracts.conform(df, contracts.record("id INT NOT NULL")).collect()
    assert contracts.conform(df, contracts.record("id INT NOT NULL"), strict=False).first()["id"] is None


def test_wire_form(spark):
    df = spark.createDataFrame([(1, Decimal("1.25"), date(1970, 1, 2), 3)], "id int, price decimal(5,2), day date, n int")
    assert rows(contracts.wire_form(df, CONTRACT)) == [(1, 125, 1, 3)]


@pytest.mark.parametrize("name", ["SCORING", "CRM_ASSET", "COMMISSION", "PARTNER_MATCHING", "WHOLESALE_INVOICE", "LEAD", "ASSET", "VOUCHER", "TICKET"])
def test_each_contract_column_keeps_its_own_value(spark, name):
    contract = getattr(contracts, name)
    source = spark.range(1).select(*[F.lit(i).cast("string").alias(f.name) for i, f in enumerate(contract.fields)])
    numbers = [i for i, f in enumerate(contract.fields) if f.dataType.typeName() in ("integer", "long", "float", "double", "decimal", "string")]
    row = contracts.conform(source, contract, strict=False).first()
    for i in numbers:
        assert float(row[i]) == i, contract.fields[i].name
    assert row.__fields__ == contract.names
