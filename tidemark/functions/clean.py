"""Scalar cleaning and formatting used by the jobs. All of it stays inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that upstream writers leave behind in place of a null.
NULL_TEXTS = ("<NA>", "nan", "None")

# Market names and their two-letter codes.
ISO_COUNTRIES = {"France": "FR", "Germany": "DE", "Italy": "IT", "Spain": "ES"}

# Display names of establishment types that do not just lower-case.
TYPE_NAMES = {"Café": "cafe", "Night Club": "nightclub"}

# Product codes sold under another term in two markets.
VARIANT_COUNTRIES = ("DE", "IT")
VARIANT_CODES = ("POS_L_Package", "POS_L_PackageS")
VARIANT_SUFFIX = ":1:12"
DEFAULT_SUFFIX = ":1:1"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null texts become nulls; non-string columns are cast to string first."""
    cleaned = {}
    for c in cols:
        text = F.col(c).cast("string")
        cleaned[c] = F.when(~text.isin(*NULL_TEXTS), text)
    return df.withColumns(cleaned)


def required_strings(
    df: DataFrame, cols: Sequence[str], defaults: Mapping[str, int] | None = None
) -> DataFrame:
    """Null becomes '' in ``cols`` (as text) and the given number in ``defaults``."""
    out = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols}
    for c, value in (defaults or {}).items():
        out[c] = F.coalesce(F.col(c), F.lit(value))
    return df.withColumns(out)


def mapped(col: Column | str, values: Mapping, otherwise=None) -> Column:
    """CASE over a small fixed mapping."""
    col = _col(col)
    expr = None
    for key, value in values.items():
        expr = (F if expr is None else expr).when(col == F.lit(key), F.lit(value))
    return expr.otherwise(F.lit(otherwise))


def potential_level(col: Column | str, levels: Mapping[str, int], otherwise: int = 3) -> Column:
    return mapped(col, levels, otherwise)


def upsell_probability(rec_a: str, prob_a: str, rec_b: str, prob_b: str) -> Column:
    """The probability of the one product recommended, or the mean of both."""
    mean = (F.col(prob_a) + F.col(prob_b)) / 2
    a, b = F.col(rec_a) == 1, F.col(rec_b) == 1
    return (
        F.when(a & b, mean).when(b, F.col(prob_b)).when(a, F.col(prob_a)).otherwise(mean)
    )


def manager_information(*parts: str) -> Column:
    """Comma-joined contact text; null as soon as one part is null."""
    pieces = [F.col(parts[0])]
    for p in parts[1:]:
        pieces += [F.lit(", "), F.col(p)]
    return F.concat(*pieces)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def iso_country(col: Column | str) -> Column:
    return mapped(col, ISO_COUNTRIES)


def safe_ratio(a: Column, b: Column) -> Column:
    """Null where the divisor is zero or null."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def first_times(quantity: Column | str, *prices: Column | str) -> Column:
    """First non-null price, else 0, times quantity."""
    return F.coalesce(*[_col(p) for p in prices], F.lit(0)) * _col(quantity)


def rounded_long(col: Column | str) -> Column:
    """Number (or numeric text) to a whole number, half away from zero.

    Spark's own cast truncates; text that is no number raises.
    """
    return F.round(_col(col).cast("decimal(38,9)")).cast("bigint")


def parse_quality(col: Column | str) -> Column:
    """Like :func:`rounded_long`, but text that is no number gives null."""
    return F.round(_col(col).try_cast("decimal(38,9)")).cast("bigint")


def text_date(col: Column | str) -> Column:
    """Date as ISO text for string contracts."""
    return F.date_format(_col(col), "yyyy-MM-dd")


def text_timestamp(col: Column | str) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text for string contracts."""
    return F.date_format(_col(col), "yyyy-MM-dd HH:mm:ss")


def as_day(col: Column | str) -> Column:
    """Date of a date, a timestamp or a text that starts with an ISO date."""
    return F.to_date(F.substring(_col(col).cast("string"), 1, 10))


def epoch_day(col: Column | str) -> Column:
    """Days since 1970-01-01; empty text counts as null."""
    text = F.substring(_col(col).cast("string"), 1, 10)
    return F.unix_date(F.to_date(F.nullif(text, F.lit(""))))


def unscaled(col: Column | str, precision: int = 5, scale: int = 2) -> Column:
    """Unscaled integer of a decimal, half to even; null counts as 0.

    A value that does not fit ``precision`` raises, as the wire contract would.
    """
    value = F.bround(F.coalesce(_col(col).cast("decimal(38,9)"), F.lit(0)), scale)
    fitted = value.cast(T.DecimalType(precision, scale))
    return (fitted * F.lit(10**scale)).cast("bigint")


def service_code(code: Column | str, active: Column | str, offset: int = 700) -> Column:
    """Catalogue code, moved by ``offset`` where the holder is not active."""
    code, active = _col(code).cast("int"), _col(active)
    return F.when(active, code).otherwise(code + F.lit(offset))


def parse_codes(col: Column | str, delimiter: str = ";") -> Column:
    """Delimited product codes to an array.

    Entries are trimmed; empty ones and 'none' (any case) are dropped; a leading 'none'
    glued to a code is cut off. Null text gives an empty array.
    """
    parts = F.split(F.coalesce(_col(col), F.lit("")), delimiter, -1)
    trimmed = F.filter(
        F.transform(parts, lambda p: F.trim(p)),
        lambda p: (p != "") & (F.lower(p) != "none"),
    )
    return F.transform(
        trimmed,
        lambda p: F.when(F.lower(p).startswith("none"), F.substr(p, F.lit(5))).otherwise(p),
    )


def code_variant(code: Column, country: Column) -> Column:
    """Catalogue name of a product code: term suffix depends on code and market."""
    special = F.upper(country).isin(*VARIANT_COUNTRIES) & code.isin(*VARIANT_CODES)
    return F.concat(code, F.when(special, F.lit(VARIANT_SUFFIX)).otherwise(F.lit(DEFAULT_SUFFIX)))


def parse_int_list(col: Column | str) -> Column:
    """Comma-separated ids to an array; null or empty text gives null."""
    col = _col(col)
    return F.when(
        col != "", F.transform(F.split(col, ","), lambda p: F.trim(p).cast("bigint"))
    )


def sparse_payload(*cols: Column | str) -> Column:
    """One JSON record without its null fields."""
    return F.to_json(F.struct(*cols))


def json_text(col: Column | str, language: str = "en_US") -> Column:
    """One language of a translated name stored as a JSON object."""
    return F.get_json_object(_col(col), f"$.{language}")


def normalise_type(col: Column | str) -> Column:
    """Establishment-type label to the key used by lookups."""
    col = _col(col)
    return F.coalesce(mapped(col, TYPE_NAMES), F.lower(col))


def partner_key(name: str, zip_code: str, vat: str, kind: str, is_company: str) -> Column:
    """Text that two records of the same partner share."""
    return F.concat(
        F.regexp_replace(F.lower(F.col(name)), "[ ']", ""),
        F.coalesce(F.col(zip_code), F.lit("")),
        F.coalesce(F.col(vat), F.lit("/")),
        F.col(kind),
        F.col(is_company).cast("string"),
    )


def split_by_presence(df: DataFrame, absent_all: Sequence[str], present: str) -> tuple[DataFrame, DataFrame]:
    """Two populations: rows where every column of ``absent_all`` is null, and rows that
    have ``present``."""
    absent = F.lit(True)
    for c in absent_all:
        absent = absent & F.col(c).isNull()
    return df.where(absent), df.where(F.col(present).isNotNull())


def whitelist(df: DataFrame, equals: Mapping[str, object], exclude: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows that equal the given values and whose codes are in none of the exclusion
    lists. A null code fails, as in SQL ``NOT IN``."""
    for c, value in equals.items():
        df = df.where(F.col(c) == F.lit(value))
    for c, values in exclude.items():
        df = df.where(~F.col(c).isin(*values))
    return df


def drop_blank(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable, skipped): null keys are in neither part; keys blank after trimming are
    skipped. The usable part has trimmed keys."""
    present = F.lit(True)
    filled = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
        filled = filled & (F.trim(F.col(c).cast("string")) != "")
    known = df.where(present)
    usable = known.where(filled).withColumns({c: F.trim(F.col(c).cast("string")) for c in cols})
    return usable, known.where(~filled)


def exclude_status(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows in one status, whatever its case; null passes."""
    return df.where(F.coalesce(F.lower(F.col(column)), F.lit("")) != value.lower())
