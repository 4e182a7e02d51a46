"""Key and row hashes over one canonical string form per type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYHASH = "_keyhash"
ROWHASH = "_rowhash"
SEPARATOR = "|"


def canonical(name: str, dtype: T.DataType) -> str:
    """SQL of the text a column contributes to a hash; null contributes ''.

    Floating point goes through a decimal with four places, because the text of a raw
    double differs between engines (``1``, ``1.0``, ``1.0E10``). A value that needs more adds
    itself with 15 significant digits, as many as every double holds: the smallest true change
    shows, and noise in the last bit of a computed amount does not. Values a decimal cannot
    hold (NaN, infinities) are their own text alone.
    """
    col = f"`{name}`"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        short = f"try_cast({col} as decimal(38,4))"
        digits, kept = (f"format_string('%.14e', double({x}))" for x in (col, short))
        more = f"if(double({short}) = double({col}) or {kept} = {digits}, '', '~' || {digits})"
        return f"coalesce(string({short}) || {more}, string({col}), '')"
    if isinstance(dtype, T.BinaryType):
        return f"coalesce(hex({col}), '')"
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return f"coalesce(to_json({col}), '')"
    return f"coalesce(string({col}), '')"


def hash_of(df: DataFrame, cols: Sequence[str]) -> Column:
    """MD5 hex over the pipe-joined canonical form of ``cols`` of ``df``.

    A pipe inside a value can collide with the separator; the format is kept because
    consumers compare stored hashes. (One SQL expression, as payloads are wide.)
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = ", ".join(canonical(c, types[c]) for c in cols)
    return F.expr(f"md5(concat_ws('{SEPARATOR}', {parts}))")


def with_hashes(df: DataFrame, key: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Add ``_keyhash`` over ``key`` and ``_rowhash`` over ``payload``.

    Both lists are explicit: a column left out of ``payload`` never makes a delta.
    """
    return df.withColumns({KEYHASH: hash_of(df, key), ROWHASH: hash_of(df, payload)})
