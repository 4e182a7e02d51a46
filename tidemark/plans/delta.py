"""What every hash-delta export shares: payload per market and contract check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import required_strings


def delta_payload(
    delta: DataFrame,
    country: str,
    country_col: str = "iso_code",
    required: Sequence[str] = (),
    defaults: Mapping[str, int] | None = None,
    drop: Sequence[str] = ("_keyhash", "_rowhash", "_valid_from", "_valid_until", "_valid_flag"),
) -> DataFrame:
    """One market's rows of a delta, version columns dropped, required texts filled.

    A market without rows gives an empty result, not an error.
    """
    mine = delta.where(F.upper(F.col(country_col)) == country.upper())
    return required_strings(mine, required, defaults).drop(*drop)
