"""Columns that an operator only carries, folded into one so that no name can clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "_rest"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def folded(docs: DataFrame, needed: list[str], new: list[str]) -> DataFrame:
    """``needed`` columns and a struct of the others, without those that ``new`` ones replace."""
    others = [c for c in docs.columns if c not in needed and c not in new]
    rest = F.struct(*(F.col(_quoted(c)) for c in others)) if others else F.lit(None).cast("int")
    return docs.select(*needed, rest.alias(REST))


def unfolded(docs: DataFrame, needed: list[str], new: list[str]) -> list[Column]:
    """The columns of ``docs`` in their order, to select from what :func:`folded` gave, but for ``new``."""
    return [
        F.col(c) if c in needed else F.col(REST).getField(c).alias(c) for c in docs.columns if c in needed or c not in new
    ]
