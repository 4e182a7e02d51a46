"""Lead, asset and voucher deltas by validity or creation window; helpdesk and invoices."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import required_strings
from tidemark.functions.clock import current_opened_today, day, opened_on, since
from tidemark.functions.contracts import ASSET, ASSET_NAMES, LEAD, TICKET, VOUCHER
from tidemark.sources.tables import append_batch, fan_out

# Source names of the asset columns: the contract's, but for the renamed ones.
_SOURCE = {contract: source for source, contract in ASSET_NAMES.items()}
ASSET_COLUMNS = [_SOURCE.get(c, c) for c in ASSET.names]


def lead_delta(df: DataFrame, as_of: date | datetime, country: str) -> DataFrame:
    """Current lead versions of one market that opened today; null texts become ''."""
    mine = current_opened_today(df, as_of, "lead_country_code", country)
    texts = [c for c in LEAD.names if c != "_ldts"]
    filled = required_strings(mine, texts)
    return filled.withColumn("_ldts", F.col("_ldts").cast("date")).select(*LEAD.names).distinct()


def asset_delta(df: DataFrame, as_of: date | datetime, country: str) -> DataFrame:
    """Current asset versions of one market that opened today, under source names.

    ``rename(..., ASSET_NAMES)`` gives contract names.
    """
    mine = current_opened_today(df, as_of, "country_code", country)
    typed = mine.withColumns(
        {
            "sfdc_internal_establishment_id": F.col("sfdc_internal_establishment_id").cast("string"),
            "asset_install_date": F.col("asset_install_date").cast("string"),
            "establishment_active": F.coalesce(F.col("establishment_active") == 1, F.lit(False)),
        }
    )
    return typed.select(*ASSET_COLUMNS).distinct()


def voucher_delta(df: DataFrame, as_of: date | datetime, country: str) -> DataFrame:
    """Vouchers of one market created since yesterday. No versions: a fact extract."""
    fresh = since(df.where(F.upper("country_code") == country.upper()), "asset_created_date", as_of, days=1)
    native = ("partner_id", "price", "recurring_invoice", "is_subscription")
    return fresh.select(*[F.col(c) if c in native else F.col(c).cast("string").alias(c) for c in VOUCHER.names])


def helpdesk_delta(df: DataFrame, as_of: date | datetime) -> DataFrame:
    """Yesterday's tickets that have a number, with timestamps as text."""
    fresh = opened_on(df.where(F.col("ticket_number").isNotNull()), "create_date", as_of)
    texts = {c: F.col(c).cast("string") for c in ("create_date", "close_date")}
    return fresh.withColumns(texts).select(*TICKET.names)


def keyed_invoices(df: DataFrame, key: str = "uni_key") -> DataFrame:
    """All columns of the rows that have a key."""
    return df.where(F.col(key).isNotNull())


def dual_export(
    df: DataFrame,
    as_of: date | datetime,
    history: str,
    sinks: Sequence[Callable[[DataFrame], None]] = (),
    key: str = "uni_key",
) -> DataFrame:
    """The keyed rowset to ``sinks`` and then to a daily history, from one read."""
    rows = keyed_invoices(df, key)
    fan_out(rows, [*sinks, lambda kept: append_batch(kept, history, day(as_of))])
    return rows
