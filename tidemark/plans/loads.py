"""Preparing records for a load into another system: keys resolved, lines nested, rejects
kept with a reason."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import code_variant, parse_codes, partner_key, sparse_payload
from tidemark.functions.clock import since
from tidemark.operators.joins import (
    REASON,
    array_lookup,
    fallback_lookup,
    lookup,
    restrict_dim,
    skip_loaded,
    unique_lookup,
)
from tidemark.operators.ordering import ntile_batch
from tidemark.session import checkpointed


# Type of ``line_items`` in the invoices to load.
LINE_ITEMS = (
    "array<struct<product_code: string, description: string, quantity: double, "
    "unit_price: double, account_id: bigint, tax_names: array<string>>>"
)


def resolve_partners(
    df: DataFrame, key: str, partners: DataFrame, external_ids: DataFrame, out: str = "partner_id"
) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): partner by its own uuid, else by external id."""
    direct = partners.select(F.col("partner_uuid"), F.col("id"))
    external = external_ids.where(
        (F.col("module") == "salesforce") & (F.col("model") == "res.partner")
    ).select("name", "res_id")
    return fallback_lookup(df, key, [(direct, "partner_uuid", "id"), (external, "name", "res_id")], out)


def resolve_lines(
    invoices: DataFrame, key: str, catalogue: DataFrame, taxes: DataFrame
) -> DataFrame:
    """Line items of each invoice with product and tax ids.

    ``invoices`` has ``line_items``: an array of (product_code, description, quantity,
    unit_price, account_id, tax_names). An unknown product leaves a null id; unknown tax
    names vanish and are counted in ``unresolved_taxes`` of the invoice. Lines and tax names
    are joined one by one, then placed by invoice once for both steps of nesting; no group
    outgrows the invoice it came from.
    """
    lines = invoices.select(key, F.posexplode("line_items").alias("_pos", "_line"))
    flat = lines.select(key, "_pos", F.col("_line.*"))
    coded = lookup(flat, catalogue, [("product_code", "name")], "res_id", "product_id")
    line = F.struct(
        F.col("description").alias("name"), "product_id", "quantity", F.col("unit_price").alias("price_unit"), "account_id"
    )
    taxed = coded.select(key, "_pos", line.alias("_line"), F.posexplode_outer("tax_names").alias("_tax_no", "_tax"))
    known = lookup(taxed, taxes, [("_tax", "name")], "id", "_tax_id")
    found = F.when(F.col("_tax_id").isNotNull(), F.struct("_tax_no", "_tax_id"))
    per_line = known.repartition(key).groupBy(key, "_pos").agg(
        F.first("_line").alias("_line"),
        F.sort_array(F.collect_list(found)).alias("_taxes"),
        F.count(F.when(F.col("_tax_no").isNotNull() & F.col("_tax_id").isNull(), 1)).alias("_misses"),
    )
    full = F.col("_line").withField("tax_ids", F.transform("_taxes", lambda x: x["_tax_id"]))
    return per_line.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", full.alias("line")))), lambda x: x["line"]).alias(
            "invoice_line_ids"
        ),
        F.sum("_misses").alias("unresolved_taxes"),
    )


def prepare_invoices(
    invoices: DataFrame,
    loaded: DataFrame,
    partners: DataFrame,
    external_ids: DataFrame,
    taxes: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """(ok, rejected) invoices that are not loaded yet.

    ``loaded`` holds the names already in the target; of copies within the batch the first
    is taken. An invoice whose partner nobody knows is rejected with the reason.
    """
    # Headers, lines and rejects all start from these rows; find them once.
    fresh = checkpointed(skip_loaded(invoices, loaded, "move_name", ["write_date"]))
    resolved, rejected = resolve_partners(fresh, "partner_uuid", partners, external_ids)
    catalogue = external_ids.where(F.col("module") == "dish_product_catalog").select("name", "res_id")
    lines = resolve_lines(fresh, "move_name", catalogue, taxes)
    empty = F.array().cast(lines.schema["invoice_line_ids"].dataType)
    ok = resolved.join(lines, "move_name", "left").select(
        F.col("move_name").alias("name"),
        "partner_id", "invoice_date", "invoice_date_due", "move_type", "currency_id", "journal_id",
        F.col("reference").alias("ref"),
        F.coalesce("invoice_line_ids", empty).alias("invoice_line_ids"),
        F.coalesce("unresolved_taxes", F.lit(0)).alias("unresolved_taxes"),
    )
    return ok, rejected.select("move_name", F.col(REASON).alias("error"), "partner_uuid")


def prepare_leads(
    leads: DataFrame,
    countries: DataFrame,
    languages: DataFrame,
    channels: DataFrame,
    stores: DataFrame,
    catalogue: DataFrame,
    establishment_type: int,
    load_date: date,
) -> tuple[DataFrame, DataFrame]:
    """(payloads, rejected) for the leads of one load date.

    Lookups are ``(name, id)`` tables (``stores``: ``code, id``; ``catalogue``: ``name,
    res_id``). A lead without a country is rejected; a null name stays out of
    ``contact_name`` instead of becoming text. Unknown product codes vanish and are counted.
    """
    keyed = leads.where(F.col("load_date") == F.lit(load_date)).distinct()
    reason = F.when(F.col("metro_id_country").isNull(), F.lit("metro_id_country is missing"))
    judged = keyed.withColumn(REASON, reason)
    rejected = judged.where(F.col(REASON).isNotNull())
    good = judged.where(F.col(REASON).isNull()).drop(REASON)

    country = F.upper("metro_id_country")
    codes = F.transform(parse_codes("product_codes"), lambda c: code_variant(c, country))
    row_key = F.md5(F.to_json(F.struct(*good.columns)))
    coded = good.withColumns(
        {"_row": row_key, "_codes": codes, "_country": country, "_lang": F.lower("primary_language"), "_merchant": F.upper("merchant")}
    )
    out = array_lookup(coded, ["_row"], "_codes", catalogue, "name", "res_id", "_products", "unresolved_products")
    out = lookup(out, countries, [("_country", "name")], "id", "country_id")
    out = lookup(out, languages, [("_lang", "name")], "id", "lang_id")
    out = lookup(out, channels, [("lead_source", "name")], "id", "source_id")
    out = lookup(out, channels, [("channel_v2", "name")], "id", "medium_id")
    out = lookup(out, channels, [("_merchant", "name")], "id", "reseller_id")
    out = lookup(out, channels, [("reseller", "name")], "id", "partner_assigned_id")
    out = lookup(out, stores, [("store", "code")], "id", "store_id", default=0)
    contact = F.nullif(F.concat_ws(" ", "first_name", "last_name"), F.lit(""))
    text = F.concat(
        F.lit("Company VAT ID: "), F.coalesce("vat_id", F.lit("")),
        F.lit(", Product codes: "), F.coalesce("product_codes", F.lit("")),
    )
    fields = {
        "contact_name": contact,
        "email_from": F.col("email"),
        "phone": F.col("phone"),
        "mobile": F.col("mobile_phone"),
        "country_id": F.col("country_id"),
        "zip": F.col("company_postal_code"),
        "city": F.col("company_city"),
        "street": F.col("company_street"),
        "establishment_zip": F.col("establishment_postal_code"),
        "establishment_city": F.col("establishment_city"),
        "establishment_street": F.col("establishment_street"),
        "store_id": F.col("store_id"),
        "establishment_name": F.col("establishment"),
        "name": F.col("establishment"),
        "lang_id": F.col("lang_id"),
        "source_id": F.col("source_id"),
        "medium_id": F.col("medium_id"),
        "function": F.col("role"),
        "reseller_id": F.col("reseller_id"),
        "partner_assigned_id": F.col("partner_assigned_id"),
        "metro_id": F.col("metro_id"),
        "description": text,
        "user_id": F.lit(False),
        "product_ids": F.when(F.size("_products") > 0, F.col("_products")),
        "establishment_type": F.lit(establishment_type),
    }
    payloads = out.select(
        "metro_id",
        "unresolved_products",
        sparse_payload(*[c.alias(n) for n, c in fields.items()]).alias("payload"),
    )
    return payloads, rejected


def partner_ids(partners: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by identity, by duplicate key) of the partners a batch mentions.

    By identity: smallest id per (uuid, is_company, type). By duplicate key: smallest id
    per (name/zip/vat/type text, uuid).
    """
    mine = restrict_dim(
        partners, "partner_uuid", batch, ["account_id", "company_id", "establishment_id"], ["-contact"]
    )
    identity = unique_lookup(mine, ["partner_uuid", "is_company", "type"], "id", "id")
    keyed = mine.withColumn("duplicate_key", partner_key("name", "zip", "vat", "type", "is_company"))
    return identity, unique_lookup(keyed, ["duplicate_key", "partner_uuid"], "id", "id")


def prepare_opportunities(
    opportunities: DataFrame,
    partners: DataFrame,
    lookups: Mapping[str, DataFrame],
    as_of: date,
    days: int | None = 1,
    tile: int | None = None,
) -> DataFrame:
    """``opportunity_id, payload`` of a daily window (``days``) or of one of ten batches of
    a full load (``tile``).

    ``lookups`` holds ``(name, id)`` tables for salutation, utm_medium, utm_source,
    country_code and est_type.
    """
    if tile is not None:
        batch = ntile_batch(opportunities, ["id"], 10, tile).drop("tile")
    else:
        batch = since(opportunities, "last_modified", as_of, days=days)
    identity, _ = partner_ids(partners, batch)
    # An opportunity's company is a partner record of kind (company, contact).
    companies = identity.where(F.col("is_company") & (F.col("type") == "contact"))
    out = lookup(batch, companies, [("company_id", "partner_uuid")], "id", "partner_id")
    for column, name in (
        ("salutation", "title_id"),
        ("utm_medium", "medium_id"),
        ("utm_source", "source_id"),
        ("country_code", "country_id"),
        ("est_type", "establishment_type"),
    ):
        out = lookup(out, lookups[column], [(column, "name")], "id", name)
    return out.select(
        "opportunity_id",
        sparse_payload(
            F.col("opportunity_name").alias("name"),
            "partner_id",
            F.lit("opportunity").alias("type"),
            "stage_id", "user_id", "expected_revenue", "probability",
            F.col("close_date").alias("date_deadline"),
            "title_id", "medium_id", "source_id", "country_id", "establishment_type",
        ).alias("payload"),
    )
