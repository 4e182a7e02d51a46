"""Matches plus product footprint as one service row per customer and product."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import as_day, parse_quality, rounded_long, service_code, text_date, text_timestamp
from tidemark.functions.clock import VALID_FLAG, day
from tidemark.functions.contracts import PARTNER_MATCHING
from tidemark.operators.aggregates import min_max_by
from tidemark.operators.joins import full_outer_coalesce, null_safe_join, propagate_active
from tidemark.operators.reshape import Flag, unpivot_flags
from tidemark.operators.select import best_per_key
from tidemark.session import checkpointed

# Accept threshold (lower is a stronger match), open end, the two match
# requests, and the offset of codes of customers without an active establishment.
MATCH_QUALITY_MAX = 150
OPEN_END = "2949-12-31"
REQUEST_BY_BOOKING_ID = "mcc_company_booq_establishment"
REQUEST_BY_CRM_ID = "sf_establishment_mcc_company"


@dataclass(frozen=True)
class Product:
    """A product flag of the base table with its date columns and catalogue entry."""

    flag: str
    code: int
    label: str
    created: str | None = None
    ended: str | None = None
    last_end: bool = True


# The service catalogue. ``last_end`` tells whether the latest or the earliest
# end date of an establishment counts.
CATALOGUE = (
    Product("has_dish_website", 100, "Dish Website", "dish_website_createddate", "dish_website_deleteddate"),
    Product("has_dish_reservation", 101, "Dish Reservation", "dish_reservation_createddate", "dish_reservation_deleteddate"),
    Product("has_mto_starter", 102, "Dish Starter", "mto_starter_createddate", "mto_starter_disableddate", False),
    Product("has_mto_prof", 103, "Dish Professional Reservation", "mto_prof_createddate", "mto_prof_disableddate", False),
    Product("has_mto_proforder", 104, "Dish Professional Order", "mto_proforder_createddate", "mto_proforder_disableddate", False),
    Product("has_mto_premium", 105, "Dish Premium", "mto_premium_createddate", "mto_premium_disableddate", False),
    Product("has_dish_order", 106, "Dish Order", "dish_order_createddate", "dish_order_deleteddate"),
    Product("has_dish_weblisting", 107, "Dish WebListing", "dish_weblisting_createddate", "dish_weblisting_deleteddate"),
    Product("has_menukit", 108, "Dish MenuKit", "menukit_createddate", "menukit_deleteddate"),
    Product("has_cockpit", 109, "Dish Cockpit", "cockpit_createddate"),
    Product("has_lynn", 110, "Dish Lynn", "lynn_createddate"),
    Product("has_Dish_POS", 111, "Dish POS", "Dish_POS_createdDate", "Dish_POS_deletedDate"),
    Product("has_MenuEngineering", 201, "GastroConsulting"),
)
# A product that is not exported, but splits the groups of the base table.
UNEXPORTED_FLAGS = ("has_dish_teamplan",)

CUSTOMER = [
    "unique_metro_id", "UID__c", "HD_cust_ident", "unique_home_store_id", "unique_cust_no",
    "country", "status_cd", "blocking_reason_cd", "match_quality",
]
ACTIVITY = [
    "establishment_active", "establishment_activity_score", "date_acquisition",
    "date_deletion", "SFDC_createdDate",
]
EXPORTED = PARTNER_MATCHING.names


def establishment_footprint(base: DataFrame, catalogue: Sequence[Product] = CATALOGUE) -> DataFrame:
    """Base table grouped by establishment, flags and activity, with first / last dates."""
    names = base.columns
    flags = [p.flag for p in catalogue] + [f for f in UNEXPORTED_FLAGS if f in names]
    mins = {p.created: p.created for p in catalogue if p.created in names}
    mins |= {p.ended: p.ended for p in catalogue if p.ended in names and not p.last_end}
    maxs = {p.ended: p.ended for p in catalogue if p.ended in names and p.last_end}
    mins["date_acquisition"] = "date_acquisition"
    maxs |= {"date_deletion": "date_deletion", "SFDC_createdDate": "SFDC_createdDate"}
    keys = ["id_est", "establishment_sfid", "booq_id", *flags, "establishment_activity_score", "establishment_active"]
    return (
        min_max_by(base, keys, mins, maxs)
        .withColumnsRenamed({"id_est": "HD_cust_ident", "establishment_sfid": "UID__c"})
    )


def accepted_matches(matches: DataFrame, max_quality: int = MATCH_QUALITY_MAX) -> DataFrame:
    """Valid matches of the two requests up to the quality threshold."""
    return (
        matches.where(
            F.col("original_request").isin(REQUEST_BY_BOOKING_ID, REQUEST_BY_CRM_ID)
            & F.col(VALID_FLAG)
            & (parse_quality("match_quality") <= max_quality)
        )
        .select(
            F.upper("iso_code").alias("country"),
            "id_source_1", "id_source_2", "unique_metro_id", "original_request", "list_type",
            parse_quality("match_quality").alias("match_quality"),
        )
        .distinct()
    )


def matched_customers(matches: DataFrame, wholesale: DataFrame, max_quality: int = MATCH_QUALITY_MAX) -> DataFrame:
    """Both kinds of match per wholesale id, with wholesale attributes; CRM match wins."""
    raw = accepted_matches(matches, max_quality)
    keep = ["country", "unique_metro_id", "list_type", "match_quality"]

    def of(request: str, id_col: str, name: str) -> DataFrame:
        mine = raw.where(F.col("original_request") == request)
        return mine.select(*keep, F.col(id_col).alias(name)).distinct()

    by_crm = of(REQUEST_BY_CRM_ID, "id_source_1", "UID__c").drop("list_type").distinct()
    by_booking = of(REQUEST_BY_BOOKING_ID, "id_source_2", "booq_id").drop("list_type").distinct()
    both = full_outer_coalesce(by_crm, by_booking, ["country", "unique_metro_id"], ["match_quality"])
    attributes = wholesale.select(
        F.upper("country").alias("country"),
        F.col("unique_metro_id").cast("string").alias("unique_metro_id"),
        F.col("unique_home_store_id").cast("string").alias("unique_home_store_id"),
        F.col("unique_cust_no").cast("string").alias("unique_cust_no"),
        "status_cd",
        "blocking_reason_cd",
    )
    return both.join(attributes, ["country", "unique_metro_id"], "left").distinct()


def service_rows(customers: DataFrame, footprint: DataFrame, catalogue: Sequence[Product] = CATALOGUE) -> DataFrame:
    """One row per customer and product it has, with the code of active or inactive holders."""
    a = customers.withColumn("booking_key", F.lower("booq_id")).drop("booq_id")
    b = footprint.withColumn("booking_key", F.lower("booq_id")).drop("booq_id")
    joined = null_safe_join(a, b, ["UID__c", "booking_key"])
    flags = [Flag(p.flag, p.label, p.code, p.created, p.ended) for p in catalogue]
    # Read four times from here on: computed once, in the shared folder.
    rows = checkpointed(unpivot_flags(joined, flags, [*CUSTOMER, *ACTIVITY], "w360_service_desc", "_code"))
    marked = propagate_active(
        rows, ["country", "unique_metro_id"], ["country", "UID__c"], F.col("establishment_active") == 1, "_active"
    )
    return marked.withColumn("w360_service_cd", service_code("_code", "_active")).drop("_code", "_active")


def one_establishment(rows: DataFrame, compat: str | None = None) -> DataFrame:
    """Keep all rows of one establishment per wholesale id.

    The most active one wins, then the one with the oldest start, then the smallest id.
    ``compat="id_first"`` takes the highest id first, as an older export did.
    """
    key = ["country", "unique_metro_id"]
    if compat == "id_first":
        pick = F.max(F.struct("HD_cust_ident", "establishment_activity_score"))
        best = rows.groupBy(*key).agg(pick["HD_cust_ident"].alias("HD_cust_ident"))
    elif compat is None:
        few = rows.select(*key, "HD_cust_ident", "establishment_activity_score", "date_from")
        best = best_per_key(few, key, ["-establishment_activity_score", "date_from", "HD_cust_ident"])
    else:
        raise ValueError(f"unknown compat {compat!r}")
    return null_safe_join(rows, best.select(*key, "HD_cust_ident"), [*key, "HD_cust_ident"], "left_semi")


def fill_service_dates(rows: DataFrame) -> DataFrame:
    """Service period as text: from falls back to acquisition, to on deletion or open end."""
    return rows.withColumns(
        {
            "date_from": text_date(F.coalesce("date_from", "date_acquisition")),
            "date_to": F.coalesce(text_date(F.coalesce("date_to", "date_deletion")), F.lit(OPEN_END)),
        }
    )


def organise(rows: DataFrame, as_of: date | datetime) -> DataFrame:
    """Staging types of the export; missing ids become 0, missing texts stay null."""
    return rows.select(
        F.coalesce(rounded_long("unique_home_store_id"), F.lit(0)).alias("unique_home_store_id"),
        F.coalesce(rounded_long("unique_cust_no"), F.lit(0)).alias("unique_cust_no"),
        "country",
        F.col("w360_service_cd").cast("string").alias("w360_service_cd"),
        "w360_service_desc",
        "date_from",
        "date_to",
        F.lit(0.0).alias("price"),
        F.col("HD_cust_ident").cast("string").alias("HD_cust_ident"),
        F.lit(str(day(as_of))).alias("creation_date"),
        F.col("UID__c").cast("string").alias("UID__c"),
        text_timestamp("SFDC_createdDate").alias("SFDC_createdDate"),
        F.col("status_cd").cast("string").alias("status_cd"),
        F.col("blocking_reason_cd").cast("string").alias("blocking_reason_cd"),
        F.col("match_quality").cast("bigint").alias("match_quality"),
    )


def matching_export(
    matches: DataFrame,
    base: DataFrame,
    wholesale: DataFrame,
    as_of: date | datetime,
    catalogue: Sequence[Product] = CATALOGUE,
    max_quality: int = MATCH_QUALITY_MAX,
    compat: str | None = None,
) -> DataFrame:
    """Staging rows of all markets at once; ``country`` is part of every key."""
    customers = matched_customers(matches, wholesale, max_quality)
    rows = service_rows(customers, establishment_footprint(base, catalogue), catalogue)
    dated = fill_service_dates(one_establishment(rows, compat))
    return organise(dated, as_of).distinct()


def matching_feed(staging: DataFrame, country: str) -> DataFrame:
    """One market's staging rows with dates typed for the event contract."""
    mine = staging.where(F.lower("country") == country.lower())
    typed = mine.withColumns({c: as_day(c) for c in ("date_from", "date_to", "creation_date")})
    return typed.select(*EXPORTED)
