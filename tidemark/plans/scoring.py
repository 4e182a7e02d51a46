"""First-offer and next-offer scores of all markets as one hashed snapshot."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import (
    manager_information,
    potential_level,
    split_by_presence,
    upsell_probability,
    whitelist,
)
from tidemark.functions.clock import day, stamp_scd
from tidemark.functions.hashing import with_hashes
from tidemark.operators.joins import join_unique
from tidemark.operators.reshape import union_positional
from tidemark.plans.delta import delta_payload

# Potential categories as the two models name them, and their levels.
PROSPECT_LEVELS = {"very_high_potential": 1, "high_potential": 2}
CUSTOMER_LEVELS = {"High Potential": 1, "Potential": 2}

# Customers that may be contacted.
ALLOWED = {"status_cd": 1}
BLOCKED = {
    "blocking_reason_cd": ["2", "3", "4", "6", "7", "8", "9"],
    "entry_check_cd": [65, 68],
    "checkout_check_cd": [31, 35],
}

DIMENSIONS = [
    "metro_id", "establishment_name", "sfdc_establishment_id", "street_name", "street_number",
    "postal_code", "city", "phone", "email", "establishment_type", "iso_code",
]
SCORES = [
    "potential_level", "bundle_recommendation", "bundle_potential_score", "pos_recommendation",
    "pos_potential_score", "pay_recommendation", "pay_potential_score",
]

# Payload order, and the columns of both hashes. The name and the load date
# are no part of the row hash, so neither makes a delta.
PAYLOAD = [
    "metro_id", "establishment_id", "establishment_name", "street_name", "street_number",
    "postal_code", "city", "iso_code", "manager_information", "first_name", "mobilephone",
    "establishment_type", *SCORES, "_ldts",
]
KEY = ["iso_code", "metro_id"]
HASHED = [c for c in PAYLOAD if c not in ("establishment_name", "_ldts")]
REQUIRED = [
    "establishment_id", "establishment_name", "street_name", "street_number", "postal_code",
    "city", "iso_code", "manager_information", "first_name", "mobilephone",
    "establishment_type", "bundle_recommendation", "_ldts",
]
DEFAULT_LEVEL = {"potential_level": 99}


def prospect_scores(scores: DataFrame) -> DataFrame:
    """First-offer scores per wholesale id."""
    return scores.select(
        F.col("metro_id").cast("bigint").alias("metro_id"),
        "country_code",
        F.col("FBO_dish_prob").alias("score"),
        F.col("FBO_dish_recommendation").alias("prediction"),
        potential_level("FBO_dish_bundle_cat", PROSPECT_LEVELS).alias("potential_level"),
        F.col("FBO_dish_bundle_recommendation").alias("bundle_recommendation"),
        F.round("FBO_dish_bundle_prob", 4).alias("bundle_potential_score"),
        F.col("FBO_dish_pos_recommendation").cast("bigint").alias("pos_recommendation"),
        F.round("FBO_dish_pos_prob", 4).alias("pos_potential_score"),
        F.col("FBO_dish_pay_recommendation").cast("bigint").alias("pay_recommendation"),
        F.round("FBO_dish_pay_prob", 4).alias("pay_potential_score"),
    ).distinct()


def customer_scores(scores: DataFrame) -> DataFrame:
    """Next-offer scores per CRM establishment."""
    res, order = "NBO_dish_reservation", "NBO_dish_order"
    recommended = (F.col(f"{res}_recommendation") == 1) | (F.col(f"{order}_recommendation") == 1)
    return scores.select(
        F.col("establishment_sfid").alias("crm_id"),
        "country_code",
        upsell_probability(
            f"{res}_recommendation", f"{res}_prob", f"{order}_recommendation", f"{order}_prob"
        ).alias("upsell_proba"),
        F.when(recommended, 1).otherwise(0).alias("sf_cust_pre"),
        potential_level("NBO_dish_bundle_cat", CUSTOMER_LEVELS).alias("potential_level"),
        F.col("NBO_dish_bundle_recommendation").alias("bundle_recommendation"),
        F.round("NBO_dish_bundle_prob", 4).alias("bundle_potential_score"),
        F.col("NBO_dish_pos_recommendation").cast("bigint").alias("pos_recommendation"),
        F.round("NBO_dish_pos_prob", 4).alias("pos_potential_score"),
        F.col("NBO_dish_pay_recommendation").cast("bigint").alias("pay_recommendation"),
        F.round("NBO_dish_pay_prob", 4).alias("pay_potential_score"),
    ).distinct()


def combined_scores(establishments: DataFrame, prospects: DataFrame, customers: DataFrame) -> DataFrame:
    """Both score sets under common names, with ``score_type``, ``score`` and ``prediction``.

    Establishments without any CRM id take first-offer scores by wholesale id; those with a
    CRM establishment id take next-offer scores by that id.
    """
    unlinked, linked = split_by_presence(
        establishments, ["sfdc_establishment_id", "sfdc_account_id"], "sfdc_establishment_id"
    )
    keep = ["country", *DIMENSIONS]
    first = unlinked.select(*keep).distinct().join(prospect_scores(prospects), "metro_id")
    scored = customer_scores(customers)
    following = linked.select(*keep).distinct().join(scored, F.col("sfdc_establishment_id") == F.col("crm_id"))
    names = ["score_type", *keep, "score", "prediction", *SCORES]
    return union_positional(
        first.select(F.lit("FBO").alias("score_type"), *keep, "score", "prediction", *SCORES),
        following.select(F.lit("NBO").alias("score_type"), *keep, "upsell_proba", "sf_cust_pre", *SCORES),
        names,
    )


def scoring_snapshot(
    establishments: DataFrame,
    prospects: DataFrame,
    customers: DataFrame,
    allowed: DataFrame,
    persons: DataFrame,
    as_of: date | datetime,
) -> DataFrame:
    """Today's scores of all markets with hashes and version columns.

    ``establishments``, ``allowed`` (wholesale customers) and ``persons`` (their authorised
    persons) carry ``country``; all markets go through the same two joins at once.
    """
    combined = combined_scores(establishments, prospects, customers)
    white = whitelist(allowed, ALLOWED, BLOCKED).select("country", "metro_id").distinct()
    contact = (
        persons.where(F.col("auth_person_id") == 1)
        .select("country", F.col("unique_metro_id").alias("metro_id"), "first_name", "last_name")
        .distinct()
    )
    joined = join_unique(combined, white, ["country", "metro_id"], "left_semi").join(contact, ["country", "metro_id"])
    payload = joined.where(F.col("bundle_recommendation").isNotNull()).select(
        "metro_id",
        F.col("sfdc_establishment_id").alias("establishment_id"),
        "establishment_name", "street_name", "street_number", "postal_code", "city", "iso_code",
        manager_information("first_name", "last_name", "phone", "email").alias("manager_information"),
        "first_name",
        F.col("phone").alias("mobilephone"),
        "establishment_type",
        *SCORES,
        F.lit(str(day(as_of))).alias("_ldts"),
    )
    return stamp_scd(with_hashes(payload.distinct(), KEY, HASHED), as_of)


def scoring_payload(delta: DataFrame, country: str) -> DataFrame:
    """One market's delta as the event contract wants it."""
    return delta_payload(delta, country, "iso_code", REQUIRED, DEFAULT_LEVEL)
