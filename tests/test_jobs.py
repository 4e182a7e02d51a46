"""The data jobs on small frames with their edge rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import contracts
from tidemark.functions.clean import rename
from tidemark.operators.scd import delta_cycle
from tidemark.plans import assets, commission, lifecycle, loads, matching_export, products, scoring, terminals

AS_OF = date(2024, 1, 30)


# --- scoring ---------------------------------------------------------------------------------


def scoring_frames(spark):
    est = spark.createDataFrame(
        [("FR", 1, None, None, "FR"), ("FR", 2, "E2", "A2", "FR"), ("FR", 3, None, "A3", "FR"), ("DE", 4, "E4", None, "DE"), ("FR", 5, None, None, "FR")],
        "country string, metro_id long, sfdc_establishment_id string, sfdc_account_id string, iso_code string")
    for c in ("establishment_name", "street_name", "street_number", "postal_code", "city", "email", "establishment_type"):
        est = est.withColumn(c, F.lit(c))
    est = est.withColumn("phone", F.when(F.col("metro_id") != 4, "p"))
    prospects = spark.range(1, 6).select(
        F.col("id").alias("metro_id"), F.lit("x").alias("country_code"), F.lit(0.5).alias("FBO_dish_prob"), F.lit(1).alias("FBO_dish_recommendation"),
        F.when(F.col("id") == 1, "very_high_potential").alias("FBO_dish_bundle_cat"), F.lit(0.123456).alias("FBO_dish_bundle_prob"),
        F.when(F.col("id") != 5, "B").alias("FBO_dish_bundle_recommendation"), F.lit(1.0).alias("FBO_dish_pos_recommendation"),
        F.lit(0.2).alias("FBO_dish_pos_prob"), F.lit(0).alias("FBO_dish_pay_recommendation"), F.lit(0.3).alias("FBO_dish_pay_prob"))
    customers = spark.createDataFrame([("E2",), ("E4",)], "establishment_sfid string").select(
        "establishment_sfid", F.lit("x").alias("country_code"), F.lit(1).alias("NBO_dish_reservation_recommendation"), F.lit(0.2).alias("NBO_dish_reservation_prob"),
        F.lit(0).alias("NBO_dish_order_recommendation"), F.lit(0.6).alias("NBO_dish_order_prob"), F.lit("Potential").alias("NBO_dish_bundle_cat"),
        F.lit(0.5).alias("NBO_dish_bundle_prob"), F.lit("B").alias("NBO_dish_bundle_recommendation"), F.lit(1).alias("NBO_dish_pos_recommendation"),
        F.lit(0.2).alias("NBO_dish_pos_prob"), F.lit(0).alias("NBO_dish_pay_recommendation"), F.lit(0.3).alias("NBO_dish_pay_prob"))
    allowed = est.select("country", "metro_id", F.lit(1).alias("status_cd"), F.lit("1").alias("blocking_reason_cd"), F.lit(1).alias("entry_check_cd"), F.lit(1).alias("checkout_check_cd"))
    persons = est.select("country", F.col("metro_id").alias("unique_metro_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"), F.lit(1).alias("auth_person_id"))
    return dict(establishments=est, prospects=prospects, customers=customers, allowed=allowed, persons=persons)


def test_scoring_populations_levels_and_contacts(spark):
    got = {r["metro_id"]: r for r in scoring.scoring_snapshot(**scoring_frames(spark), as_of=AS_OF).collect()}
    # 3 has an account but no establishment id: neither population; 5 has no recommendation.
    assert set(got) == {1, 2, 4}
    assert (got[1]["potential_level"], got[2]["potential_level"]) == (1, 2)
    assert got[1]["bundle_potential_score"] == 0.1235
    assert got[2]["establishment_id"] == "E2" and got[1]["establishment_id"] is None
    assert got[1]["manager_information"] == "A, B, p, email" and got[4]["manager_information"] is None


def test_scoring_hash_ignores_name_and_load_date(spark):
    frames = scoring_frames(spark)
    one = scoring.scoring_snapshot(**frames, as_of=AS_OF)
    frames["establishments"] = frames["establishments"].withColumn("establishment_name", F.lit("other"))
    two = scoring.scoring_snapshot(**frames, as_of=date(2024, 2, 28))
    assert rows(one, "_keyhash", "_rowhash") == rows(two, "_keyhash", "_rowhash")


def test_scoring_payload_meets_the_contract(spark):
    snapshot = scoring.scoring_snapshot(**scoring_frames(spark), as_of=AS_OF)
    payload = scoring.scoring_payload(snapshot, "fr")
    ok, bad = contracts.validate(payload, contracts.SCORING)
    assert rows(ok, "metro_id") == [(1,), (2,)] and bad.count() == 0
    assert scoring.scoring_payload(snapshot, "PL").count() == 0


# --- commission ------------------------------------------------------------------------------


LINE = ("ParentBill string, BookingDate timestamp_ntz, ActualDeliveryStart timestamp_ntz, SalesRegion string, Company string, SalesAgencyID string, Merchant string, "
        "SalesforceOrderID string, SalesforceEstablishmentID string, SalesforceAccountID string, ProductCode string, ProductBaseCode string, ProductName string, Label string, "
        "ProductIsSetup boolean, PriceAdjustment string, Quantity double, UnitPrice double, NetPriceEUR double, EntryType string")


def line(**over):
    base = dict(bill="B1", at=datetime(2024, 1, 10), region="France", agency="PARTNER-1", code="POS", base="POS", name="Till", setup=False, promo=None, q=2.0, unit=10.0, net=20.0, entry="out_invoice")
    base.update(over)
    b = base
    return (b["bill"], b["at"], b["at"], b["region"], " C ", b["agency"], "M", "O", " E1 ", "A", b["code"], b["base"], b["name"], "L", b["setup"], b["promo"], b["q"], b["unit"], b["net"], b["entry"])


def commission_of(spark, lines, **over):
    prices = spark.createDataFrame(
        [("FR", "POS", "Recurring", date(2024, 1, 1), date(2024, 1, 31), 1.0, 4.0, 8.0), ("FR", "POS", "ACTIVATION", date(2024, 1, 1), date(2024, 1, 31), 2.0, 5.0, 0.0),
         ("DE", "POS", "recurring", date(2024, 1, 1), date(2024, 1, 31), 9.0, 9.0, 9.0)],
        "country string, product_code string, fee_type string, price_start_date date, price_end_date date, platform_cost_eur double, partner_commission_eur double, customer_cost_local double")
    customers = spark.createDataFrame([(" E1", 77, "SIREN")], "establishment_uid string, clean_customer_id long, business_registry_no string")
    return commission.commission_snapshot(spark.createDataFrame(lines, LINE), prices, customers, AS_OF, **over)


def test_commission_filters(spark):
    lines = [
        line(), line(bill="/"), line(bill="R1"), line(bill=" R2"), line(region="Spain"), line(agency="DIRECT"), line(agency=None, bill="B2"), line(base=None),
        line(name="Setup Fees"), line(code="ContractPenalty"), line(at=datetime(2023, 9, 30)), line(entry="out_refund"), line(name=None),
    ]
    got = commission_of(spark, lines)
    assert sorted(r["parent_bill"] for r in got.collect()) == ["B1", "B2"]


def test_commission_measures_of_one_group(spark):
    lines = [line(), line(promo="x", net=-5.0), line(net=1.005)]
    r = commission_of(spark, lines).first()
    assert r["metro_id"] == 77 and r["siren_no"] == "SIREN" and r["company"] == "C" and r["billing_country_code"] == "FR"
    assert r["quantity"] == 4 and r["price_per_unit"] == 10.0
    assert r["theoretica_oneshot_amount"] == pytest.approx(21.01) and r["total_invoiced"] == pytest.approx(16.01)
    # partner list price 4 * 2 per regular line; its share of the customer price is one half.
    assert r["theoretical_MFR_commission_monthly"] == 16.0
    assert r["theoretical_MFR_commission_oneshot"] == pytest.approx(10.51, abs=0.01)
    assert r["net_MFR_monthly"] == 11.0 and r["amount_promotions_recurring"] == -5.0
    assert r["total_commission_one_shot_MFR"] == 0.0


def test_commission_shares_are_rounded_once(spark):
    """20,000 lines of a cent at a share of a third: rounding each line first would give 66.00."""
    lines = spark.range(20_000).select(
        *[F.lit("k").alias(k) for k in commission.KEYS],
        F.lit(False).alias("is_promo"), F.lit(False).alias("is_setup"), F.lit(1.0).alias("unit_price"),
        F.lit(1.0).alias("line_quantity"), F.lit(0.01).alias("net"), F.lit(1.0).alias("platform_list"),
        F.lit(1.0).alias("partner_list"), F.lit(3.0).alias("customer_list"),
    )
    got = commission.commission_measures(lines).first()
    assert float(got["theoretical_MFR_commission_oneshot"]) == 66.67 == float(got["total_monthly_DISH"])


def test_commission_without_price_or_regular_line(spark):
    late = commission_of(spark, [line(at=datetime(2024, 2, 1))]).first()
    assert late["theoretical_MFR_commission_monthly"] == 0.0 and late["theoretical_MFR_commission_oneshot"] is None
    promo_only = commission_of(spark, [line(promo="x")]).first()
    assert promo_only["net_MFR_monthly"] is None and promo_only["quantity"] is None and promo_only["promotions_amount_oneshot"] == 20.0
    zero = commission_of(spark, [line(setup=True)]).first()
    assert zero["total_monthly_DISH"] is None and zero["theoretical_MFR_commission_monthly"] == 10.0
    unknown = commission_of(spark, [line(setup=None)]).first()
    assert unknown["monthly_invoiced_subscription"] == 0.0 and unknown["total_commission_one_shot_MFR"] == 0.0


def test_commission_covers_first_and_last_day_of_a_price(spark):
    got = commission_of(spark, [line(bill="a", at=datetime(2024, 1, 1)), line(bill="b", at=datetime(2024, 1, 31))])
    assert {r["theoretical_MFR_commission_monthly"] for r in got.collect()} == {8.0}


def test_commission_hash_is_stable_across_partitions(spark):
    lines = [line(net=0.1 * i, bill=f"B{i % 3}") for i in range(60)]
    one = commission_of(spark, lines)
    two = commission_of(spark, lines[::-1])
    assert rows(one, "_keyhash", "_rowhash") == rows(two, "_keyhash", "_rowhash")
    delta, _ = delta_cycle(two, one, datetime(2024, 2, 1))
    assert delta.count() == 0


# --- assets ------------------------------------------------------------------------------------


def test_asset_payload_names_match_the_contract(spark):
    raw = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in assets.COLUMNS.names]).withColumns(
        {"establishment_UID": F.lit("U"), "Store_Id": F.lit(150.6), "InstallDate": F.lit("2024-01-02"), "email_permission": F.lit("true")})
    snapshot = assets.asset_snapshot(raw, AS_OF)
    row = assets.asset_payload(snapshot).first()
    assert list(row.__fields__) == contracts.CRM_ASSET.names
    assert row["store_id"] == 151 and row["install_date"] == date(2024, 1, 2) and row["_ldts"] == AS_OF


# --- matching export -----------------------------------------------------------------------------


def export_frames(spark, base_rows, match_rows, wholesale_rows=()):
    flags = [p.flag for p in matching_export.CATALOGUE] + ["has_dish_teamplan"]
    base = spark.createDataFrame(base_rows, "id_est string, establishment_sfid string, booq_id string, establishment_activity_score double, establishment_active int, has_dish_website int, has_dish_order int, started timestamp_ntz")
    for f in flags:
        if f not in base.columns:
            base = base.withColumn(f, F.lit(0))
    none = F.lit(None).cast("timestamp_ntz")
    base = base.withColumnRenamed("started", "dish_website_createddate").withColumns(
        {"dish_order_createddate": none, "dish_order_deleteddate": none, "dish_website_deleteddate": none, "date_acquisition": F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"), "date_deletion": none, "SFDC_createdDate": none})
    matches = spark.createDataFrame(match_rows, "iso_code string, id_source_1 string, id_source_2 string, unique_metro_id string, original_request string, match_quality string, _valid_flag boolean").withColumn("list_type", F.lit("l"))
    wholesale = spark.createDataFrame(list(wholesale_rows), "country string, unique_metro_id long, unique_home_store_id long, unique_cust_no long, status_cd int, blocking_reason_cd string")
    return matches, base, wholesale


CRM, BOOK = matching_export.REQUEST_BY_CRM_ID, matching_export.REQUEST_BY_BOOKING_ID


def test_matching_export_end_to_end(spark):
    matches, base, wholesale = export_frames(
        spark,
        [("H1", "S1", None, 5.0, 0, 1, 1, datetime(2023, 5, 6)), ("H2", None, "BQ2", 1.0, 1, 1, 0, None)],
        [("de", "S1", None, "10", CRM, "100", True), ("de", None, "bq2", "20", BOOK, "150.4", True), ("de", "S1", None, "30", CRM, "151", True),
         ("de", "S1", None, "40", CRM, "10", False), ("de", "S1", None, "50", "other", "10", True)],
        [("de", 10, 7, 8, 1, None)],
    )
    out = matching_export.matching_export(matches, base, wholesale, AS_OF)
    got = {(r["HD_cust_ident"], r["w360_service_cd"]): r for r in out.collect()}
    # H1 is not active anywhere, so its codes move by 700; H2 is.
    assert set(got) == {("H1", "800"), ("H1", "806"), ("H2", "100")}
    site, order, other = got[("H1", "800")], got[("H1", "806")], got[("H2", "100")]
    assert (site["date_from"], site["date_to"]) == ("2023-05-06", "2949-12-31")
    assert order["date_from"] == "2020-01-01"
    assert (site["unique_home_store_id"], other["unique_home_store_id"], other["unique_cust_no"]) == (7, 0, 0)
    assert site["blocking_reason_cd"] is None and other["status_cd"] is None and other["match_quality"] == 150
    feed = matching_export.matching_feed(out, "De")
    ok, bad = contracts.validate(feed, contracts.PARTNER_MATCHING)
    assert ok.count() == 3 and bad.count() == 0 and matching_export.matching_feed(out, "FR").count() == 0


def test_most_active_establishment_wins_unless_asked_otherwise(spark):
    rows_ = spark.createDataFrame(
        [("DE", "m", "H1", 9.0, datetime(2024, 1, 1)), ("DE", "m", "H2", 9.0, datetime(2023, 1, 1)), ("DE", "m", "H3", 1.0, None), ("DE", None, "H4", 1.0, None), ("FR", "m", "H1", 0.0, None)],
        "country string, unique_metro_id string, HD_cust_ident string, establishment_activity_score double, date_from timestamp_ntz")
    pick = lambda **k: rows(matching_export.one_establishment(rows_, **k), "country", "unique_metro_id", "HD_cust_ident")
    assert pick() == [("DE", None, "H4"), ("DE", "m", "H2"), ("FR", "m", "H1")]
    assert ("DE", "m", "H3") in pick(compat="id_first")


# --- lifecycle, helpdesk ---------------------------------------------------------------------------


def test_lead_delta_fills_texts_and_meets_the_contract(spark):
    base = spark.createDataFrame([("1", "fr", datetime(2024, 1, 30, 4), True, date(2024, 1, 30)), ("1", "fr", datetime(2024, 1, 30, 4), True, date(2024, 1, 30)), ("2", "fr", datetime(2024, 1, 29), True, date(2024, 1, 29))],
                                 "lead_id string, lead_country_code string, _valid_from timestamp_ntz, _valid_flag boolean, _ldts date")
    for c in contracts.LEAD.names:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("string"))
    got = lifecycle.lead_delta(base, AS_OF, "FR")
    ok, bad = contracts.validate(got, contracts.LEAD)
    assert ok.count() == 1 and bad.count() == 0 and ok.first()["status"] == ""


def test_asset_names(spark):
    assert rename(spark.range(1).select(*[F.lit(1).alias(c) for c in lifecycle.ASSET_COLUMNS]), contracts.ASSET_NAMES).columns == contracts.ASSET.names


# --- products --------------------------------------------------------------------------------------------


def test_score_new_names_skips_scored_and_null_names(spark):
    p = spark.createDataFrame([(1, 1, 1, "Cola"), (1, 1, 2, "Beer"), (1, 9, 3, "Orphan"), (2, 1, 4, "Cola")], "branch_office_id int, family_group_id int, product_id int, name string")
    g = spark.createDataFrame([(1, 1, "Drinks"), (2, 1, "Drinks")], "branch_office_id int, family_group_id int, name string")
    scored = spark.createDataFrame([("Drinks Beer",)], "product_name string")

    def load():
        return lambda names: [n.upper() for n in names]

    at = datetime(2024, 1, 1, 5)
    got = products.score_new_names(p, g, scored, lambda n: products.score_with_callable(n, load, at))
    assert rows(got) == [("Drinks Cola", "DRINKS COLA", at)]


def test_pipeline_learns_words(spark):
    train = spark.createDataFrame([("red wine", 0.0), ("white wine", 0.0), ("beef steak", 1.0), ("pork steak", 1.0)], "product_name string, label double")
    model = products.category_pipeline().fit(train)
    got = products.score_with_pipeline(spark.createDataFrame([("rose wine",), ("veal steak",)], "product_name string"), model, ["drink", "food"], datetime(2024, 1, 1))
    assert dict((r["product_name"], r["prediction"]) for r in got.collect()) == {"rose wine": "drink", "veal steak": "food"}


def test_overview_leaves_test_outlets_and_returns_out(spark):
    outlets = spark.createDataFrame([(1, "A", 0), (2, "T", 1)], "branch_office_id int, name string, is_test_office int")
    groups = spark.createDataFrame([(1, 5, "G"), (2, 5, "G")], "branch_office_id int, family_group_id int, name string")
    prods = spark.createDataFrame([(1, 5, 7, "P"), (2, 5, 7, "P")], "branch_office_id int, family_group_id int, product_id int, name string")
    sales = spark.createDataFrame([(1, 7, 5, datetime(2024, 1, 2, 9), 3, 1.005), (1, 7, 5, datetime(2023, 12, 31, 9), 2, 1.0), (1, 7, 5, datetime(2024, 1, 1), 0, 50.0), (2, 7, 5, datetime(2024, 1, 2), 3, 1.0)],
                                  "branch_office_id int, product_id int, family_group_id int, timestamp timestamp_ntz, count long, total_money double")
    preds = spark.createDataFrame([("G P", "cat")], "product_name string, prediction string")
    r = products.product_overview(outlets, sales, groups, prods, preds, date(2024, 1, 3)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["total_count"], r["total_revenue"], r["sale_current_week"], r["sale_one_cw_ago"], r["sale_two_cw_ago"], r["product_category"]) == (5, 2.01, 5, 2, None, "cat")
    assert (r["first_sale"], r["last_sale"]) == (date(2023, 12, 31), date(2024, 1, 2))


# --- loads -------------------------------------------------------------------------------------------------


def test_prepare_invoices(spark):
    invoices = spark.createDataFrame(
        [("I1", "u1", [("P1", "d1", 1.0, 2.0, 5, ["T1", "??"]), ("P9", "d2", 1.0, 2.0, 5, None)], datetime(2024, 1, 2)),
         ("I1", "u2", [], datetime(2024, 1, 3)), ("I2", "u2", None, datetime(2024, 1, 2)), ("I3", "nobody", [], datetime(2024, 1, 2)), ("I4", "u1", [], datetime(2024, 1, 2)), ("I5", None, [], datetime(2024, 1, 2))],
        f"move_name string, partner_uuid string, line_items {loads.LINE_ITEMS}, write_date timestamp_ntz").withColumns(
        {"invoice_date": F.lit(AS_OF), "invoice_date_due": F.lit(AS_OF), "move_type": F.lit("out"), "currency_id": F.lit(1), "journal_id": F.lit(2), "reference": F.lit(None).cast("string")})
    loaded = spark.createDataFrame([("I4",)], "move_name string")
    partners = spark.createDataFrame([("u1", 12), ("u1", 11)], "partner_uuid string, id long")
    external = spark.createDataFrame(
        [("salesforce", "res.partner", "u2", 20), ("other", "res.partner", "nobody", 30), ("dish_product_catalog", "p", "P1", 100)], "module string, model string, name string, res_id long")
    taxes = spark.createDataFrame([("T1", 9), ("T1", 8)], "name string, id long")
    ok, bad = loads.prepare_invoices(invoices, loaded, partners, external, taxes)
    got = {r["name"]: r for r in ok.collect()}
    assert {n: r["partner_id"] for n, r in got.items()} == {"I1": 11, "I2": 20}
    first, second = got["I1"]["invoice_line_ids"]
    assert (first["product_id"], first["tax_ids"], first["name"]) == (100, [8], "d1")
    assert (second["product_id"], second["tax_ids"]) == (None, [])
    assert got["I1"]["unresolved_taxes"] == 1 and got["I2"]["invoice_line_ids"] == []
    assert rows(bad, "move_name", "partner_uuid") == [("I3", "nobody"), ("I5", None)]


def test_prepare_leads_rejects_missing_country_and_keeps_nulls_out(spark):
    names = "first_name last_name email phone mobile_phone metro_id_country company_postal_code company_city company_street establishment_postal_code establishment_city establishment_street store establishment primary_language lead_source channel_v2 role merchant reseller vat_id product_codes".split()
    given = [dict(metro_id=1, metro_id_country="de", first_name=None, last_name="Ann", product_codes="POS_L_Package;X;None", store="S"), dict(metro_id=2, last_name="B")]
    df = spark.createDataFrame([tuple(g.get(n) for n in names) + (g["metro_id"], AS_OF) for g in given] * 2, ", ".join(f"{n} string" for n in names) + ", metro_id long, load_date date")
    dim = lambda *r: spark.createDataFrame(list(r), "name string, id long")
    ok, bad = loads.prepare_leads(
        df, dim(("DE", 3)), dim(("de", 4)), dim(("HD", 5)), spark.createDataFrame([("Q", 1)], "code string, id long"),
        spark.createDataFrame([("POS_L_Package:1:12", 50)], "name string, res_id long"), 9, AS_OF)
    assert rows(bad, "metro_id", "reject_reason") == [(2, "metro_id_country is missing")]
    row = ok.collect()
    assert len(row) == 1 and row[0]["unresolved_products"] == 1
    assert json.loads(row[0]["payload"]) == {
        "contact_name": "Ann", "country_id": 3, "store_id": 0, "metro_id": 1, "user_id": False, "product_ids": [50], "establishment_type": 9,
        "description": "Company VAT ID: , Product codes: POS_L_Package;X;None"}


def test_partner_ids_by_identity_and_duplicate_key(spark):
    partners = spark.createDataFrame(
        [(5, "u1", True, "contact", "Joe's Bar", "1", None), (3, "u1", True, "contact", "joes bar", "1", None), (7, "u1", False, "invoice", "x", None, "V"), (9, "zz", True, "contact", "y", None, None), (8, "c-contact", True, "contact", "y", None, None)],
        "id long, partner_uuid string, is_company boolean, type string, name string, zip string, vat string")
    batch = spark.createDataFrame([("u1", "c", None)], "account_id string, company_id string, establishment_id string")
    identity, duplicates = loads.partner_ids(partners, batch)
    assert rows(identity) == [("c-contact", True, "contact", 8), ("u1", False, "invoice", 7), ("u1", True, "contact", 3)]
    assert rows(duplicates, "duplicate_key", "id")[1:] == [("xVinvoicefalse", 7), ("y/contacttrue", 8)]
    assert rows(duplicates, "duplicate_key", "id")[0] == ("joesbar1/contacttrue", 3)


# --- terminals ---------------------------------------------------------------------------------------------


def test_flatten_terminals_with_missing_groups(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"id":"t1","assignment":{"status":"Inventory"},"connectivity":{"wifi":{"ssid":"w"}}}\n{"id":"t2"}\n')
    flat = terminals.flatten_terminals(spark.read.schema(terminals.TERMINAL).json(str(path)))
    assert rows(flat, "terminal_id", "assignment_status", "wifi_ssid", "store_id") == [("t1", "Inventory", "w", None), ("t2", None, None, None)]
    assert rows(terminals.settings_targets(flat), "terminal_id") == [("t2",)]


def test_flatten_merchants_without_data_centres(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"id":"m1","dataCenters":[{"name":"d","livePrefix":"p"}],"_links":{"self":{"href":"h"}}}\n{"id":"m2"}\n')
    flat = {r["merchant_id"]: r for r in terminals.flatten_merchants(spark.read.schema(terminals.MERCHANT).json(str(path))).collect()}
    assert flat["m1"]["data_centers"][0]["live_prefix"] == "p" and flat["m1"]["self_url"] == "h"
    assert flat["m2"]["data_centers"] == [] and flat["m2"]["users_url"] is None


def test_settings_are_cut_down_and_counted(spark):
    df = spark.createDataFrame(
        [("a", '{"gratuities":{"x":1},"secret":2,"opi":[1]}'), ("b", '{"secret":2}'), ("c", None), ("d", "{}")], "terminal_id string, settings string")
    kept, counts = terminals.filter_settings(df)
    assert [(r["terminal_id"], r["settings"]) for r in kept.collect()] == [("a", {"gratuities": '{"x":1}', "opi": "[1]"})]
    assert tuple(counts.first()) == (4, 1, 1, 2, False)
    assert terminals.filter_settings(df.where("terminal_id = 'b'"))[1].first()["nothing_left"] is True


def test_terminal_inventory_and_worklists(spark, tmp_path):
    files = {"m": '{"id":"m1"}', "s": '{"id":"s1","address":{"city":"B"}}', "t": '{"id":" t1 "}\n{"id":"t2","assignment":{"status":"INVENTORY"}}'}
    for n, text in files.items():
        (tmp_path / n).write_text(text)
    read = lambda n, schema: spark.read.schema(schema).json(str(tmp_path / n))
    settings = spark.createDataFrame([("t1", '{"payment":1}'), ("t2", '{"payment":1}')], terminals.SETTINGS)
    out = terminals.terminal_inventory(read("m", terminals.MERCHANT), read("s", terminals.STORE), read("t", terminals.TERMINAL), settings)
    assert {k: v.count() for k, v in out.items()} == {"merchants": 1, "stores": 1, "terminals": 2, "terminal_settings": 1, "settings_counts": 1}
    matches = spark.createDataFrame([("t1", " s1 ", True), ("t2", "  ", None), (None, "s", True), (" ", "s", True)], "terminal_id string, store_id string, to_disable_standalone_tip boolean")
    pairs, skipped = terminals.reassign_worklist(matches)
    assert rows(pairs) == [("t1", "s1")] and skipped.count() == 2
    patches, blank = terminals.patch_worklist(matches)
    assert rows(patches) == [("t1",)] and blank.count() == 1
