"""Smoke + semantics tests for the remaining ingest flows and marts."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans import ingest, marts

D, TS = dt.date, dt.datetime


def test_ads_report_batch(spark):
    raw = spark.createDataFrame([(D(2024, 1, 1), None, 7, 1.5, "acme", "x"), (None, 3, 8, 2.0, "acme", "x")],
                                "date date, adGroupId long, campaignId long, cost double, account string, "
                                "source_file string")
    tenants = spark.createDataFrame([(4, "acme")], "tenant_id int, company string")
    out = ingest.ads_report_batch(raw, tenants).collect()
    assert len(out) == 1 and out[0]["ad_group_id"] == 0 and out[0]["tenant_id"] == 4
    assert out[0]["campaign_id"] == 7


def test_orders_batch_watermark_per_group(spark):
    pages = spark.createDataFrame([([("o1", "2024-01-02T00:00:00Z", "2024-01-05T00:00:00Z", ("US",)),
                                     ("o2", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", ("US",))],)],
                                  "Orders array<struct<AmazonOrderId: string, PurchaseDate: string, "
                                  "LastUpdateDate: string, ShippingAddress: struct<CountryCode: string>>>")
    current = spark.createDataFrame([(1, "US", TS(2024, 1, 3)), (1, "CA", TS(2024, 2, 1))],
                                    "tenant_id int, marketplace string, last_update_date timestamp")
    out = ingest.orders_batch(pages, current, 1, "US").collect()
    assert [r["amazon_order_id"] for r in out] == ["o1"]
    assert "shipping_address_country_code" in out[0].asDict()
    items = spark.createDataFrame([("o1", [("i1", "S1", 2)])],
                                  "AmazonOrderId string, OrderItems array<struct<OrderItemId: string, "
                                  "SellerSKU: string, QuantityOrdered: long>>")
    it = ingest.order_items_batch(items, 1, "US").collect()
    assert it[0]["seller_sku"] == "S1" and it[0]["amazon_order_id"] == "o1"


def test_finance_events_keep_events_without_items(spark):
    pages = spark.createDataFrame([((
        [("o1", "2024-01-01", [("S1", "i1", 2), ("S2", "i2", 1)]), ("o2", "2024-01-02", [])],),)],
        "FinancialEvents struct<ShipmentEventList: array<struct<AmazonOrderId: string, PostedDate: string, "
        "ShipmentItemList: array<struct<SellerSKU: string, OrderItemId: string, QuantityShipped: long>>>>>")
    out = ingest.finance_events(pages, TS(2024, 1, 3), 1, "US").collect()
    assert {(r["tenant_id"], r["marketplace"]) for r in out} == {(1, "US")}
    assert sorted((r["amazon_order_id"], r["item_seller_sku"]) for r in out) == \
        [("o1", "S1"), ("o1", "S2"), ("o2", None)]


def test_snapshots_and_plans(spark):
    inv = spark.createDataFrame([([("B0A", ("5", 3))],)],
                                "inventorySummaries array<struct<asin: string, inventoryDetails: "
                                "struct<fulfillableQuantity: string, inboundWorkingQuantity: long>>>")
    out = ingest.inventory_snapshot(inv, 1, "US", D(2024, 1, 1)).first().asDict()
    assert out["fulfillable_quantity"] == "5" and out["inbound_working_quantity"] == 3 and out["date"] == D(2024, 1, 1)
    awd = spark.createDataFrame([([("s1", ("+1 (555) 123",))],)],
                                "shipments array<struct<shipmentId: string, originAddress: struct<phoneNumber: string>>>")
    assert ingest.awd_shipments(awd, 1, D(2024, 1, 1)).first()["origin_address_phone_number"] == "1555123"
    plans = spark.createDataFrame([("p1", ["ATVPDKIKX0DER", "A2EUQ1WTGCTBG2"], [("sh1", "WORKING"), ("sh2", "SHIPPED")])],
                                  "inbound_plan_id string, marketplace_ids array<string>, "
                                  "shipments array<struct<shipmentId: string, status: string>>")
    out = ingest.inbound_plan_shipments(plans).collect()
    assert sorted((r["shipment_id"], r["marketplace"]) for r in out) == [("sh1", "US"), ("sh2", "US")]


def test_fx_and_tsv_batches(spark):
    fx = spark.createDataFrame([("USD", {"2024-01-02": {"USDEUR": "0.9"}, "2024-01-01": {"USDEUR": "0.8"}}),
                                ("USD", {"2024-01-01": {"USDEUR": "0.8"}})],
                               "source string, quotes map<string, map<string, string>>")
    out = sorted((r["recorded_at"], str(r["rate"])) for r in ingest.fx_rates_batch(fx).collect())
    assert out == [(TS(2024, 1, 1), "0.800000000000000000"), (TS(2024, 1, 2), "0.900000000000000000")]
    raw = spark.createDataFrame([("S1", "F1", "A1", "US", "--", "x"), ("S1", "F1", "A1", "US", "3.5", "x")],
                                "sku string, fnsku string, asin string, `amazon-store` string, `your-price` string, "
                                "source_file string")
    fp = ingest.fee_preview_batch(raw, 1, D(2024, 1, 1)).collect()
    assert len(fp) == 1 and fp[0]["amazon_store"] == "US"
    schema = T.StructType.fromDDL("tenant_id INT, marketplace STRING, snapshot_date DATE, sku STRING, "
                                  "condition STRING, available BIGINT")
    pl = spark.createDataFrame([(" US ", "2024-01-01", "S1", "New", "4"), ("US", "2024-01-01", "S1", "New", "--")],
                               "marketplace string, `snapshot-date` string, sku string, condition string, "
                               "available string")
    got = ingest.planning_inventory_batch(pl, 1, schema).collect()
    assert len(got) == 1 and got[0]["marketplace"] == "US"


def test_keyword_tool_and_legacy(spark):
    raw = spark.createDataFrame([("kw1", "1,000", "-", "x"), (None, "5", "3", "y")],
                                "`Keyword Phrase` string, `Search Volume` string, `Position (Rank)` string, extra string")
    schema = T.StructType.fromDDL("country STRING, category STRING, `Keyword Phrase` STRING, `Search Volume` INT, "
                                  "`Position (Rank)` SMALLINT")
    out = ingest.keyword_tool_batch(raw, schema, "Position (Rank)", "US", "Bar").collect()
    assert len(out) == 1 and out[0]["Position (Rank)"] is None and out[0]["country"] == "US"
    leg = ingest.legacy_report_batch(spark.createDataFrame([("2024-01-01", "7")], "`Start Date` string, Clicks string"),
                                     {"Start Date": "date", "Clicks": "clicks"},
                                     T.StructType.fromDDL("date DATE, clicks BIGINT, spend DOUBLE")).first()
    assert leg["date"] == D(2024, 1, 1) and leg["clicks"] == 7 and leg["spend"] is None


BULK = ("portfolio_name string, campaign_name string, ad_group_name string, portfolio_id long, campaign_id long, "
        "ad_group_id long")


def test_search_term_history(spark):
    export = spark.createDataFrame([
        ("Products", D(2022, 9, 20), "SP | A | B | c", "AG", "kw", "st", "enabled", "exact", 10, 100, "$1.00", "$2.00", "$3", "7"),
        ("Products", D(2021, 1, 1), "SP | A | B | c", "AG", "kw", "old", "enabled", "exact", 1, 0, None, "$9.00", "$3", "8"),
        ("Brands", D(2022, 9, 20), "SP | A | B | c", "AG", "kw", "brand", "enabled", "exact", 1, 1, None, "$9.00", "$3", "8")],
        "Sponsored string, Date date, Campaign string, AdGroup string, Keyword string, `Search Terms` string, State string, "
        "Match string, Clicks long, Impressions long, CPC string, Cost string, Sales string, `Total Cost` string") \
        .withColumn("Current Bid", F.lit(0.5))
    console = spark.createDataFrame([(D(2022, 9, 20), "SP | A | B | c", "AG", "kw", "console", "enabled", "exact", "P"),
                                     (D(2020, 1, 1), "SP | A | B | c", "AG", "kw", "console", "enabled", "exact", "P")],
                                    "date date, campaign_name string, ad_group_name string, targeting string, "
                                    "search_term string, ad_keyword_status string, match_type string, portfolio_name string")
    # two spellings of one campaign: rows must not double
    bulk = spark.createDataFrame([("P", "SP | A | B | x", "AG", 9, 1, 2), ("P", "SP | A | B | y [old]", "AG", 9, 1, 2)], BULK)
    got = ingest.search_term_history([export], bulk, console, windows=[("2022-09-15", "2022-10-07")]).collect()
    rows = sorted((r["search_term"], r["date"], r["ad_group_id"], r["portfolio_id"], r["keyword_bid"]) for r in got
                  if r["date"] > D(2021, 1, 1))
    assert rows == [("console", D(2022, 9, 20), 2, 9, 0.5), ("st", D(2022, 9, 20), 2, 9, 0.5)]
    assert len(got) == 3 and not [c for c in got[0].asDict() if "Total" in c or c in ("Sponsored", "Actions")]
    st = next(r for r in got if r["search_term"] == "st")
    assert (st["cost"], st["click_through_rate"], st["keyword_type"], st["campaign_budget_currency_code"]) == (
        2.0, 0.1, "EXACT", "USD")


def test_targeting_history(spark):
    export = spark.createDataFrame([
        ("SP", D(2022, 12, 20), "SP | A | B | c", "AG", "[Close Match]", "enabled", "exact", "$1", "$2.00", "$3", 0.4),
        ("SP", D(2022, 12, 20), "SP | Z | B | c", "AG", "kw", "enabled", "exact", "$1", "$5.00", "$3", 0.4),
        ("SP", D(2022, 12, 12), "SP | A | B | c", "AG", "edge", "enabled", "exact", "$1", "$5.00", "$3", 0.4),
        ("SB", D(2022, 12, 20), "SP | A | B | c", "AG", "brand", "enabled", "exact", "$1", "$5.00", "$3", 0.4)],
        "Type string, Date date, Campaign string, AdGroup string, Keyword string, State string, Match string, "
        "`Cost Per Click` string, Spent string, Sales string, `Current Bid` double")
    console = spark.createDataFrame([
        (D(2022, 12, 20), "SP | A | B | c", "AG", "close-match", "enabled", "exact", 1.0, "P"),
        (D(2020, 5, 5), "SP | A | B | c", "AG", 'asin="B0X"', "enabled", "exact", 7.0, "P")],
        "date date, campaign_name string, ad_group_name string, targeting string, ad_keyword_status string, "
        "match_type string, cost double, portfolio_name string")
    share = spark.createDataFrame([(D(2020, 5, 5), "b0x", 0.25)],
                                  "date date, search_term string, top_of_search_impression_share double")
    bulk = spark.createDataFrame([("P", "SP | A | B | q", "AG", 9, 1, 2)], BULK)
    kept, unmatched = ingest.targeting_history([export], bulk, console, share, [("2022-12-12", "2022-12-26")])
    rows = {r["targeting"]: r for r in kept.collect()}
    # the console report is whole, outside the windows too, and goes first on equal keys
    assert set(rows) == {"close-match", 'asin="B0X"'} and rows["close-match"]["cost"] == 1.0
    assert rows["close-match"]["keyword_bid"] == 0.4 and rows['asin="B0X"']["top_of_search_impression_share"] == 0.25
    assert rows['asin="B0X"']["match_type"] == "TARGETING_EXPRESSION"
    assert [(r["targeting"], r["cost"]) for r in unmatched.collect()] == [("kw", 5.0)]


def test_placement_history(spark):
    hist = spark.createDataFrame([
        (D(2022, 12, 13), "enabled", "SP | A | B | c", "Top of Search", 100, 5, "$10.00"),
        (D(2022, 12, 13), "enabled", "SP | A | B | c", None, 0, 0, "$1.00"),
        (D(2022, 12, 12), "enabled", "SP | A | B | c", "Product Pages", 0, 0, "$1.00")],
        "Date date, State string, Campaign string, Placement string, Impressions long, Clicks long, Spent string")
    console = spark.createDataFrame([(D(2022, 12, 13), "enabled", "SP | A | B | c", "Top of Search", 9, 1, "$(9.00)"),
                                     (D(2020, 1, 1), "enabled", "SP | A | B | c", "Rest of Search", 9, 1, "$9.00"),
                                     (D(2020, 1, 1), "enabled", "unknown", "Rest of Search", 9, 1, "$9.00")],
                                    "date date, campaign_status string, campaign_name string, placement_classification "
                                    "string, impressions long, clicks long, cost string")
    bulk = spark.createDataFrame([("SP | A | B | x", 42), ("SP | A | B | y", 42)], "campaign_name string, campaign_id long")
    out = {r["date"]: r for r in ingest.placement_history(
        [hist], bulk, console, [("2022-12-12", "2022-12-26")]).collect()}
    assert set(out) == {D(2022, 12, 13), D(2020, 1, 1)}
    r = out[D(2022, 12, 13)]
    assert (r["cost"], r["click_through_rate"], r["placement_classification"], r["campaign_id"]) == (
        10.0, 0.05, "Top of Search on-Amazon", 42)


def test_keyword_ranks_and_search_query_files(spark):
    raw = spark.createDataFrame([("k", "A", "2024-01-01 10:00:00", "US", ">306"), ("k2", "A", "2024-01-01 10:00:00", "US", "-")],
                                "Keyword string, ASIN string, `Date Added` string, Marketplace string, `Organic Rank` string")
    batch, _ = ingest.keyword_rank_batch(raw)
    assert [(r["Keyword"], r["Organic Rank"]) for r in batch.collect()] == [("k", 306)]
    sqp = spark.createDataFrame([
        ("2024-01-06", "weekly", "us", "A", "Shoes ", 1, None, "f1", 1), ("2024-01-06", "weekly", "us", "A", "shoes", 2, None, "f1", 2),
        ("2024-01-06", "weekly", "us", "A", "shoes", 9, 5, "f2", 1), (None, "weekly", "us", "A", "x", 1, 1, "f2", 2)],
        "reporting_date string, reporting_range string, marketplace string, asin string, search_query string, "
        "volume int, clicks int, source_file string, line_no int")
    r = ingest.sqp_batch(sqp).collect()
    # the file read first wins, its last line inside; a value it lacks comes from the next file
    assert [(x["search_query"], x["marketplace"], x["volume"], x["clicks"]) for x in r] == [("shoes", "US", 2, 5)]


def test_snapshot_batches_feed_the_shipment_marts(spark):
    awd = spark.createDataFrame([([("s1", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")],)],
                                "shipments array<struct<shipmentId: string, createdAt: string, updatedAt: string>>")
    r = ingest.awd_shipments(awd, 1, D(2024, 1, 3)).first()
    assert r["shipment_create_date_utc"] == TS(2024, 1, 1) and "created_at" not in r.asDict()
    plans = spark.createDataFrame([([("p1", "2024-01-01T00:00:00Z", ["ATVPDKIKX0DER"])],)],
                                  "inboundPlans array<struct<inboundPlanId: string, createdAt: string, "
                                  "marketplaceIds: array<string>>>")
    p = ingest.inbound_records(plans, "inboundPlans", 1)
    assert p.columns == ["inbound_plan_id", "date_created_at", "marketplace_ids", "tenant_id"]
    work = p.withColumn("last_updated_at", F.lit("2024-02-01").cast("timestamp"))
    assert ingest.plan_worklist(work, "ATVPDKIKX0DER", TS(2024, 1, 1), 1).count() == 1
    assert ingest.plan_worklist(work, "A2EUQ1WTGCTBG2", TS(2024, 1, 1), 1).count() == 0
    price = spark.createDataFrame([("A", "Success", (("USD",),))],
                                  "ASIN string, status string, Product struct<price: struct<code: string>>")
    c = ingest.competitive_pricing(price, "Consumer", 1, "US", D(2024, 1, 1)).first()
    assert (c["asin"], c["customer_type"], c["product_price_code"]) == ("A", "Consumer", "USD")
    inv = spark.createDataFrame([([("S1", (3,))],)], "inventory array<struct<sku: string, totals: struct<onHand: long>>>")
    i = ingest.awd_inventory_batch(inv, 1, D(2024, 1, 1), TS(2024, 1, 1)).first()
    assert (i["sku"], i["totals_on_hand"], i["loaded_at"]) == ("S1", 3, TS(2024, 1, 1))
    listing = spark.createDataFrame([("S1", [("A1", "x"), ("A2", "y")])],
                                    "sku string, summaries array<struct<asin: string, itemName: string>>")
    got = ingest.listing_snapshot(listing, "summaries", 1, "US", D(2024, 1, 1)).collect()
    assert sorted((x["sku"], x["asin"]) for x in got) == [("S1", "A1"), ("S1", "A2")]


def test_ads_grid(spark):
    rows = spark.createDataFrame([
        ("d", 1, "C1", None, None, "$10.00", "1,000", None), ("d", 2, None, "kw1", "$4.00", None, None, "5%"),
        ("d", 3, None, "kw2", "$6.00", None, None, "10%")],
        "doc string, pos int, Campaign string, Keyword string, Cost string, `Total Spend` string, "
        "`Total Impressions` string, CTR string")
    out = {r["Keyword"]: r for r in ingest.scale_insights_grid(
        rows, "doc", "pos", F.col("Campaign").isNotNull(), ["Campaign", "Total Spend", "Total Impressions"]).collect()}
    assert (out["kw1"]["Impressions"], out["kw2"]["Impressions"], out["kw1"]["CTR"]) == (400.0, 600.0, 0.05)


def test_warehouse_stock_and_scale_grid(spark):
    pages = spark.createDataFrame([([("S2", 3), ("S1", 5)],)], "items array<struct<SKU: string, Qty: long>>")
    out = ingest.warehouse_stock(pages, "items", "WH", "acct", TS(2024, 1, 1)).collect()
    assert [r["SKU"] for r in out] == ["S1", "S2"] and out[0]["warehouse_name"] == "WH"


def _ship_tables(spark):
    t = {}
    t["fulfillment_inbound.shipments"] = spark.createDataFrame(
        [(1, "FBA1", "n1", "WORKING", "FC1", "home", "US")],
        "tenant_id int, shipment_id string, shipment_name string, shipment_status string, "
        "destination_fulfillment_center_id string, ship_from_address_name string, ship_from_address_country_code string")
    t["fulfillment_inbound.shipment_items"] = spark.createDataFrame(
        [(1, "FBA1", "S1", 5, 4), (1, "FBA1", "S2", 1, 1)],
        "tenant_id int, shipment_id string, seller_sku string, quantity_shipped long, quantity_received long")
    t["fulfillment_inbound.inbound_plans_shipments"] = spark.createDataFrame(
        [(1, "sh-x", "FBA1", "REF1", "US")],
        "tenant_id int, shipment_id string, shipment_confirmation_id string, amazon_reference_id string, "
        "destination_address_country_code string")
    t["fulfillment_inbound.inbound_plans_info"] = spark.createDataFrame(
        [(1, "plan1", ["ATVPDKIKX0DER"], [("sh-x", "WORKING")], TS(2024, 1, 1), TS(2024, 1, 2))],
        "tenant_id int, inbound_plan_id string, marketplace_ids array<string>, "
        "shipments array<struct<shipmentId: string, status: string>>, date_created_at timestamp, last_updated_at timestamp")
    awd_schema = ("tenant_id int, date date, order_id string, shipment_id string, shipment_status string, "
                  "origin_address_name string, origin_address_country_code string, "
                  "destination_address_name string, destination_address_country_code string, "
                  "warehouse_reference_id string, shipment_create_date_utc timestamp, "
                  "shipment_last_update_date_utc timestamp, received_quantity array<struct<quantity: long>>, "
                  "shipment_sku_quantities array<struct<sku: string, expectedQuantity: struct<quantity: long>>>")
    t["awd.inbound_shipments"] = spark.createDataFrame([
        (1, D(2024, 1, 2), "ord1", "AWD1", "SHIPPED", "origin", "CN", "AWD-WH", "US", "W1", TS(2024, 1, 1), None,
         [(7,)], [("S1", (4,)), ("S2", (6,))]),
        (1, D(2024, 1, 1), "ord1", "AWD1", "CREATED", "origin", "CN", "AWD-WH", "US", "W1", TS(2024, 1, 1), None,
         [], [("S1", (4,))])], awd_schema)
    return t


def test_shipments_mart(spark):
    out = {r["shipment id"]: r for r in marts.shipments(_ship_tables(spark)).collect()}
    assert set(out) == {"FBA1", "AWD1"}
    f = out["FBA1"]
    assert (f["skus"], f["quantity shipped"], f["quantity received"], f["inbound plan id"], f["reference id"]) == \
        (2, 6, 5, "plan1", "REF1")
    a = out["AWD1"]
    assert (a["skus"], a["quantity shipped"], a["quantity received"], a["shipment status"]) == (2, 10, 7, "SHIPPED")
    assert a["shipment name"] is None
    detail = marts.awd_inbound_detail(_ship_tables(spark)).collect()
    assert sorted((r["sku"], r["expected_quantity"]) for r in detail) == [("S1", 4), ("S2", 6)]


def test_brand_and_display_spend(spark):
    camp = spark.createDataFrame([
        (1, "US", D(2023, 7, 1), 10, "enabled", "USD", 2.0, 1, 10, 1, 5.0, 1),
        (1, "US", D(2023, 7, 1), 11, "archived", "USD", 9.0, 1, 10, 1, 5.0, 1)],
        "tenant_id int, marketplace string, date date, campaign_id long, campaign_status string, currency string, "
        "cost double, clicks long, impressions long, attributed_units_ordered_new_to_brand_14d long, "
        "attributed_sales_14d double, attributed_units_ordered_7d long")
    dims = spark.createDataFrame([(1, 10, 100), (1, 11, 100)], "tenant_id int, campaign_id long, portfolio_id long")
    port = spark.createDataFrame([(1, 100, "ALL")], "tenant_id int, portfolio_id long, name string")
    console = spark.createDataFrame([(1, "US", D(2023, 6, 10), "X-1", "USD", 1.0, 1, 1, 1, 1.0)],
                                    "tenant_id int, marketplace string, date date, portfolio_name string, "
                                    "currency string, spend double, clicks long, impressions long, "
                                    "`14_day_total_units` long, `14_day_total_sales` double")
    t = {"sponsored_brands.campaign_v2": camp, "sponsored_brands.campaigns": dims, "amazon_advertising_portfolios": port,
         "sponsored_brands.campaign_console": console, "sponsored_display.campaign_v2": camp,
         "sponsored_display.campaigns": dims, "sponsored_display.campaign_console": console}
    sb = sorted((r["portfolio_name"], r["product_code"], r["total_cost"]) for r in marts.sb_spend(t, "US").collect())
    assert sb == [("ALL", "ALL", 2.0), ("X-1", "X", 1.0)]
    sd = sorted((r["portfolio_name"], r["product_code"], r["total_cost"]) for r in marts.sd_spend(t).collect())
    assert sd == [("ALL", None, 11.0), ("X-1", "X", 1.0)]


def test_inventory_marts_and_keywords(spark):
    fba_cols = ", ".join(f"{c} long" for c in marts.FBA_COLUMNS[6:])
    fba = spark.createDataFrame([
        (1, "A1", "F1", "S1", "US", D(2024, 1, 31), TS(2024, 1, 5)) + (1,) * 9,
        (1, "A2", "F2", "S2", "US", D(2024, 1, 31), TS(2023, 12, 1)) + (1,) * 9,
        (1, "A3", "F3", "S3", "US", D(2024, 1, 31), None) + (1,) * 9],
        f"tenant_id int, asin string, fn_sku string, seller_sku string, marketplace string, date date, "
        f"last_updated_time timestamp, {fba_cols}")
    assert [r["asin"] for r in marts.fba_inventory({"inventory.fba": fba}).collect()] == ["A1"]
    values = {"date": D(2024, 1, 1), "parent_asin": "P1", "marketplace": "US"}
    bus = spark.createDataFrame([(1, *[values.get(c, 55.0) for c in marts.BUSINESS_COLUMNS], "x")],
                                ["tenant_id", *marts.BUSINESS_COLUMNS, "not_in_the_report"])
    r = marts.business_report_parent({"business_reports.detail_page_sales_and_traffic_parent": bus}).first()
    assert r["traffic_by_asin_buy_box_percentage"] == 0.55 and r["sales_by_asin_units_ordered"] == 55.0
    assert len(r) == 1 + len(marts.BUSINESS_COLUMNS) and "not_in_the_report" not in r.asDict()
    sqp = spark.createDataFrame([
        ("US", "B0A", D(2024, 1, 6), "shoes", 100, 9, 50, 5, 2),
        ("US", "B0B", D(2024, 1, 6), "shoes", 120, 9, 10, 0, 0),
        ("US", "B0A", D(2023, 12, 30), "old", 1, 1, 1, 1, 1)],
        "country string, asin string, `Reporting Date` date, `Search Query` string, `Search Query Volume` long, "
        "`Search Funnel - Purchases: Total Count` long, `Search Funnel - Impressions: ASIN Count` long, "
        "`Search Funnel - Clicks: ASIN Count` long, `Search Funnel - Purchases: ASIN Count` long")
    prod = spark.createDataFrame([("B0A", "Bar"), ("B0B", "Bar")], "asin string, category string")
    cer = spark.createDataFrame([("US", "Bar", "shoes", 500, 3, 2, 4.0, 1.1, TS(2024, 1, 7, 3), 1.0, 2, 0.9, 1.3),
                                 ("US", "Bar", "boots", 50, 9, 9, 5.0, 0.5, TS(2024, 1, 7, 9), 1.0, 2, 0.9, 1.3),
                                 ("US", "Bar", "low", 50, 9, 9, 2.0, 0.5, TS(2024, 1, 7, 9), 1.0, 2, 0.9, 1.3)],
                                "country string, category string, `Keyword Phrase` string, `Search Volume` int, "
                                "`Position (Rank)` int, `Relative Rank` int, `Competitor Performance Score` double, "
                                "`H10 PPC Sugg. Bid` double, created timestamp, `Competitor Rank (avg)` double, "
                                "`Ranking Competitors (count)` int, `H10 PPC Sugg. Min Bid` double, "
                                "`H10 PPC Sugg. Max Bid` double")
    ko = {r["keyword_phrase"]: r for r in marts.keyword_opportunity(
        {"search_query_performance": sqp, "product_amazon": prod, "cerebro_amazon": cer}, "US").collect()}
    assert set(ko) == {"shoes", "boots"}
    s = ko["shoes"]
    assert (s["search_query_volume"], s["impressions"], s["clicks"], s["cerebro_search_volume"]) == (120, 60, 5, 500)
    assert s["impression_share"] == 0.5 and s["conversion_rate"] == 0.4
    assert ko["boots"]["conversion_rate"] == 0.0
    assert (ko["boots"]["category"], ko["boots"]["category2"], s["h10_max_bid"]) == (None, "Bar", 1.3)
    brand = {"search_query_performance_brand_view": spark.createDataFrame(
        [("q", D(2023, 5, 13), 5, 2.0, "US", 1, 1), ("q", D(2023, 5, 20), 7, 1.0, "US", 2, 1), ("r", D(2023, 5, 20), 1, 0.5, "US", 1, 0)],
        "search_query string, reporting_date date, search_query_volume long, search_query_score double, "
        "country string, purchases_total_count long, purchases_brand_count long")}
    trend = marts.search_query_trend(brand, [D(2023, 5, 13), D(2023, 5, 20)], ["q"]).collect()
    assert [tuple(x) for x in trend] == [("q", 5, 7)]
    totals = marts.search_query_totals(brand, ordered=True).collect()
    assert [(x["search_query"], x["search_query_volume"], x["purchases_total_count"]) for x in totals] == [
        ("r", 1, 1), ("q", 7, 2), ("q", 5, 1)]


def test_sqp_api_and_active_asins(spark):
    rec = spark.createDataFrame([("B0A", ("shoes", 10), (5,))],
                                "asin string, searchQueryData struct<searchQuery: string, searchQueryScore: long>, "
                                "impressionData struct<totalQueryImpressionCount: long>")
    out = ingest.sqp_api_batch(rec, 1, "US").first().asDict()
    assert out["search_query"] == "shoes" and out["total_query_impression_count"] == 5 and out["asin"] == "B0A"
    summ = spark.createDataFrame([
        (1, "US", D(2024, 1, 1), "B0A", ["DISCOVERABLE", "BUYABLE"]), (1, "US", D(2024, 1, 2), "B0A", ["BUYABLE"]),
        (1, "US", D(2023, 12, 20), "B0B", ["DISCOVERABLE", "BUYABLE"]), (1, "US", D(2024, 1, 3), "", ["DISCOVERABLE", "BUYABLE"]),
        (2, "US", D(2024, 1, 3), "B0C", ["DISCOVERABLE", "BUYABLE"])],
        "tenant_id int, marketplace string, date date, asin string, status array<string>")
    assert [r[0] for r in ingest.active_asins(summ, 1, "US", "2024-01-06", "2024-01-13").collect()] == ["B0A"]


def test_bulk_merge(spark):
    opp = spark.createDataFrame([("Bar", "shoes", 1.0), (None, "hats", 2.0)], "category string, keyword_phrase string, x double")
    bulk = spark.createDataFrame([("Keyword", "Bar", "shoes", 0.5), ("Campaign", "Bar", "shoes", 9.9),
                                  ("Keyword", None, "hats", 0.7), ("Keyword", "Other", "boots", 0.1)],
                                 "Entity string, `Portfolio Name (Informational only)` string, `Keyword Text` string, Bid double")
    got = sorted(((r["keyword_phrase"], r["Keyword Text"], r["Bid"]) for r in
                  marts.keyword_opportunity_with_bulk(opp, bulk).collect()), key=repr)
    assert got == sorted([("shoes", "shoes", 0.5), ("hats", "hats", 0.7), (None, "boots", 0.1)], key=repr)
