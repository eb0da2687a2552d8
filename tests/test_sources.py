"""Readers on small landed files written to the test's scratch folder."""
import datetime as dt
import gzip
import json
import os

from pyspark.sql import types as T

from marketlake.sources import files as fs
from marketlake.sources.catalog import column_type, report_schema, stored_schema
from marketlake.sources.dimensions import marketplaces


def test_json_reports_with_name_provenance(spark, tmp_path):
    d = tmp_path / "ads"
    d.mkdir()
    name = "SPONSORED_PRODUCTS (acme+co-US) spCampaigns ['campaign'] 2024-01-01 - 2024-01-31.json.gz"
    with gzip.open(d / name, "wt") as f:
        json.dump([{"date": "2024-01-01", "campaignId": 5, "cost": 1.5}, {"date": "2024-01-02", "campaignId": 6}], f)
    with gzip.open(d / "ignored.txt.gz", "wt") as f:
        f.write("x")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("campaignId", T.LongType()),
                           T.StructField("cost", T.DoubleType())])
    df = fs.read_json_reports(spark, str(d), schema)
    r = df.orderBy("date").collect()
    assert len(r) == 2 and r[0]["account"] == "acme+co" and r[0]["marketplace"] == "US"
    assert r[0]["report_date"] == dt.date(2024, 1, 31)          # the last date in the name
    assert r[0]["ad_product"] == "SPONSORED_PRODUCTS" and r[0]["report_type"] == "spCampaigns"
    assert r[0]["group_by"] == "['campaign']"


def test_two_header_csv(spark, tmp_path):
    d = tmp_path / "sqp"
    d.mkdir()
    for asin, rows in (("B0AAA", [("2024-01-06", "shoes", "10")]), ("B0BBB", [("2024-01-06", "hats", "3"),
                                                                              ("2024-01-13", "hats", "4")])):
        with open(d / f"US_Search_Query_Performance_ASIN_View_Week_{asin}.csv", "w") as f:
            f.write(f'ASIN or Product=["{asin}"],Reporting Range=["Weekly"],Select week=["Week 1"]\n')
            f.write("Reporting Date,Search Query,Search Query Volume\n")
            for r in rows:
                f.write(",".join(r) + "\n")
    df = fs.read_two_header_csv(spark, str(d), ["Reporting Date", "Search Query", "Search Query Volume"])
    got = sorted((r["asin"], r["reporting_range"], r["Search Query"], r["Search Query Volume"]) for r in df.collect())
    assert got == [("B0AAA", "Weekly", "shoes", "10"), ("B0BBB", "Weekly", "hats", "3"), ("B0BBB", "Weekly", "hats", "4")]


def test_dated_csv_and_tsv(spark, tmp_path):
    d = tmp_path / "daily"
    d.mkdir()
    (d / "Sponsored Products Campaigns - January 5, 2024.csv").write_text("Campaign,Cost\nc1,$1.00\n")
    (d / "Sponsored Products Campaigns - January 6, 2024.csv").write_text("")
    df = fs.read_dated_csv(spark, str(d), T.StructType([T.StructField("Campaign", T.StringType()),
                                                         T.StructField("Cost", T.StringType())]))
    assert [(r["Campaign"], r["date"]) for r in df.collect()] == [("c1", dt.date(2024, 1, 5))]
    t = tmp_path / "tsv"
    t.mkdir()
    (t / "fees.txt").write_bytes("sku\tprice\nS1\t--\nS\xe92\t3.5\n".encode("latin-1"))
    df = fs.read_latin1_tsv(spark, str(t))
    assert sorted((r["sku"], r["price"]) for r in df.collect()) == [("S1", "--"), ("Sé2", "3.5")]


def test_pages_and_rates(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    pages = [{"Orders": [{"AmazonOrderId": "o1", "ShippingAddress": {"CountryCode": "US"}},
                         {"AmazonOrderId": "o2", "ShippingAddress": None}]}, {"Orders": []}]
    (d / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    schema = T.StructType.fromDDL("Orders ARRAY<STRUCT<AmazonOrderId: STRING, ShippingAddress: STRUCT<CountryCode: STRING>>>")
    df = fs.read_pages(spark, str(d), schema, "Orders")
    assert sorted(df.columns) == ["AmazonOrderId", "ShippingAddress_CountryCode", "source_file"]
    assert df.count() == 2
    fx = spark.createDataFrame([("USD", {"2024-01-01": {"USDEUR": "0.912345", "USDGBP": "0.79"}})],
                               "source string, quotes map<string, map<string, string>>")
    r = sorted(tuple(x) for x in fs.explode_rates(fx).collect())
    assert [(x[2], str(x[3])) for x in r] == [("EUR", "0.912345000000000000"), ("GBP", "0.790000000000000000")]


def test_catalog_types_and_dimensions(spark):
    assert column_type("campaignId") == T.LongType()
    assert column_type("unitsSoldClicks7d") == T.LongType()
    assert column_type("clickThroughRate") == T.DoubleType()
    assert column_type("costPerClick") == T.DoubleType()
    assert column_type("campaignName") == T.StringType()
    s = report_schema("date, startDate, endDate, campaignId, cost", "DAILY")
    assert s.names == ["date", "campaignId", "cost"]
    assert stored_schema("date, campaignId", "DAILY").names == ["tenant_id", "marketplace", "date", "campaign_id"]
    assert marketplaces(spark).count() == 22


def test_read_any_wrapped_listing_and_newer(spark, tmp_path):
    import time
    d = tmp_path / "biz"
    d.mkdir()
    doc = {"reportSpecification": {"reportType": "X"},
           "salesAndTrafficByAsin": [{"parentAsin": "P1", "trafficByAsin": {"sessions": 3}},
                                     {"parentAsin": "P2", "trafficByAsin": {"sessions": 5}}]}
    with gzip.open(d / "report.json.gz", "wt") as f:
        json.dump(doc, f)
    schema = T.StructType.fromDDL("salesAndTrafficByAsin ARRAY<STRUCT<parentAsin: STRING, "
                                  "trafficByAsin: STRUCT<sessions: BIGINT>>>")
    df = fs.read_wrapped_json(spark, str(d), schema, "salesAndTrafficByAsin")
    assert sorted((r["parentAsin"], r["trafficByAsin_sessions"]) for r in df.collect()) == [("P1", 3), ("P2", 5)]
    assert fs.read_any(spark, str(d / "report.json.gz"), schema).count() == 1
    csv = tmp_path / "x.csv"
    csv.write_text("a,b\n1,2\n")
    assert fs.read_any(spark, str(csv)).first()["b"] == "2"
    files = fs.list_files(spark, str(tmp_path), "*.gz").collect()
    assert [os.path.basename(r["path"]) for r in files] == ["report.json.gz"]
    cutoff = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() + 3600))
    from marketlake.operators.incremental import read_newer_files
    assert read_newer_files(spark, "csv", str(tmp_path), cutoff, "a string, b string", header=True,
                            pathGlobFilter="*.csv").count() == 0


def test_sqp_file_tags(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("/x/US_Search_Query_Performance_Brand_View_Week.csv",)], "p string")
    r = df.select(*[c.alias(n) for n, c in fs.sqp_file_tags(F.col("p")).items()]).first()
    assert (r["marketplace"], r["view"]) == ("US", "brand")


def test_corrupt_files_are_not_lost(spark, tmp_path):
    import pytest
    d = tmp_path / "ads"
    d.mkdir()
    whole = gzip.compress(json.dumps([{"date": "2024-01-01", "cost": 1.0}] * 5000).encode())
    (d / "good.json.gz").write_bytes(whole)
    (d / "cut.json.gz").write_bytes(gzip.compress(b'[{"date": "2024-01-01", "cost"'))
    schema = T.StructType.fromDDL("date DATE, cost DOUBLE")
    with pytest.raises(Exception, match="(?i)malformed|corrupt|EOF"):
        fs.read_json_reports(spark, str(d), schema).collect()
    both = fs.read_json_reports(spark, str(d), schema, bad="keep")
    assert fs.accepted(both).count() == 5000
    bad = fs.rejects(both).collect()
    assert len(bad) == 1 and "cut.json.gz" in bad[0]["source_file"]


def test_columns_by_header(spark, tmp_path):
    (tmp_path / "1.txt").write_text("a\tb\n1\tx\n2\t\n")
    (tmp_path / "2.txt").write_text("\ufeffb\textra\ta\n\"y \"\"q\"\"\"\tz\t3\n")
    (tmp_path / "3.txt").write_text("b\nonly\n")
    got = fs.read_tsv(spark, str(tmp_path), T.StructType.fromDDL("a INT, b STRING"), quote='"')
    assert sorted(((r.a, r.b) for r in got.collect()), key=str) == [(1, "x"), (2, None), (3, 'y "q"'), (None, "only")]
    assert sorted(fs.read_tsv(spark, str(tmp_path)).columns) == ["a", "b", "extra", "source_file"]
    (tmp_path / "4.txt").write_text("a\tb\n=[\tx\n")
    kept = fs.read_tsv(spark, str(tmp_path), T.StructType.fromDDL("a INT, b STRING"), bad="keep")
    assert [(r.b, r._rejected) for r in fs.rejects(kept).collect()] == [("x", ["a"])]
    assert fs.accepted(kept).count() == 4
    wide = tmp_path / "wide.csv"
    wide.write_text(",".join(f"c{i}" for i in range(700)) + "\n" + ",".join(str(i) for i in range(700)) + "\n")
    assert fs.read_any(spark, str(wide)).first()["c699"] == "699"
    packed = tmp_path / "z.csv.gz"
    packed.write_bytes(gzip.compress(b"a,b\n1,2\n"))
    assert fs.read_any(spark, str(packed)).collect() == fs.read_any(spark, str(packed), fmt="csv").collect()


def test_two_header_lines_go_by_position(spark, tmp_path):
    text = 'ASIN or Product=["B0AAA"],Reporting Range=["Weekly"]\nReporting Date,Search Query\n'
    rows = ["2024-01-06,a=[b", "a=[b,x", "Reporting Date,Search Query", '2024-01-06,"x, y"']
    (tmp_path / "US_Search_Query_1.csv").write_text(text + "\n".join(rows) + "\n")
    got = fs.read_two_header_csv(spark, str(tmp_path), ["Reporting Date", "Search Query"]).collect()
    assert sorted((r["Reporting Date"], r["Search Query"]) for r in got) == [
        ("2024-01-06", "a=[b"), ("2024-01-06", "x, y"), ("Reporting Date", "Search Query"), ("a=[b", "x")]
    assert {(r["asin"], r["reporting_range"]) for r in got} == {("B0AAA", "Weekly")}


def test_types_follow_from_metric_names():
    from marketlake.sources import catalog as c
    kinds = {
        T.DateType(): "date, startDate, endDate",
        T.StringType(): "campaignName, campaignStatus, campaignBiddingStrategy, campaignBudgetType, campaignBudgetCurrencyCode, "
                        "campaignApplicableBudgetRuleId, currency, keyword, keywordText, matchType, targeting, "
                        "targetingExpression, searchTerm, placementClassification, advertisedAsin, promotedSku, asin, sku, "
                        "costType, bidOptimization, attributionType, productCategory, asinBrandHalo",
        T.LongType(): "campaignId, adId, keywordId, targetId, impressions, impressionsViews, viewImpressions, "
                      "viewableImpressions, clicks, addToCartClicks, brandedSearchesViews, detailPageViewsClicks, "
                      "newToBrandDetailPageViews, newToBrandDetailPageViewClicks, purchases1d, purchasesSameSku7d, "
                      "purchasesPromotedClicks, unitsSoldClicks14d, unitsSoldOtherSku30d, orders14d, newToBrandPurchases14d, "
                      "newToBrandUnitsSoldClicks, video5SecondViews, videoCompleteViews, videoUnmutes, cumulativeReach, "
                      "kindleEditionNormalizedPagesRead14d, grossClickThroughs, invalidImpressions, "
                      "conversionsBrandHaloClicks, unitsSoldBrandHalo, dpv14d, attributedDetailPageViewsClicks14d, "
                      "viewAttributedBrandedSearches14d, attributedConversions14dSameSKU, attributedUnitsOrdered1d, "
                      "viewAttributedConversions14d, attributedOrdersNewToBrand14d, attributedUnitsOrderedNewToBrand14d",
        T.DoubleType(): "cost, spend, costPerClick, clickThroughRate, sales, sales7d, salesOtherSku7d, salesBrandHalo, "
                        "attributedSalesSameSku14d, acosClicks7d, roasClicks14d, keywordBid, campaignBudget, "
                        "campaignBudgetAmount, campaignRuleBasedBudget, topOfSearchImpressionShare, "
                        "kindleEditionNormalizedPagesRoyalties14d, addToCartRate, eCPAddToCart, eCPBrandSearch, "
                        "newToBrandECPDetailPageView, newToBrandPurchasesPercentage14d, newToBrandSales14d, "
                        "video5SecondViewRate, viewabilityRate, impressionsFrequencyAverage, avgImpressionsFrequency, "
                        "invalidClickThroughRate, vctr, vtr, attributedSales14dSameSKU, viewAttributedSales14d, "
                        "attributedOrderRateNewToBrand14d, attributedUnitsOrderedNewToBrandPercentage14d"}
    for kind, names in kinds.items():
        assert {n: column_type(n) for n in names.split(", ")} == dict.fromkeys(names.split(", "), kind)
    assert len(c.REPORTS) == len({r[:3] for r in c.REPORTS}) == 23 and len(c.REPORTS_V2) == 14
    assert c.lookup("SPONSORED_PRODUCTS", "spSearchTerm", "['searchTerm']") == "search_term"
    assert c.lookup_v2("SPONSORED_BRANDS", "campaigns") == "campaign_v2"


def test_metrics_from_landed_reports(spark, tmp_path):
    from marketlake.sources.catalog import landed_metrics
    for name, records in {
            "SPONSORED_PRODUCTS (acme-US) spCampaigns ['campaign'] 2024-01-01.json.gz": [{"date": "2024-01-01", "cost": 1.0}],
            "SPONSORED_PRODUCTS (acme-CA) spCampaigns ['campaign'] 2024-01-01.json.gz": [{"campaignId": 7}, {"cost": None}],
            "SPONSORED_DISPLAY (acme-US) sdTargeting ['targeting', 'matchedTarget'] 2024-01-01.json.gz": [{"clicks": 1}],
            "SPONSORED_DISPLAY (acme-US) sdNew ['x'] 2024-01-01.json.gz": [{"clicks": 1}]}.items():
        (tmp_path / name).write_bytes(gzip.compress(json.dumps(records).encode()))
    got = {(r.report_type, r.table_name): r.metrics for r in landed_metrics(spark, str(tmp_path)).collect()}
    assert got == {("spCampaigns", "sponsored_products.campaign"): ["campaignId", "cost", "date"],
                   ("sdTargeting", "sponsored_display.targeting_matched_asin"): ["clicks"], ("sdNew", None): ["clicks"]}
    assert report_schema(got["spCampaigns", "sponsored_products.campaign"]).simpleString() == \
        "struct<campaignId:bigint,cost:double,date:date>"


def _read(fn, spark, path, *args, **kw):
    return sorted((tuple(r) for r in fn(spark, str(path), *args, **kw).drop("source_file").collect()), key=str)


def test_cells_that_a_line_parser_loses(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"A" size,\n2,"two\nlines, ""quoted"""\n3,plain\n4\n'.replace('size,', 'size'))
    assert _read(fs.read_delimited, spark, tmp_path, glob="*.csv") == [
        ("1", '"A" size'), ("2", 'two\nlines, "quoted"'), ("3", "plain"), ("4", None)]
    (tmp_path / "b.txt").write_text('a\tb\tc\n1\t"10 in\t5"\n2\tx\\\ty\n')
    assert _read(fs.read_tsv, spark, tmp_path) == [("1", '"10 in', '5"'), ("2", "x\\", "y")]
    (tmp_path / "c.tsv").write_bytes("b\ta\n\xa3 5\t1\n".encode("latin-1"))
    assert _read(fs.read_tsv, spark, tmp_path, glob="*.tsv", encoding="ISO-8859-1") == [("\xa3 5", "1")]


def test_a_record_with_too_many_cells(spark, tmp_path):
    import pytest
    (tmp_path / "1.csv").write_text("a,b\n1,x\n2,y,lost\n3,,,lost\n4,z,\n5\n")
    schema = T.StructType.fromDDL("a INT, b STRING")
    with pytest.raises(Exception, match="more cells than the header"):
        fs.read_delimited(spark, str(tmp_path), schema).collect()
    with pytest.raises(Exception, match="more cells than the header"):
        fs.read_delimited(spark, str(tmp_path), schema).count()
    kept = fs.read_delimited(spark, str(tmp_path), schema, bad="keep")
    assert sorted((r.a, r._rejected) for r in fs.rejects(kept).collect()) == [(2, ["_cells"]), (3, ["_cells"])]
    assert sorted((r.a, r.b) for r in fs.accepted(kept).collect()) == [(1, "x"), (4, "z"), (5, None)]


def test_headers_in_any_order_and_odd_file_names(spark, tmp_path):
    (tmp_path / "R ['x'] (a-US) {1}.csv").write_text("a,b,a\n1,2,3\n")
    (tmp_path / "50% b+c.csv").write_text("\ufeff\n\nb,new,a\n4,5,6\n")
    (tmp_path / "same*.csv").write_text("a,b,a\n7,8,9\n")
    (tmp_path / "empty.csv").write_text("")
    df = fs.read_delimited(spark, str(tmp_path), glob="*.csv")
    assert df.columns == ["a", "b", "new", "source_file"]
    assert sorted((r.a, r.b, r.new, os.path.basename(r.source_file)) for r in df.collect()) == [
        ("1", "2", None, "R ['x'] (a-US) {1}.csv"), ("6", "4", "5", "50% b+c.csv"), ("7", "8", None, "same*.csv")]
    assert df.inputFiles() and fs.read_delimited(spark, str(tmp_path), glob="empty.csv").count() == 0


def test_only_first_lines_are_read_for_headers(spark, tmp_path):
    (tmp_path / "big.csv").write_text("a,b\n" + "1,2\n" * 200_000)
    (tmp_path / "other.csv").write_text("x\n1\n")
    heads = fs._first_lines(spark, str(tmp_path), "*.csv", "UTF-8", 1)
    assert [(os.path.basename(f), lines) for f, lines in heads] == [("big.csv", ["a,b"]), ("other.csv", ["x"])]
    numbered = fs.read_delimited(spark, str(tmp_path), glob="big.csv", line_numbers=True)
    assert numbered.select("line_no").distinct().count() == 200_000


def test_two_headers_with_line_breaks_and_repeated_headers(spark, tmp_path):
    meta = 'ASIN or Product=["B0"],Reporting Range=["Weekly"]\n'
    (tmp_path / "1.csv").write_text(meta + "Date,Query\nDate,Query\nDate,Query\n1,\"two\nlines\"\n2\n")
    (tmp_path / "2.csv").write_text(meta.replace("B0", "B1") + "Date,Query,More\n3,q,m\n")
    got = fs.read_two_header_csv(spark, str(tmp_path), ["Date", "Query"]).drop("source_file")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        ("Date", "Query", "B0", "Weekly"), ("Date", "Query", "B0", "Weekly"), ("1", "two\nlines", "B0", "Weekly"),
        ("2", None, "B0", "Weekly"), ("3", "q", "B1", "Weekly")], key=str)


def test_headers_of_small_files_share_tasks(spark, tmp_path):
    """FINDINGS r03 F3, F4: every file had a task of its own, with a Python worker, for its first lines."""
    for i in range(60):
        (tmp_path / f"{i}.csv").write_text(f"\r\n \nmeta {i}\r\na,b\rx,{i}\n")
    (tmp_path / "large.csv").write_text("meta\na,b\n" + "1,2\n" * (fs.SMALL_FILE // 4))
    (tmp_path / "short.csv").write_text("meta\n")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("meta\na,b\n1,2\n")
    spark.sparkContext.setJobGroup("heads", "heads")
    try:
        heads = {os.path.basename(f): lines for f, lines in fs._first_lines(spark, str(tmp_path), "*.csv*", "UTF-8", 2)}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert heads == {**{f"{i}.csv": [f"meta {i}", "a,b"] for i in range(60)}, "large.csv": ["meta", "a,b"],
                     "packed.csv.gz": ["meta", "a,b"]}
    status = spark.sparkContext.statusTracker()
    tasks = sum(status.getStageInfo(k).numTasks for j in status.getJobIdsForGroup("heads") for k in status.getJobInfo(j).stageIds)
    assert tasks < 40
