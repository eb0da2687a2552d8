from marketlake.operators.names import normalise_name

# hand-traced: what stored tables call these headers
CASES = {
    "unitsSoldClicks7d": "units_sold_clicks_7d", "SellerSKU": "seller_sku", "sessionsB2B": "sessions_b2b",
    "video5SecondViews": "video_5_second_views", "eCPAddToCart": "e_cpa_dd_to_cart",
    "Cart Adds: 2D Shipping": "cart_adds_2d_shipping", "attributedSalesSameSKU14d": "attributed_sales_same_sku_14d",
    "Position (Rank)": "position", "inventoryDetails.fulfillableQuantity": "inventory_details_fulfillable_quantity",
    "7_day_total_orders": "7_day_total_orders", "ASIN": "asin", "amount_b2b": "amount_b2b",
    "traffic_by_asin_sessions_b2b": "traffic_by_asin_sessions_b2b", "OrderTotal.AmountB2B": "order_total_amount_b2b",
    "Größe": "größe", "Prénom client": "prénom_client", "état": "état", "B2B": "b2b", "b2b": "b_2b",
    "Search Query": "search_query", "search_query": "search_query", "units_sold_clicks_7d": "units_sold_clicks_7d",
    "purchases14d": "purchases_14d", "campaignId": "campaign_id", "AmazonOrderId": "amazon_order_id",
    "Sales: Total": "sales_total", "your-price": "your_price", "  padded  ": "padded", "a__b": "a_b",
    "Click Share %": "click_share", "trafficByAsin.browserSessionsB2B": "traffic_by_asin_browser_sessions_b2b",
    "FNSKU": "fnsku", "fulfillment-channel-sku": "fulfillment_channel_sku", "is_7d": "is_7d", "x7": "x_7", "a_x7": "a_x7",
    "viewAttributedSales14d": "view_attributed_sales_14d", "salesBrandHalo": "sales_brand_halo",
    "TOS Impression Share %": "tos_impression_share", "H10 PPC Sugg. Bid": "h_10_ppc_sugg_bid",
}


def test_hand_traced_names():
    for raw, want in CASES.items():
        assert normalise_name(raw) == want, raw
    assert normalise_name("Position (Rank)", drop_parens=False) == "position_rank"
    assert normalise_name("report.csv", drop_extension=True) == "report"


def test_twice_is_once():
    for raw in set(CASES) - {"B2B", "b2b"}:     # a name that is one such word has no underscore to hold it
        once = normalise_name(raw)
        if not once[0].isdigit():
            assert normalise_name(once) == once, raw
