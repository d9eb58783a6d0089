"""Schemas of the source tables, and of the table of planning inputs for recommendations."""

# Sources that a run can do without.
OPTIONAL = ["pipeline_stock"]

SCHEMAS = {
    "product_master": """
        sku string, listing_id string, lead_time_production_days int, units_per_carton int,
        carton_weight_kg double, carton_volume double, ship_weight double, preferred_vendor string,
        dim_h_cm double, dim_l_cm double, dim_w_cm double, successor_sku string, snapshot_date date""",
    "sku_vendor_map": "sku string, vendor string, preferred_vendor string",
    "sales_plan": """
        market string, sku string, listing_id string, date date, snapshot_date date,
        review_cycle_version string, quantity double""",
    "product_catalog": """
        listing_id string, country_code string, brand_name string, sku string, marketplace string,
        portfolio_cluster string, go_forward int""",
    "po_lines": """
        id bigint, document_number string, line_id string, po_line_key string, batch_id string,
        sku string, listing_id string, brand string, vendor string, vendor_category string,
        market string, market_alt string, deliver_to_location string, memo string,
        final_status string, production_status string, prd_status string, prd_reconfirmation string,
        prd_change_reason string, ordered_at string, prd string, planned_prd string,
        confirmed_crd string, first_prd string, accepted_prd string,
        expected_po_arrival_date string, planned_pickup_date string, quality_control_date string,
        quantity bigint, qty_received string, quantity_on_shipments string, item_rate double,
        item_rate_eur double, wh_type string, transport_mode string, transport_type string,
        incoterms string, supplier_payment_terms string, quality_control_status string,
        subsidiary string, im_sign_off string, sm_sign_off string, anti_po string,
        snapshot_date date""",
    "po_status": "document_number string, line_id string, current_status string",
    "shipment_headers": """
        shipment_number string, external_document_number string, market_place string,
        receiving_warehouse_type string, fba_id string, status string, substatus string,
        cargo_ready_date date, expected_shipping_date date, expected_arrival_date date,
        expected_delivery_date date, actual_cargo_pick_up_date date, actual_shipping_date date,
        actual_arrival_date date, actual_delivery_date date, date_created string,
        snapshot_date date""",
    "shipment_lines": """
        shipment_number string, po_line_key string, po string, sku string, vendor string,
        receiving_location string, quantity_expected bigint,
        quantity_remaining_to_be_received bigint, quantity_received bigint""",
    "stock_snapshots": """
        snapshot_date date, listing_id string, sku string, market string, brand_name string,
        in_fm double, in_to_w2w double, in_nn3pl double, in_n3pl double, in_lm double,
        in_amz double, in_wq double, in_rsvd_cust_ord double, in_rsd_fc_proc double,
        in_walmart double, in_bol double, in_meli double, in_to_osc_l3m double,
        units_in_d2amz double, total_inventory double, units_open_pos_raw double""",
    "avg_price_l30": "listing_id string, sales_channel string, marketplace string, gross_asp_l30 double",
    "price_benchmarks": "listing_id string, market_reporting string, asp_benchmark double, date date",
    "vendor_master": """
        vendor_id string, vendor_name string, port_of_departure string, supplier_manager string,
        category_manager string, country string, supplier_category string, snapshot_date date""",
    "pipeline_stock": """
        ref string, market string, fulfillable_7d double, at_amz_21d double,
        on_the_way_to_amz_35d double, local_market_49d double, otw_35p_98d double,
        manufacturing_28_126d double, manufacturing_56p_168d double, units_per_carton int""",
}
