"""The shop's own tables, end to end: CSV import with declared types, key
audits, keep-first into a stored table, then reports on the stored table."""

import datetime as dt

from velocart.plans import prepare
from velocart.plans import reports as R
from velocart.schemas import CUSTOMER, ORDER_ITEMS, ORDERS, PRODUCT
from velocart.sources import create_namespace, load_typed, save_table

CSV = {
    "product": """product_id,brand,product_line,product_class,product_size,list_price,standard_cost
1,Giant Bicycles,Road,high,large,2100.00,1600.00
1,Giant Bicycles,Road,high,large,2100.00,1200.00
2,Trek Bicycles,Standard,medium,medium,900.50,600.25
3,Norco Bicycles,Road,low,small,,1700.00
""",
    "customer": """customer_id,first_name,last_name,job_title,job_industry_category,dob,state,property_valuation,deceased_indicator,owns_car,wealth_segment
10,Ann,Lee,Senior Developer,IT,1980-05-05,NSW,10,N,Yes,High Net Worth
11,Bob,Ray,Lead Analyst,Financial Services,1970-01-01,NSW,2,N,Yes,Mass Customer
12,Cid,Moe,Senior Dev,IT,2000-01-01,VIC,5,N,No,Affluent Customer
13,Dee,Fox,Manager,Retail,1990-01-01,QLD,7,N,Yes,Affluent Customer
""",
    "orders": """order_id,customer_id,order_date,order_status,online_order
100,10,2017-04-01,Approved,true
101,10,2017-04-02,Approved,false
102,11,2017-04-02,Approved,true
103,12,2017-04-03,Cancelled,true
""",
    "order_items": """order_item_id,order_id,product_id,quantity,item_list_price_at_sale
1000,100,1,600,2100.00
1001,101,1,500,2100.00
1002,102,3,1000,1700.00
1003,103,2,5,900.50
""",
}
SCHEMAS = {"product": PRODUCT, "customer": CUSTOMER, "orders": ORDERS, "order_items": ORDER_ITEMS}


def test_import_audit_dedupe_report(spark, tmp_path):
    frames = {}
    for name, text in CSV.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        frames[name] = load_typed(spark, str(path), SCHEMAS[name], fmt="csv")
        assert frames[name].schema == SCHEMAS[name]

    audits = prepare.audit_tables(frames)
    assert [tuple(r) for r in audits["product"].collect()] == [(1, 2)]
    assert all(audits[n].count() == 0 for n in ("customer", "orders", "order_items"))

    create_namespace(spark, "shop_e2e")
    save_table(frames["product"].coalesce(1), "shop_e2e.product", mode="overwrite")  # the import
    product_new = prepare.store_first_per_key(
        spark.table("shop_e2e.product"), ["product_id"], "file_order", "shop_e2e.product_new", mode="overwrite"
    )
    assert product_new.count() == 3
    # the first record of product 1 (cost 1600) is the one kept
    assert product_new.filter("product_id = 1").first().standard_cost == 1600

    c, o, i = frames["customer"], frames["orders"], frames["order_items"]
    assert sorted(r.brand for r in R.brands_by_cost_and_volume(product_new, i).collect()) == [
        "Giant Bicycles",
        "Norco Bicycles",
    ]
    assert [tuple(r) for r in R.daily_orders(o).collect()] == [
        (dt.date(2017, 4, 1), 1, 1),
        (dt.date(2017, 4, 2), 1, 1),
    ]
    assert sorted(r.job_title for r in R.titles_by_rules(c, as_of="2025-02-28").collect()) == [
        "Lead Analyst",
        "Senior Developer",
    ]
    assert [r.customer_id for r in R.lapsed_customers(c, o).collect()] == [13]
    top = R.top_customers(c, o, i, product_new).collect()
    assert [(r.customer_id, r.count_order) for r in top] == [(10, 1)]
