"""Hand-made store rows (FIXTURES.md schemas) written as raw CSV files.

Covers: NULL delivery timestamp, unparseable timestamp, delivery before
purchase, delivery equal to the estimate, approval in December with
delivery in January, an order with 2 reviews x 2 items x 2 payments, a
category in no group, a lead with NULL origin, a seller whose prices are
all NULL, a quoted newline and a doubled quote in a review, a byte-order
mark at the head of one file.
"""

import os

CSV = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-12-01 10:00:00,2017-12-01 12:00:00,2017-12-03 00:00:00,2018-01-02 09:00:00,2018-01-10 00:00:00
o2,c2,shipped,2018-01-05 00:00:00,2018-01-05 01:00:00,2018-01-06 00:00:00,,2018-01-20 00:00:00
o3,c3,canceled,not-a-date,2018-01-07 00:00:00,2018-01-08 00:00:00,2018-01-09 00:00:00,2018-01-30 00:00:00
o4,c1,delivered,2018-03-05 12:00:00,2018-03-05 13:00:00,2018-03-06 00:00:00,2018-03-04 10:00:00,2018-03-20 00:00:00
o5,c4,delivered,2018-02-01 00:00:00,2018-02-01 00:00:00,2018-02-02 00:00:00,2018-02-11 00:00:00,2018-02-11 00:00:00
o6,c5,weird,2018-02-03 00:00:00,2018-02-03 06:00:00,2018-02-04 00:00:00,2018-02-10 00:00:00,2018-02-28 00:00:00
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310,sao paulo,SP
c2,u2,20000,rio de janeiro,RJ
c3,u3,01311,sao paulo,SP
c4,u4,20001,niteroi,RJ
c5,u5,99999,nowhere,XX
""",
    "state_codes": """subdivision,name
SP,Sao Paulo
RJ,Rio de Janeiro
""",
    "order_reviews": '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"Muito bom, recomendo
chegou rápido",2018-01-03 00:00:00,2018-01-04 00:00:00
r2,o1,4,ok,"produto ""top""",2018-01-05 00:00:00,2018-01-06 00:00:00
r3,o2,1,,,2018-01-21 00:00:00,2018-01-22 00:00:00
r4,o3,3,bom,,2018-01-10 00:00:00,2018-01-11 00:00:00
r5,o4,2,,não gostei,2018-03-05 00:00:00,2018-03-06 00:00:00
r6,o5,5,,,2018-02-12 00:00:00,2018-02-13 00:00:00
r7,o6,4,,,2018-02-11 00:00:00,2018-02-12 00:00:00
''',
    "products": """product_id,product_category_name
p1,perfumaria
p2,pc_gamer
p3,automotivo
p4,
p5,cama_mesa_banho
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-12-05 00:00:00,10.0,1.0
o1,2,p3,s2,2017-12-05 00:00:00,20.0,2.0
o2,1,p5,s1,2018-01-07 00:00:00,30.0,3.0
o4,1,p1,s3,2018-03-07 00:00:00,,1.0
o5,1,p3,s2,2018-02-03 00:00:00,40.0,4.0
""",
    "order_payments": """order_id,payment_value
o1,15.0
o1,16.0
o2,30.0
o4,5.0
o5,40.0
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,01001,sao paulo,SP
s2,20002,rio,RJ
s3,30003,bh,MG
""",
    "leads": """mql_id,first_contact_date,landing_page_id,origin
m1,2018-01-03,lp1,paid_search
m2,2018-01-20,lp2,organic_search
m3,2018-02-01,lp1,
m4,junk,lp3,paid_search
m5,2018-02-14,lp2,paid_search
""",
    "closed_deals": """mql_id,seller_id,sdr_id,sr_id,won_date,business_segment,lead_type,lead_behaviour_profile,business_type,declared_monthly_revenue
m1,s1,d1,r1,2018-02-01 00:00:00,pet,online_big,cat,reseller,0.0
m2,s2,d2,r2,2018-02-05 00:00:00,car,industry,eagle,manufacturer,100.0
m3,s3,d1,r1,2018-03-01 00:00:00,home,online_small,,reseller,
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
1037,-23.5456,-46.6393,sao paulo,SP
1046,,-46.6441,sao paulo,SP
""",
}


def write_raw(base: str) -> str:
    for name, text in CSV.items():
        path = os.path.join(base, f"{name}.csv")
        data = text.encode("utf-8")
        if name == "state_codes":
            data = b"\xef\xbb\xbf" + data  # byte-order mark (T22)
        with open(path, "wb") as f:
            f.write(data)
    return base


def load(spark, base):
    from bazaar.sources.io import read_table

    return {name: read_table(spark, base, name) for name in CSV}
