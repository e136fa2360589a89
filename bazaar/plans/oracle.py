"""DuckDB SQL equal to each bound query (tables registered as views under
their test-table names). Written from the operator definitions, not
generated from the Spark plans; M14 is the plain join-then-count form, so it
also checks the count-over-join rewrite of the Spark plan.
"""

from __future__ import annotations

import warnings

from bazaar.functions.text import LETTERS_PATTERN
from bazaar.plans.bindings import (
    FOLDS, K_NEIGHBOURS, LEXICON_LEAST, MIN_CONFIDENCE, MIN_LIFT, MIN_SUPPORT, N_PRODUCTS, PAID_ORIGIN, PAID_PRICE,
    TEST_LEXICON, TYPE_CONFIDENCE, TYPE_LIFT, TYPE_SUPPORT,
)
from bazaar.sources.dimensions import OVERRIDE_POLARITY, OVERRIDE_WORDS, STOPWORDS_PT


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000.0) AS BIGINT)"


STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
          "ELSE o_orderstatus END")
STATUS_CODE = ("CASE {c} WHEN 'delivered' THEN 1 WHEN 'shipped' THEN 2 WHEN 'canceled' THEN 3 "
               "WHEN 'unavailable' THEN 4 WHEN 'invoiced' THEN 5 WHEN 'processing' THEN 6 "
               "WHEN 'created' THEN 7 WHEN 'approved' THEN 8 ELSE 0 END")
GROUP = ("CASE WHEN {c} IN ('ECONOMY', 'PROMO') THEN 'budget' "
         "WHEN {c} IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'size' ELSE '0' END")

M1 = f"""
orders_v AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, {STATUS} AS order_status,
         o.o_orderdate AS order_purchase_timestamp,
         CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderdate END AS order_approved_at,
         o.o_orderdate AS order_delivered_carrier_date,
         ls.delivered AS order_delivered_customer_date,
         o.o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS delivered FROM lineitem
                           GROUP BY l_orderkey) ls ON ls.l_orderkey = o.o_orderkey),
customers_v AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
         c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
         CAST(c_nationkey AS VARCHAR) AS customer_state FROM customer),
states_v AS (SELECT CAST(n_nationkey AS VARCHAR) AS subdivision, n_name AS name FROM nation),
reviews_v AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
         l_orderkey AS order_id, 1 + l_linenumber % 5 AS review_score,
         l_shipdate AS review_creation_date, l_shipdate AS review_answer_timestamp
  FROM lineitem),
m1 AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
         o.order_approved_at, o.order_delivered_carrier_date, o.order_delivered_customer_date,
         o.order_estimated_delivery_date, c.customer_unique_id, c.customer_zip_code_prefix,
         c.customer_city, c.customer_state,
         {_days('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS arrival_days,
         {STATUS_CODE.format(c='o.order_status')} AS numeric_order_status,
         s.name, r.review_id, r.review_score, r.review_creation_date, r.review_answer_timestamp
  FROM orders_v o JOIN customers_v c ON c.customer_id = o.customer_id
  JOIN states_v s ON s.subdivision = c.customer_state
  JOIN reviews_v r ON r.order_id = o.order_id)"""

M2 = f"""
items_v AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
         l_tax AS freight_value FROM lineitem),
translation_v AS (SELECT DISTINCT p_type AS product_category_name,
                         lower(p_type) AS product_category_name_english FROM part),
pt AS (
  SELECT p.p_partkey AS product_id, p.p_type AS product_category_name,
         t.product_category_name_english,
         {GROUP.format(c='p.p_type')} AS product_principal_category
  FROM part p JOIN translation_v t ON t.product_category_name = p.p_type),
m2 AS (
  SELECT i.*, pt.product_category_name, pt.product_category_name_english,
         pt.product_principal_category, o.o_totalprice AS payment_value
  FROM items_v i JOIN pt ON pt.product_id = i.product_id
  JOIN orders o ON o.o_orderkey = i.order_id)"""

DEALS = """
deals AS (
  SELECT s.s_suppkey AS mql_id, s.s_suppkey AS seller_id, CAST(s.s_nationkey AS VARCHAR) AS sdr_id,
         CAST(n.n_regionkey AS VARCHAR) AS sr_id, CAST(NULL AS TIMESTAMP) AS won_date,
         n.n_name AS business_segment, s.s_name AS lead_type,
         CAST(NULL AS VARCHAR) AS lead_behaviour_profile, r.r_name AS business_type,
         s.s_acctbal AS declared_monthly_revenue
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
leads AS (SELECT c_custkey AS mql_id, c_name AS landing_page_id, c_mktsegment AS origin FROM customer),
ql AS (SELECT landing_page_id, origin, seller_id, business_segment, lead_type,
              lead_behaviour_profile, business_type FROM leads JOIN deals USING (mql_id))"""

SALES = """
sales AS (SELECT l_suppkey AS seller_id, coalesce(sum(l_extendedprice), 0.0) AS seller_sales
          FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey)"""

RATINGS = """
rows_v AS (SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id, l.l_quantity AS score
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
pp AS (SELECT customer_id, product_id, avg(score) AS rating FROM rows_v GROUP BY customer_id, product_id),
ru AS (SELECT customer_id FROM rows_v GROUP BY customer_id HAVING count(*) >= 2),
ratings AS (SELECT pp.* FROM pp JOIN ru USING (customer_id))"""

NEIGHBOURS = f"""
unit AS (SELECT customer_id AS u, product_id AS p,
                rating / sqrt(sum(rating * rating) OVER (PARTITION BY customer_id)) AS w FROM ratings),
dots AS (SELECT a.u, b.u AS v, sum(a.w * b.w) AS sim FROM unit a JOIN unit b
         ON a.p = b.p AND a.u <> b.u GROUP BY a.u, b.u HAVING sum(a.w * b.w) > 0),
nb_ranked AS (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY round(sim, 9) DESC, v DESC) AS rk
              FROM dots),
nb_found AS (SELECT * FROM nb_ranked WHERE rk <= {K_NEIGHBOURS}),
nb_users AS (SELECT DISTINCT customer_id AS u FROM ratings),
nb_top AS (SELECT u AS id FROM nb_users ORDER BY u DESC LIMIT {K_NEIGHBOURS + 1}),
nb_m AS (SELECT nb_users.u, count(nb_found.v) AS m FROM nb_users LEFT JOIN nb_found
         ON nb_found.u = nb_users.u GROUP BY nb_users.u),
nb_pads AS (SELECT nb_m.u, t.id AS v, nb_m.m + row_number() OVER (PARTITION BY nb_m.u ORDER BY t.id DESC) AS rk
            FROM nb_m, nb_top t
            WHERE t.id <> nb_m.u AND NOT EXISTS (SELECT 1 FROM nb_found f WHERE f.u = nb_m.u AND f.v = t.id)),
nb AS (SELECT u AS customer_id, rk, v AS neighbour, round(sim, 9) AS similarity FROM nb_found
       UNION ALL SELECT u, rk, v, 0.0 FROM nb_pads WHERE rk <= {K_NEIGHBOURS})"""

RECOMMEND = f"""
nbk AS (SELECT customer_id, neighbour, count(*) OVER (PARTITION BY customer_id) AS k FROM nb),
scores AS (SELECT nbk.customer_id, r.product_id, sum(r.rating) / max(nbk.k) AS score
           FROM nbk JOIN ratings r ON r.customer_id = nbk.neighbour
           GROUP BY nbk.customer_id, r.product_id HAVING sum(r.rating) / max(nbk.k) > 0),
rc_ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id
                                           ORDER BY round(score, 9) DESC, product_id ASC) AS rk FROM scores),
rc_found AS (SELECT * FROM rc_ranked WHERE rk <= {N_PRODUCTS}),
rc_users AS (SELECT DISTINCT customer_id FROM nb),
rc_top AS (SELECT DISTINCT product_id FROM ratings ORDER BY product_id LIMIT {N_PRODUCTS}),
rc_m AS (SELECT rc_users.customer_id, count(rc_found.product_id) AS m FROM rc_users
         LEFT JOIN rc_found ON rc_found.customer_id = rc_users.customer_id GROUP BY rc_users.customer_id),
rc_pads AS (SELECT rc_m.customer_id, t.product_id,
                   rc_m.m + row_number() OVER (PARTITION BY rc_m.customer_id ORDER BY t.product_id) AS rk
            FROM rc_m, rc_top t WHERE NOT EXISTS (
              SELECT 1 FROM rc_found f WHERE f.customer_id = rc_m.customer_id AND f.product_id = t.product_id)),
recs AS (SELECT customer_id, rk, product_id, round(score, 9) AS score FROM rc_found
         UNION ALL SELECT customer_id, rk, product_id, 0.0 FROM rc_pads WHERE rk <= {N_PRODUCTS})"""


def _stopwords_sql() -> str:
    return "[" + ", ".join(_q(w) for w in STOPWORDS_PT) + "]"


def _clean_sql(text: str) -> tuple[str, str]:
    toks = (f"list_filter(string_split_regex(trim(lower(regexp_replace({text}, {_q(LETTERS_PATTERN)}, ' ', 'g'))), ' +'), "
            f"lambda x: x <> '' AND NOT list_contains({_stopwords_sql()}, x))")
    clean = f"CASE WHEN {text} IS NULL THEN NULL ELSE array_to_string({toks}, ' ') END"
    return toks, clean


def _lexicon_values() -> str:
    return ", ".join(f"({_q(w)}, CAST({v!r} AS DOUBLE))" for w, v in TEST_LEXICON.items())


def _polarity_ctes(source: str, text: str) -> str:
    """CTEs docs(doc_id, txt, clean) and pol(doc_id, txt, polarity)."""
    toks, clean = _clean_sql(text)
    overrides = ", ".join(_q(w) for w in OVERRIDE_WORDS)
    return f"""
docs AS (SELECT doc_id, {text} AS txt, {toks} AS toks, {clean} AS clean FROM {source}),
lex(word, weight) AS (VALUES {_lexicon_values()}),
hits AS (SELECT d.doc_id, sum(lex.weight) / count(*) AS p FROM (SELECT doc_id, unnest(toks) AS w FROM docs) d
         JOIN lex ON lex.word = d.w GROUP BY d.doc_id),
pol AS (SELECT docs.doc_id, docs.txt,
               CASE WHEN clean IS NULL OR clean = '' THEN NULL
                    WHEN clean IN ({overrides}) THEN CAST({OVERRIDE_POLARITY!r} AS DOUBLE)
                    ELSE coalesce(hits.p, 0.0) END AS polarity
        FROM docs LEFT JOIN hits ON hits.doc_id = docs.doc_id)"""


def _learned_ctes() -> str:
    """CTEs reviews(doc_id, text, score, fold, toks, clean) and learned(fold,
    word, positive, negative, weight); fold -1 is learned from all."""
    toks, clean = _clean_sql("d.text")
    return f"""
reviews AS (SELECT d.doc_id, d.text, 1 + 4 * l.quality AS score, d.doc_id % {FOLDS} AS fold, {toks} AS toks, {clean} AS clean
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
judged AS (SELECT f.f AS fold, r.toks, CASE WHEN r.score >= 4 THEN 1 ELSE 0 END AS p
           FROM reviews r, range(-1, {FOLDS}) AS f(f) WHERE (r.score >= 4 OR r.score <= 2) AND r.fold <> f.f),
counted AS (SELECT fold, word, CAST(sum(p) AS BIGINT) AS positive, CAST(sum(1 - p) AS BIGINT) AS negative
            FROM (SELECT fold, p, unnest(list_distinct(toks)) AS word FROM judged) GROUP BY fold, word),
totals AS (SELECT fold, CAST(sum(positive) AS DOUBLE) AS np, CAST(sum(negative) AS DOUBLE) AS nn FROM counted GROUP BY fold),
odds AS (SELECT counted.*, positive + negative AS n,
                ln((positive + 1.0::DOUBLE) / (np + 2)) - ln((negative + 1.0::DOUBLE) / (nn + 2)) AS x
         FROM counted JOIN totals USING (fold)),
learned AS (SELECT fold, word, positive, negative,
                   round((exp(x * n / (n + 10.0::DOUBLE)) - 1) / (exp(x * n / (n + 10.0::DOUBLE)) + 1) * 64) / 64 + 0.0 AS weight
            FROM odds WHERE n >= {LEXICON_LEAST})"""


SENTIMENT_CLASS = ("CASE WHEN txt = '' THEN 'Error' WHEN polarity IS NULL THEN 'neutral' "
                   "WHEN polarity >= 0.3 AND polarity <= 1 THEN 'positive' "
                   "WHEN polarity >= 0 AND polarity < 0.3 THEN 'neutral' "
                   "WHEN polarity < 0 THEN 'negative' ELSE '0' END")


PART_ITEMS = "SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL"
TYPE_ITEMS = "SELECT DISTINCT l_orderkey AS o, p_type AS i FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL"


def _rules_sql(pairs_only: bool, items: str = PART_ITEMS, support: float = MIN_SUPPORT,
               confidence: float = MIN_CONFIDENCE, lift: float = MIN_LIFT, splits: bool = False) -> str:
    """``splits``: every split of an itemset in two sides, not only those with
    one item on the right."""
    s = repr(support)
    base = f"""
WITH r AS ({items}),
n AS (SELECT CAST(count(DISTINCT o) AS DOUBLE) AS n FROM r),
f AS (SELECT i, count(*) AS ci FROM r GROUP BY i HAVING count(*) / (SELECT n FROM n) >= {s}),
k AS (SELECT r.* FROM r JOIN f USING (i)),
pc AS (SELECT a.i AS a, b.i AS b, count(*) AS cab FROM k a JOIN k b ON a.o = b.o AND a.i < b.i
       GROUP BY a.i, b.i HAVING count(*) / (SELECT n FROM n) >= {s}),
pair_rules AS (
  SELECT x AS antecedent, y AS consequent, cab / n.n AS support, cab / fx.ci AS confidence,
         (cab / fx.ci) / (fy.ci / n.n) AS lift
  FROM (SELECT a AS x, b AS y, cab FROM pc UNION ALL SELECT b AS x, a AS y, cab FROM pc) d
  JOIN f fx ON fx.i = d.x JOIN f fy ON fy.i = d.y, n)"""
    if pairs_only:
        return base + f"""
SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift
FROM pair_rules WHERE confidence >= {confidence!r} AND lift >= {lift!r}"""
    # itemsets of any size: every ascending item list of each basket's
    # frequent items (recursive), counted, then every single-item consequent
    split = """
rules AS (
  SELECT list_filter(fs.items, lambda x, i: (m.m >> (i - 1)) & 1 = 0) AS ante,
         list_filter(fs.items, lambda x, i: (m.m >> (i - 1)) & 1 = 1) AS cons, fs.c AS c
  FROM fs, range(1, (1 << len(fs.items)) - 1) AS m(m) WHERE len(fs.items) >= 2)""" if splits else """
rules AS (
  SELECT list_filter(fs.items, lambda x: x <> y.y) AS ante, [y.y] AS cons, fs.c AS c
  FROM fs, unnest(fs.items) AS y(y) WHERE len(fs.items) >= 2)"""
    return f"""
WITH RECURSIVE r AS ({items}),
n AS (SELECT CAST(count(DISTINCT o) AS DOUBLE) AS n FROM r),
f AS (SELECT i FROM r GROUP BY i HAVING count(*) / (SELECT n FROM n) >= {s}),
k AS (SELECT r.* FROM r JOIN f USING (i)),
occ(o, items, last) AS (
  SELECT o, [i], i FROM k
  UNION ALL
  SELECT occ.o, list_append(occ.items, k.i), k.i FROM occ JOIN k ON k.o = occ.o AND k.i > occ.last),
fs AS (SELECT items, count(*) AS c FROM occ GROUP BY items HAVING count(*) / (SELECT n FROM n) >= {s}),{split}
SELECT array_to_string(rules.ante, ' ') AS antecedent, array_to_string(rules.cons, ' ') AS consequent,
       round(rules.c / n.n, 6) AS support, round(rules.c / a.c, 6) AS confidence,
       round((rules.c / a.c) / (b.c / n.n), 6) AS lift
FROM rules JOIN fs a ON a.items = rules.ante JOIN fs b ON b.items = rules.cons, n
WHERE rules.c / a.c >= {confidence!r} AND (rules.c / a.c) / (b.c / n.n) >= {lift!r}"""


def oracle_sql() -> dict[str, str]:
    period = 'make_date(y, m, 1) AS "first", last_day(make_date(y, m, 1)) AS "last"'
    sql: dict = {}
    sql["on_time_by_month"] = lambda: f"""
WITH rws AS (
  SELECT o.o_orderstatus AS order_status, o.o_orderdate + to_hours(3 * l.l_linenumber) AS purchase,
         CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderdate END AS approved,
         o.o_orderdate AS carrier, l.l_shipdate AS delivered,
         o.o_orderdate + INTERVAL 60 DAY AS estimated
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
f AS (
  SELECT year(approved) AS y, month(delivered) AS m,
         CASE WHEN {_days('purchase', 'delivered')} < {_days('approved', 'estimated')} THEN 1 ELSE 0 END AS at_time
  FROM rws WHERE order_status IS NOT NULL AND purchase IS NOT NULL AND approved IS NOT NULL
    AND carrier IS NOT NULL AND delivered IS NOT NULL AND estimated IS NOT NULL)
SELECT CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month,
       round_even(avg(at_time) * 100.0, 2) AS at_time, round_even(avg(1 - at_time) * 100.0, 2) AS no_at_time,
       {period}
FROM f GROUP BY y, m"""
    sql["elapsed_days"] = lambda: f"""
SELECT l.l_orderkey, l.l_linenumber,
       {_days('o.o_orderdate + to_hours(3 * l.l_linenumber)', 'l.l_shipdate')} AS elapsed_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
    sql["orders_payment"] = lambda: """
SELECT o.o_custkey AS customer_id, o.o_orderdate AS order_date, o.o_orderkey AS order_id,
       l.l_extendedprice AS order_value, strftime(o.o_orderdate, '%b-%Y') AS month_yr
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""
    sql["qualified_leads"] = lambda: f"WITH {DEALS.strip()}\nSELECT * FROM ql"
    sql["seller_cltv"] = lambda: f"""
WITH {SALES.strip()}
SELECT s.s_suppkey AS seller_id, s.s_nationkey AS seller_zip_code_prefix, s.s_name AS seller_city,
       n.n_name AS seller_state, round(sales.seller_sales, 2) AS cltv
FROM sales JOIN supplier s ON s.s_suppkey = sales.seller_id JOIN nation n ON s.s_nationkey = n.n_nationkey"""
    sql["lead_cltv"] = lambda: f"""
WITH {DEALS.strip()}, {SALES.strip()}
SELECT ql.*, round(CASE WHEN origin = {_q(PAID_ORIGIN)} THEN seller_sales - {PAID_PRICE!r}
                        ELSE seller_sales END, 2) AS cltv
FROM ql JOIN sales USING (seller_id)"""
    sql["closed_deals"] = lambda: f"WITH {DEALS.strip()}\nSELECT * FROM deals"
    sql["leads_by_month_origin"] = lambda: f"""
WITH l AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderpriority AS origin FROM orders)
SELECT CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month, origin, count(origin) AS "count", {period}
FROM l WHERE y IS NOT NULL AND m IS NOT NULL AND origin IS NOT NULL GROUP BY y, m, origin"""
    sql["leads_by_origin"] = lambda: """
SELECT event_type AS origin, count(*) AS "count" FROM events WHERE event_type IS NOT NULL
GROUP BY event_type"""
    sql["geolocation"] = lambda: """
SELECT c_custkey, c_acctbal AS geolocation_lat, CAST(c_nationkey AS DOUBLE) AS geolocation_lng,
       CAST(c_acctbal AS VARCHAR) || ',' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) AS location
FROM customer"""
    sql["order_reviews"] = lambda: f"WITH {M1.strip()}\nSELECT * FROM m1"
    sql["order_products_payments"] = lambda: f"WITH {M2.strip()}\nSELECT * FROM m2"
    sql["arrival_by_city"] = lambda: f"""
WITH {M1.strip()},
g AS (SELECT customer_city, round(avg(arrival_days), 6) AS arrival_days,
             round(avg(review_score), 6) AS review_score
      FROM m1 WHERE customer_city IS NOT NULL GROUP BY customer_city)
SELECT * FROM g WHERE arrival_days IS NOT NULL AND review_score IS NOT NULL"""
    sql["arrival_by_state"] = lambda: f"""
WITH {M1.strip()}
SELECT name, round(avg(arrival_days), 6) AS arrival_days, round(avg(review_score), 6) AS review_score
FROM m1 WHERE name IS NOT NULL GROUP BY name"""
    sql["order_rows_by_month"] = lambda: f"""
WITH {M1.strip()}, {M2.strip()},
j AS (SELECT m1.order_id, year(m1.order_approved_at) AS y, month(m1.order_approved_at) AS m, m2.product_id
      FROM m1 JOIN m2 ON m1.order_id = m2.order_id WHERE m1.order_approved_at IS NOT NULL)
SELECT order_id, CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month, count(product_id) AS product_id,
       {period}
FROM j GROUP BY order_id, y, m"""
    sql["order_status_code"] = lambda: f"""
SELECT o_orderkey AS order_id, {STATUS} AS order_status,
       {STATUS_CODE.format(c=STATUS)} AS numeric_order_status FROM orders"""
    sql["principal_category"] = lambda: f"""
SELECT p_partkey, p_type, {GROUP.format(c='p_type')} AS product_principal_category FROM part"""
    sql["baskets"] = lambda: """
SELECT l_orderkey AS order_id, array_to_string(list_sort(list_distinct(list(l_partkey))), ' ') AS items,
       CAST(len(list_distinct(list(l_partkey))) AS INTEGER) AS n_items
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY l_orderkey"""
    sql["pair_rules"] = lambda: _rules_sql(pairs_only=True)
    sql["association_rules"] = lambda: _rules_sql(pairs_only=False)
    sql["user_product_ratings"] = lambda: f"""
WITH {RATINGS.strip()}
SELECT customer_id, product_id, round(rating, 6) AS rating FROM ratings"""
    sql["similar_users"] = lambda: f"""
WITH {RATINGS.strip()}, {NEIGHBOURS.strip()}
SELECT customer_id, CAST(rk AS INTEGER) AS rank, neighbour, round(similarity, 6) AS similarity FROM nb"""
    sql["recommend"] = lambda: f"""
WITH {RATINGS.strip()}, {NEIGHBOURS.strip()}, {RECOMMEND.strip()}
SELECT customer_id, CAST(rk AS INTEGER) AS rank, product_id, round(score, 6) AS score FROM recs"""
    sql["recommend_or_default"] = lambda: f"""
WITH {RATINGS.strip()}, {NEIGHBOURS.strip()}, {RECOMMEND.strip()},
requests AS (SELECT DISTINCT c_custkey AS customer_id FROM customer),
complete AS (SELECT customer_id FROM recs GROUP BY customer_id HAVING count(*) >= {N_PRODUCTS}),
popular AS (SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id ASC) AS rk
            FROM ratings GROUP BY product_id QUALIFY rk <= {N_PRODUCTS})
SELECT r.customer_id, CAST(r.rk AS INTEGER) AS rank, r.product_id, false AS is_default FROM recs r
WHERE r.customer_id IN (SELECT customer_id FROM requests) AND r.customer_id IN (SELECT customer_id FROM complete)
UNION ALL
SELECT q.customer_id, CAST(p.rk AS INTEGER), p.product_id, true FROM requests q, popular p
WHERE q.customer_id NOT IN (SELECT customer_id FROM complete)"""
    sql["clean_text"] = lambda: f"SELECT doc_id, {_clean_sql('text')[1]} AS clean_text FROM documents"
    sql["lexicon_polarity"] = lambda: f"""
WITH {_polarity_ctes('documents', 'text').strip()}
SELECT doc_id, polarity FROM pol"""
    sql["sentiment"] = lambda: f"""
WITH {_polarity_ctes('documents', 'text').strip()}
SELECT doc_id, {SENTIMENT_CLASS} AS sentiment FROM pol"""
    sql["review_score_class"] = lambda: """
SELECT l_orderkey, l_linenumber, l_quantity / 10.0 AS review_score,
       CASE WHEN l_quantity / 10.0 >= 4 THEN 'positive' WHEN l_quantity / 10.0 >= 3 THEN 'neutral'
            WHEN l_quantity / 10.0 <= 2 THEN 'negative' END AS score_class
FROM lineitem"""
    sql["review_sentiment"] = lambda: f"""
WITH src AS (SELECT d.doc_id, concat_ws(' ', d.source, d.text) AS body, 1 + 4 * l.quality AS score
             FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
{_polarity_ctes('src', 'body').strip()}
SELECT src.doc_id,
       CASE WHEN d.source IS NULL AND d.text IS NULL THEN
              CASE WHEN score >= 4 THEN 'positive' WHEN score >= 3 THEN 'neutral'
                   WHEN score <= 2 THEN 'negative' END
            ELSE {SENTIMENT_CLASS} END AS sentiment
FROM src JOIN pol ON pol.doc_id = src.doc_id JOIN documents d ON d.doc_id = src.doc_id"""
    sql["label_sentiment"] = lambda: """
SELECT doc_id, CASE WHEN 1 + 4 * quality >= 4 THEN 'positive' WHEN 1 + 4 * quality >= 3 THEN 'neutral'
                    WHEN 1 + 4 * quality <= 2 THEN 'negative' END AS sentiment
FROM labels"""
    sql["type_rules"] = lambda: _rules_sql(False, TYPE_ITEMS, TYPE_SUPPORT, TYPE_CONFIDENCE, TYPE_LIFT)
    sql["csv_documents"] = lambda: "SELECT doc_id, lang, source, n_chars, text FROM documents"
    sql["csv_orders_payment"] = lambda: """
SELECT CAST(o.o_custkey AS VARCHAR) AS customer_id, o.o_orderdate AS order_date, CAST(o.o_orderkey AS VARCHAR) AS order_id,
       l.l_extendedprice AS order_value, strftime(o.o_orderdate, '%b-%Y') AS month_yr
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""
    sql["csv_marts"] = lambda: f"""
WITH {M1.strip()},
f AS (
  SELECT year(order_approved_at) AS y, month(order_delivered_customer_date) AS m,
         CASE WHEN {_days('order_purchase_timestamp', 'order_delivered_customer_date')}
                   < {_days('order_approved_at', 'order_estimated_delivery_date')} THEN 1 ELSE 0 END AS at_time
  FROM m1 WHERE order_status IS NOT NULL AND order_purchase_timestamp IS NOT NULL AND order_approved_at IS NOT NULL
    AND order_delivered_carrier_date IS NOT NULL AND order_delivered_customer_date IS NOT NULL
    AND order_estimated_delivery_date IS NOT NULL)
SELECT CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month,
       round_even(avg(at_time) * 100.0, 2) AS at_time, round_even(avg(1 - at_time) * 100.0, 2) AS no_at_time, {period}
FROM f GROUP BY y, m"""
    sql["ratings_store"] = sql["merged_ratings"] = sql["user_product_ratings"]
    sql["recommend_from_buckets"] = sql["recommend"]
    sql["refreshed_neighbours"] = sql["similar_users"]
    sql["lattice_rules"] = lambda: _rules_sql(False, TYPE_ITEMS, TYPE_SUPPORT, TYPE_CONFIDENCE, TYPE_LIFT, splits=True)
    sql["learned_lexicon"] = lambda: f"""
WITH {_learned_ctes().strip()}
SELECT word, positive, negative, weight FROM learned WHERE fold = -1"""
    sql["held_out_sentiment"] = lambda: f"""
WITH {_learned_ctes().strip()},
hits AS (SELECT r.doc_id, sum(l.weight) / count(*) AS p FROM (SELECT doc_id, fold, unnest(toks) AS w FROM reviews) r
         JOIN learned l ON l.word = r.w AND l.fold = r.fold GROUP BY r.doc_id),
pol AS (SELECT r.doc_id, r.text AS txt, r.score,
               CASE WHEN clean IS NULL OR clean = '' THEN NULL
                    WHEN clean IN ({", ".join(_q(w) for w in OVERRIDE_WORDS)}) THEN CAST({OVERRIDE_POLARITY!r} AS DOUBLE)
                    ELSE coalesce(hits.p, 0.0) END AS polarity
        FROM reviews r LEFT JOIN hits ON hits.doc_id = r.doc_id)
SELECT doc_id, CASE WHEN txt IS NULL THEN CASE WHEN score >= 4 THEN 'positive' WHEN score >= 3 THEN 'neutral'
                                               WHEN score <= 2 THEN 'negative' END
                    ELSE {SENTIMENT_CLASS} END AS sentiment
FROM pol"""
    sql["similar_users_by_index"] = sql["similar_users_in_blocks"] = sql["similar_users_hot_products"] = sql["similar_users"]
    sql["recommender_rows"] = lambda: f"""
WITH {M1.strip()}, {M2.strip()}
SELECT i.product_id, p.p_type AS product_category_name, i.price, r.review_score, o.customer_id, i.order_id
FROM items_v i FULL JOIN part p ON p.p_partkey = i.product_id
FULL JOIN reviews_v r ON r.order_id = i.order_id FULL JOIN orders_v o ON o.order_id = i.order_id
WHERE i.product_id IS NOT NULL AND p.p_type IS NOT NULL AND i.price IS NOT NULL AND r.review_score IS NOT NULL
  AND o.customer_id IS NOT NULL AND i.order_id IS NOT NULL"""
    out = {}
    for name, build in sql.items():
        try:
            out[name] = build()
        except Exception as e:  # one entry that can't be built must not hide the others
            warnings.warn(f"no SQL for {name}: {e}", stacklevel=2)
    return out
