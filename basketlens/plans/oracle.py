"""DuckDB oracle SQL for every registered query.

Each oracle is the literal, reference-style formulation (window functions
over all rows, cross joins, per-month snapshots) written directly over the
raw test tables; the Spark queries use the rewritten, scalable plans.  The
adapter of ``sources/testdata.py`` is restated here as CTEs.
"""

from __future__ import annotations

from basketlens.functions.lexicon import DEMO_BOOSTERS, DEMO_LEXICON, DEMO_NEGATORS, DEMO_THEMES
from basketlens.operators.themes import COMPLAINT_THEMES


# ---- exact arithmetic on 128-bit integers: quotient, then up if the remainder is half or more ----

def units(n: str, d: str, u: int) -> str:
    a, b = f"(abs(CAST({n} AS HUGEINT)) * {u})", f"abs(CAST({d} AS HUGEINT))"
    return (f"(CASE WHEN ({d}) <> 0 THEN (CASE WHEN (({n}) < 0) <> (({d}) < 0) THEN -1 ELSE 1 END) * "
            f"({a} // {b} + CASE WHEN 2 * ({a} % {b}) >= {b} THEN 1 ELSE 0 END) END)")


def ratio(n: str, d: str, factor: int = 1, digits: int = 2) -> str:
    return f"(CAST({units(n, d, factor * 10 ** digits)} AS DOUBLE) / {10 ** digits})"


def pct(n: str, d: str, digits: int = 2) -> str:
    return ratio(n, d, 100, digits)


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def money_pct(a: str, b: str) -> str:
    return pct(cents(a), cents(b))


def money_mean(s: str, c: str, digits: int) -> str:
    return ratio(cents(s), f"({c}) * 100", 1, digits)


def mean_dec(s: str, c: str) -> str:
    return (f"CAST(CAST({units(cents(s), f'({c}) * 100', 10 ** 6)} AS DECIMAL(20,0)) "
            f"* CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(20,6))")


def elapsed(e: str, s: str) -> str:
    return f"CAST(floor((epoch_us({e}) - epoch_us({s})) / 86400000000.0) AS BIGINT)"


def qcut(r: str, n: str) -> str:
    return f"CAST(greatest(1, (5 * ({r} - 1) + {n} - 2) // greatest({n} - 1, 1)) AS INTEGER)"


TIER = """CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'VIP'
     WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal'
     WHEN recency_score <= 2 AND monetary_score >= 3 THEN 'At Risk'
     WHEN recency_score <= 2 THEN 'Lost' ELSE 'Developing' END"""

HALF_CENTS = "CAST(floor({x} * 100 + 0.5) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(2,2))"
PRICE = HALF_CENTS.format(x="l_extendedprice")
TAX = HALF_CENTS.format(x="l_tax")
AS_OF_P = "(SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY FROM oc WHERE order_status = 'delivered')"
AS_OF_S = "(SELECT max(CAST(order_purchase_timestamp AS DATE)) FROM oc)"


def _values(rows, cols: str) -> str:
    vals = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {vals}) v({cols}))"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _arr(words) -> str:
    return "[" + ", ".join(_lit(w) for w in words) + "]"


def _theme_rows(themes):
    return [(t, w) for t, ws in themes.items() for w in ws]


BASE = rf"""
c_raw AS (
  SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id, c.c_nationkey AS customer_zip_code_prefix,
         o.o_orderpriority AS customer_city, n.n_name AS customer_state
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
c_std AS (
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
         regexp_replace(strip_accents(lower(regexp_replace(customer_city, '^[\s\x0B\x85\pZ]+|[\s\x0B\x85\pZ]+$', '', 'g'))), '[^\x00-\x7F]', '', 'g') AS customer_city,
         upper(customer_state) AS customer_state
  FROM c_raw),
persons AS (
  SELECT c.c_custkey AS customer_unique_id, c.c_mktsegment AS customer_city, n.n_name AS customer_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
o_raw AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' END AS order_status,
         o_orderdate AS order_purchase_timestamp
  FROM orders),
i_raw AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date,
         CAST({PRICE} AS DECIMAL(12,2)) AS price,
         CAST(round(({PRICE}) * ({TAX}), 2) AS DECIMAL(12,2)) AS freight_value
  FROM lineitem),
p_raw AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name, CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CAST(length(p_brand) AS INTEGER) AS product_description_lenght, p_size AS product_photos_qty
  FROM part),
tr AS {_values([('STANDARD', 'standard_goods'), ('ECONOMY', 'economy_goods'), ('MEDIUM', 'medium_goods'),
                ('PROMO', 'promo_goods')], 'product_category_name, product_category_name_english')},
p_clean AS (
  SELECT p.product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name,
         p.product_name_lenght AS product_name_length, p.product_description_lenght AS product_description_length,
         p.product_photos_qty,
         coalesce(t.product_category_name_english, coalesce(p.product_category_name, 'unknown')) AS product_category_english
  FROM p_raw p LEFT JOIN tr t ON p.product_category_name = t.product_category_name),
r_raw AS (
  SELECT d.doc_id AS review_id, d.doc_id AS order_id,
         CAST(CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN 5 WHEN l.quality = 0 THEN 2 END AS TINYINT) AS review_score,
         d.text AS review_comment_message
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
fin AS (
  SELECT order_id, CAST(sum(price) AS DECIMAL(28,2)) AS order_revenue, CAST(sum(freight_value) AS DECIMAL(28,2)) AS order_freight,
         count(order_item_id) AS order_items
  FROM i_raw GROUP BY order_id),
oc AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, c.customer_unique_id,
         CAST(coalesce(f.order_revenue, 0) AS DECIMAL(28,2)) AS order_revenue,
         CAST(coalesce(f.order_freight, 0) AS DECIMAL(28,2)) AS order_freight,
         CAST(coalesce(f.order_items, 0) AS INTEGER) AS order_items,
         CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS order_month
  FROM o_raw o LEFT JOIN c_std c ON o.customer_id = c.customer_id LEFT JOIN fin f ON o.order_id = f.order_id),
dlv AS (SELECT * FROM oc WHERE order_status = 'delivered' AND customer_unique_id IS NOT NULL),
cc AS (
  SELECT l.customer_unique_id, l.customer_city, l.customer_state, d.first_seen_date, d.last_seen_date, d.total_orders
  FROM (SELECT customer_unique_id, arg_min(customer_city, customer_id) AS customer_city,
               arg_min(customer_state, customer_id) AS customer_state
        FROM c_std WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id) l
  LEFT JOIN (SELECT customer_unique_id, min(order_purchase_timestamp) AS first_seen_date,
                    max(order_purchase_timestamp) AS last_seen_date, count(DISTINCT order_id) AS total_orders
             FROM dlv GROUP BY customer_unique_id) d ON l.customer_unique_id = d.customer_unique_id),
metrics AS (
  SELECT customer_unique_id, last_purchase_date, first_purchase_date, frequency, monetary,
         {mean_dec('monetary', '_cnt')} AS avg_order_value,
         {elapsed(AS_OF_P, 'last_purchase_date')} AS recency_days,
         greatest({elapsed('last_purchase_date', 'first_purchase_date')}, 1) AS customer_lifespan_days
  FROM (SELECT customer_unique_id, max(order_purchase_timestamp) AS last_purchase_date,
               min(order_purchase_timestamp) AS first_purchase_date, count(DISTINCT order_id) AS frequency,
               CAST(sum(order_revenue) AS DECIMAL(28,2)) AS monetary, count(order_revenue) AS _cnt
        FROM dlv GROUP BY customer_unique_id)),
qc AS (
  SELECT *, {qcut('r_r', 'n')} AS recency_score, {qcut('r_f', 'n')} AS frequency_score, {qcut('r_m', 'n')} AS monetary_score
  FROM (SELECT *, row_number() OVER (ORDER BY recency_days DESC, customer_unique_id) AS r_r,
               row_number() OVER (ORDER BY frequency, customer_unique_id) AS r_f,
               row_number() OVER (ORDER BY monetary, customer_unique_id) AS r_m,
               count(*) OVER () AS n
        FROM metrics)),
rfm AS (
  SELECT q.customer_unique_id, last_purchase_date, first_purchase_date, frequency, monetary, avg_order_value,
         recency_days, customer_lifespan_days, recency_score, frequency_score, monetary_score,
         recency_score + frequency_score + monetary_score AS rfm_score, {TIER} AS value_tier,
         cc.customer_city, cc.customer_state
  FROM qc q LEFT JOIN cc ON q.customer_unique_id = cc.customer_unique_id),
cv AS (
  SELECT customer_unique_id, first_purchase_date, last_purchase_date, order_count, historical_clv, avg_order_value,
         days_since_last_purchase, days_since_last_purchase > 180 AS is_churned, customer_lifespan_days,
         CAST(CASE WHEN days_since_last_purchase > 180 THEN avg_order_value ELSE 0 END AS DECIMAL(20,6)) AS estimated_revenue_at_risk
  FROM (SELECT customer_unique_id, min(order_purchase_timestamp) AS first_purchase_date,
               max(order_purchase_timestamp) AS last_purchase_date, count(DISTINCT order_id) AS order_count,
               CAST(sum(order_revenue) AS DECIMAL(28,2)) AS historical_clv,
               {mean_dec('CAST(sum(order_revenue) AS DECIMAL(28,2))', 'count(order_revenue)')} AS avg_order_value,
               {elapsed(AS_OF_P, 'max(order_purchase_timestamp)')} AS days_since_last_purchase,
               greatest({elapsed('max(order_purchase_timestamp)', 'min(order_purchase_timestamp)')}, 1) AS customer_lifespan_days
        FROM dlv GROUP BY customer_unique_id)),
churn AS (
  SELECT cv.*, cc.customer_city, cc.customer_state, rfm.value_tier
  FROM cv LEFT JOIN cc ON cv.customer_unique_id = cc.customer_unique_id
  LEFT JOIN rfm ON cv.customer_unique_id = rfm.customer_unique_id),
msql AS (
  SELECT c.customer_unique_id, c.customer_state, max(CAST(o.order_purchase_timestamp AS DATE)) AS last_purchase_date,
         count(DISTINCT o.order_id) AS frequency, CAST(sum(o.order_revenue) AS DECIMAL(28,2)) AS monetary,
         CAST(date_diff('day', max(CAST(o.order_purchase_timestamp AS DATE)), {AS_OF_S}) AS BIGINT) AS recency_days
  FROM persons c LEFT JOIN oc o ON c.customer_unique_id = o.customer_unique_id
  WHERE o.order_status = 'delivered'
  GROUP BY c.customer_unique_id, c.customer_state),
segs AS (
  SELECT *, CASE WHEN recency_days <= 90 AND frequency >= 2 AND monetary >= 500 THEN 'VIP'
                 WHEN recency_days <= 180 AND frequency >= 2 THEN 'Loyal'
                 WHEN recency_days BETWEEN 181 AND 365 THEN 'At Risk' ELSE 'Lost' END AS customer_segment,
            CASE WHEN recency_days > 180 THEN 1 ELSE 0 END AS churned_flag
  FROM msql),
cohort_long AS (
  SELECT cohort_month, months_since_first_purchase, active_customers, revenue,
         first_value(active_customers) OVER w AS cohort_size, first_value(revenue) OVER w AS month_0_revenue,
         {pct('active_customers', 'first_value(active_customers) OVER w')} AS retention_pct,
         {money_pct('revenue', 'first_value(revenue) OVER w')} AS revenue_retention_pct
  FROM (SELECT cohort_month, months_since_first_purchase, count(DISTINCT customer_unique_id) AS active_customers,
               CAST(sum(order_revenue) AS DECIMAL(28,2)) AS revenue
        FROM (SELECT d.*, min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month,
                     CAST(date_diff('month', min(order_month) OVER (PARTITION BY customer_unique_id), order_month) AS INTEGER)
                       AS months_since_first_purchase
              FROM dlv d)
        GROUP BY cohort_month, months_since_first_purchase)
  WINDOW w AS (PARTITION BY cohort_month ORDER BY months_since_first_purchase)),
rwc AS (SELECT r.review_id, r.order_id, r.review_score, r.review_comment_message, o.customer_id, o.customer_unique_id
        FROM r_raw r JOIN oc o ON r.order_id = o.order_id),
lex AS (SELECT token, CAST(valence AS DECIMAL(10,4)) AS valence FROM {_values(DEMO_LEXICON, 'token, valence')}),
rnorm AS (
  SELECT *, lower(regexp_replace(coalesce(CAST(review_comment_message AS VARCHAR), ''), '^\s+|\s+$', '', 'g')) AS t
  FROM rwc),
rtok AS (
  SELECT review_id, toks, generate_subscripts(toks, 1) AS i, unnest(toks) AS tok
  FROM (SELECT review_id, list_filter(regexp_split_to_array(t, '[^\p{{L}}\p{{N}}_]+'), lambda x: length(x) > 0) AS toks FROM rnorm)),
rhit AS (
  SELECT k.review_id, l.valence,
         (list_contains({_arr(DEMO_NEGATORS)}, (CASE WHEN k.i > 1 THEN k.toks[k.i - 1] END)) IS TRUE OR list_contains({_arr(DEMO_NEGATORS)}, (CASE WHEN k.i > 2 THEN k.toks[k.i - 2] END)) IS TRUE
          OR list_contains({_arr(DEMO_NEGATORS)}, (CASE WHEN k.i > 3 THEN k.toks[k.i - 3] END)) IS TRUE) AS negated,
         CAST(0.293 * ((CASE WHEN list_contains({_arr(DEMO_BOOSTERS)}, (CASE WHEN k.i > 1 THEN k.toks[k.i - 1] END)) IS TRUE THEN 1.0 ELSE 0.0 END)
                     + (CASE WHEN list_contains({_arr(DEMO_BOOSTERS)}, (CASE WHEN k.i > 2 THEN k.toks[k.i - 2] END)) IS TRUE THEN 0.95 ELSE 0.0 END)
                     + (CASE WHEN list_contains({_arr(DEMO_BOOSTERS)}, (CASE WHEN k.i > 3 THEN k.toks[k.i - 3] END)) IS TRUE THEN 0.9 ELSE 0.0 END))
              AS DECIMAL(10,6)) AS boost
  FROM rtok k JOIN lex l ON k.tok = l.token),
rsum AS (
  SELECT review_id, sum(CASE WHEN negated THEN (valence + sign(valence) * boost) * CAST(-0.74 AS DECIMAL(3,2))
                            ELSE valence + sign(valence) * boost END) AS s
  FROM rhit GROUP BY review_id),
scored AS (
  SELECT r.*, coalesce(CASE WHEN round(CAST(s.s AS DOUBLE) / sqrt(CAST(s.s AS DOUBLE) * CAST(s.s AS DOUBLE) + 15), 4) = 0 THEN 0.0 ELSE round(CAST(s.s AS DOUBLE) / sqrt(CAST(s.s AS DOUBLE) * CAST(s.s AS DOUBLE) + 15), 4) END, 0.0) AS polarity
  FROM rnorm r LEFT JOIN rsum s ON r.review_id = s.review_id),
labeled AS (
  SELECT *, length(t) > 0 AS has_comment,
         CASE WHEN length(t) > 0 AND review_score >= 4 AND polarity < 0 THEN 'Mixed Negative'
              WHEN polarity >= 0.05 OR (NOT length(t) > 0 AND review_score >= 4) THEN 'Positive'
              WHEN polarity <= -0.05 OR review_score <= 2 THEN 'Negative'
              WHEN review_score >= 4 THEN 'Positive' ELSE 'Negative' END AS sentiment_label
  FROM scored),
csent AS (
  SELECT customer_unique_id, customer_id, review_count, avg_review_score, avg_vader_compound,
         mixed_negative_reviews, negative_reviews, positive_reviews,
         CASE WHEN mixed_negative_reviews > 0 THEN 'Mixed Negative' WHEN negative_reviews >= positive_reviews THEN 'Negative'
              ELSE 'Positive' END AS sentiment_label
  FROM (SELECT customer_unique_id, min(customer_id) AS customer_id, count(review_id) AS review_count,
               {ratio('sum(review_score)', 'count(review_score)', 1, 2)} AS avg_review_score,
               {ratio('sum(CAST(polarity * 10000 AS DECIMAL(20,0)))', 'count(polarity)', 1, 0)} / 10000 AS avg_vader_compound,
               count_if(sentiment_label = 'Mixed Negative') AS mixed_negative_reviews,
               count_if(sentiment_label = 'Negative') AS negative_reviews,
               count_if(sentiment_label = 'Positive') AS positive_reviews
        FROM labeled WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)),
csr AS (
  SELECT s.*, r.value_tier, r.recency_days, r.frequency, r.monetary, r.customer_state
  FROM csent s LEFT JOIN rfm r ON s.customer_unique_id = r.customer_unique_id)
"""


def q(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body


def _themes_sql(themes) -> str:
    kw = _values(_theme_rows(themes), "complaint_theme, keyword")
    names = ", ".join(f"({_lit(t)})" for t in themes)
    return q(rf""", neg AS (
  SELECT l.*, coalesce(r.value_tier, 'Unknown') AS tier
  FROM labeled l LEFT JOIN rfm r ON l.customer_unique_id = r.customer_unique_id
  WHERE l.sentiment_label IN ('Negative', 'Mixed Negative')),
cnt AS (SELECT tier, count(*) AS negative_review_count FROM neg GROUP BY tier),
toks AS (SELECT tier, unnest(regexp_split_to_array(t, '[^\p{{L}}\p{{N}}_]+')) AS w FROM neg),
men AS (SELECT tier, complaint_theme, count(*) AS mention_count FROM toks JOIN {kw} k ON toks.w = k.keyword
        GROUP BY tier, complaint_theme)
SELECT c.tier AS value_tier, th.complaint_theme, CAST(coalesce(m.mention_count, 0) AS BIGINT) AS mention_count,
       c.negative_review_count
FROM cnt c CROSS JOIN (SELECT * FROM (VALUES {names}) v(complaint_theme)) th
LEFT JOIN men m ON m.tier = c.tier AND m.complaint_theme = th.complaint_theme""")


def _churn_by(key: str) -> str:
    return q(f"""
SELECT {key}, count(DISTINCT customer_unique_id) AS customers, count_if(is_churned) AS churned_customers,
       CAST(sum(historical_clv) AS DECIMAL(28,2)) AS historical_revenue,
       CAST(sum(estimated_revenue_at_risk) AS DECIMAL(28,6)) AS revenue_at_risk,
       {pct('count_if(is_churned)', 'count(DISTINCT customer_unique_id)')} AS churn_rate_pct
FROM churn WHERE {key} IS NOT NULL GROUP BY {key}""")


def _matrix(value: str) -> str:
    cells = ", ".join(f'coalesce(max(CASE WHEN months_since_first_purchase = {k} THEN {value} END), 0) AS "{k}"'
                      for k in range(96))
    return q(f"SELECT cohort_month, {cells} FROM cohort_long GROUP BY cohort_month")


def _churn_trend(src: str, churn_days: int) -> str:
    """Literal per-month-end snapshot: month ends x persons with a condition join."""
    return q(f"""{_trend_tables(src, churn_days)}
SELECT CAST(date_trunc('month', me) AS DATE) AS month, known_customers, churned_customers,
       coalesce({pct('churned_customers', 'known_customers')}, 0.0) AS churn_rate_pct
FROM snap""")


def _trend_tables(src: str, churn_days: int) -> str:
    return f""", src AS ({src}),
v AS (SELECT customer_unique_id, min(order_purchase_timestamp) AS f, max(order_purchase_timestamp) AS l
      FROM src GROUP BY customer_unique_id),
b AS (SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi FROM src),
me AS (SELECT CAST(last_day(m) AS TIMESTAMP) + (b.lo - CAST(CAST(b.lo AS DATE) AS TIMESTAMP)) AS me
       FROM b, (SELECT unnest(generate_series(CAST(date_trunc('month', lo) AS DATE), CAST(date_trunc('month', hi) AS DATE),
                                           INTERVAL 1 MONTH)) AS m FROM b)
       WHERE CAST(last_day(m) AS TIMESTAMP) + (b.lo - CAST(CAST(b.lo AS DATE) AS TIMESTAMP)) BETWEEN b.lo AND b.hi),
snap AS (SELECT me.me, count(v.customer_unique_id) AS known_customers,
                count_if({elapsed('me.me', 'v.l')} > {churn_days}) AS churned_customers
         FROM me LEFT JOIN v ON v.f <= me.me GROUP BY me.me)"""


EVENTS_SRC = """SELECT event_id AS order_id, user_id AS customer_unique_id,
       ts + to_days(CAST((event_id % 6) * 30 AS INTEGER)) AS order_purchase_timestamp,
       CAST(CAST(floor(value * 100 + 0.5) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(28,2)) AS order_revenue
FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL"""


ORACLE_SQL: dict[str, str] = {
    # ---- I ----
    "read_raw": """
SELECT CAST(d.doc_id AS VARCHAR) AS review_id, CAST(d.doc_id AS VARCHAR) AS order_id,
       CAST(CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN 5 WHEN l.quality = 0 THEN 2 END AS TINYINT) AS review_score,
       CAST(NULL AS VARCHAR) AS review_comment_title, nullif(d.text, '') AS review_comment_message,
       CAST(NULL AS TIMESTAMP) AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "write_table": q("SELECT * FROM oc"),
    "standardize_customers": q("SELECT * FROM c_std"),
    "reviews_with_customer": q("SELECT * FROM rwc"),
    "products_clean": q("SELECT * FROM p_clean"),
    "split_raw": q("""
, k AS (SELECT *, CASE WHEN order_item_id = 7 THEN 'cut short' WHEN price > 50000 THEN 'spelled out' ELSE 'good' END AS kind FROM i_raw)
SELECT kind, count(*) AS row_count, CAST(sum(CASE WHEN kind = 'good' THEN price END) AS DECIMAL(28,2)) AS price FROM k GROUP BY kind"""),
    "row_counts": q("""
, o_sql AS (SELECT o.order_id FROM o_raw o JOIN c_std c ON o.customer_id = c.customer_id),
p_sql AS (SELECT product_id FROM p_raw)
SELECT 'customers' AS table_name, count(DISTINCT customer_unique_id) AS row_count FROM c_std
UNION ALL SELECT 'products', count(*) FROM p_sql
UNION ALL SELECT 'orders', count(*) FROM o_sql
UNION ALL SELECT 'order_items', count(*) FROM i_raw i
   WHERE i.order_id IN (SELECT order_id FROM o_sql) AND i.product_id IN (SELECT product_id FROM p_clean)
UNION ALL SELECT 'order_reviews', count(DISTINCT review_id) FROM r_raw WHERE order_id IN (SELECT order_id FROM o_sql)"""),
    "key_audit": q("""
SELECT 'customers' AS table_name, 'duplicate customer_id' AS "check",
       (SELECT count(*) FROM (SELECT customer_id FROM c_raw GROUP BY customer_id HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'orders', 'duplicate order_id', (SELECT count(*) FROM (SELECT order_id FROM o_raw GROUP BY order_id HAVING count(*) > 1))
UNION ALL SELECT 'order_items', 'duplicate order_id,order_item_id',
       (SELECT count(*) FROM (SELECT order_id, order_item_id FROM i_raw GROUP BY order_id, order_item_id HAVING count(*) > 1))
UNION ALL SELECT 'products', 'duplicate product_id', (SELECT count(*) FROM (SELECT product_id FROM p_raw GROUP BY product_id HAVING count(*) > 1))
UNION ALL SELECT 'order_reviews', 'duplicate review_id', (SELECT count(*) FROM (SELECT review_id FROM r_raw GROUP BY review_id HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'orphan customer_id', (SELECT count(*) FROM o_raw WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM c_raw WHERE customer_id IS NOT NULL))
UNION ALL SELECT 'order_items', 'orphan order_id', (SELECT count(*) FROM i_raw WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM o_raw WHERE order_id IS NOT NULL))
UNION ALL SELECT 'order_items', 'orphan product_id', (SELECT count(*) FROM i_raw WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM p_raw WHERE product_id IS NOT NULL))
UNION ALL SELECT 'order_reviews', 'orphan order_id', (SELECT count(*) FROM r_raw WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM o_raw WHERE order_id IS NOT NULL))"""),
    "order_financials": q("SELECT * FROM fin"),
    "orders_clean": q("SELECT * FROM oc"),
    "orders_clean_inner": q("SELECT * FROM oc WHERE customer_id IN (SELECT customer_id FROM c_std)"),
    "customers_clean": q("SELECT * FROM cc"),
    "customers_dim": q("""
SELECT c.customer_unique_id, min(c.customer_city) AS customer_city, min(c.customer_state) AS customer_state,
       CAST(min(o.order_purchase_timestamp) AS DATE) AS first_seen_date, CAST(max(o.order_purchase_timestamp) AS DATE) AS last_seen_date,
       count(DISTINCT o.order_id) AS total_orders
FROM c_std c LEFT JOIN o_raw o ON c.customer_id = o.customer_id GROUP BY c.customer_unique_id"""),
    "sales_fact": q("""
SELECT d.order_id, d.customer_id, d.order_purchase_timestamp, c.customer_unique_id, c.customer_city, c.customer_state,
       i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value, p.product_category_english,
       CAST(i.price + i.freight_value AS DECIMAL(28,2)) AS line_revenue,
       CAST(date_trunc('month', d.order_purchase_timestamp) AS DATE) AS order_month
FROM o_raw d LEFT JOIN c_std c ON d.customer_id = c.customer_id JOIN i_raw i ON d.order_id = i.order_id
LEFT JOIN p_clean p ON i.product_id = p.product_id
WHERE d.order_status = 'delivered'"""),
    "items_valid": q("""
SELECT * FROM i_raw WHERE order_id IN (SELECT order_id FROM o_raw) AND product_id IN (SELECT product_id FROM p_raw)"""),
    "reviews_dedup": q("""
, rr AS (SELECT conv_id AS review_id, conv_id + turn AS order_id, CAST((turn % 5) + 1 AS TINYINT) AS review_score,
                text AS review_comment_message FROM conversations)
SELECT r.review_id, min(r.order_id) AS order_id, max(r.review_score) AS review_score,
       max(nullif(r.review_comment_message, '')) AS review_comment_message
FROM rr r JOIN o_raw o ON r.order_id = o.order_id GROUP BY r.review_id"""),
    "customer_order_summary": q(f"""
SELECT c.customer_unique_id, c.customer_city, c.customer_state, count(DISTINCT o.order_id) AS total_orders,
       min(o.order_purchase_timestamp) AS first_purchase_date, max(o.order_purchase_timestamp) AS last_purchase_date,
       CAST(sum(o.order_revenue) AS DECIMAL(28,2)) AS total_revenue,
       {money_mean('CAST(sum(o.order_revenue) AS DECIMAL(28,2))', 'count(o.order_revenue)', 6)} AS avg_order_value
FROM persons c LEFT JOIN oc o ON c.customer_unique_id = o.customer_unique_id
GROUP BY c.customer_unique_id, c.customer_city, c.customer_state"""),
    # ---- R ----
    "customer_metrics": q("SELECT * FROM metrics"),
    "quintile_qcut": q("SELECT customer_unique_id, recency_score, frequency_score, monetary_score FROM qc"),
    "quintile_ntile": q("""
SELECT customer_unique_id,
       CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id) AS INTEGER) AS recency_score,
       CAST(ntile(5) OVER (ORDER BY frequency, customer_unique_id) AS INTEGER) AS frequency_score,
       CAST(ntile(5) OVER (ORDER BY monetary, customer_unique_id) AS INTEGER) AS monetary_score
FROM msql"""),
    "score_and_tier": q("SELECT customer_unique_id, rfm_score, value_tier FROM rfm"),
    "rfm_segmentation": q("SELECT * FROM rfm"),
    "rfm_segmentation_ntile": q(f"""
SELECT customer_unique_id, customer_state, recency_days, frequency, monetary, recency_score, frequency_score, monetary_score,
       recency_score + frequency_score + monetary_score AS rfm_score, {TIER} AS value_tier
FROM (SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id) AS INTEGER) AS recency_score,
             CAST(ntile(5) OVER (ORDER BY frequency, customer_unique_id) AS INTEGER) AS frequency_score,
             CAST(ntile(5) OVER (ORDER BY monetary, customer_unique_id) AS INTEGER) AS monetary_score
      FROM msql)"""),
    "segment_summary": q(f"""
SELECT value_tier, count(DISTINCT customer_unique_id) AS customers, CAST(sum(monetary) AS DECIMAL(28,2)) AS revenue,
       {money_mean('CAST(sum(monetary) AS DECIMAL(28,2))', 'count(monetary)', 6)} AS avg_clv,
       {ratio('sum(recency_days)', 'count(recency_days)', 1, 6)} AS avg_recency_days
FROM rfm WHERE value_tier IS NOT NULL GROUP BY value_tier"""),
    "fixed_threshold_segments": q("SELECT * FROM segs"),
    # ---- C ----
    "cohort_assign": q("""
SELECT order_id, customer_unique_id, order_purchase_timestamp, order_revenue, order_month,
       min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month,
       CAST(date_diff('month', min(order_month) OVER (PARTITION BY customer_unique_id), order_month) AS INTEGER) AS months_since_first_purchase
FROM dlv"""),
    "retention_trend": q(f"""
SELECT s.cohort_month, s.cohort_size, CAST(coalesce(a.active_customers, 0) AS BIGINT) AS active_customers,
       1 AS months_since_first_purchase, {pct('coalesce(a.active_customers, 0)', 's.cohort_size')} AS retention_pct
FROM (SELECT cohort_month, cohort_size FROM cohort_long WHERE months_since_first_purchase = 0) s
LEFT JOIN (SELECT cohort_month, active_customers FROM cohort_long WHERE months_since_first_purchase = 1) a
  ON s.cohort_month = a.cohort_month"""),
    "cohort_retention_long": q("SELECT * FROM cohort_long"),
    "cohort_retention_sql": q(f"""
, oc7 AS (SELECT customer_unique_id, order_id, order_month FROM oc WHERE order_status = 'delivered'),
cohorts AS (SELECT customer_unique_id, min(order_month) AS cohort_month FROM oc7 GROUP BY customer_unique_id),
ca AS (SELECT c.cohort_month, o.order_month, CAST(date_diff('month', c.cohort_month, o.order_month) AS INTEGER) AS months_since_first_purchase,
              count(DISTINCT o.customer_unique_id) AS active_customers
       FROM oc7 o JOIN cohorts c ON o.customer_unique_id = c.customer_unique_id
       GROUP BY c.cohort_month, o.order_month, months_since_first_purchase),
cs AS (SELECT cohort_month, active_customers AS cohort_size FROM ca WHERE months_since_first_purchase = 0)
SELECT ca.cohort_month, ca.months_since_first_purchase, cs.cohort_size, ca.active_customers,
       {pct('ca.active_customers', 'cs.cohort_size')} AS retention_pct
FROM ca JOIN cs ON ca.cohort_month = cs.cohort_month"""),
    "cohort_revenue_retention_sql": q(f"""
, oc8 AS (SELECT customer_unique_id, order_id, order_month, order_revenue FROM oc WHERE order_status = 'delivered'),
cohorts AS (SELECT customer_unique_id, min(order_month) AS cohort_month FROM oc8 GROUP BY customer_unique_id),
cr AS (SELECT c.cohort_month, o.order_month, CAST(date_diff('month', c.cohort_month, o.order_month) AS INTEGER) AS months_since_first_purchase,
              CAST(sum(o.order_revenue) AS DECIMAL(28,2)) AS revenue
       FROM oc8 o JOIN cohorts c ON o.customer_unique_id = c.customer_unique_id
       GROUP BY c.cohort_month, o.order_month, months_since_first_purchase),
br AS (SELECT cohort_month, revenue AS month_0_revenue FROM cr WHERE months_since_first_purchase = 0)
SELECT cr.cohort_month, cr.months_since_first_purchase, cr.revenue, br.month_0_revenue,
       {money_pct('cr.revenue', 'br.month_0_revenue')} AS revenue_retention_pct
FROM cr JOIN br ON cr.cohort_month = br.cohort_month"""),
    "cohort_retention_matrix": _matrix("retention_pct"),
    "cohort_revenue_matrix": _matrix("revenue_retention_pct"),
    # ---- H ----
    "customer_churn_clv": q("SELECT * FROM churn"),
    "churn_by_segment": _churn_by("value_tier"),
    "churn_by_region": _churn_by("customer_state"),
    "churn_trend": _churn_trend("SELECT * FROM dlv", 180),
    "churn_trend_events": _churn_trend(EVENTS_SRC, 20),
    "churn_trend_asof": q(f"""
, cm AS (SELECT customer_unique_id, order_month, max(CAST(order_purchase_timestamp AS DATE)) AS last_in_month
         FROM oc WHERE order_status = 'delivered' GROUP BY customer_unique_id, order_month),
spine AS (SELECT DISTINCT order_month AS month_start FROM oc WHERE order_status = 'delivered'),
cms AS (SELECT m.month_start, c.customer_unique_id, max(cm.last_in_month) AS last_before
        FROM spine m CROSS JOIN persons c
        LEFT JOIN cm ON c.customer_unique_id = cm.customer_unique_id AND cm.order_month <= m.month_start
        GROUP BY m.month_start, c.customer_unique_id)
SELECT month_start, count(*) AS known_customers,
       count_if(date_diff('day', last_before, last_day(month_start)) > 180) AS churned_customers,
       {pct("count_if(date_diff('day', last_before, last_day(month_start)) > 180)", 'count(*)')} AS churn_rate_pct
FROM cms WHERE last_before IS NOT NULL GROUP BY month_start"""),
    "executive_kpis": q(f"""
SELECT count(DISTINCT customer_unique_id) AS total_customers, count_if(NOT is_churned) AS active_customers,
       count_if(is_churned) AS churned_customers, {pct('count_if(is_churned)', 'count(is_churned)')} AS churn_rate_pct,
       CAST(round(coalesce((SELECT CAST(sum(order_revenue) AS DECIMAL(28,2)) FROM oc WHERE order_status = 'delivered'), 0), 2) AS DECIMAL(28,2)) AS revenue,
       {ratio(cents('sum(historical_clv)'), 'count(historical_clv) * 100', 1, 2)} AS average_historical_clv,
       {ratio('sum(customer_lifespan_days)', 'count(customer_lifespan_days)', 1, 2)} AS average_customer_lifespan_days,
       CAST(round(coalesce(sum(estimated_revenue_at_risk), 0), 2) AS DECIMAL(28,2)) AS revenue_at_risk,
       180 AS churn_definition_days
FROM churn"""),
    "churn_by_rule_segment": q(f"""
SELECT customer_segment, count(*) AS customers, CAST(sum(churned_flag) AS BIGINT) AS churned_customers,
       CAST(sum(CASE WHEN churned_flag = 1 THEN monetary ELSE 0 END) AS DECIMAL(28,2)) AS historical_revenue_from_churned,
       {pct('sum(churned_flag)', 'count(*)')} AS churn_rate_pct
FROM segs GROUP BY customer_segment"""),
    "revenue_impact_of_churn": q(f"""
, v AS (SELECT customer_unique_id, max(CAST(order_purchase_timestamp AS DATE)) AS last_purchase_date,
               CAST(sum(order_revenue) AS DECIMAL(28,2)) AS historical_clv,
               {mean_dec('CAST(sum(order_revenue) AS DECIMAL(28,2))', 'count(order_revenue)')} AS avg_order_value
        FROM dlv GROUP BY customer_unique_id)
SELECT CASE WHEN date_diff('day', last_purchase_date, {AS_OF_S}) > 180 THEN 'Churned' ELSE 'Active' END AS lifecycle_status,
       count(*) AS customers, CAST(sum(historical_clv) AS DECIMAL(28,2)) AS historical_revenue,
       CAST(sum(avg_order_value) AS DECIMAL(28,6)) AS estimated_revenue_at_risk,
       {ratio(cents('CAST(sum(historical_clv) AS DECIMAL(28,2))'), 'count(historical_clv) * 100', 1, 6)} AS avg_historical_clv
FROM v GROUP BY lifecycle_status"""),
    # ---- V ----
    "top_customers": q(f"""
, cr AS (SELECT c.customer_unique_id, c.customer_state, c.customer_city, count(DISTINCT o.order_id) AS orders_count,
                CAST(sum(o.order_revenue) AS DECIMAL(28,2)) AS total_revenue,
                {money_mean('CAST(sum(o.order_revenue) AS DECIMAL(28,2))', 'count(o.order_revenue)', 6)} AS avg_order_value
         FROM persons c JOIN oc o ON c.customer_unique_id = o.customer_unique_id
         WHERE o.order_status = 'delivered'
         GROUP BY c.customer_unique_id, c.customer_state, c.customer_city)
SELECT customer_unique_id, customer_state, customer_city, orders_count, total_revenue, avg_order_value,
       rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
       dense_rank() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS state_revenue_rank
FROM cr ORDER BY revenue_rank, customer_unique_id LIMIT 100"""),
    "return_windows": q(f"""
, co AS (SELECT customer_unique_id, order_id, order_purchase_timestamp,
                lag(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp) AS prev_ts
         FROM oc WHERE order_status = 'delivered' AND customer_unique_id IS NOT NULL),
rw AS (SELECT customer_unique_id, date_diff('day', CAST(prev_ts AS DATE), CAST(order_purchase_timestamp AS DATE)) AS gap
       FROM co WHERE prev_ts IS NOT NULL)
SELECT count(DISTINCT customer_unique_id) AS returning_customers,
       {pct('count(DISTINCT CASE WHEN gap <= 30 THEN customer_unique_id END)', 'count(DISTINCT customer_unique_id)')} AS returned_within_30_days_pct,
       {pct('count(DISTINCT CASE WHEN gap <= 60 THEN customer_unique_id END)', 'count(DISTINCT customer_unique_id)')} AS returned_within_60_days_pct,
       {pct('count(DISTINCT CASE WHEN gap <= 90 THEN customer_unique_id END)', 'count(DISTINCT customer_unique_id)')} AS returned_within_90_days_pct
FROM rw"""),
    "region_repeat_rate": None,            # filled below
    "region_repeat_rate_all_states": None,
    "monthly_revenue": q(f"""
, mr AS (SELECT order_month AS revenue_month, count(DISTINCT order_id) AS orders_count,
                count(DISTINCT customer_unique_id) AS active_customers, CAST(sum(order_revenue) AS DECIMAL(28,2)) AS revenue
         FROM oc WHERE order_status = 'delivered' GROUP BY order_month)
SELECT revenue_month, orders_count, active_customers, revenue,
       CAST(sum(revenue) OVER (ORDER BY revenue_month) AS DECIMAL(28,2)) AS running_revenue,
       lag(revenue) OVER (ORDER BY revenue_month) AS prior_month_revenue,
       {pct(cents('revenue') + ' - ' + cents('lag(revenue) OVER (ORDER BY revenue_month)'),
            cents('lag(revenue) OVER (ORDER BY revenue_month)'))} AS mom_revenue_growth_pct
FROM mr"""),
    # ---- T ----
    "lexicon_polarity": None,               # filled below (runs on all reviews, not only joined ones)
    "label_reviews": q("SELECT review_id, customer_unique_id, review_score, polarity, has_comment, sentiment_label FROM labeled"),
    "customer_sentiment": q("SELECT * FROM csent"),
    "customer_sentiment_rfm": q("SELECT * FROM csr"),
    "negative_review_themes": _themes_sql(COMPLAINT_THEMES),
    "negative_review_themes_wordlist": _themes_sql(DEMO_THEMES),
    "sentiment_distribution": q(f"""
, g AS (SELECT value_tier, sentiment_label, count(DISTINCT customer_unique_id) AS customers FROM csr
        WHERE value_tier IS NOT NULL AND sentiment_label IS NOT NULL GROUP BY value_tier, sentiment_label)
SELECT value_tier, sentiment_label, customers, sum(customers) OVER (PARTITION BY value_tier) AS segment_customers,
       {pct('customers', 'sum(customers) OVER (PARTITION BY value_tier)')} AS sentiment_pct
FROM g"""),
    "negative_concentration": q(f"""
, g AS (SELECT value_tier, count(DISTINCT customer_unique_id) AS customers,
               count_if(sentiment_label = 'Negative') AS negative_customers,
               count_if(sentiment_label = 'Mixed Negative') AS mixed_negative_customers,
               count_if(sentiment_label = 'Positive') AS positive_customers
        FROM csr WHERE value_tier IS NOT NULL GROUP BY value_tier)
SELECT *, {pct('negative_customers', 'customers')} AS negative_pct,
       {pct('mixed_negative_customers', 'customers')} AS mixed_negative_pct,
       {pct('negative_customers + mixed_negative_customers', 'customers')} AS dissatisfied_pct
FROM g"""),
}


def _repeat_rate(min_customers: int) -> str:
    return q(f"""
, ca AS (SELECT c.customer_state, c.customer_unique_id, count(DISTINCT o.order_id) AS order_count
         FROM persons c LEFT JOIN oc o ON c.customer_unique_id = o.customer_unique_id AND o.order_status = 'delivered'
         GROUP BY c.customer_state, c.customer_unique_id)
SELECT customer_state, count(*) AS customers, count_if(order_count >= 2) AS repeat_customers,
       {pct('count_if(order_count >= 2)', 'count(*)')} AS repeat_customer_rate_pct
FROM ca GROUP BY customer_state HAVING count(*) >= {min_customers}""")


ORACLE_SQL["region_repeat_rate"] = _repeat_rate(50)
ORACLE_SQL["region_repeat_rate_all_states"] = _repeat_rate(1)
ORACLE_SQL["lexicon_polarity"] = q(
    "SELECT s.review_id, s.polarity FROM scored s").replace("FROM r_raw r JOIN oc o ON r.order_id = o.order_id",
                                                           "FROM r_raw r LEFT JOIN oc o ON r.order_id = o.order_id")


ORACLE_SQL.update({
    "kpi_cards": ORACLE_SQL["executive_kpis"],
    "revenue_by_month": q("""
, mr AS (SELECT order_month AS revenue_month, CAST(sum(order_revenue) AS DECIMAL(28,2)) AS revenue
         FROM oc WHERE order_status = 'delivered' GROUP BY order_month)
SELECT revenue_month, revenue, CAST(sum(revenue) OVER (ORDER BY revenue_month) AS DECIMAL(28,2)) AS running_revenue FROM mr"""),
    "revenue_by_state": q("""
, sf AS (SELECT d.order_id, c.customer_state, CAST(i.price + i.freight_value AS DECIMAL(28,2)) AS line_revenue
         FROM o_raw d LEFT JOIN c_std c ON d.customer_id = c.customer_id JOIN i_raw i ON d.order_id = i.order_id
         WHERE d.order_status = 'delivered')
SELECT customer_state, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS revenue, count(DISTINCT order_id) AS orders_count,
       count(*) AS item_rows
FROM sf GROUP BY customer_state"""),
    "tier_profile": q(f"""
SELECT value_tier, count(DISTINCT customer_unique_id) AS customers, CAST(sum(monetary) AS DECIMAL(28,2)) AS revenue,
       {money_mean('CAST(sum(monetary) AS DECIMAL(28,2))', 'count(monetary)', 6)} AS avg_clv,
       {ratio('sum(recency_days)', 'count(recency_days)', 1, 6)} AS avg_recency_days,
       {pct('count(DISTINCT customer_unique_id)', '(SELECT count(DISTINCT customer_unique_id) FROM rfm WHERE value_tier IS NOT NULL)')} AS customer_share_pct
FROM rfm WHERE value_tier IS NOT NULL GROUP BY value_tier"""),
    "cohort_heatmaps": q("SELECT cohort_month, months_since_first_purchase, retention_pct, revenue_retention_pct FROM cohort_long"),
    "returning_customers_by_month": q(f"""
, pm AS (SELECT DISTINCT customer_unique_id, order_month FROM dlv),
f AS (SELECT customer_unique_id, min(order_month) AS first_month FROM dlv GROUP BY customer_unique_id)
SELECT pm.order_month, count(*) AS active_customers, count_if(f.first_month = pm.order_month) AS new_customers,
       count_if(f.first_month < pm.order_month) AS returning_customers,
       {pct('count_if(f.first_month < pm.order_month)', 'count(*)')} AS returning_pct
FROM pm JOIN f ON pm.customer_unique_id = f.customer_unique_id GROUP BY pm.order_month"""),
    "churn_dashboard": q(f"""{_trend_tables("SELECT * FROM dlv", 180)}
SELECT 'value_tier' AS dimension, value_tier AS dimension_value, count(DISTINCT customer_unique_id) AS customers,
       count_if(is_churned) AS churned_customers,
       {pct('count_if(is_churned)', 'count(DISTINCT customer_unique_id)')} AS churn_rate_pct,
       CAST(sum(estimated_revenue_at_risk) AS DECIMAL(28,6)) AS revenue_at_risk
FROM churn WHERE value_tier IS NOT NULL GROUP BY value_tier
UNION ALL
SELECT 'customer_state', customer_state, count(DISTINCT customer_unique_id), count_if(is_churned),
       {pct('count_if(is_churned)', 'count(DISTINCT customer_unique_id)')},
       CAST(sum(estimated_revenue_at_risk) AS DECIMAL(28,6))
FROM churn WHERE customer_state IS NOT NULL GROUP BY customer_state
UNION ALL
SELECT 'month', CAST(CAST(date_trunc('month', me) AS DATE) AS VARCHAR), known_customers, churned_customers,
       coalesce({pct('churned_customers', 'known_customers')}, 0.0), NULL
FROM snap"""),
    "rfm_scatter_bins": q(f"""
, e AS (SELECT quantile_disc(frequency, {[k / 16 for k in range(16)]}) AS f, quantile_disc(monetary, {[k / 16 for k in range(16)]}) AS m FROM rfm),
b AS (SELECT (SELECT max(x) FROM (SELECT unnest(e.f) AS x FROM e) WHERE x <= r.frequency) AS frequency_bin,
             (SELECT max(x) FROM (SELECT unnest(e.m) AS x FROM e) WHERE x <= r.monetary) AS monetary_bin, value_tier FROM rfm r)
SELECT frequency_bin, monetary_bin, value_tier, count(*) AS customers FROM b GROUP BY ALL"""),
    "vip_customers": q("""
SELECT customer_unique_id, customer_state, customer_city, frequency, monetary, recency_days FROM rfm WHERE value_tier = 'VIP'"""),
    "churned_revenue_by_state": q("""
SELECT customer_state, count(*) AS churned_customers, CAST(sum(historical_clv) AS DECIMAL(28,2)) AS churned_historical_revenue
FROM churn WHERE is_churned AND customer_state IS NOT NULL GROUP BY customer_state"""),
    "active_retention_by_state": q(f"""
SELECT customer_state, count(DISTINCT customer_unique_id) AS customers, count_if(is_churned) AS churned_customers,
       {pct('count_if(is_churned)', 'count(DISTINCT customer_unique_id)')} AS churn_rate_pct,
       {pct('count(DISTINCT customer_unique_id) - count_if(is_churned)', 'count(DISTINCT customer_unique_id)')} AS active_rate_pct
FROM churn WHERE customer_state IS NOT NULL GROUP BY customer_state HAVING count(DISTINCT customer_unique_id) >= 50"""),
    "return_rate_all_customers": q(f"""
, co AS (SELECT customer_unique_id, order_purchase_timestamp,
                lag(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp) AS prev_ts
         FROM dlv),
g AS (SELECT customer_unique_id,
             min(date_diff('day', CAST(prev_ts AS DATE), CAST(order_purchase_timestamp AS DATE))) AS min_gap
      FROM co GROUP BY customer_unique_id)
SELECT count(*) AS delivered_customers, count_if(min_gap <= 90) AS returned_within_90_days,
       {pct('count_if(min_gap <= 90)', 'count(*)')} AS returned_within_90_days_pct
FROM g"""),
    "action_list": q("""
SELECT customer_unique_id, value_tier,
       CASE value_tier WHEN 'VIP' THEN 'VIP protection' WHEN 'Loyal' THEN 'Loyal upsell'
            WHEN 'At Risk' THEN 'At Risk reactivation' WHEN 'Lost' THEN 'Lost win-back' END AS action,
       monetary, monetary_score, recency_days, customer_state,
       (monetary_score >= 4 AND recency_days > 180) AS win_back_target
FROM rfm WHERE value_tier IN ('VIP', 'Loyal', 'At Risk', 'Lost')"""),
    "sales_by_category_month": q("""
, sf AS (SELECT d.order_id, i.price, CAST(i.price + i.freight_value AS DECIMAL(28,2)) AS line_revenue,
                p.product_category_english, CAST(date_trunc('month', d.order_purchase_timestamp) AS DATE) AS order_month
         FROM o_raw d JOIN i_raw i ON d.order_id = i.order_id LEFT JOIN p_clean p ON i.product_id = p.product_id
         WHERE d.order_status = 'delivered')
SELECT product_category_english, order_month, CAST(sum(price) AS DECIMAL(28,2)) AS item_revenue,
       CAST(sum(line_revenue) AS DECIMAL(28,2)) AS line_revenue, count(*) AS items_sold, count(DISTINCT order_id) AS orders_count
FROM sf GROUP BY product_category_english, order_month"""),
    "sales_by_category_month_totals": q("""
, sf AS (SELECT d.order_id, i.price, CAST(i.price + i.freight_value AS DECIMAL(28,2)) AS line_revenue,
                p.product_category_english, CAST(date_trunc('month', d.order_purchase_timestamp) AS DATE) AS order_month
         FROM o_raw d JOIN i_raw i ON d.order_id = i.order_id LEFT JOIN p_clean p ON i.product_id = p.product_id
         WHERE d.order_status = 'delivered')
SELECT product_category_english, order_month, CAST(grouping_id(product_category_english, order_month) AS INTEGER) AS level, CAST(sum(price) AS DECIMAL(28,2)) AS item_revenue,
       CAST(sum(line_revenue) AS DECIMAL(28,2)) AS line_revenue, count(*) AS items_sold, count(DISTINCT order_id) AS orders_count
FROM sf GROUP BY ROLLUP (product_category_english, order_month)"""),
})


def _bigint_count_if(sql: str) -> str:
    """Wrap every count_if(...) in CAST(... AS BIGINT): DuckDB returns HUGEINT, Spark BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


ORACLE_SQL = {k: _bigint_count_if(v) for k, v in ORACLE_SQL.items()}
ORACLE_SQL["sentiment_distribution"] = ORACLE_SQL["sentiment_distribution"].replace(
    "sum(customers) OVER (PARTITION BY value_tier) AS segment_customers",
    "CAST(sum(customers) OVER (PARTITION BY value_tier) AS BIGINT) AS segment_customers")
ORACLE_SQL["top_customers"] = (ORACLE_SQL["top_customers"]
                               .replace("rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank",
                                        "CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank")
                               .replace("dense_rank() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS state_revenue_rank",
                                        "CAST(dense_rank() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS INTEGER) AS state_revenue_rank"))

ORACLE_SQL["write_extract"] = ORACLE_SQL["monthly_revenue"]   # the CSV round trip of the months
ORACLE_SQL["customer_metrics_stored"] = ORACLE_SQL["customer_metrics"]
ORACLE_SQL["return_windows_stored"] = ORACLE_SQL["return_windows"]
ORACLE_SQL["row_counts_written"] = ORACLE_SQL["row_counts"]
