"""The same queries as plain SQL over the test tables, for the correctness check."""

from __future__ import annotations

import re

# Named subqueries; a query pulls in those it mentions.
PARTS: dict[str, str] = {}

PARTS["sales"] = """
SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_suppkey AS sales_id, o_custkey AS customer_id,
       p_brand AS egroup, CASE WHEN l_linestatus = 'F' THEN 'Shipment' ELSE 'Backlog' END AS tran_type,
       o_orderdate AS order_date, l_shipdate AS efftive_date, l_quantity AS qty,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS eur,
       n_name AS cust_country, c_mktsegment AS sector
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""

PARTS["clean"] = """
SELECT customer_id, order_no, line_no, egroup, order_date, efftive_date, abs(qty) AS qty, abs(eur) AS eur,
       cust_country, sector
FROM sales WHERE tran_type = 'Shipment' AND order_date > TIMESTAMP '1996-01-01'"""

PARTS["totals"] = """
SELECT customer_id, max(order_date) AS order_date, count(*) AS frequency,
       CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS monetary,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS qty,
       CAST(date_diff('day', max(order_date), TIMESTAMP '2002-01-01') AS INTEGER) AS recency
FROM clean GROUP BY customer_id"""

PARTS["rfm_edges"] = """
SELECT quantile_cont(CAST(recency AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]) AS r,
       quantile_cont(CAST(frequency AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS f,
       quantile_cont(monetary, [0.0, 0.25, 0.5, 0.75, 1.0]) AS m
FROM totals"""

PARTS["scored"] = """
SELECT *, -recency_score + frequency_score + monetary_score AS rfm_score FROM (
  SELECT totals.*,
    CAST(greatest(0, len(list_filter(list_distinct(r), lambda e: e < recency)) - 1) AS INTEGER) AS recency_score,
    CAST(greatest(0, len(list_filter(list_distinct(f), lambda e: e < frequency)) - 1) AS INTEGER) AS frequency_score,
    CAST(greatest(0, len(list_filter(list_distinct(m), lambda e: e < monetary)) - 1) AS INTEGER) AS monetary_score
  FROM totals, rfm_edges)"""

PARTS["order_dates"] = "SELECT DISTINCT customer_id, order_date FROM clean"

PARTS["last_two"] = """
SELECT customer_id, max(order_date) FILTER (WHERE k = 1) AS last, max(order_date) FILTER (WHERE k = 2) AS prev
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC) AS k FROM order_dates)
GROUP BY customer_id"""

PARTS["labels_c"] = """
SELECT customer_id, CASE
  WHEN prev IS NULL AND TIMESTAMP '2002-01-01' - last <= INTERVAL 360 DAY THEN 'retain'
  WHEN prev IS NULL THEN 'churn'
  WHEN date_diff('day', prev, last) > 365 THEN 'churn'
  WHEN date_diff('day', prev, TIMESTAMP '2002-01-01') > 480 THEN 'churn'
  ELSE 'retain' END AS label
FROM last_two"""

PARTS["gaps"] = """
SELECT customer_id, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS gap
FROM clean"""

PARTS["variability"] = """
SELECT customer_id, coalesce(s, (SELECT sum(s * n) / sum(n) FROM deviations WHERE s IS NOT NULL)) AS purchase_variability
FROM deviations"""
PARTS["deviations"] = """
SELECT customer_id, count(*) AS n, stddev_samp(CAST(gap AS DOUBLE)) AS s FROM gaps GROUP BY customer_id"""

PARTS["attributes"] = """
SELECT customer_id, count(DISTINCT egroup) AS purchase_diversity, min({'t': order_date, 'v': egroup}).v AS egroup,
       min({'t': order_date, 'v': cust_country}).v AS cust_country, min({'t': order_date, 'v': sector}).v AS sector
FROM clean GROUP BY customer_id"""

PARTS["profile"] = """
SELECT customer_id, a.cust_country, recency, frequency, monetary, recency_score, frequency_score, monetary_score,
       rfm_score, qty, a.egroup, order_date, a.sector, purchase_variability, a.purchase_diversity, label
FROM scored JOIN attributes a USING (customer_id) JOIN labels_c USING (customer_id) JOIN variability USING (customer_id)"""

PARTS["opportunity"] = """
SELECT o_orderkey AS opportunity_id, o_custkey AS erp_id, o_totalprice AS amount,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 100.0 WHEN '2' THEN 75.0 WHEN '3' THEN 50.0
            WHEN '5' THEN 0.0 END AS probability,
       CASE WHEN o_orderkey % 101 = 0 THEN 'unknown'
            WHEN o_orderkey % 97 = 0 THEN '3024' || substr(strftime(o_orderdate, '%Y-%m-%d'), 5)
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS close_date,
       o_orderdate AS created_date,
       CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(rep AS VARCHAR) END AS sales_code_text
FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS rep FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'P'"""

PARTS["accounts"] = """
SELECT erp_id, coalesce(CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE), 0) AS amount,
       max(TRY_CAST(regexp_replace(close_date, '^3024', '2024') AS DATE)) AS close_date
FROM opportunity WHERE probability IS NULL OR probability <> 0 GROUP BY erp_id"""

PARTS["backlog_history"] = """
SELECT customer_id, sales_id, eur, efftive_date FROM sales
WHERE tran_type = 'Backlog' AND efftive_date < TIMESTAMP '1999-01-01'"""
PARTS["backlog_current"] = """
SELECT customer_id, sales_id, eur, efftive_date FROM sales
WHERE tran_type = 'Backlog' AND efftive_date >= TIMESTAMP '1999-01-01'"""
PARTS["future_backlog"] = """
SELECT sales_id, eur, tran_type, efftive_date + INTERVAL 1 YEAR AS efftive_date FROM sales
WHERE tran_type = 'Backlog' AND year(efftive_date) = 2001"""
PARTS["customer_backlog"] = """
SELECT customer_id, CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS backlog, max(efftive_date) AS backlog_date
FROM (SELECT * FROM backlog_history UNION ALL SELECT * FROM backlog_current) GROUP BY customer_id"""

PARTS["gated"] = """
SELECT totals.*,
       coalesce(CASE WHEN CAST(close_date AS TIMESTAMP) < order_date THEN amount END, 0) AS opportunity_amt,
       coalesce(CASE WHEN backlog_date < order_date THEN backlog END, 0) AS backlog
FROM totals LEFT JOIN accounts ON customer_id = erp_id LEFT JOIN customer_backlog USING (customer_id)"""

PARTS["sector_map"] = """
SELECT replace(s, chr(160), '') AS sector, master_sector, customer_type FROM (VALUES
  ('AUTOMOBILE', 'IIoT', 'KA'), ('BUILDING', 'SIOT', 'CP'), ('FURNITURE', 'CIOT', 'AOL'),
  ('MACHINERY' || chr(160), 'EIoT', 'KA')) t(s, master_sector, customer_type)"""

PARTS["mapped"] = """
SELECT c_custkey AS customer_id, master_sector, customer_type
FROM customer LEFT JOIN sector_map ON c_mktsegment = sector"""

PARTS["features"] = """
SELECT p.* EXCLUDE (sector), master_sector, customer_type, g.opportunity_amt, g.backlog
FROM profile p JOIN (SELECT customer_id, opportunity_amt, backlog FROM gated) g USING (customer_id)
LEFT JOIN sector_map m ON p.sector = m.sector"""

# --- rep path

PARTS["rep_scores_raw"] = """
SELECT sales_id, CAST(year(efftive_date) AS INTEGER) AS year_id, CAST(month(efftive_date) AS INTEGER) AS month,
       count(*) AS lines, CAST(sum(CAST(abs(eur) AS DECIMAL(18,4))) AS DOUBLE) AS total,
       count(*) FILTER (WHERE tran_type = 'Shipment') AS shipments,
       coalesce(CAST(sum(CAST(abs(eur) AS DECIMAL(18,4))) FILTER (WHERE tran_type = 'Shipment') AS DOUBLE), 0) AS eur
FROM sales WHERE year(efftive_date) > 1995 GROUP BY 1, 2, 3"""
PARTS["rep_edges"] = """
SELECT quantile_cont(CAST(lines AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS f,
       quantile_cont(total, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS m
FROM rep_scores_raw"""
PARTS["rep_scores"] = """
SELECT r.*,
    CAST(greatest(0, len(list_filter(list_distinct(f), lambda e: e < lines)) - 1) AS INTEGER) AS frequency,
    CAST(greatest(0, len(list_filter(list_distinct(m), lambda e: e < total)) - 1) AS INTEGER) AS monetary
FROM rep_scores_raw r, rep_edges"""
PARTS["rep_backlog"] = """
SELECT sales_id, CAST(year(efftive_date) AS INTEGER) AS year_id, CAST(month(efftive_date) AS INTEGER) AS month,
       CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS backlog
FROM backlog_history GROUP BY 1, 2, 3"""
PARTS["rep_sales"] = """
SELECT sales_id, year_id, month, eur, monetary, frequency, coalesce(backlog, 0) AS backlog
FROM rep_scores LEFT JOIN rep_backlog USING (sales_id, year_id, month) WHERE shipments > 0"""
PARTS["quota"] = """
SELECT l_suppkey AS sales_id, s_name AS sales_name, CAST(year(l_shipdate) AS INTEGER) AS year_id,
       CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(sum(CAST(l_quantity * p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / 1000.0 AS amount,
       r_name AS master_sector, n_name AS fact_entity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL"""
PARTS["quota_m"] = """
SELECT sales_id, year_id, month, CAST(sum(CAST(amount * 1000 AS DECIMAL(18,4))) AS DOUBLE) AS amount,
       min(master_sector) AS master_sector, min(fact_entity) AS fact_entity, max(sales_name) AS sales_name
FROM quota GROUP BY ALL"""
PARTS["quota_sales"] = """
SELECT q.*, s.eur, s.monetary, s.frequency, s.backlog
FROM quota_m q LEFT JOIN rep_sales s USING (sales_id, year_id, month)"""
PARTS["filled"] = """
SELECT * REPLACE (
  coalesce(eur, avg(eur) OVER (PARTITION BY sales_id)) AS eur,
  coalesce(CAST(monetary AS DOUBLE), avg(monetary) OVER (PARTITION BY sales_id)) AS monetary,
  coalesce(CAST(frequency AS DOUBLE), avg(frequency) OVER (PARTITION BY sales_id)) AS frequency)
FROM quota_sales"""
PARTS["leads"] = """
SELECT CAST(TRY_CAST(sales_code_text AS DOUBLE) AS BIGINT) AS sales_id,
       CAST(year(created_date) AS INTEGER) AS year_id, CAST(month(created_date) AS INTEGER) AS month,
       count(*) AS leads, count(*) FILTER (WHERE probability = 100) * 100.0 / count(*) AS win_rate,
       count(*) FILTER (WHERE probability >= 75) * 100.0 / count(*) AS partial_win_rate,
       CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS opportunity_amount
FROM opportunity WHERE TRY_CAST(sales_code_text AS DOUBLE) IS NOT NULL GROUP BY 1, 2, 3"""
PARTS["growth"] = """
SELECT sales_id, CASE WHEN f > 0 THEN pow(l / f, 1.0 / span) - 1 ELSE 0.0 END AS cagr FROM (
  SELECT sales_id, arg_min(eur, year_id) AS f, arg_max(eur, year_id) AS l, max(year_id) - min(year_id) AS span
  FROM (SELECT sales_id, year_id, CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS eur
        FROM rep_sales GROUP BY 1, 2) GROUP BY 1)
WHERE span > 0"""
PARTS["potential"] = """
SELECT sales_id, cagr, CASE WHEN cagr >= (SELECT quantile_cont(cagr, 0.5) FROM growth) THEN 'High'
  WHEN cagr >= (SELECT quantile_cont(cagr, 0.25) FROM growth) THEN 'Medium' ELSE 'Low' END AS growth_potential
FROM growth"""
PARTS["lagged"] = """
SELECT f.*, p.eur AS lagged_eur, p.amount AS lagged_quota, p.monetary AS lagged_monetary,
       p.frequency AS lagged_frequency
FROM filled f LEFT JOIN filled p ON f.sales_id = p.sales_id AND f.year_id = p.year_id + 1 AND f.month = p.month"""
PARTS["opened"] = """
SELECT *, CASE WHEN month >= 8 AND year_id = (SELECT max(year_id) FROM quota_sales) THEN NULL
               WHEN month < 8 THEN coalesce(eur, 0) ELSE eur END AS known,
       row_number() OVER (PARTITION BY sales_id ORDER BY year_id, month) AS pos
FROM quota_sales"""
PARTS["sides"] = """
SELECT *, last_value(CASE WHEN known IS NOT NULL THEN pos END IGNORE NULLS) OVER l AS at0,
       last_value(known IGNORE NULLS) OVER l AS v0,
       first_value(CASE WHEN known IS NOT NULL THEN pos END IGNORE NULLS) OVER r AS at1,
       first_value(known IGNORE NULLS) OVER r AS v1
FROM opened
WINDOW l AS (PARTITION BY sales_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       r AS (PARTITION BY sales_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
PARTS["interpolated"] = """
SELECT * EXCLUDE (known, pos, at0, v0, at1, v1) REPLACE (
  CASE WHEN known IS NOT NULL THEN known WHEN at1 IS NULL THEN v0 WHEN at0 IS NULL THEN v1
       ELSE v0 + (v1 - v0) * (pos - at0) / (at1 - at0) END AS eur)
FROM sides"""
PARTS["opened_all"] = PARTS["opened"].replace(" AND year_id = (SELECT max(year_id) FROM quota_sales)", "")
PARTS["sides_all"] = PARTS["sides"].replace("FROM opened", "FROM opened_all")
PARTS["interpolated_all"] = PARTS["interpolated"].replace("FROM sides", "FROM sides_all")
PARTS["spreads"] = """
SELECT sales_id, avg(amount) AS historical_mean, stddev_samp(amount) AS spread FROM quota_m GROUP BY 1"""
PARTS["train_raw"] = """
SELECT l.sales_id, l.year_id, l.month, l.amount, l.master_sector, coalesce(l.backlog, 0) AS backlog,
       coalesce(l.monetary, 0) AS monetary, coalesce(l.frequency, 0) AS frequency,
       coalesce(lagged_eur, 0) AS lagged_eur, coalesce(lagged_quota, 0) AS lagged_quota,
       coalesce(lagged_monetary, 0) AS lagged_monetary, coalesce(lagged_frequency, 0) AS lagged_frequency,
       historical_mean, coalesce(spread, 0) AS spread, coalesce(w.win_rate, 0) AS win_rate,
       coalesce(w.partial_win_rate, 0) AS partial_win_rate,
       coalesce(b.partial_win_rate, 0) AS lagged_partial_win_rate,
       coalesce(b.opportunity_amount, 0) AS lagged_opportunity_amount
FROM lagged l JOIN spreads USING (sales_id)
LEFT JOIN leads w ON l.sales_id = w.sales_id AND l.year_id = w.year_id AND l.month = w.month
LEFT JOIN (SELECT quota_m.sales_id, quota_m.year_id, quota_m.month, partial_win_rate, opportunity_amount
           FROM leads JOIN quota_m USING (sales_id, year_id, month)) b
  ON l.sales_id = b.sales_id AND l.year_id = b.year_id + 1 AND l.month = b.month"""


def _minmax(column: str, name: str | None = None, digits: int | None = None) -> str:
    share = f"({column} - min({column}) OVER ()) / nullif(max({column}) OVER () - min({column}) OVER (), 0)"
    return (f"round({share}, {digits})" if digits else share) + f" AS {name or column + '_std'}"


SCALED = [
    "monetary", "spread", "backlog", "historical_mean", "frequency", "lagged_eur", "lagged_quota",
    "lagged_monetary", "lagged_frequency",
]
SECTOR_FLAGS = ", ".join(
    f"CAST(master_sector = '{s}' AS INTEGER) AS {s.lower().replace(' ', '_')}"
    for s in ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
)
PARTS["train"] = f"""
SELECT * EXCLUDE (master_sector), {SECTOR_FLAGS}, {", ".join(_minmax(c) for c in SCALED)} FROM train_raw"""

PARTS["infer_raw"] = """
SELECT i.sales_id, sales_name, CAST(i.year_id + 1 AS INTEGER) AS year_id, i.month, coalesce(eur, 0) AS eur, i.amount,
       coalesce(monetary, 0) AS monetary, coalesce(frequency, 0) AS frequency, historical_mean,
       coalesce(spread, 0) AS spread, coalesce(partial_win_rate, 0) AS partial_win_rate,
       master_sector, fact_entity, coalesce(growth_potential, 'Low') AS growth_potential, coalesce(cagr, 0) AS cagr,
       f.backlog
FROM interpolated_filled i JOIN spreads USING (sales_id)
LEFT JOIN (SELECT sales_id, year_id, month, partial_win_rate FROM leads) w
  ON i.sales_id = w.sales_id AND i.year_id = w.year_id AND i.month = w.month
LEFT JOIN potential p ON i.sales_id = p.sales_id
LEFT JOIN (SELECT sales_id, year(efftive_date) AS y, month(efftive_date) AS m,
                  CAST(sum(CAST(abs(eur) AS DECIMAL(18,4))) AS DOUBLE) AS backlog
           FROM future_backlog WHERE tran_type = 'Backlog' AND year(efftive_date) > 1995 GROUP BY 1, 2, 3) f
  ON i.sales_id = f.sales_id AND i.year_id + 1 = f.y AND i.month = f.m
WHERE i.year_id = (SELECT max(year_id) FROM quota_m)"""
PARTS["interpolated_filled"] = """
SELECT * EXCLUDE (backlog) REPLACE (
  coalesce(CAST(monetary AS DOUBLE), avg(monetary) OVER (PARTITION BY sales_id)) AS monetary,
  coalesce(CAST(frequency AS DOUBLE), avg(frequency) OVER (PARTITION BY sales_id)) AS frequency)
FROM interpolated"""


def _infer(column: str, name: str) -> str:
    return f"coalesce({_minmax(column, 'x')[:-5]}, 0) AS {name}"


PARTS["infer"] = f"""
SELECT * EXCLUDE (monetary, frequency, historical_mean, spread, partial_win_rate, backlog), {SECTOR_FLAGS},
  {_infer("eur", "lagged_eur_std")}, {_infer("amount", "lagged_quota_std")},
  {_infer("monetary", "lagged_monetary_std")}, {_infer("frequency", "lagged_frequency_std")},
  {_infer("spread", "spread_std")}, {_infer("historical_mean", "historical_mean_std")},
  {_infer("backlog", "backlog_std")}
FROM infer_raw"""
PARTS["modelled"] = """
SELECT sales_id, year_id, month, coalesce(eur, 0) AS eur, amount,
       CASE WHEN sales_id % 4 = 0 THEN 'High' WHEN sales_id % 4 = 1 THEN 'Medium' ELSE 'Low' END AS growth_potential,
       CASE WHEN month = 7 THEN 0.0 ELSE amount END * (1 + ((sales_id + month) % 13 - 6) / 20.0) AS with_backlog,
       CASE WHEN month = 7 THEN 0.0 ELSE amount END * (1 + ((sales_id + month) % 7 - 3) / 10.0) AS without_backlog
FROM (SELECT * REPLACE (CASE WHEN month = 5 THEN 0.0 ELSE amount END AS amount,
                        CASE WHEN sales_id % 3 = 0 THEN eur / 1000 ELSE eur END AS eur) FROM quota_sales)"""
PARTS["capped"] = """
SELECT *, CASE WHEN 3 * eur < amount THEN eur * 1.04
   WHEN (amount = 0 AND pred > 0) OR (amount <> 0 AND (pred - amount) / nullif(amount, 0) > 0.12) THEN amount * 1.05
   ELSE pred END AS predicted_quota
FROM (SELECT *, CASE WHEN eur = 0 AND amount = 0 THEN 0.0 ELSE (with_backlog + without_backlog) / 2 END AS pred
      FROM modelled)"""
PARTS["forecasts"] = """
SELECT sales_id, year_id, month, amount AS y_true, amount * (1 + ((sales_id + month) % 13 - 6) / 9.7) AS y_pred
FROM quota_m"""
PARTS["year_stats"] = """
SELECT year_id, avg((y_true - y_pred) * (y_true - y_pred)) AS mse, count(*) AS n, avg(x) AS xm,
       var_pop(x) * count(*) AS ss, quantile_cont(b, 0.25) AS q1, quantile_cont(b, 0.75) AS q3
FROM banded GROUP BY 1"""
PARTS["banded"] = """
SELECT f.*, lagged_quota_std AS x, backlog_std AS b FROM forecasts f JOIN train USING (sales_id, year_id, month)"""

# --- preprocessing, exploration, evaluation

PARTS["neighbours"] = """
SELECT vec_id AS customer_id, CASE WHEN label < 7 THEN 1 ELSE 0 END AS target_encoded,
       list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features
FROM embeddings"""
PARTS["near_pairs"] = """
SELECT a.customer_id AS a, b.customer_id AS b, a.target_encoded AS ca, b.target_encoded AS cb,
       row_number() OVER (PARTITION BY a.customer_id ORDER BY
         list_sum(list_transform(list_zip(a.features, b.features), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
         b.customer_id) AS k
FROM neighbours a JOIN neighbours b ON a.customer_id <> b.customer_id"""
PARTS["types"] = """
SELECT customer_id, CASE WHEN customer_type = 'AOL' THEN 1 ELSE 0 END AS customer_aol,
       CASE WHEN customer_type = 'CP' THEN 1 ELSE 0 END AS customer_cp,
       CASE WHEN customer_type = 'KA' THEN 1 ELSE 0 END AS customer_ka FROM mapped"""
PARTS["inference"] = """
SELECT customer_id, cust_country, round((frequency_score - avg(frequency_score) OVER ()) / stddev_pop(frequency_score) OVER (), 6) AS frequency_score,
       round((monetary_score - avg(monetary_score) OVER ()) / stddev_pop(monetary_score) OVER (), 6) AS monetary_score,
       round((rfm_score - avg(rfm_score) OVER ()) / stddev_pop(rfm_score) OVER (), 6) AS rfm_score,
       round((qty - avg(qty) OVER ()) / stddev_pop(qty) OVER (), 6) AS qty,
       round((opportunity_amt - avg(opportunity_amt) OVER ()) / stddev_pop(opportunity_amt) OVER (), 6) AS opportunity_amt,
       round((backlog - avg(backlog) OVER ()) / stddev_pop(backlog) OVER (), 6) AS backlog,
       coalesce(CAST(customer_type = 'AOL' AS INTEGER), 0) AS customer_aol,
       coalesce(CAST(customer_type = 'CP' AS INTEGER), 0) AS customer_cp,
       coalesce(CAST(customer_type = 'KA' AS INTEGER), 0) AS customer_ka, label
FROM features"""
PARTS["kept_customers"] = """
SELECT * FROM features WHERE abs((monetary - (SELECT avg(monetary) FROM features))
  / (SELECT stddev_samp(monetary) FROM features)) <= 2"""
PARTS["encoded"] = PARTS["inference"].replace("label\nFROM features", "label, "
    "CASE label WHEN 'churn' THEN 0 ELSE 1 END AS target_encoded\nFROM kept_customers")
PARTS["class_sizes"] = "SELECT target_encoded AS c, count(*) AS n FROM encoded GROUP BY 1"
PARTS["encoded_pairs"] = """
SELECT a.customer_id AS a, a.target_encoded AS ca, b.target_encoded AS cb, row_number() OVER (
         PARTITION BY a.customer_id ORDER BY
         (a.frequency_score - b.frequency_score) ** 2 + (a.monetary_score - b.monetary_score) ** 2
         + (a.rfm_score - b.rfm_score) ** 2 + (a.qty - b.qty) ** 2 + (a.opportunity_amt - b.opportunity_amt) ** 2
         + (a.backlog - b.backlog) ** 2 + (a.customer_aol - b.customer_aol) ** 2
         + (a.customer_cp - b.customer_cp) ** 2 + (a.customer_ka - b.customer_ka) ** 2, b.customer_id) AS k
FROM encoded a JOIN encoded b ON a.customer_id <> b.customer_id"""
PARTS["training"] = """
SELECT e.* FROM encoded e
WHERE (SELECT max(n) * 1.0 / sum(n) FROM class_sizes) <= 0.6
   OR e.target_encoded <> (SELECT arg_max(c, n) FROM class_sizes)
   OR e.customer_id NOT IN (SELECT a FROM encoded_pairs WHERE k = 2 AND ca <> cb)"""
PARTS["label_sector"] = """
SELECT c_custkey AS customer_id, label, n_name AS cust_country, c_mktsegment AS sector, master_sector, customer_type
FROM labels_c JOIN customer ON c_custkey = labels_c.customer_id JOIN nation ON c_nationkey = n_nationkey
JOIN mapped ON mapped.customer_id = c_custkey"""
PARTS["predictions"] = """
SELECT doc_id AS customer_id, quality AS target_encoded,
       CASE WHEN n_chars % 5 = 0 THEN 1 - quality ELSE quality END AS predictions,
       0.5::DOUBLE + (doc_id % 50) / 100.0::DOUBLE AS probability,
       CASE doc_id % 3 WHEN 0 THEN 'KA' WHEN 1 THEN 'CP' ELSE 'AOL' END AS customer_type,
       CAST(n_chars AS DOUBLE) AS qty
FROM labels JOIN documents USING (doc_id)"""
PARTS["outcomes"] = """
SELECT *, CASE WHEN target_encoded = predictions THEN 'correct_' ELSE 'incorrect_' END || predictions AS outcome
FROM predictions"""
PARTS["score_predictions"] = """
SELECT predictions.*, rfm_score, frequency_score, monetary_score
FROM predictions LEFT JOIN (SELECT customer_id, rfm_score, frequency_score, monetary_score FROM scored) USING (customer_id)"""
PARTS["score_outcomes"] = """
SELECT *, CASE WHEN target_encoded = predictions THEN 'correct_' ELSE 'incorrect_' END || predictions AS outcome
FROM score_predictions"""
PARTS["spans"] = """
SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders"""
PARTS["cutoffs"] = """
SELECT c, row_number() OVER (ORDER BY c) AS i FROM (
  SELECT CAST(last_day(m) AS TIMESTAMP) + (lo - date_trunc('day', lo)) AS c, hi
  FROM (SELECT unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 3 MONTH)) AS m, lo, hi FROM spans))
WHERE c <= hi"""
PARTS["pairs_p"] = "SELECT a.c AS s, b.c AS e FROM cutoffs a JOIN cutoffs b ON b.i = a.i + 1"
PARTS["apes"] = """
SELECT *, CASE WHEN y_true = 0 AND y_pred <> 0 THEN CAST('Infinity' AS DOUBLE)
               ELSE abs((y_true - y_pred) / nullif(y_true, 0)) * 100 END AS ape FROM forecasts"""
PARTS["labelled_totals"] = "SELECT totals.*, label FROM totals JOIN labels_c USING (customer_id)"
PARTS["sector_totals"] = """
SELECT totals.*, c_mktsegment AS sector, customer_type FROM totals
JOIN customer ON c_custkey = totals.customer_id JOIN mapped ON mapped.customer_id = c_custkey"""


def _long(source: str, columns: list[str], by: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {by}, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns
    )


PARTS["labelled_scores"] = "SELECT scored.*, label FROM scored JOIN labels_c USING (customer_id)"
PARTS["mw_long"] = _long("labelled_scores", ["monetary", "frequency", "recency", "qty", "rfm_score"], "label")
PARTS["mw_ranks"] = """
SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY metric, value) - 1) / 2.0::DOUBLE AS r,
       count(*) OVER (PARTITION BY metric, value) AS same
FROM mw_long WINDOW w AS (PARTITION BY metric ORDER BY value)"""
PARTS["mw_sums"] = """
SELECT metric, count(*) AS n, count(*) FILTER (WHERE label = 'churn') AS n1,
       count(*) FILTER (WHERE label = 'retain') AS n2, sum(r) FILTER (WHERE label = 'churn') AS r1,
       sum(CAST(same AS DOUBLE) * same - 1) AS ties
FROM mw_ranks GROUP BY metric"""
PARTS["kw_long"] = _long(
    "(SELECT * FROM sector_totals WHERE customer_type IS NOT NULL)", ["monetary", "frequency", "recency"],
    "customer_type")
PARTS["kw_ranks"] = PARTS["mw_ranks"].replace("mw_long", "kw_long")
PARTS["kw_sums"] = """
SELECT metric, sum(s * s / c) AS squares, sum(c) AS n, max(ties) AS ties FROM (
  SELECT metric, customer_type, sum(r) AS s, count(*) AS c FROM kw_ranks GROUP BY 1, 2)
JOIN (SELECT metric, sum(CAST(same AS DOUBLE) * same - 1) AS ties FROM kw_ranks GROUP BY 1) USING (metric)
GROUP BY metric"""
PARTS["box_long"] = _long("sector_totals", ["recency", "frequency", "monetary"], "sector")
PARTS["box_quartiles"] = """
SELECT sector, metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
       quantile_cont(value, 0.75) AS q3 FROM box_long GROUP BY 1, 2"""
PARTS["outcome_long"] = "SELECT * FROM (" + _long(
    "score_outcomes", ["rfm_score", "frequency_score", "monetary_score"], "outcome") + ") WHERE value IS NOT NULL"
PARTS["outcome_quartiles"] = PARTS["box_quartiles"].replace("sector", "outcome").replace("box_long", "outcome_long")
PARTS["scored_rfm"] = "SELECT frequency, recency, monetary, qty, rfm_score FROM scored"

SQL: dict[str, str] = {}


def _uses(text: str, known: set[str]) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text))
    return sorted(words & known)


def build(body: str) -> str:
    """The query with the named subqueries that it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for used in _uses(PARTS[name], set(PARTS) - {name}):
            visit(used)
        ordered.append(name)

    for name in _uses(body, set(PARTS)):
        visit(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{body.strip()}"


SQL["scan_sales"] = """
SELECT order_no, line_no, sales_id, customer_id, egroup, tran_type, order_date, efftive_date, qty, eur,
       cust_country, sector FROM sales"""
SQL["scan_backlog_topn"] = """
SELECT customer_id, sales_id, eur, efftive_date FROM backlog_history
ORDER BY efftive_date, customer_id, sales_id, eur LIMIT 1000"""
SQL["clean_sales"] = "SELECT customer_id, order_no, line_no, order_date, efftive_date, qty, eur FROM clean"
SQL["customer_revenue"] = """
SELECT customer_id, CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS eur FROM sales GROUP BY customer_id"""
SQL["rfm"] = """
SELECT customer_id, order_date, recency, frequency, monetary, recency_score, frequency_score, monetary_score,
       rfm_score FROM scored"""
SQL["drop_stale_customers"] = """
SELECT customer_id, order_date FROM totals WHERE order_date >= TIMESTAMP '2001-06-01'"""
SQL["churn_label"] = "SELECT customer_id, label FROM labels_c"
SQL["purchase_variability"] = "SELECT customer_id, round(purchase_variability, 6) AS purchase_variability FROM variability"
SQL["purchase_diversity"] = "SELECT customer_id, count(DISTINCT egroup) AS purchase_diversity FROM clean GROUP BY customer_id"
SQL["opportunity_by_account"] = "SELECT erp_id, amount, close_date FROM accounts"
SQL["backlog_by_customer"] = "SELECT customer_id, backlog, backlog_date FROM customer_backlog"
SQL["backlog_text_dates"] = SQL["backlog_by_customer"]
SQL["gated_amounts"] = "SELECT customer_id, order_date, opportunity_amt, backlog FROM gated"
SQL["map_sector"] = "SELECT customer_id, master_sector, customer_type FROM mapped"
SQL["customer_profile"] = "SELECT * REPLACE (round(purchase_variability, 6) AS purchase_variability) FROM profile"
SQL["customer_features"] = "SELECT * REPLACE (round(purchase_variability, 6) AS purchase_variability) FROM features"

SQL["rep_month_scores"] = "SELECT sales_id, year_id, month, lines, total, frequency, monetary FROM rep_scores"
SQL["rep_month_sales"] = "SELECT * FROM rep_sales"
SQL["rep_month_sales_text"] = SQL["rep_month_sales"]
SQL["rep_month_sales_per_row"] = """
SELECT sales_id, year_id, month, eur, monetary, frequency, coalesce(backlog * shipments, 0) AS backlog
FROM rep_scores LEFT JOIN rep_backlog USING (sales_id, year_id, month) WHERE shipments > 0"""
SQL["quota_lag_rows"] = """
SELECT sales_id, year_id, month, lagged_quota FROM (
  SELECT sales_id, year_id, month, filler, lag(amount, 12) OVER (PARTITION BY sales_id ORDER BY year_id, month) AS lagged_quota
  FROM (SELECT sales_id, year_id, month, amount, false AS filler FROM quota_m
        UNION ALL
        SELECT sales_id, 1998, CAST(m AS INTEGER), NULL, true
        FROM (SELECT DISTINCT sales_id FROM quota_m WHERE year_id = 1998), range(1, 13) r(m)
        WHERE (sales_id, m) NOT IN (SELECT (sales_id, month) FROM quota_m WHERE year_id = 1998)))
WHERE NOT filler"""
SQL["quota_monthly"] = "SELECT * FROM quota_m"
SQL["quota_vs_sales"] = "SELECT sales_id, year_id, month, amount, eur, backlog FROM quota_sales"
SQL["group_mean_fill"] = """
SELECT sales_id, year_id, month, round(eur, 6) AS eur, round(monetary, 6) AS monetary,
       round(frequency, 6) AS frequency FROM filled"""
SQL["quota_spread"] = """
SELECT sales_id, round(historical_mean, 5) AS historical_mean, round(spread, 5) AS spread FROM spreads"""
SQL["rep_win_rate"] = """
SELECT sales_id, year_id, month, leads, win_rate, partial_win_rate, opportunity_amount
FROM leads JOIN (SELECT sales_id, year_id, month FROM quota_m) USING (sales_id, year_id, month)"""
SQL["rep_cagr"] = "SELECT sales_id, round(cagr, 8) AS cagr FROM growth"
SQL["growth_potential"] = "SELECT sales_id, round(cagr, 8) AS cagr, growth_potential FROM potential"
SQL["quota_lag12"] = """
SELECT sales_id, year_id, month, round(lagged_eur, 6) AS lagged_eur, lagged_quota,
       round(lagged_monetary, 6) AS lagged_monetary, round(lagged_frequency, 6) AS lagged_frequency FROM lagged"""
SQL["fill_interpolate_eur"] = "SELECT sales_id, year_id, month, round(eur, 6) AS eur FROM interpolated"
SQL["fill_interpolate_all"] = "SELECT sales_id, year_id, month, round(eur, 6) AS eur FROM interpolated_all"
SQL["train_features"] = (
    "SELECT * REPLACE (" + ", ".join(
        f"round({c}, 6) AS {c}" for c in
        [f"{c}_std" for c in SCALED] + ["monetary", "frequency", "lagged_monetary", "lagged_frequency", "win_rate",
                                        "partial_win_rate", "lagged_partial_win_rate"]
    ) + ", " + ", ".join(f"round({c}, 5) AS {c}" for c in ["historical_mean", "spread", "lagged_eur"])
    + ") FROM train"
)
SQL["infer_features"] = (
    "SELECT * REPLACE (" + ", ".join(
        f"round({c}, 6) AS {c}" for c in
        ["cagr", "lagged_eur_std", "lagged_quota_std", "lagged_monetary_std", "lagged_frequency_std", "spread_std",
         "historical_mean_std", "backlog_std"]
    ) + ", round(eur, 2) AS eur) FROM infer"
)
SQL["quota_rules"] = """
SELECT sales_id, year_id, month, round(predicted_quota, 6) AS predicted_quota,
       amount = 0 OR eur = 0 AS inactive_or_no_quota,
       CASE growth_potential WHEN 'High' THEN 1.4::DOUBLE WHEN 'Medium' THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END
         AS growth_adjustment_weight
FROM capped"""
SQL["quota_rules_v1"] = """
SELECT sales_id, year_id, month, round(CASE WHEN eur = 0 AND amount = 0 THEN 0.0 WHEN amount = 0 THEN eur * 1.02
   WHEN eur < 10000 THEN eur * 1.015 ELSE (with_backlog + without_backlog) / 2 END, 8) AS predicted_quota
FROM modelled"""
SQL["ensemble_mean"] = """
SELECT sales_id, year_id, month, round((with_backlog + without_backlog) / 2, 6) AS mean,
       round(CASE WHEN eur = 0 AND amount = 0 THEN 0.0 ELSE (with_backlog + without_backlog) / 2 END, 6) AS mean_active
FROM modelled"""
SQL["quota_totals"] = """
SELECT round(CAST(sum(CAST(predicted_quota AS DECIMAL(18,4))) AS DOUBLE), 0) AS predicted_quota,
       round(CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE), 0) AS revenue,
       round(CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE), 0) AS quota
FROM capped"""
SQL["prediction_interval"] = """
SELECT sales_id, year_id, month, round(up, 2) AS y_upper, round(lo, 2) AS y_lower, round(y_pred + (up - y_pred), 2) AS y_adjusted
FROM (SELECT b.*, y_pred + half + CASE WHEN b >= q3 THEN 0.05 * y_pred ELSE 0 END AS up,
             y_pred - half + CASE WHEN b <= q1 THEN 0.05 * y_pred ELSE 0 END AS lo
      FROM (SELECT banded.*, q1, q3, 0.32 * sqrt(mse * (1 + 1.0 / n + coalesce((x - xm) * (x - xm) / nullif(ss, 0), 0))) AS half
            FROM banded JOIN year_stats USING (year_id)) b)"""

_ZCOLS = ["recency", "frequency", "monetary", "qty"]
SQL["outliers_z"] = """
SELECT customer_id, frequency, monetary FROM totals, (
  SELECT avg(frequency) AS fm, stddev_samp(frequency) AS fs, avg(monetary) AS mm, stddev_samp(monetary) AS ms FROM totals)
WHERE abs((frequency - fm) / fs) <= 2 AND abs((monetary - mm) / ms) <= 2"""
SQL["outliers_iqr"] = """
SELECT customer_id, monetary FROM totals, (
  SELECT quantile_cont(monetary, 0.25) AS a, quantile_cont(monetary, 0.75) AS b FROM totals)
WHERE monetary BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)"""
SQL["standardize"] = "SELECT customer_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _ZCOLS) + " FROM totals"
SQL["minmax_scale"] = "SELECT customer_id, " + ", ".join(_minmax(c, digits=6) for c in _ZCOLS) + " FROM totals"
SQL["one_hot"] = "SELECT * FROM types"
SQL["decode_onehot"] = """
SELECT customer_id, CASE WHEN customer_aol >= customer_cp AND customer_aol >= customer_ka THEN 'customer_aol'
  WHEN customer_cp >= customer_ka THEN 'customer_cp' ELSE 'customer_ka' END AS customer_type FROM types"""
SQL["label_encode"] = """
SELECT customer_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS target_encoded FROM labels_c"""
SQL["denormalize"] = """
SELECT customer_id, round((qty - avg(qty) OVER ()) / stddev_pop(qty) OVER (), 6) AS qty_scaled, round(qty, 4) AS qty
FROM totals"""
SQL["tomek_undersample"] = """
SELECT customer_id, target_encoded FROM neighbours WHERE target_encoded = 0
  OR customer_id NOT IN (SELECT a FROM near_pairs WHERE k = 2 AND ca = 1 AND cb = 0)"""
SQL["tomek_links"] = """
SELECT customer_id, target_encoded FROM neighbours WHERE target_encoded = 0
  OR customer_id NOT IN (SELECT x.a FROM near_pairs x JOIN near_pairs y ON x.a = y.b AND x.b = y.a
                         WHERE x.k = 1 AND y.k = 1 AND x.ca = 1 AND x.cb = 0)"""
SQL["inference_table"] = "SELECT * FROM inference"
SQL["training_table"] = "SELECT * FROM training"
SQL["training_table_text_keys"] = (
    "SELECT * REPLACE ('C' || lpad(CAST(customer_id AS VARCHAR), 12, '0') AS customer_id) FROM training")
SQL["label_share"] = """
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels_c GROUP BY label"""
SQL["churn_rate_by_segment"] = """
SELECT cust_country, round(c, 6) AS churn, round(r, 6) AS retain, round(c + r, 6) AS total FROM (
  SELECT cust_country, count(*) FILTER (WHERE label = 'churn') / count(*) AS c,
         count(*) FILTER (WHERE label = 'retain') / count(*) AS r FROM label_sector GROUP BY 1)"""
SQL["pivot_counts"] = """
SELECT master_sector, count(*) FILTER (WHERE label = 'churn') AS churn,
       count(*) FILTER (WHERE label = 'retain') AS retain
FROM label_sector WHERE master_sector IS NOT NULL GROUP BY 1"""
SQL["category_counts"] = "SELECT customer_type, label, count(*) AS n FROM label_sector GROUP BY 1, 2"
SQL["segment_profile"] = """
SELECT label, count(*) AS n, round(avg(frequency), 4) AS mean_frequency, round(avg(recency), 4) AS mean_recency,
       round(avg(monetary), 4) AS mean_monetary, round(avg(purchase_variability), 4) AS mean_purchase_variability,
       round(avg(purchase_diversity), 4) AS mean_purchase_diversity, sum(qty) AS sum_qty FROM profile GROUP BY 1"""
SQL["monthly_trend"] = """
SELECT CAST(m AS DATE) AS month, coalesce(s, 0) AS monetary, CAST(coalesce(f, 0) AS BIGINT) AS frequency
FROM (SELECT unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)),
                                    INTERVAL 1 MONTH)) AS m FROM totals)
LEFT JOIN (SELECT date_trunc('month', order_date) AS k, CAST(sum(CAST(monetary AS DECIMAL(18,4))) AS DOUBLE) AS s,
                  sum(frequency) AS f FROM totals GROUP BY 1) ON m = k"""
SQL["monthly_means"] = """
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       round(avg(monetary), 4) AS mean_monetary, round(avg(frequency), 4) AS mean_frequency FROM totals GROUP BY 1, 2"""
SQL["consecutive_periods"] = """
SELECT 3 AS period_months, customers, n AS consecutive_customers, round(n * 100.0 / customers, 6) AS percentage FROM (
  SELECT count(DISTINCT a.o_custkey) AS n FROM orders a
  JOIN pairs_p ON a.o_orderdate >= s AND a.o_orderdate < e + INTERVAL 1 DAY
  JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate >= e
   AND b.o_orderdate < e + INTERVAL 3 MONTH + INTERVAL 1 DAY),
  (SELECT count(DISTINCT o_custkey) AS customers FROM orders)"""
SQL["correlation_matrix"] = " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, "
    + ("1.0::DOUBLE AS corr" if a == b else f"round(corr({a}, {b}), 6) AS corr FROM scored_rfm")
    for a in ["frequency", "recency", "monetary", "qty", "rfm_score"]
    for b in ["frequency", "recency", "monetary", "qty", "rfm_score"])
SQL["describe_numeric"] = " UNION ALL ".join(
    f"SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q / 100}), 4) AS q{q}" for q in (25, 50, 75))
    + " FROM totals" for c in _ZCOLS)
SQL["histogram_by_group"] = """
SELECT sector, CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 10, 4) AS bin_start, count(*) AS n FROM (
  SELECT sector, lo, hi, least(9, floor((qty - lo) / (hi - lo) * 10)) AS b
  FROM sector_totals, (SELECT min(qty) AS lo, max(qty) AS hi FROM sector_totals)) GROUP BY sector, b, lo, hi"""
SQL["box_summary"] = """
SELECT sector, metric, count(*) AS n, round(max(q1), 4) AS q25, round(max(q2), 4) AS q50, round(max(q3), 4) AS q75,
  round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS low_whisker,
  round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS high_whisker,
  count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM box_long JOIN box_quartiles USING (sector, metric) GROUP BY 1, 2"""
SQL["score_boxes_by_outcome"] = (
    SQL["box_summary"].replace("sector", "outcome").replace("box_long", "outcome_long")
    .replace("box_quartiles", "outcome_quartiles"))
SQL["confusion_split"] = "SELECT customer_id, outcome FROM outcomes"
SQL["confusion_prob_stats"] = """
SELECT outcome, count(*) AS n, round(avg(probability), 6) AS mean, round(stddev_samp(probability), 6) AS std
FROM outcomes GROUP BY 1"""
SQL["confusion_prob_stats_by_class"] = """
SELECT outcome, count(*) AS n, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std
FROM (SELECT *, CASE WHEN predictions = 0 THEN 1 - probability ELSE probability END AS p FROM outcomes) GROUP BY 1"""
SQL["segment_accuracy"] = """
SELECT customer_type, c AS correct, i AS incorrect, round(c * 100.0::DOUBLE / (c + i), 6) AS correct_pct,
       round(i * 100.0::DOUBLE / (c + i), 6) AS incorrect_pct
FROM (SELECT customer_type, count(*) FILTER (WHERE target_encoded = predictions) AS c,
             count(*) FILTER (WHERE target_encoded <> predictions) AS i FROM predictions GROUP BY 1)"""
SQL["classification_report"] = """
SELECT class, round(avg(coalesce(tp / nullif(said, 0), 0)), 6) AS precision,
       round(avg(coalesce(tp / nullif(was, 0), 0)), 6) AS recall,
       round(avg(coalesce(2 * tp / nullif(said + was, 0), 0)), 6) AS f1, CAST(sum(was) AS BIGINT) AS support,
       round(avg(acc), 6) AS accuracy
FROM (SELECT customer_id % 5 AS fold, class, count(*) FILTER (WHERE target_encoded = class AND predictions = class) AS tp,
             count(*) FILTER (WHERE predictions = class) AS said, count(*) FILTER (WHERE target_encoded = class) AS was,
             count(*) FILTER (WHERE target_encoded = predictions) / count(*) AS acc
      FROM predictions, (VALUES (0), (1)) c(class) GROUP BY 1, 2) GROUP BY 1"""
SQL["regression_metrics"] = """
SELECT year_id, count(*) AS n, round(avg((y_true - y_pred) ** 2), 1) AS mse, round(avg(abs(y_true - y_pred)), 6) AS mae,
       round(avg(ape) FILTER (WHERE ape < 'Infinity'), 6) AS mean_ape, round(quantile_cont(ape, 0.5), 6) AS median_ape,
       round(1 - avg((y_true - y_pred) ** 2) / var_pop(y_true), 6) AS r2 FROM apes GROUP BY 1"""
SQL["forecast_bands"] = """
SELECT CASE WHEN ape < 10 THEN 'highly accurate' WHEN ape < 25 THEN 'good' WHEN ape < 50 THEN 'reasonable'
       ELSE 'weak and inaccurate' END AS band, count(*) AS n_rows, count(DISTINCT sales_id) AS n_reps,
       (SELECT round(avg(ape), 6) FROM apes WHERE ape < 70) AS mean_error_below_70
FROM apes WHERE ape IS NOT NULL GROUP BY 1"""
SQL["t_test_bonferroni"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, n1, n2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) "
    f"* (1.0 / n1 + 1.0 / n2)), 6) AS t FROM (SELECT "
    + ", ".join(
        f"count({c}) FILTER (WHERE target_encoded {op} predictions) AS n{i}, "
        f"avg({c}) FILTER (WHERE target_encoded {op} predictions) AS m{i}, "
        f"var_samp({c}) FILTER (WHERE target_encoded {op} predictions) AS v{i}"
        for i, op in ((1, "<>"), (2, "=")))
    + " FROM score_predictions)" for c in ("rfm_score", "frequency_score", "monetary_score", "qty"))
SQL["mann_whitney"] = """
SELECT metric, n1 AS size_1, n2 AS size_2, r1 - n1 * (n1 + 1) / 2.0 AS u,
  round((greatest(r1 - n1 * (n1 + 1) / 2.0, n1 * n2 - (r1 - n1 * (n1 + 1) / 2.0)) - n1 * n2 / 2.0 - 0.5)
        / sqrt(n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1.0)))), 6) AS z
FROM mw_sums"""
SQL["kruskal_wallis"] = """
SELECT metric, CAST(n AS BIGINT) AS n, round((12.0 / (n * (n + 1)) * squares - 3 * (n + 1))
   / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)), 6) AS h, 2 AS freedom FROM kw_sums"""
# densities integrated from 0 by Simpson's rule in 4,000 steps
_SIMPSON = (
    "list_sum(list_transform(range(0, 4001), lambda i: CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END "
    "* {density})) * {upper} / 12000.0")
SQL["rank_test_p_values"] = (
    "SELECT metric, u AS statistic, round(least(1.0, 1 - 2 * "
    + _SIMPSON.format(density="exp(-((abs(z) * i / 4000.0) ** 2) / 2) / sqrt(2 * pi())", upper="abs(z)")
    + """), 6) AS p
FROM (SELECT metric, r1 - n1 * (n1 + 1) / 2.0 AS u,
  (greatest(r1 - n1 * (n1 + 1) / 2.0, n1 * n2 - (r1 - n1 * (n1 + 1) / 2.0)) - n1 * n2 / 2.0 - 0.5)
        / sqrt(n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1.0)))) AS z FROM mw_sums)""")
SQL["t_test_p_values"] = (
    "SELECT feature, n1, n2, round(t, 6) AS t, round(p, 6) AS p, round(least(1.0, 4 * p), 6) AS p_corrected, "
    "least(1.0, 4 * p) < 0.05 AS significant FROM (SELECT *, 1 - 2 * "
    + _SIMPSON.format(
        density="exp(lgamma((f + 1) / 2.0) - lgamma(f / 2.0)) / sqrt(f * pi()) "
        "* (1 + (abs(t) * i / 4000.0) ** 2 / f) ** (-(f + 1) / 2.0)", upper="abs(t)")
    + " AS p FROM (SELECT *, CAST(n1 + n2 - 2 AS DOUBLE) AS f FROM ("
    + SQL["t_test_bonferroni"].replace("round((m1 - m2)", "((m1 - m2)").replace("(1.0 / n1 + 1.0 / n2)), 6) AS t", "(1.0 / n1 + 1.0 / n2))) AS t")
    + ")))")
SQL["error_distance"] = """
SELECT w.customer_id, count(*) AS n_correct, round(min(d), 6) AS min_distance, round(avg(d), 6) AS avg_distance FROM (
  SELECT a.customer_id, sqrt((a.qty - b.qty) ** 2 + CASE WHEN a.customer_type = b.customer_type THEN 0 ELSE 2 END) AS d
  FROM predictions a, predictions b
  WHERE a.target_encoded <> a.predictions AND b.target_encoded = b.predictions) w GROUP BY 1"""
SQL["stratified_folds"] = """
SELECT label, CAST(f AS INTEGER) AS fold, CAST(c // 5 + CASE WHEN f < c % 5 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM (SELECT label, count(*) AS c FROM labels_c GROUP BY 1), range(5) r(f)"""
SQL["customer_value_features"] = """
SELECT training.*, eur FROM training JOIN (
  SELECT customer_id, CAST(sum(CAST(eur AS DECIMAL(18,4))) AS DOUBLE) AS eur FROM sales GROUP BY 1)
USING (customer_id) WHERE eur > 0"""
SQL["backtest_splits"] = """
SELECT CAST(t AS INTEGER) AS test_year, CASE WHEN year_id = t THEN 'test' ELSE 'train' END AS role, sales_id, year_id, month
FROM train, (VALUES (1999), (2000), (2001)) y(t)
WHERE year_id = t OR (year_id < t AND year_id >= 1998 AND lagged_quota_std <> 0 AND lagged_eur_std <> 0)"""
SQL["churn_report_checked"] = """
SELECT CAST(target_encoded AS INTEGER) AS class, count(*) AS support, true AS shares FROM training GROUP BY 1"""
SQL["score_customers_checked"] = """
SELECT customer_id, CASE customer_type WHEN 'CP' THEN 'customer_cp' WHEN 'KA' THEN 'customer_ka' ELSE 'customer_aol' END
         AS customer_type, round(qty) AS qty, label, true AS sure
FROM features"""
SQL["quota_backtest_checked"] = """
SELECT CAST(year_id AS INTEGER) AS test_year, sales_id, year_id, month, round(amount, 2) AS y_true, true AS fits
FROM train WHERE year_id IN (1999, 2000, 2001)"""
SQL["quota_predictions_checked"] = """
SELECT sales_id, year_id, month, round(amount, 2) AS current_year_quota, growth_potential,
       CAST(CASE growth_potential WHEN 'High' THEN 1.4 WHEN 'Medium' THEN 1.2 ELSE 1.0 END AS DOUBLE) AS weight,
       amount = 0 OR eur = 0 AS inactive_or_no_quota
FROM infer"""
SQL["write_overwrite_append"] = f"""
SELECT * FROM ({SQL["customer_revenue"]}) UNION ALL SELECT * FROM ({SQL["customer_revenue"]})"""
SQL["csv_round_trip"] = SQL["customer_revenue"]
SQL["clear_table"] = f"""
SELECT count(*) AS rows_before, max(customer_id) AS last_before, CAST(0 AS BIGINT) AS rows_after,
       'customer_id bigint, eur double' AS columns_after FROM ({SQL["customer_revenue"]})"""
SQL["training_table_stored"] = SQL["training_table"]
SQL["inference_table_stored"] = SQL["inference_table"]
SQL["purchase_diversity_merged"] = SQL["purchase_diversity"]
SQL["csv_quarantine"] = f"""
SELECT count(*) FILTER (WHERE NOT broken) AS n_good,
       round(CAST(sum(CAST(round(eur, 2) AS DECIMAL(18,4))) FILTER (WHERE NOT broken) AS DOUBLE), 2) AS eur,
       count(*) FILTER (WHERE broken) AS n_bad, count(*) FILTER (WHERE customer_id % 7 = 0) AS n_words,
       CAST(0 AS BIGINT) AS n_without_reason
FROM (SELECT *, customer_id % 7 = 0 OR customer_id % 11 = 0 AS broken FROM ({SQL["customer_revenue"]}))"""
SQL["rfm_approx"] = """
SELECT metric, prob, (SELECT count(*) FROM totals) AS n, true AS within
FROM (SELECT 'frequency' AS metric, unnest([0.0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]::DOUBLE[]) AS prob
      UNION ALL SELECT m, unnest([0.0, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) FROM (VALUES ('recency'), ('monetary')) t(m))"""
SQL["run_log_history"] = """
SELECT TIMESTAMP '2002-01-01' + to_days(CAST(fold AS INTEGER)) AS training_date, round(a, 6) AS accuracy,
       round(f, 6) AS f1_score, round(a - lag(a) OVER (ORDER BY fold), 6) AS change,
       round(max(a) OVER (ORDER BY fold), 6) AS best_so_far
FROM (SELECT customer_id % 5 AS fold, avg(CASE WHEN target_encoded = predictions THEN 1.0 ELSE 0.0 END) AS a,
             coalesce(2.0::DOUBLE * count(*) FILTER (WHERE predictions = 1 AND target_encoded = 1)
               / nullif(count(*) FILTER (WHERE predictions = 1) + count(*) FILTER (WHERE target_encoded = 1), 0), 0) AS f
      FROM predictions GROUP BY 1)"""


def oracle_sql() -> dict[str, str]:
    return {name: build(body) for name, body in SQL.items()}
