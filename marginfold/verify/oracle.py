"""The same queries as SQL over the star-schema tables, in exact integer cents.

Money stays a whole number of cents (percentages hundredths) until the last projection, and
division rounds half away from zero on integers, so no floating or capped decimal step can
differ from the exact answer.
"""

from __future__ import annotations

import re

from marginfold.verify.queries import BUILT, KEPT, LOADED


def _div(num: str, den: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero divisor."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)"


def _num(value: str, scale: int = 100, places: int | None = None) -> str:
    """The exact decimal of a whole number of ``1 / scale``, as text with all places of its type."""
    kept = len(str(scale)) - 1
    unit = f"CAST('{1 / scale:.{kept}f}' AS DECIMAL({kept + 1}, {kept}))"
    return f"CAST(CAST(CAST({value} AS DECIMAL(20, 0)) * {unit} AS DECIMAL(38, {places or kept})) AS VARCHAR)"


def _double(value: str, scale: int = 100) -> str:
    return f"CAST({value} AS DOUBLE) / {scale}"


def _day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def _time(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def _pct(part: str, whole: str) -> str:
    return _div(f"({part}) * 10000", whole)


def _status(ok: str, fail: str = "FAIL", passed: str = "PASS") -> str:
    return f"CASE WHEN {ok} THEN '{passed}' ELSE '{fail}' END"


def _case(key: str, table: dict, otherwise: str) -> str:
    arms = " ".join(f"WHEN {key} = {k!r} THEN {v}" for k, v in table.items())
    return f"CASE {arms} ELSE {otherwise} END"


# ---------------------------------------------------------------- canonical inputs and staging

_CTES: dict[str, str] = {}

_CTES["lines"] = f"""
SELECT l_orderkey AS ok, l_partkey, l_suppkey, l_linenumber, l_returnflag || l_linestatus AS flags,
  row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS line,
  {_div("CAST(round(l_extendedprice * 100) AS HUGEINT)", "100")} AS price,
  {_div("CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(round(l_tax * 100) AS HUGEINT)", "10000")} AS freight,
  {_div("CAST(round(l_extendedprice * 100) AS HUGEINT) * CAST(round(l_discount * 100) AS HUGEINT)", "10000")} AS disc
FROM lineitem"""

_CTES["raw_orders"] = f"""
SELECT o_orderkey AS ok, o_custkey AS ck,
  CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'returned'
       WHEN o_orderkey % 5 = 0 THEN 'canceled' ELSE 'shipped' END AS status,
  o_orderdate AS bought,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) END AS approved,
  o_orderdate + to_days(1) AS shipped,
  o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS delivered,
  o_orderdate + to_days(20) AS estimated,
  CASE WHEN o_orderkey % 11 <> 0 THEN d.disc END AS discount,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'paid_search' WHEN '2' THEN 'social_ads' WHEN '3' THEN 'email'
    WHEN '4' THEN 'marketplace' WHEN '5' THEN 'organic_search' END AS channel
FROM orders LEFT JOIN (SELECT ok AS dk, sum(disc) AS disc FROM lines GROUP BY ok) d ON o_orderkey = d.dk"""

_CTES["so"] = """
SELECT ok, ck, status, bought, approved, shipped, delivered, estimated,
  CAST(bought AS DATE) AS day, CAST(date_trunc('month', bought) AS DATE) AS month,
  coalesce(discount, 0) AS discount, channel, status = 'returned' AS returned,
  CAST(trunc((epoch_us(delivered) - epoch_us(estimated)) / 86400000000.0) AS BIGINT) AS delay,
  delivered > estimated AS late,
  epoch_us(approved) - epoch_us(bought) AS lag_us,
  row_number() OVER (PARTITION BY ck ORDER BY bought, CAST(ok AS VARCHAR)) AS seq
FROM raw_orders WHERE status IN ('delivered', 'returned')"""

_CTES["prod"] = """
SELECT p_partkey AS pk, p_type AS category, p_size AS size, p_size + 30 AS ratio,
  CAST(floor(p_retailprice) AS BIGINT) AS lo, CAST(floor(p_retailprice) AS BIGINT) + p_size AS hi
FROM part"""

_CTES["si"] = f"""
SELECT l.ok, l.line, l.l_partkey AS pk, l.l_suppkey AS sk, p.category, p.ratio, l.price, l.freight,
  {_div("l.price * p.ratio", "100")} AS cogs,
  {_div("l.price * 100 - l.price * p.ratio", "100")} AS gross,
  (100 - p.ratio) * 100 AS gross_pct
FROM lines l JOIN so ON l.ok = so.ok LEFT JOIN prod p ON l.l_partkey = p.pk"""

_CTES["pay"] = f"""
SELECT l.ok, CASE l.flags WHEN 'AF' THEN 'credit_card' WHEN 'AO' THEN 'debit_card' WHEN 'NF' THEN 'upi'
    WHEN 'NO' THEN 'voucher' ELSE 'wallet' END AS kind,
  CASE l.flags WHEN 'AF' THEN 25 WHEN 'AO' THEN 15 WHEN 'NF' THEN 5 WHEN 'NO' THEN 0 ELSE 20 END AS rate,
  l.price AS amount, l.line, l.l_linenumber AS installments
FROM lines l"""

_CTES["sp"] = f"""
SELECT p.ok, count(*) AS n, arg_max(kind, amount * 1000000 - line) AS kind, max(installments) AS installments,
  sum(amount) AS paid, {_div("sum(amount * rate)", "1000")} AS fee,
  {_div("sum(amount * rate) * 100", "sum(amount)")} AS rate
FROM pay p JOIN so ON p.ok = so.ok GROUP BY p.ok"""

_CTES["cust"] = """
SELECT c_custkey AS ck, c_name, c_nationkey, n_name, c_mktsegment AS segment,
  CASE c_custkey % 6 WHEN 0 THEN 'marketplace' WHEN 1 THEN 'organic_search' WHEN 2 THEN 'paid_search'
    WHEN 3 THEN 'social_ads' WHEN 4 THEN 'email' WHEN 5 THEN 'referral' END AS acquired
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

_CTES["leads"] = """
SELECT event_id AS id, CAST(ts AS DATE) AS contact,
  CASE event_type WHEN 'view' THEN 'marketplace' WHEN 'click' THEN 'paid_search' WHEN 'signup' THEN 'organic_search'
    WHEN 'purchase' THEN 'email' ELSE 'display' END AS channel
FROM events"""

_CTES["deals"] = """
SELECT e.event_id AS id, e.user_id, CAST(CAST(e.ts AS DATE) + CAST(e.event_id % 30 AS INTEGER) AS DATE) AS won,
  e.event_type, CASE WHEN e.value >= 200 THEN 'offline' ELSE 'online_medium' END AS lead_type,
  CAST(round(e.value * 100) AS HUGEINT) * 1000 AS revenue, l.channel, l.contact
FROM events e LEFT JOIN leads l ON e.event_id = l.id WHERE e.value >= 100"""

_CTES["spend"] = """
SELECT * FROM (VALUES ('marketplace', 4500000), ('organic_search', 0), ('paid_search', 6000000),
  ('social_ads', 3500000), ('email', 800000), ('referral', 500000)) AS v(name, amount)"""

_CTES["funnel"] = f"""
SELECT coalesce(l.channel, d.channel, n.channel) AS channel, coalesce(l.n, 0) AS leads, coalesce(d.n, 0) AS deals,
  coalesce(n.n, 0) AS customers, {_pct("coalesce(d.n, 0)", "coalesce(l.n, 0)")} AS conversion
FROM (SELECT channel, count(*) AS n FROM leads GROUP BY channel) l
FULL OUTER JOIN (SELECT channel, count(*) AS n FROM deals GROUP BY channel) d ON l.channel = d.channel
FULL OUTER JOIN (SELECT acquired AS channel, count(DISTINCT ck) AS n FROM cust c
    WHERE EXISTS (SELECT 1 FROM so WHERE so.ck = c.ck) GROUP BY acquired) n
  ON coalesce(l.channel, d.channel) = n.channel"""

_CTES["summary"] = f"""
SELECT f.*, s.amount AS spend, CASE WHEN customers > 0 THEN {_div("s.amount", "customers")} END AS cac
FROM funnel f LEFT JOIN spend s ON f.channel = s.name"""

# ---------------------------------------------------------------- fact

_CTES["base"] = f"""
SELECT i.ok, i.line, so.ck, i.pk, i.sk, so.day, so.month, i.category, c.segment, c.n_name AS state, so.channel,
  c.acquired, sp.kind, so.returned, so.late, so.seq, so.seq = 1 AS first, i.price AS rev, i.cogs, i.gross, i.gross_pct,
  i.freight AS log,
  CASE WHEN so.returned THEN {_div("i.freight * 10 + i.cogs", "10")} ELSE 0 END AS ret,
  sp.fee AS order_fee, so.discount AS order_disc, t.total, t.n, coalesce(s.cac, 0) AS cac
FROM si i JOIN so ON i.ok = so.ok JOIN cust c ON so.ck = c.ck JOIN sp ON i.ok = sp.ok
JOIN (SELECT ok, sum(price) AS total, count(*) AS n FROM si GROUP BY ok) t ON i.ok = t.ok
LEFT JOIN summary s ON so.channel = s.channel"""

_CTES["alloc"] = f"""
SELECT *, {_div("rev * 1000000", "total")} AS share, {_div("order_fee * rev", "total")} AS fee,
  {_div("order_disc * rev", "total")} AS disc,
  CASE WHEN seq = 1 THEN {_div("cac * rev", "total")} ELSE 0 END AS acq
FROM base"""

_CTES["casc"] = "SELECT *, rev - cogs - log - fee - disc - ret AS cm FROM alloc"

_CTES["fact"] = f"""
SELECT *, cm - acq AS net, {_pct("cm", "rev")} AS cm_pct, {_pct("cm - acq", "rev")} AS net_pct, cm - acq < 0 AS leak
FROM casc"""

_SUMS = """count(*) AS lines, count(DISTINCT ok) AS orders, count(DISTINCT ck) AS customers, sum(rev) AS rev,
  sum(cogs) AS cogs, sum(log) AS log, sum(fee) AS fee, sum(disc) AS disc, sum(ret) AS ret, sum(gross) AS gross,
  sum(cm) AS cm, sum(acq) AS acq, sum(net) AS net, sum(net_pct) AS net_pct, count(net_pct) AS net_n,
  sum(cm_pct) AS cm_pct, count(cm_pct) AS cm_n, count(*) FILTER (WHERE leak) AS leaks,
  count(*) FILTER (WHERE net < 0) AS losing, count(*) FILTER (WHERE returned) AS returned_lines,
  count(DISTINCT ok) FILTER (WHERE returned) AS returned_orders, count(DISTINCT ok) FILTER (WHERE first) AS first_orders,
  count(DISTINCT ck) FILTER (WHERE first) AS new_customers, sum(rev) FILTER (WHERE first) AS first_rev,
  sum(net) FILTER (WHERE first) AS first_net, min(day) AS first_day, max(day) AS last_day"""

_LEAKED = "(rev - greatest(net, 0))"
_AVG_NET = _div("net_pct", "net_n")

_CTES["monthly"] = f"""
SELECT month, {_SUMS} FROM fact GROUP BY month"""

_CTES["r_month"] = f"""
SELECT {_day("month")} AS order_month, CAST(year(month) AS BIGINT) AS order_year,
  strftime(month, '%b %Y') AS month_label, {_big("orders")} AS total_orders, {_big("lines")} AS total_line_items,
  {_num("rev")} AS total_revenue, {_num("cogs")} AS total_cogs, {_num("log")} AS total_logistics,
  {_num("fee")} AS total_payment_fees, {_num("disc")} AS total_discounts, {_num("ret")} AS total_return_costs,
  {_num("cm")} AS total_contribution_margin, {_num(_div("cm_pct", "cm_n"))} AS avg_cm_pct, {_num("acq")} AS total_cac,
  {_num("net")} AS total_net_profit, {_num(_AVG_NET)} AS avg_net_margin_pct, {_big("leaks")} AS profit_leak_items
FROM monthly"""

_CTES["r_category"] = f"""
SELECT category, {_big("lines")} AS total_line_items, {_big("orders")} AS total_orders,
  {_big("customers")} AS total_customers, {_num("rev")} AS total_revenue, {_num("cogs")} AS total_cogs,
  {_num("log")} AS total_logistics_cost, {_num("fee")} AS total_payment_fees, {_num("disc")} AS total_discounts,
  {_num("ret")} AS total_return_cost, {_num("acq")} AS total_cac_spend,
  {_num(_pct("cogs", "rev"))} AS cogs_pct, {_num(_pct("log", "rev"))} AS logistics_pct,
  {_num(_pct("fee", "rev"))} AS payment_fee_pct, {_num(_pct("disc", "rev"))} AS discount_pct,
  {_num(_pct("ret", "rev"))} AS return_cost_pct, {_num(_pct("acq", "rev"))} AS cac_pct,
  {_num("gross")} AS total_gross_profit, {_num(_pct("gross", "rev"))} AS gross_margin_pct,
  {_num("cm")} AS total_contribution_margin, {_num(_pct("cm", "rev"))} AS cm_pct, {_num("net")} AS total_net_profit,
  {_num(_AVG_NET)} AS avg_net_margin_pct, {_big("returned_lines")} AS returned_items,
  {_num(_pct("returned_lines", "lines"))} AS return_rate_pct, {_num(_LEAKED)} AS profit_leaked_abs,
  {_num(_pct(_LEAKED, "rev"))} AS leakage_pct,
  CASE WHEN cogs = greatest(cogs, log, acq, ret) THEN 'COGS' WHEN log = greatest(cogs, log, acq, ret) THEN 'Logistics'
    WHEN acq = greatest(cogs, log, acq, ret) THEN 'CAC' ELSE 'Returns' END AS primary_cost_driver,
  CASE WHEN {_AVG_NET} >= 1500 THEN 'High Margin' WHEN {_AVG_NET} >= 500 THEN 'Moderate Margin'
    WHEN {_AVG_NET} >= 0 THEN 'Low Margin' ELSE 'Loss-Making' END AS profitability_tier
FROM (SELECT category, {_SUMS} FROM fact GROUP BY category)"""

_CTES["r_loss"] = f"""
SELECT CAST(ok AS VARCHAR) AS order_id, CAST(ck AS VARCHAR) AS customer_id, {_day("day")} AS order_date,
  {_day("month")} AS order_month, channel AS order_channel, segment AS customer_segment, category AS primary_category,
  returned AS return_flag, first AS is_first_order, {_big("n")} AS item_count, {_num("rev")} AS order_revenue,
  {_num("cogs")} AS order_cogs, {_num("log")} AS order_logistics, {_num("fee")} AS order_payment_fee,
  {_num("disc")} AS order_discount, {_num("ret")} AS order_return_cost, {_num("gross")} AS order_gross_profit,
  {_num("cm")} AS order_contribution_margin, {_num("acq")} AS order_cac, {_num("net")} AS order_net_profit,
  {_num("pct")} AS order_net_margin_pct, {_num("abs(net)")} AS loss_amount,
  CASE WHEN cm >= 0 AND acq > cm THEN 'High CAC on First Order' WHEN returned AND ret > cm + acq THEN 'Return Cost'
    WHEN gross < 0 THEN 'Negative Gross Margin (COGS > Revenue)' WHEN disc > cm THEN 'Excess Discount'
    WHEN 2 * log > gross THEN 'High Logistics Cost' ELSE 'Combined Cost Pressure' END AS loss_root_cause,
  CASE WHEN pct < -5000 THEN 'Severe   (>50% loss)' WHEN pct < -2000 THEN 'High     (20-50% loss)'
    WHEN pct < -500 THEN 'Moderate (5-20% loss)' ELSE 'Marginal (<5% loss)' END AS loss_severity
FROM (SELECT *, {_pct("net", "rev")} AS pct FROM (
  SELECT ok, ck, day, month, channel, segment, returned, first, max(category) AS category, count(*) AS n,
    sum(rev) AS rev, sum(cogs) AS cogs, sum(log) AS log, sum(fee) AS fee, sum(disc) AS disc, sum(ret) AS ret,
    sum(gross) AS gross, sum(cm) AS cm, sum(acq) AS acq, sum(net) AS net
  FROM fact GROUP BY ok, ck, day, month, channel, segment, returned, first)) WHERE net < 0"""

_CTES["r_customer"] = f"""
SELECT CAST(ck AS VARCHAR) AS customer_id, segment AS customer_segment, acquired AS acquisition_channel,
  state AS customer_state, {_big("orders")} AS total_orders, {_day("first_day")} AS first_order_date,
  {_day("last_day")} AS last_order_date, {_big("last_day - first_day")} AS customer_lifespan_days,
  {_num("rev")} AS total_revenue, {_num(_div("rev", "orders"))} AS avg_order_value, {_num("cogs")} AS total_cogs,
  {_num("log")} AS total_logistics, {_num("fee")} AS total_payment_fees, {_num("disc")} AS total_discounts,
  {_num("ret")} AS total_return_costs, {_num("gross")} AS total_gross_profit,
  {_num("cm")} AS total_contribution_margin, {_num("acq")} AS total_cac_paid, {_num("net")} AS total_net_profit,
  {_num(_pct("net", "rev"))} AS net_margin_pct, {_num(_div("net * 100", "acq"))} AS ltv_cac_ratio,
  {_num(_div("acq * orders * 10", "cm"), 10)} AS cac_payback_orders, {_big("returned_orders")} AS returned_orders,
  CASE WHEN net >= 500000 THEN 'Champion' WHEN net >= 100000 THEN 'Profitable' WHEN net >= 0 THEN 'Breakeven'
    ELSE 'Loss-Making' END AS customer_value_tier
FROM (SELECT ck, segment, acquired, state, {_SUMS} FROM fact GROUP BY ck, segment, acquired, state)"""

_PER_NEW = _div("net", "new_customers")

_CTES["r_channel"] = f"""
SELECT co.channel, {_big("coalesce(s.leads, 0)")} AS total_mql_leads, {_big("coalesce(s.deals, 0)")} AS total_deals_closed,
  {_num("coalesce(s.conversion, 0)")} AS lead_conversion_rate_pct, {_big("new_customers")} AS new_customers,
  {_big("co.customers")} AS total_customers,
  {_num(_pct("co.customers - new_customers", "new_customers"))} AS repeat_customer_rate_pct,
  {_num("coalesce(s.spend, 0)")} AS estimated_monthly_spend, {_num("coalesce(s.cac, 0)")} AS estimated_cac,
  {_num(_div("acq", "new_customers"))} AS actual_cac_per_new_customer, {_big("orders")} AS total_orders,
  {_num("rev")} AS total_revenue, {_num("gross")} AS total_gross_profit, {_num("cm")} AS total_contribution_margin,
  {_num("acq")} AS total_cac_spend, {_num("net")} AS total_net_profit, {_num(_AVG_NET)} AS avg_net_margin_pct,
  {_num(_div("rev", "new_customers"))} AS revenue_per_new_customer,
  {_num(_PER_NEW)} AS net_profit_per_new_customer, {_num("first_rev")} AS first_order_revenue,
  {_num("first_net")} AS first_order_net_profit, {_num(_pct("first_net", "first_rev"))} AS first_order_net_margin_pct,
  {_num(_div("net * 100", "coalesce(s.spend, acq)"))} AS ltv_cac_ratio,
  CASE WHEN {_PER_NEW} >= 200000 THEN 'High Value Channel' WHEN {_PER_NEW} >= 50000 THEN 'Moderate Value'
    WHEN {_PER_NEW} >= 0 THEN 'Breakeven' ELSE 'Loss Channel' END AS channel_tier
FROM (SELECT channel, {_SUMS} FROM fact GROUP BY channel) co LEFT JOIN summary s ON co.channel = s.channel"""

_CTES["wf"] = f"SELECT {_SUMS} FROM fact"

_CTES["r_waterfall"] = f"""
SELECT {_num("rev")} AS step_01_item_revenue, {_num("cogs")} AS step_02_less_cogs, {_num("log")} AS step_03_less_logistics,
  {_num("fee")} AS step_04_less_payment_fees, {_num("disc")} AS step_05_less_discounts,
  {_num("ret")} AS step_06_less_return_costs, {_num("cm")} AS step_07_contribution_margin,
  {_num(_pct("cm", "rev"))} AS cm_margin_pct, {_num("acq")} AS step_08_less_cac, {_num("net")} AS step_09_net_profit,
  {_num(_pct("net", "rev"))} AS net_margin_pct, {_num(_LEAKED)} AS total_profit_leaked,
  {_num(_pct(_LEAKED, "rev"))} AS leakage_pct, {_big("orders")} AS total_orders, {_big("lines")} AS total_line_items,
  {_big("customers")} AS total_customers, {_big("leaks")} AS loss_making_line_items,
  {_num(_pct("leaks", "lines"))} AS pct_items_losing_money
FROM wf"""

# ---------------------------------------------------------------- outputs

_OUT: dict[str, str] = {}

_OUT["b01_stage_orders"] = f"""
SELECT CAST(ok AS VARCHAR) AS order_id, CAST(ck AS VARCHAR) AS customer_id, status AS order_status,
  {_time("bought")} AS order_purchase_at, {_time("approved")} AS order_approved_at, {_time("shipped")} AS shipped_at,
  {_time("delivered")} AS delivered_at, {_time("estimated")} AS estimated_delivery_at, {_day("day")} AS order_date,
  {_day("month")} AS order_month, {_num("discount", 100, 8)} AS discount_amount, channel AS order_channel,
  returned AS return_flag, delay AS delivery_delay_days, late AS is_late_delivery,
  {_num(_div("lag_us", "36000000"))} AS approval_lag_hours, {_big("seq")} AS customer_order_seq
FROM so"""

_OUT["b02_stage_order_items"] = f"""
SELECT CAST(ok AS VARCHAR) AS order_id, {_big("line")} AS order_item_id, CAST(pk AS VARCHAR) AS product_id,
  CAST(sk AS VARCHAR) AS seller_id, category, {_num("ratio", 100, 10)} AS cost_ratio, {_num("price")} AS selling_price,
  {_num("cogs")} AS unit_cogs, {_num("freight")} AS logistics_cost, {_num("gross")} AS gross_profit,
  {_num("gross_pct")} AS gross_margin_pct
FROM si"""

_OUT["b03_stage_payments"] = f"""
SELECT CAST(ok AS VARCHAR) AS order_id, {_big("n")} AS payment_count, kind AS primary_payment_type,
  {_big("installments")} AS max_installments, {_num("paid")} AS total_payment_value, {_num("fee")} AS total_payment_fee,
  {_num("rate", 1000)} AS effective_fee_rate_pct
FROM sp"""

_VOLUME = "(size + 10) * (size % 20 + 5) * (size % 15 + 8)"

_OUT["b04_stage_products"] = f"""
SELECT CAST(pk AS VARCHAR) AS product_id, category, {_big("size * 100")} AS weight_g, {_big("size + 10")} AS length_cm,
  {_big("size % 20 + 5")} AS height_cm, {_big("size % 15 + 8")} AS width_cm, {_big("size % 6")} AS photos_qty,
  {_big("lo")} AS list_price_min, {_big("hi")} AS list_price_max, {_num(_div("(lo + hi) * 100", "2"))} AS avg_list_price,
  {_num("ratio", 100, 10)} AS cost_ratio, {_num(_div(f"{_VOLUME} * 1000", "5000"), 1000)} AS volumetric_weight_kg
FROM prod"""

_OUT["b05_stage_customers"] = """
SELECT CAST(ck AS VARCHAR) AS customer_id, c_name AS customer_unique_id, 'City ' || c_nationkey AS customer_city,
  n_name AS customer_state, segment AS customer_segment, acquired AS acquisition_channel
FROM cust"""

_OUT["b06_stage_leads"] = f"""
SELECT CAST(id AS VARCHAR) AS mql_id, channel, {_day("contact")} AS first_contact_date,
  {_day("date_trunc('month', contact)")} AS lead_month
FROM leads"""

_OUT["b07_stage_deals"] = f"""
SELECT CAST(id AS VARCHAR) AS mql_id, CAST(user_id AS VARCHAR) AS seller_id, {_day("won")} AS won_date,
  {_day("date_trunc('month', won)")} AS won_month, event_type AS business_segment, lead_type,
  'reseller' AS business_type, {_num("revenue")} AS declared_monthly_revenue, channel,
  {_day("contact")} AS first_contact_date, {_big("won - contact")} AS days_to_close
FROM deals"""

_FUNNEL = f"""channel, {_big("leads")} AS total_leads, {_big("deals")} AS total_deals,
  {_big("customers")} AS new_customers, {_num("conversion")} AS lead_conversion_rate_pct"""

_OUT["b08_channel_funnel"] = f"""
SELECT {_FUNNEL}, CAST(NULL AS VARCHAR) AS estimated_monthly_spend, CAST(NULL AS VARCHAR) AS estimated_cac FROM funnel"""

_OUT["b09_attach_spend"] = f"""
SELECT {_FUNNEL}, {_num("spend")} AS estimated_monthly_spend, {_num("cac")} AS estimated_cac FROM summary"""

_OUT["b10_order_totals"] = f"""
SELECT CAST(ok AS VARCHAR) AS order_id, {_num("sum(price)")} AS order_total_revenue, {_big("count(*)")} AS item_count
FROM si GROUP BY ok"""

_OUT["b11_return_costs"] = f"""
SELECT CAST(i.ok AS VARCHAR) AS order_id, {_big("i.line")} AS order_item_id,
  {_num(f"CASE WHEN so.returned THEN {_div('i.freight * 10 + i.cogs', '10')} ELSE 0 END")} AS return_cost
FROM si i JOIN so ON i.ok = so.ok"""

_OUT["b12_channel_cac"] = f"""
SELECT channel, {_num("coalesce(cac, 0)")} AS cac_per_new_customer FROM summary"""

_KEYS = f"CAST(ok AS VARCHAR) AS order_id, {_big('line')} AS order_item_id"

_DIMS = f"""{_KEYS}, CAST(ck AS VARCHAR) AS customer_id, CAST(pk AS VARCHAR) AS product_id,
  CAST(sk AS VARCHAR) AS seller_id, {_day("day")} AS order_date, {_day("month")} AS order_month,
  CAST(year(day) AS BIGINT) AS order_year, CAST(quarter(day) AS BIGINT) AS order_quarter,
  strftime(day, '%b %Y') AS month_label, category, segment AS customer_segment, state AS customer_state,
  channel AS order_channel, acquired AS acquisition_channel, kind AS primary_payment_type, returned AS return_flag,
  late AS is_late_delivery, {_big("seq")} AS customer_order_seq, first AS is_first_order, {_num("rev")} AS item_revenue,
  {_num("cogs")} AS item_cogs, {_num("gross")} AS gross_profit, {_num("gross_pct")} AS gross_margin_pct,
  {_num("log")} AS logistics_cost, {_num("ret")} AS return_cost"""

_OUT["b13_fact_base"] = f"""
SELECT {_DIMS}, {_num("order_fee")} AS order_payment_fee, {_num("order_disc", 100, 8)} AS order_discount,
  {_num("total")} AS order_total_revenue, {_big("n")} AS item_count, {_num("cac")} AS channel_cac
FROM base"""

_OUT["b14_allocate_by_revenue_share"] = f"""
SELECT {_KEYS}, {_num("share", 1000000)} AS item_revenue_share, {_num("fee")} AS payment_fee,
  {_num("disc")} AS discount_allocated
FROM alloc"""

_OUT["b15_allocate_cac"] = f"""
SELECT {_KEYS}, first AS is_first_order, {_num("cac")} AS channel_cac, {_num("acq")} AS cac_allocation FROM alloc"""

_OUT["b16_cost_cascade"] = f"""
SELECT {_KEYS}, {_num("cm")} AS contribution_margin, {_num("cm_pct")} AS contribution_margin_pct,
  {_num("net")} AS net_profit, {_num("net_pct")} AS net_margin_pct, leak AS is_profit_leak
FROM fact"""

_OUT["b17_fact_order_items"] = f"""
SELECT CAST(ok AS VARCHAR) || '-' || CAST(line AS VARCHAR) AS order_item_key, {_DIMS},
  {_num("share", 1000000)} AS item_revenue_share, {_num("fee")} AS payment_fee, {_num("disc")} AS discount_allocated,
  {_num("cm")} AS contribution_margin, {_num("cm_pct")} AS contribution_margin_pct, {_num("acq")} AS cac_allocation,
  {_num("net")} AS net_profit, {_num("net_pct")} AS net_margin_pct, leak AS is_profit_leak
FROM fact"""

_OUT["b18_dim_products"] = f"""
SELECT CAST(pk AS VARCHAR) AS product_id, category, {_num("ratio", 100, 10)} AS cost_ratio, {_big("lo")} AS list_price_min,
  {_big("hi")} AS list_price_max, {_num(_div("(lo + hi) * 100", "2"))} AS avg_list_price,
  {_big("size * 100")} AS weight_g, {_num(_div(f"{_VOLUME} * 1000", "5000"), 1000)} AS volumetric_weight_kg
FROM prod"""

_OUT["b19_dim_customers"] = f"""
SELECT CAST(c.ck AS VARCHAR) AS customer_id, c_name AS customer_unique_id, 'City ' || c_nationkey AS customer_city,
  n_name AS customer_state, segment AS customer_segment, acquired AS acquisition_channel,
  {_big("count(so.ok)")} AS total_orders, {_day("min(day)")} AS first_order_date, {_day("max(day)")} AS last_order_date,
  {_big("max(day) - min(day)")} AS customer_lifespan_days
FROM cust c LEFT JOIN so ON c.ck = so.ck GROUP BY c.ck, c_name, c_nationkey, n_name, segment, acquired"""

_OUT["b20_summary_by_month"] = "SELECT * FROM r_month"
_OUT["b21_category_profitability"] = "SELECT * FROM r_category"
_OUT["b22_loss_making_orders"] = "SELECT * FROM r_loss"
_OUT["b23_customer_profitability"] = "SELECT * FROM r_customer"
_OUT["b24_cac_by_channel"] = "SELECT * FROM r_channel"
_OUT["b25_profit_waterfall"] = "SELECT * FROM r_waterfall"

_LAYERS = """
(SELECT sum(price) AS rr, count(DISTINCT l.ok) AS ro, count(*) AS rl FROM lines l JOIN raw_orders o ON l.ok = o.ok
  WHERE o.status IN ('delivered', 'returned')) r,
(SELECT sum(rev) AS fr, count(DISTINCT ok) AS fo, count(*) AS fl FROM fact) f"""

_OUT["b26_reconcile_revenue"] = f"""
SELECT {_num("rr")} AS raw_total_revenue, {_num("fr")} AS fact_total_revenue, {_num("fr - rr")} AS revenue_delta,
  {_big("ro")} AS raw_order_count, {_big("fo")} AS fact_order_count, {_big("fo - ro")} AS order_count_delta,
  {_big("rl")} AS raw_line_items, {_big("fl")} AS fact_line_items, {_big("fl - rl")} AS line_item_delta,
  {_status("abs(fr - rr) <= 100 AND fo = ro AND fl = rl", "FAIL — Revenue or row count mismatch")}
    AS reconciliation_status
FROM {_LAYERS}"""

_FEE_GAPS = "(SELECT abs(f.s - sp.fee) AS gap FROM (SELECT ok, sum(fee) AS s FROM fact GROUP BY ok) f JOIN sp ON f.ok = sp.ok)"
_DISC_GAPS = (
    "(SELECT abs(f.s - so.discount) AS gap FROM (SELECT ok, sum(disc) AS s FROM fact GROUP BY ok) f JOIN so ON f.ok = so.ok)"
)


def _gaps(source: str, name: str, passed: str, failed: str) -> str:
    bad = "count(*) FILTER (WHERE gap > 5)"
    return f"""
SELECT {_big("count(*)")} AS orders_checked, {_big(bad)} AS {name}, {_num("max(gap)", 100, 4)} AS max_rounding_error,
  {_status(f"{bad} = 0", failed, passed)} AS status
FROM {source}"""


_OUT["b27_reconcile_fee"] = _gaps(
    _FEE_GAPS,
    "orders_with_fee_mismatch",
    "PASS — All fee allocations sum correctly",
    "FAIL — Fee allocation mismatch (check multi-item orders)",
)
_OUT["b28_reconcile_discount"] = _gaps(
    _DISC_GAPS,
    "orders_with_discount_mismatch",
    "PASS — All discount allocations sum correctly",
    "FAIL — Discount allocation mismatch detected",
)


def _rules(table: str, name: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS {name}, {_big(f'count(*) FILTER (WHERE {bad})')} AS violations, "
        f"{_status(f'count(*) FILTER (WHERE {bad}) = 0')} AS status FROM {table}"
        for label, bad in rules.items()
    )


_OUT["b29_check_cac_rules"] = _rules(
    "fact",
    "rule_name",
    {
        "Repeat orders have zero CAC": "NOT first AND acq <> 0",
        "First orders have non-negative CAC": "first AND acq < 0",
        "No negative cac_allocation anywhere": "acq < 0",
    },
)
_OUT["b30_check_return_rules"] = _rules(
    "fact",
    "rule_name",
    {
        "Non-returned orders have zero return_cost": "NOT returned AND ret <> 0",
        "Returned orders have positive return_cost": "returned AND ret <= 0",
    },
)
_OUT["b31_check_cascade"] = _rules(
    "fact",
    "check_name",
    {
        "gross_profit = item_revenue - item_cogs": "abs(gross - (rev - cogs)) > 2",
        "CM = Revenue - COGS - Logistics - Fee - Disc - Returns": "abs(cm - (rev - cogs - log - fee - disc - ret)) > 2",
        "net_profit = contribution_margin - cac_allocation": "abs(net - (cm - acq)) > 2",
    },
)

_OUT["b32_sanity_summary"] = f"""
SELECT {_big("orders")} AS total_orders, {_big("customers")} AS total_customers, {_big("first_orders")} AS first_orders,
  {_num("rev")} AS total_revenue, {_num("cogs")} AS total_cogs, {_num("log")} AS total_logistics,
  {_num("fee")} AS total_payment_fees, {_num("disc")} AS total_discounts, {_num("ret")} AS total_return_costs,
  {_num("cm")} AS total_cm, {_num("acq")} AS total_cac, {_num("net")} AS total_net_profit,
  {_num(_pct("gross", "rev"))} AS gross_margin_pct, {_num(_pct("cm", "rev"))} AS cm_pct,
  {_num(_pct("net", "rev"))} AS net_margin_pct, {_num(_LEAKED)} AS total_leaked,
  {_num(_pct(_LEAKED, "rev"))} AS leakage_pct, {_big("leaks")} AS loss_making_line_items,
  {_big("returned_orders")} AS returned_orders
FROM wf"""

_REPORTS = {
    "rpt_category_profitability": ("r_category", ">= 1", "FAIL — Empty Report"),
    "rpt_loss_making_orders": ("r_loss", ">= 0", "FAIL"),
    "rpt_customer_profitability": ("r_customer", ">= 1", "FAIL — Empty Report"),
    "rpt_cac_by_channel": ("r_channel", ">= 1", "FAIL — Empty Report"),
    "rpt_profit_waterfall": ("r_waterfall", "= 1", "FAIL — Expected 1 row"),
}

_OUT["b33_report_completeness"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS report_table, {_big('count(*)')} AS row_count, {_status(f'count(*) {ok}', fail)} AS status FROM {table}"
    for name, (table, ok, fail) in _REPORTS.items()
)

_RAW_TABLES = {
    "orders": ("raw_orders", 420),
    "order_items": ("lines", 582),
    "order_payments": ("pay", 420),
    "customers": ("cust", 180),
    "products": ("prod", 12),
    "marketing_qualified_leads": ("leads", 4000),
    "closed_deals": ("deals", 600),
}

_OUT["b34_check_min_rows"] = "\nUNION ALL\n".join(
    f"SELECT 'raw.{name}' AS table_name, {_big('count(*)')} AS actual_rows, {_big(str(floor))} AS expected_min, "
    f"{_status(f'count(*) >= {floor}')} AS status FROM {table}"
    for name, (table, floor) in _RAW_TABLES.items()
)

_OUT["b35_check_not_null"] = "\nUNION ALL\n".join(
    f"SELECT 'raw.{label}' AS column_check, {_big(f'count(*) FILTER (WHERE {column} IS NULL)')} AS null_count, "
    f"{_status(f'count(*) FILTER (WHERE {column} IS NULL) = 0')} AS status FROM {table}"
    for label, table, column in [
        ("orders.order_id", "raw_orders", "ok"),
        ("orders.customer_id", "raw_orders", "ck"),
        ("order_items.order_id", "lines", "ok"),
        ("order_items.product_id", "lines", "l_partkey"),
        ("order_items.price", "lines", "price"),
        ("products.estimated_cost_ratio", "prod", "ratio"),
        ("customers.acquisition_channel", "cust", "acquired"),
    ]
)

_OUT["b36_check_staging_filter"] = _rules(
    "so",
    "check_name",
    {
        "No canceled orders in stg_orders": "status = 'canceled'",
        "No in-transit orders in stg_orders": "status = 'shipped'",
        "All stg_orders have an order_date": "day IS NULL",
        "stg_orders customer_order_seq starts at 1": "seq < 1 OR seq IS NULL",
    },
)
_OUT["b37_check_cogs"] = (
    _rules(
        "si",
        "check_name",
        {
            "stg_order_items: no NULL unit_cogs": "cogs IS NULL",
            "stg_order_items: unit_cogs < selling_price": "cogs >= price",
            "stg_order_items: gross_profit > 0 for all products": "gross <= 0",
        },
    )
    + "\nUNION ALL\n"
    + _rules("sp", "check_name", {"stg_order_payments: total_payment_fee >= 0": "fee < 0"})
)
_DUPLICATES = "count(*) - count(DISTINCT CAST(ok AS VARCHAR) || '-' || CAST(line AS VARCHAR))"
_OUT["b38_check_fact_integrity"] = (
    _rules(
        "fact",
        "check_name",
        {
            "fact: no NULL item_revenue": "rev IS NULL",
            "fact: no NULL contribution_margin": "cm IS NULL",
            "fact: no NULL net_profit": "net IS NULL",
            "fact: net_profit <= contribution_margin (CAC is non-negative)": "net > cm",
            "fact: CAC = 0 for non-first orders": "NOT first AND acq <> 0",
            "fact: return_cost = 0 for delivered orders": "NOT returned AND ret <> 0",
        },
    )
    + f"""
UNION ALL
SELECT 'fact: order_item_key is unique (no duplicates)' AS check_name, {_big(_DUPLICATES)} AS violations,
  {_status(f"{_DUPLICATES} = 0")} AS status FROM fact"""
)

_OUT["b39_business_sanity"] = f"""
SELECT {_big("orders")} AS total_orders, {_big("customers")} AS total_customers, {_num("rev")} AS total_revenue,
  {_num("net")} AS total_net_profit, {_num(_AVG_NET)} AS avg_net_margin_pct,
  {_big("returned_lines")} AS returned_items, {_num(_pct("losing", "lines"))} AS pct_items_losing_money
FROM wf"""

_HEADLINES = f"""
SELECT {_big("1")} AS check_no, 'Revenue matches raw source' AS check_name,
  {_status("abs(fr - rr) <= 100")} AS status FROM {_LAYERS}
UNION ALL SELECT 2, 'Payment fee allocation sums correctly', {_status("max(gap) <= 5")} FROM {_FEE_GAPS}
UNION ALL SELECT 3, 'No CAC on repeat orders', {_status("count(*) FILTER (WHERE NOT first AND acq <> 0) = 0")} FROM fact
UNION ALL SELECT 4, 'net_profit = CM - CAC (cascade integrity)',
  {_status("count(*) FILTER (WHERE abs(net - (cm - acq)) > 2) = 0")} FROM fact
UNION ALL SELECT 5, 'Return cost only on returned orders',
  {_status("count(*) FILTER (WHERE NOT returned AND ret <> 0) = 0")} FROM fact
UNION ALL SELECT 6, 'All 5 report tables populated', {_status("min(n) >= 1")} FROM (
  SELECT count(*) AS n FROM r_category UNION ALL SELECT count(*) FROM r_customer
  UNION ALL SELECT count(*) FROM r_channel UNION ALL SELECT count(*) FROM r_waterfall)"""

_OUT["b40_reconciliation_summary"] = _HEADLINES
_OUT["b40_overall_verdict"] = f"""
SELECT {_big("count(*)")} AS checks, {_big("count(*) FILTER (WHERE status <> 'PASS')")} AS failed,
  {_status("count(*) FILTER (WHERE status <> 'PASS') = 0")} AS verdict
FROM ({_HEADLINES})"""

_OUT["b41_load_raw"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{name}.csv' AS file, 'OK' AS status, {_big('count(*)')} AS row_count FROM {table}"
    for name, (table, _) in _RAW_TABLES.items()
)

_COUNTED = {
    "staging.stg_orders": "so",
    "staging.stg_order_items": "si",
    "staging.stg_order_payments": "sp",
    "staging.stg_products": "prod",
    "staging.stg_customers": "cust",
    "staging.stg_marketing_leads": "leads",
    "staging.stg_closed_deals": "deals",
    "staging.stg_channel_summary": "summary",
    "analytics.fact_order_items": "fact",
    "analytics.summary_by_month": "monthly",
    "analytics.rpt_category_profitability": "r_category",
    "analytics.rpt_loss_making_orders": "r_loss",
    "analytics.rpt_customer_profitability": "r_customer",
    "analytics.rpt_cac_by_channel": "r_channel",
    "analytics.rpt_profit_waterfall": "r_waterfall",
}
_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, {_big('count(*)')} AS row_count FROM {table}" for name, table in _COUNTED.items()
)
_OUT["b42_table_counts"] = _COUNTS

_OUT["b43_channel_cac_report"] = f"""
SELECT channel, {_big("customers")} AS new_customers, {_num("spend")} AS estimated_monthly_spend,
  {_num("cac")} AS estimated_cac
FROM summary ORDER BY cac DESC NULLS LAST"""
_OUT["b44_category_summary"] = """
SELECT category, total_revenue, total_net_profit, avg_net_margin_pct, leakage_pct, profitability_tier
FROM r_category ORDER BY total_net_profit DESC"""
_OUT["b45_channel_economics"] = """
SELECT channel, new_customers, estimated_cac, total_net_profit, avg_net_margin_pct, ltv_cac_ratio, channel_tier
FROM r_channel ORDER BY total_net_profit DESC"""

_OUT["b46_fact_explorer"] = f"""
SELECT {_KEYS}, CAST(ck AS VARCHAR) AS customer_id, CAST(pk AS VARCHAR) AS product_id, category,
  segment AS customer_segment, channel AS order_channel, {_day("day")} AS order_date, {_day("month")} AS order_month,
  strftime(day, '%b %Y') AS month_label, {_num("rev")} AS item_revenue, {_num("cogs")} AS item_cogs,
  {_num("log")} AS logistics_cost, {_num("fee")} AS payment_fee, {_num("disc")} AS discount_allocated,
  {_num("ret")} AS return_cost, {_num("gross")} AS gross_profit, {_num("gross_pct")} AS gross_margin_pct,
  {_num("cm")} AS contribution_margin, {_num("cm_pct")} AS contribution_margin_pct, {_num("acq")} AS cac_allocation,
  {_num("net")} AS net_profit, {_num("net_pct")} AS net_margin_pct, returned AS return_flag, first AS is_first_order,
  leak AS is_profit_leak, {_big("seq")} AS customer_order_seq
FROM fact ORDER BY order_date DESC"""

_OUT["b47_monthly_averages"] = f"""
SELECT CAST(sum(rev) AS DOUBLE) / 100 / count(rev) AS avg_monthly_revenue,
  CAST(sum(net) AS DOUBLE) / 100 / count(net) AS avg_monthly_profit,
  CAST(sum({_AVG_NET}) AS DOUBLE) / 100 / count({_AVG_NET}) AS avg_net_margin_pct,
  (SELECT strftime(month, '%b %Y') FROM monthly ORDER BY net DESC NULLS LAST, month LIMIT 1) AS best_month,
  (SELECT strftime(month, '%b %Y') FROM monthly ORDER BY net ASC NULLS LAST, month LIMIT 1) AS worst_month
FROM monthly"""

_BUCKETS = {
    "COGS": "cogs",
    "Logistics": "log",
    "Payment Fees": "fee",
    "Discounts": "disc",
    "Returns": "ret",
    "CAC": "acq",
    "Net Profit": "net",
}
_OUT["b48_leak_breakdown"] = "\nUNION ALL\n".join(
    f"SELECT {_big(str(i))} AS position, '{label}' AS label, {_double(c)} AS value, abs({_double(c)}) AS magnitude, "
    f"CASE WHEN rev <> 0 THEN ({_double(c)}) / ({_double('rev')}) * 100 ELSE 0.0 END AS pct_of_revenue FROM wf"
    for i, (label, c) in enumerate(_BUCKETS.items(), start=1)
)

_OUT["b49_quick_stats"] = f"""
SELECT {_big("count(DISTINCT ck)")} AS unique_customers,
  CAST(count(*) FILTER (WHERE returned) AS DOUBLE) / count(returned) * 100 AS return_rate_pct,
  {_big("count(*) FILTER (WHERE first)")} AS first_order_items,
  CAST(count(*) FILTER (WHERE first) AS DOUBLE) / count(*) * 100 AS first_order_items_pct,
  {_big("count(*) FILTER (WHERE leak)")} AS leak_items
FROM fact"""

_STEPS = [
    ("Revenue", "rev", "absolute", "1 *"),
    ("− COGS", "cogs", "relative", "-1 *"),
    ("− Logistics", "log", "relative", "-1 *"),
    ("− Payment Fees", "fee", "relative", "-1 *"),
    ("− Discounts", "disc", "relative", "-1 *"),
    ("− Returns", "ret", "relative", "-1 *"),
    ("Contribution Margin", "cm", "total", None),
    ("− CAC", "acq", "relative", "-1 *"),
    ("Net Profit", "net", "total", None),
]
_OUT["b50_waterfall_steps"] = "\nUNION ALL\n".join(
    f"SELECT {_big(str(i))} AS step, '{label}' AS label, '{kind}' AS measure, "
    f"{f'{sign} ({_double(c)})' if sign else 'CAST(NULL AS DOUBLE)'} AS value, {_double(c)} AS amount FROM wf"
    for i, (label, c, kind, sign) in enumerate(_STEPS, start=1)
)

_OUT["b51_run_all"] = _COUNTS

_OUT["b52_ordered_summary_by_month"] = "SELECT * FROM r_month ORDER BY order_month"
_OUT["b52_ordered_rpt_category_profitability"] = "SELECT * FROM r_category ORDER BY total_net_profit DESC"
_OUT["b52_ordered_rpt_customer_profitability"] = "SELECT * FROM r_customer ORDER BY total_net_profit DESC"
_OUT["b52_ordered_rpt_cac_by_channel"] = "SELECT * FROM r_channel ORDER BY total_net_profit DESC"
_OUT["b52_ordered_rpt_loss_making_orders"] = "SELECT * FROM r_loss ORDER BY order_net_profit"
_OUT["b52_ordered_rpt_profit_waterfall"] = "SELECT * FROM r_waterfall"

_OUT["q1_check_key"] = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS table_name, '{columns}' AS key_columns, {_big('coalesce(sum(n), 0)')} AS row_count,
  {_big('coalesce(sum(n) FILTER (WHERE k IS NULL), 0)')} AS null_keys,
  {_big('count(*) FILTER (WHERE n > 1 AND k IS NOT NULL)')} AS duplicate_keys,
  {_status('coalesce(sum(n) FILTER (WHERE k IS NULL), 0) = 0 AND count(*) FILTER (WHERE n > 1 AND k IS NOT NULL) = 0')}
    AS status
FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY {key})"""
    for name, columns, table, key in [
        ("stg_orders", "order_id", "so", "ok"),
        ("stg_order_payments", "order_id", "sp", "ok"),
        ("stg_products", "product_id", "prod", "pk"),
        ("stg_customers", "customer_id", "cust", "ck"),
        ("stg_channel_summary", "channel", "summary", "channel"),
        ("fact_order_items", "order_item_key", "fact", "CAST(ok AS VARCHAR) || '-' || CAST(line AS VARCHAR)"),
    ]
)


def _needed(sql: str, found: set[str]) -> set[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", sql))
    for name in words & _CTES.keys() - found:
        found.add(name)
        _needed(_CTES[name], found)
    return found


def _with_ctes(sql: str) -> str:
    needed = _needed(sql, set())
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items() if name in needed)
    return f"WITH {ctes}\n{sql}"


def oracle_sql() -> dict[str, str]:
    same_rows = {query: _OUT[other] for query, (_, other) in {**LOADED, **BUILT}.items()}
    same_rows |= {query: _OUT[other] for query, other in KEPT.items()}
    return {name: _with_ctes(sql) for name, sql in {**_OUT, **same_rows}.items()}
