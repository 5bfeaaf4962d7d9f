"""SQL of the registered queries, for DuckDB, over the same Parquet tables.

Written in the plain form: raw joins, EXISTS per class, UNION ALL per alert
kind. Ratios are rounded by integer arithmetic, so they are exact. Decimals are
shown as doubles and dates as text, as the Spark side shows them.
"""

from __future__ import annotations

import re

TODAY = "DATE '2001-11-04'"


def rdiv(num: str, den: str, digits: int) -> str:
    """num / den rounded half up to digits, exact; for num >= 0 and den > 0 whole numbers."""
    scaled = f"((2 * ({num}) * {10 ** digits} + ({den})) // (2 * ({den})))"
    unit = "0." + "0" * (digits - 1) + "1" if digits else "1"
    return f"(CAST({scaled} AS DECIMAL(22,0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})))"


def u(col: str) -> str:
    """A decimal(…,5) as a whole number of 1/100000 units."""
    return f"CAST({col} * 100000 AS HUGEINT)"


def d(expr: str, scale: int = 5) -> str:
    """A decimal as a double, through a decimal whose digits a double can hold."""
    return f"CAST(CAST({expr} AS DECIMAL(28,{scale})) AS DOUBLE)"


def text(expr: str, scale: int) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(28,{scale})) AS VARCHAR)"


def pct(part: str, whole: str, scale: int) -> str:
    return (
        f"COALESCE(CASE WHEN {whole} > 0 THEN"
        f" ROUND(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100, {scale}) END, 0.0)"
    )


def recent(days: int, alias: str = "") -> str:
    col = f"{alias}.sale_date" if alias else "sale_date"
    return f"{col} >= {TODAY} - {days} AND {col} <= {TODAY}"


CTES: dict[str, str] = {}

CTES["m_sales"] = f"""
SELECT l_orderkey AS doc_no, l_partkey AS product_id, l_suppkey AS warehouse_id,
  CAST({TODAY} - CAST(date_diff('day', CAST(l_shipdate AS DATE), {TODAY}) % 120 AS INTEGER) AS DATE)
    AS sale_date,
  CAST(l_quantity AS DECIMAL(15,5)) AS qty,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))
    AS DECIMAL(15,5)) AS amount,
  l_linenumber AS line_no
FROM lineitem"""
CTES["m_docs"] = """
SELECT s.*, o_orderstatus AS status FROM m_sales s JOIN orders ON o_orderkey = doc_no"""
CTES["m_warehouses"] = """
SELECT s_suppkey AS warehouse_id, s_name AS name,
  CASE WHEN s_suppkey % 5 = 0 THEN 'Reserva' ELSE 'Venta' END AS wtype,
  r_name AS region_id, s_suppkey % 20 = 1 AS is_dc, s_suppkey % 50 <> 7 AS active
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
CTES["m_regions"] = """
SELECT r_name AS region_id, 'Region ' || r_name AS name FROM region"""
CTES["m_brands"] = """
SELECT brand_id, 'Marca ' || CAST(n AS VARCHAR) AS name,
  CASE WHEN n <= 10 THEN 'PRINCIPAL' ELSE 'OTRAS' END AS category,
  substr('ABCD', n % 4 + 1, 1) AS abc_class,
  CASE WHEN n <= 10 THEN n * 7 END AS buy_every_days,
  CASE WHEN n <= 10 THEN CASE n % 3 WHEN 0 THEN 15 WHEN 1 THEN 30 ELSE 60 END END AS cover_days,
  CASE WHEN n <= 10 THEN CASE n % 3 WHEN 0 THEN 22 WHEN 1 THEN 10 ELSE 105 END END AS dc_lead
FROM (SELECT DISTINCT p_brand AS brand_id, CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part)"""
CTES["m_products"] = """
SELECT p_partkey AS product_id, 'C' || CAST(p_partkey + 1000 AS VARCHAR) AS code, p_name AS name,
  CASE WHEN p_partkey % 29 <> 0 THEN p_brand END AS brand_id FROM part"""
CTES["m_pb"] = """
SELECT p.product_id, p.name AS product_name, p.brand_id, b.name AS brand_name, b.category,
  b.abc_class, b.cover_days, b.dc_lead
FROM m_products p LEFT JOIN m_brands b ON b.brand_id = p.brand_id"""
CTES["m_stock"] = """
SELECT p AS product_id, s AS warehouse_id,
  CAST(CASE WHEN (7 * p + s) % 9 = 0 THEN 0
            WHEN p % 3 = 0 THEN (31 * p + 17 * s) % (4 + p % 40)
            ELSE (31 * p + 17 * s) % 240 END AS DECIMAL(15,5)) AS qty,
  CASE WHEN p % 13 = 0 THEN CAST(0 AS DECIMAL(15,5))
       ELSE CAST(CAST(p_retailprice AS DECIMAL(15,2)) * 0.6 AS DECIMAL(15,5)) END AS unit_cost,
  CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS DECIMAL(15,5)) AS unit_price,
  CASE p % 10 WHEN 0 THEN 'PROYECTOS' WHEN 1 THEN 'OUTLET' WHEN 2 THEN '  ' END AS stock_tag
FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem) JOIN part ON p_partkey = p
WHERE (p + s) % 11 <> 0"""
CTES["m_stock_daily"] = f"""
SELECT CAST({TODAY} - CAST(7 * k AS INTEGER) AS DATE) AS snapshot_date, warehouse_id, product_id,
  CAST(qty * (k + 1) AS DECIMAL(15,5)) AS qty, unit_cost, unit_price, stock_tag
FROM m_stock, (VALUES (0), (1), (2), (3)) w(k)"""
CTES["m_lookback"] = f"""
SELECT v.product_id, v.warehouse_id,
  SUM(CASE WHEN {recent(7, 'v')} THEN qty ELSE 0 END) AS q7,
  SUM(CASE WHEN {recent(30, 'v')} THEN qty ELSE 0 END) AS q30,
  SUM(qty) AS q90,
  COUNT(*) FILTER (WHERE {recent(30, 'v')}) AS sales_rows_30d
FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id AND w.wtype = 'Venta'
WHERE {recent(90, 'v')} GROUP BY ALL"""
CTES["m_enriched"] = """
SELECT s.product_id, s.warehouse_id, s.qty AS stock, s.qty * s.unit_cost AS raw_value,
  COALESCE(k.q7, 0) AS q7, COALESCE(k.q30, 0) AS q30, COALESCE(k.q90, 0) AS q90,
  COALESCE(k.sales_rows_30d, 0) AS sales_rows_30d,
  COALESCE(pb.cover_days, 30) AS cover, COALESCE(pb.dc_lead, 15) AS lead_days
FROM m_stock s
LEFT JOIN m_lookback k ON k.product_id = s.product_id AND k.warehouse_id = s.warehouse_id
LEFT JOIN m_pb pb ON pb.product_id = s.product_id
WHERE s.qty > 0"""
CTES["m_rated"] = f"""
SELECT *, CAST(raw_value AS DECIMAL(18,2)) AS stock_value,
  CAST({rdiv(u('q30'), '30', 0)} AS DECIMAL(22,0)) * 0.00001 AS daily,
  CASE WHEN q30 > 0 THEN {rdiv(u('stock') + ' * 30', u('q30'), 2)} ELSE 9999 END AS days_of_stock,
  {rdiv(u('q30'), u('stock'), 4)} AS turn,
  {rdiv(u('q30') + ' * lead_days * 12', '30000000', 2)} AS reorder_point,
  {rdiv(u('q30') + ' * 7', '3000000', 2)} AS safety_stock,
  {rdiv(u('q30') + ' * cover', '3000000', 2)} AS stock_max
FROM m_enriched"""
CTES["m_metrics"] = """
SELECT *, stock_state IN ('CRITICO', 'BAJO', 'EXCESO') AS needs_transfer,
  stock_state IN ('CRITICO', 'BAJO') AS needs_purchase
FROM (SELECT *, CASE WHEN dd < 3 THEN 'CRITICO' WHEN dd < 7 THEN 'BAJO' WHEN dd < 15 THEN 'MEDIO'
        WHEN dd > cover * 1.5 THEN 'EXCESO' WHEN dd > cover THEN 'SOBRE' ELSE 'NORMAL' END AS stock_state
      FROM (SELECT *, CASE WHEN days_of_stock = 0 THEN 9999 ELSE days_of_stock END AS dd FROM m_rated))"""

A_COLS = "product_id, warehouse_id, stock, days_of_stock, daily, category, abc_class, message"
CTES["m_named"] = """
SELECT m.*, pb.category, pb.abc_class, pb.cover_days, w.wtype, w.region_id
FROM m_metrics m JOIN m_pb pb ON pb.product_id = m.product_id
JOIN m_warehouses w ON w.warehouse_id = m.warehouse_id"""
CTES["a_low"] = f"""
SELECT CASE WHEN days_of_stock < 3 THEN 'STOCK_CRITICO' WHEN days_of_stock < 7 THEN 'STOCK_BAJO'
         ELSE 'STOCK_MEDIO' END AS alert_type,
  CASE WHEN days_of_stock < 3 THEN 'CRITICO' WHEN days_of_stock < 7 THEN 'ALTO' ELSE 'MEDIO' END AS level,
  product_id, warehouse_id, stock, days_of_stock, daily, category, abc_class,
  'Stock para ' || {text('days_of_stock', 1)} || ' días. Venta diaria: ' || {text('daily', 2)}
    || ' uds. Se recomienda reabastecer.' AS message
FROM m_named WHERE wtype = 'Venta' AND days_of_stock < 15 AND daily > 0"""
CTES["a_over"] = f"""
SELECT 'SOBREINVENTARIO' AS alert_type,
  CASE WHEN days_of_stock > 2 * stock_max THEN 'ALTO' ELSE 'MEDIO' END AS level,
  product_id, warehouse_id, stock, days_of_stock, daily, category, abc_class,
  'Stock para ' || {text('days_of_stock', 0)} || ' días (objetivo: '
    || CAST(COALESCE(cover_days, 30) AS VARCHAR)
    || '). Considerar traslado a otro almacén.' AS message
FROM m_named WHERE days_of_stock > COALESCE(cover_days, 30) * 1.5 AND daily > 0"""
CTES["a_slow"] = f"""
SELECT 'BAJA_ROTACION' AS alert_type, CASE WHEN q90 = 0 THEN 'ALTO' ELSE 'MEDIO' END AS level,
  product_id, warehouse_id, stock, days_of_stock, daily, category, abc_class,
  CASE WHEN q90 = 0 THEN 'Sin movimiento en 90 días. Valor en stock: $' || {text('stock_value', 0)}
    ELSE 'Solo ' || {text('q90', 5)} || ' uds vendidas en 90 días. Evaluar promoción o descontinuar.'
  END AS message
FROM m_named WHERE stock > 0 AND (q90 < 3 OR turn < 0.5) AND abc_class <> 'D'"""
CTES["a_no_rotation"] = f"""
SELECT 'SIN_ROTACION' AS alert_type, CASE WHEN q90 = 0 THEN 'ALTO' ELSE 'MEDIO' END AS level,
  product_id, warehouse_id, stock, days_of_stock, daily, category, abc_class,
  'Sin ventas en 30 días. Stock: ' || {text('stock', 0)} || ' uds. Valor: $' || {text('stock_value', 0)}
    || '. Evaluar promoción/oferta o redistribución.' AS message
FROM m_named m WHERE wtype = 'Venta' AND stock > 0 AND daily = 0
  AND NOT EXISTS (SELECT 1 FROM m_sales v WHERE v.product_id = m.product_id
    AND v.warehouse_id = m.warehouse_id AND {recent(30, 'v')})"""
CTES["m_sold30"] = f"""
SELECT v.product_id, v.warehouse_id, SUM(v.qty) AS q30, SUM(v.amount) AS amount
FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id AND w.wtype = 'Venta'
WHERE {recent(30, 'v')} GROUP BY ALL HAVING SUM(v.qty) > 0"""
CTES["a_stockout"] = f"""
SELECT 'STOCK_AGOTADO' AS alert_type,
  CASE WHEN k.q30 >= 30 THEN 'CRITICO' WHEN k.q30 >= 9 THEN 'ALTO' ELSE 'MEDIO' END AS level,
  k.product_id, k.warehouse_id, COALESCE(s.qty, 0) AS stock, 0 AS days_of_stock,
  CAST({rdiv(u('k.q30'), '30', 0)} AS DECIMAL(22,0)) * 0.00001 AS daily, pb.category, pb.abc_class,
  'Agotado con demanda activa. Venta diaria: ' || {text(rdiv(u('k.q30'), '3000000', 2), 2)}
    || ' uds (' || {text('k.q30', 5)} || ' en 30d). Reabastecer urgente.' AS message
FROM m_sold30 k JOIN m_pb pb ON pb.product_id = k.product_id
LEFT JOIN m_stock s ON s.product_id = k.product_id AND s.warehouse_id = k.warehouse_id
WHERE COALESCE(s.qty, 0) = 0"""
CTES["a_all"] = " UNION ALL ".join(
    f"SELECT * FROM {k}" for k in ("a_low", "a_over", "a_slow", "a_no_rotation", "a_stockout")
)
CTES["a_stored"] = """
SELECT *, CASE WHEN product_id % 7 = 0 THEN 'ATENDIDA' ELSE 'PENDIENTE' END AS state,
  '2001-11-04' AS generated_on FROM a_all"""
CTES["a_pending"] = "SELECT * FROM a_stored WHERE state = 'PENDIENTE'"
CTES["a_unmoved"] = f"""
SELECT 'SIN_ROTACION' AS alert_type,
  CASE WHEN NOT EXISTS (SELECT 1 FROM m_sales v WHERE v.product_id = s.product_id
    AND v.warehouse_id = s.warehouse_id AND {recent(90, 'v')}) THEN 'ALTO' ELSE 'MEDIO' END AS level,
  s.product_id, s.warehouse_id, s.qty AS stock,
  'Sin ventas en 30 días. Stock: ' || {text('s.qty', 0)} || ' uds. Valor: $'
    || {text('s.qty * s.unit_cost', 0)} || '. Evaluar promoción/oferta o redistribución.' AS message
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id AND w.wtype = 'Venta'
WHERE s.qty > 0 AND NOT EXISTS (SELECT 1 FROM m_sales v WHERE v.product_id = s.product_id
  AND v.warehouse_id = s.warehouse_id AND {recent(30, 'v')})"""

CTES["t_needs"] = """
SELECT product_id, warehouse_id AS to_id, region_id AS to_region, days_of_stock AS days_to,
  GREATEST(reorder_point - stock, 0) AS needed, category, abc_class
FROM m_named WHERE wtype = 'Venta' AND days_of_stock < 15 AND daily > 0"""
CTES["t_surplus"] = """
SELECT product_id, warehouse_id AS from_id, days_of_stock AS days_from,
  GREATEST(stock - stock_max, 0) AS available
FROM m_named WHERE stock > stock_max AND stock > 0"""
CTES["t_all"] = """
SELECT n.product_id, e.from_id, n.to_id, n.to_region, LEAST(e.available, n.needed) AS qty,
  e.days_from, n.days_to, n.category, n.abc_class,
  CASE WHEN n.days_to < 3 AND n.category = 'PRINCIPAL' AND n.abc_class = 'A' THEN 'URGENTE'
       WHEN n.days_to < 7 AND n.category = 'PRINCIPAL' THEN 'ALTA'
       WHEN n.days_to < 15 THEN 'MEDIA' ELSE 'BAJA' END AS priority
FROM t_needs n JOIN t_surplus e ON e.product_id = n.product_id AND e.from_id <> n.to_id
WHERE LEAST(e.available, n.needed) > 0"""
CTES["t_stored"] = """
SELECT *, CASE WHEN product_id % 7 = 0 THEN 'ATENDIDA' ELSE 'PENDIENTE' END AS state,
  '2001-11-04' AS generated_on FROM t_all"""

CTES["e_stock"] = """
SELECT product_id, SUM(qty) AS stock_network,
  CAST(SUM(unit_cost) AS DOUBLE) / COUNT(unit_cost) AS unit_cost FROM m_stock GROUP BY product_id"""
CTES["e_sales"] = f"""
SELECT v.product_id, SUM(v.qty) AS q30
FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id AND w.wtype = 'Venta'
WHERE {recent(30, 'v')} GROUP BY v.product_id"""
CTES["e_coverage"] = f"""
SELECT p.*, k.q30, COALESCE(s.stock_network, 0) AS stock_network,
  COALESCE(s.unit_cost, 0) AS unit_cost,
  {rdiv(u('COALESCE(s.stock_network, 0)') + ' * 30', u('k.q30'), 2)} AS cover_now
FROM m_pb p JOIN e_sales k ON k.product_id = p.product_id
LEFT JOIN e_stock s ON s.product_id = p.product_id WHERE k.q30 > 0"""
CTES["e_short"] = f"""
SELECT *, {u('q30')} * (cover_days + dc_lead) - {u('stock_network')} * 30 AS lack30
FROM e_coverage WHERE cover_now < cover_days + dc_lead AND category = 'PRINCIPAL'"""
CTES["e_purchases"] = f"""
SELECT * FROM (SELECT *, CASE WHEN lack30 > 0 THEN {rdiv('lack30', '3000000', 0)} ELSE 0 END AS buy_qty,
  CAST({TODAY} + CAST(FLOOR(GREATEST(cover_now - dc_lead - 7, 0)) AS INTEGER) AS DATE) AS order_date,
  CASE WHEN cover_now < dc_lead THEN 'URGENTE' WHEN cover_now < dc_lead + 7 THEN 'ALTA'
       WHEN cover_now < cover_days THEN 'MEDIA' ELSE 'BAJA' END AS priority
FROM e_short) WHERE buy_qty > 0"""
CTES["e_projects"] = "SELECT DISTINCT product_id FROM m_stock WHERE stock_tag = 'PROYECTOS'"
CTES["e_cost"] = """
SELECT product_id, CAST(SUM(unit_cost) AS DOUBLE) / COUNT(*) AS stock_cost
FROM m_stock WHERE unit_cost > 0 GROUP BY product_id"""
CTES["e_paid"] = f"""
SELECT product_id, ROUND(CAST(SUM(amount) AS DOUBLE) / CAST(SUM(qty) AS DOUBLE)) AS sale_cost
FROM m_sales WHERE {recent(30)} AND qty > 0 GROUP BY product_id"""
CTES["e_live_all"] = f"""
SELECT p.product_id, p.product_name, p.brand_name, p.category, p.abc_class,
  COALESCE(s.stock_network, 0) AS stock_network, k.q30,
  COALESCE(p.cover_days, 30) AS cover, COALESCE(p.dc_lead, 15) AS lead_days,
  COALESCE(c.stock_cost, v.sale_cost, 0) AS unit_cost
FROM e_sales k JOIN m_pb p ON p.product_id = k.product_id
LEFT JOIN e_stock s ON s.product_id = k.product_id
LEFT JOIN e_cost c ON c.product_id = k.product_id
LEFT JOIN e_paid v ON v.product_id = k.product_id
WHERE k.q30 > 0 AND NOT EXISTS (SELECT 1 FROM e_projects x WHERE x.product_id = k.product_id)"""
CTES["e_live"] = f"""
SELECT *, CAST((({u('q30')} * (cover + lead_days) - {u('stock_network')} * 30) + 2999999)
    // 3000000 AS DOUBLE) AS buy_qty,
  CASE WHEN stock_network = 0 OR stock_network * 30 < lead_days * q30 THEN 'URGENTE'
       WHEN stock_network * 30 < (lead_days + 7) * q30 THEN 'ALTA'
       WHEN stock_network * 30 < cover * q30 THEN 'MEDIA' ELSE 'BAJA' END AS priority,
  {rdiv(u('stock_network') + ' * 30', u('q30'), 1)} AS cover_now
FROM e_live_all WHERE stock_network * 30 < (cover + lead_days) * q30"""

Q: dict[str, str] = {}

# --- metrics -------------------------------------------------------------------
Q["sales_lookback"] = f"""
SELECT product_id, warehouse_id, {d('q7')} AS q7, {d('q30')} AS q30, {d('q90')} AS q90, sales_rows_30d
FROM m_lookback"""
Q["stock_metrics"] = f"""
SELECT '2001-11-04' AS calc_date, product_id, warehouse_id, {d('stock')} AS stock,
  {d('stock_value')} AS stock_value, {d('q7')} AS q7, {d('q30')} AS q30, {d('q90')} AS q90,
  sales_rows_30d, {d('daily')} AS daily, {d('days_of_stock')} AS days_of_stock, {d('turn')} AS turn,
  {d('reorder_point')} AS reorder_point, {d('safety_stock')} AS safety_stock,
  {d('stock_max')} AS stock_max, stock_state, needs_transfer, needs_purchase
FROM m_metrics"""
Q["network_metrics"] = f"""
WITH held AS (
  SELECT s.product_id, SUM(qty) AS stock, CAST(SUM(qty * unit_cost) AS DECIMAL(18,2)) AS stock_value,
    COALESCE(SUM(CASE WHEN wtype = 'Venta' THEN qty END), 0) AS sp_stock,
    COUNT(*) FILTER (WHERE qty > 0) AS with_stock,
    COUNT(*) FILTER (WHERE qty > 0 AND wtype = 'Venta') AS sp_with,
    COUNT(*) FILTER (WHERE qty <= 0 AND wtype = 'Venta') AS sp_without,
    stddev_pop(CAST(qty AS DOUBLE)) AS spread
  FROM m_stock s LEFT JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id GROUP BY s.product_id),
sold AS (
  SELECT v.product_id, SUM(qty) AS q30, SUM(amount) AS amount
  FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id AND w.wtype = 'Venta'
  WHERE {recent(30, 'v')} GROUP BY v.product_id),
ranked AS (
  SELECT a.product_id, a.q30,
    COALESCE((SELECT SUM(b.amount) FROM sold b WHERE b.amount > a.amount), 0) AS larger,
    (SELECT SUM(amount) FROM sold) AS grand
  FROM sold a),
base AS (
  SELECT h.*, COALESCE(r.q30, 0) AS q30,
    CASE WHEN CAST(larger AS DOUBLE) / CAST(grand AS DOUBLE) < 0.8 THEN 'A'
         WHEN CAST(larger AS DOUBLE) / CAST(grand AS DOUBLE) < 0.95 THEN 'B' ELSE 'C' END AS abc_class
  FROM held h LEFT JOIN ranked r ON r.product_id = h.product_id),
rated AS (
  SELECT *, CASE WHEN q30 > 0 THEN {rdiv(u('stock') + ' * 30', u('q30'), 2)} ELSE 9999 END AS dos
  FROM base)
SELECT '2001-11-04' AS calc_date, product_id, {d('stock')} AS stock, {d('stock_value')} AS stock_value,
  {d('sp_stock')} AS sales_point_stock, with_stock AS warehouses_with_stock,
  sp_with AS sales_points_with_stock, sp_without AS sales_points_without_stock,
  {d('ROUND(spread, 4)', 4)} AS stock_spread, {d('q30')} AS q30,
  {d(rdiv(u('q30'), '3000000', 5))} AS daily, {d('dos')} AS days_of_stock,
  {d("CASE WHEN stock > 0 THEN " + rdiv(u('q30'), u('stock'), 4) + " ELSE 0 END")} AS turn,
  abc_class,
  CASE WHEN dd < 3 THEN 'CRITICO' WHEN dd < 7 THEN 'BAJO' WHEN dd < 15 THEN 'MEDIO'
       WHEN dd > 45 THEN 'EXCESO' WHEN dd > 30 THEN 'SOBRE' ELSE 'NORMAL' END AS stock_state
FROM (SELECT *, CASE WHEN dos = 0 THEN 9999 ELSE dos END AS dd FROM rated)"""
Q["region_metrics"] = f"""
WITH sp AS (SELECT * FROM m_warehouses WHERE wtype = 'Venta'),
pairs AS (SELECT region_id, product_id, SUM(qty) AS qty, SUM(qty * unit_cost) AS value
          FROM m_stock JOIN sp USING (warehouse_id) GROUP BY ALL)
SELECT '2001-11-04' AS calc_date, r.region_id,
  {d("COALESCE((SELECT CAST(SUM(value) AS DECIMAL(18,2)) FROM pairs p WHERE p.region_id = r.region_id), 0)")}
    AS stock_value,
  {d(f"COALESCE((SELECT CAST(SUM(v.amount) AS DECIMAL(18,2)) FROM m_sales v JOIN sp USING (warehouse_id) WHERE sp.region_id = r.region_id AND {recent(30, 'v')}), 0)")}
    AS sales_value_30d,
  (SELECT COUNT(*) FROM pairs p WHERE p.region_id = r.region_id AND qty > 0) AS products_in_stock,
  (SELECT COUNT(*) FROM pairs p WHERE p.region_id = r.region_id AND qty <= 0) AS products_out_of_stock,
  (SELECT COUNT(DISTINCT product_id) FROM m_named m WHERE m.region_id = r.region_id
     AND wtype = 'Venta' AND stock_state = 'CRITICO') AS critical_products,
  (SELECT COUNT(DISTINCT product_id) FROM m_named m WHERE m.region_id = r.region_id
     AND wtype = 'Venta' AND stock_state IN ('SOBRE', 'EXCESO')) AS overstocked_products,
  COALESCE((SELECT ROUND(CAST(SUM(turn) AS DOUBLE) / COUNT(*), 4) FROM m_named m
     WHERE m.region_id = r.region_id AND wtype = 'Venta'), 0.0) AS mean_turn,
  COALESCE((SELECT ROUND(CAST(SUM(v.qty) AS DOUBLE) /
       (SELECT CAST(SUM(qty) AS DOUBLE) FROM pairs p WHERE p.region_id = r.region_id) * 100, 4)
     FROM m_sales v JOIN sp USING (warehouse_id)
     WHERE sp.region_id = r.region_id AND {recent(30, 'v')}), 0.0) AS sold_over_available_pct
FROM m_regions r"""

# --- alerts --------------------------------------------------------------------
A_OUT = (
    f"alert_type, level, product_id, warehouse_id, {d('stock')} AS stock,"
    f" {d('days_of_stock')} AS days_of_stock, {d('daily')} AS daily, category, abc_class, message"
)
for kind in ("low", "over", "slow", "no_rotation", "stockout", "all"):
    Q[f"alerts_{kind}"] = f"SELECT {A_OUT} FROM a_{kind}"
Q["alert_counts"] = """
SELECT (SELECT COUNT(*) FROM a_low) AS low, (SELECT COUNT(*) FROM a_over) AS over,
  (SELECT COUNT(*) FROM a_slow) AS slow, (SELECT COUNT(*) FROM a_no_rotation) AS no_rotation,
  (SELECT COUNT(*) FROM a_stockout) AS stockout, (SELECT COUNT(*) FROM a_all) AS total"""
Q["alerts_rebuild"] = f"""
SELECT {A_OUT}, state, generated_on FROM a_stored
WHERE NOT (alert_type = 'SIN_ROTACION' AND state = 'PENDIENTE')
UNION ALL
SELECT alert_type, level, product_id, warehouse_id, {d('stock')}, 9999.0, 0.0, NULL, NULL, message,
  'PENDIENTE', '2001-11-04' FROM a_unmoved"""
Q["alerts_rebuild_counts"] = """
SELECT (SELECT COUNT(*) FROM a_pending WHERE alert_type = 'SIN_ROTACION') AS deleted,
  (SELECT COUNT(*) FROM a_unmoved) AS inserted"""

# --- transfers -----------------------------------------------------------------
Q["transfer_needs"] = f"""
SELECT product_id, to_id, to_region, {d('days_to')} AS days_to, {d('needed')} AS needed, category,
  abc_class FROM t_needs"""
Q["transfer_surplus"] = f"""
SELECT product_id, from_id, {d('days_from')} AS days_from, {d('available')} AS available FROM t_surplus"""
T_OUT = (
    f"product_id, from_id, to_id, to_region, {d('qty')} AS qty, {d('days_from')} AS days_from,"
    f" {d('days_to')} AS days_to, category, abc_class, priority"
)
Q["transfers"] = f"SELECT {T_OUT} FROM t_all"
Q["transfers_ordered"] = f"""
SELECT {T_OUT}, CASE WHEN category = 'PRINCIPAL' AND abc_class = 'A' THEN 1
  WHEN category = 'PRINCIPAL' THEN 2 ELSE 3 END AS brand_rank FROM t_all
ORDER BY brand_rank, days_to, product_id, to_id, from_id"""
Q["transfers_first"] = f"""
SELECT {T_OUT} FROM t_all
ORDER BY CASE WHEN category = 'PRINCIPAL' AND abc_class = 'A' THEN 1 WHEN category = 'PRINCIPAL' THEN 2 ELSE 3 END,
  days_to, product_id, to_id, from_id LIMIT 100"""
Q["transfer_counts"] = """
SELECT product_id, to_region, COUNT(*) AS transfers FROM t_all GROUP BY product_id, to_region"""

# --- purchases -----------------------------------------------------------------
Q["network_stock"] = f"""
SELECT product_id, {d('stock_network')} AS stock_network, ROUND(unit_cost, 6) AS unit_cost FROM e_stock"""
Q["network_sales"] = f"""
SELECT product_id, {d('q30')} AS q30, {d(rdiv(u('q30'), '3000000', 5))} AS daily FROM e_sales"""
Q["coverage"] = f"""
SELECT product_id, {d('q30')} AS q30, {d(rdiv(u('q30'), '3000000', 5))} AS daily, product_name, brand_id,
  brand_name, category, abc_class, cover_days, dc_lead, {d('stock_network')} AS stock_network,
  ROUND(unit_cost, 6) AS unit_cost, {d('cover_now')} AS cover_now FROM e_coverage"""
E_COLS = (
    f"{d('stock_network')} AS stock_network, {d('q30')} AS projected, CAST(buy_qty AS DOUBLE) AS qty,"
    f" {d('cover_now')} AS cover_now, cover_days AS cover_target, ROUND(unit_cost, 5) AS unit_cost,"
    " ROUND(CAST(buy_qty AS DOUBLE) * unit_cost, 2) AS purchase_value,"
    " CAST(order_date AS VARCHAR) AS order_date, priority"
)
Q["purchases"] = f"SELECT product_id, brand_id, category, abc_class, {E_COLS} FROM e_purchases"
Q["purchases_list"] = f"""
SELECT product_id, product_name, brand_name, category, abc_class, {E_COLS}, 'PENDIENTE' AS state
FROM e_purchases e ORDER BY e.priority, e.cover_now, product_id LIMIT 50"""
L_OUT = (
    f"product_id, product_name, brand_name, category, abc_class, {d('stock_network')} AS stock_network,"
    f" {d('q30')} AS projected, buy_qty AS qty, {d('cover_now')} AS cover_now, cover AS cover_target,"
    " ROUND(unit_cost, 4) AS unit_cost, ROUND(buy_qty * unit_cost, 2) AS purchase_value,"
    " CAST(NULL AS VARCHAR) AS order_date, priority, 'CALCULADO' AS state"
)
Q["purchases_live"] = f"SELECT {L_OUT} FROM e_live"
Q["purchases_live_top"] = f"""
SELECT {L_OUT} FROM e_live e WHERE priority = 'URGENTE' AND EXISTS (SELECT 1 FROM m_stock t
  WHERE t.product_id = e.product_id AND (COALESCE(stock_tag, '') = '' OR stock_tag IN ('OUTLET')))
ORDER BY CASE WHEN e.stock_network = 0 THEN 0 ELSE 1 END,
  CASE WHEN category = 'PRINCIPAL' THEN 0 ELSE 1 END,
  CASE abc_class WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 4 END, e.cover_now, product_id
LIMIT 50"""

# --- indicators ----------------------------------------------------------------
MIX_PLACE = "w.region_id IN ('ASIA', 'EUROPE', 'AFRICA')"
MIX_BRANDS = "p.brand_id IN ('Brand#1', 'Brand#2', 'Brand#12')"
PLAIN = "COALESCE({}.stock_tag, '') = ''"
MIX_PRODUCT = "EXISTS (SELECT 1 FROM m_stock t WHERE t.product_id = {}.product_id AND COALESCE(t.stock_tag, '') = '')"
INV = f"""
SELECT COUNT(DISTINCT s.product_id) AS products, COUNT(DISTINCT s.warehouse_id) AS warehouses,
  {d('COALESCE(SUM(s.qty), 0)')} AS units, {d('COALESCE(SUM(s.qty * s.unit_cost), 0)')} AS stock_value
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id AND w.wtype = 'Venta'"""
Q["kpi_inventory"] = INV
Q["kpi_inventory_filtered"] = f"""{INV} JOIN m_products p ON p.product_id = s.product_id
WHERE {MIX_PLACE} AND {MIX_BRANDS} AND {PLAIN.format('s')}"""
Q["kpi_projects"] = f"""
SELECT COUNT(DISTINCT CAST(s.product_id AS VARCHAR) || '-' || CAST(s.warehouse_id AS VARCHAR)) AS items,
  {d('COALESCE(SUM(s.qty), 0)')} AS units, {d('COALESCE(SUM(s.qty * s.unit_cost), 0)')} AS stock_value
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id AND w.wtype = 'Venta'
WHERE s.stock_tag = 'PROYECTOS' AND s.qty > 0"""
KS = f"""
SELECT COUNT(*) AS sales_rows, {d('COALESCE(SUM(v.qty), 0)')} AS units,
  {d('COALESCE(SUM(v.amount), 0)')} AS amount
FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id WHERE {recent(30, 'v')}"""
Q["kpi_sales"] = KS
Q["kpi_sales_filtered"] = f"{KS} AND {MIX_PLACE} AND {MIX_PRODUCT.format('v')}"
Q["kpi_alerts"] = """
SELECT COUNT(*) FILTER (WHERE alert_type = 'STOCK_CRITICO') AS critical,
  COUNT(*) FILTER (WHERE alert_type = 'STOCK_BAJO') AS low,
  COUNT(*) FILTER (WHERE alert_type = 'SOBREINVENTARIO') AS over,
  COUNT(*) FILTER (WHERE alert_type = 'SIN_ROTACION') AS no_rotation,
  COUNT(*) FILTER (WHERE alert_type = 'STOCK_AGOTADO') AS stockout, COUNT(*) AS total
FROM a_pending a JOIN m_warehouses w ON w.warehouse_id = a.warehouse_id
WHERE EXISTS (SELECT 1 FROM m_stock t WHERE t.product_id = a.product_id
  AND t.warehouse_id = a.warehouse_id AND (COALESCE(stock_tag, '') = '' OR stock_tag IN ('OUTLET')))"""
Q["kpi_transfers"] = """
SELECT COUNT(*) AS pending FROM t_stored
WHERE state = 'PENDIENTE' AND to_region IN ('ASIA', 'EUROPE')"""
Q["kpi_transfers_live"] = "SELECT COUNT(*) AS pending FROM t_all WHERE to_region IN ('ASIA', 'EUROPE')"
Q["kpi_purchases"] = f"""
SELECT COUNT(*) AS purchases, {d('COALESCE(SUM(CAST(ROUND(CAST(buy_qty AS DOUBLE) * unit_cost, 2) AS DECIMAL(18,2))), 0)')}
  AS purchase_value FROM e_purchases"""
Q["kpi_purchases_live"] = f"""
SELECT COUNT(*) AS purchases, ROUND(COALESCE(SUM(GREATEST(
    ({u('k.q30')} * 45 - {u('COALESCE(s.stock_network, 0)')} * 30 + 2999999) // 3000000, 0)
  * COALESCE(c.stock_cost, v.sale_cost, 0)), 0), 2) AS purchase_value
FROM e_sales k LEFT JOIN e_stock s ON s.product_id = k.product_id
LEFT JOIN e_cost c ON c.product_id = k.product_id LEFT JOIN e_paid v ON v.product_id = k.product_id
WHERE k.q30 > 0 AND COALESCE(s.stock_network, 0) * 30 < 45 * k.q30
  AND NOT EXISTS (SELECT 1 FROM e_projects x WHERE x.product_id = k.product_id)"""


def _flag(kind: str) -> str:
    return (
        "EXISTS (SELECT 1 FROM a_pending a WHERE a.product_id = s.product_id"
        f" AND a.warehouse_id = s.warehouse_id AND a.alert_type = '{kind}')"
    )


_SOLD = (
    "EXISTS (SELECT 1 FROM m_sales v WHERE v.product_id = s.product_id"
    f" AND v.warehouse_id = s.warehouse_id AND {recent(30, 'v')})"
)
for name, extra in (
    ("h_items", ""),
    ("h_items_mixed", f" AND {MIX_PLACE} AND {MIX_BRANDS} AND {PLAIN.format('s')}"),
):
    CTES[name] = f"""
SELECT s.product_id, s.warehouse_id, s.qty * s.unit_cost AS value,
  CASE WHEN s.qty = 0 AND {_SOLD} THEN 1 WHEN {_flag('STOCK_CRITICO')} THEN 2
       WHEN {_flag('STOCK_BAJO')} THEN 3 WHEN {_flag('SOBREINVENTARIO')} THEN 4
       WHEN {_flag('BAJA_ROTACION')} THEN 5 WHEN s.qty > 0 AND NOT {_SOLD} THEN 6
       WHEN s.qty > 0 THEN 7 ELSE 6 END AS grade
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id AND w.wtype = 'Venta'
JOIN m_products p ON p.product_id = s.product_id WHERE s.qty >= 0{extra}"""
H_NAME = (
    "CASE grade WHEN 1 THEN 'agotado' WHEN 2 THEN 'critico' WHEN 3 THEN 'bajo'"
    " WHEN 4 THEN 'sobreinventario' WHEN 5 THEN 'baja_rotacion' WHEN 6 THEN 'sin_rotacion'"
    " ELSE 'sano' END"
)
for name, items in (("h_health", "h_items"), ("h_health_mixed", "h_items_mixed")):
    CTES[name] = f"""
SELECT {H_NAME} AS health, COUNT(*) AS products, SUM(value) AS value
FROM (SELECT product_id, SUM(value) AS value, MIN(grade) AS grade FROM {items} GROUP BY product_id)
GROUP BY grade"""
Q["health"] = f"SELECT health, products, {d('value')} AS stock_value FROM h_health"
Q["health_filtered"] = f"SELECT health, products, {d('value')} AS stock_value FROM h_health_mixed"
Q["health_pct"] = f"""
WITH all_classes AS (
  SELECT c.health, COALESCE(h.value, 0) AS value,
    CASE WHEN c.health = 'agotado' THEN GREATEST(COALESCE(h.products, 0),
      (SELECT COUNT(DISTINCT product_id) FROM a_pending WHERE alert_type = 'STOCK_AGOTADO'))
      ELSE COALESCE(h.products, 0) END AS products
  FROM (VALUES ('agotado'), ('critico'), ('bajo'), ('sobreinventario'), ('baja_rotacion'),
    ('sin_rotacion'), ('sano')) c(health) LEFT JOIN h_health h ON h.health = c.health)
SELECT health, products, {d('value')} AS stock_value,
  {pct('value', '(SELECT SUM(value) FROM all_classes)', 1)} AS value_pct,
  CAST((SELECT SUM(products) FROM all_classes) AS BIGINT) AS total_products,
  {d('(SELECT SUM(value) FROM all_classes)')} AS total_value
FROM all_classes"""
Q["lost_sales"] = f"""
SELECT COUNT(DISTINCT CAST(k.product_id AS VARCHAR) || '-' || CAST(k.warehouse_id AS VARCHAR)) AS items,
  {d('COALESCE(SUM(k.amount), 0)')} AS amount, {d('COALESCE(SUM(k.q30), 0)')} AS units
FROM m_sold30 k LEFT JOIN m_stock s ON s.product_id = k.product_id AND s.warehouse_id = k.warehouse_id
WHERE COALESCE(s.qty, 0) = 0
  AND NOT EXISTS (SELECT 1 FROM e_projects x WHERE x.product_id = k.product_id)"""
Q["kpi_legacy"] = f"""
SELECT (SELECT COUNT(DISTINCT product_id) FROM m_stock) AS products,
  (SELECT COUNT(DISTINCT warehouse_id) FROM m_stock) AS warehouses,
  {d('(SELECT SUM(qty) FROM m_stock)')} AS units,
  {d('(SELECT SUM(qty * unit_cost) FROM m_stock)')} AS stock_value,
  (SELECT COUNT(*) FROM m_sales WHERE {recent(30)}) AS sales_rows,
  {d(f'(SELECT SUM(qty) FROM m_sales WHERE {recent(30)})')} AS sold_units,
  {d(f'(SELECT SUM(amount) FROM m_sales WHERE {recent(30)})')} AS sold_amount,
  (SELECT COUNT(*) FROM a_pending WHERE alert_type = 'STOCK_CRITICO') AS critical,
  (SELECT COUNT(*) FROM a_pending WHERE alert_type = 'STOCK_BAJO') AS low,
  (SELECT COUNT(*) FROM a_pending WHERE alert_type = 'SOBREINVENTARIO') AS over,
  (SELECT COUNT(*) FROM a_pending) AS alerts,
  (SELECT COUNT(*) FROM t_stored WHERE state = 'PENDIENTE') AS transfers"""

# --- lists and reports ----------------------------------------------------------
Q["filter_regions"] = "SELECT region_id, name FROM m_regions"
Q["filter_warehouses"] = """
SELECT warehouse_id, name, region_id FROM m_warehouses WHERE active AND wtype = 'Venta'"""
Q["filter_brands"] = "SELECT brand_id, name, category, abc_class FROM m_brands"
Q["filter_tags"] = """
SELECT COALESCE(NULLIF(TRIM(stock_tag), ''), 'INVENTARIO') AS tag, COUNT(DISTINCT product_id) AS products
FROM m_stock GROUP BY 1"""
AL = f"""
SELECT a.alert_type, a.level, a.product_id, p.product_name, a.warehouse_id, w.name AS warehouse_name,
  {d('a.stock')} AS stock, {d('a.days_of_stock')} AS days_of_stock, {d('a.daily')} AS daily, a.message,
  a.generated_on, a.state, w.region_id, a.category, a.abc_class, p.brand_id,
  {d('COALESCE(s.qty * s.unit_cost, 0)')} AS stock_value,
  {d('COALESCE(n.national, 0)')} AS national_stock
FROM a_pending a LEFT JOIN m_pb p ON p.product_id = a.product_id
LEFT JOIN m_warehouses w ON w.warehouse_id = a.warehouse_id
LEFT JOIN m_stock s ON s.product_id = a.product_id AND s.warehouse_id = a.warehouse_id
LEFT JOIN (SELECT product_id, SUM(qty) AS national FROM m_stock GROUP BY product_id) n
  ON n.product_id = a.product_id"""
AL_ORDER = "ORDER BY a.generated_on DESC, a.alert_type, a.product_id, a.warehouse_id"
Q["alert_list"] = f"{AL} {AL_ORDER} LIMIT 50"
Q["alert_list_filtered"] = f"""{AL}
WHERE a.level = 'ALTO' AND {MIX_PLACE} AND {MIX_BRANDS} AND {PLAIN.format('s')} {AL_ORDER} LIMIT 40"""
Q["alert_list_text_order"] = f"""
SELECT a.alert_type, a.level, a.product_id, p.product_name, a.warehouse_id, w.name AS warehouse_name,
  {d('a.stock')} AS stock, {d('a.days_of_stock')} AS days_of_stock, {d('a.daily')} AS daily, a.message,
  a.generated_on
FROM a_pending a LEFT JOIN m_pb p ON p.product_id = a.product_id
LEFT JOIN m_warehouses w ON w.warehouse_id = a.warehouse_id
ORDER BY a.level DESC, a.days_of_stock, a.alert_type, a.product_id, a.warehouse_id LIMIT 50"""
Q["alert_summary"] = """
SELECT alert_type, level, COUNT(*) AS alerts FROM a_pending GROUP BY alert_type, level"""
TL = f"""
SELECT t.product_id, p.name AS product_name, t.from_id, f.name AS from_name, t.to_id, g.name AS to_name,
  t.to_region, {d('t.qty')} AS qty, {d('t.days_from')} AS days_from, {d('t.days_to')} AS days_to,
  t.priority, t.state
FROM t_stored t LEFT JOIN m_products p ON p.product_id = t.product_id
LEFT JOIN m_warehouses f ON f.warehouse_id = t.from_id
LEFT JOIN m_warehouses g ON g.warehouse_id = t.to_id
WHERE t.state = 'PENDIENTE'"""
Q["transfer_list"] = f"{TL} ORDER BY t.days_to, t.product_id, t.to_id, t.from_id LIMIT 50"
Q["transfer_list_text_order"] = f"""{TL} AND EXISTS (SELECT 1 FROM m_stock x
  WHERE x.product_id = t.product_id AND x.stock_tag IN ('OUTLET'))
ORDER BY t.priority DESC, t.days_to, t.product_id, t.to_id, t.from_id LIMIT 50"""
Q["warehouse_list"] = f"""
SELECT w.warehouse_id, w.name, w.wtype, w.region_id, w.is_dc, COUNT(DISTINCT m.product_id) AS products,
  {d('COALESCE(SUM(m.stock), 0)')} AS units, {d('COALESCE(SUM(m.stock_value), 0)')} AS stock_value,
  ROUND(CAST(SUM(m.days_of_stock) FILTER (WHERE m.days_of_stock < 9999) AS DOUBLE)
    / COUNT(*) FILTER (WHERE m.days_of_stock < 9999), 6) AS mean_days
FROM m_warehouses w LEFT JOIN m_metrics m ON m.warehouse_id = w.warehouse_id
WHERE w.active AND w.wtype = 'Venta' GROUP BY ALL"""
Q["warehouse_top"] = f"""
SELECT m.product_id, p.name AS product_name, {d('m.stock')} AS stock, {d('m.stock_value')} AS stock_value,
  {d('m.q30')} AS q30, {d('m.daily')} AS daily, {d('m.days_of_stock')} AS days_of_stock,
  {d('m.turn')} AS turn, m.stock_state
FROM m_metrics m LEFT JOIN m_products p ON p.product_id = m.product_id
WHERE m.warehouse_id = 3 ORDER BY m.stock_value DESC, m.product_id LIMIT 100"""
Q["daily_sales"] = f"""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, COUNT(*) AS sales_rows, {d('SUM(qty)')} AS units,
  {d('SUM(amount)')} AS amount
FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id
WHERE {recent(30, 'v')} GROUP BY v.sale_date"""


def _efficiency(sales_filter: str, stock_filter: str) -> str:
    return f"""
WITH day_sales AS (SELECT v.sale_date, SUM(v.amount) AS amount
  FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id
  WHERE {recent(30, 'v')}{sales_filter} GROUP BY v.sale_date),
now_value AS (SELECT COALESCE(SUM(s.qty * s.unit_cost), 0) AS value
  FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id
  WHERE w.wtype = 'Venta'{stock_filter}),
snaps AS (SELECT s.snapshot_date, SUM(s.qty * s.unit_cost) AS value
  FROM m_stock_daily s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id
  WHERE w.wtype = 'Venta' AND s.snapshot_date >= {TODAY} - 30{stock_filter} GROUP BY s.snapshot_date),
joined AS (SELECT a.sale_date, a.amount, n.value AS today_value,
    COALESCE(p.value, n.value
      + COALESCE((SELECT SUM(b.amount) FROM day_sales b WHERE b.sale_date > a.sale_date), 0)) AS inventory
  FROM day_sales a, now_value n LEFT JOIN snaps p ON p.snapshot_date = a.sale_date)
SELECT CAST(sale_date AS VARCHAR) AS sale_date, {d('amount')} AS amount, {d('inventory')} AS inventory,
  {pct('amount', 'inventory', 4)} AS efficiency, {d('today_value')} AS today_value FROM joined"""


Q["daily_efficiency"] = _efficiency("", "")
Q["daily_efficiency_filtered"] = _efficiency(
    f" AND {MIX_PLACE} AND {MIX_PRODUCT.format('v')}", f" AND {MIX_PLACE} AND {PLAIN.format('s')}"
)
TP = f"""
SELECT v.product_id, p.name AS product_name, {d('SUM(v.qty)')} AS units, {d('SUM(v.amount)')} AS amount,
  COUNT(DISTINCT v.warehouse_id) AS warehouses
FROM m_sales v LEFT JOIN m_products p ON p.product_id = v.product_id
JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id WHERE {recent(30, 'v')}"""
TP_END = "GROUP BY v.product_id, p.name ORDER BY SUM(v.qty) DESC, v.product_id LIMIT"
Q["top_products"] = f"{TP} {TP_END} 20"
Q["top_products_filtered"] = f"""{TP} AND {MIX_PLACE} AND {MIX_BRANDS} AND {MIX_PRODUCT.format('v')}
{TP_END} 10"""
Q["product_search"] = f"""
SELECT p.product_id, p.name AS product_name, p.code, b.name AS brand_name,
  {d('COALESCE(SUM(s.qty), 0)')} AS stock,
  COUNT(DISTINCT s.warehouse_id) FILTER (WHERE s.qty > 0) AS warehouses
FROM m_products p LEFT JOIN m_brands b ON b.brand_id = p.brand_id
LEFT JOIN m_stock s ON s.product_id = p.product_id
WHERE lower(p.name) LIKE '%ring%' OR CAST(p.product_id AS VARCHAR) LIKE '%ring%'
  OR lower(p.code) LIKE '%ring%'
GROUP BY p.product_id, p.name, p.code, b.name
ORDER BY COALESCE(SUM(s.qty), 0) DESC, p.product_id LIMIT 30"""
Q["product_header"] = """
SELECT p.product_id, p.product_name, c.code, p.brand_name, p.category, p.abc_class, p.cover_days
FROM m_pb p JOIN m_products c ON c.product_id = p.product_id WHERE p.product_id = 14"""
Q["product_stock"] = f"""
SELECT s.warehouse_id, w.name, w.wtype, w.region_id, {d('s.qty')} AS stock,
  {d('s.unit_cost')} AS unit_cost, {d('COALESCE(m.daily, 0)')} AS daily,
  {d('COALESCE(m.days_of_stock, 0)')} AS days_of_stock, COALESCE(m.stock_state, 'SIN_DATOS') AS stock_state
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id
LEFT JOIN m_metrics m ON m.product_id = s.product_id AND m.warehouse_id = s.warehouse_id
WHERE s.product_id = 14 AND s.qty > 0"""
Q["product_sales"] = f"""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, {d('SUM(qty)')} AS units, {d('SUM(amount)')} AS amount
FROM m_sales WHERE product_id = 14 AND {recent(30)} GROUP BY sale_date"""
Q["region_cards"] = f"""
WITH grand AS (SELECT SUM(qty * unit_cost) AS value FROM m_stock),
held AS (SELECT r.region_id, r.name,
    COUNT(DISTINCT w.warehouse_id) FILTER (WHERE w.wtype = 'Venta') AS sales_points,
    COALESCE(SUM(s.qty * s.unit_cost), 0) AS value
  FROM m_regions r LEFT JOIN m_warehouses w ON w.region_id = r.region_id
  LEFT JOIN m_stock s ON s.warehouse_id = w.warehouse_id GROUP BY r.region_id, r.name)
SELECT h.region_id, h.name, h.sales_points, {d('h.value')} AS stock_value,
  {d(f"COALESCE((SELECT SUM(v.amount) FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id WHERE w.region_id = h.region_id AND {recent(30, 'v')}), 0)")}
    AS sold_amount,
  {pct('h.value', 'g.value', 1)} AS stock_pct,
  (SELECT COUNT(*) FROM a_pending a JOIN m_warehouses w ON w.warehouse_id = a.warehouse_id
    WHERE w.region_id = h.region_id) AS alerts,
  (SELECT COUNT(*) FROM a_pending a JOIN m_warehouses w ON w.warehouse_id = a.warehouse_id
    WHERE w.region_id = h.region_id AND a.level = 'CRITICO') AS critical,
  (SELECT COUNT(*) FROM t_stored t WHERE t.state = 'PENDIENTE' AND t.to_region = h.region_id) AS transfers,
  {d('g.value')} AS inventory_value
FROM held h, grand g"""


def _warehouse_cards(tag_total: str, extra: str) -> str:
    count = lambda cond: (
        "(SELECT COUNT(*) FROM a_pending a WHERE a.warehouse_id = h.warehouse_id" + cond + ")"
    )
    sold = lambda c: (
        f"COALESCE((SELECT SUM(v.{c}) FROM m_sales v WHERE v.warehouse_id = h.warehouse_id"
        f" AND {recent(30, 'v')}), 0)"
    )
    return f"""
WITH grand AS (SELECT SUM(qty * unit_cost) AS value FROM m_stock s {tag_total}),
held AS (SELECT w.warehouse_id, w.name, w.wtype, w.region_id, w.is_dc,
    COUNT(DISTINCT s.product_id) AS products, COALESCE(SUM(s.qty), 0) AS units,
    COALESCE(SUM(s.qty * s.unit_cost), 0) AS value
  FROM m_warehouses w LEFT JOIN m_stock s ON s.warehouse_id = w.warehouse_id
  WHERE w.active AND w.wtype = 'Venta'{extra} GROUP BY ALL),
full_rows AS (SELECT h.*, {sold('qty')} AS sold_units, {sold('amount')} AS sold_amount FROM held h)
SELECT h.warehouse_id, h.name, h.wtype, h.region_id, h.is_dc, h.products, {d('h.units')} AS units,
  {d('h.value')} AS stock_value, {pct('h.value', 'g.value', 1)} AS stock_pct,
  {d('h.sold_units')} AS sold_units, {d('h.sold_amount')} AS sold_amount,
  {count('')} AS alerts, {count(" AND a.level = 'CRITICO'")} AS critical_level,
  {count(" AND a.alert_type = 'STOCK_CRITICO'")} AS critical,
  {count(" AND a.alert_type = 'STOCK_BAJO'")} AS low,
  {count(" AND a.alert_type = 'SOBREINVENTARIO'")} AS over,
  {count(" AND a.alert_type = 'SIN_ROTACION'")} AS no_rotation,
  {pct('h.sold_amount', 'h.value', 1)} AS turn_pct, {d('g.value')} AS inventory_value
FROM full_rows h, grand g"""


Q["warehouse_cards"] = _warehouse_cards("", "")
Q["warehouse_cards_filtered"] = _warehouse_cards(
    "WHERE COALESCE(s.stock_tag, '') = ''", f" AND {MIX_PLACE} AND {PLAIN.format('s')}"
)


def _brand_breakdown(date_from: str, date_to: str, days: int, tag: str, tag_exists: str) -> str:
    return f"""
WITH grand AS (SELECT SUM(s.qty) AS units, SUM(s.qty * s.unit_cost) AS value
  FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id WHERE w.wtype = 'Venta'{tag}),
held AS (SELECT p.brand_id, p.brand_name, p.category, p.abc_class,
    COUNT(DISTINCT s.product_id) AS products, COUNT(DISTINCT s.warehouse_id) AS warehouses,
    SUM(s.qty) AS units, SUM(s.qty * s.unit_cost) AS value
  FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id
  JOIN m_pb p ON p.product_id = s.product_id
  WHERE s.qty > 0 AND w.wtype = 'Venta'{tag} GROUP BY ALL),
sold AS (SELECT p.brand_id, SUM(v.qty) AS units, SUM(v.amount) AS amount
  FROM m_sales v JOIN m_warehouses w ON w.warehouse_id = v.warehouse_id AND w.wtype = 'Venta'
  JOIN m_products p ON p.product_id = v.product_id
  WHERE v.sale_date >= {date_from} AND v.sale_date <= {date_to}{tag_exists} GROUP BY p.brand_id),
full_rows AS (SELECT h.*, COALESCE(k.units, 0) AS sold_units, COALESCE(k.amount, 0) AS sold_amount
  FROM held h LEFT JOIN sold k ON k.brand_id IS NOT DISTINCT FROM h.brand_id)
SELECT h.brand_id, COALESCE(h.brand_name, 'Sin marca') AS brand_name, h.category, h.abc_class,
  h.products, h.warehouses, {d('h.units')} AS units, {d('h.value')} AS stock_value,
  {pct('h.units', 'g.units', 2)} AS units_pct, {pct('h.value', 'g.value', 2)} AS value_pct,
  {d('h.sold_units')} AS sold_units, {d('h.sold_amount')} AS sold_amount,
  {pct('h.sold_amount', 'h.value', 2)} AS turn_pct, {d('g.units')} AS total_units,
  {d('g.value')} AS total_value, CAST({days} AS BIGINT) AS range_days
FROM full_rows h, grand g"""


Q["brand_breakdown"] = _brand_breakdown(f"{TODAY} - 30", TODAY, 30, "", "")
_TAG2 = " AND (COALESCE({0}.stock_tag, '') = '' OR {0}.stock_tag IN ('OUTLET'))"
Q["brand_breakdown_filtered"] = _brand_breakdown(
    "DATE '2001-09-01'", "DATE '2001-10-15'", 44, _TAG2.format("s"),
    " AND EXISTS (SELECT 1 FROM m_stock t WHERE t.product_id = v.product_id" + _TAG2.format("t") + ")",
)
Q["tag_summary"] = f"""
SELECT COALESCE(stock_tag, 'SIN_OBSERVACION') AS stock_tag, COUNT(*) AS items, {d('SUM(qty)')} AS units,
  {d('SUM(qty * unit_cost)')} AS stock_value
FROM m_stock s JOIN m_warehouses w ON w.warehouse_id = s.warehouse_id AND w.wtype = 'Venta'
WHERE qty > 0 GROUP BY stock_tag"""

# --- views: sales and stock rows of a warehouse meet many to many -----------------
CTES["f_sold"] = f"""
SELECT warehouse_id, product_id AS sold_id, qty AS sold, amount FROM m_sales WHERE {recent(30)}"""
CTES["f_held"] = """
SELECT warehouse_id, product_id AS held_id, qty AS held, qty * unit_cost AS worth FROM m_stock"""
CTES["f_points"] = "SELECT * FROM m_warehouses WHERE wtype = 'Venta'"
# every sold row beside every held row of the same place; either side may be missing
CTES["f_meetings"] = """
SELECT warehouse_id, sold_id, sold, amount, held_id, held, worth
FROM f_points LEFT JOIN f_sold USING (warehouse_id) LEFT JOIN f_held USING (warehouse_id)"""
CTES["f_inflated"] = """
SELECT warehouse_id, SUM(sold) AS sold, SUM(amount) AS amount, SUM(held) AS held, COUNT(held) AS held_rows,
  SUM(worth) AS worth, COUNT(DISTINCT sold_id) AS sold_ids, COUNT(DISTINCT held_id) AS held_ids
FROM f_meetings GROUP BY warehouse_id"""
CTES["f_plain"] = """
SELECT warehouse_id, v.sold, v.amount, s.held, s.held_rows, s.worth, v.sold_ids, s.held_rows AS held_ids
FROM f_points
LEFT JOIN (SELECT warehouse_id, SUM(sold) AS sold, SUM(amount) AS amount, COUNT(DISTINCT sold_id) AS sold_ids
  FROM f_sold GROUP BY ALL) v USING (warehouse_id)
LEFT JOIN (SELECT warehouse_id, SUM(held) AS held, COUNT(*) AS held_rows, SUM(worth) AS worth
  FROM f_held GROUP BY ALL) s USING (warehouse_id)"""


def _efficiency(sums: str) -> str:
    """Warehouses with the sums of one of the two CTEs above; a missing side counts as nothing."""
    return f"""
SELECT warehouse_id, name, wtype, region_id, {d('IFNULL(sold, 0)', 2)} AS sold_units,
  {d('IFNULL(amount, 0)', 2)} AS sold_amount, ROUND(IFNULL(level, 0), 6) AS mean_stock,
  {d('IFNULL(worth, 0)', 2)} AS stock_value,
  IFNULL(ROUND(CAST(IFNULL(sold, 0) AS DOUBLE) / NULLIF(level, 0) * 100, 2), 0.0) AS sold_over_available_pct,
  IFNULL(sold_ids, 0) AS products_sold, IFNULL(held_ids, 0) AS products_stocked
FROM f_points JOIN (SELECT *, CAST(held AS DOUBLE) / held_rows AS level FROM {sums}) USING (warehouse_id)"""


Q["warehouse_efficiency"] = _efficiency("f_inflated")
Q["warehouse_efficiency_corrected"] = _efficiency("f_plain")
# the sums of a region are those of its sales points
Q["region_efficiency"] = f"""
SELECT region_id, g.name, points AS sales_points, {d('amount', 2)} AS sold_amount, {d('worth', 2)} AS stock_value,
  IFNULL(ROUND(CAST(sold AS DOUBLE) / NULLIF(CAST(held AS DOUBLE), 0) * 100, 2), 0.0) AS sold_over_available_pct
FROM m_regions g JOIN (
  SELECT region_id, COUNT(warehouse_id) AS points, IFNULL(SUM(sold), 0) AS sold,
    IFNULL(SUM(amount), 0) AS amount, IFNULL(SUM(held), 0) AS held, IFNULL(SUM(worth), 0) AS worth
  FROM m_regions LEFT JOIN f_points p USING (region_id) LEFT JOIN f_inflated USING (warehouse_id)
  GROUP BY region_id) USING (region_id)"""
Q["stock_by_type"] = f"""
WITH held AS (
  SELECT warehouse_id, SUM(qty) AS units, SUM(qty * unit_cost) AS cost, SUM(qty * unit_price) AS sale
  FROM m_stock GROUP BY warehouse_id),
kinds AS (SELECT wtype, product_id FROM m_stock JOIN m_warehouses USING (warehouse_id) GROUP BY ALL),
variety AS (SELECT wtype, COUNT(product_id) AS products FROM kinds GROUP BY wtype)
SELECT w.wtype, COUNT(*) AS warehouses, COALESCE(MAX(v.products), 0) AS products,
  {d('COALESCE(SUM(units), 0)')} AS units, {d('COALESCE(SUM(cost), 0)')} AS cost_value, {d('COALESCE(SUM(sale), 0)')} AS sale_value
FROM m_warehouses w LEFT JOIN held USING (warehouse_id) LEFT JOIN variety v USING (wtype) GROUP BY w.wtype"""
CTES["v_described"] = """
SELECT m.*, p.name AS product_name, b.name AS brand_name, b.category, b.abc_class, b.cover_days,
  w.name AS warehouse_name, w.wtype, w.region_id
FROM m_metrics m JOIN m_products p ON p.product_id = m.product_id
JOIN m_brands b ON b.brand_id = p.brand_id JOIN m_warehouses w ON w.warehouse_id = m.warehouse_id"""
V = "product_id, product_name, brand_name, category, abc_class, warehouse_id, warehouse_name"
CTES["f_ranks"] = """
SELECT * FROM (VALUES ('PRINCIPAL', 'A', 1), ('PRINCIPAL', 'B', 2), ('OTRAS', 'A', 3), ('PRINCIPAL', 'C', 4),
  ('OTRAS', 'B', 5)) t(category, abc_class, place)"""
CTES["f_bands"] = """
SELECT * FROM (VALUES (0, 3, 'CRÍTICO - Menos de 3 días'), (3, 7, 'ALTO - Menos de 7 días'),
  (7, 15, 'MEDIO - Menos de 15 días')) t(above, below, label)"""
Q["critical_products"] = f"""
SELECT {V}, region_id, {d('stock')} AS stock, {d('daily')} AS daily, {d('m.days_of_stock')} AS days_of_stock,
  stock_state, {d('reorder_point')} AS reorder_point, IFNULL(place, 6) AS attention_rank, label AS message
FROM v_described m LEFT JOIN f_ranks USING (category, abc_class)
JOIN f_bands ON m.days_of_stock < below AND (m.days_of_stock >= above OR above = 0)
WHERE m.daily > 0 AND wtype = 'Venta'"""
Q["overstock"] = f"""
SELECT {V}, wtype, region_id, {d('stock')} AS stock, {d('daily')} AS daily,
  {d('days_of_stock')} AS days_of_stock, cover_days AS target_days,
  {d('m.days_of_stock - cover_days')} AS excess_days, {d('stock_value')} AS stock_value
FROM v_described m WHERE m.days_of_stock > cover_days * 1.5"""
Q["low_rotation"] = f"""
SELECT {V}, wtype, {d('stock')} AS stock, {d('q90')} AS q90, {d('turn')} AS turn,
  {d('stock_value')} AS stock_value,
  CASE WHEN abc_class = 'D' THEN 'ESPERADO (Marca clase D)' WHEN m.q90 = 0 THEN 'SIN MOVIMIENTO 90 DÍAS'
       WHEN m.turn < 0.5 THEN 'ROTACIÓN MUY BAJA' ELSE 'ROTACIÓN BAJA' END AS rotation
FROM v_described m WHERE m.stock > 0 AND (m.q90 < 3 OR m.turn < 1)"""
# a product's stock rows and its sales of the month, side by side
CTES["f_items"] = f"""
SELECT p.brand_id, p.product_id, s.held, s.worth, IFNULL(s.held_rows, 0) AS held_rows,
  IFNULL(s.stocked, FALSE) AS stocked, v.sold, v.amount
FROM m_products p
LEFT JOIN (SELECT product_id, SUM(qty) AS held, SUM(qty * unit_cost) AS worth, COUNT(*) AS held_rows,
  BOOL_OR(qty > 0) AS stocked FROM m_stock GROUP BY ALL) s USING (product_id)
LEFT JOIN (SELECT product_id, SUM(qty) AS sold, SUM(amount) AS amount FROM m_sales
  WHERE {recent(30)} GROUP BY ALL) v USING (product_id)"""


def _brands(times: str, over: str, under: str) -> str:
    """Brands with sums over their products; each product's sales count ``times`` times."""
    return f"""
SELECT brand_id, g.name AS brand_name, category, abc_class, buy_every_days, cover_days,
  cover_days + dc_lead AS total_cover, products, products_in_stock, {d('held')} AS units,
  {d('worth', 2)} AS stock_value, {d('sold', 2)} AS sold_units, {d('amount', 2)} AS sold_amount,
  IFNULL(ROUND(CAST({over} AS DOUBLE) / NULLIF(CAST({under} AS DOUBLE), 0) * 30, 1), 0.0) AS mean_days
FROM m_brands g JOIN (
  SELECT b.brand_id, COUNT(product_id) AS products, COUNT(*) FILTER (WHERE stocked) AS products_in_stock,
    IFNULL(SUM(held), 0) AS held, IFNULL(SUM(worth), 0) AS worth,
    IFNULL(SUM(sold * {times}), 0) AS sold, IFNULL(SUM(amount * {times}), 0) AS amount
  FROM m_brands b LEFT JOIN f_items USING (brand_id) GROUP BY ALL) USING (brand_id)"""


# joined raw, a product's sales are repeated for each of its stock rows
Q["brand_summary"] = _brands("GREATEST(held_rows, 1)", "sold", "held")
Q["brand_summary_corrected"] = _brands("1", "held", "sold")

# --- loads and merges --------------------------------------------------------------
CTES["i_docs"] = """
SELECT doc_no, product_id, warehouse_id, sale_date, qty, amount, line_no,
  CASE WHEN doc_no % 97 <> 0 THEN status END AS doc_prefix FROM m_docs"""
I_ORDER = "line_no, warehouse_id, sale_date, qty, amount"
CTES["i_first"] = f"""
SELECT * FROM i_docs WHERE line_no <= 3
QUALIFY doc_prefix IS NULL
  OR row_number() OVER (PARTITION BY doc_prefix, doc_no, product_id ORDER BY {I_ORDER}) = 1"""
I_COLS = (
    f"doc_no, product_id, warehouse_id, CAST(sale_date AS VARCHAR) AS sale_date, {d('qty')} AS qty,"
    f" {d('amount')} AS amount, CAST(line_no AS BIGINT) AS line_no, doc_prefix"
)
Q["sales_insert_ignore"] = f"""
SELECT {I_COLS} FROM i_first
UNION ALL
SELECT {I_COLS} FROM (SELECT * FROM i_docs n WHERE NOT EXISTS (SELECT 1 FROM i_first o
    WHERE o.doc_prefix = n.doc_prefix AND o.doc_no = n.doc_no AND o.product_id = n.product_id)
  QUALIFY doc_prefix IS NULL
    OR row_number() OVER (PARTITION BY doc_prefix, doc_no, product_id ORDER BY {I_ORDER}) = 1)"""
Q["sales_insert_bucketed"] = Q["sales_insert_ignore"]
S_COLS = f"{d('unit_cost')} AS unit_cost, {d('unit_price')} AS unit_price, stock_tag"
Q["stock_upsert"] = f"""
SELECT product_id, warehouse_id,
  {d('CASE WHEN warehouse_id % 3 = 0 THEN qty + 2 ELSE qty END')} AS qty, {S_COLS} FROM m_stock"""
Q["snapshot_upsert"] = f"""
SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, warehouse_id, product_id,
  {d(f"CASE WHEN snapshot_date = {TODAY} AND product_id % 2 = 0 THEN qty * 10 ELSE qty END")} AS qty,
  {S_COLS} FROM m_stock_daily"""
Q["product_upsert"] = """
SELECT product_id, CASE WHEN product_id % 4 = 0 THEN code || 'X' ELSE code END AS code,
  CASE WHEN product_id % 4 = 0 THEN upper(name) ELSE name END AS name, brand_id, TRUE AS active
FROM m_products
UNION ALL
SELECT product_id + 1000000000, code, name, brand_id, TRUE FROM m_products WHERE product_id % 4 = 1"""
Q["product_last_wins"] = """
SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(line_no AS VARCHAR) AS code,
  'doc ' || CAST(doc_no AS VARCHAR) AS name, status AS source_brand
FROM m_docs QUALIFY row_number() OVER (PARTITION BY product_id
  ORDER BY doc_no DESC, line_no DESC, warehouse_id DESC, qty DESC, amount DESC, sale_date DESC) = 1"""
Q["payload_sales"] = f"""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, status AS doc_prefix, CAST(doc_no AS VARCHAR) AS doc_no,
  CAST(warehouse_id AS VARCHAR) AS warehouse_id, CAST(product_id AS VARCHAR) AS product_id,
  {d('CASE WHEN doc_no % 41 = 0 THEN 0 ELSE qty END')} AS qty, CAST(0 AS DOUBLE) AS unit_price, {d('amount')} AS amount
FROM m_docs"""
Q["payload_errors"] = """
SELECT 'page ' || CAST(doc_no % 50 AS VARCHAR) AS source,
  CASE doc_no % 2 WHEN 0 THEN 'error' ELSE 'raw' END AS status, COUNT(*) AS payloads
FROM m_docs WHERE doc_no % 5 = 4 GROUP BY ALL"""
Q["payload_stock"] = f"""
SELECT CAST(warehouse_id AS VARCHAR) AS warehouse_id, CAST(product_id AS VARCHAR) AS product_id, {d('qty')} AS qty,
  {d('unit_cost')} AS unit_cost, {d('unit_price')} AS unit_price, NULLIF(TRIM(stock_tag), '') AS stock_tag
FROM m_stock"""
Q["bad_records"] = """
SELECT CAST(doc_no AS VARCHAR) AS "NUMDOC", CAST(product_id AS VARCHAR) AS "REFER", 'n/a' AS "CANTID"
FROM m_docs WHERE doc_no % 41 = 0"""
Q["history_summary"] = """
WITH span AS (SELECT MIN(sale_date) AS lo, MAX(sale_date) AS hi FROM m_docs),
  slices AS (SELECT CAST(lo + CAST(7 * i AS INTEGER) AS DATE) AS a,
    LEAST(CAST(lo + CAST(7 * i + 6 AS INTEGER) AS DATE), hi) AS b
  FROM span, range(0, 1000) t(i) WHERE lo + CAST(7 * i AS INTEGER) <= hi)
SELECT CAST(a AS VARCHAR) AS start_date, CAST(b AS VARCHAR) AS end_date, COUNT(v.doc_no) AS loaded,
  COUNT(DISTINCT v.product_id) AS products, COUNT(*) FILTER (WHERE v.doc_no % 41 = 0) AS errors
FROM slices LEFT JOIN m_docs v ON v.sale_date BETWEEN a AND b GROUP BY a, b"""
Q["week_ranges"] = """
WITH span AS (SELECT MIN(sale_date) AS lo, MAX(sale_date) AS hi FROM m_sales)
SELECT CAST(CAST(lo + CAST(7 * i AS INTEGER) AS DATE) AS VARCHAR) AS start_date,
  CAST(LEAST(CAST(lo + CAST(7 * i + 6 AS INTEGER) AS DATE), hi) AS VARCHAR) AS end_date
FROM span, range(0, 1000) t(i) WHERE lo + CAST(7 * i AS INTEGER) <= hi"""

# --- lifecycle ---------------------------------------------------------------------
NEW_STATE = "CASE WHEN product_id % 2 = 0 THEN '{}' ELSE '{}' END"
HIT = "product_id % 3 = 0"
Q["apply_alert_status"] = f"""
SELECT {A_OUT}, CASE WHEN {HIT} THEN {NEW_STATE.format('IGNORADA', 'VISTA')} ELSE state END AS state,
  generated_on,
  CASE WHEN {HIT} THEN CASE WHEN product_id % 2 = 0 THEN 'user 2' ELSE 'user 1' END END AS handled_by,
  CASE WHEN {HIT} THEN '2001-11-05 08:00:00' END AS handled_at FROM a_stored"""
Q["apply_transfer_status"] = f"""
SELECT {T_OUT}, CASE WHEN {HIT} THEN {NEW_STATE.format('EJECUTADO', 'APROBADO')} ELSE state END AS state,
  generated_on, {HIT} AND product_id % 2 = 0 AS executed,
  CASE WHEN {HIT} AND product_id % 2 = 0 THEN '2001-11-05 08:00:00' END AS executed_at FROM t_stored"""
Q["retag_stock"] = f"""
SELECT product_id, warehouse_id, {d('qty')} AS qty, {d('unit_cost')} AS unit_cost,
  {d('unit_price')} AS unit_price, CASE WHEN s.qty = 0 THEN 'AGOTADOS' ELSE stock_tag END AS stock_tag,
  s.qty = 0 AS updated FROM m_stock s"""


# --- sinks ---------------------------------------------------------------------------
Q["stored_sales_window"] = f"""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, COUNT(*) AS sales_rows, {d('SUM(qty)')} AS units
FROM m_sales WHERE {recent(30)} GROUP BY sale_date"""
Q["metrics_sink"] = f"""
SELECT stock_state, COUNT(*) AS items, {d('SUM(stock)')} AS units FROM m_metrics GROUP BY stock_state"""
Q["alerts_sink"] = """
SELECT alert_type, 'PENDIENTE' AS state, COUNT(*) AS alerts FROM a_all GROUP BY alert_type
UNION ALL
SELECT alert_type, 'VISTA', COUNT(*) FROM a_all WHERE product_id % 3 = 0 GROUP BY alert_type"""
Q["page_report"] = """
WITH pages AS (SELECT doc_no // 200 AS page, COUNT(*) AS records FROM m_docs GROUP BY 1),
  last AS (SELECT records AS last_records FROM pages ORDER BY page DESC LIMIT 1)
SELECT COUNT(*) AS pages, CAST(SUM(records) AS BIGINT) AS records,
  MAX(page) - MIN(page) + 1 = COUNT(*) AND MAX(last_records) < 1000
    AND COUNT(*) FILTER (WHERE records < 1000) = 1 AS complete,
  COUNT(*) >= 100 AND MAX(last_records) >= 1000 AS hit_page_limit
FROM pages, last"""

Q["ingest_sales_stream"] = """
SELECT status AS doc_prefix, COUNT(DISTINCT (doc_no, product_id)) AS sales_rows
FROM m_docs WHERE doc_no % 97 != 0 GROUP BY status
UNION ALL
SELECT NULL, COUNT(*) FROM m_docs WHERE doc_no % 97 = 0 HAVING COUNT(*) > 0"""


Q["load_selection"] = f"""
SELECT CAST(sale_date AS VARCHAR) AS sale_date, warehouse_id, COUNT(*) AS sales_rows, {d('SUM(qty)')} AS units
FROM m_sales WHERE sale_date = {TODAY} - 1 GROUP BY sale_date, warehouse_id"""
Q["csv_export"] = f"""
WITH listed AS ({Q['warehouse_list']})
SELECT CAST(warehouse_id AS VARCHAR) AS code, name, wtype, region_id AS region, products, units, stock_value FROM listed"""
Q["end_to_end_run"] = """
SELECT (SELECT COUNT(*) FROM m_metrics) AS metrics, (SELECT COUNT(*) FROM a_all) AS alerts,
  (SELECT COUNT(*) FROM t_all) AS transfers, (SELECT COUNT(*) FROM e_purchases) AS purchases,
  (SELECT COUNT(*) FROM t_needs WHERE needed > 0) AS needs"""
Q["alert_changes"] = f"""
SELECT alert_type, CASE WHEN {HIT} THEN {NEW_STATE.format('IGNORADA', 'VISTA')} ELSE state END AS state,
  COUNT(*) AS alerts, COUNT(*) FILTER (WHERE {HIT}) AS handled FROM a_stored GROUP BY ALL"""
Q["transfer_changes"] = f"""
SELECT {d('days_to')} AS days_to, product_id, from_id, to_id, to_region, {d('qty')} AS qty, state
FROM (SELECT *, row_number() OVER (ORDER BY days_to, product_id, to_id, from_id) AS n FROM t_stored)
WHERE n > 60 AND state = 'PENDIENTE' ORDER BY n LIMIT 40"""
Q["stock_tags"] = """
SELECT CASE WHEN qty != 0 THEN stock_tag WHEN product_id % 2 = 1 THEN 'AGOTADOS' END AS stock_tag,
  COUNT(*) AS items, (SELECT COUNT(*) FROM m_stock WHERE qty = 0) AS tagged FROM m_stock GROUP BY 1"""
Q["alerts_rebuild_written"] = """
SELECT alert_type, state, COUNT(*) AS alerts,
  (SELECT COUNT(*) FROM a_pending WHERE alert_type = 'SIN_ROTACION') AS deleted,
  (SELECT COUNT(*) FROM a_unmoved) AS inserted
FROM (SELECT alert_type, state FROM a_stored WHERE NOT (alert_type = 'SIN_ROTACION' AND state = 'PENDIENTE')
  UNION ALL SELECT alert_type, 'PENDIENTE' FROM a_unmoved) GROUP BY alert_type, state"""


Q["rolling_lookback"] = Q["sales_lookback"]


Q["page_gaps"] = """
WITH sent AS (
  SELECT 'feed ' || CAST(n // 40 AS VARCHAR) AS feed, n % 40 + 1 AS page, records
  FROM (SELECT doc_no // 200 AS n, COUNT(*) AS records FROM m_docs GROUP BY 1) WHERE n % 7 != 3
), near AS (
  SELECT *, COALESCE(LAG(page) OVER w, 0) AS prior, LEAD(page) OVER w AS later FROM sent WINDOW w AS (PARTITION BY feed ORDER BY page)
)
SELECT feed, 'missing' AS kind, prior + 1 AS first_page, page - 1 AS last_page FROM near WHERE page > prior + 1
UNION ALL SELECT feed, 'short', page, page FROM near WHERE later IS NOT NULL AND records < 100
UNION ALL SELECT feed, 'open', page + 1, page + 1 FROM near WHERE later IS NULL AND records >= 100 AND page < 40"""
# a key comes in one document, whose lines may be of several weeks: the week that is loaded first has it
Q["back_load"] = """
WITH span AS (SELECT MIN(sale_date) AS lo, MAX(sale_date) AS hi FROM m_docs),
  weeks AS (SELECT CAST(lo + CAST(7 * i AS INTEGER) AS DATE) AS a, LEAST(CAST(lo + CAST(7 * i + 6 AS INTEGER) AS DATE), hi) AS b
    FROM span, range(0, 1000) t(i) WHERE lo + CAST(7 * i AS INTEGER) <= hi),
  lines AS (SELECT a, b, status, doc_no, product_id, doc_no % 41 = 0 AS bad FROM weeks JOIN m_docs ON sale_date BETWEEN a AND b),
  stored AS (SELECT status, doc_no, product_id, MIN(a) AS a FROM lines WHERE doc_no % 97 != 0 GROUP BY ALL
    UNION ALL SELECT status, doc_no, product_id, a FROM lines WHERE doc_no % 97 = 0),
  rows_of AS (SELECT a, COUNT(*) AS loaded FROM stored GROUP BY a)
SELECT CAST(l.a AS VARCHAR) AS start_date, CAST(l.b AS VARCHAR) AS end_date, 'done' AS status,
  COALESCE(MAX(r.loaded), 0) AS loaded, COUNT(DISTINCT l.product_id) AS products, COUNT(*) FILTER (WHERE bad) AS errors
FROM lines l LEFT JOIN rows_of r ON r.a = l.a GROUP BY l.a, l.b"""


Q["product_search_indexed"] = Q["product_search"]


Q["daily_efficiency_intervals"] = Q["daily_efficiency"]


def _needed(body: str) -> list[str]:
    """The CTEs a query uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [body]
    while todo:
        for name in re.findall(r"\b[a-z]_[a-z0-9_]+\b", todo.pop()):
            if name in CTES and name not in found:
                found.add(name)
                todo.append(CTES[name])
    return [name for name in CTES if name in found]


def oracle_queries() -> dict[str, str]:
    out = {}
    for name, body in Q.items():
        # definitions are ordered by use, except those added late; sort by dependency
        parts = _in_order(_needed(body))
        own = body.strip()
        heads = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in parts)
        if own.startswith("WITH "):
            out[name] = f"WITH {heads}, {own[5:]}"
        else:
            out[name] = f"WITH {heads} {own}"
    return out


def _in_order(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(n: str) -> None:
        if n in done:
            return
        for other in re.findall(r"\b[a-z]_[a-z0-9_]+\b", CTES[n]):
            if other in names and other != n:
                visit(other)
        done.append(n)

    for n in names:
        visit(n)
    return done
