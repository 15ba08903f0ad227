"""Shared CTEs and exact rounding. Money is whole cents throughout."""

# The dirt the feed carries, stated here once more so that a change there shows.
BROKEN_DATES = ["30/02/2024", "2024-14-02", "00/05/2023", "ontem", "2024-03- 31", "2024-03- 07"]
BROKEN_PRICES = ["R$ --", "a combinar", "7,7,7"]
FOREIGN_STATUSES = ["Em rota", "Retido", "Pago"]
PLAIN_VOWELS, ACCENTED_VOWELS = "aeiou", "áêíõú"

WS = "' '||chr(9)||chr(10)||chr(13)"


def quoted(texts):
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


def ratio(num: str, den: str, digits: int, times: int = 1) -> str:
    """times * num / den half away from zero, NULL when den is 0; integers only."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    scale = 10**digits
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {times * scale} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {scale} END)"
    )


def pct(num: str, den: str, digits: int = 1) -> str:
    return ratio(num, den, digits, 100)


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def ym(day: str) -> str:
    return f"strftime({day}, '%Y-%m')"


STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'Entregue' WHEN o_orderstatus = 'O' THEN 'Enviado'
    WHEN o_orderkey % 3 = 0 THEN 'Processando' WHEN o_orderkey % 3 = 1 THEN 'Cancelado' ELSE 'Devolvido' END"""

ITEMS = f"""items AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(o_orderdate AS DATE) AS day,
    'S' || c_nationkey AS st, {STATUS} AS stat
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""

SALES = f"""{ITEMS}, sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) AS txn_id,
    CAST(l_orderkey AS VARCHAR) AS order_id, day AS sale_date, {ym('day')} AS year_month,
    CAST(year(day) AS BIGINT) AS year, CAST(month(day) AS BIGINT) AS month,
    CAST(o_custkey AS VARCHAR) AS customer_id, p_name AS product, p_type AS category,
    n_name AS city, st AS state, r_name AS country, CAST(l_quantity AS BIGINT) AS quantity,
    cents AS price, CAST(l_quantity AS BIGINT) * cents AS amount,
    o_orderpriority AS payment_method, stat AS status FROM items),
done AS (SELECT *, {month('sale_date')} AS m FROM sales WHERE status IN ('Entregue', 'Enviado'))"""


def _pick(texts, prime):
    return f"{quoted(texts)}[CAST((k // {prime}) % {len(texts)} + 1 AS BIGINT)]"


def dirty(clashing: bool = False) -> str:
    key = (
        "concat_ws('-', l_orderkey, l_linenumber)" if clashing
        else "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents)"
    )
    grouped = "translate(format('{:,.2f}', CAST(v AS DOUBLE) / 100), ',.', '.,')"
    label = "(left(p_type, 1) || lower(substr(p_type, 2)))"
    return f"""{ITEMS}, keyed AS (
  SELECT *, l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3 + cents AS k,
    cents * (CASE WHEN (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3 + cents) % 163 = 0
      THEN 6 + (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3 + cents) % 7 ELSE 1 END) AS v
  FROM items),
feed AS (SELECT
  CASE WHEN k % 167 = 5 THEN '   ' WHEN k % 167 <> 0 THEN
    CASE WHEN k % 113 = 0 THEN ' ' || {key} || chr(9) ELSE {key} END END AS txn_id,
  CASE WHEN k % 503 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN k % 167 <> 2 THEN CASE WHEN k % 211 = 0 THEN {_pick(BROKEN_DATES, 211)}
    WHEN k % 97 < 58 THEN strftime(day, '%Y-%m-%d') WHEN k % 97 < 82 THEN strftime(day, '%d/%m/%Y')
    ELSE strftime(day, '%d-%m-%Y') END END AS sale_date,
  CASE WHEN k % 167 <> 1 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN k % 167 <> 4 THEN p_name END AS product,
  CASE WHEN k % 307 = 0 THEN NULL WHEN k % 83 < 4 THEN upper({label}) WHEN k % 83 < 8 THEN lower({label})
    WHEN k % 83 < 12 THEN translate({label}, '{PLAIN_VOWELS}', '{ACCENTED_VOWELS}') ELSE {label} END AS category,
  CASE WHEN k % 167 <> 3 THEN CASE WHEN k % 251 = 0 THEN {_pick(BROKEN_PRICES, 251)}
    WHEN k % 257 = 0 THEN 'R$ -' || {grouped} WHEN k % 89 < 36 THEN 'R$ ' || {grouped}
    WHEN k % 89 < 58 THEN {grouped}
    ELSE CAST(v // 100 AS VARCHAR) || '.' || lpad(CAST(v % 100 AS VARCHAR), 2, '0') END END AS unit_price,
  CASE WHEN k % 101 = 0 THEN {_pick(["-2", "-1", "0"], 101)} WHEN k % 401 = 0 THEN '3.0'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
  CASE k % 131 WHEN 0 THEN n_name || '/' || st WHEN 1 THEN n_name || '/' || st || '/' || r_name || '/x'
    WHEN 2 THEN ' / / ' WHEN 3 THEN NULL WHEN 4 THEN ' ' || n_name || ' / ' || st || ' / ' || r_name || ' '
    ELSE n_name || '/' || st || '/' || r_name END AS location,
  CASE WHEN k % 509 <> 0 THEN o_orderpriority END AS payment_method,
  CASE WHEN k % 199 = 0 THEN {_pick(FOREIGN_STATUSES, 199)} WHEN k % 79 < 3 THEN upper(stat)
    WHEN k % 79 < 6 THEN lower(stat) ELSE stat END AS status,
  copy, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents
  FROM keyed, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR k % 67 = 0)"""


def tagged(clashing: bool = False) -> str:
    """Feed with typed c_ fields and the first reject reason."""
    blank = {f: f"coalesce(trim({f}, {WS}), '') = ''" for f in ("txn_id", "customer_id", "sale_date", "unit_price", "product")}
    return f"""{dirty(clashing)}, parsed AS (SELECT *,
  trim(replace(unit_price, 'R$', ''), {WS}) AS bare_price, trim(sale_date, {WS}) AS bare_date,
  strip_accents(trim(category, {WS})) AS bare_category, strip_accents(trim(status, {WS})) AS bare_status,
  trim(quantity, {WS}) AS bare_quantity,
  [trim(x, {WS}) FOR x IN string_split(coalesce(location, ''), '/')] AS parts FROM feed),
numbers AS (SELECT *,
  CASE WHEN contains(bare_price, ',') THEN replace(replace(bare_price, '.', ''), ',', '.') ELSE bare_price END AS dotted,
  CAST(CASE WHEN regexp_matches(bare_date, '^\\d{{4}}-\\d+-\\d+$') THEN try_strptime(bare_date, '%Y-%m-%d')
    WHEN regexp_matches(bare_date, '^\\d+/\\d+/\\d{{4}}$') THEN try_strptime(bare_date, '%d/%m/%Y')
    WHEN regexp_matches(bare_date, '^\\d+-\\d+-\\d{{4}}$') THEN try_strptime(bare_date, '%d-%m-%Y') END AS DATE) AS c_date,
  upper(left(bare_status, 1)) || lower(substr(bare_status, 2)) AS any_status,
  CASE WHEN regexp_matches(bare_quantity, '^[+-]?\\d+$') THEN TRY_CAST(bare_quantity AS INTEGER) END AS c_quantity,
  len(parts) = 3 AND len(list_filter(parts, lambda x: x = '')) = 0 AS whole_place FROM parsed),
typed AS (SELECT *,
  trim(txn_id, {WS}) AS c_txn, trim(order_id, {WS}) AS c_order, trim(customer_id, {WS}) AS c_customer,
  trim(product, {WS}) AS c_product, trim(payment_method, {WS}) AS c_payment,
  CASE WHEN regexp_matches(dotted, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$')
    THEN CAST(round(TRY_CAST(dotted AS DOUBLE) * 100) AS BIGINT) END AS c_cents,
  CASE WHEN bare_category <> '' THEN upper(left(bare_category, 1)) || lower(substr(bare_category, 2)) END AS c_category,
  CASE WHEN any_status IN ('Entregue', 'Enviado', 'Processando', 'Cancelado', 'Devolvido') THEN any_status END AS c_status,
  CASE WHEN whole_place THEN parts[1] ELSE 'Desconhecida' END AS c_city,
  CASE WHEN whole_place THEN parts[2] ELSE 'ND' END AS c_state,
  CASE WHEN whole_place THEN parts[3] ELSE 'Brasil' END AS c_country FROM numbers),
tagged AS (SELECT *, CASE
  WHEN {blank['txn_id']} THEN 'campo chave nulo: id_transacao'
  WHEN {blank['customer_id']} THEN 'campo chave nulo: id_cliente'
  WHEN {blank['sale_date']} THEN 'campo chave nulo: data_venda'
  WHEN {blank['unit_price']} THEN 'campo chave nulo: valor_unitario'
  WHEN {blank['product']} THEN 'campo chave nulo: nome_produto'
  WHEN c_date IS NULL THEN 'data invalida' WHEN c_cents IS NULL THEN 'valor invalido'
  WHEN c_cents < 0 THEN 'valor negativo' WHEN c_quantity IS NULL THEN 'quantidade invalida'
  WHEN c_quantity <= 0 THEN 'quantidade nao positiva' WHEN c_status IS NULL THEN 'status invalido'
  WHEN c_category IS NULL THEN 'categoria nula'
  WHEN order_id IS NULL THEN 'campo obrigatorio nulo: id_pedido'
  WHEN payment_method IS NULL THEN 'campo obrigatorio nulo: metodo_pagamento'
  END AS reason FROM typed)"""


ACCEPTED = """accepted AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY c_txn
  ORDER BY copy, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) AS n FROM tagged WHERE reason IS NULL)
  WHERE n = 1)"""

DIMS = """customers AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id
  FROM (SELECT DISTINCT c_customer AS customer_id FROM accepted)),
products AS (SELECT row_number() OVER (ORDER BY product, category) AS product_key, product, category
  FROM (SELECT DISTINCT c_product AS product, c_category AS category FROM accepted)),
locations AS (SELECT row_number() OVER (ORDER BY city, state, country) AS location_key, city, state, country
  FROM (SELECT DISTINCT c_city AS city, c_state AS state, c_country AS country FROM accepted))"""


def over_sales(sql: str, *ctes: str) -> str:
    return "WITH " + ", ".join([SALES, *ctes]) + " " + sql


def over_feed(sql: str, clashing: bool = False) -> str:
    return f"WITH {dirty(clashing)} {sql}"


def over_tagged(sql: str, clashing: bool = False) -> str:
    return f"WITH {tagged(clashing)} {sql}"


def over_accepted(sql: str, clashing: bool = False, *ctes: str) -> str:
    return "WITH " + ", ".join([tagged(clashing), ACCEPTED, *ctes]) + " " + sql
