"""SQL for the cleaning, validation and star-schema queries."""

from oracle.base import DIMS, WS, dirty, over_accepted, over_feed, over_tagged, pct

RAW = ["txn_id", "order_id", "sale_date", "customer_id", "product", "category", "unit_price", "quantity",
       "location", "payment_method", "status"]
RAW_LIST = ", ".join(RAW)

DATE_FORM = f"""CASE WHEN coalesce(bare_date, '') = '' THEN 'nulo' WHEN c_date IS NULL THEN 'invalido'
  WHEN regexp_matches(bare_date, '^[0-9]{{4}}') AND contains(bare_date, '-') THEN 'iso (aaaa-mm-dd)'
  WHEN contains(bare_date, '/') THEN 'dd/mm/aaaa' ELSE 'dd-mm-aaaa' END"""
MONEY_FORM = f"""CASE WHEN coalesce(trim(unit_price, {WS}), '') = '' THEN 'nulo' WHEN c_cents IS NULL THEN 'invalido'
  WHEN starts_with(trim(unit_price, {WS}), 'R$') THEN 'R$ 1.234,56'
  WHEN contains(unit_price, ',') THEN '1.234,56' ELSE '1234.56' END"""
ACCEPTED_FIELDS = """c_txn AS txn_id, c_order AS order_id, strftime(c_date, '%Y-%m-%d') AS sale_date,
  c_customer AS customer_id, c_product AS product, c_category AS category,
  CAST(c_cents AS DOUBLE) / 100 AS unit_price, CAST(c_quantity AS BIGINT) AS quantity,
  c_city AS city, c_state AS state, c_country AS country, c_payment AS payment_method, c_status AS status"""
FACT_FIELDS = """c_txn AS txn_id, c_order AS order_id, strftime(c_date, '%Y-%m-%d') AS sale_date, customer_key,
  product_key, location_key, CAST(c_quantity AS BIGINT) AS quantity, CAST(c_cents AS DOUBLE) / 100 AS unit_price,
  CAST(c_cents * c_quantity AS DOUBLE) / 100 AS amount, c_payment AS payment_method, c_status AS status"""
FACT_FROM = """FROM accepted JOIN customers ON c_customer = customers.customer_id
  JOIN products ON c_product = products.product AND c_category = products.category
  JOIN locations ON c_city = locations.city AND c_state = locations.state AND c_country = locations.country"""
ENRICHED = """c_txn AS txn_id, c_order AS order_id, strftime(c_date, '%Y-%m-%d') AS sale_date,
  strftime(c_date, '%Y-%m') AS year_month, CAST(year(c_date) AS BIGINT) AS year,
  CAST(month(c_date) AS BIGINT) AS month, c_customer AS customer_id, c_product AS product,
  c_category AS category, c_city AS city, c_state AS state, c_country AS country,
  CAST(c_quantity AS BIGINT) AS quantity, CAST(c_cents AS DOUBLE) / 100 AS unit_price,
  CAST(c_cents * c_quantity AS DOUBLE) / 100 AS amount, c_payment AS payment_method, c_status AS status"""
MONTHS = ("['janeiro','fevereiro','marco','abril','maio','junho','julho','agosto','setembro','outubro',"
          "'novembro','dezembro']")
CALENDAR = f"""SELECT strftime(d, '%Y-%m-%d') AS day, CAST(year(d) AS BIGINT) AS year,
  CAST(month(d) AS BIGINT) AS month, {MONTHS}[month(d)] AS month_name, CAST(quarter(d) AS BIGINT) AS quarter,
  strftime(d, '%Y-%m') AS year_month
  FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(c_date)),
    date_trunc('month', max(c_date)) + INTERVAL 7 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM accepted)"""


def _constraints() -> str:
    """Every check counted over the accepted rows and the dimensions made of them."""
    checks = {
        "fact txn_id repeated": "SELECT count(*) - count(DISTINCT c_txn) FROM accepted",
        "customer repeated": "SELECT count(*) - count(DISTINCT customer_id) FROM customers",
        "product repeated": "SELECT count(*) - count(DISTINCT (product, category)) FROM products",
        "location repeated": "SELECT count(*) - count(DISTINCT (city, state, country)) FROM locations",
        "date outside calendar": "SELECT count(*) FROM accepted WHERE c_date < (SELECT min(c_date) FROM accepted) OR c_date > (SELECT max(c_date) FROM accepted)",
        "customer orphan": "SELECT count(*) FROM accepted a ANTI JOIN customers c ON c_customer = c.customer_id",
        "product orphan": "SELECT count(*) FROM accepted a ANTI JOIN products p ON c_product = p.product AND c_category = p.category",
        "location orphan": "SELECT count(*) FROM accepted a ANTI JOIN locations l ON c_city = l.city AND c_state = l.state AND c_country = l.country",
        "quantity not positive": "SELECT count(*) FROM accepted WHERE c_quantity <= 0",
        "price negative": "SELECT count(*) FROM accepted WHERE c_cents < 0",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"constraint\", CAST(({sql}) AS BIGINT) AS violations" for name, sql in checks.items()
    )


def _constraint_fact() -> str:
    """Violations of all rows of the feed, rejected ones and repeats too, against the dimensions of the accepted ones."""
    checks = {
        "fact txn_id repeated": "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM fact GROUP BY c_txn)",
        "customer repeated": "SELECT count(*) - count(DISTINCT customer_id) FROM customers",
        "product repeated": "SELECT count(*) - count(DISTINCT (product, category)) FROM products",
        "location repeated": "SELECT count(*) - count(DISTINCT (city, state, country)) FROM locations",
        "date outside calendar": "SELECT count(*) FROM fact WHERE c_date IS NULL OR c_date < (SELECT date_trunc('month', min(c_date)) FROM accepted) OR c_date >= (SELECT date_trunc('month', max(c_date)) + INTERVAL 7 MONTH FROM accepted)",
        "customer orphan": "SELECT count(*) FROM fact ANTI JOIN customers ON c_customer = customers.customer_id",
        "product orphan": "SELECT count(*) FROM fact ANTI JOIN products ON c_product = products.product AND c_category = products.category",
        "location orphan": "SELECT count(*) FROM fact ANTI JOIN locations ON c_city = locations.city AND c_state = locations.state AND c_country = locations.country",
        "quantity not positive": "SELECT count(*) FROM fact WHERE c_quantity <= 0",
        "price negative": "SELECT count(*) FROM fact WHERE c_cents < 0",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"constraint\", CAST(({sql}) AS BIGINT) AS violations" for name, sql in checks.items()
    )


def _nulls() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS nulls FROM feed WHERE coalesce(trim({c}, {WS}), '') = '' HAVING count(*) > 0"
        for c in RAW
    )


JSON = "to_json({" + ", ".join(f"'{c}': {c}" for c in RAW) + "})"

SQL = {
    "staging_projection": over_feed(f"SELECT {RAW_LIST} FROM feed"),
    "quarantine_records": over_tagged(
        f"SELECT CAST({JSON} AS VARCHAR) AS record, reason, 'validacao' AS stage FROM tagged WHERE reason IS NOT NULL"),
    "layer_counts": over_accepted(
        "SELECT 'staging' AS layer, count(*) AS n_rows FROM tagged UNION ALL SELECT 'fact', count(*) FROM accepted "
        "UNION ALL SELECT 'quarantine', count(*) FROM tagged WHERE reason IS NOT NULL"),
    "parse_money": over_tagged("SELECT unit_price, CAST(c_cents AS DOUBLE) / 100 AS price FROM tagged"),
    "price_two_places": over_tagged(
        "SELECT c_txn AS txn_id, CAST(c_cents AS DOUBLE) / 100 AS price FROM tagged WHERE reason IS NULL"),
    "parse_date": over_tagged("SELECT sale_date, strftime(c_date, '%Y-%m-%d') AS day FROM tagged"),
    "strip_accents": over_feed("SELECT category, strip_accents(category) AS bare FROM feed"),
    "normalize_category": over_tagged("SELECT category, c_category AS clean FROM tagged"),
    "normalize_status": over_tagged("SELECT status, c_status AS clean FROM tagged"),
    "parse_location": over_tagged("SELECT location, c_city AS city, c_state AS state, c_country AS country FROM tagged"),
    "trimmed_fields": over_tagged(
        "SELECT c_txn AS txn_id, c_order AS order_id, c_customer AS customer_id, c_product AS product, "
        "c_payment AS payment_method FROM tagged"),
    "parse_quantity": over_tagged("SELECT quantity, CAST(c_quantity AS BIGINT) AS units FROM tagged"),
    "date_form": over_tagged(f"SELECT sale_date, {DATE_FORM} AS form FROM tagged"),
    "money_form": over_tagged(f"SELECT unit_price, {MONEY_FORM} AS form FROM tagged"),
    "date_pattern_census": over_feed(
        r"""SELECT p AS pattern, count(sale_date) AS n_rows FROM
        (SELECT unnest(['aaaa-mm-dd', 'dd/mm/aaaa', 'dd-mm-aaaa', 'nenhum dos tres']) AS p)
        LEFT JOIN (SELECT sale_date, CASE WHEN regexp_matches(sale_date, '^\d{4}-\d{2}-\d{2}$') THEN 'aaaa-mm-dd'
          WHEN regexp_matches(sale_date, '^\d{2}/\d{2}/\d{4}$') THEN 'dd/mm/aaaa'
          WHEN regexp_matches(sale_date, '^\d{2}-\d{2}-\d{4}$') THEN 'dd-mm-aaaa' ELSE 'nenhum dos tres' END AS q
          FROM feed WHERE sale_date IS NOT NULL) ON p = q GROUP BY p"""),
    "unmatched_dates": over_feed(
        r"""SELECT sale_date AS "value", count(*) AS n_rows FROM feed WHERE sale_date IS NOT NULL AND NOT
        regexp_matches(sale_date, '^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}-\d{2}-\d{4})$') GROUP BY 1"""),
    "status_census": over_feed(
        'SELECT status AS "value", count(*) AS n_rows FROM feed WHERE status IS NOT NULL GROUP BY 1'),
    "category_census": over_feed(
        'SELECT category AS "value", count(*) AS n_rows FROM feed WHERE category IS NOT NULL GROUP BY 1'),
    "quantity_signs": over_feed(
        "SELECT count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) < 0) AS negative, "
        "count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) = 0) AS zero FROM feed"),
    "reject_reason": over_tagged(f"SELECT {RAW_LIST}, reason FROM tagged"),
    "split_accepted": over_accepted(f"SELECT {ACCEPTED_FIELDS} FROM accepted"),
    "split_rejected": over_tagged(f"SELECT {RAW_LIST}, reason FROM tagged WHERE reason IS NOT NULL"),
    "dedup_keep_first": over_accepted(f"SELECT {ACCEPTED_FIELDS} FROM accepted", True),
    "duplicate_census": over_feed(
        f"SELECT {RAW_LIST}, copies FROM (SELECT *, count(*) OVER (PARTITION BY txn_id) AS copies FROM feed "
        "WHERE txn_id IS NOT NULL) WHERE copies > 1", True),
    "load_balance": over_accepted(
        "SELECT staged, valid, rejected, fact, valid - fact AS duplicates, staged = fact + rejected + (valid - fact) "
        "AS balanced FROM (SELECT (SELECT count(*) FROM tagged) AS staged, (SELECT count(*) FROM tagged WHERE reason IS NULL) "
        "AS valid, (SELECT count(*) FROM tagged WHERE reason IS NOT NULL) AS rejected, (SELECT count(*) FROM accepted) AS fact)"),
    "constraint_violations": over_accepted(_constraints(), False, DIMS),
    "constraint_violations_dirty": over_accepted(_constraint_fact(), False, DIMS, "fact AS (SELECT * FROM tagged)"),
    "null_census": over_feed(f"SELECT * FROM ({_nulls()})"),
    "date_forms": over_tagged(f"SELECT {DATE_FORM} AS form, count(*) AS n_rows FROM tagged GROUP BY 1"),
    "money_forms": over_tagged(f"SELECT {MONEY_FORM} AS form, count(*) AS n_rows FROM tagged GROUP BY 1"),
    "distinct_before_after": over_tagged(
        f"""SELECT 'category' AS field, count(DISTINCT coalesce(trim(category, {WS}), '')) AS distinct_raw,
        count(DISTINCT c_category) FILTER (WHERE reason IS NULL) AS distinct_clean FROM tagged UNION ALL
        SELECT 'status', count(DISTINCT coalesce(trim(status, {WS}), '')),
        count(DISTINCT c_status) FILTER (WHERE reason IS NULL) FROM tagged"""),
    "reject_census": over_tagged(
        f"SELECT reason, n_rows, {pct('n_rows', 'staged', 2)} AS pct_staged FROM (SELECT reason, count(*) AS n_rows, "
        "(SELECT count(*) FROM tagged) AS staged FROM tagged WHERE reason IS NOT NULL GROUP BY reason)"),
    "load_report": over_tagged(
        f"""SELECT 'blank' AS topic, column_name AS item, nulls AS n_rows FROM ({_nulls()}) UNION ALL
        SELECT 'date form', {DATE_FORM}, count(*) FROM tagged GROUP BY 2 UNION ALL
        SELECT 'money form', {MONEY_FORM}, count(*) FROM tagged GROUP BY 2 UNION ALL
        SELECT 'reason', reason, count(*) FROM tagged WHERE reason IS NOT NULL GROUP BY 2 UNION ALL
        SELECT 'distinct', 'category as written', count(DISTINCT coalesce(trim(category, {WS}), '')) FROM tagged UNION ALL
        SELECT 'distinct', 'category as loaded', count(DISTINCT c_category) FROM tagged WHERE reason IS NULL UNION ALL
        SELECT 'distinct', 'status as written', count(DISTINCT coalesce(trim(status, {WS}), '')) FROM tagged UNION ALL
        SELECT 'distinct', 'status as loaded', count(DISTINCT c_status) FROM tagged WHERE reason IS NULL"""),
    "rejected_share": over_tagged(f"SELECT {pct('count(reason)', 'count(*)')} AS rejected_pct FROM tagged"),
    "status_domain": over_accepted("SELECT c_status AS status, count(*) AS n_rows FROM accepted GROUP BY 1"),
    "dim_calendar": over_accepted(CALENDAR),
    "dim_customer": over_accepted("SELECT * FROM customers", False, DIMS),
    "dim_product": over_accepted("SELECT * FROM products", False, DIMS),
    "dim_location": over_accepted("SELECT * FROM locations", False, DIMS),
    "load_fact": over_accepted(f"SELECT {FACT_FIELDS} {FACT_FROM}", False, DIMS),
    "generated_amount": over_accepted("SELECT c_txn AS txn_id, CAST(c_cents * c_quantity AS DOUBLE) / 100 AS amount FROM accepted"),
    "fact_with_sale_key": over_accepted(
        "SELECT row_number() OVER (ORDER BY copy, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) AS sale_key, "
        f"{FACT_FIELDS} {FACT_FROM}", False, DIMS),
    "sales_enriched": over_accepted(
        "SELECT row_number() OVER (ORDER BY copy, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) AS sale_key, "
        f"{ENRICHED} FROM accepted"),
    "load_pipeline": over_accepted(f"SELECT {ENRICHED} FROM accepted"),
}


def _broken_lines() -> str:
    """The broken export by lines and by records: the same, records with line breaks whole."""
    texts = {c: f"coalesce({c}, '')" for c in RAW}
    texts["product"] = "coalesce(product, '') || CASE fault WHEN 0 THEN chr(10) || 'nova linha' WHEN 3 THEN chr(10) || '1,2,3,4,5,6,7,8,9,10,11' || chr(10) || 'fim' ELSE '' END"
    quoted = [f"""'"' || replace({t}, '"', '""') || '"'""" for t in texts.values()]
    fields = {c: f"nullif({t}, '')" for c, t in texts.items()}

    def rows(mode: str, broken: str, malformed: str) -> str:
        shown = ", ".join(f"CASE WHEN NOT ({broken}) THEN {t} END AS {c}" for c, t in fields.items())
        return f"SELECT '{mode}' AS mode, {shown}, CASE WHEN {broken} THEN {malformed} END AS malformed FROM recs"

    return f"""{dirty()}, faults AS (SELECT *, (l_orderkey * 13 + l_linenumber * 5 + cents) % 61 AS fault FROM feed),
      recs AS (SELECT *, {" || ',' || ".join(quoted[:-1])} || CASE fault WHEN 1 THEN '' WHEN 2 THEN ',' || {quoted[-1]} || ',"x"'
        ELSE ',' || {quoted[-1]} END AS record FROM faults)
      {rows("records", "fault IN (1, 2)", "record")} UNION ALL {rows("lines", "fault IN (1, 2)", "record")}"""


SQL["read_broken_lines"] = "WITH " + _broken_lines()
SQL["read_raw_sales"] = SQL["staging_projection"]
