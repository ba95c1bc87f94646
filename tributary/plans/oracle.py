"""Reference SQL for every registered query, runnable by DuckDB over the raw
driver tables (views ``orders``, ``lineitem``, ``events``).

The SQL is written independently of the Spark plans: the bronze feeds are
re-derived from the tables with the fixture formulas, and every later step is
plain SQL (window functions where Spark uses aggregate + join). Column names
and types match ``plans.queries``.
"""

from __future__ import annotations

# The report as-of date (same as the Spark plans).
REPORT_DATE = "2024-03-10"


def pad(expr: str, width: int) -> str:
    return f"printf('%0{width}d', {expr})"


def pick(selector: str, values: list) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"(CASE {selector} {whens} END)"


def landing_day(key: str) -> str:
    return f"(DATE '2024-03-01' + CAST({key} % 10 AS INTEGER))"


# --------------------------------------------------------------------------
# scalar expressions
# --------------------------------------------------------------------------

EPOCH_GUARD = r"^\s*[+-]?\d+(\.\d+)?\s*$"


def date_parse(c: str, documented: bool = False) -> str:
    slash = f"try_strptime({c}, '%m/%d/%Y')"
    if documented:
        slash = f"coalesce({slash}, try_strptime({c}, '%d/%m/%Y'))"
    epoch = f"CAST(trunc(TRY_CAST({c} AS DECIMAL(38,6))) AS BIGINT)"
    return f"""(CASE
      WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T') THEN try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ')
      WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime({c}, '%Y-%m-%d')
      WHEN regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN {slash}
      WHEN regexp_matches({c}, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$') THEN try_strptime({c}, '%d-%m-%Y')
      WHEN regexp_matches({c}, '{EPOCH_GUARD}') THEN
        CASE WHEN {epoch} BETWEEN -9223372036854 AND 9223372036854 THEN make_timestamp({epoch} * 1000000) END
    END)"""


def date_ambiguous(c: str) -> str:
    return f"""coalesce(regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')
      AND try_strptime({c}, '%m/%d/%Y') IS NOT NULL
      AND try_strptime({c}, '%d/%m/%Y') IS NOT NULL
      AND substr({c}, 1, 2) <> substr({c}, 4, 2), false)"""


def price_clean(c: str, documented: bool = False) -> str:
    if not documented:
        return f"TRY_CAST(regexp_replace(NULLIF({c}, ''), '[$€£¥PHP USD EUR GBP,]', '', 'g') AS DOUBLE)"
    tokens = r"\$|€|£|¥|PHP|USD|EUR|GBP"
    core = (
        f"trim(regexp_replace(regexp_replace({c}, '(?i)^\\s*({tokens})\\s*', ''), "
        f"'(?i)\\s*({tokens})\\s*$', ''))"
    )
    fixed = (
        f"(CASE WHEN regexp_matches({core}, '^-?\\d+,\\d{{2}}$') THEN replace({core}, ',', '.') "
        f"WHEN regexp_matches({core}, '^-?\\d{{1,3}}(,\\d{{3}})+(\\.\\d+)?$') THEN replace({core}, ',', '') "
        f"ELSE {core} END)"
    )
    return f"(CASE WHEN regexp_matches({fixed}, '^-?\\d+(\\.\\d+)?$') THEN TRY_CAST({fixed} AS DOUBLE) END)"


def status(c: str) -> str:
    s = f"lower(trim({c}))"
    return f"""(CASE WHEN {s} IN ('completed', 'complete', 'comp', 'done') THEN 'completed'
      WHEN {s} IN ('pending', 'processing') THEN 'pending'
      WHEN {s} IN ('cancelled', 'canceled', 'void') THEN 'cancelled'
      WHEN {s} IN ('refunded', 'refund') THEN 'refunded'
      WHEN {s} IN ('failed', 'error') THEN 'failed'
      ELSE 'unknown' END)"""


def store(c: str) -> str:
    return f"(CASE WHEN {c} IS NOT NULL THEN upper(regexp_replace({c}, '[_\\-\\s]', '', 'g')) ELSE 'UNKNOWN' END)"


def payment(c: str) -> str:
    s = f"lower({c})"
    return f"""(CASE WHEN contains({s}, 'cash') THEN 'cash'
      WHEN contains({s}, 'credit') THEN 'credit_card'
      WHEN contains({s}, 'debit') THEN 'debit_card' ELSE 'other' END)"""


def exact_sum(c: str) -> str:
    return f"CAST(SUM(TRY_CAST({c} AS DECIMAL(38,6))) AS DOUBLE)"


def exact_avg(c: str) -> str:
    return f"CAST(SUM(TRY_CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / CAST(COUNT(TRY_CAST({c} AS DECIMAL(38,6))) AS DOUBLE)"


def int_avg(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"


def _half_up_div(num: str, den: str) -> str:
    return (
        f"(CASE WHEN {num} >= 0 THEN (2 * ({num}) + {den}) // (2 * {den}) "
        f"ELSE -((2 * (-({num})) + {den}) // (2 * {den})) END)"
    )


def half_up_avg(c: str, places: int) -> str:
    u = 10 ** (6 - places)
    m = f"CAST(SUM(CAST(TRY_CAST({c} AS DECIMAL(38,6)) * 1000000 AS DECIMAL(38,0))) AS HUGEINT)"
    n = f"COUNT(TRY_CAST({c} AS DECIMAL(38,6)))"
    return (
        f"(CASE WHEN {n} > 0 THEN CAST({_half_up_div(m, f'{n} * {u}')} AS DOUBLE) "
        f"/ CAST({10**places} AS DOUBLE) END)"
    )


def half_up_avg_int(c: str, places: int) -> str:
    s = 10**places
    n = f"COUNT({c})"
    return (
        f"(CASE WHEN {n} > 0 THEN CAST({_half_up_div(f'{s} * SUM({c})', n)} AS DOUBLE) "
        f"/ CAST({s} AS DOUBLE) END)"
    )


# --------------------------------------------------------------------------
# common table expressions; each entry is (dependencies, body)
# --------------------------------------------------------------------------

POS_FIELDS = (
    "TRANS_ID, CUST_NUM, PRODUCT_CODE, QTY, PRICE, TRANS_DATE, STORE, STATUS, "
    "PAYMENT_TYPE, CASHIER_ID, REGISTER_NUM"
)
POS_REST = POS_FIELDS.split(", ", 1)[1]
AUDIT = "source_system, source_format, ingestion_timestamp, file_name"
UNIFIED = (
    "transaction_id, transaction_date, customer_id, product_id, quantity, unit_price, "
    "store_id, status, payment_method, source_system, ingestion_timestamp, source_file, total_amount"
)
SCORED = UNIFIED + ", quality_score, quality_tier, transformation_timestamp, needs_review"

# Order of the rows of a duplicate group; what is equal in all of it is equal.
TIE = ", ".join(
    f"{c} NULLS FIRST"
    for c in "transaction_date transaction_id source_file quantity unit_price total_amount status store_id payment_method".split()
)

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte(
    "pos_src",
    [],
    f"""SELECT o_orderkey AS k, o_custkey, o_orderdate,
      o_orderkey % 100 = 99 AS corrupt,
      (o_orderkey * 15485863 + 7) % 64 AS p,
      (o_orderkey * 32452843 + 11) % 26 AS q,
      (o_orderkey * 104729 + 3) % 100 AS r_prod,
      (o_orderkey * 1299709 + 5) % 100 AS r_qty,
      CAST(10 + o_orderkey % 490 AS VARCHAR) || '.' || {pad('(o_orderkey * 37) % 100', 2)} AS x,
      {landing_day('o_orderkey')} AS day
    FROM orders""",
)
cte(
    "pos_one",
    ["pos_src"],
    f"""SELECT k,
      CASE WHEN NOT corrupt THEN 'POS' || {pad('k', 8)} END AS TRANS_ID,
      CASE WHEN corrupt THEN '###CORRUPT###' WHEN (k * 7919 + 1) % 100 < 20 THEN NULL
           ELSE 'C' || {pad('o_custkey', 5)} END AS CUST_NUM,
      CASE WHEN corrupt THEN NULL WHEN k % 20 = 7 THEN 'PROD-' || {pad('(k * 31 + 7) % 50 + 1', 4)}
           WHEN r_prod < 4 THEN NULL WHEN r_prod < 7 THEN '' WHEN r_prod < 10 THEN 'MISSING'
           ELSE 'SKU-' || CAST(1000 + (k * 31) % 9000 AS VARCHAR) END AS PRODUCT_CODE,
      CASE WHEN corrupt THEN 'abc' WHEN r_qty < 2 THEN NULL WHEN r_qty < 4 THEN ''
           WHEN r_qty < 6 THEN '0' WHEN r_qty < 8 THEN '-1'
           WHEN k % 50 = 13 THEN CAST(100 + k % 401 AS VARCHAR) ELSE CAST(1 + k % 5 AS VARCHAR) END AS QTY,
      CASE WHEN corrupt THEN 'INVALID' WHEN k % 100 = 13 THEN '0.75' WHEN p = 0 THEN '$' || x WHEN p = 1 THEN 'PHP ' || x
           WHEN p = 2 THEN x || ' USD' WHEN p = 3 THEN replace(x, '.', ',') WHEN p = 4 THEN '-' || x
           WHEN p = 5 THEN NULL WHEN p = 6 THEN '' WHEN p = 7 THEN '0' ELSE x END AS PRICE,
      CASE WHEN corrupt THEN '99/99/9999' WHEN q = 0 THEN NULL WHEN q = 1 THEN ''
           WHEN q = 2 THEN 'NULL' WHEN q = 3 THEN '00/00/0000'
           WHEN q % 4 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
           WHEN q % 4 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
           WHEN q % 4 = 2 THEN strftime(o_orderdate, '%Y-%m-%d')
           ELSE strftime(o_orderdate, '%d/%m/%Y') END AS TRANS_DATE,
      CASE WHEN NOT corrupt THEN {pick('k % 5', ['Store_A', 'Store_B', 'Store_C', 'Store-D', None])} END AS STORE,
      CASE WHEN corrupt THEN 'ERROR' ELSE {pick('(k // 5) % 6', ['COMPLETE', 'complete', 'PENDING', 'VOID', '', None])} END AS STATUS,
      CASE WHEN NOT corrupt THEN {pick('(k // 7) % 5', ['CASH', 'cash', 'CREDIT', 'DEBIT', None])} END AS PAYMENT_TYPE,
      CASE WHEN NOT corrupt THEN 'EMP' || {pad('k % 50 + 1', 3)} END AS CASHIER_ID,
      CASE WHEN NOT corrupt THEN 'REG' || {pad('k % 10 + 1', 2)} END AS REGISTER_NUM,
      'legacy_pos' AS source_system, 'csv' AS source_format,
      CAST(day AS TIMESTAMP) AS ingestion_timestamp,
      'pos_export_' || strftime(day, '%Y%m%d') || '.csv' AS file_name
    FROM pos_src""",
)
cte(
    "pos_raw",
    ["pos_one"],
    f"""SELECT {POS_FIELDS}, {AUDIT} FROM pos_one
    UNION ALL
    SELECT TRANS_ID || '_DUP', {POS_REST}, {AUDIT} FROM pos_one WHERE k % 20 = 3""",
)
cte(
    "ecom_lines",
    [],
    """SELECT l_orderkey, l_partkey, l_quantity, l_discount,
      row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS pos
    FROM lineitem""",
)
cte(
    "ecom_agg",
    [],
    """SELECT l_orderkey, count(*) AS n_items,
      sum((1 + CAST(l_quantity AS BIGINT) % 8) * (1500 + (l_partkey * 3701) % 58500)) AS cents,
      sum(1 + CAST(l_quantity AS BIGINT) % 8) AS qty_total
    FROM lineitem GROUP BY l_orderkey""",
)
cte(
    "ecom_src",
    ["ecom_lines", "ecom_agg"],
    f"""SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderdate, o.o_orderkey % 20 = 19 AS broken,
      a.n_items, a.cents, a.qty_total, f.l_partkey AS f_partkey, f.l_quantity AS f_quantity,
      f.l_discount AS f_discount, {landing_day('o.o_orderkey')} AS day
    FROM orders o LEFT JOIN ecom_agg a ON a.l_orderkey = o.o_orderkey
    LEFT JOIN ecom_lines f ON f.l_orderkey = o.o_orderkey AND f.pos = 1""",
)
cte(
    "ecom_raw",
    ["ecom_src"],
    f"""SELECT
      CASE WHEN broken THEN 'ORD-ERROR-' || CAST(k AS VARCHAR) ELSE 'ORD-' || {pad('k', 8)} END AS orderId,
      CASE WHEN NOT broken THEN strftime(o_orderdate, '%Y-%m-%d') || 'T' || {pad('(k * 13) % 24', 2)}
           || ':' || {pad('(k * 29) % 60', 2)} || ':00Z' END AS orderDate,
      CASE WHEN NOT broken AND (k * 7919 + 2) % 100 >= 10 THEN 'CUST-' || {pad('o_custkey', 5)} END AS customer_id,
      CASE WHEN NOT broken AND (k * 104729 + 4) % 100 >= 5
           THEN 'customer' || CAST(o_custkey AS VARCHAR) || '@example.com' END AS customer_email,
      CASE WHEN NOT broken THEN {pick('k % 5', ['bronze', 'silver', 'gold', 'platinum', None])} END AS loyalty_tier,
      CAST(CASE WHEN broken THEN 0 ELSE coalesce(n_items, 0) END AS INTEGER) AS item_count,
      CAST(CASE WHEN broken THEN 0 ELSE coalesce(qty_total, 0) END AS BIGINT) AS item_quantity_total,
      CASE WHEN NOT broken AND n_items IS NOT NULL THEN 'PROD-' || {pad('(k * 31 + 7) % 50 + 1', 4)} END AS first_product_id,
      CASE WHEN NOT broken AND n_items IS NOT NULL THEN 'Product PROD-' || {pad('(k * 31 + 7) % 50 + 1', 4)} END AS first_product_name,
      CASE WHEN NOT broken THEN CAST(1 + CAST(f_quantity AS BIGINT) % 8 AS VARCHAR) END AS first_quantity,
      CASE WHEN NOT broken THEN CAST(1500 + (f_partkey * 3701) % 58500 AS DOUBLE) / 100.0 END AS first_unit_price,
      CASE WHEN NOT broken THEN f_discount END AS first_discount,
      CASE WHEN NOT broken THEN {pick('k % 4', ['credit_card', 'paypal', 'apple_pay', 'google_pay'])} END AS payment_method,
      CASE WHEN broken THEN 'error' ELSE {pick('k % 4', ['completed', 'pending', 'failed', 'refunded'])} END AS payment_status,
      CASE WHEN NOT broken THEN 'TXN-' || CAST(k AS VARCHAR) END AS payment_transaction_id,
      CASE WHEN NOT broken THEN {pick('k % 3', ['standard', 'express', 'overnight'])} END AS shipping_method,
      CASE WHEN NOT broken THEN 'PH' END AS shipping_country,
      CASE WHEN NOT broken THEN {pick('k % 4', ['Manila', 'Quezon City', 'Makati', 'Cebu'])} END AS shipping_city,
      CASE WHEN broken THEN 'unknown' WHEN k % 10 < 7 THEN 'web' ELSE 'mobile_web' END AS platform,
      CASE WHEN broken THEN CAST(0 AS DOUBLE) ELSE CAST(coalesce(cents, 0) AS DOUBLE) / 100.0 END AS totalAmount,
      'ecommerce_platform' AS source_system, 'json' AS source_format,
      CAST(day AS TIMESTAMP) AS ingestion_timestamp,
      'orders_' || strftime(day, '%Y%m%d') || '.json' AS file_name
    FROM ecom_src""",
)
cte(
    "mobile_raw",
    [],
    f"""SELECT
      CASE WHEN event_type <> 'error' THEN 'MTX-' || CAST(event_id AS VARCHAR) END AS transaction_id,
      CASE WHEN event_type <> 'error' THEN 'MP-' || CAST((event_id * 17) % 200 AS VARCHAR) END AS product_id,
      'device_' || {pad('user_id', 16)} AS device_id,
      CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 + event_id % 5 END AS BIGINT) AS quantity,
      CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value END AS amount,
      CAST(CASE WHEN event_type = 'error' THEN 0 ELSE floor(epoch(ts)) END AS BIGINT) AS "timestamp",
      CASE WHEN event_type = 'error' THEN 'unknown'
           ELSE {pick('event_id % 4', ['2.1.0', '2.2.0', '2.3.0', '2.4.0'])} END AS app_version,
      CASE WHEN event_type = 'error' THEN 'unknown' ELSE {pick('event_id % 2', ['iOS', 'Android'])} END AS platform,
      CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'pending'
           WHEN 'view' THEN 'failed' ELSE event_type END AS payment_status,
      'mobile_app' AS source_system, 'parquet' AS source_format,
      CAST({landing_day('event_id')} AS TIMESTAMP) AS ingestion_timestamp,
      'mobile_txn_' || strftime({landing_day('event_id')}, '%Y%m%d') || '.parquet' AS file_name
    FROM events""",
)
def _pos_norm_sql(documented: bool) -> str:
    if documented:
        digits = "regexp_extract(CUST_NUM, '(\\d+)', 1)"
        customer = (
            f"CASE WHEN {digits} <> '' THEN 'CUST-' || CASE WHEN length({digits}) >= 5 "
            f"THEN {digits} ELSE lpad({digits}, 5, '0') END END"
        )
        product = (
            "CASE WHEN NOT (upper(trim(PRODUCT_CODE)) IN ('', 'MISSING', 'NULL', 'N/A')) "
            "THEN PRODUCT_CODE END"
        )
    else:
        customer = (
            "CASE WHEN CUST_NUM IS NOT NULL AND CUST_NUM <> '' "
            "THEN 'CUST-' || lpad(regexp_extract(CUST_NUM, '(\\d+)', 1), 5, '0') END"
        )
        product = "PRODUCT_CODE"
    return f"""SELECT *, CASE WHEN quantity IS NOT NULL AND unit_price IS NOT NULL THEN quantity * unit_price END AS total_amount
    FROM (SELECT
      TRANS_ID AS transaction_id,
      {date_parse('TRANS_DATE', documented)} AS transaction_date,
      {customer} AS customer_id,
      {product} AS product_id,
      CAST(CASE WHEN regexp_matches(QTY, '^\\d+$') THEN TRY_CAST(QTY AS INTEGER) END AS BIGINT) AS quantity,
      {price_clean('PRICE', documented)} AS unit_price,
      {store('STORE')} AS store_id,
      {status('STATUS')} AS status,
      {payment('PAYMENT_TYPE')} AS payment_method,
      'pos' AS source_system, ingestion_timestamp, file_name AS source_file
    FROM pos_raw)"""


def _mobile_norm_sql(documented: bool) -> str:
    zero = ' AND "timestamp" <> 0' if documented else ""
    return f"""SELECT transaction_id,
      CASE WHEN "timestamp" BETWEEN -9223372036854 AND 9223372036854{zero}
           THEN make_timestamp("timestamp" * 1000000) END AS transaction_date,
      'DEVICE-' || device_id AS customer_id, product_id, quantity,
      CASE WHEN quantity IS NOT NULL AND quantity > 0 AND amount IS NOT NULL THEN amount / quantity END AS unit_price,
      'MOBILE' AS store_id, {status('payment_status')} AS status,
      'mobile_app_payment' AS payment_method, 'mobile' AS source_system,
      ingestion_timestamp, file_name AS source_file, amount AS total_amount
    FROM mobile_raw"""


def _scored_sql(unified: str, clamp: bool) -> str:
    penalties = """100
      - CASE WHEN transaction_id IS NULL THEN 100 ELSE 0 END
      - CASE WHEN product_id IS NULL THEN 100 ELSE 0 END
      - CASE WHEN customer_id IS NULL THEN 10 ELSE 0 END
      - CASE WHEN transaction_date IS NULL THEN 20 ELSE 0 END
      - CASE WHEN unit_price IS NULL OR unit_price <= 0 THEN 50 ELSE 0 END
      - CASE WHEN quantity IS NULL OR quantity <= 0 THEN 30 ELSE 0 END
      - CASE WHEN status = 'unknown' THEN 5 ELSE 0 END
      - CASE WHEN store_id = 'UNKNOWN' THEN 5 ELSE 0 END"""
    score = f"greatest({penalties}, 0)" if clamp else penalties
    return f"""SELECT {UNIFIED}, quality_score,
      CASE WHEN quality_score >= 90 THEN 'high' WHEN quality_score >= 70 THEN 'medium'
           WHEN quality_score >= 50 THEN 'low' ELSE 'rejected' END AS quality_tier,
      ingestion_timestamp AS transformation_timestamp,
      coalesce(quantity > 100 AND unit_price < 1, false) AS needs_review
    FROM (SELECT *, {score} AS quality_score FROM {unified})"""


cte("pos_norm", ["pos_raw"], _pos_norm_sql(False))
cte("pos_norm_doc", ["pos_raw"], _pos_norm_sql(True))
cte(
    "ecom_norm",
    ["ecom_raw"],
    f"""SELECT orderId AS transaction_id,
      try_strptime(orderDate, '%Y-%m-%dT%H:%M:%SZ') AS transaction_date,
      customer_id, first_product_id AS product_id,
      TRY_CAST(first_quantity AS BIGINT) AS quantity, first_unit_price AS unit_price,
      'ONLINE' AS store_id, {status('payment_status')} AS status, payment_method,
      'ecommerce' AS source_system, ingestion_timestamp, file_name AS source_file,
      totalAmount AS total_amount
    FROM ecom_raw""",
)
cte("mobile_norm", ["mobile_raw"], _mobile_norm_sql(False))
cte("mobile_norm_doc", ["mobile_raw"], _mobile_norm_sql(True))
for _suffix in ("", "_doc"):
    cte(
        f"unified{_suffix}",
        [f"pos_norm{_suffix}", "ecom_norm", f"mobile_norm{_suffix}"],
        f"""SELECT {UNIFIED} FROM pos_norm{_suffix}
    UNION ALL SELECT {UNIFIED} FROM ecom_norm
    UNION ALL SELECT {UNIFIED} FROM mobile_norm{_suffix}""",
    )
cte("scored", ["unified"], _scored_sql("unified", clamp=False))
cte("scored_doc", ["unified_doc"], _scored_sql("unified_doc", clamp=True))
cte("silver_main", ["scored"], "SELECT * FROM scored WHERE quality_tier <> 'rejected'")
cte("silver_rejected", ["scored"], "SELECT * FROM scored WHERE quality_tier = 'rejected'")
# The table after the changes of change data capture: by a digest of the
# transaction id, rows of the first days of a month whose key occurs once.
cte(
    "silver_main_cdc",
    ["silver_main"],
    f"""SELECT {', '.join('CASE WHEN kind = 0 OR kind = 2 THEN quantity + 1 ELSE quantity END AS quantity' if c == 'quantity'
        else 'CASE WHEN kind = 2 THEN transaction_date + INTERVAL 40 DAYS ELSE transaction_date END AS transaction_date'
        if c == 'transaction_date' else c for c in SCORED.split(', '))}
    FROM (SELECT *, CASE WHEN once THEN mark % 10 END AS kind FROM ({{marked}}))
    WHERE kind IS NULL OR kind <> 1 OR mark % 50 = 1
    UNION ALL SELECT {SCORED.replace('transaction_id,', "transaction_id || '-N' AS transaction_id,", 1)}
    FROM ({{marked}}) WHERE once AND mark % 10 = 3""".format(
        marked="""SELECT *, CAST('0x' || substr(md5(transaction_id), 1, 8) AS BIGINT) AS mark, dayofmonth(transaction_date) <= 6
          AND count(*) OVER (PARTITION BY source_system, transaction_id) = 1 AS once FROM silver_main"""
    ),
)
for _of in ("", "_cdc"):
    cte(
        f"dedup_w{_of}",
        [f"silver_main{_of}"],
        f"""SELECT {SCORED},
          CASE WHEN customer_id IS NULL OR product_id IS NULL OR transaction_date IS NULL THEN 'no_duplicate'
               WHEN min(prio) OVER w < max(prio) OVER w THEN
                 CASE WHEN row_number() OVER (w ORDER BY prio, {TIE}) = 1 THEN 'kept_by_priority' ELSE 'superseded' END
               WHEN count(*) OVER r = 1 THEN 'no_duplicate'
               WHEN row_number() OVER (r ORDER BY {TIE}) = 1 THEN 'kept_by_priority'
               ELSE 'superseded' END AS duplicate_resolution,
          first_value(source_system) OVER (w ORDER BY prio, {TIE}) AS best_source
        FROM (SELECT *, CASE source_system WHEN 'ecommerce' THEN 1 WHEN 'mobile' THEN 2
                            WHEN 'pos' THEN 3 ELSE 4 END AS prio FROM silver_main{_of})
        WINDOW w AS (PARTITION BY customer_id, product_id, CAST(transaction_date AS DATE)),
          r AS (PARTITION BY customer_id, product_id, CAST(transaction_date AS DATE), transaction_id)""",
    )
    cte(
        f"dedup{_of}",
        [f"dedup_w{_of}"],
        f"""SELECT {SCORED}, duplicate_resolution = 'superseded' AS is_duplicate, duplicate_resolution
        FROM dedup_w{_of}""",
    )
    cte(
        f"usable{_of}",
        [f"dedup{_of}"],
        f"SELECT * FROM dedup{_of} WHERE quality_tier IN ('high', 'medium') AND NOT is_duplicate",
    )
    cte(
        f"gold_revenue{_of}",
        [f"usable{_of}"],
        f"""SELECT source_system, CAST(transaction_date AS DATE) AS transaction_date,
          COUNT(DISTINCT transaction_id) AS transaction_count,
          COUNT(DISTINCT customer_id) AS unique_customers,
          {exact_sum('total_amount')} AS total_revenue,
          {exact_avg('total_amount')} AS avg_transaction_value,
          CAST(SUM(quantity) AS BIGINT) AS total_items_sold,
          COUNT(DISTINCT product_id) AS unique_products
        FROM usable{_of} WHERE transaction_date IS NOT NULL AND total_amount IS NOT NULL
        GROUP BY source_system, CAST(transaction_date AS DATE)""",
    )
    cte(
        f"gold_product{_of}",
        [f"usable{_of}"],
        f"""SELECT product_id, source_system, COUNT(*) AS times_sold,
          CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
          {exact_sum('total_amount')} AS total_revenue,
          {half_up_avg('unit_price', 2)} AS avg_unit_price
        FROM usable{_of} WHERE product_id IS NOT NULL GROUP BY product_id, source_system""",
    )
    cte(
        f"gold_quality{_of}",
        [f"silver_main{_of}"],
        f"""SELECT source_system, quality_tier, COUNT(*) AS record_count,
          {half_up_avg_int('quality_score', 1)} AS avg_quality_score
        FROM silver_main{_of} GROUP BY source_system, quality_tier""",
    )
    cte(
        f"gold_exec{_of}",
        [f"usable{_of}"],
        f"""SELECT DATE '{REPORT_DATE}' AS report_date,
          COUNT(DISTINCT transaction_id) AS total_transactions,
          COUNT(DISTINCT customer_id) AS unique_customers,
          {exact_sum('total_amount')} AS total_revenue,
          {half_up_avg('total_amount', 2)} AS avg_transaction_value,
          {half_up_avg_int('quality_score', 1)} AS avg_data_quality
        FROM usable{_of}""",
    )


def with_ctes(select: str, *needed: str) -> str:
    """``WITH`` every needed CTE (and its dependencies, in order) + select."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    if not order:
        return select
    body = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select}"


def _dims() -> list[tuple[str, str]]:
    # (dimension, failure predicate) in the quality framework's order.
    return [
        ("transaction_id", "transaction_id IS NULL"),
        ("product_id", "product_id IS NULL"),
        ("customer_id", "customer_id IS NULL"),
        ("transaction_date", "transaction_date IS NULL"),
        ("unit_price", "unit_price IS NULL OR unit_price <= 0"),
        ("quantity", "quantity IS NULL OR quantity <= 0"),
        ("status", "coalesce(status = 'unknown', false)"),
        ("store_id", "coalesce(store_id = 'UNKNOWN', false)"),
    ]


def _missing(c: str) -> str:
    return f"({c} IS NULL OR {c} = '' OR {c} IN ('NULL', 'N/A'))"


def _raw_dates() -> str:
    return """SELECT 'pos' AS source, TRANS_DATE AS raw_value FROM pos_raw
      UNION ALL SELECT 'ecommerce', orderDate FROM ecom_raw
      UNION ALL SELECT 'mobile', CAST("timestamp" AS VARCHAR) FROM mobile_raw"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    pos_cols = f"{POS_FIELDS}, {AUDIT}"
    q["bronze_pos"] = with_ctes(f"SELECT {pos_cols} FROM pos_raw", "pos_raw")
    q["bronze_ecommerce"] = with_ctes(
        """SELECT orderId, orderDate, customer_id, customer_email, loyalty_tier, item_count,
          item_quantity_total, first_product_id, first_product_name, first_quantity,
          first_unit_price, first_discount, payment_method, payment_status,
          payment_transaction_id, shipping_method, shipping_country, shipping_city, platform,
          totalAmount, source_system, source_format, ingestion_timestamp, file_name
        FROM ecom_raw""",
        "ecom_raw",
    )
    q["bronze_mobile"] = with_ctes("SELECT * FROM mobile_raw", "mobile_raw")
    q["bronze_sample"] = with_ctes(
        """SELECT TRANS_ID, PRODUCT_CODE, PRICE, QTY, TRANS_DATE, STATUS FROM pos_raw
        ORDER BY TRANS_ID ASC NULLS LAST LIMIT 10""",
        "pos_raw",
    )
    cols = ["TRANS_ID", "CUST_NUM", "PRODUCT_CODE", "PRICE", "TRANS_DATE"]
    counts = ", ".join(f"COUNT(CASE WHEN {_missing(c)} THEN 1 END) AS {c}" for c in cols)
    unions = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS missing_count, total_records, "
        f"{c} / total_records * 100 AS missing_pct FROM prof"
        for c in cols
    )
    q["bronze_missing_profile"] = with_ctes(
        f"SELECT * FROM (WITH prof AS (SELECT COUNT(*) AS total_records, {counts} FROM pos_raw) {unions})",
        "pos_raw",
    )
    q["date_variants"] = with_ctes(
        "SELECT DISTINCT TRANS_DATE FROM pos_raw WHERE TRANS_DATE IS NOT NULL AND TRANS_DATE <> ''",
        "pos_raw",
    )
    q["status_frequency"] = with_ctes(
        'SELECT STATUS, COUNT(*) AS "count" FROM pos_raw GROUP BY STATUS ORDER BY 2 DESC', "pos_raw"
    )
    q["price_nonconforming"] = with_ctes(
        "SELECT TRANS_ID, PRICE FROM pos_raw WHERE NOT coalesce(regexp_matches(PRICE, '^\\d+\\.?\\d*$'), false)",
        "pos_raw",
    )
    src_counts = """SELECT 'POS' AS source, COUNT(*) AS records FROM pos_raw
      UNION ALL SELECT 'E-commerce', COUNT(*) FROM ecom_raw
      UNION ALL SELECT 'Mobile App', COUNT(*) FROM mobile_raw"""
    q["bronze_source_counts"] = with_ctes(src_counts, "pos_raw", "ecom_raw", "mobile_raw")
    q["bronze_total"] = with_ctes(
        f"SELECT CAST(SUM(records) AS BIGINT) AS total_records FROM ({src_counts})",
        "pos_raw",
        "ecom_raw",
        "mobile_raw",
    )
    q["date_parse"] = with_ctes(
        f"SELECT source, raw_value, {date_parse('raw_value')} AS parsed_value FROM ({_raw_dates()})",
        "pos_raw",
        "ecom_raw",
        "mobile_raw",
    )
    q["date_parse_documented"] = with_ctes(
        f"""SELECT source, raw_value, {date_parse('raw_value', True)} AS parsed_value,
          {date_ambiguous('raw_value')} AS date_ambiguous FROM ({_raw_dates()})""",
        "pos_raw",
        "ecom_raw",
        "mobile_raw",
    )
    q["price_clean"] = with_ctes(
        f"SELECT PRICE AS raw_price, {price_clean('PRICE')} AS unit_price FROM pos_raw", "pos_raw"
    )
    q["price_clean_documented"] = with_ctes(
        f"SELECT PRICE AS raw_price, {price_clean('PRICE', True)} AS unit_price FROM pos_raw",
        "pos_raw",
    )
    q["status_standardize"] = with_ctes(
        f"""SELECT source, raw_status, {status('raw_status')} AS status FROM (
          SELECT 'pos' AS source, STATUS AS raw_status FROM pos_raw
          UNION ALL SELECT 'ecommerce', payment_status FROM ecom_raw
          UNION ALL SELECT 'mobile', payment_status FROM mobile_raw)""",
        "pos_raw",
        "ecom_raw",
        "mobile_raw",
    )
    q["store_normalize"] = with_ctes(
        f"SELECT STORE AS raw_store, {store('STORE')} AS store_id FROM pos_raw", "pos_raw"
    )
    q["payment_normalize"] = with_ctes(
        f"SELECT PAYMENT_TYPE AS raw_payment, {payment('PAYMENT_TYPE')} AS payment_method FROM pos_raw",
        "pos_raw",
    )
    q["pos_normalized"] = with_ctes(f"SELECT {UNIFIED} FROM pos_norm", "pos_norm")
    q["ecommerce_normalized"] = with_ctes(f"SELECT {UNIFIED} FROM ecom_norm", "ecom_norm")
    q["mobile_normalized"] = with_ctes(f"SELECT {UNIFIED} FROM mobile_norm", "mobile_norm")
    q["unified_sales"] = with_ctes(f"SELECT {UNIFIED} FROM unified", "unified")
    q["ecommerce_line_items"] = with_ctes(
        f"""SELECT 'ORD-' || {pad('o.o_orderkey', 8)} AS transaction_id,
          try_strptime(strftime(o.o_orderdate, '%Y-%m-%d') || 'T' || {pad('(o.o_orderkey * 13) % 24', 2)}
            || ':' || {pad('(o.o_orderkey * 29) % 60', 2)} || ':00Z', '%Y-%m-%dT%H:%M:%SZ') AS transaction_date,
          CASE WHEN (o.o_orderkey * 7919 + 2) % 100 >= 10 THEN 'CUST-' || {pad('o.o_custkey', 5)} END AS customer_id,
          CAST(l.pos AS INTEGER) AS line_number,
          'PROD-' || {pad('(o.o_orderkey * 31 + l.pos * 7) % 50 + 1', 4)} AS product_id,
          'Product PROD-' || {pad('(o.o_orderkey * 31 + l.pos * 7) % 50 + 1', 4)} AS product_name,
          1 + CAST(l.l_quantity AS BIGINT) % 8 AS quantity,
          CAST(1500 + (l.l_partkey * 3701) % 58500 AS DOUBLE) / 100.0 AS unit_price,
          l.l_discount AS discount,
          (1 + CAST(l.l_quantity AS BIGINT) % 8) * (CAST(1500 + (l.l_partkey * 3701) % 58500 AS DOUBLE) / 100.0) AS gross_amount
        FROM orders o LEFT JOIN ecom_lines l ON l.l_orderkey = o.o_orderkey
        WHERE o.o_orderkey % 20 <> 19
        UNION ALL
        SELECT 'ORD-ERROR-' || CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL,
          NULL, NULL, NULL, NULL
        FROM orders WHERE o_orderkey % 20 = 19""",
        "ecom_lines",
    )
    q["quality_scored"] = with_ctes(f"SELECT {SCORED} FROM scored", "scored")
    q["quality_distribution"] = with_ctes(
        """SELECT source_system, quality_tier, COUNT(*) AS "count" FROM scored
        GROUP BY source_system, quality_tier ORDER BY source_system, quality_tier""",
        "scored",
    )
    q["silver_main"] = with_ctes(f"SELECT {SCORED} FROM silver_main", "silver_main")
    q["silver_rejected"] = with_ctes(f"SELECT {SCORED} FROM silver_rejected", "silver_rejected")
    q["review_flags"] = with_ctes(
        """SELECT source_system, COUNT(*) AS records,
          COUNT(CASE WHEN quantity > 100 AND unit_price < 1 THEN 1 END) AS needs_review
        FROM scored GROUP BY source_system""",
        "scored",
    )
    q["rejection_reasons"] = with_ctes(
        """SELECT source_system, reason, COUNT(*) AS records FROM (
          SELECT source_system, 'missing_transaction_id' AS reason FROM silver_rejected WHERE transaction_id IS NULL
          UNION ALL SELECT source_system, 'missing_product_id' FROM silver_rejected WHERE product_id IS NULL
          UNION ALL SELECT source_system, 'missing_quantity_and_price' FROM silver_rejected
            WHERE quantity IS NULL AND unit_price IS NULL
          UNION ALL SELECT source_system, 'score_below_threshold' FROM silver_rejected
            WHERE transaction_id IS NOT NULL AND product_id IS NOT NULL
              AND NOT (quantity IS NULL AND unit_price IS NULL))
        GROUP BY source_system, reason""",
        "silver_rejected",
    )
    dim_counts = ", ".join(f"COUNT(CASE WHEN {p} THEN 1 END) AS {d}" for d, p in _dims())
    dim_rows = "\nUNION ALL ".join(
        f"SELECT source_system, records, '{d}' AS dimension, {d} AS failures FROM per_source"
        for d, _ in _dims()
    )
    q["quality_issue_ranking"] = with_ctes(
        f"""SELECT * FROM (
          WITH per_source AS (SELECT source_system, COUNT(*) AS records, {dim_counts}
                              FROM scored GROUP BY source_system),
          long AS ({dim_rows})
          SELECT source_system, records, dimension, failures,
            failures / records AS failure_rate,
            CAST(row_number() OVER (PARTITION BY source_system ORDER BY failures DESC, dimension) AS INTEGER) AS issue_rank
          FROM long)
        WHERE issue_rank <= 3 AND failures > 0""",
        "scored",
    )
    q["source_average_quality"] = with_ctes(
        f"""SELECT coalesce(source_system, 'ALL') AS source_system, COUNT(*) AS records,
          {int_avg('quality_score')} AS avg_quality_score
        FROM scored GROUP BY ROLLUP (source_system)""",
        "scored",
    )
    q["dedup_flagged"] = with_ctes(
        f"SELECT {SCORED}, is_duplicate, duplicate_resolution FROM dedup", "dedup"
    )
    q["dedup_summary"] = with_ctes(
        """SELECT source_system, duplicate_resolution, winner_source, records,
          records * 100.0 / SUM(records) OVER (PARTITION BY source_system) AS pct_of_source
        FROM (SELECT source_system, duplicate_resolution,
                CASE WHEN duplicate_resolution = 'superseded' THEN best_source END AS winner_source,
                COUNT(*) AS records
              FROM dedup_w GROUP BY 1, 2, 3)""",
        "dedup_w",
    )
    content = "CUST_NUM, PRODUCT_CODE, QTY, PRICE, TRANS_DATE, STORE, STATUS, PAYMENT_TYPE, CASHIER_ID, REGISTER_NUM"
    q["pos_content_duplicates"] = with_ctes(
        f"""SELECT TRANS_ID, CUST_NUM, PRODUCT_CODE, TRANS_DATE, copies, canonical_id FROM (
          SELECT *, COUNT(*) OVER c AS copies, MIN(TRANS_ID) OVER c AS canonical_id
          FROM pos_raw WHERE TRANS_ID IS NOT NULL WINDOW c AS (PARTITION BY {content}))
        WHERE copies > 1""",
        "pos_raw",
    )
    q["gold_revenue_by_source"] = with_ctes("SELECT * FROM gold_revenue", "gold_revenue")
    q["gold_product_performance"] = with_ctes("SELECT * FROM gold_product", "gold_product")
    q["gold_data_quality_metrics"] = with_ctes("SELECT * FROM gold_quality", "gold_quality")
    q["gold_executive_summary"] = with_ctes("SELECT * FROM gold_exec", "gold_exec")
    q["channel_revenue"] = with_ctes(
        f"""SELECT source_system, {exact_sum('total_revenue')} AS revenue, COUNT(*) AS transactions
        FROM gold_revenue GROUP BY source_system ORDER BY revenue DESC""",
        "gold_revenue",
    )
    trends = f"""SELECT source_system, quality_tier, COUNT(*) AS records,
          {int_avg('quality_score')} AS avg_score FROM silver_main"""
    q["quality_trends"] = with_ctes(f"{trends} GROUP BY source_system, quality_tier", "silver_main")
    q["daily_quality_report"] = with_ctes(
        f"""{trends} WHERE CAST(transformation_timestamp AS DATE) = DATE '{REPORT_DATE}'
        GROUP BY source_system, quality_tier""",
        "silver_main",
    )
    q["quality_trend_7d"] = with_ctes(
        f"""SELECT CAST(transformation_timestamp AS DATE) AS date, {int_avg('quality_score')} AS avg_score
        FROM silver_main
        WHERE transformation_timestamp >= CAST(DATE '{REPORT_DATE}' - 7 AS TIMESTAMP)
        GROUP BY 1 ORDER BY 1""",
        "silver_main",
    )
    layer_rows = [
        ("bronze", "pos_raw", "pos_raw"),
        ("bronze", "ecommerce_raw", "ecom_raw"),
        ("bronze", "mobile_raw", "mobile_raw"),
        ("silver", "unified_sales", "silver_main"),
        ("silver", "unified_sales_deduped", "dedup"),
        ("silver", "sales_rejected", "silver_rejected"),
        ("gold", "revenue_by_source", "gold_revenue"),
        ("gold", "product_performance", "gold_product"),
        ("gold", "data_quality_metrics", "gold_quality"),
        ("gold", "executive_summary", "gold_exec"),
    ]
    q["layer_audit"] = with_ctes(
        "\nUNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {src}"
            for layer, name, src in layer_rows
        ),
        *[src for _, _, src in layer_rows],
    )
    q["landing_pos_csv"] = with_ctes(
        f"SELECT {POS_FIELDS}, source_system, source_format FROM pos_raw", "pos_raw"
    )
    q["landing_ecommerce_json"] = with_ctes(
        """SELECT orderId, orderDate, customer_id, item_count, first_product_id, first_unit_price,
          payment_status, shipping_city, totalAmount, source_system, source_format FROM ecom_raw""",
        "ecom_raw",
    )
    q["landing_paged_api"] = q["landing_ecommerce_json"]
    # The pages, and what each was answered: see the query.
    q["landing_page_report"] = with_ctes(
        """SELECT 'c' || CAST(page AS VARCHAR) AS cursor,
          CAST(1 + (page % 4 = 1)::INT + (page % 5 = 0)::INT + (page % 7 = 2)::INT + (page % 3 = 1)::INT AS BIGINT) AS responses,
          CAST((page % 5 = 0)::INT + (page % 7 = 2)::INT AS BIGINT) AS failed, records, records > 0 AS landed
        FROM (SELECT page, CAST(COUNT(*) AS BIGINT) AS records FROM (
            SELECT CAST(floor(coalesce(TRY_CAST(regexp_extract(orderId, '(\\d+)$', 1) AS BIGINT), 0) / 512) AS BIGINT) AS page FROM ecom_raw)
          GROUP BY page)""",
        "ecom_raw",
    )
    q["bronze_footer_counts"] = with_ctes(
        f"""SELECT source, records FROM ({src_counts})
        UNION ALL SELECT 'all', CAST(SUM(records) AS BIGINT) FROM ({src_counts})""",
        "pos_raw",
        "ecom_raw",
        "mobile_raw",
    )
    new_fields = """SELECT *, CAST(regexp_extract(orderId, '(\\d+)$', 1) AS BIGINT) AS k,
          ingestion_timestamp > TIMESTAMP '2024-03-05' AS late FROM ecom_raw"""
    q["landing_new_fields"] = with_ctes(
        f"""SELECT orderId, customer_id, item_count, totalAmount,
          CASE WHEN late AND k % 2 = 0 THEN k % 3 = 0 END AS gift_wrap,
          CASE WHEN late AND k % 4 = 0 THEN 'C' || CAST(k % 7 AS VARCHAR) END AS campaign_code,
          CASE WHEN late AND k % 4 = 0 THEN k % 5 END AS campaign_percent,
          CASE WHEN late AND k % 5 = 1 AND orderDate IS NOT NULL THEN 'S' || CAST(k % 3 AS VARCHAR) END AS segment,
          CASE WHEN late AND k % 6 = 0 AND item_count > 0 THEN k % 24 END AS first_warranty
        FROM ({new_fields})""",
        "ecom_raw",
    )
    q["landing_discovered_fields"] = with_ctes(
        f"""SELECT * FROM (
          SELECT 'giftWrap' AS field, 'BOOLEAN' AS type, count(*) AS records FROM ({new_fields}) WHERE late AND k % 2 = 0
          UNION ALL SELECT 'campaign', 'OBJECT<code: STRING, percent: BIGINT>', count(*)
            FROM ({new_fields}) WHERE late AND k % 4 = 0
          UNION ALL SELECT 'customer', 'OBJECT<segment: STRING>', count(*)
            FROM ({new_fields}) WHERE late AND k % 5 = 1 AND orderDate IS NOT NULL
          UNION ALL SELECT 'lineItems', 'ARRAY<OBJECT<warrantyMonths: BIGINT>>', count(*)
            FROM ({new_fields}) WHERE late AND k % 6 = 0 AND item_count > 0
        ) WHERE records > 0""",
        "ecom_raw",
    )
    q["type_widening"] = """SELECT o_orderkey AS order_key,
          CASE WHEN o_orderkey % 3 = 2 THEN CAST(floor(o_totalprice) AS DOUBLE)
               ELSE CAST(CAST(floor(o_totalprice) AS FLOAT) AS DOUBLE) END AS price,
          CAST(o_orderdate AS TIMESTAMP) AS ordered, o_orderkey % 100 AS slot, o_orderstatus AS status FROM orders"""
    q["landing_mobile_parquet"] = with_ctes(
        """SELECT transaction_id, product_id, device_id, quantity, amount, "timestamp", app_version,
          platform, payment_status, source_system, source_format FROM mobile_raw""",
        "mobile_raw",
    )
    lake = [
        ("silver.unified_scored", "scored"),
        ("silver.unified_sales", "silver_main"),
        ("silver.sales_rejected", "silver_rejected"),
        ("silver.unified_sales_deduped", "dedup"),
        ("gold.revenue_by_source", "gold_revenue"),
        ("gold.product_performance", "gold_product"),
        ("gold.data_quality_metrics", "gold_quality"),
        ("gold.executive_summary", "gold_exec"),
    ]
    first = {
        "gold.revenue_by_source": "source_system",
        "gold.product_performance": "product_id",
        "gold.data_quality_metrics": "source_system",
        "gold.executive_summary": "report_date",
    }
    q["layer_roundtrip"] = with_ctes(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, "
            f"COUNT(DISTINCT {first.get(name, 'transaction_id')}) AS distinct_keys, "
            f"COUNT({first.get(name, 'total_amount')}) AS filled FROM {src}"
            for name, src in lake
        ),
        *[src for _, src in lake],
    )
    stored = [(f"{layer}.{name}", src) for layer, name, src in layer_rows if name not in ("unified_sales", "sales_rejected")]
    stored.append(("silver.unified_scored", "scored"))
    q["file_inventory"] = with_ctes(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, true AS has_files, true AS sizes_fit, COUNT(*) AS row_count FROM {src}"
            for name, src in stored
        ),
        *[src for _, src in stored],
    )
    fields = "[" + ", ".join(f"'{c}'" for c in "abcdefghijkl") + "]"
    q["landing_rejects"] = f"""
        SELECT 'pos' AS feed, true AS from_text_file, CASE o_orderkey % 50
          WHEN 0 THEN 'POS' || CAST(o_orderkey AS VARCHAR) || ',C1,SKU-1,1'
          ELSE 'POS,' || CAST(o_orderkey AS VARCHAR) || ',' || array_to_string({fields}, ',') END AS raw_text
        FROM orders WHERE o_orderkey % 50 < 2
        UNION ALL
        SELECT 'ecommerce', true, '{{"orderId": "ORD-' || CAST(o_orderkey AS VARCHAR) || '", "customer": {{"cust'
        FROM orders WHERE o_orderkey % 50 = 2"""
    q["epoch_range"] = """
        SELECT event_id, CAST(v AS VARCHAR) AS raw_value,
          CASE WHEN abs(v) <= 9223372036854 THEN v END AS seconds
        FROM (SELECT event_id, unnest([s, s * 1000, -s * 1000, s * 1000000]) AS v
              FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events))"""
    # Whole cents of the ordinary totals are added as integers.
    q["exact_aggregates"] = """
        WITH v AS (
          SELECT CAST(o_orderkey % 97 AS INTEGER) AS g, o_orderkey BETWEEN 1 AND 6 AS odd,
            CASE o_orderkey WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE)
              WHEN 3 THEN 1e20 WHEN 4 THEN 1e28 WHEN 5 THEN 1e33 WHEN 6 THEN -1e33
              ELSE CASE WHEN o_orderkey % 97 <> 7 THEN o_totalprice END END AS x FROM orders
        ), s AS (
          SELECT g, COUNT(x) AS n, MAX(CASE WHEN odd THEN x END) AS special,
            SUM(CASE WHEN NOT odd THEN CAST(round(x * 100) AS HUGEINT) END) AS cents FROM v GROUP BY g
        ), t AS (
          SELECT g, n, special, cents,
            CASE WHEN special IS NOT NULL THEN special ELSE CAST(cents AS DOUBLE) / 100 END AS total FROM s
        ), u AS (
          SELECT *, total / n AS mean,
            CASE WHEN special IS NOT NULL THEN total / n
              ELSE CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 END AS mean_2 FROM t
        )
        SELECT g, n, """ + ", ".join(
        f"CASE WHEN isnan({c}) OR isinf({c}) OR abs({c}) < 1e15 THEN {c} "
        f"ELSE sign({c}) * round(log10(abs({c})), 6) END AS {c}"
        for c in ("total", "mean", "mean_2")
    ) + " FROM u"
    q["snapshot_history"] = with_ctes(
        """SELECT CAST(v AS BIGINT) AS version, op AS operation, (SELECT COUNT(*) FROM silver_main) AS num_rows
        FROM (VALUES (0, 'WRITE'), (1, 'OVERWRITE'), (2, 'OPTIMIZE')) AS t(v, op)""",
        "silver_main",
    )
    q["snapshot_as_of"] = with_ctes(
        f"SELECT {SCORED}, false AS is_duplicate, 'no_duplicate' AS duplicate_resolution FROM silver_main",
        "silver_main",
    )
    q["snapshot_diff"] = with_ctes(
        f"""SELECT {SCORED}, is_duplicate, duplicate_resolution, 'added' AS change
          FROM dedup WHERE duplicate_resolution <> 'no_duplicate'
        UNION ALL
        SELECT {SCORED}, false, 'no_duplicate', 'removed'
          FROM dedup WHERE duplicate_resolution <> 'no_duplicate'""",
        "dedup",
    )
    dedup_cols = f"SELECT {SCORED}, is_duplicate, duplicate_resolution FROM dedup"
    q["compact_table"] = with_ctes(dedup_cols, "dedup")
    q["compact_partitions"] = with_ctes(
        """SELECT source_system, count(*) AS records, count(DISTINCT transaction_id) AS ids,
          CASE source_system WHEN 'pos' THEN 24 WHEN 'mobile' THEN 9 ELSE 1 END AS files_before, 1 AS files_after
        FROM silver_main GROUP BY source_system""",
        "silver_main",
    )
    q["cluster_table"] = with_ctes(dedup_cols, "dedup")
    q["point_lookup"] = with_ctes(
        f"""SELECT {SCORED} FROM silver_main WHERE transaction_id IN (
          SELECT transaction_id FROM (SELECT DISTINCT transaction_id FROM silver_main) ORDER BY md5(transaction_id) NULLS LAST LIMIT 25)""",
        "silver_main",
    )
    q["schema_evolution"] = with_ctes(
        f"""SELECT {SCORED}, CASE WHEN source_system <> 'pos' THEN 'online' END AS channel_group
        FROM silver_main""",
        "silver_main",
    )
    q["stream_silver"] = with_ctes(f"SELECT {SCORED} FROM scored", "scored")
    q["stream_dedup"] = with_ctes(
        f"""SELECT {SCORED}, dedup_day FROM (
          SELECT *, CAST(transaction_date AS DATE) AS dedup_day,
            row_number() OVER (PARTITION BY customer_id, product_id, CAST(transaction_date AS DATE)
              ORDER BY ingestion_timestamp, source_system, {TIE}) AS arrival
          FROM silver_main
          WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND transaction_date IS NOT NULL)
        WHERE arrival = 1
        UNION ALL
        SELECT {SCORED}, CAST(transaction_date AS DATE) AS dedup_day
        FROM silver_main
        WHERE customer_id IS NULL OR product_id IS NULL OR transaction_date IS NULL""",
        "silver_main",
    )
    drop = """least(greatest(coalesce((year(transaction_date) - 1992) // 2, 0), 0), 3)
              + CASE WHEN CAST('0x' || substr(md5(transaction_id), 1, 8) AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END"""
    q["stream_dedup_watermark"] = q["stream_dedup"].replace("ORDER BY ingestion_timestamp", f"ORDER BY {drop}, ingestion_timestamp")
    q["stream_revenue_windows"] = with_ctes(
        f"""SELECT source_system, CAST(transaction_date AS DATE) AS transaction_date,
          COUNT(*) AS transactions, {exact_sum('total_amount')} AS revenue
        FROM (SELECT *, max(CAST(transaction_date AS DATE)) OVER () AS latest FROM silver_main
          WHERE quality_tier IN ('high', 'medium') AND transaction_date IS NOT NULL AND total_amount IS NOT NULL)
        WHERE CAST(transaction_date AS DATE) + 1 <= latest - 30 GROUP BY 1, 2""",
        "silver_main",
    )
    q["stream_revenue"] = with_ctes(
        f"""SELECT source_system, CAST(transaction_date AS DATE) AS transaction_date,
          COUNT(*) AS transactions, {exact_sum('total_amount')} AS revenue
        FROM silver_main
        WHERE quality_tier IN ('high', 'medium') AND transaction_date IS NOT NULL AND total_amount IS NOT NULL
        GROUP BY 1, 2""",
        "silver_main",
    )
    q["incremental_upsert"] = with_ctes(
        """SELECT transaction_id, transaction_date, customer_id, product_id, quantity, unit_price,
          store_id, CASE WHEN upd THEN 'completed' ELSE status END AS status, payment_method,
          source_system,
          CASE WHEN upd THEN ingestion_timestamp + INTERVAL 10 DAY ELSE ingestion_timestamp END AS ingestion_timestamp,
          source_file, total_amount, quality_score, quality_tier,
          CASE WHEN upd THEN transformation_timestamp + INTERVAL 10 DAY ELSE transformation_timestamp END
            AS transformation_timestamp, needs_review
        FROM (SELECT *, source_system = 'ecommerce' AND status = 'pending'
                AND CAST(ingestion_timestamp AS DATE) <= DATE '2024-03-05' AS upd
              FROM silver_main)""",
        "silver_main",
    )
    q["unified_sales_documented"] = with_ctes(f"SELECT {UNIFIED} FROM unified_doc", "unified_doc")
    q["quality_distribution_documented"] = with_ctes(
        """SELECT source_system, quality_tier, COUNT(*) AS "count", MIN(quality_score) AS min_score
        FROM scored_doc GROUP BY source_system, quality_tier""",
        "scored_doc",
    )
    q["dedup_stub"] = with_ctes(
        f"SELECT {SCORED}, false AS is_duplicate, 'no_duplicate' AS duplicate_resolution FROM silver_main",
        "silver_main",
    )
    q["gold_revenue_by_source_no_dedup"] = with_ctes(
        f"""SELECT source_system, CAST(transaction_date AS DATE) AS transaction_date,
          COUNT(DISTINCT transaction_id) AS transaction_count,
          COUNT(DISTINCT customer_id) AS unique_customers,
          {exact_sum('total_amount')} AS total_revenue,
          {exact_avg('total_amount')} AS avg_transaction_value,
          CAST(SUM(quantity) AS BIGINT) AS total_items_sold,
          COUNT(DISTINCT product_id) AS unique_products
        FROM silver_main
        WHERE quality_tier IN ('high', 'medium') AND transaction_date IS NOT NULL
          AND total_amount IS NOT NULL
        GROUP BY source_system, CAST(transaction_date AS DATE)""",
        "silver_main",
    )
    q["bucketed_upsert"] = q["incremental_upsert"]
    q["bucketed_dedup_keys"] = with_ctes(
        """SELECT customer_id, product_id, CAST(transaction_date AS DATE) AS dedup_day, count(*) AS records,
          min(prio) AS best_priority, max(prio) AS worst_priority
        FROM (SELECT *, CASE source_system WHEN 'ecommerce' THEN 1 WHEN 'mobile' THEN 2 WHEN 'pos' THEN 3 ELSE 4 END AS prio
          FROM silver_main)
        WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND transaction_date IS NOT NULL
        GROUP BY 1, 2, 3 HAVING min(prio) < max(prio)""",
        "silver_main",
    )
    for name, source in (("incremental_run", "dedup"), ("cdc_apply", "dedup_cdc")):
        q[name] = with_ctes(
            f"""SELECT transaction_id, transaction_date, customer_id, product_id, quantity, unit_price,
              store_id, status, payment_method, source_system, total_amount, quality_score,
              quality_tier, needs_review, is_duplicate, duplicate_resolution
            FROM {source}""",
            source,
        )
    figures = [
        ("revenue_by_source", "gold_revenue_cdc", "source_system", "CAST(transaction_date AS VARCHAR)",
         "transaction_count unique_customers unique_products total_revenue avg_transaction_value"),
        ("product_performance", "gold_product_cdc", "source_system", "product_id",
         "times_sold total_quantity_sold total_revenue avg_unit_price"),
        ("data_quality_metrics", "gold_quality_cdc", "source_system", "quality_tier", "record_count avg_quality_score"),
        ("executive_summary", "gold_exec_cdc", "NULL", "CAST(report_date AS VARCHAR)",
         "total_transactions unique_customers total_revenue avg_transaction_value avg_data_quality"),
    ]
    parts = []
    for table, source, system, key, names in figures:
        columns = names.split() + ["NULL"] * (5 - len(names.split()))
        shown = ", ".join(f"CAST({c} AS DOUBLE) AS figure_{i}" for i, c in enumerate(columns, 1))
        parts.append(f"SELECT '{table}' AS table_name, {system} AS source_system, {key} AS key, {shown} FROM {source}")
    q["cdc_gold"] = with_ctes("\nUNION ALL ".join(parts), *[f[1] for f in figures])
    return q
