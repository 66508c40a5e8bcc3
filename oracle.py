"""Plain-SQL statements of the same results, for the check against an independent engine.

``BASE`` derives the landed tables from the star schema; the statements below build on it. Money
is carried as whole cents up to the first division, so that both engines round the same numbers.
"""

from types import SimpleNamespace

BASE = """
placed AS MATERIALIZED (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders),
halved AS (
  SELECT *, CASE WHEN c % 5 = 0 AND n >= 4 THEN n // 2 ELSE 0 END AS n2 FROM placed),
split AS (
  SELECT *, place > n - n2 AS second,
         CASE WHEN place > n - n2 THEN place - (n - n2) ELSE place END AS ver,
         CASE WHEN place > n - n2 THEN n2 ELSE n - n2 END AS size
  FROM halved),
kinds AS (
  SELECT *, printf('CTR-%06d-%d', c, CASE WHEN second THEN 2 ELSE 1 END) AS contract_id,
         printf('ACC-%06d', c) AS account_id, printf('INV-%07d', k) AS invoice_id,
         CASE WHEN ver = 1 THEN 'new'
              WHEN ver = size AND ((c % 10 = 0 AND NOT second) OR c % 12 = 1) THEN 'churn'
              WHEN pr = '1-URGENT' THEN 'upsell' WHEN pr = '2-HIGH' THEN 'downgrade'
              WHEN pr = '4-NOT SPECIFIED' THEN 'currency_change' ELSE 'renewal' END AS kind
  FROM split),
deals AS MATERIALIZED (
  SELECT *, ['USD', 'EUR', 'INR'][CAST((c + sum(CASE WHEN kind = 'currency_change' THEN 1 ELSE 0 END)
           OVER (PARTITION BY contract_id ORDER BY ver)) % 3 AS INTEGER) + 1] AS currency
  FROM kinds),
created AS (SELECT o_custkey AS c, CAST(min(o_orderdate) AS DATE) AS created_date
            FROM orders GROUP BY 1),
acc AS MATERIALIZED (
  SELECT printf('ACC-%06d', c_custkey) AS account_id, c_name AS account_name, region,
         CASE region WHEN 'US' THEN 'Northfall Ledgers Inc.'
                     WHEN 'EU' THEN 'Northfall Ledgers Europe B.V.'
                     ELSE 'Northfall Ledgers India Pvt. Ltd.' END AS legal_entity,
         CASE region WHEN 'US' THEN 'USD' WHEN 'EU' THEN 'EUR' ELSE 'INR' END AS currency,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'SMB'
              WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Mid-Market'
              ELSE 'Enterprise' END AS segment,
         lower(c_mktsegment) AS industry, created_date
  FROM (SELECT customer.*, created_date, CASE WHEN n_regionkey IN (0, 1) THEN 'US'
               WHEN n_regionkey IN (3, 4) THEN 'EU' ELSE 'IN' END AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN created ON c = c_custkey) t),
contract_rows AS MATERIALIZED (
  SELECT contract_id, CAST(ver AS BIGINT) AS version_number, account_id,
         d AS effective_start_date, CASE WHEN kind = 'churn' THEN d END AS effective_end_date,
         CASE WHEN kind = 'churn' THEN 0 ELSE cents END AS arr_cents, currency,
         k % 495 + 5 AS seats, ['Starter', 'Growth', 'Enterprise'][k % 3 + 1] AS plan_tier,
         kind AS amendment_type,
         CASE WHEN k % 4 = 0 THEN d + CAST(k % 30 + 10 AS INTEGER) ELSE d END AS created_at,
         k % 4 = 0 AS is_backdated, CASE WHEN n2 > 0 THEN account_id END AS co_termination_group
  FROM deals),
cust AS (
  SELECT a.account_id, v AS version, 'Contact ' || c || ' v' || v AS billing_contact_name,
         'billing' || c || CASE WHEN c % 500 = 7 THEN '' ELSE '@firm' || (c % 97) || '.example' END
           AS billing_contact_email,
         printf('TX-%09d', c * 7919 % 1000000000) AS tax_id,
         (c % 900 + 100) || ' Main Street, Unit ' || v AS address_line1,
         'City ' || (c % 53) AS city, a.region, a.legal_entity,
         CASE WHEN v = 2 THEN created.created_date + 200 ELSE created.created_date END AS updated_at
  FROM created JOIN acc a ON a.account_id = printf('ACC-%06d', c),
       (SELECT unnest([1, 2]) AS v) vs
  WHERE v = 1 OR c % 8 = 0),
order_days AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
               FROM orders),
fx_days AS (SELECT lo + CAST(i AS INTEGER) AS rate_date, i + 1 AS i
            FROM (SELECT lo, unnest(range(hi - lo + 1)) AS i FROM order_days) t
            WHERE i % 7 NOT IN (0, 6)),
fx_raw AS MATERIALIZED (
  SELECT rate_date, 'USD' AS quote_currency, CAST(1 AS DECIMAL(18, 6)) AS fx_rate FROM fx_days
  UNION ALL SELECT rate_date, 'EUR',
    CAST(0.920137 AS DECIMAL(18, 6)) + CAST((i * 37 % 101) / 10000.0 AS DECIMAL(18, 6)) FROM fx_days
  UNION ALL SELECT rate_date, 'INR',
    CAST(83.000071 AS DECIMAL(18, 6)) + CAST((i * 53 % 211) / 100.0 AS DECIMAL(18, 6)) FROM fx_days),
inv AS MATERIALIZED (
  SELECT invoice_id, contract_id, account_id, d AS invoice_date, currency, cents, k
  FROM deals WHERE kind <> 'churn'),
li AS MATERIALIZED (
  SELECT printf('INV-%07d', l_orderkey) AS invoice_id, l_orderkey AS k, l_partkey, l_suppkey,
         CAST(l_shipdate AS DATE) AS ship_date,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(l_quantity AS BIGINT) AS quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_shipdate, l_extendedprice, l_quantity) AS line
  FROM lineitem),
lines AS (
  SELECT li.invoice_id || '-L' || line AS invoice_line_id, li.invoice_id,
         'Part ' || l_partkey AS description, quantity,
         CAST((li.cents * 200 + quantity) // (2 * quantity) AS DECIMAL(18, 4)) / 10000 AS unit_amount,
         li.cents, invoice_date
  FROM li JOIN inv USING (invoice_id)),
pay AS MATERIALIZED (
  SELECT printf('PAY-%07d-%03d', li.k, line) || copy AS payment_id, li.invoice_id, account_id,
         ship_date AS payment_date, li.cents, currency
  FROM li JOIN inv USING (invoice_id), (SELECT unnest(['', '-D']) AS copy) copies
  WHERE copy = '' OR l_suppkey % 33 = 0),
paid AS MATERIALIZED (
  SELECT min(payment_id) AS payment_id, invoice_id, any_value(account_id) AS account_id,
         payment_date, cents, currency
  FROM pay GROUP BY invoice_id, payment_date, cents, currency),
memo AS MATERIALIZED (
  SELECT printf('CM-%06d', k) AS credit_memo_id, invoice_id, account_id,
         invoice_date + 15 AS issue_date, invoice_date + 15 + CAST(k % 60 + 5 AS INTEGER)
           AS system_entry_date,
         currency, (cents + 1) // 2 AS cents,
         ['service_credit', 'billing_error', 'goodwill', 'downgrade_proration'][k % 4 + 1] AS reason
  FROM inv WHERE k % 25 = 0),
gl AS MATERIALIZED (
  SELECT 'JE-' || invoice_id || '-' || n AS je_id, invoice_date AS posting_date, gl_account,
         debit_credit, cents, currency, invoice_id AS reference_id, 'AUTO_INVOICE' AS je_type
  FROM inv, (VALUES (1, '4000-SUBSCRIPTION-REVENUE', 'CREDIT'),
                    (2, '1200-ACCOUNTS-RECEIVABLE', 'DEBIT')) legs(n, gl_account, debit_credit)
  UNION ALL
  SELECT 'JE-' || payment_id || '-' || n, payment_date, gl_account, debit_credit, cents, currency,
         invoice_id, 'AUTO_PAYMENT'
  FROM paid, (VALUES (1, '1000-CASH', 'DEBIT'),
                     (2, '1200-ACCOUNTS-RECEIVABLE', 'CREDIT')) legs(n, gl_account, debit_credit)
  UNION ALL
  SELECT 'JE-ADJ-' || invoice_id || '-' || n, invoice_date, gl_account,
         CASE WHEN (k % 11 > 5) = (n = 1) THEN 'DEBIT' ELSE 'CREDIT' END, abs(k % 11 - 5) * 100,
         currency, invoice_id, 'MANUAL_ADJUSTMENT'
  FROM inv, (VALUES (1, '4900-REVENUE-ADJUSTMENT'),
                    (2, '4000-SUBSCRIPTION-REVENUE')) legs(n, gl_account)
  WHERE k % 100 = 0 AND k % 11 <> 5),
edges AS MATERIALIZED (
  SELECT min(x) AS lo, max(x) AS hi FROM (
    SELECT min(rate_date) AS x FROM fx_raw UNION ALL SELECT max(rate_date) FROM fx_raw
    UNION ALL SELECT min(effective_start_date) FROM contract_rows
    UNION ALL SELECT max(effective_start_date) FROM contract_rows
    UNION ALL SELECT min(created_date) FROM acc UNION ALL SELECT max(created_date) FROM acc
    UNION ALL SELECT min(invoice_date) FROM inv UNION ALL SELECT max(invoice_date) FROM inv) t),
days AS (SELECT lo + CAST(unnest(range(hi - lo + 1)) AS INTEGER) AS date_day FROM edges),
months AS MATERIALIZED (
  SELECT DISTINCT last_day(date_day) AS month_end_date FROM days, edges
  WHERE last_day(date_day) <= hi),
grid AS (SELECT date_day AS rate_date, quote_currency
         FROM days, (SELECT unnest(['USD', 'EUR', 'INR']) AS quote_currency) q),
fxd AS MATERIALIZED (
  SELECT g.rate_date, g.quote_currency,
         coalesce(r.fx_rate, (SELECT arg_min(f.fx_rate, f.rate_date) FROM fx_raw f
                              WHERE f.quote_currency = g.quote_currency)) AS fx_rate,
         r.rate_date IS NULL OR r.rate_date <> g.rate_date AS is_fx_rate_filled
  FROM grid g ASOF LEFT JOIN fx_raw r
    ON r.quote_currency = g.quote_currency AND r.rate_date <= g.rate_date),
ver AS MATERIALIZED (
  SELECT *, md5(contract_id || '-' || version_number) AS contract_version_sk,
         coalesce(lead(effective_start_date) OVER (PARTITION BY contract_id ORDER BY version_number),
                  effective_end_date, DATE '9999-12-31') AS effective_end_date_exclusive
  FROM contract_rows),
life AS (
  SELECT contract_id, account_id, min(effective_start_date) AS since,
         max(effective_start_date) FILTER (WHERE amendment_type = 'churn') AS gone
  FROM ver GROUP BY ALL),
reported AS (
  SELECT life.contract_id, life.account_id, m.month_end_date
  FROM life JOIN months m ON m.month_end_date >= since
   AND (gone IS NULL OR (m.month_end_date <= last_day(gone)
        AND last_day(gone) <= (SELECT max(month_end_date) FROM months)))),
carr AS MATERIALIZED (
  SELECT r.month_end_date, r.contract_id, r.account_id, acc.region, acc.legal_entity, acc.segment,
         v.version_number, coalesce(v.arr_cents, 0) AS local_cents, v.currency, v.seats,
         v.plan_tier, v.amendment_type, v.is_backdated, v.co_termination_group, f.fx_rate,
         CAST(round(coalesce(v.arr_cents, 0) / 100.0 / f.fx_rate, 2) AS DECIMAL(18, 2)) AS arr_usd
  FROM reported r JOIN acc USING (account_id)
  LEFT JOIN ver v ON v.contract_id = r.contract_id AND v.amendment_type <> 'churn'
    AND r.month_end_date >= v.effective_start_date
    AND r.month_end_date < v.effective_end_date_exclusive
  JOIN fxd f ON f.rate_date = r.month_end_date AND f.quote_currency = coalesce(v.currency, 'USD')),
aarr AS MATERIALIZED (
  SELECT *, coalesce(lag(account_arr_usd) OVER h, 0) AS prior_account_arr_usd,
         coalesce(max(account_arr_usd) OVER (h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           > 0 AS account_ever_had_arr_before
  FROM (SELECT month_end_date, account_id, region, legal_entity, sum(arr_usd) AS account_arr_usd
        FROM carr GROUP BY ALL) t
  WINDOW h AS (PARTITION BY account_id ORDER BY month_end_date)),
chained AS (
  SELECT carr.*, row_number() OVER h AS seq, lag(month_end_date) OVER h AS prior_month,
         coalesce(lag(arr_usd) OVER h, 0) AS prior_usd
  FROM carr WINDOW h AS (PARTITION BY contract_id ORDER BY month_end_date)),
bri AS MATERIALIZED (
  SELECT b.*, aarr.prior_account_arr_usd, aarr.account_ever_had_arr_before,
         CAST(CASE WHEN seq = 1 THEN arr_usd
              ELSE round(local_cents / 100.0 / p.fx_rate - prior_usd, 2) END AS DECIMAL(18, 2))
           AS real_usd,
         CAST(CASE WHEN seq = 1 THEN 0
              ELSE round(arr_usd - local_cents / 100.0 / p.fx_rate, 2) END AS DECIMAL(18, 2))
           AS drift_usd
  FROM chained b JOIN aarr USING (account_id, month_end_date)
  LEFT JOIN fxd p ON p.rate_date = prior_month AND p.quote_currency = coalesce(b.currency, 'USD')),
mov AS MATERIALIZED (
  SELECT *, CASE
      WHEN seq = 1 AND prior_account_arr_usd <> 0 THEN 'expansion'
      WHEN seq = 1 AND account_ever_had_arr_before THEN 'reactivation'
      WHEN seq = 1 THEN 'new'
      WHEN arr_usd = 0 AND prior_usd > 0 THEN 'churn'
      WHEN real_usd = 0 THEN 'no_change'
      ELSE if(real_usd > 0, 'expansion', 'contraction') END AS movement_type
  FROM bri),
awf AS MATERIALIZED (
  SELECT month_end_date, account_id, region, legal_entity, segment,
         sum(arr_usd) AS account_arr_usd,
         coalesce(sum(real_usd) FILTER (movement_type = 'new'), 0) AS new_arr_usd,
         coalesce(sum(real_usd) FILTER (movement_type = 'expansion'), 0) AS expansion_arr_usd,
         coalesce(sum(real_usd) FILTER (movement_type = 'contraction'), 0) AS contraction_arr_usd,
         coalesce(sum(real_usd) FILTER (movement_type = 'churn'), 0) AS churn_arr_usd,
         coalesce(sum(real_usd) FILTER (movement_type = 'reactivation'), 0) AS reactivation_arr_usd,
         sum(drift_usd) AS fx_impact_usd
  FROM mov GROUP BY ALL),
pwf AS MATERIALIZED (
  SELECT month_end_date, total_arr_usd,
         lag(total_arr_usd) OVER (ORDER BY month_end_date) AS prior_total_arr_usd,
         * EXCLUDE (month_end_date, total_arr_usd)
  FROM (SELECT month_end_date, sum(account_arr_usd) AS total_arr_usd,
               sum(new_arr_usd) AS new_arr_usd, sum(expansion_arr_usd) AS expansion_arr_usd,
               sum(contraction_arr_usd) AS contraction_arr_usd,
               sum(churn_arr_usd) AS churn_arr_usd,
               sum(reactivation_arr_usd) AS reactivation_arr_usd,
               sum(fx_impact_usd) AS fx_impact_usd,
               sum(new_arr_usd + expansion_arr_usd + contraction_arr_usd + churn_arr_usd
                   + reactivation_arr_usd + fx_impact_usd) AS net_movement_usd
        FROM awf GROUP BY 1) t),
money AS MATERIALIZED (
  SELECT 'billed' AS what, invoice_date AS day, account_id, cents / 100.0 AS amount, currency,
         CAST(invoice_date AS TIMESTAMP) AS arrived FROM inv
  UNION ALL SELECT 'credit', issue_date, account_id, cents / 100.0, currency, system_entry_date
  FROM memo
  UNION ALL SELECT 'collected', payment_date, account_id, cents / 100.0, currency, payment_date
  FROM paid
  UNION ALL SELECT CASE WHEN gl_account <> '4000-SUBSCRIPTION-REVENUE' THEN 'other'
                        WHEN je_type = 'MANUAL_ADJUSTMENT' THEN 'manual' ELSE 'recognized' END,
         posting_date, inv.account_id,
         CASE WHEN debit_credit = 'CREDIT' THEN gl.cents ELSE -gl.cents END / 100.0, gl.currency,
         posting_date
  FROM gl JOIN inv ON inv.invoice_id = reference_id),
usd AS MATERIALIZED (
  SELECT what, CAST(date_trunc('month', day) AS DATE) AS month_start, legal_entity,
         amount / fx_rate AS amount, arrived
  FROM money JOIN acc USING (account_id)
  LEFT JOIN fxd ON rate_date = day AND quote_currency = money.currency)
"""


def reconciled(name: str, condition: str = "TRUE") -> str:
    """Reconciliation over the facts that meet a condition, as a named subquery."""
    return f"""
{name} AS (
  SELECT month_start, legal_entity,
    round(coalesce(sum(amount) FILTER (what = 'billed'), 0), 2) AS billed_usd,
    round(coalesce(sum(amount) FILTER (what IN ('recognized', 'manual')), 0), 2) AS recognized_usd,
    round(coalesce(sum(amount) FILTER (what = 'credit'), 0), 2) AS credit_usd,
    round(coalesce(sum(amount) FILTER (what = 'collected'), 0), 2) AS collected_usd,
    round(coalesce(sum(amount) FILTER (what = 'manual'), 0), 2) AS manual_adjustment_usd,
    round(coalesce(sum(amount) FILTER (what IN ('recognized', 'manual')), 0)
          - coalesce(sum(amount) FILTER (what = 'credit'), 0), 2) AS recognized_net_of_credits_usd
  FROM usd WHERE {condition} GROUP BY 1, 2)"""


RECON = reconciled("rec")
# Ledger lines that came before their invoice had no entity then; their zero rows stay.
ORPHANS = """
    SELECT DISTINCT CAST(date_trunc('month', posting_date) AS DATE) AS month_start,
      CAST(NULL AS VARCHAR) AS legal_entity, {zeros}
    FROM gl JOIN inv ON inv.invoice_id = reference_id
    WHERE posting_date < DATE '2001-06-02' AND invoice_date >= DATE '2001-06-02'"""
RECON_MEASURES = ("billed_usd", "recognized_usd", "credit_usd", "collected_usd",
                  "manual_adjustment_usd", "recognized_net_of_credits_usd")
MOVES = ("new_arr_usd", "expansion_arr_usd", "contraction_arr_usd", "churn_arr_usd",
         "reactivation_arr_usd", "fx_impact_usd")
SINCE = "TIMESTAMP '2001-06-02'"


def q(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *[m.strip() for m in more]]) + "\n" + select.strip()


def cents(expr: str, alias: str | None = None, digits: int = 2) -> str:
    return f"CAST({expr} AS DECIMAL(38, {digits})) AS {alias or expr}"


def amount(alias: str = "amount", source: str = "cents") -> str:
    return cents(f"round({source} / 100.0, 2)", alias)


def cents_of(columns) -> str:
    return ", ".join(cents(c) for c in columns)


STG = {
    "accounts": "account_id, account_name, region, legal_entity, currency, segment, industry, "
                "created_date AS account_created_date, CAST(created_date AS TIMESTAMP) AS _loaded_at "
                "FROM acc",
    "contracts": "md5(contract_id || '-' || version_number) AS contract_version_sk, contract_id, "
                 "version_number, account_id, effective_start_date, effective_end_date, "
                 + amount("arr_amount", "arr_cents") + ", currency, seats, plan_tier, "
                 "amendment_type, created_at AS contract_version_recorded_at, is_backdated, "
                 "co_termination_group, CAST(created_at AS TIMESTAMP) AS _loaded_at "
                 "FROM contract_rows",
    "customer_master": "md5(account_id || '-' || version) AS customer_master_sk, account_id, "
                       "CAST(version AS BIGINT) AS customer_master_version, billing_contact_name, "
                       "billing_contact_email, tax_id, address_line1, city, region, legal_entity, "
                       "updated_at, CAST(updated_at AS TIMESTAMP) AS _loaded_at FROM cust",
    "fx_rates": "rate_date, 'USD' AS base_currency, quote_currency, "
                + cents("fx_rate", digits=6) + ", CAST(rate_date AS TIMESTAMP) AS _loaded_at "
                "FROM fx_raw",
    "invoices": "invoice_id, contract_id, account_id, invoice_date, currency, " + amount()
                + ", CAST(invoice_date AS TIMESTAMP) AS _loaded_at FROM inv",
    "invoice_line_items": "invoice_line_id, invoice_id, description, quantity, "
                          + cents("unit_amount", digits=4) + ", " + amount()
                          + ", CAST(invoice_date AS TIMESTAMP) AS _loaded_at FROM lines",
    "credit_memos": "credit_memo_id, invoice_id, account_id, issue_date, system_entry_date, "
                    "currency, " + amount() + ", reason, "
                    "CAST(system_entry_date AS TIMESTAMP) AS _loaded_at FROM memo",
    "payments": "payment_id, invoice_id, account_id, payment_date, " + amount() + ", currency, "
                "CAST(payment_date AS TIMESTAMP) AS _loaded_at FROM paid",
    "gl_journal_entries": "je_id, posting_date, gl_account, debit_credit, " + amount()
                          + ", currency, reference_id AS invoice_id, je_type, "
                          "CAST(posting_date AS TIMESTAMP) AS _loaded_at FROM gl",
}

ARR_MODELS = {
    "date_spine_daily": ("SELECT date_day FROM days"),
    "month_end_spine": ("SELECT month_end_date FROM months"),
    "fx_daily_filled": (f"SELECT rate_date, quote_currency, {cents('fx_rate', digits=6)}, "
                         "is_fx_rate_filled FROM fxd"),
    "contract_versions": f"""
        SELECT contract_version_sk, contract_id, version_number, account_id, acc.region,
          acc.legal_entity, effective_start_date, effective_end_date_exclusive,
          {amount('arr_amount', 'arr_cents')}, ver.currency, seats, plan_tier, amendment_type,
          created_at AS contract_version_recorded_at, is_backdated, co_termination_group,
          amendment_type = 'churn' AS is_churn_version
        FROM ver JOIN acc USING (account_id)""",
    "customer_master_versions": """
        SELECT md5(account_id || '-' || version) AS customer_master_sk, account_id,
          CAST(version AS BIGINT) AS customer_master_version, billing_contact_name,
          billing_contact_email, tax_id, address_line1, city, region, legal_entity, updated_at,
          coalesce(lead(updated_at) OVER (PARTITION BY account_id ORDER BY version),
                   DATE '9999-12-31') AS effective_end_date_exclusive,
          version = max(version) OVER (PARTITION BY account_id) AS is_current_version
        FROM cust""",
    "contract_arr_monthly": f"""
        SELECT month_end_date, contract_id, account_id, region, legal_entity, segment,
          version_number, {amount('arr_local', 'local_cents')}, currency, seats, plan_tier,
          amendment_type, is_backdated, co_termination_group,
          {cents('fx_rate', 'fx_rate_at_month_end', 6)}, {cents('arr_usd')}
        FROM carr""",
    "account_arr_monthly": f"""
        SELECT month_end_date, account_id, region, legal_entity, {cents('account_arr_usd')},
          {cents('prior_account_arr_usd')}, account_ever_had_arr_before FROM aarr""",
    "arr_bridge_monthly": f"""
        SELECT month_end_date, contract_id, account_id, region, legal_entity, segment, currency,
          {amount('arr_local', 'local_cents')}, {cents('arr_usd')}, CAST(seq AS INTEGER) AS contract_month_seq,
          {cents('prior_usd', 'prior_arr_usd_filled')}, {cents('real_usd', 'real_component_usd')},
          {cents('drift_usd', 'fx_component_usd')}, {cents('prior_account_arr_usd')},
          account_ever_had_arr_before FROM bri""",
    "arr_movements": f"""
        SELECT md5(contract_id || '-' || strftime(month_end_date, '%Y-%m-%d')) AS arr_movement_sk,
          month_end_date, contract_id, account_id, region, legal_entity, segment, currency,
          {amount('arr_local', 'local_cents')}, {cents('arr_usd')},
          {cents('prior_usd', 'prior_arr_usd')}, {cents('real_usd', 'real_component_usd')},
          {cents('drift_usd', 'fx_component_usd')}, movement_type FROM mov""",
    "arr_waterfall_account": f"""
        SELECT month_end_date, account_id, region, legal_entity, segment,
          {cents_of(('account_arr_usd', *MOVES))} FROM awf""",
    "arr_waterfall_portfolio": f"""
        SELECT month_end_date,
          {cents_of(('total_arr_usd', 'prior_total_arr_usd', *MOVES, 'net_movement_usd'))}
        FROM pwf""",
}
ARR = {name: q(body) for name, body in ARR_MODELS.items()}

_NEWEST = "SELECT * FROM pwf ORDER BY month_end_date DESC LIMIT 1"
_BARS = """
bars AS (
  UNPIVOT (SELECT coalesce(prior_total_arr_usd, 0) AS "Starting ARR", new_arr_usd AS "New",
                  expansion_arr_usd AS "Expansion", reactivation_arr_usd AS "Reactivation",
                  contraction_arr_usd AS "Contraction", churn_arr_usd AS "Churn",
                  fx_impact_usd AS "FX Impact", total_arr_usd AS "Ending ARR"
           FROM (SELECT * FROM pwf ORDER BY month_end_date DESC LIMIT 1) t)
  ON COLUMNS(*) INTO NAME label VALUE amount),
bars_at AS (
  SELECT *, list_position(['Starting ARR', 'New', 'Expansion', 'Reactivation', 'Contraction',
                           'Churn', 'FX Impact', 'Ending ARR'], label) AS pos FROM bars),
stacked AS (
  SELECT *, sum(amount) OVER (ORDER BY pos) AS upto, sum(amount) OVER (ORDER BY pos) - amount AS below
  FROM bars_at)
"""
_BRIDGE_TABLE = """
    SELECT CAST(pos AS INTEGER) AS position, pos || '. ' || label AS component,
      CAST(amount AS DECIMAL(38, 2)) AS amount_usd,
      CAST(CASE WHEN pos >= 7 THEN (SELECT amount FROM bars_at WHERE pos = 8) ELSE upto END
           AS DECIMAL(38, 2)) AS running_total
    FROM stacked"""
_LONG = """
    SELECT month_end_date, label AS movement_type, CAST(amount AS DECIMAL(38, 2)) AS amount_usd
    FROM (UNPIVOT (SELECT month_end_date, new_arr_usd AS "New", expansion_arr_usd AS "Expansion",
                          reactivation_arr_usd AS "Reactivation",
                          contraction_arr_usd AS "Contraction", churn_arr_usd AS "Churn" FROM pwf)
          ON COLUMNS(* EXCLUDE month_end_date) INTO NAME label VALUE amount) u"""

DASHBOARD = {
    "headline_arr": q(f"""
        SELECT month_end_date, {cents('total_arr_usd')},
          {cents('total_arr_usd - prior_total_arr_usd', 'mom_change_usd')},
          {cents('''round((total_arr_usd - prior_total_arr_usd) / prior_total_arr_usd * 100, 1)''',
                 'mom_change_pct', 1)}
        FROM ({_NEWEST}) t"""),
    "waterfall_bridge_tile": q(f"""
        SELECT CAST(pos AS INTEGER) AS sort_order, label AS category,
          {cents('CASE WHEN pos = 8 THEN 0 ELSE least(below, upto) END', 'base_invisible')},
          {cents('abs(amount)', 'bar_visible')}, {cents('amount', 'raw_delta')}
        FROM stacked""", _BARS),
    "bridge_running_total": q(_BRIDGE_TABLE, _BARS),
    "bridge_movement_components": q(_BRIDGE_TABLE + " WHERE pos BETWEEN 2 AND 7", _BARS),
    "arr_trend_by_movement": q(_LONG),
    "arr_trend_wide": q(f"""
        SELECT month_end_date, {cents('new_arr_usd', '"New"')},
          {cents('expansion_arr_usd', '"Expansion"')},
          {cents('reactivation_arr_usd', '"Reactivation"')},
          {cents('contraction_arr_usd', '"Contraction"')}, {cents('churn_arr_usd', '"Churn"')}
        FROM pwf"""),
    "arr_by_segment": q(f"""
        SELECT segment, {cents('sum(account_arr_usd)', 'arr_usd')} FROM awf
        WHERE month_end_date = (SELECT max(month_end_date) FROM awf) GROUP BY segment"""),
    "arr_by_region": q(f"""
        SELECT region, {cents('sum(account_arr_usd)', 'arr_usd')} FROM awf
        WHERE month_end_date = (SELECT max(month_end_date) FROM awf) GROUP BY region"""),
    "kpi_cards": q(f"""
        SELECT month_end_date, {cents('total_arr_usd')},
          {cents('''round((total_arr_usd - prior_total_arr_usd) / prior_total_arr_usd * 100, 1)''',
                 'mom_change_pct', 1)},
          {cents('new_arr_usd + expansion_arr_usd', 'new_plus_expansion_usd')},
          {cents('contraction_arr_usd + churn_arr_usd', 'contraction_plus_churn_usd')}
        FROM ({_NEWEST}) t"""),
}

_RECON_ALL = f"SELECT month_start, legal_entity, {cents_of(RECON_MEASURES)} FROM rec"
_ORPHANS = ORPHANS.format(zeros=", ".join(cents("0", m) for m in RECON_MEASURES))
_KEYS = f"SELECT DISTINCT month_start, legal_entity FROM usd WHERE arrived >= {SINCE}"
_DIFF = ",\n".join(
    f"CAST(coalesce(b.{m}, 0) AS DECIMAL(38, 2)) AS before_{m}, "
    f"CAST(coalesce(a.{m}, 0) AS DECIMAL(38, 2)) AS after_{m}, "
    f"CAST(coalesce(a.{m}, 0) AS DECIMAL(38, 2)) - CAST(coalesce(b.{m}, 0) AS DECIMAL(38, 2)) "
    f"AS delta_{m}" for m in RECON_MEASURES)
_CHANGED = " OR ".join(f"delta_{m} <> 0" for m in RECON_MEASURES)
RECONCILIATION = {
    "revenue_reconciliation": q(_RECON_ALL, RECON),
    "revenue_reconciliation_incremental": q(f"{_RECON_ALL} UNION ALL {_ORPHANS}", RECON),
    "revenue_affected_keys": q(_KEYS),
    "restatement_log": q(f"""
        SELECT TIMESTAMP '2001-08-01 06:00:00' AS run_started_at, 'run-2' AS run_id, k.*
        FROM ({_KEYS}) k"""),
    "restated_periods": q(f"""
        SELECT TIMESTAMP '2001-08-01 06:00:00' AS run_started_at, 'run-2' AS run_id, k.*
        FROM ({_KEYS}) k"""),
    "restatement_diff": q(f"""
        SELECT * FROM (
          SELECT coalesce(a.month_start, b.month_start) AS month_start,
            coalesce(a.legal_entity, b.legal_entity) AS legal_entity, {_DIFF}
          FROM rec a FULL JOIN old b USING (month_start, legal_entity)) t
        WHERE {_CHANGED}""", RECON, reconciled("old", f"arrived < {SINCE}")),
    "facts_in_batches": q(_RECON_ALL, RECON),
    "daily_run": q(f"{_RECON_ALL} UNION ALL {_ORPHANS}", RECON),
    "daily_run_log": q(f"""
        SELECT * FROM (
          SELECT TIMESTAMP '2001-06-02 06:00:00' AS run_started_at, 'run-1' AS run_id, month_start,
            legal_entity FROM usd WHERE arrived >= {SINCE} - INTERVAL 60 DAY AND arrived < {SINCE}
            AND what IN ('billed', 'credit', 'collected')
          UNION
          SELECT TIMESTAMP '2001-06-02 06:00:00', 'run-1',
            CAST(date_trunc('month', posting_date) AS DATE),
            CASE WHEN invoice_date < {SINCE} THEN acc.legal_entity END
          FROM gl JOIN inv ON invoice_id = reference_id JOIN acc ON acc.account_id = inv.account_id
          WHERE posting_date >= {SINCE} - INTERVAL 60 DAY AND posting_date < {SINCE}
          UNION
          SELECT TIMESTAMP '2001-08-01 06:00:00', 'run-2', k.* FROM ({_KEYS}) k) t"""),
    "daily_run_restated": q(f"""
        SELECT * FROM (
          SELECT coalesce(a.month_start, b.month_start) AS month_start,
            coalesce(a.legal_entity, b.legal_entity) AS legal_entity, {_DIFF}
          FROM rec a FULL JOIN old b USING (month_start, legal_entity)) t
        WHERE {_CHANGED}""", RECON, reconciled("old", f"arrived < {SINCE}")),
    "expired_versions": q(f"""
        SELECT 'run-1' AS run_id, TRUE AS is_expired, NULL AS n_keys
        UNION ALL SELECT 'run-2', FALSE, count(*) FROM ({_RECON_ALL} UNION ALL {_ORPHANS}) t""",
                          RECON),
    "payments_at_version": q("""
        SELECT payment_id, payment_date, contract_id,
          CASE WHEN payment_date < v.e THEN v.n END AS version_number,
          CASE WHEN payment_date < v.e THEN v.tier END AS plan_tier,
          CASE WHEN payment_date < v.e THEN v.seats END AS seats
        FROM (
          SELECT payment_id, payment_date, i.contract_id, max({'s': effective_start_date,
            'n': version_number, 'e': effective_end_date_exclusive, 'tier': plan_tier,
            'seats': seats}) FILTER (effective_start_date IS NOT NULL) AS v
          FROM paid p JOIN inv i ON i.invoice_id = p.invoice_id
          LEFT JOIN ver ON ver.contract_id = i.contract_id AND effective_start_date <= payment_date
          GROUP BY ALL) t"""),
    "unconverted_payments": q(f"""
        SELECT payment_id, payment_date, {amount()} FROM paid
        WHERE payment_date > (SELECT hi FROM edges)"""),
    "to_usd_invoices": q(f"""
        SELECT invoice_id, {cents('round(cents / 100.0 / fx_rate, 2)', 'amount_usd')}
        FROM inv JOIN fxd ON rate_date = invoice_date AND quote_currency = currency"""),
}

_SCHEDULE = """
sched AS (
  SELECT contract_id, version_number, account_id, currency, seats, plan_tier,
         (arr_cents + 6) // 12 AS cents, p, effective_start_date + CAST(p * 30 AS INTEGER) AS invoice_date,
         concat_ws('-', 'INV', contract_id, version_number, p + 1) AS invoice_id
  FROM (SELECT *, unnest(range((least(effective_end_date_exclusive, hi) - effective_start_date + 29)
                               // 30)) AS p
        FROM ver, edges
        WHERE arr_cents > 0 AND effective_start_date < least(effective_end_date_exclusive, hi)) t)
"""
BILLING = {
    "billing_schedule": q(f"""
        SELECT invoice_id, contract_id, account_id, invoice_date, currency, {amount()}, seats,
          plan_tier FROM sched""", _SCHEDULE),
    "invoice_lines": q(f"""
        SELECT invoice_id || '-L1' AS invoice_line_id, invoice_id,
          plan_tier || ' plan - ' || seats || ' seats' AS description, seats AS quantity,
          {cents('((cents * 200 + seats) // (2 * seats)) / 10000.0', 'unit_amount', 4)}, {amount()}
        FROM sched""", _SCHEDULE),
    "gl_postings": q(f"""
        SELECT je_id, posting_date, gl_account, debit_credit, {amount()}, currency, reference_id,
          je_type FROM gl WHERE je_type <> 'MANUAL_ADJUSTMENT'"""),
    "manual_adjustment_postings": q(f"""
        SELECT je_id, posting_date, gl_account, debit_credit, {amount()}, currency, reference_id,
          je_type FROM gl WHERE je_type = 'MANUAL_ADJUSTMENT'"""),
    "gl_balance": q(f"""
        SELECT je_type, count(DISTINCT reference_id) AS n_references,
          {cents('''sum(CASE WHEN debit_credit = 'DEBIT' THEN cents ELSE -cents END) / 100.0''',
                 'imbalance')}
        FROM gl GROUP BY je_type"""),
    "co_termination_group": q("""
        SELECT contract_id, version_number, co_termination_group FROM contract_rows"""),
}

_CURRENT = """
cur AS (SELECT *, updated_at AS customer_master_updated_at FROM cust
        WHERE version = CASE WHEN CAST(substr(account_id, 5) AS BIGINT) % 8 = 0 THEN 2 ELSE 1 END)
"""
_CLEAR = ("account_id, billing_contact_name, billing_contact_email, tax_id, address_line1, city, "
          "region, legal_entity, customer_master_updated_at")
_MASKED = """account_id, '***MASKED***' AS billing_contact_name,
    substr(billing_contact_email, 1, 1) || '***@' || split_part(billing_contact_email, '@', -1)
      AS billing_contact_email,
    '***MASKED***' AS tax_id, '***MASKED***' AS address_line1, city, region, legal_entity,
    customer_master_updated_at"""
_US = "legal_entity = 'Northfall Ledgers Inc.'"
GOVERNANCE = {
    "dim_customer": q(f"SELECT {_CLEAR} FROM cur", _CURRENT),
    "dim_customer_for_admin": q(f"SELECT {_CLEAR} FROM cur", _CURRENT),
    "dim_customer_for_reader": q(f"SELECT {_MASKED} FROM cur", _CURRENT),
    "dim_customer_for_analyst": q(f"SELECT {_MASKED} FROM cur WHERE {_US}", _CURRENT),
    "dim_customer_for_unmapped_user": q(f"SELECT {_MASKED} FROM cur WHERE FALSE", _CURRENT),
    "mask_email_strict": q("""
        SELECT account_id, CASE WHEN contains(billing_contact_email, '@')
            THEN left(billing_contact_email, 1) || '***@'
                 || split_part(billing_contact_email, '@', -1)
            ELSE '***MASKED***' END AS billing_contact_email
        FROM cur""", _CURRENT),
    "account_waterfall_for_analyst": q(f"""
        SELECT month_end_date, account_id, region, legal_entity, segment,
          {cents_of(('account_arr_usd', *MOVES))} FROM awf WHERE {_US}"""),
    "reconciliation_for_analyst": q(_RECON_ALL + f" WHERE {_US}", RECON),
    "portfolio_for_analyst": q(f"""
        SELECT month_end_date,
          {cents_of(('total_arr_usd', 'prior_total_arr_usd', *MOVES, 'net_movement_usd'))}
        FROM pwf"""),
}

_COST = """
tagged AS (
  SELECT CAST(ts AS DATE) AS query_date,
    ['RL_LOADING_WH', 'RL_TRANSFORMING_WH', 'RL_BI_WH', 'RL_CI_WH'][user_id % 5 + 1]
      AS warehouse_name,
    event_type = 'error' AS broken, user_id AS u, CAST(abs(round(value * 1000)) AS BIGINT) AS ms
  FROM events
  WHERE user_id % 5 < 4 AND event_type <> 'signup' AND ts >= TIMESTAMP '2023-11-02'),
day_ms AS (SELECT query_date, warehouse_name, sum(ms) AS total_ms FROM tagged GROUP BY ALL),
credits AS (
  SELECT DISTINCT CAST(ts AS DATE) AS query_date, w.warehouse_name,
    CAST(1 + (dayofmonth(ts) * 7 + w.i * 3) % 11 / 4.0 AS DECIMAL(18, 4)) AS credits_used
  FROM events, (VALUES (0, 'RL_LOADING_WH'), (1, 'RL_TRANSFORMING_WH'), (2, 'RL_BI_WH'),
                       (3, 'RL_CI_WH')) w(i, warehouse_name)
  WHERE dayofmonth(ts) <> 13),
steps AS (
  SELECT query_date, warehouse_name,
    CASE WHEN broken THEN 'invocation_level'
         ELSE ['staging', 'intermediate', 'marts_finance'][u % 3 + 1] END AS pipeline_layer,
    CASE WHEN NOT broken THEN 'model_' || u % 7 END AS dbt_model,
    CASE WHEN NOT broken THEN if(u % 2 = 0, 'prod', 'dev') END AS dbt_target,
    count(*) AS query_count, sum(ms) AS elapsed_ms
  FROM tagged GROUP BY ALL)
"""
COST = {
    "cost_by_layer_daily": q(f"""
        SELECT query_date, warehouse_name, pipeline_layer, dbt_model, dbt_target, query_count,
          CAST(elapsed_ms AS BIGINT) AS elapsed_ms,
          CAST(CASE WHEN total_ms > 0 THEN CAST(
            (elapsed_ms * CAST(coalesce(credits_used, 0) * 4 AS BIGINT) * 20000 + 4 * total_ms)
            // (8 * total_ms) AS DECIMAL(38, 4)) / 10000 END AS DECIMAL(38, 4)) AS estimated_credits
        FROM steps JOIN day_ms USING (query_date, warehouse_name)
        LEFT JOIN credits USING (query_date, warehouse_name)""", _COST),
    "cost_report_in_order": q("""
        SELECT CAST(row_number() OVER (ORDER BY query_date DESC, warehouse_name NULLS FIRST,
            pipeline_layer NULLS FIRST, dbt_model NULLS FIRST, dbt_target NULLS FIRST) AS INTEGER)
            AS place, query_date, warehouse_name, pipeline_layer, dbt_model, dbt_target
        FROM steps JOIN day_ms USING (query_date, warehouse_name)""", _COST),
    "portfolio_in_order": q("""
        SELECT CAST(row_number() OVER (ORDER BY month_end_date) AS INTEGER) AS place,
          month_end_date FROM pwf"""),
    "query_tags": q("""
        SELECT account_id, 'revenue' AS project, 'prod' AS target, 'run-1' AS invocation_id,
          CAST(NULL AS VARCHAR) AS schema, 'dim_customer' AS model FROM acc"""),
    "query_tag_fields": q("""
        SELECT 'Q-' || event_id AS query_id,
          CASE WHEN ok THEN 'dbt' END AS app, CASE WHEN ok THEN 'billing' END AS project,
          CASE WHEN ok THEN if(user_id % 2 = 0, 'prod', 'dev') END AS dbt_target,
          CASE WHEN ok THEN ['staging', 'intermediate', 'marts_finance'][user_id % 3 + 1] END
            AS pipeline_layer,
          CASE WHEN ok THEN 'model_' || user_id % 7 END AS dbt_model
        FROM (SELECT *, event_type NOT IN ('signup', 'error') AS ok FROM events) t"""),
}

_SLICE = "DATE '1998-06-15'"
_CUT = "DATE '2000-01-01'"
_PAYMENT = f"payment_id, invoice_id, account_id, payment_date, {amount()}, currency"
SOURCES = {
    "landing_csv": q(f"""
        SELECT credit_memo_id, invoice_id, account_id, issue_date, system_entry_date, currency,
          {amount()}, reason FROM memo"""),
    "landing_csv_nulls": q(f"""
        SELECT contract_id, version_number, effective_end_date, {amount('arr_amount', 'arr_cents')},
          is_backdated, co_termination_group FROM contract_rows"""),
    "landing_json_arrays": q("""
        SELECT account_id, CAST(version AS BIGINT) AS version, billing_contact_name,
          billing_contact_email, tax_id, address_line1, city, region, legal_entity, updated_at
        FROM cust"""),
    "landing_json": q("""
        SELECT account_id, CAST(version AS BIGINT) AS version, billing_contact_name,
          billing_contact_email, tax_id, address_line1, city, region, legal_entity, updated_at
        FROM cust"""),
    "daily_slice": q(f"""
        SELECT invoice_id, contract_id, account_id, invoice_date, currency, {amount()} FROM inv
        WHERE invoice_date = {_SLICE}"""),
    "daily_slice_lines": q(f"""
        SELECT invoice_line_id, invoice_id, quantity, {amount()} FROM lines
        WHERE invoice_date = {_SLICE}"""),
    "insert_if_absent": q(f"""
        SELECT payment_id, invoice_id, account_id, payment_date, currency,
          {cents(f'round(cents / 100.0, 2) + CASE WHEN payment_date >= {_CUT} THEN 1 ELSE 0 END',
                 'amount')} FROM pay"""),
    "mart_rebuild": q(f"""
        SELECT month_end_date, account_id, region, legal_entity, segment,
          {cents_of(('account_arr_usd', *MOVES))} FROM awf"""),
    "snapshot_before_run": q(f"{_RECON_ALL} UNION ALL {_ORPHANS}",
                             reconciled("rec", f"arrived < {SINCE}")),
    "stream_landing": q(f"""
        SELECT invoice_id, contract_id, account_id, invoice_date, currency, {amount()} FROM inv"""),
    "stream_landing_file_by_file": q(f"""
        SELECT invoice_id, contract_id, account_id, invoice_date, currency, {amount()} FROM inv"""),
    "landing_csv_multiline": """
        SELECT doc_id, CASE WHEN text NOT IN ('', 'NULL', 'null') THEN text END AS text, lang, source,
          n_chars FROM documents""",
    "stream_payments_staging": q(f"SELECT {_PAYMENT} FROM paid"),
    "stream_payments_one_more": q(f"""
        SELECT CASE WHEN payment_id = (SELECT min(payment_id) FROM pay) THEN 'A' || payment_id
            ELSE payment_id END AS payment_id, invoice_id, account_id, payment_date, {amount()},
          currency FROM paid"""),
    "landing_replayed_batch": q(f"""
        SELECT CASE WHEN CAST(substr(invoice_id, 5) AS INTEGER) % 7 <> 0 THEN payment_id END
            AS payment_id, invoice_id, account_id, payment_date, {amount()}, currency FROM pay"""),
}

QUALITY = {
    "check_not_null": q("""
        SELECT contract_id, version_number FROM contract_rows WHERE co_termination_group IS NULL"""),
    "check_unique": q("""
        SELECT contract_id, count(*) AS n_records FROM contract_rows GROUP BY 1
        HAVING count(*) > 1"""),
    "check_accepted_values": q("""
        SELECT currency, count(*) AS n_records FROM inv WHERE currency NOT IN ('USD', 'EUR')
        GROUP BY 1"""),
    "check_relationships": q("""
        SELECT printf('INV-%07d', l_orderkey) AS invoice_id, count(*) AS n_records FROM lineitem
        WHERE printf('INV-%07d', l_orderkey) NOT IN (SELECT invoice_id FROM inv) GROUP BY 1"""),
    "check_unique_combination": q(f"""
        SELECT invoice_id, payment_date, {amount()}, currency, count(*) AS n_records FROM pay
        GROUP BY invoice_id, payment_date, cents, currency HAVING count(*) > 1"""),
    "decomposition_gap": q("""
        SELECT contract_id, month_end_date FROM bri
        WHERE abs(arr_usd - prior_usd - real_usd - drift_usd) > 0.01"""),
    "account_waterfall_gap": q("""
        SELECT account_id, month_end_date FROM (
          SELECT *, account_arr_usd - lag(account_arr_usd, 1, 0) OVER (
              PARTITION BY account_id ORDER BY month_end_date) AS change FROM awf) t
        WHERE abs(change - new_arr_usd - expansion_arr_usd - contraction_arr_usd - churn_arr_usd
                  - reactivation_arr_usd - fx_impact_usd) > 0.01"""),
    "portfolio_waterfall_gap": q("""
        SELECT month_end_date FROM pwf
        WHERE abs(total_arr_usd - coalesce(prior_total_arr_usd, 0) - net_movement_usd) > 0.01"""),
    "portfolio_vs_contract_gap": q("""
        SELECT month_end_date FROM pwf
        JOIN (SELECT month_end_date, sum(arr_usd) AS s FROM carr GROUP BY 1) c
          USING (month_end_date) WHERE abs(total_arr_usd - s) > 0.01"""),
    "billed_vs_recognized_gap": q("""
        SELECT month_start, legal_entity FROM rec
        WHERE abs(recognized_net_of_credits_usd - billed_usd - manual_adjustment_usd + credit_usd)
              > 1""", RECON),
    "decomposition_gap_found": q("""
        SELECT contract_id, month_end_date FROM bri
        WHERE abs(arr_usd - prior_usd - real_usd - drift_usd
                  - CASE WHEN month(month_end_date) = 6 THEN 5 ELSE 0 END) > 0.01"""),
    "account_waterfall_gap_found": q("""
        SELECT account_id, month_end_date FROM awf
        WHERE month(month_end_date) = 6 AND abs(new_arr_usd) > 0.01"""),
    "portfolio_waterfall_gap_found": q("""
        SELECT month_end_date FROM pwf WHERE month(month_end_date) = 6"""),
    "portfolio_vs_contract_gap_found": q("""
        SELECT month_end_date FROM pwf JOIN (
            SELECT month_end_date, sum(arr_usd + 3) AS s FROM carr
            WHERE month(month_end_date) = 6 GROUP BY 1) c USING (month_end_date)
        WHERE abs(total_arr_usd - s) > 0.01"""),
    "billed_vs_recognized_gap_found": q("""
        SELECT month_start, legal_entity FROM rec
        WHERE month(month_start) = 6 AND recognized_net_of_credits_usd IS NOT NULL""", RECON),
    "credit_memo_lag": q("""
        SELECT credit_memo_id, invoice_id, issue_date, system_entry_date,
          CAST(system_entry_date - issue_date AS INTEGER) AS lag_days,
          system_entry_date - issue_date > 30 AS is_late FROM memo"""),
    "freshness_report": q("""
        SELECT table_name, newest AS max_loaded_at,
          CAST(epoch(TIMESTAMP '2001-08-03') - epoch(newest) AS BIGINT) AS age_seconds,
          CASE WHEN epoch(TIMESTAMP '2001-08-03') - epoch(newest) > error_h * 3600 THEN 'error'
               WHEN epoch(TIMESTAMP '2001-08-03') - epoch(newest) > warn_h * 3600 THEN 'warn'
               ELSE 'pass' END AS status
        FROM (SELECT 'accounts' AS table_name, CAST(max(created_date) AS TIMESTAMP) AS newest,
                     30 AS warn_h, 48 AS error_h FROM acc
              UNION ALL SELECT 'contracts', max(created_at), 30, 48 FROM contract_rows
              UNION ALL SELECT 'customer_master', max(updated_at), 30, 48 FROM cust
              UNION ALL SELECT 'fx_rates', max(rate_date), 72, 120 FROM fx_raw
              UNION ALL SELECT 'invoices', max(invoice_date), 24, 30 FROM inv
              UNION ALL SELECT 'invoice_line_items', max(invoice_date), 24, 30 FROM lines
              UNION ALL SELECT 'credit_memos', max(system_entry_date), 30, 48 FROM memo
              UNION ALL SELECT 'payments', max(payment_date), 24, 30 FROM pay
              UNION ALL SELECT 'gl_journal_entries', max(posting_date), 840, 960 FROM gl) t"""),
}

_FROM = {
    "fct_revenue_reconciliation_monthly": _RECON_ALL,
    "dim_customer": f"SELECT {_CLEAR} FROM cur",
    "rpt_restatement_log": f"SELECT TIMESTAMP '2001-08-01 06:00:00' AS run_started_at, k.* FROM ({_KEYS}) k",
    "int_date_spine_daily": ARR_MODELS["date_spine_daily"],
    "int_date_spine_month_end": ARR_MODELS["month_end_spine"],
    "int_fx_rates_daily_filled": ARR_MODELS["fx_daily_filled"],
    "int_customer_master_versions": ARR_MODELS["customer_master_versions"],
    "int_contract_versions": ARR_MODELS["contract_versions"],
    "int_contract_arr_monthly": ARR_MODELS["contract_arr_monthly"],
    "int_account_arr_monthly": ARR_MODELS["account_arr_monthly"],
    "int_contract_arr_bridge_monthly": ARR_MODELS["arr_bridge_monthly"],
    "fct_arr_movements": ARR_MODELS["arr_movements"],
    "fct_arr_waterfall_account_monthly": ARR_MODELS["arr_waterfall_account"],
    "fct_arr_waterfall_portfolio_monthly": ARR_MODELS["arr_waterfall_portfolio"],
    **{f"stg_{name}": "SELECT " + body for name, body in STG.items()},
}
# The staged columns under the names they have as landed.
_LANDED = {
    "accounts": "SELECT * FROM acc",
    "contracts": "SELECT *, arr_cents AS arr_amount FROM contract_rows",
    "customer_master": "SELECT * FROM cust",
    "fx_rates": "SELECT *, 'USD' AS base_currency FROM fx_raw",
    "invoices": "SELECT *, cents AS amount FROM inv",
    "invoice_line_items": "SELECT *, cents AS amount FROM lines",
    "credit_memos": "SELECT *, cents AS amount FROM memo",
    "payments": "SELECT *, cents AS amount FROM pay",
    "gl_journal_entries": "SELECT *, cents AS amount FROM gl",
}


def declared(tables: dict[str, str], catalogue) -> str:
    """Every declared check as one row counting its violations."""
    parts = []

    def add(table, check, column, violations):
        parts.append(f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
                     f"'{column}' AS column_name, count(*) AS violations FROM ({violations}) v")

    for table, checks in catalogue.items():
        rows = f"t_{table}"
        for c in checks.not_null:
            add(table, "not_null", c, f"SELECT 1 FROM {rows} WHERE {c} IS NULL")
        for c, values in checks.accepted.items():
            allowed = ", ".join(f"'{v}'" for v in values)
            add(table, "accepted_values", c, f"SELECT 1 FROM {rows} WHERE {c} NOT IN ({allowed})")
        for c in checks.unique:
            add(table, "unique", c, f"SELECT {c} FROM {rows} WHERE {c} IS NOT NULL GROUP BY 1 "
                                    "HAVING count(*) > 1")
        for c, (parent, key) in checks.parents.items():
            add(table, "relationships", c, f"SELECT DISTINCT {c} FROM {rows} WHERE {c} NOT IN "
                                           f"(SELECT {key} FROM t_{parent} WHERE {key} IS NOT NULL)")
        if checks.combination:
            columns = ", ".join(checks.combination)
            add(table, "unique_combination", columns,
                f"SELECT {columns} FROM {rows} GROUP BY ALL HAVING count(*) > 1")
    return q("\nUNION ALL ".join(parts), RECON, _CURRENT,
             *[f"t_{name} AS MATERIALIZED ({body})" for name, body in tables.items()])


# ---- Fixed values: the declared checks, table by table, written out here on their own --------
_SOURCE_RULES = """
accounts: not_null account_id account_name legal_entity created_date; unique account_id; in region US EU IN; in currency USD EUR INR; in segment SMB Mid-Market Enterprise
contracts: not_null contract_id version_number account_id effective_start_date arr_amount created_at; in currency USD EUR INR; in amendment_type new upsell downgrade renewal currency_change churn
customer_master: not_null account_id version updated_at; in region US EU IN
fx_rates: not_null rate_date quote_currency fx_rate; in base_currency USD; in quote_currency USD EUR INR
invoices: not_null invoice_id contract_id account_id invoice_date amount; unique invoice_id; in currency USD EUR INR
invoice_line_items: not_null invoice_line_id invoice_id amount; unique invoice_line_id
credit_memos: not_null credit_memo_id invoice_id account_id issue_date system_entry_date amount; unique credit_memo_id; in currency USD EUR INR; in reason service_credit billing_error goodwill downgrade_proration
payments: not_null payment_id invoice_id account_id payment_date amount; unique payment_id; in currency USD EUR INR
gl_journal_entries: not_null je_id posting_date gl_account amount; unique je_id; in debit_credit DEBIT CREDIT; in currency USD EUR INR; in je_type AUTO_INVOICE AUTO_PAYMENT MANUAL_ADJUSTMENT
"""
_MODEL_RULES = """
stg_accounts: not_null account_id; unique account_id; in region US EU IN; in currency USD EUR INR
stg_contracts: not_null contract_version_sk contract_id account_id arr_amount; unique contract_version_sk; in amendment_type new upsell downgrade renewal currency_change churn; parent account_id stg_accounts account_id
stg_customer_master: not_null customer_master_sk account_id customer_master_version; unique customer_master_sk; parent account_id stg_accounts account_id
stg_fx_rates: not_null quote_currency fx_rate; in quote_currency USD EUR INR; key rate_date quote_currency
stg_invoices: not_null invoice_id contract_id account_id amount; unique invoice_id; parent contract_id stg_contracts contract_id; parent account_id stg_accounts account_id
stg_invoice_line_items: not_null invoice_line_id invoice_id; unique invoice_line_id; parent invoice_id stg_invoices invoice_id
stg_credit_memos: not_null credit_memo_id invoice_id amount; unique credit_memo_id; parent invoice_id stg_invoices invoice_id
stg_payments: not_null payment_id invoice_id amount; unique payment_id; parent invoice_id stg_invoices invoice_id; key invoice_id payment_date amount currency
stg_gl_journal_entries: not_null je_id; unique je_id; in debit_credit DEBIT CREDIT; in je_type AUTO_INVOICE AUTO_PAYMENT MANUAL_ADJUSTMENT; parent invoice_id stg_invoices invoice_id
int_date_spine_daily: not_null date_day; unique date_day
int_date_spine_month_end: not_null month_end_date; unique month_end_date
int_fx_rates_daily_filled: not_null rate_date quote_currency fx_rate; in quote_currency USD EUR INR; key rate_date quote_currency
int_customer_master_versions: not_null customer_master_sk effective_end_date_exclusive; unique customer_master_sk; key account_id customer_master_version
int_contract_versions: not_null contract_version_sk effective_end_date_exclusive; unique contract_version_sk
int_contract_arr_monthly: not_null arr_usd; key contract_id month_end_date
int_account_arr_monthly: not_null account_arr_usd; key account_id month_end_date
int_contract_arr_bridge_monthly: not_null real_component_usd fx_component_usd; key contract_id month_end_date
fct_arr_movements: not_null arr_movement_sk movement_type account_id; unique arr_movement_sk; in movement_type new expansion contraction churn reactivation no_change; parent account_id stg_accounts account_id
fct_arr_waterfall_account_monthly: key account_id month_end_date
fct_arr_waterfall_portfolio_monthly: not_null month_end_date total_arr_usd; unique month_end_date
fct_revenue_reconciliation_monthly: not_null month_start legal_entity recognized_net_of_credits_usd; key month_start legal_entity
dim_customer: not_null account_id billing_contact_email; unique account_id
rpt_restatement_log: not_null run_started_at month_start
"""
# ----------------------------------------------------------------------------------------------


def _rules(text: str) -> dict:
    out = {}
    for line in text.strip().split("\n"):
        name, _, rules = line.partition(": ")
        found = SimpleNamespace(not_null=(), unique=(), accepted={}, parents={}, combination=())
        for kind, *words in (rule.split() for rule in rules.split("; ")):
            if kind == "not_null":
                found.not_null = words
            elif kind == "unique":
                found.unique = words
            elif kind == "in":
                found.accepted[words[0]] = words[1:]
            elif kind == "parent":
                found.parents[words[0]] = (words[1], words[2])
            else:
                found.combination = words
        out[name] = found
    return out


# Rows of these tables that a fault is put into, in words that both engines read alike.
FAULTY_ROWS = {
    "accounts": "month(created_date) = 6", "contracts": "month(created_at) = 6",
    "customer_master": "month(updated_at) = 6", "fx_rates": "month(rate_date) = 6",
    "invoices": "month(invoice_date) = 6", "invoice_line_items": "quantity % 10 = 0",
    "credit_memos": "month(issue_date) = 6", "payments": "month(payment_date) = 6",
    "gl_journal_entries": "month(posting_date) = 6",
    "stg_accounts": "month(account_created_date) = 6",
    "stg_contracts": "month(contract_version_recorded_at) = 6",
    "stg_customer_master": "month(updated_at) = 6", "stg_fx_rates": "month(rate_date) = 6",
    "stg_invoices": "month(invoice_date) = 6", "stg_invoice_line_items": "quantity % 10 = 0",
    "stg_credit_memos": "month(issue_date) = 6", "stg_payments": "month(payment_date) = 6",
    "stg_gl_journal_entries": "month(posting_date) = 6",
    "int_contract_arr_monthly": "month(month_end_date) = 6",
    "fct_arr_movements": "month(month_end_date) = 6",
    "fct_arr_waterfall_portfolio_monthly": "month(month_end_date) = 6",
    "fct_revenue_reconciliation_monthly": "month(month_start) = 6",
}


def _with_faults(body: str, name: str, rules) -> str:
    """Chosen rows lose their last column that must be known, get an unknown value in their last
    column of given values, and come twice."""
    if name not in FAULTY_ROWS:
        return body
    change = [f"CASE WHEN bad THEN NULL ELSE {c} END AS {c}" for c in rules.not_null[-1:]]
    change += [f"CASE WHEN bad THEN 'none' ELSE {c} END AS {c}" for c in list(rules.accepted)[-1:]]
    rows = (f"SELECT * REPLACE ({', '.join(change)}) FROM "
            f"(SELECT *, {FAULTY_ROWS[name]} AS bad FROM ({body}) b) r")
    return f"{rows} UNION ALL {rows} WHERE bad"


for _name, _bodies, _text in (("declared_source_checks", _LANDED, _SOURCE_RULES),
                              ("declared_model_checks", _FROM, _MODEL_RULES)):
    _declared = _rules(_text)
    QUALITY[_name] = declared(_bodies, _declared)
    QUALITY[f"{_name}_found"] = declared(
        {n: _with_faults(b, n, _declared[n]) for n, b in _bodies.items()}, _declared)
# A day and a half after its newest row each table is between its limits, past them or fresh.
QUALITY["freshness_warnings"] = QUALITY["freshness_report"].replace(
    "TIMESTAMP '2001-08-03'", "((SELECT max(system_entry_date) FROM memo) + INTERVAL 36 HOUR)")
SOURCES["staged_files"] = q("""
    SELECT 'accounts' AS table_name, count(*) > 0 AS has_content FROM acc
    UNION ALL SELECT 'credit_memos', count(*) > 0 FROM memo""")
SOURCES["feed_arrived"] = q("""
    SELECT DATE '1998-06-15' AS run_date,
      (SELECT count(*) > 0 FROM gl WHERE posting_date = DATE '1998-06-15') AS arrived
    UNION ALL SELECT DATE '1998-06-14', FALSE""")

STATEMENTS: dict[str, str] = {
    **{f"stg_{name}": q("SELECT " + body) for name, body in STG.items()},
    **ARR, **DASHBOARD, **RECONCILIATION, **BILLING, **GOVERNANCE, **COST, **SOURCES, **QUALITY,
}
