"""DuckDB SQL of the queries on stored state: one pass over all rows, without batches."""

from __future__ import annotations

from ledgerloom.plans.incremental import LOOKUPS, QUANTILES, SPANS
from ledgerloom.plans.oracle import _ACCOUNTS, _CUSTOMERS, _FACTS, _ORDER, _TRANSACTIONS, _transaction_columns, _with

_SEEN = """
  seen AS (
    SELECT DISTINCT substr(CAST(transaction_date AS varchar), 1, 7) AS month, region, customer_id
    FROM transactions t JOIN accounts USING (account_id) JOIN customers USING (customer_id)
    WHERE t.status = 'completed')"""

_QUARTER = "substr(month, 1, 4) || '-Q' || ((CAST(substr(month, 6) AS integer) + 2) // 3)"


def oracle_sql() -> dict[str, str]:
    periods = " UNION ALL ".join(
        f"SELECT {period} AS period, {region} AS region, count(DISTINCT customer_id) AS customers FROM seen GROUP BY ALL"
        for period in ("month", _QUARTER, "substr(month, 1, 4)")
        for region in ("region", "'All'")
    )
    spans = " UNION ALL ".join(
        f"""SELECT '{first} {last}' AS span, count(amount) AS n, CAST(sum(amount) AS double) AS total,
       round(CAST(sum(amount) AS double) / count(amount), 4) AS mean, round(stddev_samp(CAST(amount AS double)), 4) AS deviation
FROM completed WHERE month BETWEEN '{first}' AND '{last}' HAVING count(*) > 0"""
        for first, last in SPANS
    )
    lookups = " UNION ALL ".join(
        f"SELECT '{name}' AS filter, count(*) AS rows, coalesce(CAST(sum(amount) AS double), 0) AS amount FROM located WHERE "
        + " AND ".join(f"{column} BETWEEN '{low}' AND '{high}'" for column, (low, high) in ranges.items())
        for name, ranges in LOOKUPS.items()
    )
    shares = ", ".join(f"({share})" for share in QUANTILES)
    return {
        "transactions_with_owner": _with(
            *_FACTS,
            then="""
SELECT transaction_id, account_id, customer_id, product_name, region, transaction_date, CAST(amount AS double) AS amount
FROM transactions LEFT JOIN (SELECT account_id, customer_id, product_name, region FROM accounts JOIN customers USING (customer_id))
USING (account_id)""",
        ),
        "repeated_batches": _with(
            _CUSTOMERS,
            _TRANSACTIONS,
            then="""
SELECT 'transactions' AS table_name, substr(CAST(transaction_date AS varchar), 1, 7) AS part, count(*) AS rows,
       CAST(sum(amount) AS double) AS amount
FROM transactions GROUP BY 2
UNION ALL SELECT 'customers', region, count(*), CAST(sum(annual_income) AS double) FROM customers GROUP BY 2""",
        ),
        "first_copies_over_batches": _with(
            _TRANSACTIONS,
            f"""
  copied AS (
    SELECT * FROM transactions
    UNION ALL
    SELECT * REPLACE (CAST(transaction_date + CASE WHEN transaction_id LIKE '%-1' THEN 30 ELSE -30 END AS date) AS transaction_date,
                      'failed' AS status)
    FROM transactions WHERE transaction_id LIKE '%-1' OR transaction_id LIKE '%-2'),
  firsts AS (SELECT * FROM copied QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_ORDER}) = 1)""",
            then=_transaction_columns("firsts"),
        ),
        "amount_baselines": _with(
            _TRANSACTIONS,
            """
  completed AS (
    SELECT substr(CAST(transaction_date AS varchar), 1, 7) AS month, amount FROM transactions WHERE status = 'completed')""",
            then=spans,
        ),
        "running_amounts": _with(
            _TRANSACTIONS,
            then="""
SELECT transaction_id, transaction_date, currency, CAST(amount AS double) AS amount,
       CAST(sum(amount) OVER (PARTITION BY currency ORDER BY transaction_date, transaction_id, amount ROWS UNBOUNDED PRECEDING) AS double)
         AS running_amount
FROM transactions""",
        ),
        "open_accounts_by_day": _with(
            _CUSTOMERS,
            _ACCOUNTS,
            """
  valid AS (
    SELECT * FROM accounts WHERE open_date IS NOT NULL AND (close_date IS NULL OR close_date >= open_date)),
  days AS (
    SELECT product_name, open_date AS day FROM valid
    UNION SELECT product_name, CAST(close_date + 1 AS date) FROM valid WHERE close_date IS NOT NULL)""",
            then="""
SELECT d.product_name, d.day,
       CAST((SELECT count(*) FROM valid v WHERE v.product_name = d.product_name AND v.open_date <= d.day
             AND (v.close_date IS NULL OR v.close_date >= d.day)) AS bigint) AS open
FROM days d""",
        ),
        "approximate_amount_quantiles": _with(
            _TRANSACTIONS,
            f"""
  counted AS (
    SELECT transaction_type AS kind, count(*) AS n FROM transactions GROUP BY 1
    UNION ALL SELECT 'all', count(*) FROM transactions)""",
            then=f"""
SELECT kind, CAST(share AS double) AS share, n, true AS rank_in_bound FROM counted, (VALUES {shares}) AS asked(share)""",
        ),
        "interleaved_lookups": _with(
            *_FACTS,
            """
  located AS (
    SELECT transaction_date, account_id, region, amount
    FROM transactions JOIN accounts USING (account_id) JOIN customers USING (customer_id))""",
            then=lookups,
        ),
        "bucketed_join": _with(
            *_FACTS,
            then="""
SELECT region, t.status, count(*) AS transactions, CAST(sum(amount) AS double) AS amount
FROM transactions t JOIN accounts USING (account_id) JOIN customers USING (customer_id) GROUP BY ALL""",
        ),
        "distinct_customers_by_period": _with(*_FACTS, _SEEN, then=periods),
        "approximate_mau": _with(
            *_FACTS,
            _SEEN,
            then="""
SELECT month AS period, count(DISTINCT customer_id) AS active, true AS estimate_in_bound FROM seen GROUP BY 1
UNION ALL SELECT substr(month, 1, 4), count(DISTINCT customer_id), true FROM seen GROUP BY 1""",
        ),
    }
