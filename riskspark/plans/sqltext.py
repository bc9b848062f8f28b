"""DuckDB SQL text of the proxy views and small SQL builders for the oracle queries.

The same view definitions as ``riskspark.sources.views``, written as CTEs over the
driver's pre-registered tables. Doubles are rounded to 6 places and timestamps are
given as 'yyyy-MM-dd HH:mm:ss.ffffff' text on both sides of every comparison.
"""

from __future__ import annotations

CTES = {
    "T0": """T0 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
      lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date FROM orders)""",
    "T": """T AS (SELECT CAST(o_orderkey AS VARCHAR) AS TransactionID, CAST(o_custkey AS VARCHAR) AS AccountID,
      CAST(o_totalprice AS DOUBLE) AS TransactionAmount, o_orderdate AS TransactionDate,
      prev_date AS PreviousTransactionDate, CAST(c_acctbal AS DOUBLE) AS AccountBalance,
      c_mktsegment AS CustomerOccupation, o_orderpriority AS Channel, n_name AS Location,
      CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS Fraud
      FROM T0 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "E": """E AS (SELECT CAST(event_id AS VARCHAR) AS TransactionID, CAST(user_id AS VARCHAR) AS AccountID,
      CAST(value AS DOUBLE) AS TransactionAmount, ts AS TransactionDate,
      lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS PreviousTransactionDate,
      event_type AS Channel, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS LoginAttempts,
      CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS Fraud FROM events)""",
    "P0": """P0 AS (SELECT * EXCLUDE (Fraud), TransactionAmount / (TransactionAmount + 50.0) AS rf_score,
      TransactionAmount / (TransactionAmount + 100.0) AS xgb_score, ln(1.0 + TransactionAmount) AS iso_raw FROM E)""",
    "P1": """P1 AS (SELECT *, (iso_raw - (SELECT min(iso_raw) FROM P0))
      / ((SELECT max(iso_raw) FROM P0) - (SELECT min(iso_raw) FROM P0)) AS iso_score FROM P0)""",
    "P": """P AS (SELECT *, 0.3 * rf_score + 0.5 * xgb_score + 0.2 * iso_score AS FraudScore,
      CAST(0.3 * rf_score + 0.5 * xgb_score + 0.2 * iso_score > 0.5 AS INTEGER) AS FraudPrediction,
      TransactionDate AS Timestamp FROM P1)""",
    "L": """L AS (SELECT P.*, E.Fraud FROM P JOIN E ON P.TransactionID = E.TransactionID)""",
    "R": """R AS (SELECT * FROM E WHERE TransactionDate < TIMESTAMP '2024-01-16 00:00:00')""",
    "C": """C AS (SELECT * FROM E WHERE TransactionDate >= TIMESTAMP '2024-01-16 00:00:00')""",
    "FB0": """FB0 AS (SELECT event_id, ts, event_type,
      lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_id FROM events)""",
    "FB": """FB AS (SELECT CAST(prev_id AS VARCHAR) AS TransactionID, event_type = 'view' AS IsFraud,
      event_type AS Feedback, ts AS Timestamp FROM FB0
      WHERE event_type IN ('click', 'view') AND prev_id IS NOT NULL)""",
}

DEPS = {
    "T": ["T0"], "P0": ["E"], "P1": ["P0"], "P": ["P1"], "L": ["P", "E"], "R": ["E"], "C": ["E"], "FB": ["FB0"],
}


def _order(names):
    seen: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(*names: str, extra: str | list[str] = ()) -> str:
    """``WITH`` clause holding the named views (and their dependencies) then ``extra`` CTEs."""
    parts = [CTES[n] for n in _order(names)]
    if isinstance(extra, str):
        extra = [extra]
    parts += list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def us(expr: str) -> str:
    """Timestamp as text with microseconds (the portable form of both engines)."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"
