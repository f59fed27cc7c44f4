"""Ledger views over the test tables.

The tables hold no bank data, so each view derives one with expressions that mean the same in Spark SQL
and DuckDB.  The text of a view serves both: Spark runs it over DataFrames, the checks prepend it to
their SQL.  Money is in whole cents.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Descriptions by order number, so that many bank rules and transfer patterns meet rows.
_TEXTS = [
    "Lightspeed Commerce Inc LS", "Uber Holdings Canada", "Depot direct client", "Dépôt GAB Montréal", "NETHRIS paie", "LOYER bureau",
    "HYDRO-QUEBEC facture", "BELL MOBILITE", "Frais mensuels", "Versement sur prêt", "ECOLAB CO", "Sysco Quebec",
    "Virement AccèsD / à 012345 EOP", "Virement AccesD / de 0123456 EOP", "Virement Interac à /Owner_A", "Virement Interac à /Jean Roy/",
    "Virement envoyé Acme Inc", "Virement reçu Client Inc", "MONERIS frais", "  ", "Divers achat bureau", "Intérêts sur prêt", "SAQ 23012", "Owner_B  Holding",
]
_CASE = " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(_TEXTS))

VIEWS: dict[str, str] = {
    "ledger": f"""
        SELECT o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS date, substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS month,
               CAST(c_nationkey AS STRING) AS account, 'NATION_' || CAST(c_nationkey AS STRING) AS entity,
               'file_' || CAST(c_nationkey AS STRING) || '_' || substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) || '.csv' AS file_name,
               CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS debit,
               CASE WHEN o_orderstatus = 'O' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS credit,
               CASE o_orderkey % {len(_TEXTS) + 1} {_CASE} END AS description
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "legs_out": """
        SELECT o_orderkey AS leg_id, CAST(o_orderdate AS DATE) AS date, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
               CAST(c_nationkey AS BIGINT) AS src, CAST((c_nationkey + 1 + o_orderkey % 5) % 25 AS BIGINT) AS dst
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'
    """,
    "legs_in": """
        SELECT o_orderkey + 1000000000 AS leg_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INT) AS date,
               CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 7 = 0 THEN 1 WHEN o_orderkey % 11 = 0 THEN 5 ELSE 0 END AS cents,
               CAST(c_nationkey AS BIGINT) AS src, CAST((c_nationkey + 1 + o_orderkey % 5) % 25 AS BIGINT) AS dst
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND o_orderkey % 10 <> 0
    """,
    "balances": """
        SELECT txn_id, account, date, debit, credit,
               CASE WHEN txn_id % 13 = 0 THEN NULL ELSE
                   CAST(sum(coalesce(credit, 0) - coalesce(debit, 0)) OVER (PARTITION BY account ORDER BY date, txn_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
                   + CASE WHEN txn_id % 97 = 0 THEN 500 ELSE 0 END END AS balance
        FROM ledger
    """,
    "card": """
        SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_returnflag AS card, CAST(l_shipdate AS DATE) AS date,
               CASE l_partkey % 14 WHEN 0 THEN 'COSTCO DELIVERY ' WHEN 1 THEN 'UBER CANADA TRIP ' WHEN 2 THEN 'UBER EATS ' WHEN 3 THEN 'UEAT ' WHEN 4 THEN 'VRBO '
                    WHEN 5 THEN 'NETFLIX ' WHEN 6 THEN 'SAQ ' WHEN 7 THEN 'FRAIS DE CREDIT ' WHEN 8 THEN 'SHELL ' WHEN 9 THEN 'APPLE.COM/BILL ' WHEN 10 THEN 'HOME DEPOT '
                    WHEN 11 THEN 'PAIEMENT MERCI ' WHEN 12 THEN 'GOOGLE WORKSPACE ' ELSE '' END || p_name AS description
        FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    "stmt": """
        SELECT o_orderkey AS id, CAST(o_custkey % 50 AS STRING) AS card, CAST(o_orderdate AS DATE) AS date,
               CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority AS description
        FROM orders
    """,
    "book": """
        SELECT o_orderkey AS id, CAST(o_custkey % 50 AS STRING) AS tab, CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey % 5 ELSE 0 END AS INT) AS date,
               CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 9 = 2 THEN 4 ELSE 0 END AS cents, o_orderpriority AS supplier
        FROM orders WHERE o_orderkey % 10 <> 3
    """,
    "files": """
        SELECT entity AS account, month, CASE WHEN CAST(substring(month, 6, 2) AS INT) % 2 = 0 OR CAST(account AS INT) % 3 = 0 THEN 'csv' ELSE 'pdf' END AS source_type,
               file_name || CASE WHEN CAST(substring(month, 6, 2) AS INT) % 2 = 0 OR CAST(account AS INT) % 3 = 0 THEN '.a' ELSE '.b' END AS file_name, count(*) AS n
        FROM ledger GROUP BY 1, 2, 3, 4
        UNION ALL
        SELECT entity, month, 'pdf', file_name || '.c', count(*)
        FROM ledger WHERE CAST(account AS INT) % 4 = 2 OR CAST(account AS INT) % 4 = 1 AND CAST(substring(month, 6, 2) AS INT) % 2 = 0 GROUP BY 1, 2, 3, 4
    """,
    "registry_old": """
        SELECT 'docs/' || source || '/' || CAST(doc_id AS STRING) || '.csv' AS path,
               'SRC-BANK-' || CASE WHEN doc_id < 999 THEN lpad(CAST(doc_id + 1 AS STRING), 3, '0') ELSE CAST(doc_id + 1 AS STRING) END AS source_id,
               sha2(coalesce(text, '') || CASE WHEN doc_id % 6 = 0 THEN 'x' ELSE '' END, 256) AS sha256, DATE '2024-01-01' AS first_seen, 'bank' AS domain
        FROM documents WHERE doc_id % 5 <> 4
    """,
    "registry_new": """
        SELECT 'docs/' || source || '/' || CAST(doc_id AS STRING) || '.csv' AS path, sha2(coalesce(text, ''), 256) AS sha256, CASE WHEN doc_id % 2 = 0 THEN 'bank' ELSE 'tax' END AS domain
        FROM documents WHERE doc_id % 7 <> 3
    """,
    "decisions": """
        SELECT s_suppkey AS seq, 'E' || CAST(s_nationkey AS STRING) AS entity, 'f' || CAST(s_suppkey % 4 AS STRING) AS field,
               'ts' || lpad(CAST(s_suppkey AS STRING), 8, '0') AS ts, CAST(round(s_acctbal * 100) AS BIGINT) AS value,
               CASE WHEN s_suppkey % 3 = 0 AND s_suppkey > 3 THEN 'ts' || lpad(CAST(s_suppkey - 3 AS STRING), 8, '0') END AS corrects,
               CASE s_suppkey % 5 WHEN 0 THEN 'CONFIRMED' WHEN 1 THEN 'INFERRED' WHEN 2 THEN 'NEEDS_REVIEW' WHEN 3 THEN 'BLOCKED' ELSE 'CONFIRMED' END AS confidence_status,
               CASE WHEN s_suppkey % 7 = 0 THEN 'see art. 5' ELSE 'bank statement' END AS basis
        FROM supplier
    """,
    "schedule": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN '<entity-slug>' ELSE 'E' || CAST(c_nationkey AS STRING) END AS entity,
               CAST(round(c_acctbal * 100) AS BIGINT) AS amount,
               CASE c_custkey % 9 WHEN 0 THEN 'VERIFY' WHEN 1 THEN 'INFERRED' WHEN 2 THEN 'BLOCKED' WHEN 3 THEN 'ODD' WHEN 4 THEN '' ELSE 'CONFIRMED' END AS confidence_status,
               CASE WHEN c_custkey % 8 = 0 THEN '' ELSE 'SRC-BANK-' || lpad(CAST(c_custkey % 30 AS STRING), 3, '0') END AS source_id,
               CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'statement' END AS source, 'page 1' AS source_locator
        FROM customer
    """,
    "words": """
        SELECT CAST(floor(event_id / 60) AS BIGINT) AS doc_id, event_id % 3 AS page, event_id AS word_seq, event_type AS text,
               CAST((event_id * 37) % 500 AS DOUBLE) AS x0, CAST((event_id * 37) % 500 + 20 AS DOUBLE) AS x1, CAST((event_id % 7) * 20 + event_id % 2 AS DOUBLE) AS top
        FROM events
    """,
}
_USES = {name: [t for t in [*VIEWS, "orders", "customer", "lineitem", "part", "nation", "supplier", "events", "documents"] if re.search(rf"(FROM|JOIN) {t}\b", sql)] for name, sql in VIEWS.items()}


def _needed(names: list[str]) -> list[str]:
    """The views in an order in which each follows those it reads."""
    found: list[str] = []
    for name in names:
        for view in [*_needed([u for u in _USES[name] if u in VIEWS]), name]:
            if view not in found:
                found.append(view)
    return found


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A ledger view as a DataFrame over the tables in ``sf_dir``; nothing is read until it is used."""
    inputs = {u: view(spark, sf_dir, u) if u in VIEWS else spark.read.parquet(f"{sf_dir}/{u}.parquet") for u in _USES[name]}
    sql = VIEWS[name]
    for used in inputs:
        sql = re.sub(rf"(FROM|JOIN) {used}\b", rf"\1 {{{used}}}", sql)
    return spark.sql(sql, **inputs)


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL with the named views in front."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in _needed(list(names))]
    if not names:
        return sql
    text = ", ".join(parts).replace("sha2(", "sha256(").replace(", 256)", ")")
    return f"WITH {text} {sql}" if not sql.lstrip().upper().startswith("WITH ") else f"WITH {text}, {sql.lstrip()[5:]}"
