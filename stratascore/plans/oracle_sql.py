"""SQL building blocks for the check: the three feature tables and their long forms."""

from __future__ import annotations

from stratascore.sources.features import CUSTOMER_FEATURES, DOCUMENT_FEATURES, EMBEDDING_DIM, EMBEDDING_FEATURES

CUSTOMER = """
cust AS (
  SELECT c.c_custkey AS id,
         CAST(CASE WHEN max(c.c_acctbal) < 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
         max(c.c_mktsegment) AS grp,
         count(DISTINCT o.o_orderkey) AS n_orders,
         count(l.l_orderkey) AS n_lines,
         coalesce(sum(l.l_quantity), 0) AS sum_qty,
         coalesce(sum(l.l_extendedprice), 0) AS sum_price,
         coalesce(max(l.l_extendedprice), 0) AS max_price,
         coalesce(avg(l.l_discount), 0) AS avg_disc,
         coalesce(avg(l.l_tax), 0) AS avg_tax,
         coalesce(avg(CASE WHEN l.l_orderkey IS NULL THEN NULL WHEN l.l_returnflag = 'R' THEN 1e0 ELSE 0e0 END), 0) AS ret_share,
         coalesce(avg(CASE WHEN l.l_orderkey IS NULL THEN NULL WHEN o.o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END), 0) AS done_share,
         coalesce(stddev_samp(l.l_quantity), 0) AS sd_qty,
         CAST(1 AS INTEGER) AS one_flag,
         2 * coalesce(sum(l.l_extendedprice), 0) AS sum_price_x2
  FROM customer c
  LEFT JOIN orders o ON o.o_custkey = c.c_custkey
  LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY c.c_custkey
)"""

DOCUMENT = """
docs AS (
  SELECT d.doc_id AS id, CAST(b.toxic AS INTEGER) AS label, d.lang AS grp,
         CAST(d.n_chars AS BIGINT) AS n_chars,
         length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g')) AS n_digit,
         length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g')) AS n_upper,
         length(d.text) - length(regexp_replace(d.text, '[.,;:!?]', '', 'g')) AS n_punct,
         length(d.text) - length(replace(d.text, ' ', '')) AS n_space,
         length(d.text) - length(replace(d.text, chr(10), '')) AS n_nl
  FROM documents d JOIN labels b ON b.doc_id = d.doc_id
)"""

ALL_DOCUMENT = DOCUMENT.replace("JOIN labels", "LEFT JOIN labels")  # documents without a label too

EMBEDDING = """
emb AS (
  SELECT vec_id AS id, CAST(label AS INTEGER) AS cluster,
         CAST(CASE WHEN label = 9 THEN 1 ELSE 0 END AS INTEGER) AS label,
         CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
)"""

EMBEDDING_LONG = f"""
emb_long AS (
  SELECT id, cluster, label, 'e' || CAST(i AS VARCHAR) AS feature, i AS pos, v[i + 1] AS value
  FROM emb, range({EMBEDDING_DIM}) t(i)
)"""

TABLES = {
    "cust": (CUSTOMER, CUSTOMER_FEATURES),
    "docs": (DOCUMENT, DOCUMENT_FEATURES),
    "emb": (EMBEDDING, EMBEDDING_FEATURES),
}


def long_cte(table: str, features: list[str] | None = None) -> str:
    """``<table>_long(id, label, grp, feature, pos, value)`` for the customer or document table."""
    features = features or TABLES[table][1]
    arms = "\n  UNION ALL ".join(
        f"SELECT id, label, grp, '{f}' AS feature, {i} AS pos, CAST({f} AS DOUBLE) AS value FROM {table}"
        for i, f in enumerate(features)
    )
    return f"{table}_long AS (\n  {arms}\n)"


def with_long(table: str, features: list[str] | None = None, unlabelled: bool = False) -> str:
    """``WITH <table>, <table>_long``."""
    if unlabelled:
        return f"WITH {ALL_DOCUMENT}, {long_cte(table, features)}"
    if table == "emb":
        return f"WITH {EMBEDDING}, {EMBEDDING_LONG}"
    return f"WITH {TABLES[table][0]}, {long_cte(table, features)}"


def hash_u32(expr: str, *salt: object) -> str:
    text = " || ':' || ".join([f"CAST({expr} AS VARCHAR)", *[f"'{s}'" if not str(s).startswith("@") else f"CAST({str(s)[1:]} AS VARCHAR)" for s in salt]])
    return f"CAST(('0x' || substr(md5({text}), 1, 8))::UBIGINT AS BIGINT)"
