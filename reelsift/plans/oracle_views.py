"""DuckDB text of the canonical views, prepended to every oracle query.

The oracle is an independent SQL statement of each query's semantics; it runs
in DuckDB on the same parquet tables the driver registers as views.
"""

from __future__ import annotations

VIEWS = {
    "ratings": """
ratings AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
           CAST(ceil(l.l_quantity / 5) * 0.5 AS DOUBLE) AS rating,
           CAST(date_diff('day', DATE '1970-01-01', CAST(l.l_shipdate AS DATE)) AS BIGINT) * 86400 AS ts,
           row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
             ORDER BY l.l_shipdate DESC, l.l_orderkey DESC, l.l_linenumber DESC, l.l_quantity DESC) AS rn
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) x
  WHERE rn = 1)""",
    "items": """
items AS (
  SELECT p_partkey AS item_id,
         CASE WHEN p_partkey % 97 = 0 THEN p_name
              ELSE concat(p_name, ' (', CAST(1970 + p_size AS VARCHAR), ')') END AS title,
         CASE p_partkey % 4 WHEN 0 THEN p_type
              WHEN 1 THEN concat(p_type, '|', substr(p_name, 1, sp))
              ELSE concat(p_type, '|', substr(p_name, 1, sp), '|', substr(p_name, sp + 2)) END AS genres
  FROM (SELECT *, instr(p_name, ' ') - 1 AS sp FROM part) p
  WHERE p_partkey % 101 <> 0)""",
    "links": """
links AS (
  SELECT p_partkey AS item_id, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdb_id,
         CAST(p_partkey * 7 AS VARCHAR) AS tmdb_id
  FROM part WHERE p_partkey % 53 <> 0)""",
    "item_emb": """
item_emb AS (SELECT vec_id AS item_id, CAST(embedding AS FLOAT[]) AS emb FROM embeddings)""",
}

ORDER = ["ratings", "items", "links", "item_emb"]


def with_views(body: str, *extra_ctes: str) -> str:
    """``WITH <canonical views>, <extra ctes> <body>``."""
    ctes = [VIEWS[n].strip() for n in ORDER] + [c.strip() for c in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
