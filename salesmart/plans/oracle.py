"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the DataFrame code: the base views below are the
documented mapping of the driver tables onto the sales fact and dimensions;
each query text is self-contained (``WITH`` the views it needs).
"""

from __future__ import annotations

_VIEWS = {
    "sales": """
SELECT o.o_custkey AS customer_id, s.s_nationkey AS store_id, p.p_name AS product_name,
       CAST(l.l_shipdate AS DATE) AS sales_date, l.l_suppkey AS sales_person_id,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS price, CAST(l.l_quantity AS INT) AS quantity,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
       l.l_returnflag AS payment_mode, l.l_linestatus AS channel
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "customer_dim": """
SELECT c_custkey AS customer_id, substr(c_name,1,8) AS first_name, substr(c_name,10) AS last_name,
       n_name AS address, lpad(CAST(c_nationkey AS VARCHAR(6)),6,'0') AS pincode,
       concat('91', lpad(CAST(c_custkey AS VARCHAR(10)),8,'0')) AS phone_number
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "store_dim": """
SELECT n_nationkey AS id, r_name AS address, n_name AS store_manager_name
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sales_team_dim": """
SELECT s_suppkey AS id, substr(s_name,1,8) AS first_name, substr(s_name,10) AS last_name,
       min(s_suppkey) OVER (PARTITION BY s_nationkey) AS manager_id,
       CASE WHEN s_suppkey = min(s_suppkey) OVER (PARTITION BY s_nationkey) THEN 'Y' ELSE 'N' END AS is_manager,
       n_name AS address, lpad(CAST(s_nationkey AS VARCHAR(6)),6,'0') AS pincode
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "enriched": """
SELECT ct.customer_id, ct.first_name, ct.last_name, ct.address, ct.pincode, ct.phone_number,
       f.store_id, sd.store_manager_name, f.sales_person_id,
       st.first_name AS sales_person_first_name, st.last_name AS sales_person_last_name,
       st.address AS sales_person_address, st.pincode AS sales_person_pincode, st.manager_id, st.is_manager,
       f.sales_date, substr(CAST(f.sales_date AS VARCHAR(10)),1,7) AS sales_month, f.total_cost
FROM sales f JOIN customer_dim ct ON f.customer_id = ct.customer_id
JOIN store_dim sd ON f.store_id = sd.id JOIN sales_team_dim st ON f.sales_person_id = st.id""",
}
_VIEWS["enriched_modes"] = """
SELECT f.customer_id, f.store_id, f.sales_person_id, substr(CAST(f.sales_date AS VARCHAR(10)),1,7) AS sales_month, f.total_cost, f.payment_mode
FROM sales f JOIN customer_dim ct ON f.customer_id = ct.customer_id
JOIN store_dim sd ON f.store_id = sd.id JOIN sales_team_dim st ON f.sales_person_id = st.id"""


def _mixed(row: str, seed: int, stream: int) -> str:
    """The generator's number of a row: fixed modulus and multipliers."""
    a = f"(({row} % 2147483647 * 48271 + {seed * 69621 + stream * 40692 + 1}) % 2147483647)"
    b = f"(({a} * 16807 + {stream * 69621 + 12345}) % 2147483647)"
    return f"({b} * 69621 + {a}) % 2147483647"


_NEEDS = {"enriched": ["sales", "customer_dim", "store_dim", "sales_team_dim"], "enriched_modes": ["sales", "customer_dim", "store_dim", "sales_team_dim"]}

_SELLER_MONTHLY = """SELECT store_id, sales_person_id, concat(sales_person_first_name,' ',sales_person_last_name) AS full_name,
 sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales FROM enriched
 GROUP BY store_id, sales_person_id, sales_person_first_name, sales_person_last_name, sales_month"""

_RANKED = f"""SELECT m.*, CAST(rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC) AS INT) AS rnk
 FROM ({_SELLER_MONTHLY}) m"""

_QUERIES = {
    "star_enrich": (["enriched"], "SELECT * FROM enriched"),
    "customer_monthly": (
        ["enriched"],
        """SELECT customer_id, concat(first_name,' ',last_name) AS full_name, address, phone_number,
 sales_month AS sales_date_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales FROM enriched
 GROUP BY customer_id, first_name, last_name, address, phone_number, sales_month""",
    ),
    "customer_monthly_window": (
        ["enriched"],
        """SELECT DISTINCT customer_id, sales_month,
 CAST(sum(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(18,2)) AS total_sales FROM enriched""",
    ),
    "seller_monthly": (["enriched"], _SELLER_MONTHLY),
    "seller_rank": (["enriched"], _RANKED),
    "top_sellers": (
        ["enriched"],
        f"SELECT store_id, sales_person_id, sales_month, total_sales FROM ({_RANKED}) r WHERE rnk = 1",
    ),
    "seller_incentive": (
        ["enriched"],
        f"""SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
 CAST(CASE WHEN rnk = 1 THEN round(total_sales * CAST(0.01 AS DECIMAL(4,2)), 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
 FROM ({_RANKED}) r""",
    ),
    "customer_mart_detail": (
        ["enriched"],
        "SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost FROM enriched",
    ),
    "seller_mart_detail": (
        ["enriched"],
        """SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
 manager_id, is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost, sales_month FROM enriched""",
    ),
    "partition_counts": (
        ["enriched"],
        """SELECT sales_month, store_id, count(*) AS n, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_cost
 FROM enriched GROUP BY sales_month, store_id""",
    ),
    "fold_extra": (
        ["sales"],
        """SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
 concat_ws(',', channel, payment_mode) AS additional_column,
 concat('{"channel":"', channel, '","payment_mode":"', payment_mode, '"}') AS additional_json FROM sales""",
    ),
    "conform_union": (
        ["sales"],
        """SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
 CAST(NULL AS VARCHAR) AS additional_column FROM sales WHERE payment_mode = 'A'
 UNION ALL SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
 concat_ws(',', channel, payment_mode) FROM sales WHERE payment_mode <> 'A'""",
    ),
    "unmatched_customers": (
        ["sales"],
        """SELECT f.customer_id, count(*) AS n FROM sales f
 WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = f.customer_id AND c.c_acctbal >= 0) GROUP BY f.customer_id""",
    ),
    "unmatched_stores": (
        ["sales"],
        """SELECT f.store_id, count(*) AS n FROM sales f
 WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = f.store_id AND n_nationkey % 3 <> 0) GROUP BY f.store_id""",
    ),
    "unmatched_sellers": (
        ["sales", "sales_team_dim"],
        """SELECT f.sales_person_id, count(*) AS n FROM sales f
 WHERE NOT EXISTS (SELECT 1 FROM sales_team_dim t WHERE t.id = f.sales_person_id AND t.is_manager = 'N')
 GROUP BY f.sales_person_id""",
    ),
    "reject_files": (
        [],
        """SELECT 'missing' AS folder, 'missing_columns' AS reason, 'price,store_id' AS missing
 UNION ALL SELECT 'duplicate', 'duplicate_columns', ''
 UNION ALL SELECT 'region', 'missing_columns',
  'customer_id,price,product_name,quantity,sales_date,sales_person_id,store_id,total_cost' FROM (SELECT count(*) AS n FROM region) r WHERE n > 0
 UNION ALL SELECT 'json', 'not_csv', '' FROM (SELECT count(*) AS n FROM nation) s WHERE n > 0""",
    ),
    "bad_rows_by_column": (
        ["sales"],
        """SELECT folder, errors, count(*) AS n, count(extra) AS n_additional FROM (
 SELECT 'broken' AS folder, CASE quantity % 10 WHEN 0 THEN 'total_cost' WHEN 1 THEN 'customer_id,total_cost'
  WHEN 2 THEN 'sales_date,total_cost' ELSE '' END AS errors, CAST(NULL AS VARCHAR) AS extra FROM sales WHERE payment_mode = 'A'
 UNION ALL SELECT 'sales[1]?', '', NULL FROM sales WHERE payment_mode = 'R'
 UNION ALL SELECT 'sales 100%', '', concat_ws(',', channel, payment_mode) FROM sales WHERE payment_mode = 'N') x
 GROUP BY folder, errors""",
    ),
    "job_customer_monthly": (
        ["enriched"],
        """SELECT customer_id, concat(first_name,' ',last_name) AS full_name, address, phone_number,
 sales_month AS sales_date_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales FROM enriched
 GROUP BY customer_id, first_name, last_name, address, phone_number, sales_month""",
    ),
    "job_seller_monthly": (
        ["enriched"],
        f"""SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
 CAST(CASE WHEN rnk = 1 THEN round(total_sales * CAST(0.01 AS DECIMAL(4,2)), 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
 FROM ({_RANKED}) r""",
    ),
    "job_detail_committed": (
        ["enriched"],
        """SELECT sales_month, store_id, count(*) AS n, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_cost
 FROM enriched GROUP BY sales_month, store_id""",
    ),
    "job_snapshots": (
        ["enriched_modes"],
        """SELECT * FROM (WITH c AS (SELECT k AS snapshot, customer_id, sales_month, sum(total_cost) AS total FROM enriched_modes, (VALUES (1), (2), (3)) t(k)
  WHERE k >= CASE payment_mode WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END GROUP BY k, customer_id, sales_month),
 s AS (SELECT k AS snapshot, store_id, sales_person_id, sales_month, sum(total_cost) AS total FROM enriched_modes, (VALUES (1), (2), (3)) t(k)
  WHERE k >= CASE payment_mode WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END GROUP BY k, store_id, sales_person_id, sales_month)
 SELECT snapshot, 'customer_monthly' AS mart, sales_month, count(*) AS n, CAST(sum(total) AS DECIMAL(18,2)) AS total_sales FROM c GROUP BY snapshot, sales_month
 UNION ALL SELECT snapshot, 'seller_monthly', sales_month, count(*), CAST(sum(total) AS DECIMAL(18,2)) FROM s GROUP BY snapshot, sales_month) x""",
    ),
    "job_monthly_incremental": (
        ["enriched"],
        f"""SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
 CAST(CASE WHEN rnk = 1 THEN round(total_sales * CAST(0.01 AS DECIMAL(4,2)), 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
 FROM ({_RANKED}) r""",
    ),
    "stream_ledger_latest": (
        [],
        """SELECT user_id, event_type AS status, ts AS updated_at FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1""",
    ),
    "conform_multiline": (
        ["sales"],
        """SELECT customer_id, store_id, CASE WHEN quantity % 3 = 0 THEN concat(product_name, chr(10), 'line "two", and', chr(10), chr(10), 'last') ELSE product_name END AS product_name,
 sales_date, sales_person_id, price, quantity, total_cost, CASE WHEN payment_mode <> 'A' THEN channel END AS additional_column FROM sales""",
    ),
    "inferred_types": (
        [],
        """WITH t(column_name, plain, large, odd, widened) AS (VALUES ('customer_id', 'int', 'bigint', 'int', 'bigint'), ('store_id', 'int', 'int', 'int', 'int'),
  ('product_name', 'string', 'string', 'string', 'string'), ('sales_date', 'date', 'date', 'timestamp', 'timestamp'), ('sales_person_id', 'int', 'int', 'int', 'int'),
  ('price', 'double', 'int', 'double', 'double'), ('quantity', 'int', 'int', 'string', 'string'), ('total_cost', 'double', 'double', 'void', 'double')),
 f AS (SELECT 'plain' AS folder, column_name, plain AS type, widened FROM t UNION ALL SELECT 'large', column_name, large, widened FROM t UNION ALL SELECT 'odd', column_name, odd, widened FROM t)
 SELECT folder, column_name AS "column", type, widened, type <> widened AND type <> 'void' AS drift FROM f, (SELECT count(*) AS n FROM lineitem) l WHERE n > 0""",
    ),
    "ledger_anti_join": (
        [],
        """SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events e WHERE event_type = 'signup'
 AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND CAST(p.ts AS DATE) = CAST(e.ts AS DATE))""",
    ),
    "fold_variant": (
        ["sales"],
        """SELECT name, found_type, count(*) AS n, count(DISTINCT value) AS n_distinct, CAST(sum(TRY_CAST(value AS BIGINT)) AS BIGINT) AS total FROM (
 SELECT 'channel' AS name, 'STRING' AS found_type, channel AS value FROM sales UNION ALL SELECT 'payment_mode', 'STRING', payment_mode FROM sales
 UNION ALL SELECT 'discount', 'BIGINT', CAST(quantity % 7 AS VARCHAR) FROM sales
 UNION ALL SELECT 'mixed', 'VARIANT', CASE WHEN quantity % 2 = 0 THEN CAST(quantity AS VARCHAR) ELSE concat('q', quantity) END FROM sales) x GROUP BY name, found_type""",
    ),
    "synth_sales": (
        [],
        f"""WITH i AS (SELECT unnest(range((SELECT count(*) FROM lineitem))) AS row_id),
 m AS (SELECT row_id, {", ".join(f"({_mixed('row_id', 20, k)}) AS x{k}" for k in range(6))} FROM i),
 c AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer),
 s AS (SELECT s_suppkey AS k, s_nationkey AS store_id, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM supplier),
 p AS (SELECT p_name, CAST(p_retailprice AS DECIMAL(18,2)) AS price, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part)
 SELECT row_id, c.k AS customer_id, s.store_id, p_name AS product_name, CAST(DATE '2023-01-01' + CAST(x4 % 365 AS INT) AS DATE) AS sales_date, s.k AS sales_person_id,
  price, CAST(x5 % 10 + 1 AS INT) AS quantity, CAST(price * CAST(x5 % 10 + 1 AS INT) AS DECIMAL(18,2)) AS total_cost
 FROM m JOIN c ON c.place = CASE WHEN x0 % 1000 < 125 THEN 0 ELSE x1 % (SELECT count(*) FROM customer) END
 JOIN s ON s.place = CASE WHEN x0 % 1000 < 125 THEN 0 ELSE x2 % (SELECT count(*) FROM supplier) END
 JOIN p ON p.place = x3 % (SELECT count(*) FROM part)""",
    ),
    "ledger_latest": (
        [],
        """SELECT user_id, event_type AS status, ts AS updated_at FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1""",
    ),
    "ledger_prior_run": (
        [],
        """SELECT DISTINCT user_id FROM events
 WHERE event_type = 'purchase' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
    ),
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        for dep in _NEEDS.get(n, []):
            if dep not in out:
                out.append(dep)
        if n not in out:
            out.append(n)
    return out


def sql(name: str) -> str:
    views, body = _QUERIES[name]
    ctes = [f"{v} AS ({_VIEWS[v].strip()})" for v in _closure(views)]
    return (f"WITH {', '.join(ctes)}\n" if ctes else "") + body.strip()


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in _QUERIES}
