"""Landing-shaped frames derived from the shared test tables.

The staging loads expect landing tables (member captured list, member
list, product extract) that the test data does not have.  These adapters
derive them from the TPC-H-style tables, row for row, so every load runs
over whole tables and grows with the scale factor:

* captured list   one row per lineitem (order, customer, supplier, part)
* product extract one row per lineitem (part offered by a supplier to a
                  customer segment); duplicates are left for the loads' dedupe
* member list     one row per order (customer attributes, repeated)

Each column is one expression template rendered for Spark SQL or DuckDB,
so the oracle SQL derives exactly the same landing rows.  Names are kept
upper-case where a later lookup compares them without ``upper`` (the
model's case handling is faithful, so mixed case would drop those rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstage.session import session_id

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DIALECTS = {
    "spark": {
        "mdy": "date_format({0}, 'MM/dd/yyyy')",
        "iso": "date_format({0}, 'yyyy-MM-dd')",
        "day": "CAST(date_add(DATE'1950-01-01', CAST({0} AS INT)) AS STRING)",
        "day_mdy": "date_format(date_add(DATE'1950-01-01', CAST({0} AS INT)), 'MM/dd/yyyy')",
    },
    "duckdb": {
        "mdy": "strftime({0}, '%m/%d/%Y')",
        "iso": "strftime({0}, '%Y-%m-%d')",
        "day": "CAST(DATE '1950-01-01' + CAST({0} AS INTEGER) AS VARCHAR)",
        "day_mdy": "strftime(DATE '1950-01-01' + CAST({0} AS INTEGER), '%m/%d/%Y')",
    },
}


def render(template: str, dialect: str) -> str:
    d = DIALECTS[dialect]
    out = template
    for name, pattern in d.items():
        tag = "{" + name + ":"
        while tag in out:
            i = out.index(tag)
            j = out.index("}", i)
            arg = out[i + len(tag):j]
            out = out[:i] + pattern.format(arg) + out[j + 1:]
    return out


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A test table (the read is resolved once per session and path)."""
    path = f"{d.rstrip('/')}/{name}.parquet"
    key = (session_id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


# ---------------------------------------------------------------- captured list
def _beneficiary_templates() -> list[tuple[str, str]]:
    """Slot k is filled when k <= c_custkey % 6 (0-5 beneficiaries)."""
    out = []
    n = "(c_custkey % 6)"
    for k in range(1, 6):
        filled = f"{k} <= {n}"
        out += [
            (f"beneficiary_full_name_{k}",
             f"CASE WHEN {filled} THEN 'BEN {k} OF ' || CAST(c_custkey AS STRING) END"),
            (f"beneficiary_id_number_{k}",
             f"CASE WHEN {filled} THEN CAST(c_custkey * 10 + {k} AS STRING) END"),
            (f"beneficiary_relation_{k}",
             f"CASE WHEN {filled} THEN "
             f"{'SPOUSE' if k == 1 else 'CHILD' if k == 2 else 'PARENT'!r} END"),
            (f"beneficiary_percentage_{k}",
             f"CASE WHEN {filled} THEN (CASE {n} WHEN 1 THEN '100' WHEN 2 THEN '50' "
             f"ELSE '33.34' END) END"),
            (f"beneficiary_cell_{k}",
             f"CASE WHEN {filled} THEN '07' || lpad(CAST(c_custkey * 10 + {k} AS STRING), 8, '0') END"),
        ]
    return out


CAPTURED_COLS = [
    ("agent_code", "CAST(s_suppkey AS STRING)"),
    ("agent", "s_name"),
    ("contact_number", "'0' || CAST(s_suppkey AS STRING)"),
    ("broker_code", "CAST(s_suppkey AS STRING)"),
    ("broker", "s_name"),
    ("branch_name", "n_name"),
    ("client", "lower(c_mktsegment)"),
    ("first_name", "upper(c_name)"),
    ("last_name", "c_mktsegment"),
    ("id_number", "CAST(c_custkey AS STRING)"),
    ("gender", "CASE WHEN (c_custkey + CASE WHEN c_custkey % 31 = 5 THEN l_linenumber ELSE 0 END) % 2 = 0 THEN 'F' ELSE 'M' END"),
    ("date_of_birth", "CASE WHEN c_custkey % 29 = 3 AND l_linenumber = 2 THEN '1970-02-03' WHEN c_custkey % 97 = 13 THEN '1980-13-01' ELSE {day:c_custkey % 18000} END"),
    ("postal_add_1", "'BOX ' || CAST(c_custkey % 1000 AS STRING)"),
    ("postal_add_2", "o_orderpriority"),
    ("postal_add_3", "n_name"),
    ("postal_code", "CAST(1000 + c_nationkey AS STRING)"),
    ("res_address_1", "'UNIT ' || CAST(o_orderkey % 50 AS STRING)"),
    ("res_address_2", "o_orderstatus"),
    ("res_address_3", "n_name"),
    ("res_code", "CAST(2000 + c_nationkey AS STRING)"),
    *_beneficiary_templates(),
    ("policy_number", "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"),
    ("policy_description", "p_name"),
    ("cover", "CAST(p_size * 1000 AS STRING) || CASE WHEN l_linenumber = 1 THEN '.50' ELSE '' END"),
    ("member_type", "p_type"),
    ("capture_date", "CASE WHEN l_linenumber = 7 THEN '13/01/1995' ELSE {mdy:o_orderdate} END"),
    ("inception", "{mdy:l_shipdate}"),
    ("status", "o_orderstatus"),
]

PRODUCT_EXTRACT_COLS = [
    ("policy_code", "CAST(p_partkey AS STRING)"),
    ("policy_description", "p_name"),
    ("relate_to", "p_type"),
    ("age_from", "CAST(p_size % 10 + 18 AS STRING)"),
    ("age_to", "CAST(p_size + 60 AS STRING)"),
    ("premium", "CAST(p_retailprice AS STRING)"),
    ("underwriter_premium",
     "CASE WHEN p_size > 45 THEN CAST(p_partkey * 10 + 100000 AS STRING) "
     "ELSE CAST(p_partkey % 1000 AS STRING) || '.' || lpad(CAST(p_partkey * 7 % 1000 AS STRING), 3, '0') END"),
    ("cover", "CAST(p_size * 1000 AS STRING)"),
    ("waiting_period", "CASE WHEN p_size % 9 = 0 THEN 'none' ELSE CAST(p_size % 6 AS STRING) END"),
    ("product_category", "p_brand"),
    ("product_type", "p_type"),
    ("broker_code", "CAST(s_suppkey AS STRING)"),
    ("broker_name", "upper(s_name)"),
    ("client", "c_mktsegment"),
    ("underwriter", "'UW' || CAST(s_nationkey AS STRING)"),
]

MEMBER_LIST_COLS = [
    ("first_name", "c_name"),
    ("last_name", "c_mktsegment"),
    ("id_number", "CAST(c_custkey AS STRING)"),
    ("gender", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END"),
    ("birth_date", "CASE WHEN c_custkey % 97 = 13 THEN '13/01/1980' ELSE {day_mdy:c_custkey % 18000} END"),
    ("title", "CASE c_custkey % 3 WHEN 0 THEN 'MR' WHEN 1 THEN 'MS' END"),
]


def _exprs(cols, dialect):
    return [f"{render(t, dialect)} AS {n}" for n, t in cols]


LINE_COLS = ("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_orderkey",
             "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "p_partkey", "p_name", "p_type", "p_size", "p_brand", "p_retailprice",
             "s_suppkey", "s_name", "s_nationkey")


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """One row per lineitem with its order, customer, supplier and part: the columns both landing lists are made of.

    The narrow columns of lineitem are shuffled before the attributes are known, and the
    customers come last of the large tables, so that a customer's rows end up together; the
    suppliers are few, and their attributes are added where the rows then are.
    """
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    p = table(spark, d, "part")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(p, F.col("l_partkey") == p.p_partkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey))
    # equal by the join: the order's key is carried once
    return j.select(*[F.col("l_orderkey").cast(o.schema[x].dataType).alias(x) if x == "o_orderkey" else x for x in LINE_COLS])


def captured_list(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """``lines``: the frame of ``order_lines``, if it has been written."""
    lines = order_lines(spark, d) if lines is None else lines
    n = table(spark, d, "nation")
    return lines.join(n, F.col("s_nationkey") == n.n_nationkey).selectExpr(*_exprs(CAPTURED_COLS, "spark"))


def product_extract(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """``lines``: the frame of ``order_lines``, if it has been written."""
    lines = order_lines(spark, d) if lines is None else lines
    return lines.selectExpr(*_exprs(PRODUCT_EXTRACT_COLS, "spark"))


def member_list(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(*_exprs(MEMBER_LIST_COLS, "spark"))


def captured_list_sql() -> str:
    return ("SELECT " + ", ".join(_exprs(CAPTURED_COLS, "duckdb")) +
            " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
            " JOIN customer ON o_custkey = c_custkey"
            " JOIN supplier ON l_suppkey = s_suppkey"
            " JOIN nation ON s_nationkey = n_nationkey"
            " JOIN part ON l_partkey = p_partkey")


def product_extract_sql() -> str:
    return ("SELECT " + ", ".join(_exprs(PRODUCT_EXTRACT_COLS, "duckdb")) +
            " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
            " JOIN customer ON o_custkey = c_custkey"
            " JOIN supplier ON l_suppkey = s_suppkey"
            " JOIN part ON l_partkey = p_partkey")


def member_list_sql() -> str:
    return ("SELECT " + ", ".join(_exprs(MEMBER_LIST_COLS, "duckdb")) +
            " FROM orders JOIN customer ON o_custkey = c_custkey")
