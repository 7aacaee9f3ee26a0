"""Registered queries over the test tables and their DuckDB oracle SQL.

Every query reads whole tables (or frames Spark derives from them) and
returns a DataFrame whose dates, timestamps and decimals are rendered as
text, so both engines are compared on the same representation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landstage.functions import (audit_columns, clock12, format_ts, hash_of, parse_date, second_trunc,
                                 to_decimal, to_double, to_int)
from landstage.functions.scalar import scalar_function
from landstage.functions.text import chop_prefix
from landstage.operators import (apply_mapping, combinations, dedupe, explode_values, lookup,
                                 map_columns, map_records, relationalize, resolve_choice,
                                 unpivot_cross, unpivot_factored, unpivot_positional)
from landstage.plans import model as M
from landstage.plans.jobs import run_job
from landstage.plans.cleaning import clean_and_nest, flatten
from landstage.plans.skeletons import (explode_encode, relationalize_encode, select_rename_stamp,
                                       stamp_all)
from landstage.plans.spec import run_load, unmatched
from landstage.plans.staging import BROADCAST_ROWS, load_product, product_rows, two_feeds, unique_lookups, written
from landstage.plans.testbed import (TABLES, captured_list_sql, member_list_sql,
                                     product_extract_sql, table)
from landstage.session import scratch_path
from landstage.sinks import copy_parquet_tree, finished_files, record_run, runs, write_parquet, write_run
from landstage.sinks.runs import ledger_name
from landstage.sources import discover_files, read_paths, read_table, read_tree

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

PINNED = "2024-01-01 13:05:07"          # pinned load instant for deterministic stamps


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Dates/timestamps/decimals as text, binary as hex, dotted names with '_'."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.BinaryType):
            c = F.hex(c)
        cols.append(c.alias(f.name.replace(".", "_")))
    return df.select(*cols)


# ------------------------------------------------------------------ SQL helpers
def _txt(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def H(*cols: str) -> str:
    return "hex(sha1(" + " || ".join(_txt(c) for c in cols) + "))"


def SID(*cols: str) -> str:
    return "sha1(" + " || ".join(_txt(c) for c in cols) + ")"


def INT(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DECIMAL(38,18))) AS INTEGER)"


def DATE(c: str, fmt: str) -> str:
    return f"CAST(CAST(try_strptime({c}, '{fmt}') AS DATE) AS VARCHAR)"


CAP = "landing_member_captured_list"
EXT = "landing_product_extract_list"
LST = "landing_member_list"


def staging_ctes() -> str:
    return f"""
cap AS ({captured_list_sql()}),
ext AS ({product_extract_sql()}),
stg_member AS (
  SELECT {SID('id_number', 'first_name', 'last_name')} AS member_id,
         upper(first_name) AS first_name, upper(last_name) AS last_name, id_number, gender,
         CAST(try_strptime(date_of_birth, '%Y-%m-%d') AS DATE) AS birth_date, '' AS title,
         {H('id_number', 'first_name', 'last_name')} AS hash_key,
         {H('id_number', 'first_name', 'last_name', 'gender', 'date_of_birth')} AS hash_diff,
         '{CAP}' AS source_table
  FROM (SELECT DISTINCT first_name, last_name, id_number, gender, date_of_birth FROM cap) t),
stg_broker AS (
  SELECT {SID('broker_code', 'broker_name')} AS broker_id, broker_code,
         upper(broker_name) AS broker_name, '' AS broker_branch,
         {H('broker_code', 'broker_name')} AS hash_key, {H('broker_code', 'broker_name')} AS hash_diff,
         '{EXT}' AS source_table
  FROM (SELECT DISTINCT broker_code, broker_name FROM ext) t),
stg_client AS (
  SELECT {SID('client')} AS client_id, upper(client) AS client_name,
         {H('client')} AS hash_key, {H('client')} AS hash_diff, '{EXT}' AS source_table
  FROM (SELECT DISTINCT client FROM ext) t),
stg_bc AS (
  SELECT {SID('b.broker_id', 'c.client_id')} AS broker_client_id, b.broker_id, c.client_id,
         {H('b.broker_id', 'c.client_id')} AS hash_key, {H('b.broker_id', 'c.client_id')} AS hash_diff,
         '{EXT}' AS source_table
  FROM (SELECT DISTINCT upper(broker_code) AS bcode, upper(broker_name) AS bname,
                        upper(client) AS cl FROM ext) x
  JOIN stg_broker b ON x.bcode = b.broker_code AND x.bname = b.broker_name
  JOIN stg_client c ON x.cl = c.client_name),
stg_product AS (
  SELECT {SID('x.policy_code', 'x.policy_description', 'bc.broker_client_id', 'x.relate_to',
              'x.age_from', 'x.age_to')} AS product_id,
         x.policy_code, x.policy_description, bc.broker_client_id, x.relate_to,
         x.premium AS retail_premium, x.underwriter,
         {INT('x.age_to')} AS age_to, {INT('x.age_from')} AS age_from,
         CAST(TRY_CAST(x.underwriter_premium AS DECIMAL(7,2)) AS VARCHAR) AS underwriter_premium,
         {INT('x.cover')} AS cover, {INT('x.waiting_period')} AS waiting_period,
         x.product_category, x.product_type, '' AS grace_period, 0 AS number_of_dependents,
         {H('x.policy_code', 'x.policy_description', 'bc.broker_client_id', 'x.relate_to',
            'x.age_from', 'x.age_to')} AS hash_key,
         {H('x.policy_code', 'x.policy_description', 'bc.broker_client_id', 'x.relate_to',
            'x.age_from', 'x.age_to')} AS hash_diff,
         '{EXT}' AS source_table
  FROM (SELECT DISTINCT * FROM ext) x
  JOIN stg_broker b ON x.broker_code = b.broker_code AND x.broker_name = b.broker_name
  JOIN stg_client c ON x.client = c.client_name
  JOIN stg_bc bc ON b.broker_id = bc.broker_id AND c.client_id = bc.client_id)
"""


def with_staging(select: str) -> str:
    return "WITH " + staging_ctes() + select


# ========================================================================= scans
@register("scan_catalog", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_scan_catalog(spark, d):
    table(spark, d, "nation").createOrReplaceTempView("nation")
    return read_table(spark, "nation").select("n_nationkey", "n_name", "n_regionkey")


@register("scan_paths", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_scan_paths(spark, d):
    return read_paths(spark, [f"{d.rstrip('/')}/orders.parquet"], "parquet") \
        .select("o_orderkey", "o_custkey", "o_orderstatus")


_FILE_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@register("scan_discover", _FILE_COUNTS_SQL)
def q_scan_discover(spark, d):
    files = discover_files(spark, d).select(F.col("relative").alias("file_name"))
    counts = read_tree(spark, d).groupBy(F.col("relative").alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return files.join(counts, "file_name", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))


# ==================================================================== projections
@register("select_all_stamped", f"SELECT *, '{PINNED}' AS LOAD_DTS FROM customer")
def q_select_all_stamped(spark, d):
    return stamp_all(table(spark, d, "customer"), at=PINNED)


@register("select_rename_stamp",
          f"SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice, "
          f"'{PINNED}' AS this_is_timestamp FROM orders")
def q_select_rename_stamp(spark, d):
    return select_rename_stamp(table(spark, d, "orders"),
                               [("o_orderkey", "order_key"), ("o_orderstatus", "status"), "o_totalprice"],
                               at=PINNED)


# ====================================================================== dedupe
@register("dedupe_keys",
          f"SELECT o_orderstatus, o_orderpriority, {H('o_orderstatus', 'o_orderpriority')} AS hash_key "
          f"FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders) t")
def q_dedupe_keys(spark, d):
    u = dedupe(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])
    return u.select("*", hash_of("o_orderstatus", "o_orderpriority").alias("hash_key"))


@register("dedupe_upper_keys",
          "SELECT DISTINCT upper(p_name) AS p_name, upper(p_brand) AS p_brand FROM part")
def q_dedupe_upper_keys(spark, d):
    return dedupe(table(spark, d, "part"), [F.upper("p_name").alias("p_name"),
                                            F.upper("p_brand").alias("p_brand")])


@register("dedupe_with_count",
          "SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY 1, 2")
def q_dedupe_with_count(spark, d):
    return dedupe(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], keep_count=True,
                  count_name="n_rows")


# ====================================================================== hashes
@register("hash_key_basic", f"SELECT o_orderkey, {H('o_orderkey', 'o_orderdate')} AS hash_key FROM orders")
def q_hash_key_basic(spark, d):
    return table(spark, d, "orders").select("o_orderkey",
                                            hash_of("o_orderkey", "o_orderdate").alias("hash_key"))


@register("hash_diff_basic",
          f"SELECT o_orderkey, {H('o_orderkey', 'o_orderdate', 'o_orderstatus')} AS hash_diff FROM orders")
def q_hash_diff_basic(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", hash_of("o_orderkey", "o_orderdate", "o_orderstatus").alias("hash_diff"))


@register("hash_null_semantics",
          f"SELECT c_custkey, {H('c_custkey', 'nullif(c_mktsegment, ' + chr(39) + 'BUILDING' + chr(39) + ')')}"
          f" AS hash_key FROM customer")
def q_hash_null_semantics(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", hash_of("c_custkey", "nullif(c_mktsegment, 'BUILDING')").alias("hash_key"))


@register("audit_stamp",
          f"SELECT s_suppkey, {H('s_suppkey', 's_name')} AS hash_key, "
          f"{H('s_suppkey', 's_name', 's_nationkey')} AS hash_diff, 'supplier' AS source_table, "
          f"'2024-01-01 01:05:07' AS load_dts FROM supplier")
def q_audit_stamp(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", hash_of("s_suppkey", "s_name").alias("hash_key"),
                    hash_of("s_suppkey", "s_name", "s_nationkey").alias("hash_diff"),
                    *audit_columns("supplier", at=PINNED, mode="clock12"))


# ================================================================= stamps & dates
@register("load_dts_clock12",
          "SELECT event_id, CAST(date_trunc('second', ts) - CASE WHEN hour(ts) >= 12 "
          "THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS VARCHAR) AS load_dts FROM events")
def q_load_dts_clock12(spark, d):
    return table(spark, d, "events").select("event_id", clock12("ts").alias("load_dts"))


@register("load_dts_exact",
          "SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS load_dts FROM events")
def q_load_dts_exact(spark, d):
    return table(spark, d, "events").select("event_id", second_trunc("ts").alias("load_dts"))


@register("stamp_text",
          "SELECT event_id, strftime(ts, '%m/%d/%Y %I:%M:%S') AS stamp FROM events")
def q_stamp_text(spark, d):
    return table(spark, d, "events").select("event_id", format_ts("ts").alias("stamp"))


@register("parse_date_mdy",
          "SELECT o_orderkey, " + DATE(
              "CASE WHEN o_orderkey % 13 = 0 THEN '13/01/1995' ELSE strftime(o_orderdate, '%m/%d/%Y') END",
              "%m/%d/%Y") + " AS order_date FROM orders")
def q_parse_date_mdy(spark, d):
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderkey") % 13 == 0, F.lit("13/01/1995")) \
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return o.select("o_orderkey", parse_date(txt, "MM/dd/yyyy").alias("order_date"))


@register("parse_date_iso",
          "SELECT o_orderkey, " + DATE(
              "CASE WHEN o_orderkey % 13 = 0 THEN '1995-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END",
              "%Y-%m-%d") + " AS order_date FROM orders")
def q_parse_date_iso(spark, d):
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderkey") % 13 == 0, F.lit("1995-13-01")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", parse_date(txt, "yyyy-MM-dd").alias("order_date"))


# ======================================================================== casts
_INT_TXT = ("CASE WHEN l_linenumber = 3 THEN 'n/a' "
            "WHEN l_linenumber = 4 THEN CAST(l_orderkey AS STRING) || '000000000' "
            "ELSE CAST(l_extendedprice AS STRING) END")
_DEC_TXT = ("CASE WHEN l_linenumber = 3 THEN 'n/a' "
            "WHEN l_linenumber = 2 THEN CAST(l_partkey % 1000 AS STRING) || '.' || "
            "lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0') "
            "ELSE CAST(l_extendedprice AS STRING) END")


@register("cast_int_tolerant",
          f"SELECT l_orderkey, l_linenumber, {INT(_INT_TXT)} AS v FROM lineitem")
def q_cast_int_tolerant(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", to_int(F.expr(_INT_TXT)).alias("v"))


@register("cast_decimal_tolerant",
          f"SELECT l_orderkey, l_linenumber, CAST(TRY_CAST({_DEC_TXT} AS DECIMAL(7,2)) AS VARCHAR) AS v "
          f"FROM lineitem")
def q_cast_decimal_tolerant(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", to_decimal(F.expr(_DEC_TXT), 7, 2).alias("v"))


# ======================================================================= lookups
@register("lookup_single",
          "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def q_lookup_single(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return lookup(o, table(spark, d, "customer"), [("o_custkey", "c_custkey")],
                  {"c_name": "c_name"}).drop("o_custkey")


@register("lookup_composite",
          "SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation "
          "ON c_nationkey = n_nationkey AND 'NATION_' || CAST(c_nationkey AS VARCHAR) = n_name")
def q_lookup_composite(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    out = lookup(c, table(spark, d, "nation"),
                 [("c_nationkey", "n_nationkey"), ("'NATION_' || CAST(c_nationkey AS STRING)", "n_name")],
                 ["n_name", "n_regionkey"])
    return out.drop("c_nationkey")


@register("lookup_upper_key",
          "SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey "
          "JOIN nation ON upper('nation_' || CAST(c_nationkey AS VARCHAR)) = n_name")
def q_lookup_upper_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    o = lookup(o, table(spark, d, "customer"), [("o_custkey", "c_custkey")], ["c_nationkey"])
    o = lookup(o, table(spark, d, "nation"),
               [("upper('nation_' || CAST(c_nationkey AS STRING))", "n_name")], ["n_name"])
    return o.select("o_orderkey", "n_name")


@register("lookup_cast_key",
          f"SELECT c_custkey, n_name FROM customer JOIN nation "
          f"ON {INT(chr(39).join(['CAST(c_nationkey AS VARCHAR) || ', '.9', '']))} = n_nationkey")
def q_lookup_cast_key(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    key = to_int(F.concat(F.col("c_nationkey").cast("string"), F.lit(".9")))
    return lookup(c, table(spark, d, "nation"), [(key, "n_nationkey")], ["n_name"]).drop("c_nationkey")


# ============================================================== staging loads
def _load(spec, spark, d):
    """Run a load over the written landing (and staging) tables."""
    return run_load(spec, written(spark, d, spec.needs()), stamp=None, narrow=True)


@register("dim_agent", f"""WITH cap AS ({captured_list_sql()})
SELECT agent_code, agent AS agent_name, {INT('contact_number')} AS contact_number,
       {H('agent_code', 'agent')} AS hash_key, {H('agent_code', 'agent', 'contact_number')} AS hash_diff,
       '{CAP}' AS source_table
FROM (SELECT DISTINCT agent_code, agent, contact_number FROM cap) t""")
def q_dim_agent(spark, d):
    return _load(M.AGENT, spark, d)


@register("dim_broker", f"""WITH cap AS ({captured_list_sql()})
SELECT broker_code, broker AS broker_name, branch_name AS broker_branch,
       {H('broker_code', 'broker', 'branch_name')} AS hash_key,
       {H('broker_code', 'broker', 'branch_name')} AS hash_diff, '{CAP}' AS source_table
FROM (SELECT DISTINCT broker_code, broker, branch_name FROM cap) t""")
def q_dim_broker(spark, d):
    return _load(M.BROKER, spark, d)


@register("dim_client", f"""WITH cap AS ({captured_list_sql()})
SELECT client AS client_name, {H('client')} AS hash_key, {H('client')} AS hash_diff,
       '{CAP}' AS source_table
FROM (SELECT DISTINCT client FROM cap) t""")
def q_dim_client(spark, d):
    return _load(M.CLIENT, spark, d)


@register("dim_member", f"""WITH cap AS ({captured_list_sql()})
SELECT upper(first_name) AS first_name, upper(last_name) AS last_name, id_number, gender,
       {DATE('date_of_birth', '%Y-%m-%d')} AS birth_date, '' AS title,
       {H('id_number', 'first_name', 'last_name')} AS hash_key,
       {H('id_number', 'first_name', 'last_name', 'gender', 'date_of_birth')} AS hash_diff,
       '{CAP}' AS source_table
FROM (SELECT DISTINCT first_name, last_name, id_number, gender, date_of_birth FROM cap) t""")
def q_dim_member(spark, d):
    return _load(M.MEMBER, spark, d)


@register("dim_member_list", f"""WITH lst AS ({member_list_sql()})
SELECT first_name, last_name, id_number, gender, {DATE('birth_date', '%m/%d/%Y')} AS birth_date, title,
       {H('id_number', 'first_name', 'last_name')} AS hash_key,
       {H('id_number', 'first_name', 'last_name', 'gender', 'birth_date', 'title')} AS hash_diff,
       '{LST}' AS source_table
FROM lst""")
def q_dim_member_list(spark, d):
    return _load(M.MEMBER_FROM_LIST, spark, d)


@register("dim_broker_extract", f"""WITH ext AS ({product_extract_sql()})
SELECT broker_code, upper(broker_name) AS broker_name, '' AS broker_branch,
       {H('broker_code', 'broker_name')} AS hash_key, {H('broker_code', 'broker_name')} AS hash_diff,
       '{EXT}' AS source_table
FROM (SELECT DISTINCT broker_code, broker_name FROM ext) t""")
def q_dim_broker_extract(spark, d):
    return _load(M.BROKER_FROM_EXTRACT, spark, d)


@register("dim_client_extract", f"""WITH ext AS ({product_extract_sql()})
SELECT upper(client) AS client_name, {H('client')} AS hash_key, {H('client')} AS hash_diff,
       '{EXT}' AS source_table
FROM (SELECT DISTINCT client FROM ext) t""")
def q_dim_client_extract(spark, d):
    return _load(M.CLIENT_FROM_EXTRACT, spark, d)


@register("link_broker_client", with_staging(
    "SELECT broker_id, client_id, hash_key, hash_diff, source_table FROM stg_bc"))
def q_link_broker_client(spark, d):
    return _load(M.BROKER_CLIENT, spark, d)


@register("dim_product", with_staging(
    "SELECT * EXCLUDE (product_id) FROM stg_product"))
def q_dim_product(spark, d):
    return load_product(spark, d, M.PRODUCT, written(spark, d, M.PRODUCT.needs()), narrow=True)


_POLICY_HASH = H("x.policy_number", "m.member_id", "p.product_id", "x.capture_date", "x.inception",
                 "x.status")


@register("fact_policy", with_staging(f"""
SELECT x.policy_number, m.member_id, p.product_id,
       {DATE('x.capture_date', '%m/%d/%Y')} AS capture_date,
       {DATE('x.inception', '%m/%d/%Y')} AS inception_date, x.status,
       {_POLICY_HASH} AS hash_key, {_POLICY_HASH} AS hash_diff, '{CAP}' AS source_table
FROM cap x
JOIN stg_member m ON upper(x.last_name) = m.last_name AND upper(x.first_name) = m.first_name
                 AND x.id_number = m.id_number
JOIN stg_broker b ON x.broker_code = b.broker_code AND upper(x.broker) = b.broker_name
JOIN stg_client c ON upper(x.client) = c.client_name
JOIN stg_bc bc ON b.broker_id = bc.broker_id AND c.client_id = bc.client_id
JOIN stg_product p ON bc.broker_client_id = p.broker_client_id
                  AND x.policy_description = p.policy_description
                  AND {INT('x.cover')} = p.cover AND x.member_type = p.relate_to"""))
def q_fact_policy(spark, d):
    return _load(M.POLICY, spark, d)


_ADDR = ", ".join(M.ADDRESS_COLS)


@register("load_member_address", with_staging(f"""
SELECT m.id_number AS member_id, {", ".join("x." + c for c in M.ADDRESS_COLS)},
       {H('x.id_number', 'x.first_name', 'x.last_name')} AS hash_key,
       {H('x.id_number', 'x.first_name', 'x.last_name', 'm.gender', 'm.birth_date')} AS hash_diff,
       '{CAP}' AS source_table
FROM (SELECT DISTINCT first_name, last_name, id_number, {_ADDR} FROM cap) x
JOIN stg_member m ON x.first_name = m.first_name AND x.last_name = m.last_name
                 AND x.id_number = m.id_number"""))
def q_load_member_address(spark, d):
    return _load(M.MEMBER_ADDRESS, spark, d)


def _beneficiary_sql(cross: bool) -> str:
    fields = [f"beneficiary_{f}" for f in M.BENEFICIARY_FIELDS]
    slots = range(1, M.BENEFICIARY_SLOTS + 1)
    if cross:
        groups = [f"g_{f} AS (SELECT DISTINCT member_id, v AS {f} FROM (SELECT member_id, "
                  f"unnest([{', '.join(f'{f}_{i}' for i in slots)}]) AS v FROM base) u)" for f in fields]
        joins = " ".join(f"JOIN g_{f} USING (member_id)" for f in fields[1:])
        tail = ", ".join(groups) + f", rows_ AS (SELECT * FROM g_{fields[0]} {joins})"
    else:
        parts = " UNION ".join(
            f"SELECT member_id, {', '.join(f'{f}_{i} AS {f}' for f in fields)} FROM base "
            f"WHERE coalesce({', '.join(f'{f}_{i}' for f in fields)}) IS NOT NULL" for i in slots)
        tail = f"rows_ AS ({parts})"
    return with_staging(f""",
base AS (
  SELECT m.id_number AS member_id, {", ".join("x." + c for c in M.beneficiary_slot_columns())}
  FROM cap x JOIN stg_member m ON x.first_name = m.first_name AND x.last_name = m.last_name
                              AND x.id_number = m.id_number),
{tail}
SELECT member_id, beneficiary_full_name, beneficiary_id_number, beneficiary_relation,
       {INT('beneficiary_percentage')} AS beneficiary_percentage, beneficiary_cell,
       {H('member_id')} AS hash_key, {H('member_id', *fields)} AS hash_diff,
       '{LST}' AS source_table
FROM rows_""")


@register("load_member_beneficiary", _beneficiary_sql(cross=False))
def q_load_member_beneficiary(spark, d):
    return _load(M.MEMBER_BENEFICIARY_DISTINCT, spark, d)


@register("policy_unmatched", with_staging(f"""
, m AS (SELECT DISTINCT first_name, last_name, id_number FROM stg_member WHERE gender = 'F'),
hit AS (SELECT x.policy_number, x.id_number, m.id_number IS NOT NULL AS found FROM cap x
  LEFT JOIN m ON upper(x.last_name) = m.last_name AND upper(x.first_name) = m.first_name AND x.id_number = m.id_number)
SELECT policy_number, id_number, '{M.STG_MEMBER}' AS missing FROM hit WHERE NOT found
UNION ALL
SELECT x.policy_number, x.id_number, '{M.STG_PRODUCT}' FROM cap x JOIN hit USING (policy_number)
JOIN (SELECT DISTINCT broker_code, broker_name, broker_id FROM stg_broker) b ON x.broker_code = b.broker_code AND upper(x.broker) = b.broker_name
JOIN (SELECT DISTINCT client_name, client_id FROM stg_client) c ON upper(x.client) = c.client_name
JOIN (SELECT DISTINCT broker_id, client_id, broker_client_id FROM stg_bc) bc ON b.broker_id = bc.broker_id AND c.client_id = bc.client_id
WHERE hit.found AND NOT EXISTS (SELECT 1 FROM stg_product p WHERE bc.broker_client_id = p.broker_client_id
  AND x.policy_description = p.policy_description AND {INT('x.cover')} = p.cover AND x.member_type = p.relate_to)"""))
def q_policy_unmatched(spark, d):
    """Landing policies that find no member (only women are in the dimension here) or no product."""
    inputs = written(spark, d, [n for n in M.POLICY.needs() if n != M.STG_PRODUCT]) | {M.STG_PRODUCT: product_rows(spark, d)}
    inputs[M.STG_MEMBER] = inputs[M.STG_MEMBER].where("gender = 'F'")
    return unmatched(M.POLICY, inputs, narrow=True).select("policy_number", "id_number", "missing")


@register("policy_lookup_counts", f"""WITH lost AS ({ORACLES["policy_unmatched"]}), loaded AS ({ORACLES["fact_policy"]} WHERE m.gender = 'F')
SELECT 'lost_' || missing AS metric, count(*) AS n FROM lost GROUP BY missing UNION ALL SELECT 'matched', count(*) FROM loaded""")
def q_policy_lookup_counts(spark, d):
    """What the policy load's own run counted: rows that each lookup lost, and rows that passed all."""
    inputs = written(spark, d, M.POLICY.needs())
    inputs[M.STG_MEMBER] = inputs[M.STG_MEMBER].where("gender = 'F'")
    counts = Observation(f"policy-{uuid.uuid4().hex}")
    run_load(M.POLICY, inputs, stamp=None, counts=counts, narrow=True).write.option("compression", "zstd").parquet(scratch_path(spark, "counted"))
    return spark.createDataFrame([(k, n) for k, n in counts.get.items() if n], "metric string, n bigint")


_TWO_FEEDS = f"""
m2 AS (SELECT last_name, first_name, id_number, min(member_id) AS member_id FROM (
    SELECT member_id, first_name, last_name, id_number FROM stg_member
    UNION ALL SELECT {SID('id_number', 'first_name', 'last_name')}, first_name, last_name, id_number FROM lst) GROUP BY ALL),
b2 AS (SELECT broker_code, broker_name, min(broker_id) AS broker_id FROM (
    SELECT broker_id, broker_code, broker_name FROM stg_broker
    UNION ALL SELECT {SID('broker_code', 'broker', 'branch_name')}, broker_code, broker FROM cap) GROUP BY ALL),
c2 AS (SELECT client_name, min(client_id) AS client_id FROM (
    SELECT client_id, client_name FROM stg_client UNION ALL SELECT {SID('client')}, client FROM cap) GROUP BY ALL),
bc2 AS (SELECT broker_id, client_id, {SID('broker_id', 'client_id')} AS broker_client_id FROM (
    SELECT DISTINCT broker_id, client_id FROM (SELECT DISTINCT upper(broker_code) AS bcode, upper(broker_name) AS bname, upper(client) AS cl FROM ext) x
    JOIN b2 ON bcode = b2.broker_code AND bname = b2.broker_name JOIN c2 ON cl = c2.client_name)),
p2 AS (SELECT bc2.broker_client_id, x.policy_description, {INT('x.cover')} AS cover, x.relate_to,
    min({SID('x.policy_code', 'x.policy_description', 'bc2.broker_client_id', 'x.relate_to', 'x.age_from', 'x.age_to')}) AS product_id
  FROM (SELECT DISTINCT * FROM ext) x JOIN b2 ON x.broker_code = b2.broker_code AND x.broker_name = b2.broker_name
  JOIN c2 ON x.client = c2.client_name JOIN bc2 ON b2.broker_id = bc2.broker_id AND c2.client_id = bc2.client_id GROUP BY ALL)"""
_TWO_HASH = H("x.policy_number", "m.member_id", "p.product_id", "x.capture_date", "x.inception", "x.status")


@register("fact_policy_two_feeds", with_staging(f""", lst AS ({member_list_sql()}), {_TWO_FEEDS}
SELECT x.policy_number, m.member_id, p.product_id,
       {DATE('x.capture_date', '%m/%d/%Y')} AS capture_date, {DATE('x.inception', '%m/%d/%Y')} AS inception_date, x.status,
       {_TWO_HASH} AS hash_key, {_TWO_HASH} AS hash_diff, '{CAP}' AS source_table
FROM cap x
JOIN m2 m ON upper(x.last_name) = m.last_name AND upper(x.first_name) = m.first_name AND x.id_number = m.id_number
JOIN b2 b ON x.broker_code = b.broker_code AND upper(x.broker) = b.broker_name
JOIN c2 c ON upper(x.client) = c.client_name
JOIN bc2 bc ON b.broker_id = bc.broker_id AND c.client_id = bc.client_id
JOIN p2 p ON bc.broker_client_id = p.broker_client_id AND x.policy_description = p.policy_description
         AND {INT('x.cover')} = p.cover AND x.member_type = p.relate_to"""))
def q_fact_policy_two_feeds(spark, d):
    """The policy fact over staging tables that two feeds have filled, one dimension row per key."""
    return run_load(unique_lookups(M.POLICY), two_feeds(spark, d), stamp=None, narrow=True)


# ====================================================================== unpivot
_SLOTS_SQL = ("SELECT l_orderkey, l_returnflag AS flag_1, l_linestatus AS flag_2, "
              "CAST(l_linenumber % 3 AS VARCHAR) AS band_1, "
              "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey % 5 AS VARCHAR) END AS band_2 FROM lineitem")


def _slots(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("flag_1"), F.col("l_linestatus").alias("flag_2"),
        (F.col("l_linenumber") % 3).cast("string").alias("band_1"),
        F.when(F.col("l_linenumber") % 2 == 0, (F.col("l_suppkey") % 5).cast("string")).alias("band_2"))


_GROUPS = {"flag": ["flag_1", "flag_2"], "band": ["band_1", "band_2"]}


@register("unpivot_distinct",
          "SELECT DISTINCT l_orderkey, v AS flag FROM "
          "(SELECT l_orderkey, unnest([l_returnflag, l_linestatus]) AS v FROM lineitem) u")
def q_unpivot_distinct(spark, d):
    return explode_values(table(spark, d, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"],
                          "flag")


@register("unpivot_cross", f"""WITH w AS ({_SLOTS_SQL}),
f AS (SELECT DISTINCT l_orderkey, v AS flag FROM (SELECT l_orderkey, unnest([flag_1, flag_2]) AS v FROM w) u),
b AS (SELECT DISTINCT l_orderkey, v AS band FROM (SELECT l_orderkey, unnest([band_1, band_2]) AS v FROM w) u)
SELECT l_orderkey, flag, band FROM f JOIN b USING (l_orderkey)""")
def q_unpivot_cross(spark, d):
    return unpivot_cross(_slots(spark, d), "l_orderkey", _GROUPS)


@register("unpivot_factored", f"""WITH w AS ({_SLOTS_SQL}),
f AS (SELECT DISTINCT l_orderkey, v FROM (SELECT l_orderkey, unnest([flag_1, flag_2]) AS v FROM w) u),
b AS (SELECT DISTINCT l_orderkey, v FROM (SELECT l_orderkey, unnest([band_1, band_2]) AS v FROM w) u),
fs AS (SELECT l_orderkey, string_agg(coalesce(v, '-'), ',' ORDER BY coalesce(v, '-')) AS flags, count(*) AS n FROM f GROUP BY 1),
bs AS (SELECT l_orderkey, string_agg(coalesce(v, '-'), ',' ORDER BY coalesce(v, '-')) AS bands, count(*) AS n FROM b GROUP BY 1)
SELECT l_orderkey, flags, bands, CAST(fs.n * bs.n AS DOUBLE) AS n_rows FROM fs JOIN bs USING (l_orderkey)""")
def q_unpivot_factored(spark, d):
    """The value sets of every key, and how many combinations they stand for."""
    sets = unpivot_factored(_slots(spark, d), "l_orderkey", _GROUPS)
    shown = [F.array_join(F.array_sort(F.transform(g, lambda x: F.coalesce(x, F.lit("-")))), ",").alias(f"{g}s") for g in _GROUPS]
    return sets.select("l_orderkey", *shown, combinations(list(_GROUPS)).alias("n_rows"))


@register("unpivot_cross_load", _beneficiary_sql(cross=True))
def q_unpivot_cross_load(spark, d):
    """The beneficiary load in the legacy layout: all combinations of a member's slot values."""
    return _load(M.MEMBER_BENEFICIARY_CROSS, spark, d)


@register("unpivot_positional", f"""WITH w AS ({_SLOTS_SQL})
SELECT DISTINCT l_orderkey, flag, band FROM (
  SELECT l_orderkey, flag_1 AS flag, band_1 AS band FROM w
  UNION ALL SELECT l_orderkey, flag_2, band_2 FROM w) u
WHERE flag IS NOT NULL OR band IS NOT NULL""")
def q_unpivot_positional(spark, d):
    return unpivot_positional(_slots(spark, d), "l_orderkey", _GROUPS)


# ================================================================ nesting / maps
_LINES_SQL = ("(SELECT conv_id, turn, role, string_split(text, chr(10)) AS arr FROM conversations) s, "
              "LATERAL (SELECT unnest(generate_series(1, len(s.arr))) AS i) t")


@register("explode_struct_fields", f"""
SELECT conv_id, turn, hex(CAST(i - 1 AS VARCHAR)) AS relational_1, hex(arr[i]) AS relational_2,
       'this_is_my_source' AS source_id, '01/01/2024 01:05:07' AS "timestamp"
FROM {_LINES_SQL}""")
def q_explode_struct_fields(spark, d):
    conv = table(spark, d, "conversations")
    arr = F.transform(F.split("text", "\n"),
                      lambda x, i: F.struct(i.alias("test_column1"), x.alias("test_column2")))
    nested = conv.select("conv_id", "turn", arr.alias("column_with_array"))
    return explode_encode(nested, "column_with_array", ["test_column1", "test_column2"],
                          keep=["conv_id", "turn"], at=PINNED)


def _conv_nested(spark, d):
    conv = table(spark, d, "conversations")
    return conv.select("conv_id", F.struct("turn", "role").alias("msg"), F.expr("nullif(turn, 1)").alias("part"),
                       F.split("text", "\n").alias("lines"))


_ROOT_ID = "sha1(" + " || ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("conv_id", "nullif(turn, 1)")) + ")"


@register("relationalize_root",
          f"SELECT conv_id, turn AS msg_turn, role AS msg_role, nullif(turn, 1) AS part, "
          f"CASE WHEN text IS NOT NULL THEN {_ROOT_ID} END AS lines FROM conversations")
def q_relationalize_root(spark, d):
    return relationalize(_conv_nested(spark, d), "root", key=["conv_id", "part"])["root"]


@register("relationalize_child",
          f"SELECT {_ROOT_ID} AS id, CAST(i - 1 AS INTEGER) AS \"index\", arr[i] AS lines_val "
          f"FROM {_LINES_SQL}")
def q_relationalize_child(spark, d):
    return relationalize(_conv_nested(spark, d), "root", key=["conv_id", "part"])["root_lines"]


_WORDS_SQL = ("(SELECT conv_id, turn, role, string_split(text, ' ') AS arr FROM conversations) s, "
              "LATERAL (SELECT unnest(generate_series(1, len(s.arr))) AS i) t")


@register("relationalize_children",
          f"SELECT conv_id, turn, role, 'lines' AS child, CAST(i - 1 AS INTEGER) AS \"index\", arr[i] AS val FROM {_LINES_SQL} "
          f"UNION ALL SELECT conv_id, turn, role, 'words', CAST(i - 1 AS INTEGER), arr[i] FROM {_WORDS_SQL}")
def q_relationalize_children(spark, d):
    """Two arrays of one frame without a key: both children joined back to their root rows by the id."""
    conv = table(spark, d, "conversations")
    nested = conv.select("conv_id", "turn", "role", F.split("text", "\n").alias("lines"), F.split("text", " ").alias("words"))
    frames = relationalize(nested, "root")
    root = frames["root"].select("conv_id", "turn", "role", F.coalesce("lines", "words").alias("id"))
    children = [frames[f"root_{c}"].select("id", F.lit(c).alias("child"), "index", F.col(f"`{c}.val`").alias("val")) for c in ("lines", "words")]
    return root.join(children[0].union(children[1]), "id").drop("id")


@register("relationalize_encoded",
          f"SELECT hex(role) AS TESTKEY, 'this_is_my_source' AS SRC_FOR_ID, '{PINNED}' AS DTS "
          f"FROM conversations")
def q_relationalize_encoded(spark, d):
    return relationalize_encode(_conv_nested(spark, d), "msg.role", key=["conv_id", "part"], at=PINNED)


_PROVIDER_SQL = """SELECT c_mktsegment AS "drg definition",
  CASE WHEN c_custkey % 11 = 0 THEN 'P' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END
    AS "provider id",
  c_name AS "provider name", 'CITY ' || CAST(c_nationkey AS VARCHAR) AS "provider city",
  'ST' || CAST(c_nationkey % 5 AS VARCHAR) AS "provider state", c_custkey * 10 + 1 AS "provider zip code",
  'REGION ' || CAST(c_nationkey % 3 AS VARCHAR) AS "hospital referral region description",
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '$' || CAST(c_acctbal AS VARCHAR) END
    AS "average covered charges",
  CASE WHEN c_custkey % 19 = 0 THEN '$' ELSE '$' || CAST(c_nationkey AS VARCHAR) || '.5' END
    AS "average total payments",
  '$' || CAST(c_custkey % 1000 AS VARCHAR) AS "average medicare payments"
FROM customer"""


def _provider(spark, d):
    return table(spark, d, "customer").selectExpr(
        "c_mktsegment AS `drg definition`",
        "CASE WHEN c_custkey % 11 = 0 THEN 'P' || CAST(c_custkey AS STRING) "
        "ELSE CAST(c_custkey AS STRING) END AS `provider id`",
        "c_name AS `provider name`", "'CITY ' || CAST(c_nationkey AS STRING) AS `provider city`",
        "'ST' || CAST(c_nationkey % 5 AS STRING) AS `provider state`",
        "c_custkey * 10 + 1 AS `provider zip code`",
        "'REGION ' || CAST(c_nationkey % 3 AS STRING) AS `hospital referral region description`",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '$' || CAST(c_acctbal AS STRING) END "
        "AS `average covered charges`",
        "CASE WHEN c_custkey % 19 = 0 THEN '$' ELSE '$' || CAST(c_nationkey AS STRING) || '.5' END "
        "AS `average total payments`",
        "'$' || CAST(c_custkey % 1000 AS STRING) AS `average medicare payments`")




@register("apply_mapping_nested", f"""WITH p AS ({_PROVIDER_SQL})
SELECT "drg definition" AS drg, TRY_CAST("provider id" AS BIGINT) AS provider_id,
  "provider name" AS provider_name, "provider city" AS provider_city,
  "provider state" AS provider_state, CAST("provider zip code" AS BIGINT) AS provider_zip,
  "hospital referral region description" AS rr
FROM p""")
def q_apply_mapping_nested(spark, d):
    from landstage.plans.cleaning import PROVIDER_CHARGES_MAPPING
    mapping = [m for m in PROVIDER_CHARGES_MAPPING if not m[2].startswith("charges.")]
    return flatten(apply_mapping(_provider(spark, d), mapping))


@register("clean_and_nest", f"""WITH p AS ({_PROVIDER_SQL})
SELECT "drg definition" AS drg, TRY_CAST("provider id" AS BIGINT) AS provider_id,
  "provider name" AS provider_name, "provider city" AS provider_city,
  "provider state" AS provider_state, CAST("provider zip code" AS BIGINT) AS provider_zip,
  "hospital referral region description" AS rr,
  TRY_CAST(substr("average covered charges", 2) AS DOUBLE) AS charges_covered,
  TRY_CAST(substr("average total payments", 2) AS DOUBLE) AS charges_total_pay,
  TRY_CAST(substr("average medicare payments", 2) AS DOUBLE) AS charges_medicare_pay
FROM p WHERE TRY_CAST("provider id" AS BIGINT) IS NOT NULL""")
def q_clean_and_nest(spark, d):
    return flatten(clean_and_nest(_provider(spark, d)))


@register("chop_prefix",
          "SELECT c_custkey, TRY_CAST(substr('$' || CAST(c_acctbal AS VARCHAR), 2) AS DOUBLE) AS balance "
          "FROM customer")
def q_chop_prefix(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey",
                    to_double(chop_prefix(F.concat(F.lit("$"), F.col("c_acctbal").cast("string"))))
                    .alias("balance"))


_CHOP3_SQL = f"""WITH p AS ({_PROVIDER_SQL})
SELECT "provider name" AS provider_name, substr("average covered charges", 2) AS acc, substr("average total payments", 2) AS atp, substr("average medicare payments", 2) AS amp FROM p"""


def _chop_three(spark, d, chop):
    return _provider(spark, d).select(F.col("provider name").alias("provider_name"), chop(F.col("average covered charges")).alias("acc"),
                                      chop(F.col("average total payments")).alias("atp"), chop(F.col("average medicare payments")).alias("amp"))


def first_dropped(values):
    """All values of an Arrow array without their first character."""
    import pyarrow.compute as pc
    return pc.utf8_slice_codeunits(values, 1)


@register("scalar_function_values", _CHOP3_SQL)
def q_scalar_function_values(spark, d):
    """A Python function of one value over three columns at once; null stays null."""
    return _chop_three(spark, d, scalar_function(lambda x: x[1:], "string"))


@register("scalar_function_arrays", _CHOP3_SQL)
def q_scalar_function_arrays(spark, d):
    """The same as a function of whole Arrow arrays."""
    return _chop_three(spark, d, scalar_function(first_dropped, "string", vectorized=True))


@register("resolve_choice_cast",
          "SELECT event_id, uid FROM (SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN event_type "
          "ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS uid FROM events) t WHERE uid IS NOT NULL")
def q_resolve_choice_cast(spark, d):
    ev = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.col("event_type"))
        .otherwise(F.col("user_id").cast("string")).alias("uid"))
    return resolve_choice(ev, [("uid", "cast:long")]).where(F.col("uid").isNotNull())


_RECORDS_SQL = ("SELECT event_id AS this_id, CAST(json_extract_string(props, '$.k') AS INTEGER) + 10 "
                "AS channel, event_type AS my_band FROM events")


def _records(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("this_id"),
        to_int(F.get_json_object("props", "$.k")).alias("channel"),
        F.col("event_type").alias("my_band"))


@register("map_records_expr", _RECORDS_SQL)
def q_map_records_expr(spark, d):
    return map_columns(_records(spark, d), {"channel": "channel + 10"})


_BIG = 9_007_199_254_740_992       # 2**53: longs above it have no exact double


def band_record(rec: dict) -> dict:
    """A wide channel number and a label from two fields; both null where the channel is."""
    channel = rec["channel"]
    wide = None if channel is None else channel + _BIG + 1
    return {"this_id": rec["this_id"], "wide": wide, "label": None if channel is None else f"{rec['my_band']}/{channel % 7}"}


def band_batch(batch):
    """The same for a whole Arrow batch."""
    import pyarrow as pa
    import pyarrow.compute as pc
    channel = batch.column("channel").cast(pa.int64())
    seven = pc.subtract(channel, pc.multiply(pc.divide(channel, 7), 7))
    label = pc.binary_join_element_wise(batch.column("my_band"), seven.cast(pa.string()), "/")
    return pa.table({"this_id": batch.column("this_id"), "wide": pc.add(channel, _BIG + 1), "label": label})


def _sparse_records(spark, d):
    return _records(spark, d).withColumn("channel", F.expr("CASE WHEN this_id % 5 <> 0 THEN abs(channel) END"))


_BAND_SQL = ("SELECT event_id AS this_id, c + 9007199254740993 AS wide, event_type || '/' || (c % 7) AS label FROM ("
             "SELECT event_id, event_type, CASE WHEN event_id % 5 <> 0 THEN abs(CAST(json_extract_string(props, '$.k') AS INTEGER)) END AS c FROM events) t")
_BAND_SCHEMA = "this_id bigint, wide bigint, label string"


@register("map_records_pandas", _BAND_SQL)
def q_map_records(spark, d):
    return map_records(_sparse_records(spark, d), band_record, _BAND_SCHEMA)


@register("map_records_batch", _BAND_SQL)
def q_map_records_batch(spark, d):
    return map_records(_sparse_records(spark, d), band_batch, _BAND_SCHEMA, vectorized=True)


@register("project_to_json",
          "SELECT doc_id AS id, CAST(to_json(struct_pack(id := doc_id, created := n_chars, url := source, "
          "selftext := text, author := CAST(lang AS VARCHAR))) AS VARCHAR) AS document FROM documents")
def q_project_to_json(spark, d):
    from landstage.sinks import json_documents
    docs = table(spark, d, "documents")
    rec = json_documents(docs, [("id", F.col("doc_id")), ("created", F.col("n_chars")),
                                ("url", F.col("source")), ("selftext", F.col("text")),
                                ("author", F.col("lang"))], as_text=["author"])
    return rec.select("id", F.to_json(F.struct(*rec.columns)).alias("document"))


_JSON_FIELDS = ("id", "created", "url", "selftext", "upvote_ratio", "author", "author_premium", "over_18", "treatment_tags")
_JSON_SQL = ("SELECT doc_id AS id, CASE WHEN doc_id % 7 <> 0 THEN n_chars END AS created, source AS url, text AS selftext, "
             "(doc_id % 100) / 100.0::DOUBLE AS upvote_ratio, lang AS author, doc_id % 3 = 0 AS author_premium, "
             "CASE WHEN doc_id % 4 <> 0 THEN doc_id % 2 = 0 END AS over_18, CASE WHEN doc_id % 5 = 0 THEN 'tag' END AS treatment_tags, 9 AS n_keys FROM documents")


@register("sink_json_documents", _JSON_SQL)
def q_sink_json_documents(spark, d):
    """Nine-field documents written as JSON lines and read back; ``n_keys`` counts the keys of each written line."""
    from landstage.sinks import json_documents, write_json
    i = F.col("doc_id")
    rec = json_documents(table(spark, d, "documents"), list(zip(_JSON_FIELDS, (
        i, F.when(i % 7 != 0, F.col("n_chars")), F.col("source"), F.col("text"), (i % 100) / F.lit(100.0), F.col("lang"),
        i % 3 == 0, F.when(i % 4 != 0, i % 2 == 0), F.when(i % 5 == 0, F.lit("tag"))), strict=True)), as_text=["author"])
    path = scratch_path(spark, "json")
    write_json(rec, path)
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", rec.schema).alias("r"), F.size(F.json_object_keys("value")).alias("n_keys")).select("r.*", "n_keys")


# ======================================================================== sinks
@register("sink_append_table", "SELECT c_custkey, c_mktsegment, 'first' AS load_run, 2 AS n_runs FROM customer "
          "UNION ALL SELECT c_custkey, c_mktsegment, 'second', 2 FROM customer")
def q_sink_append_table(spark, d):
    """Two runs appended to one table; the first is executed twice and still there once."""
    name = f"landstage_append_{uuid.uuid4().hex[:12]}"
    src = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    path = scratch_path(spark, "append")
    for run, rows in (("first", src.where("c_custkey % 3 = 0")), ("second", src), ("first", src)):
        record_run(spark, name, run, "running", path=f"{path}-runs")
        write_run(rows, name, run, path=path)
        record_run(spark, name, run, "done")
    out = scratch_path(spark, "appended")
    spark.table(name).join(runs(spark, name).where("state = 'done'").select("load_run"), "load_run").crossJoin(
        F.broadcast(runs(spark, name).agg(F.count(F.lit(1)).cast("int").alias("n_runs")))).write.parquet(out)
    _drop(spark, name, ledger_name(name))
    return spark.read.parquet(out)


def _drop(spark, *names: str) -> None:
    for name in names:                       # the catalog keeps nothing of a query's run
        spark.sql(f"DROP TABLE IF EXISTS {name}")


SLICE_ROWS = 50_000_000                 # landing rows that the policy job moves at a time


@register("fact_policy_runs", ORACLES["fact_policy"])
def q_fact_policy_runs(spark, d):
    """The policy fact as jobs over bucketed staging tables of the catalog; two of the jobs are executed twice."""
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inputs = written(spark, d, (M.CAPTURED, M.PRODUCT_EXTRACT))
    for name in (M.CAPTURED, M.PRODUCT_EXTRACT):
        inputs[name].createOrReplaceTempView(f"{prefix}{name}")
    jobs = (("member", "member_id"), ("broker_from_extract", "broker_id"), ("client_from_extract", "client_id"),
            ("broker_client", "broker_client_id"), ("product", "product_id"), ("member", "member_id"), ("policy", None), ("policy", None))
    out = scratch_path(spark, "fact-runs")
    for load, sid in jobs:
        own = {"product": {"mostly_distinct": True}, "policy": {"slice_rows": SLICE_ROWS, "path": out}}.get(load, {})
        run_job(spark, load, prefix=prefix, surrogate=sid, stamp=None, run_id=f"{load} 1", buckets=n,
                send=(M.STG_BROKER, M.STG_CLIENT, M.STG_BROKER_CLIENT), few=BROADCAST_ROWS, **own)
    fact = finished_files(spark, f"{prefix}{M.STG_POLICY}", out)
    for target in (M.STG_MEMBER, M.STG_BROKER, M.STG_CLIENT, M.STG_BROKER_CLIENT, M.STG_PRODUCT, M.STG_POLICY):
        _drop(spark, f"{prefix}{target}", ledger_name(f"{prefix}{target}"))
    for name in (M.CAPTURED, M.PRODUCT_EXTRACT):
        spark.catalog.dropTempView(f"{prefix}{name}")
    return fact


@register("sink_parquet_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def q_sink_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return spark.read.parquet(path)


# The test tables' columns by kind: i whole numbers, s texts, f fractions, t times, v vectors.
_COLUMNS = {
    "region": "r_regionkey:i r_name:s", "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s", "supplier": "s_suppkey:i s_name:s s_nationkey:i s_acctbal:f",
    "part": "p_partkey:i p_name:s p_brand:s p_type:s p_size:i p_retailprice:f",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:f l_extendedprice:f l_discount:f l_tax:f l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:i ts:t user_id:i event_type:s value:f props:s", "documents": "doc_id:i text:s lang:s source:s n_chars:i",
    "embeddings": "vec_id:i embedding:v label:i", "pages": "page_id:i url:s html:s", "benchmark": "item_id:i text:s",
    "labels": "doc_id:i quality:i toxic:i", "conversations": "conv_id:i turn:i role:s text:s",
}
_SPARK_TEXT = {"i": "cast({c} as string)", "s": "{c}", "f": "cast(cast(floor({c} * 1000) as bigint) as string)", "t": "date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
               "v": "array_join(transform({c}, x -> cast(cast(floor(cast(x as double) * 1000) as bigint) as string)), ',')"}
_DUCK_TEXT = {"i": "CAST({c} AS VARCHAR)", "s": "{c}", "f": "CAST(CAST(floor({c} * 1000) AS BIGINT) AS VARCHAR)", "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
              "v": "array_to_string(list_transform({c}, lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)), ',')"}


def _row_text(name: str, kinds: dict[str, str]) -> str:
    """All values of a row of a test table as one text."""
    return "concat_ws('|', " + ", ".join(f"coalesce({kinds[k].format(c=c)}, '-')" for c, _, k in (x.partition(":") for x in _COLUMNS[name].split())) + ")"


_COPY_SQL = " UNION ALL ".join(f"SELECT '{t}.parquet' AS source_path, md5({_row_text(t, _DUCK_TEXT)}) AS row_md5 FROM {t}" for t in TABLES)


@register("copy_parquet_tree", _COPY_SQL)
def q_copy_parquet_tree(spark, d):
    """Every row of every table, read from the copied tree; the copied files are those of the copy's manifest."""
    dst = scratch_path(spark, "copy")
    copied = copy_parquet_tree(spark, d, dst)
    names = F.regexp_extract("relative", "^([^/]+)", 1)
    files = copied.where("copied = length").select(names.alias("source_path")).distinct()
    rows = [spark.read.parquet(f"{dst}/{t}.parquet").select(F.lit(f"{t}.parquet").alias("source_path"), F.expr(f"md5({_row_text(t, _SPARK_TEXT)})").alias("row_md5")) for t in TABLES]
    return reduce(DataFrame.union, rows).join(files, "source_path", "left_semi")


@register("incremental_dim_agent", ORACLES["dim_agent"])
def q_incremental_dim_agent(spark, d):
    """The agent load run as a bookmarked stream over the written landing folder."""
    from landstage.plans.staging import landing_files
    from landstage.streaming import run_incremental
    root = scratch_path(spark, "incremental")
    landing_path = landing_files(spark, d, M.CAPTURED, M.AGENT.dedupe)
    run_incremental(spark, M.AGENT, landing_path, f"{root}/out", f"{root}/checkpoint", stamp=None)
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def queries() -> dict[str, QueryFn]:
    def wrap(fn):
        return lambda spark, d: comparable(fn(spark, d))
    return {k: wrap(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
