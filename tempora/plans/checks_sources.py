"""Checks for sources and sinks (A).  File round trips (CSV, documents,
DDL, table swaps) are tested in ``tests/test_sources.py``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.plans import standins as S
from tempora.plans.checks_relational import READINGS, _with
from tempora.plans.registry import check
from tempora.sources import html as HT
from tempora.sources import io as A

RECORD = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DoubleType()),
])
JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@check("a1_parse_records", """SELECT event_id, ts, user_id, value FROM events
  WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""")
def _a1(spark, d):
    ev = S.table(spark, d, "events")
    payload = ev.select(F.to_json(F.struct(F.array(F.struct("event_id", "ts", "user_id", "value"))
                                           .alias("records")), JSON_TS).alias("payload"))
    return A.parse_records(payload, "payload", RECORD, "ts", "2024-01-05 00:00:00", "2024-01-20 00:00:00")


@check("a3_register_view", """SELECT o_orderpriority, count(*) AS n_orders, round(avg(o_totalprice), 6) AS mean_price
  FROM orders GROUP BY 1""")
def _a3(spark, d):
    A.register_view(spark, "orders_view", f"{d}/orders.parquet")
    return spark.sql("""SELECT o_orderpriority, count(*) AS n_orders, round(avg(o_totalprice), 6) AS mean_price
                        FROM orders_view GROUP BY 1""")


_NATION_PAGE = """'<html><body><p>intro</p><table class="wikitable sortable"><tr><th>Key</th><th>Name</th></tr>'
  || '<tr><td>' || CAST(n_nationkey AS VARCHAR) || '</td><td><a href="#">' || n_name || '</a></td></tr></table>'
  || '<table class="wikitable"><tr><td>other</td></tr></table></body></html>'"""


# simple tables, as these pages have, read by patterns
_ROW, _CELL, _TAG = r"(?is)<tr[^>]*>(.*?)</tr>", r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", r"<[^>]+>"
_WIKITABLE = r'(?is)<table[^>]*class="[^"]*wikitable[^"]*"[^>]*>(.*?)</table>'


@check("a5_html_tables", f"""WITH p AS (SELECT page_id, html FROM pages
  UNION ALL SELECT 100000 + n_nationkey, {_NATION_PAGE} FROM nation),
  t AS (SELECT page_id, regexp_extract(html, '{_WIKITABLE}', 1) AS tbl FROM p),
  r AS (SELECT page_id, regexp_extract_all(tbl, '{_ROW}', 1) AS rows FROM t),
  u AS (SELECT page_id, unnest(rows) AS row_html, unnest(range(len(rows))) AS row_no FROM r)
  SELECT page_id, row_no, list_transform(regexp_extract_all(row_html, '{_CELL}', 1),
    lambda c: trim(regexp_replace(c, '{_TAG}', '', 'g'))) AS cells FROM u""")
def _a5(spark, d):
    pages = S.table(spark, d, "pages").select("page_id", "html")
    n = S.table(spark, d, "nation")
    made = n.select((F.lit(100000) + F.col("n_nationkey")).cast("long").alias("page_id"), F.concat(
        F.lit('<html><body><p>intro</p><table class="wikitable sortable"><tr><th>Key</th><th>Name</th></tr>'),
        F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit('</td><td><a href="#">'), F.col("n_name"),
        F.lit("</a></td></tr></table>"),
        F.lit('<table class="wikitable"><tr><td>other</td></tr></table></body></html>')).alias("html"))
    return HT.extract_html_tables(pages.unionByName(made), "html", "wikitable", ["page_id"])


@check("a6_with_id", """SELECT sha256(CAST(l_orderkey AS VARCHAR) || chr(1) || CAST(l_linenumber AS VARCHAR)) AS id,
  l_orderkey, l_linenumber FROM lineitem""")
def _a6(spark, d):
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return A.with_id(li, ["l_orderkey", "l_linenumber"])


def _split(spark, d):
    r = S.readings(spark, d)
    target = r.filter(F.col("hourutc") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = r.filter(F.col("hourutc") >= F.lit("2024-01-15").cast("timestamp_ntz")) \
        .withColumn("value", F.col("value") * 2.0)
    return target, new


@check("a7_upsert_frame", _with(READINGS) + """SELECT id, hourutc, municipalityno, branche, value * 2.0 AS value
  FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15'
  UNION ALL SELECT * FROM readings WHERE hourutc < TIMESTAMP '2024-01-20'
    AND id NOT IN (SELECT id FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15')""")
def _a7(spark, d):
    target, new = _split(spark, d)
    return A.upsert_frame(target, new, ["id"], order="hourutc")


@check("a7_upsert_buckets", _with(READINGS) + """SELECT id, hourutc, municipalityno, branche, value * 2.0 AS value
  FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15'
  UNION ALL SELECT * FROM readings WHERE hourutc < TIMESTAMP '2024-01-20'
    AND id NOT IN (SELECT id FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15')""")
def _a7_buckets(spark, d):
    target, new = _split(spark, d)
    view = f"keyed_{uuid.uuid4().hex}"
    A.create_keyed_table(spark, view, _scratch(spark, "keyed"), target.schema, ["id"], buckets=8)
    for frame in (target, new):
        A.upsert_buckets(spark, view, frame, order="hourutc")
    return spark.table(view)


@check("a8_insert_if_absent_frame", _with(READINGS) + """SELECT id, hourutc, municipalityno, branche, value * 2.0 AS value
  FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15'
    AND id NOT IN (SELECT id FROM readings WHERE hourutc < TIMESTAMP '2024-01-20')""")
def _a8(spark, d):
    target, new = _split(spark, d)
    return A.insert_if_absent_frame(target, new, ["id"])


@check("a9_append_counts", _with(READINGS) + """SELECT count(*) AS n_rows FROM (
  SELECT id FROM readings WHERE hourutc < TIMESTAMP '2024-01-20'
  UNION ALL SELECT id FROM readings WHERE hourutc >= TIMESTAMP '2024-01-15')""")
def _a9(spark, d):
    target, new = _split(spark, d)
    return target.unionByName(new).agg(F.count(F.lit(1)).alias("n_rows"))


def _scratch(spark, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder."""
    from tempora.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/landed/{name}-{uuid.uuid4().hex}"


@check("a2_read_csv", "SELECT * FROM orders")
def _a2(spark, d):
    orders = S.table(spark, d, "orders")
    path = _scratch(spark, "orders_csv")
    fmt = "yyyy-MM-dd HH:mm:ss"
    A.write_csv(orders, path, timestamp_format=fmt)
    return A.read_csv(spark, path, orders.schema, timestamp_format=fmt)


@check("a4_read_documents", """SELECT c_name AS Municipality, r_name AS Region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _a4(spark, d):
    m = S.municipalities(spark, d)
    docs = m.select(F.concat(F.lit("doc-"), F.col("code").cast("string")).alias("_id"),
                    F.col("name").alias("Municipality"), F.col("region").alias("Region"),
                    "latitude", "longitude")
    path = _scratch(spark, "municipalities_json")
    docs.write.mode("overwrite").json(path)
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("Municipality", T.StringType()),
                           T.StructField("Region", T.StringType()), T.StructField("latitude", T.DoubleType()),
                           T.StructField("longitude", T.DoubleType())])
    return A.read_documents(spark, path, schema, include=["Municipality", "Region"])


@check("b2_index_to_column", "SELECT day, round(price, 6) AS price, row_number() OVER (ORDER BY day) - 1 AS idx FROM (" +
       "SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS price FROM orders GROUP BY 1)")
def _b2i(spark, d):
    from tempora.functions import columns as B
    from tempora.plans.registry import rounded
    return rounded(B.index_to_column(S.gas_daily(spark, d), "idx", ["day"]))


@check("a10_create_table", """SELECT sha256(CAST(n_nationkey AS VARCHAR)) AS id, n_nationkey, n_name, n_regionkey
  FROM nation""")
def _a10(spark, d):
    rows = A.with_id(S.table(spark, d, "nation"), ["n_nationkey"])
    name = f"nation_{uuid.uuid4().hex}"
    A.create_table(spark, rows.drop("id").schema, "tempora_checks", name)
    A.append(rows, f"tempora_checks.{name}")
    return spark.table(f"tempora_checks.{name}")


@check("a11_replace_table", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def _a11(spark, d):
    rows = S.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    table = f"customer_{uuid.uuid4().hex}"
    A.replace_table(spark, rows, table)
    A.replace_table(spark, spark.table(table).where("c_acctbal > 0"), table)
    return spark.table(table)
