"""File and table round trips for the sources and sinks (A)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.sources import io as A

SF = "/root/testdata/sf0.001"


def scratch():
    return tempfile.mkdtemp(prefix="tempora-test-")


def test_read_records_files(spark):
    d = scratch()
    recs = [{"HourUTC": f"2022-01-01T{h:02d}:00:00", "Price": float(h)} for h in range(5)]
    recs.append({"HourUTC": "2023-01-01T00:00:00", "Price": 99.0})
    with open(os.path.join(d, "page1.json"), "w") as f:
        json.dump({"total": 6, "records": recs[:3]}, f, indent=2)
    with open(os.path.join(d, "page2.json"), "w") as f:
        json.dump({"total": 6, "records": recs[3:]}, f, indent=2)
    schema = T.StructType([T.StructField("HourUTC", T.TimestampNTZType()), T.StructField("Price", T.DoubleType())])
    out = A.read_records(spark, d, schema, "HourUTC", "2022-01-01", "2023-01-01")
    assert sorted(r.Price for r in out.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_csv_round_trip(spark):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    path = os.path.join(scratch(), "nation_csv")
    A.write_csv(nation, path)
    back = A.read_csv(spark, path, nation.schema, sort=["n_nationkey"])
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in nation.orderBy("n_nationkey").collect()]


def test_csv_timestamps(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    path = os.path.join(scratch(), "ev_csv")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    A.write_csv(ev, path, timestamp_format=fmt)
    back = A.read_csv(spark, path, ev.schema, timestamp_format=fmt)
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_documents_projection(spark):
    d = scratch()
    with open(os.path.join(d, "docs.json"), "w") as f:
        for i in range(4):
            f.write(json.dumps({"_id": f"x{i}", "Region": "Capital", "Municipality": f"M{i}"}) + "\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_id", "Region", "Municipality")])
    assert A.read_documents(spark, d, schema).columns == ["Region", "Municipality"]
    assert A.read_documents(spark, d, schema, include=["Municipality"]).count() == 4


def test_register_view(spark):
    A.register_view(spark, "region_v", f"{SF}/region.parquet")
    assert spark.sql("SELECT count(*) AS n FROM region_v").first().n == 5


def test_ddl():
    schema = T.StructType([T.StructField("hourutc", T.TimestampType()), T.StructField("n", T.LongType()),
                           T.StructField("m", T.MapType(T.StringType(), T.StringType()))])
    ddl = A.create_table_ddl(schema, "energy", "production")
    assert ddl == ("CREATE TABLE IF NOT EXISTS energy.production (`id` STRING, `hourutc` TIMESTAMP, "
                   "`n` BIGINT, `m` STRING) USING parquet")
    with_id = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("id", T.StringType())])
    assert A.create_table_ddl(with_id, "e", "t").startswith("CREATE TABLE IF NOT EXISTS e.t (`id` STRING, `x` DOUBLE)")


def test_upsert_twice_is_once(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    base = lines.filter(F.col("l_orderkey") % 2 == 0)
    upd = lines.filter(F.col("l_orderkey") % 3 == 0).withColumn("l_quantity", F.col("l_quantity") + 100)
    A.replace_table(spark, base, "t_upsert")
    A.upsert(spark, "t_upsert", upd, ["l_orderkey", "l_linenumber"])
    once = spark.table("t_upsert").orderBy("l_orderkey", "l_linenumber").collect()
    A.upsert(spark, "t_upsert", upd, ["l_orderkey", "l_linenumber"])
    twice = spark.table("t_upsert").orderBy("l_orderkey", "l_linenumber").collect()
    assert once == twice
    expected = A.upsert_frame(base, upd, ["l_orderkey", "l_linenumber"]).orderBy("l_orderkey", "l_linenumber").collect()
    assert once == expected


def test_insert_if_absent_twice(spark):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    A.replace_table(spark, nation.filter("n_nationkey < 10"), "t_insert")
    assert A.insert_if_absent(spark, "t_insert", nation, ["n_nationkey"]) == 15
    assert A.insert_if_absent(spark, "t_insert", nation, ["n_nationkey"]) == 0
    assert spark.table("t_insert").count() == 25


def test_append_with_id_is_deterministic(spark):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    a = A.with_id(nation, ["n_nationkey"]).select("id").collect()
    b = A.with_id(nation, ["n_nationkey"]).select("id").collect()
    assert a == b and len({r.id for r in a}) == 25
    A.replace_table(spark, A.with_id(nation.limit(0), ["n_nationkey"]), "t_append")
    A.append_with_id(nation, "t_append", ["n_nationkey"])
    A.append(A.with_id(nation, ["n_nationkey"]), "t_append")
    assert spark.table("t_append").count() == 50


class Crash(RuntimeError):
    pass


def _crash_at(monkeypatch, spark, word):
    """The next SQL statement with ``word`` fails before it does anything."""
    real = type(spark).sql

    def sql(self, text, *a, **b):
        if word in text:
            raise Crash(text)
        return real(self, text, *a, **b)
    monkeypatch.setattr(type(spark), "sql", sql)


def test_replace_keeps_the_old_rows_until_the_new_are_whole(spark, monkeypatch):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    A.replace_table(spark, nation.where("n_nationkey < 5"), "t_swap")
    with monkeypatch.context() as m:
        _crash_at(m, spark, "SET LOCATION")
        with pytest.raises(Crash):
            A.replace_table(spark, nation, "t_swap")
    assert spark.table("t_swap").count() == 5
    old = A._location(spark, "t_swap")
    for n in (25, 3):
        A.replace_table(spark, nation.where(f"n_nationkey < {n}"), "t_swap")
        assert spark.table("t_swap").count() == n
    assert A._location(spark, "t_swap") != old and not os.path.exists(old.removeprefix("file:"))
    # a table that reads itself, and appending afterwards
    A.replace_table(spark, spark.table("t_swap").where("n_nationkey > 0"), "t_swap")
    A.append(nation.where("n_nationkey = 7"), "t_swap")
    assert sorted(r.n_nationkey for r in spark.table("t_swap").collect()) == [1, 2, 7]


@pytest.mark.parametrize("word", ["t_cols__next RENAME", "DROP TABLE IF EXISTS t_cols__prev"])
def test_replace_with_other_columns_loses_nothing(spark, monkeypatch, word):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    A.replace_table(spark, nation.select("n_nationkey"), "t_cols")
    with monkeypatch.context() as m:
        _crash_at(m, spark, word)
        with pytest.raises(Crash):
            A.replace_table(spark, nation.select("n_nationkey", "n_name"), "t_cols")
    # the next call finds the old rows again
    A.upsert(spark, "t_cols", nation.select("n_nationkey").where("n_nationkey < 2"), ["n_nationkey"])
    assert spark.table("t_cols").count() == 25
    A.replace_table(spark, nation, "t_cols")
    assert spark.table("t_cols").columns == nation.columns
    A.replace_table(spark, nation.select("n_nationkey"), "t_cols")


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_upsert_in_buckets_touches_only_what_changes(spark, monkeypatch):
    base = os.path.join(scratch(), "keyed")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    key = ["l_orderkey", "l_linenumber"]
    lines = lines.groupBy(*key).agg(F.max("l_quantity").alias("l_quantity"), F.max("l_shipdate").alias("l_shipdate"))
    A.create_keyed_table(spark, "t_keyed", base, lines.schema, key, buckets=16)
    assert spark.table("t_keyed").count() == 0 and spark.table("t_keyed").schema.simpleString() == lines.schema.simpleString()
    assert A.upsert_buckets(spark, "t_keyed", lines.where("l_orderkey % 2 = 0"), files_per_bucket=2) == list(range(16))
    before = _files(base)
    few = lines.where("l_orderkey in (2, 3)").withColumn("l_quantity", F.col("l_quantity") + 1000)
    want = A.upsert_frame(lines.where("l_orderkey % 2 = 0"), few, key).orderBy(*key).collect()
    with monkeypatch.context() as m:
        _crash_at(m, spark, "CREATE OR REPLACE VIEW")
        with pytest.raises(Crash):
            A.upsert_buckets(spark, "t_keyed", few)
    assert spark.table("t_keyed").where("l_quantity > 1000").count() == 0
    touched = A.upsert_buckets(spark, "t_keyed", few)
    assert 0 < len(touched) < 16
    assert spark.table("t_keyed").orderBy(*key).collect() == want
    after = _files(base)
    assert all(after[f] == t for f, t in before.items())
    current = set(spark.table("t_keyed").inputFiles())
    bucket = lambda f: int(f.split("bucket=")[1].split("/")[0])
    rows = [f for f in before if "bucket=" in f]
    # buckets without updates are read from the same files as before, the others are not
    for f in rows:
        assert any(c.endswith(f.replace("=", "%3D")) or c.endswith(f) for c in current) == (bucket(f) not in touched)
    A.upsert_buckets(spark, "t_keyed", few)
    assert spark.table("t_keyed").orderBy(*key).collect() == want
    # the last update of a key wins; none at all changes nothing
    twice = few.withColumn("at", F.lit(1)).union(few.withColumn("l_quantity", F.lit(7.0)).withColumn("at", F.lit(2)))
    A.upsert_buckets(spark, "t_keyed", twice, order="at")
    assert {r.l_quantity for r in spark.table("t_keyed").where("l_orderkey in (2, 3)").collect()} == {7.0}
    assert A.upsert_buckets(spark, "t_keyed", few.limit(0)) == []


TABLES = {
    "nested": ("<table class='x'><tr><td>no</td></tr></table><TABLE CLASS='wide wikitable'><tr><th>A<th>B"
               "<tr><td>1<td>in <table class=wikitable><tr><td>p</td><td>q</td></tr></table> out<tr><td>2<td>3</table>"
               "<table class=wikitable><tr><td>second</td></tr></table>",
               [["A", "B"], ["1", "in p q out"], ["2", "3"]]),
    "spans": ("<table class=wikitable><tr><td rowspan=2>a</td><td colspan=2>b</td></tr><tr><td>c</td><td rowspan='3'>d</td></tr>"
              "<tr><td>e</td><td>f</td></tr><tr><td>g</td></tr><tr><td>h</td></tr></table>",
              [["a", "b", "b"], ["a", "c", "d"], ["e", "f", "d"], ["g", "", "d"], ["h"]]),
    "to the end": ("<table class=wikitable><tr><td rowspan=0>a<td>b<tr><td>c<tr><td rowspan=x colspan=0>d</table>",
                   [["a", "b"], ["a", "c"], ["a", "d"]]),
    "sections": ("<table class=wikitable><thead><tr><th>H</thead><tbody><tr><td>x &amp; y<br>z<script>no</script>"
                 "<tr><td> two   words\n</tbody><tfoot><td>loose</tfoot></table>",
                 [["H"], ["x & y z"], ["two words"], ["loose"]]),
    "open": ("<table class=wikitable><tr><td>a<td>b", [["a", "b"]]),
    "none": ("<table class=wikitables><tr><td>a</td></tr></table>", []),
    "empty": ("", []), "null": (None, []),
}


def test_tables_as_a_browser_reads_them(spark):
    from tempora.sources import html
    pages = spark.createDataFrame([(k, v[0], "x") for k, v in TABLES.items()], "id string, page string, cells string")
    got = {k: [] for k in TABLES}
    for r in html.extract_html_tables(pages, "page", "wikitable", ["id"]).orderBy("id", "row_no").collect():
        assert r.row_no == len(got[r.id])
        got[r.id].append(r.cells)
    assert got == {k: v[1] for k, v in TABLES.items()}


def test_many_tags_take_linear_time():
    import time
    from tempora.sources import html
    page = "<table class=wikitable>" + "<tr><td rowspan=3>x<td><table><tr><td>y</table>" * 20_000
    t = time.time()
    assert len(html.table_rows(page, "wikitable")) == 20_000
    assert time.time() - t < 10
