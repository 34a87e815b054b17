"""Reading landed files and tables; appending, upserting, creating tables (A1-A11).

Everything reads through ``spark.read`` with an explicit schema (no
inference) and writes through ``DataFrameWriter``.  Writes that replace a
table never overwrite the table being read: the new version is written to
a fresh folder and then pointed to, so a failed job leaves the old table
intact.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.scalar import random_key, row_key
from tempora.session import cut_lineage


# --- A1 ---------------------------------------------------------------------
def payload_schema(record: T.StructType, field: str = "records") -> T.StructType:
    return T.StructType([T.StructField(field, T.ArrayType(record), True)])


def _time_range(df: DataFrame, ts: str | None, start, end) -> DataFrame:
    if ts is None:
        return df
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end).cast(df.schema[ts].dataType))
    return df


def read_records(spark: SparkSession, path: str, record: T.StructType, ts: str | None = None,
                 start=None, end=None, field: str = "records") -> DataFrame:
    """Landed API responses ``{"records": [...]}`` (one JSON document per
    file) as one row per record, restricted to ``start <= ts < end``."""
    raw = spark.read.schema(payload_schema(record, field)).option("multiLine", True).json(path)
    rows = raw.select(F.explode(field).alias("_r")).select("_r.*")
    return _time_range(rows, ts, start, end)


def parse_records(df: DataFrame, col: str, record: T.StructType, ts: str | None = None,
                  start=None, end=None, field: str = "records") -> DataFrame:
    """Same as :func:`read_records` for payloads held in a string column."""
    parsed = df.select(F.from_json(col, payload_schema(record, field)).alias("_p"))
    rows = parsed.select(F.explode(f"_p.{field}").alias("_r")).select("_r.*")
    return _time_range(rows, ts, start, end)


# --- A2 ---------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             timestamp_format: str | None = None, sort: Sequence[str] | None = None) -> DataFrame:
    """CSV with a declared schema; the time column is parsed by the reader.
    ``sort`` orders the result (a final-output ordering, one range shuffle)."""
    r = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    df = r.csv(path)
    return df.orderBy(*sort) if sort else df


def write_csv(df: DataFrame, path: str, timestamp_format: str | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if timestamp_format:
        w = w.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    w.csv(path)


# --- A3 ---------------------------------------------------------------------
def register_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                  **options) -> DataFrame:
    """Load a stored table and expose it to ``spark.sql`` as a temp view."""
    df = spark.read.format(fmt).options(**options).load(path)
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*cols) if cols else df


# --- A4 ---------------------------------------------------------------------
def read_documents(spark: SparkSession, path: str, schema: T.StructType,
                   include: Sequence[str] | None = None,
                   exclude: Sequence[str] = ("_id",)) -> DataFrame:
    """A document collection landed as JSON lines, with field projection
    (``include``) or exclusion; projected fields are pruned at the scan."""
    df = spark.read.schema(schema).json(path)
    if include:
        return df.select(*include)
    return df.drop(*[c for c in exclude if c in df.columns])


# --- A6 / A9 ----------------------------------------------------------------
def with_id(df: DataFrame, key_cols: Sequence[str] | None = None, id_col: str = "id") -> DataFrame:
    """Add the primary key: a hash of the natural key (re-runs give the same
    id) or, without key columns, a random UUID as in the reference."""
    new = row_key(*key_cols) if key_cols else random_key()
    return df.withColumn(id_col, new).select(id_col, *[c for c in df.columns if c != id_col])


def append(df: DataFrame, table: str) -> None:
    """Plain bulk insert (no duplicate check)."""
    df.write.mode("append").saveAsTable(table)


def append_with_id(df: DataFrame, table: str, key_cols: Sequence[str] | None = None) -> None:
    append(with_id(df, key_cols), table)


# --- A7 / A8 ----------------------------------------------------------------
def latest_per_key(df: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the one with the largest ``order`` (any row when
    None).  A grouped ``max_by`` combines map-side, so a key with many
    updates does not land on one task."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    s = F.struct(*[F.col(c) for c in rest])
    pick = F.max_by(s, F.col(order)) if order else F.first(s)
    return df.groupBy(*key).agg(pick.alias("_row")).select(*key, "_row.*")


def upsert_frame(target: DataFrame, updates: DataFrame, key: Sequence[str],
                 order: str | None = None) -> DataFrame:
    """Merged frame: the latest update per key wins; target rows whose key
    has no update are kept."""
    key = list(key)
    u = latest_per_key(updates, key, order).select(*target.columns)
    kept = target.join(u.select(*key), key, "left_anti")
    return u.unionByName(kept)


def insert_if_absent_frame(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` (one per key) whose key is not in ``target``."""
    key = list(key)
    return latest_per_key(new, key).select(*new.columns).join(target.select(*key).distinct(), key, "left_anti")


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _restore(spark: SparkSession, table: str) -> None:
    """Undo a swap that ended between its renames: the old version gets its name back."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__prev"):
        spark.sql(f"ALTER TABLE {table}__prev RENAME TO {table}")


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def _swap_in(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Write ``df`` as ``table``, whose old rows are read until the new ones are whole.

    An existing table of the same columns gets a new folder, and one catalogue call points the table to it:
    the name is never missing.  The old folder is removed last.  With other columns, which that call cannot
    change, the new version is written as ``table__next`` and takes the name; the old one is renamed aside
    before and dropped last, and if that ends between the renames, the next call gives it its name back.
    """
    _restore(spark, table)
    if spark.catalog.tableExists(table) and _same_columns(spark.table(table).schema, df.schema):
        old = _location(spark, table)
        new = f"{old.split('__v')[0].rstrip('/')}__v{uuid.uuid4().hex}"
        df.write.parquet(new)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.catalog.refreshTable(table)
        path = spark._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        return
    nxt, prev = f"{table}__next", f"{table}__prev"
    spark.sql(f"DROP TABLE IF EXISTS {nxt}")
    df.write.format("parquet").mode("overwrite").saveAsTable(nxt)
    spark.sql(f"DROP TABLE IF EXISTS {prev}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {prev}")
    spark.sql(f"ALTER TABLE {nxt} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {prev}")


# --- A7 in buckets ------------------------------------------------------------
BUCKETS = 64


def _bucket(key: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _folders(spark: SparkSession, view: str) -> tuple[dict[str, str], dict[int, str]]:
    """Properties of a keyed table, and the current folder of each of its buckets."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    rows = spark.read.parquet(props["tempora.manifest"]).collect()
    return props, {r["bucket"]: r["folder"] for r in rows if r["folder"]}


def _point_to(spark: SparkSession, view: str, base: str, key: Sequence[str], buckets: int, schema: T.StructType,
              folders: dict[int, str]) -> None:
    """Make ``folders`` the current version: a manifest for writers and, in one catalogue call, the view for readers."""
    manifest = f"{base}/manifests/{uuid.uuid4().hex}"
    spark.createDataFrame([(b, folders.get(b)) for b in range(buckets)], "bucket int, folder string") \
        .coalesce(1).write.parquet(manifest)
    cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    if folders:
        # one relation over the folders of all buckets
        parts = sorted(f.removeprefix(f"{base}/") for f in folders.values())
        source = f"parquet.`{base}/{{{','.join(parts)}}}`"
    else:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        source = f"(SELECT {nulls}) WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('tempora.manifest' = '{manifest}', "
              f"'tempora.base' = '{base}', 'tempora.key' = '{','.join(key)}', 'tempora.buckets' = '{buckets}') "
              f"AS SELECT {cols} FROM {source}")


def create_keyed_table(spark: SparkSession, view: str, base: str, schema: T.StructType, key: Sequence[str],
                       buckets: int = BUCKETS) -> None:
    """An empty table for :func:`upsert_buckets`, read under the name ``view``; its files lie under ``base``."""
    _point_to(spark, view, base.rstrip("/"), list(key), buckets, schema, {})


def upsert_buckets(spark: SparkSession, view: str, updates: DataFrame, order: str | None = None,
                   files_per_bucket: int = 1) -> list[int]:
    """Upsert into a keyed table, reading and writing only the buckets that have updates; returns these.

    Rows lie in buckets by the hash of their key.  The buckets with updates are merged (last write wins, see
    :func:`upsert_frame`) into new folders; the others keep their files.  Then the view, which names the
    current folder of every bucket, is replaced in one call: readers see the version before or the one after,
    and a run that ends early leaves the one before.  Folders of older versions stay, for readers still on
    them, and may be removed when none is.  One writer at a time.
    """
    props, folders = _folders(spark, view)
    base, key, buckets = props["tempora.base"], props["tempora.key"].split(","), int(props["tempora.buckets"])
    schema = spark.table(view).schema
    updates = cut_lineage(latest_per_key(updates, key, order).select(*schema.names)
                          .withColumn("bucket", _bucket(key, buckets)))
    touched = sorted(r[0] for r in updates.select("bucket").distinct().collect())
    if not touched:
        return []
    new = updates.drop("bucket")
    have = [folders[b] for b in touched if b in folders]
    merged = upsert_frame(spark.read.schema(schema).parquet(*have), new, key) if have else new
    version = uuid.uuid4().hex
    (merged.withColumn("bucket", _bucket(key, buckets))
     .repartition(len(touched) * files_per_bucket, "bucket", F.pmod(F.hash(*key), F.lit(files_per_bucket)))
     .write.partitionBy("bucket").parquet(f"{base}/{version}"))
    _point_to(spark, view, base, key, buckets, schema,
              {**folders, **{b: f"{base}/{version}/bucket={b}" for b in touched}})
    return touched


def upsert(spark: SparkSession, table: str, updates: DataFrame, key: Sequence[str],
           order: str | None = None) -> None:
    """Upsert by key into a managed table (last write wins); running it
    twice with the same updates leaves the same table.  The whole table is
    written; for few updates to a large table see :func:`upsert_buckets`."""
    _restore(spark, table)
    if not spark.catalog.tableExists(table):
        _swap_in(spark, latest_per_key(updates, key, order).select(*updates.columns), table)
        return
    merged = upsert_frame(spark.table(table), updates, key, order)
    _swap_in(spark, merged, table)


def insert_if_absent(spark: SparkSession, table: str, new: DataFrame, key: Sequence[str]) -> int:
    """Append the rows whose key is new; returns how many were added.
    The frame to add is checkpointed first, so it is computed once against
    the table as it was before the append."""
    _restore(spark, table)
    if not spark.catalog.tableExists(table):
        rows = cut_lineage(latest_per_key(new, key).select(*new.columns))
        rows.write.saveAsTable(table)
        return rows.count()
    rows = cut_lineage(insert_if_absent_frame(spark.table(table), new, key))
    n = rows.count()
    if n:
        append(rows, table)
    return n


# --- A10 / A11 --------------------------------------------------------------
# The reference's dtype -> column type map; anything unknown
# becomes a string column.
TYPE_MAP = {
    "bigint": "BIGINT", "int": "INT", "double": "DOUBLE", "float": "FLOAT",
    "string": "STRING", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP_NTZ", "date": "DATE",
}


def create_table_ddl(schema: T.StructType, db: str, name: str, key: str = "id",
                     type_map: Mapping[str, str] = TYPE_MAP, fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` from a schema: the key column first,
    not repeated when the schema already has it; unknown types as STRING."""
    cols = [f"`{key}` STRING"] if key not in schema.names else []
    ordered = sorted(schema.fields, key=lambda f: f.name != key)
    for f in ordered:
        cols.append(f"`{f.name}` {type_map.get(f.dataType.simpleString(), 'STRING')}")
    return f"CREATE TABLE IF NOT EXISTS {db}.{name} ({', '.join(cols)}) USING {fmt}"


def create_table(spark: SparkSession, schema: T.StructType, db: str, name: str, key: str = "id") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(create_table_ddl(schema, db, name, key))


def replace_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Drop and recreate with the frame's rows (via a swap, never
    overwriting the table the frame may be reading)."""
    _swap_in(spark, df, table)
