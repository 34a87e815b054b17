"""Operator 1: mixing sources to target weights by a hypergeometric splitting tree.

A block is one document, drawn whole.  Every source has an exact word target,
and its blocks a random order per pass (by hash): pass 1 takes a prefix, and
pass 2 repeats a fresh prefix when the target exceeds the source.  A prefix
stops before the block that would pass the target.  Then blocks larger than
the words still missing are dropped, the longest fitting prefix of the others
is taken, and so on; it stops when no block left fits what is missing, so a
source misses its target by less than its smallest block left out.  Every
round takes a block and drops the one that stopped the round before.

The numbers of blocks so drawn are then split over the output shards.  A
binary tree halves the shards; at each node the left half's share of every
source is a multivariate hypergeometric draw, so that quotas stay exact and
every shard is a random sample of the whole mix.  A shard takes the next
quota of each source's permuted blocks; shards are disjoint, and a local
shuffle is a sort by hash inside the shard.

Ranks come from hash buckets: counts and word sums per (source, bucket) give
each bucket its offset, a window numbers the rows inside.  Buckets grow in
number with the table, so a source with a third of all rows is many tasks.
The driver holds one row per source, and refuses more than ``MAX_SOURCES``.

Defined results: null text has size 0; a null source is a source of its own,
last in order; rows alike in id, text and source are one block and drawn
together, other rows that repeat an id are separate blocks; an empty table
gives an empty mix; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from tempora.session import cut_lineage

WORDS = r"[^\x20\x09-\x0D]+"
MAX_SOURCES = 100_000
BUCKET_ROWS = 20_000
# rows of a shard that are sorted in one task
SHARD_ROWS = 2_000


def targets(sizes: dict, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Word targets of the sources, given in order: shares by weight, stopped at ``most`` times the size."""
    total = share * sum(sizes.values())
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    full: dict = {}
    while True:
        left = [s for s in sizes if s not in full]
        rest = total - sum(full.values())
        whole = sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / whole > most * sizes[s]]
        if not over:
            return full | {s: rest * weight[s] / whole for s in left}
        full |= {s: most * sizes[s] for s in over}


def split_tree(quotas: list[int], shards: int, seed: int = 0) -> np.ndarray:
    """Quotas of each source (columns) per shard (rows): exact totals, equal shards."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        total = int(have.sum())
        want = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left, rest, need = np.zeros_like(have), total, want
        for i, n in enumerate(have.tolist()):  # one source after another: the joint draw
            rest -= n
            if need and n:
                # numpy's sampler takes arguments below 10**9; larger ones by their normal limit
                if max(n, rest, need) < 10 ** 9:
                    x = int(rng.hypergeometric(n, rest, need))
                else:
                    p = n / (n + rest)
                    var = need * p * (1 - p) * (n + rest - need) / max(1, n + rest - 1)
                    x = round(rng.normal(need * p, math.sqrt(var)))
                x = min(max(x, need - rest, 0), n, need)
                left[i], need = x, need - x
        split(lo, mid, left)
        split(mid, hi, have - left)

    split(0, shards, np.array(quotas, np.int64))
    return out


def _ranked(df: DataFrame, n_rows: int) -> DataFrame:
    """Add ``pos`` and ``before``: rank and words before, per source and pass in the random order of ``key``."""
    buckets = max(1, math.ceil(n_rows / BUCKET_ROWS))
    df = df.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    sums = df.groupBy("sid", "copy", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    over = W.partitionBy("sid", "copy").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("sid", "copy", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n0"),
                       F.coalesce(F.sum("words").over(over), F.lit(0)).alias("w0"))
    inner = W.partitionBy("sid", "copy", "bucket").orderBy("key", "uid", "size")
    return df.select("*", (F.row_number().over(inner) - 1).alias("i"),
                     (F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("w")) \
        .join(sums, ["sid", "copy", "bucket"]) \
        .select("uid", "sid", "copy", "size", "key", (F.col("n0") + F.col("i")).alias("pos"),
                (F.col("w0") + F.col("w")).alias("before"))


def _chosen(blocks: DataFrame, room: dict, n_rows: int) -> DataFrame:
    """The blocks drawn: ``room`` holds the words that each (sid, copy) may take."""
    spark, pool, picks = blocks.sparkSession, blocks, None
    while room:
        # a row per source and pass, 2 * MAX_SOURCES at most
        now = F.broadcast(spark.createDataFrame([(*k, float(v)) for k, v in room.items()],
                                                "sid int, copy int, room double"))
        # the first round takes the whole order, later ones the blocks that fit by themselves
        fits = pool if picks is None else pool.join(now, ["sid", "copy"]).where("size <= room").drop("room")
        ranked = cut_lineage(_ranked(fits, n_rows).join(now, ["sid", "copy"])
                             .withColumn("head", F.expr("before + size <= room")))
        head = ranked.where("head").select("uid", "sid", "copy", "size", "key")
        picks = head if picks is None else picks.union(head)
        pool = ranked.where("not head and size > 0").select("uid", "sid", "copy", "size", "key")
        state = ranked.groupBy("sid", "copy").agg(
            F.max(F.expr("if(head, before + size, 0)")).alias("took"),
            F.min(F.expr("if(not head and size > 0, size, null)")).alias("least"),
            F.count_if(F.expr("not head and size > 0")).alias("n")).collect()
        left = {(r["sid"], r["copy"]): room[r["sid"], r["copy"]] - r["took"] for r in state}
        open_ = [r for r in state if r["least"] is not None and r["least"] <= left[r["sid"], r["copy"]]]
        room = {(r["sid"], r["copy"]): left[r["sid"], r["copy"]] for r in open_}
        n_rows = sum(r["n"] for r in open_)
    return picks


def _uid(id_col: str, text_col: str, source_col: str):
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    return F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.crc32(F.coalesce(text, F.lit(""))),
                      source, source.isNull())


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         shards: int = 16, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7):
    """(sized, sources, draws).

    ``sized``: uid, doc_id, sid, size per input row; ``sources``: sid, source_size, target;
    ``draws``: uid, sid, copy (1 or 2), shard and the key of the local shuffle per block drawn.
    """
    spark = docs.sparkSession
    sized = cut_lineage(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        _uid(id_col, text_col, source_col).alias("uid")))
    own = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")) \
        .limit(MAX_SOURCES + 1).collect()
    if len(own) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    own.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = {r["source"]: r["size"] for r in own}
    goal = targets(sizes, weights, share, most) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    rows = [(i, s, sizes[s], float(goal[s])) for i, s in enumerate(sizes)]
    sources = spark.createDataFrame(rows, "sid int, source string, source_size long, target double")
    # broadcasts below hold a row per source, MAX_SOURCES at most
    sized = sized.join(F.broadcast(sources.select("sid", F.col("source").alias("_s"))),
                       F.col("source").eqNullSafe(F.col("_s"))).select("uid", "doc_id", "sid", "size")
    blocks = cut_lineage(sized.groupBy("uid", "sid").agg(F.sum("size").alias("size")))
    n_rows = sum(r["n"] for r in own)
    passes = blocks.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")) \
        .withColumn("key", F.xxhash64("uid", F.lit(seed) + F.col("copy")))
    # words a pass may take: what the passes before it leave of the target
    room = {(i, copy): max(0.0, target - (copy - 1) * size) for i, _, size, target in rows for copy in (1, 2)}
    if not room:
        return sized, sources, passes.select("uid", "sid", "size", "copy", F.lit(0).alias("shard"),
                                             F.col("key").alias("shuffle"))
    # blocks of later rounds stand among the others again, so that no shard gets them all
    drawn = cut_lineage(_ranked(_chosen(passes, room, n_rows), n_rows))
    # a source's blocks in order: pass 1, then pass 2
    counts = {r["sid"]: (r["a"], r["n"]) for r in drawn.groupBy("sid").agg(
        F.count_if(F.col("copy") == 1).alias("a"), F.count("*").alias("n")).collect()}
    tree = split_tree([counts.get(i, (0, 0))[1] for i in range(len(rows))], shards, seed)
    ends = spark.createDataFrame(
        [(i, counts.get(i, (0, 0))[0], np.cumsum(tree[:, i]).tolist()) for i in range(len(rows))],
        "sid int, pass1 long, ends array<long>")
    draws = drawn.join(F.broadcast(ends), "sid") \
        .withColumn("at", F.col("pos") + F.when(F.col("copy") == 2, F.col("pass1")).otherwise(0)) \
        .select("uid", "sid", "size", "copy", F.expr("size(filter(ends, e -> e <= at))").alias("shard"),
                F.xxhash64("uid", "copy", F.lit(seed)).alias("shuffle"))
    return sized, sources, draws


def taken(docs: DataFrame, **how) -> DataFrame:
    """Per input row: doc_id, size, source_size, target, copies and the shards drawn into."""
    sized, sources, draws = plan(docs, **how)
    per = draws.groupBy("uid", "sid").agg(F.count("*").alias("copies"),
                                          F.sort_array(F.collect_list("shard")).alias("shards"))
    return sized.join(per, ["uid", "sid"], "left").join(F.broadcast(sources), "sid").select(
        "doc_id", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"), "shards")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        shard_col: str | None = None, **how) -> DataFrame:
    """The mixed rows themselves, as often as drawn, with the input's columns.

    Rows are dealt out by (shard, hash) and sorted by the shuffle key inside each shard.  ``shard_col``
    names an added last column with the shard; it replaces an input column of that name.
    """
    _, _, draws = plan(docs, id_col, text_col, source_col, **how)
    salts = max(1, math.ceil(draws.count() / how.get("shards", 16) / SHARD_ROWS))
    # at most one draw per pass
    per = draws.groupBy("uid").agg(F.collect_list(F.struct("shard", "shuffle")).alias("d"))
    dealt = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        _uid(id_col, text_col, source_col).alias("uid")).join(per, "uid") \
        .select("row", F.explode("d").alias("d")) \
        .repartition("d.shard", F.pmod("d.shuffle", F.lit(salts))).sortWithinPartitions("d.shard", "d.shuffle")
    if shard_col is None:
        return dealt.select("row.*")
    return dealt.select(*(f"row.`{c}`" for c in docs.columns if c != shard_col), F.col("d.shard").alias(shard_col))
