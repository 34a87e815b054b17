"""Operator 2: sharding by histogram sort, in DataFrame functions only.

Rows are ordered by a key of two hashes: of the text, so that equal texts
are neighbours, then of the id, so that a group of copies can be cut where
it is larger than a shard.  Shard boundaries are sought as in a histogram
sort: each round counts the exact bytes below evenly spaced probe keys in
the key ranges that still hold a boundary, over all partitions, and only the
counts per probe reach the driver.  A boundary is settled when a probe is
within ``tolerance`` of its byte target; else its range shrinks to the
probes around it, down to single keys.  A text's copies stay together where
that moves a boundary by at most ``copy_tolerance``.  With the splitters known, a row's
shard follows from its own key and rows are exchanged once.

Slots number the rows of a shard without gaps: a count per (shard, hash
bucket of the id) gives each bucket its offset, a window numbers the rows
inside, so no task holds a whole shard.

Defined results: null text has no bytes, crc 0 and the key of an empty text;
null ids and repeated rows are placed like others; an empty table gives an
empty result; other columns pass through in ``row``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tempora.session import cut_lineage

ROW_BYTES = 16
PROBE_BITS = 10
BUCKET_ROWS = 20_000
_MIN = -(1 << 63)


def _keys(text: Column, row_id: Column) -> dict[str, Column]:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(row_id.cast("string"), F.lit(1)),
            "size": (F.octet_length(text) + ROW_BYTES).cast("long")}


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.001,
              copy_tolerance: float = 0.01) -> list[tuple[int, int]]:
    """Lower key bounds (k1, k2) of shards 1 .. shards-1, in unsigned key order.

    ``keys`` has k1, k2 and size.  Each round aggregates to at most
    ``shards * 2**PROBE_BITS`` counts, whatever the number of rows.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    goals = [total * s / shards for s in range(1, shards)]
    done: dict[int, tuple[int, int]] = {}
    # open ranges: leading digits of the 128-bit key, and the bytes below them
    opened = {s: ((), 0) for s in range(len(goals))}
    while opened and total:
        prefixes = {p for p, _ in opened.values()}
        depth = len(next(iter(prefixes)))
        digit = _digit(depth)
        near = keys if depth == 0 else keys.where(
            F.concat_ws(",", *(_digit(d).cast("string") for d in range(depth)))
            .isin([",".join(map(str, p)) for p in prefixes]))
        counts: dict[tuple, dict[int, int]] = {}
        for r in near.groupBy(*(_digit(d).alias(f"d{d}") for d in range(depth)), digit.alias("probe")) \
                .agg(F.sum("size").alias("bytes")).collect():
            counts.setdefault(tuple(r[f"d{d}"] for d in range(depth)), {})[r["probe"]] = r["bytes"]
        left = {}
        for s, (prefix, below) in opened.items():
            at, hist = below, counts.get(prefix, {})
            for probe in sorted(hist):
                if at + hist[probe] >= goals[s]:
                    break
                at += hist[probe]
            low, high = at, at + hist[probe]
            best = (low, probe) if goals[s] - low <= high - goals[s] else (high, probe + 1)
            # the last digit of the first key: beyond it, a text's copies are cut
            slack = copy_tolerance if depth + 1 == _PER else tolerance
            if abs(best[0] - goals[s]) <= slack * total / shards or depth + 1 == DIGITS:
                done[s] = _bound(prefix, best[1])
            else:
                left[s] = (prefix + (probe,), low)
        opened = left
    return [done[s] for s in range(len(goals))] if total else []


# digits per 64-bit key: the last one is shorter
_PER = math.ceil(64 / PROBE_BITS)
DIGITS = 2 * _PER


def _width(d: int) -> tuple[int, int]:
    """(shift, bits) of digit d inside its 64-bit key."""
    top = 64 - PROBE_BITS * (d % _PER)
    bits = min(PROBE_BITS, top)
    return top - bits, bits


def _digit(d: int) -> Column:
    shift, bits = _width(d)
    key = F.col("k1" if d < _PER else "k2").bitwiseXOR(F.lit(_MIN))  # signed to unsigned order
    return F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _bound(prefix: tuple, probe: int) -> tuple[int, int]:
    """The smallest 128-bit unsigned key at or above this probe, as two unsigned halves."""
    value = 0
    for d in range(DIGITS):
        shift, _ = _width(d)
        digit = prefix[d] if d < len(prefix) else probe if d == len(prefix) else 0
        value += digit << (shift + (64 if d < _PER else 0))
    return min(value >> 64, (1 << 64)), value & ((1 << 64) - 1)


def shard_of(bounds: list[tuple[int, int]]) -> Column:
    """Number of bounds at or below the row's key."""
    out = F.lit(0)
    for a, b in bounds:
        if a >= 1 << 64:  # above every key
            continue
        a, b = F.lit(a + _MIN), F.lit(b + _MIN)  # back to signed order
        out = out + ((F.col("k1") > a) | ((F.col("k1") == a) & (F.col("k2") >= b))).cast("int")
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40,
          tolerance: float = 0.001) -> DataFrame:
    """``row`` (the input row), size, shard and slot; shards hold nearly equal bytes."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         *(e.alias(n) for n, e in _keys(F.col(f"`{text_col}`"), F.col(f"`{id_col}`")).items()))
    keys = cut_lineage(packed.select("k1", "k2", "size"))
    buckets = max(1, math.ceil(keys.count() / shards / BUCKET_ROWS))
    bounds = splitters(keys, shards, tolerance)
    placed = lambda df: df.withColumn("shard", shard_of(bounds)) \
        .withColumn("part", F.pmod("k2", F.lit(buckets)).cast("int"))
    over = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = placed(keys).groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("first"))
    inside = W.partitionBy("shard", "part").orderBy("k2", "k1")
    return placed(packed).withColumn("i", F.row_number().over(inside) - 1) \
        .join(first, ["shard", "part"]) \
        .select("row", "size", "shard", (F.col("first") + F.col("i")).alias("slot"))
