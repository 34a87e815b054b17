"""Operator 13: maximal periodic runs of words, found in tiles per octave of periods.

A run is a stretch with smallest period q whose words q apart are equal, as
long as it can be, of ``max(min_length, exponent * q)`` words or more.  For a
period q it is a longest interval of places i with ``word[i] == word[i + q]``.

1. Periods are taken by octaves [S, 2S), the first one being [1, 2S) with S
   at its smallest.  A run's interval of places is at least 2S long, so it
   holds a grid point c, a multiple of S, where the S/2 words from c and
   those from c + q are equal.  Hashes of S/2 words tell these points.
2. The points of a document that pass are sent as tiles: the words around a
   few neighbouring points, overlapping the next tile.  Tiles are dealt out
   evenly, so a very long document is many tasks.
3. A tile is solved alone.  At each point the Z-function of the words behind
   it gives how far every period goes on, and one of the words before it,
   reversed, how far it reaches back.  Periods that are a multiple of a
   shorter one are dropped there: so is their whole run.
4. The fragments meet by document and period and are stitched where they
   touch or overlap, which gives whole runs.  Short ones are dropped then.

Words are compared by 64-bit hashes.  Texts without a tile never move; the
others are shuffled once, to meet their runs.

Defined results: null and empty texts have no words and no runs; rows that
repeat an id or have none are treated one by one; very long texts are
treated whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tempora.llm import grams
from tempora.session import cut_lineage

SLICE_BYTES = 2 << 20
# points of one tile lie within so many words, or 4 S
TILE_WORDS = 4096
RUNS = "array<struct<start:long,period:long,length:long>>"


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal the first ones."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        z[0] = n
    return z


@lru_cache(maxsize=1 << 16)
def _roots(q: int) -> tuple[int, ...]:
    """q over each of its prime factors: the periods that would make q a multiple."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return (*out, q // rest) if rest > 1 else tuple(out)


def octaves(longest: int, min_length: int, exponent: int):
    """(S, first period, end of periods) as far as a run of ``longest`` words has them."""
    step = 2
    while 6 * step <= min_length:
        # every period under 2 * step leaves 2 * step equal places or more
        step *= 2
    step = max(2, step)
    low = 1
    while exponent * low <= longest:
        yield step, low, 2 * step
        low = step = 2 * step


def points(word: np.ndarray, first: np.ndarray, min_length: int, exponent: int):
    """(S, documents, points): grid points that may lie in a run, as words of the document, for each octave."""
    own = np.diff(first)
    use = own >= min_length
    word, own, rows = word[np.repeat(use, own)], own[use], np.flatnonzero(use)
    for step, low, end in octaves(int(own.max(initial=0)), min_length, exponent):
        use = own >= exponent * low
        if not use.all():
            word, own, rows = word[np.repeat(use, own)], own[use], rows[use]
        if not len(own):
            return
        gram, n = step // 2, len(word)
        begin = np.cumsum(own) - own
        doc = np.repeat(np.arange(len(own)), own)
        # the grid runs on behind the last word, over hashes that no document has
        h = grams.windows(np.concatenate([word, np.arange(end + gram + step, dtype=np.uint64)]), gram)
        grid = np.arange(0, n, step)
        ahead = np.lib.stride_tricks.sliding_window_view(h[low:], end - low)[::step][:len(grid)]
        at, q = np.nonzero(ahead == h[grid][:, None])
        at, q = grid[at], q + low
        last = at + q + gram - 1
        fits = last < n
        at, q, last = at[fits], q[fits], last[fits]
        fits = (doc[at] == doc[last]) & (exponent * q <= own[doc[at]])
        at = np.unique(at[fits])
        if len(at):
            yield step, rows[doc[at]], at - begin[doc[at]]


def _slices(column):
    raw, offs = grams.text_buffers(column)
    for i, j in grams.byte_slices(offs, SLICE_BYTES):
        yield i, j, *grams.words(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def _tiles(docs: DataFrame, min_length: int, exponent: int) -> DataFrame:
    """(a, b, step, base, points, words) of (a, b, text): the words of a tile as its own small numbers."""
    def explode(batches):
        names = ["a", "b", "step", "base", "points", "words"]
        for batch in batches:
            for i, _, word, first in _slices(batch.column(2)):
                for step, rows, at in points(word, first, min_length, exponent):
                    cut = (np.diff(rows) > 0) | (np.diff(at) > 4 * step) | \
                        (np.diff(at // max(TILE_WORDS, 4 * step)) > 0)
                    edge = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(at)]])
                    out = {c: [] for c in names}
                    for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                        lo, hi = int(first[rows[x]]), int(first[rows[x] + 1])
                        base = max(0, int(at[x]) - step)
                        part = word[lo + base:min(hi, lo + int(at[y - 1]) + 4 * step)]
                        ids = np.unique(part, return_inverse=True)[1]
                        wide = np.uint32 if len(part) > 65535 else np.uint16
                        for c, v in zip(names, (batch.column(0)[i + int(rows[x])].as_py(),
                                                batch.column(1)[i + int(rows[x])].as_py(), step, base,
                                                (at[x:y] - base).astype(np.uint32).tobytes(),
                                                ids.astype(wide).tobytes())):
                            out[c].append(v)
                        if len(out["a"]) >= 256:
                            yield _tile_batch(out)
                            out = {c: [] for c in names}
                    if out["a"]:
                        yield _tile_batch(out)
    return docs.mapInArrow(explode, "a long, b int, step long, base long, points binary, words binary")


def _tile_batch(out: dict) -> pa.RecordBatch:
    kinds = dict(a=pa.int64(), b=pa.int32(), step=pa.int64(), base=pa.int64(), points=pa.binary(), words=pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in kinds.items()], list(kinds))


def solve(words: list[int], at: list[int], step: int, low: int):
    """(period, first place, end of places) of the periods [low, 2 step) around the points of one tile."""
    found: dict[int, list[list[int]]] = {}
    for c in at:
        forth = z_function(words[c:c + 4 * step])
        before, end = words[max(0, c - step):c][::-1], min(len(words), c + 2 * step)
        back = None
        for q in range(low, min(2 * step, len(forth))):
            if forth[q] < step // 2 or any(forth[p] >= q - p for p in _roots(q)):
                continue
            if back is None:
                back = z_function(before + [-1] + words[max(0, c - step):end][::-1])
            reach = back[len(before) + 1 + end - c - q] if before else 0
            spans = found.setdefault(q, [])
            if spans and c - reach <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], c + forth[q])
            else:
                spans.append([c - reach, c + forth[q]])
    return [(q, x, y) for q, spans in found.items() for x, y in spans]


def _fragments(tiles: DataFrame, min_length: int) -> DataFrame:
    smallest = next(octaves(min_length, min_length, 1))[0]

    def each(batches):
        for batch in batches:
            out = {c: [] for c in ("a", "b", "period", "low", "high")}
            for a, b, step, base, at, words in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.frombuffer(at, np.uint32).tolist()
                wide = np.uint16 if len(words) <= 2 * 65535 else np.uint32
                words = np.frombuffer(words, wide).tolist()
                for q, x, y in solve(words, at, step, 1 if step == smallest else step):
                    for c, v in zip(out, (a, b, q, base + x, base + y)):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c], pa.int32() if c == "b" else pa.int64()) for c in out], list(out))
    return tiles.mapInArrow(each, "a long, b int, period long, low long, high long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    # 96 bits that tell rows apart by id and text; rows alike in both have the same runs
    return docs.select(doc_id.alias("doc_id"), text.alias("text")).select(
        F.xxhash64("doc_id", "text").alias("a"), F.hash("text", "doc_id").alias("b"), "doc_id", "text")


def _runs(keyed: DataFrame, min_length: int, exponent: int) -> DataFrame:
    """(a, b, start, period, length) of every run."""
    tiles = _tiles(keyed.select("a", "b", "text"), min_length, exponent)
    # tiles of one document go to many tasks, those of one place to the same on every attempt
    tiles = tiles.repartition("a", "b", "step", "base")
    pieces = _fragments(tiles, min_length)
    key = ["a", "b", "period"]
    seen = Window.partitionBy(*key).orderBy("low", "high")
    stitched = pieces.withColumn("_end", F.max("high").over(seen.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("_new", F.when(F.col("low") <= F.col("_end"), 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(seen.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy(*key, "_run").agg(F.min("low").alias("start"), F.max("high").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    return stitched.select("a", "b", "start", "period", length.alias("length")) \
        .where((F.col("length") >= min_length) & (F.col("length") >= exponent * F.col("period")))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
              exponent: int = 3) -> DataFrame:
    """doc_id, start, period, length of every run (rows alike in id and text: their runs once)."""
    keyed = _keyed(docs, id_col, text_col)
    names = keyed.select("a", "b", "doc_id")
    found = cut_lineage(_runs(keyed, min_length, exponent))
    return found.join(names, ["a", "b"]).select("doc_id", "start", "period", "length").distinct()


def _hits(column, min_length: int, exponent: int) -> np.ndarray:
    """Which texts have a grid point, so a tile."""
    got = np.zeros(len(column), bool)
    for i, _, word, first in _slices(column):
        for _, rows, _ in points(word, first, min_length, exponent):
            got[i + rows] = True
    return got


def _with_hits(keyed: DataFrame, min_length: int, exponent: int) -> DataFrame:
    def pick(batches):
        for batch in batches:
            yield batch.filter(pa.array(_hits(batch.column(3), min_length, exponent)))
    return keyed.mapInArrow(pick, keyed.schema)


CUT_SCHEMA = f"doc_id long, n_words long, runs {RUNS}, n_dropped long, kept_text string"
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "period", "length")]))


def _cut(ids, texts, runs) -> pa.RecordBatch:
    n, dropped, kept = [], [], []
    for text, own_runs in zip(texts, runs):
        own = (text or "").encode().split()
        n.append(len(own))
        if own_runs:
            gone = np.zeros(len(own) + 1, np.int64)
            for r in own_runs:
                gone[r["start"] + r["period"]] += 1
                gone[r["start"] + r["length"]] -= 1
            own = [own[x] for x in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        dropped.append(n[-1] - len(own))
        kept.append(b" ".join(own).decode())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.array(runs, _RUNS), pa.array(dropped, pa.int64()),
         pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "n_dropped", "kept_text"])


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
             exponent: int = 3) -> DataFrame:
    """Per input row: doc_id, n_words, runs (by start, then period), n_dropped, kept_text.

    A word goes when it lies in a run behind the run's first period.
    """
    if min_length < 12 or exponent < 3:
        raise ValueError("runs are found from 12 words and three periods on")
    keyed = _keyed(docs, id_col, text_col)
    found = _runs(keyed, min_length, exponent).groupBy("a", "b") \
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    moved = _with_hits(keyed, min_length, exponent).join(found, ["a", "b"], "left").select("doc_id", "text", "runs")

    def still(batches):
        for batch in batches:
            rest = batch.filter(pa.array(~_hits(batch.column(1), min_length, exponent)))
            for b in (rest.slice(i, 512) for i in range(0, rest.num_rows, 512)):
                yield _cut(b.column(0), b.column(1).to_pylist(), [[]] * b.num_rows)

    def cut(batches):
        for b in (x.slice(i, 512) for x in batches for i in range(0, x.num_rows, 512)):
            yield _cut(b.column(0), b.column(1).to_pylist(), [r or [] for r in b.column(2).to_pylist()])
    return moved.mapInArrow(cut, CUT_SCHEMA).union(keyed.select("doc_id", "text").mapInArrow(still, CUT_SCHEMA))
