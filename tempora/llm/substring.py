"""Operator 3: exact substring dedup by Rabin-Karp hashes of fixed-length word windows.

A word goes when a window of ``window`` words that covers it also starts in
a document with a smaller id.  All windows are judged on the input.

1. Every text is hashed once.  Texts with equal word sequences are one
   class; all but its smallest id are removed whole, and only that one
   represents the class below.
2. Every window is hashed through its anchor, the smallest of the hashes of
   the half-length windows inside it.  Neighbouring windows mostly share
   their anchor, so a run of windows is one row.  Equal windows have equal
   anchors: a window whose anchor is in one class only occurs once and needs
   no further count.
3. Where all runs of a repeated anchor hash alike, the middle of a shared
   passage, they have the same windows and the run is counted as a whole.
   Windows under other repeated anchors, at the ends of passages, are
   counted by their own 96-bit Rabin-Karp hash.  Either way the smallest id
   per hash is joined back.
4. A document's repeated windows merge into maximal intervals, which are cut
   out of its words.

Counting is a map-side combined aggregate joined back.  An anchor that very
many rows have, in the passage that a third of all documents share, is told
by its count, and its rows are dealt over as many parts as it needs, to each
of which the one row to join is copied; the hashes of step 3's single windows
are left to adaptive execution.  Windows that follow one another are one
row before they are gathered by document.  Texts are shuffled once, by id;
both joins that need them read the same exchange.

Defined results: null text has no words; texts under ``window`` words lose
nothing; rows with a null id are kept whole and never count as smaller;
rows that repeat an id are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tempora.llm import grams
from tempora.session import cut_lineage

SLICE_BYTES = 2 << 20
# sequence digests a map task remembers, to send copies once per task
SEEN_CLASSES = 200_000
_LOW = np.uint64(0xFFFFFFFF)
# rows of one hash in a part, and hashes with more rows up to which their list is broadcast (40 bytes each)
HOT_ROWS, BROADCAST_HOT = 10_000, 500_000


def _tag(s1) -> int:
    """Tells the texts of rows that share an id apart (31 bits of the text's digest)."""
    return int(s1) & 0x7FFFFFFF


def _slices(column):
    raw, offs = grams.text_buffers(column)
    for i, j in grams.byte_slices(offs, SLICE_BYTES):
        yield i, j, *grams.words(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def _signed(docs: DataFrame) -> DataFrame:
    def sign(batches):
        for b in batches:
            for i, j, word, first in _slices(b.column(1)):
                s1, s2 = grams.sequence_digests(word, first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(np.diff(first)),
                     pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))],
                    ["doc_id", "n_words", "s1", "s2"])
    return docs.mapInArrow(sign, "doc_id long, n_words long, s1 long, s2 long")


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """Runs of windows with one anchor: (g, s1, r, at, n), ``r`` the hash of all the run's words."""
    k = max(1, window // 2)

    def scan(batches):
        seen: OrderedDict[tuple, None] = OrderedDict()
        for b in batches:
            for _, _, word, first in _slices(b.column(0)):
                s1, s2 = grams.sequence_digests(word, first)
                low = grams.sliding_min(grams.windows(word, k), window - k + 1)
                own = np.diff(first) - window + 1
                use = np.flatnonzero(own > 0)
                use = [r for r in use.tolist() if (int(s1[r]), int(s2[r])) not in seen]
                if not use:
                    continue
                for r in use:
                    seen[int(s1[r]), int(s2[r])] = None
                    if len(seen) > SEEN_CLASSES:
                        seen.popitem(last=False)
                use, own = np.array(use), own[use]
                end = np.cumsum(own)
                row = np.repeat(np.arange(len(use)), own)
                at = np.arange(end[-1]) - np.repeat(end - own, own)
                g = low[first[use][row] + at]
                start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])]))
                n = np.diff(np.append(start, len(g)))
                begin = first[use][row[start]] + at[start]
                r = grams.span_hashes(word, begin, begin + n + window - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[start].view(np.int64)), pa.array(s1[use][row[start]].view(np.int64)),
                     pa.array(r.view(np.int64)), pa.array(at[start].astype(np.int32)),
                     pa.array(n.astype(np.int32))], ["g", "s1", "r", "at", "n"])
    return docs.select("text").mapInArrow(scan, "g long, s1 long, r long, at int, n int")


def _window_hashes(docs: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows in ``ranges``: (h, c, doc_id, tag, at)."""
    def count(batches):
        for b in batches:
            ranges = b.column(2).to_pylist()
            for i, j, word, first in _slices(b.column(1)):
                h = grams.windows(word, window)
                check = grams.windows(grams.mix(word), window)
                s1, _ = grams.sequence_digests(word, first)
                ids, tags, ats, spots = [], [], [], []
                for r in range(j - i):
                    a, z = int(first[r]), int(first[r + 1]) - window + 1
                    if z <= a:
                        continue
                    spot = np.unique(np.concatenate(
                        [np.arange(a + x["at"], min(a + x["at"] + x["n"], z)) for x in ranges[i + r]]))
                    spots.append(spot)
                    ats.append((spot - a).astype(np.int32))
                    tags.append(np.full(len(spot), _tag(s1[r]), np.int32))
                    ids.append(np.full(len(spot), b.column(0)[i + r].as_py(), np.int64))
                if spots:
                    spot = np.concatenate(spots)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[spot].view(np.int64)),
                         pa.array((check[spot] & _LOW).astype(np.uint32).view(np.int32)),
                         pa.array(np.concatenate(ids)), pa.array(np.concatenate(tags)),
                         pa.array(np.concatenate(ats))], ["h", "c", "doc_id", "tag", "at"])
    return docs.mapInArrow(count, "h long, c int, doc_id long, tag int, at int")


def _join_split(big: DataFrame, small: DataFrame, keys: list[str], deal: list[str]) -> DataFrame:
    """``big`` joined with ``small``, which has one row per key with the number ``rows`` of its rows in ``big``.

    Rows of a key with more than HOT_ROWS are dealt by ``deal`` over parts of their own.
    """
    parts = F.when(F.col("rows") > HOT_ROWS, F.ceil(F.col("rows") / HOT_ROWS)).otherwise(1).cast("int")
    small = cut_lineage(small.withColumn("parts", parts).drop("rows"))
    hot = small.where("parts > 1").select(*keys, F.col("parts").alias("dealt"))
    n = hot.count()
    if not n:
        return big.join(small.drop("parts"), keys)
    if n <= BROADCAST_HOT:
        hot = F.broadcast(hot)
    part = F.when(F.col("dealt").isNull(), 0).otherwise(F.pmod(F.xxhash64(*deal), F.col("dealt"))).cast("int")
    dealt = big.join(hot, keys, "left").withColumn("part", part).drop("dealt")
    return dealt.join(small.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"),
                      [*keys, "part"]).drop("part")


def _merged_starts(gone: DataFrame) -> DataFrame:
    """Windows of (doc_id, tag, at, n) that follow one another as one row, dealt by document."""
    order = Window.partitionBy("doc_id", "tag").orderBy("at", "n")
    before = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return gone.repartition("doc_id").withColumn("_new", F.when(F.col("at") <= before, 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("doc_id", "tag", "_run").agg(F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("_stop")) \
        .select("doc_id", "tag", "at", (F.col("_stop") - F.col("at")).alias("n"))


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """Apply the removals: (doc_id, n_words, n_removed, intervals, kept_text)."""
    def cut(batches):
        # a few rows at a time: their words are Python objects
        for b in (x.slice(i, 512) for x in batches for i in range(0, x.num_rows, 512)):
            out = {c: [] for c in ("doc_id", "n_words", "n_removed", "intervals", "kept_text")}
            for doc_id, text, gone, whole in zip(*(b.column(c).to_pylist() for c in range(4))):
                own = (text or "").encode().split()
                spans: list[tuple[int, int]] = []
                if gone or whole:
                    raw, offs = grams.text_buffers(pa.array([text]))
                    s1 = grams.sequence_digests(*grams.words(raw, offs))[0]
                    if whole and int(s1.view(np.int64)[0]) in whole:
                        spans = [(0, len(own))]
                    else:
                        # windows that touch or overlap merge into one interval
                        for x in sorted((g["at"], g["at"] + g["n"] + window - 1)
                                        for g in gone or () if g["tag"] == _tag(s1[0])):
                            if spans and x[0] <= spans[-1][1]:
                                spans[-1] = (spans[-1][0], max(x[1], spans[-1][1]))
                            else:
                                spans.append(x)
                kept, pos = [], 0
                for x, y in spans:
                    kept += own[pos:x]
                    pos = y
                kept += own[pos:]
                for c, v in zip(out, (doc_id, len(own), len(own) - len(kept),
                                      [{"first": x, "stop": y} for x, y in spans],
                                      b" ".join(kept).decode())):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["n_removed"], pa.int64()),
                 pa.array(out["intervals"], pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(out["kept_text"], pa.string())], list(out))
    return docs.mapInArrow(cut, "doc_id long, n_words long, n_removed long, "
                                "intervals array<struct<first:long,stop:long>>, kept_text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, intervals, kept_text."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    some = docs.where("doc_id is not null")
    signed = cut_lineage(_signed(some).where(F.col("n_words") >= window))
    low = signed.groupBy("n_words", "s1", "s2").agg(F.min("doc_id").alias("low"))
    whole = signed.join(low, ["n_words", "s1", "s2"]).where("doc_id > low") \
        .groupBy("doc_id").agg(F.collect_set("s1").alias("whole"))
    anchors = _anchors(some, window)
    many = anchors.groupBy("g").agg(F.min("s1").alias("a"), F.max("s1").alias("z"), F.count("*").alias("rows"),
                                    (F.min("r") == F.max("r")).alias("alike")).where("a <> z")
    runs = cut_lineage(_join_split(anchors, many.select("g", "alike", "rows"), ["g"], ["s1", "at"])
                       .join(low.select("s1", F.col("low").alias("doc_id")), "s1")
                       .select("g", "alike", "doc_id", F.expr("cast(s1 & 2147483647 as int)").alias("tag"),
                               "at", "n").distinct())
    alike = runs.where("alike")
    least = [F.min("doc_id").alias("low"), F.count("*").alias("rows")]
    gone = _join_split(alike, alike.groupBy("g").agg(*least), ["g"], ["doc_id", "at"]).where("doc_id > low") \
        .select("doc_id", "tag", "at", "n")
    ranges = runs.where("not alike").groupBy("doc_id").agg(F.collect_set(F.struct("at", "n")).alias("ranges"))
    # one exchange of the texts, read by both joins below
    spread = some.repartition("doc_id")
    hashed = _window_hashes(spread.join(ranges, "doc_id").select("doc_id", "text", "ranges"), window)
    # windows of one document only are nobody's repeat
    first = hashed.groupBy("h", "c").agg(*least, F.max("doc_id").alias("top")).where("low < top").drop("top")
    # in one plan with the texts' exchange: adaptive execution splits a hot hash here
    gone = gone.union(hashed.join(first.drop("rows"), ["h", "c"]).where("doc_id > low")
                      .select("doc_id", "tag", "at", F.lit(1).alias("n")))
    gone = _merged_starts(gone).groupBy("doc_id").agg(F.collect_list(F.struct("tag", "at", "n")).alias("gone"))
    marked = spread.join(gone, "doc_id", "left").join(whole, "doc_id", "left") \
        .select("doc_id", "text", "gone", "whole")
    nameless = docs.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<struct<tag:int,at:int,n:int>>"), F.lit(None).cast("array<long>"))
    return _cut(marked.union(nameless), window)
