"""Operator 8: n-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns are word shingles.

1. Documents with equal shingle sets form one class (a 128-bit set digest
   found by a map-side combined aggregate), so copies are one matrix row.
2. The matrix is cut into column blocks by shingle hash.  Each map task
   sends, per slice of documents and block, one packed array of hashes;
   a block is sorted once in numpy, columns with a single document are
   dropped and the rest get their document count.
3. Per class the surviving columns come together again.  A partner has to
   share ``ceil(t * n)`` shingles, so classes with fewer repeated columns
   are single: they can have no partner.
4. The rest accumulate overlap column by column, rarest first.  A column is
   multiplied out only for pairs whose positions still allow the overlap
   ``t / (1 + t) * (n_a + n_b)``; a true pair always passes at its first
   common column.  Columns first multiply with one pivot per column: the
   member with the smallest share of unrepeated shingles, the likely source
   of a group of copies, whose links join the whole group; then a random
   one.  The pairs of different components that remain, few, are multiplied
   in full, so no link between components is missed: by sizes first, then the
   entries whose positions allow those sizes, then labels that differ, so
   that no other pair of a column is made.
5. Full overlaps of the candidate pairs decide exactly.  Links are joined
   into components by alternating large-star and small-star steps.

Defined results: null or word-less text has an empty set, n 0 and links
with nothing; texts under ``k`` words have one shingle; rows with a null id
keep a null component; repeated rows are one class; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tempora.llm import grams
from tempora.session import cut_lineage

NODE = 16
SLICE_BYTES = 4 << 20
BLOCK_ENTRIES = 2_000_000
BUCKET_CLASSES = 20_000
# candidate pairs up to this number are broadcast (32 bytes each)
BROADCAST_PAIRS = 200_000
# keys of rows up to this number are broadcast (about 50 bytes each)
BROADCAST_KEYS = 500_000
# set digests a map task remembers, to send copies once per task
SEEN_CLASSES = 200_000


def _digests(sets) -> list[bytes]:
    """128-bit digest of each shingle set (independent of order)."""
    out = []
    for s in sets:
        a = np.uint64(0) if not len(s) else np.sum(grams.mix(s), dtype=np.uint64)
        b = np.uint64(0) if not len(s) else np.bitwise_xor.reduce(
            grams.mix(s + np.uint64(0x9E3779B97F4A7C15)))
        out.append(int(a).to_bytes(8, "big") + int(b ^ np.uint64(len(s))).to_bytes(8, "big"))
    return out


def _sets_by_slice(column, k, slice_bytes=SLICE_BYTES):
    raw, offs = grams.text_buffers(column)
    for i, j in grams.byte_slices(offs, slice_bytes):
        word, first = grams.words(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i], lower=True)
        yield i, j, grams.shingle_sets(word, first, k)


def _text_key(text_col: str):
    """96 bits that tell the texts of one id apart."""
    text = F.col(text_col)
    return F.struct(text.isNull().alias("none"), F.xxhash64(text).alias("h"), F.hash(text).alias("g"))


def classes(docs: DataFrame, id_col: str, text_col: str, k: int = 5, keyed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, node): the set size and the 16-byte class of each row; ``keyed`` adds the key of its text."""
    more = ["key"] if keyed else []

    def sign(batches):
        for b in batches:
            for i, j, sets in _sets_by_slice(b.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(_digests(sets), pa.binary()), *(b.column(c).slice(i, j - i) for c in more)],
                    ["doc_id", "n_shingles", "node", *more])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *(_text_key(text_col).alias(c) for c in more)) \
        .mapInArrow(sign, "doc_id long, n_shingles long, node binary" + "".join(
            f", {c} struct<none:boolean,h:long,g:int>" for c in more))


def _incidence(docs: DataFrame, text_col: str, k: int, blocks: int) -> DataFrame:
    """Packed matrix entries: one row per slice of documents and column block."""
    def cut(batches):
        seen: OrderedDict[bytes, None] = OrderedDict()
        for b in batches:
            for _, _, sets in _sets_by_slice(b.column(0), k):
                nodes = _digests(sets)
                keep = []
                for x, (node, s) in enumerate(zip(nodes, sets)):
                    if len(s) and node not in seen:
                        keep.append(x)
                        seen[node] = None
                        if len(seen) > SEEN_CLASSES:
                            seen.popitem(last=False)
                if not keep:
                    continue
                node = np.frombuffer(b"".join(nodes[x] for x in keep), f"V{NODE}")
                n = np.array([len(sets[x]) for x in keep], np.uint32)
                h = np.concatenate([sets[x] for x in keep])
                doc = np.repeat(np.arange(len(keep), dtype=np.uint32), n)
                block = (h % np.uint64(blocks)).astype(np.uint32)
                order = np.argsort(block, kind="stable")
                h, doc = h[order], doc[order]
                edge = np.searchsorted(block[order], np.arange(blocks + 1))
                rows = {c: [] for c in ("block", "nodes", "ns", "counts", "hashes")}
                for q in range(blocks):
                    lo, hi = edge[q], edge[q + 1]
                    if lo == hi:
                        continue
                    count = np.bincount(doc[lo:hi], minlength=len(keep)).astype(np.uint32)
                    has = count > 0
                    for c, v in zip(rows, (q, node[has].tobytes(), n[has].tobytes(),
                                           count[has].tobytes(), _six(h[lo:hi] // np.uint64(blocks)))):
                        rows[c].append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["block"], pa.int32())] +
                    [pa.array(rows[c], pa.binary()) for c in ("nodes", "ns", "counts", "hashes")],
                    list(rows))
    return docs.select(F.col(text_col).alias("text")).mapInArrow(
        cut, "block int, nodes binary, ns binary, counts binary, hashes binary")


def _six(h: np.ndarray) -> bytes:
    """The lower 48 bits of each number."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _repeated(entries: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """Columns of two documents or more, with their counts, packed per class bucket."""
    def reduce(table: pa.Table) -> pa.Table:
        node, n = _joined(table, "nodes", f"V{NODE}"), _joined(table, "ns", np.uint32)
        count, h = _joined(table, "counts", np.uint32), _from_six(b"".join(table.column("hashes").to_pylist()))
        # a column is its 48 bits within the block, and the block
        h = grams.mix(h + (np.uint64(table.column("block")[0].as_py()) << np.uint64(48)))
        # one row per class: tasks may have sent the same class twice
        key = node.view(">u8").reshape(-1, 2)
        by = np.lexsort((key[:, 1], key[:, 0]))
        same = np.zeros(len(by), bool)
        same[1:] = (key[by][1:] == key[by][:-1]).all(axis=1)
        again = np.zeros(len(by), bool)
        again[by] = same
        doc = np.repeat(np.arange(len(node), dtype=np.uint32), count)
        if again.any():
            keep = ~again[doc]
            h, doc = h[keep], doc[keep]
        order = np.argsort(h, kind="stable")
        hs = h[order]
        start = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]])) if len(hs) else np.zeros(0, int)
        df = np.diff(np.append(start, len(hs)))
        many = np.repeat(df > 1, df)
        order = order[many]
        dfs = np.repeat(df, df)[many].astype(np.uint32)
        h, doc = h[order], doc[order]
        bucket = (key[:, 0].astype(np.uint64) % np.uint64(buckets)).astype(np.uint32)[doc]
        order = np.lexsort((doc, bucket))
        h, doc, dfs, bucket = h[order], doc[order], dfs[order], bucket[order]
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = {c: [] for c in ("bucket", "nodes", "ns", "counts", "hashes", "dfs")}
        for q in range(buckets):
            lo, hi = edge[q], edge[q + 1]
            if lo == hi:
                continue
            who, per = np.unique(doc[lo:hi], return_counts=True)
            for c, v in zip(rows, (q, node[who].tobytes(), n[who].tobytes(),
                                   per.astype(np.uint32).tobytes(), h[lo:hi].tobytes(),
                                   dfs[lo:hi].tobytes())):
                rows[c].append(v)
        return pa.table([pa.array(rows["bucket"], pa.int32())] +
                        [pa.array(rows[c], pa.binary()) for c in list(rows)[1:]], names=list(rows))
    return entries.repartition(blocks, "block").groupBy("block").applyInArrow(
        reduce, "bucket int, nodes binary, ns binary, counts binary, hashes binary, dfs binary")


def _need(n, num: int, den: int):
    """ceil(t * n): shingles that any partner has to share."""
    return -(-num * n // den)


def _survivors(packed: DataFrame, buckets: int, num: int, den: int) -> DataFrame:
    """Classes with enough repeated columns: (node, n, grams, first_pos, prefix).

    ``grams`` are the sorted repeated hashes, ``prefix`` those in whose
    columns a partner must be met, rarest first, from position ``first_pos``
    (columns without a second document stand before them).
    """
    def gather(table: pa.Table) -> pa.Table:
        node, n = _joined(table, "nodes", f"V{NODE}"), _joined(table, "ns", np.uint32).astype(np.int64)
        count = _joined(table, "counts", np.uint32)
        h, df = _joined(table, "hashes", np.uint64), _joined(table, "dfs", np.uint32)
        _, first, which = np.unique(node.view(">u8").reshape(-1, 2), axis=0,
                                    return_index=True, return_inverse=True)
        which = which.reshape(-1)
        entry = np.repeat(which, count)
        r = np.bincount(entry, minlength=len(first))
        size = n[first]
        ok = r >= _need(size, num, den)
        keep = ok[entry]
        entry, h, df = entry[keep], h[keep], df[keep]
        order = np.lexsort((h, df, entry))
        entry, h = entry[order], h[order]
        out = {c: [] for c in ("node", "n", "grams", "first_pos", "prefix")}
        for x in np.flatnonzero(ok):
            lo, hi = np.searchsorted(entry, [x, x + 1])
            own, total = h[lo:hi], int(size[x])
            unique = total - len(own)
            length = max(0, total - _need(total, num, den) + 1 - unique)
            for c, v in zip(out, (node[first[x]].tobytes(), total, np.sort(own).tobytes(), unique,
                                  own[:length].view(np.int64))):
                out[c].append(v)
        return pa.table([pa.array(out["node"], pa.binary()), pa.array(out["n"], pa.int64()),
                         pa.array(out["grams"], pa.binary()), pa.array(out["first_pos"], pa.int64()),
                         pa.array(out["prefix"], pa.list_(pa.int64()))], names=list(out))
    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        gather, "node binary, n long, grams binary, first_pos long, prefix array<long>")


def _verified(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full overlap reaches the threshold."""
    def decide(batches):
        for b in batches:
            keep = []
            for na, nb, ga, gb in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "ga", "gb"))):
                both = len(np.intersect1d(np.frombuffer(ga, np.uint64), np.frombuffer(gb, np.uint64),
                                          assume_unique=True))
                keep.append(den * both >= num * (na + nb - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    side = lambda p: rows.select(F.col("node").alias(p), F.col("n").alias(f"n{p}"),
                                 F.col("grams").alias(f"g{p}"))
    if pairs.count() <= BROADCAST_PAIRS:
        # few pairs go to the columns, instead of all columns to the pairs
        few = F.broadcast(pairs)
        both = side("a").join(few, "a").join(side("b").join(few, "b"), ["a", "b"])
    else:
        both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(decide, "a binary, b binary")


def _forget(df: DataFrame) -> None:
    """Have the driver collect its garbage, so that Spark removes the files of superseded shuffles and checkpoints.

    Otherwise they stay until the driver's memory runs short, and the many small steps of a fixpoint add up on disk.
    """
    df.sparkSession.sparkContext._jvm.System.gc()


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node of each component, by alternating star steps.

    Each step is an aggregate (min per node) and a join, so a node with very
    many links is a hot join key and no group is collected.
    """
    now = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .where("u <> v").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*") \
            .where("u <> v").distinct()
        now = cut_lineage(small)
        del both, low, large, small
        _forget(now)
    return now.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node") \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _allowed(num: int, den: int):
    """Sizes fit, and this column may be the first common one of a linked pair."""
    need = F.ceil((num * (F.col("a.n") + F.col("b.n"))) / (num + den))
    return (den * F.least("a.n", "b.n") >= num * F.greatest("a.n", "b.n")) & \
        (F.col("a.pos") <= F.col("a.n") - need) & (F.col("b.pos") <= F.col("b.n") - need)


def _rest_pairs(rest: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that meet in a column, are allowed and have different labels; no other pair is made.

    Whether a pair is allowed depends on its sizes, and on a bound on the position of each side.  So pairs
    of sizes come first, then the entries of each side under its bound, then pairs of their labels.
    """
    sizes = rest.groupBy("g", "n").agg(F.min("pos").alias("pos"))
    sizes = sizes.alias("a").join(sizes.alias("b"), "g").where((F.col("a.n") <= F.col("b.n")) & _allowed(num, den)) \
        .select("g", F.col("a.n").alias("na"), F.col("b.n").alias("nb"),
                F.ceil((num * (F.col("a.n") + F.col("b.n"))) / (num + den)).alias("need"))

    def side(p: str) -> DataFrame:
        return rest.select("g", F.col("n").alias(f"n{p}"), "pos", F.col("node").alias(p), F.col("label").alias(f"l{p}")) \
            .join(sizes, ["g", f"n{p}"]).where(F.col("pos") <= F.col(f"n{p}") - F.col("need")) \
            .select("g", "na", "nb", p, f"l{p}")
    a, b = side("a"), side("b")
    meet = ["g", "na", "nb"]
    labels = a.select(*meet, "la").distinct().join(b.select(*meet, "lb").distinct(), meet) \
        .where("la <> lb and (na < nb or la < lb)")
    return labels.join(a, [*meet, "la"]).join(b, [*meet, "lb"]).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(rows: DataFrame, num: int, den: int, pivot_rounds: int = 2) -> DataFrame:
    """Links that connect every component: (a, b) of class nodes."""
    posts = rows.select("node", "n", "first_pos", F.posexplode("prefix").alias("i", "g")) \
        .select("g", "node", "n", (F.col("first_pos") + F.col("i")).alias("pos"),
                (F.col("first_pos") / F.col("n")).alias("alone"))
    many = posts.groupBy("g").count().where("count > 1").select("g")
    posts = cut_lineage(posts.join(many, "g"))
    found = tested = label = None
    for step in range(pivot_rounds + 1):
        p = posts.withColumn("label", F.col("node")) if label is None else \
            posts.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        first = F.col("alone") if step == 0 else F.xxhash64("node", F.lit(step))
        span = p.groupBy("g").agg(F.min(F.struct(first, "node", "label", "pos", "n")).alias("pivot"),
                                  F.min("label").alias("low"), F.max("label").alias("top")) \
            .where("low <> top")
        if step < pivot_rounds:
            pairs = span.select("g", "pivot.*").alias("a").join(p.alias("b"), "g") \
                .where((F.col("a.label") != F.col("b.label")) & _allowed(num, den)) \
                .select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")) \
                .distinct()
        else:
            pairs = _rest_pairs(cut_lineage(p.join(span.select("g"), "g", "left_semi")), num, den)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        linked = _verified(pairs, rows, num, den)
        found = cut_lineage(linked if found is None else found.union(linked))
        tested = pairs if tested is None else tested.union(pairs)
        del p, span, pairs, linked
        label = connected(found)
    return label


def _labelled(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: tuple[int, int],
              keyed: bool = False) -> DataFrame:
    """The rows of ``classes`` with the label of their component, null for empty sets."""
    num, den = threshold
    base = cut_lineage(classes(docs, id_col, text_col, k, keyed))
    sized = base.groupBy("node").agg(F.first("n_shingles").alias("n"))
    total, n_classes = sized.agg(F.sum("n"), F.count("*")).first()
    blocks = max(16, math.ceil((total or 0) / BLOCK_ENTRIES))
    buckets = max(16, math.ceil(n_classes / BUCKET_CLASSES))
    rows = cut_lineage(_survivors(_repeated(_incidence(docs, text_col, k, blocks), blocks, buckets), buckets, num, den))
    _forget(rows)
    label = links(rows, num, den)
    # empty sets share a node but link with nothing
    return base.join(label, "node", "left").withColumn(
        "label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; see the module text.

    ``threshold`` is the Jaccard bound as a fraction; two documents link
    when ``den * overlap >= num * union``.
    """
    labelled = _labelled(docs, id_col, text_col, k, threshold).select("doc_id", "n_shingles", "label")
    low = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("low"))
    return labelled.join(low, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """The input rows without near duplicates: one row of every component stays.

    It is the row of the smallest id, null ids last, then of the smallest class and text key; of rows
    alike in id and text any one.  Rows without words link with nothing and stay, once per id and text.
    """
    same = ["_null", "_id", "_key"]
    found = _labelled(docs, f"`{id_col}`", f"`{text_col}`", k, threshold, keyed=True).select(
        F.col("doc_id").isNull().alias("_null"), F.coalesce("doc_id", F.lit(0)).alias("_id"), "node",
        F.col("key").alias("_key"), "label")
    lead = found.where("label is not null").groupBy("label") \
        .agg(F.min(F.struct("_null", "_id", "node", "_key")).alias("m")).select("m._null", "m._id", "m._key") \
        .withColumn("_lead", F.lit(True))
    # decided on keys alone: those that go, and those kept that several rows have
    keys = found.groupBy(*same).agg(F.count("*").alias("_rows"), F.max(F.col("label").isNull()).alias("_alone")) \
        .join(lead, same, "left").withColumn("_goes", ~F.col("_alone") & F.col("_lead").isNull()) \
        .where("_goes or _rows > 1").select(*same, "_goes")
    keys = cut_lineage(keys)
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("_i"), _text_key(f"`{text_col}`").alias("_key")) \
        .select("row", F.col("_i").isNull().alias("_null"), F.coalesce("_i", F.lit(0)).alias("_id"), "_key") \
        .join(keys, same, "left")
    # only rows of one id and text go through an aggregate
    once = rows.where("_goes is null").select("row")
    first = rows.where("not _goes").groupBy(*same).agg(F.first("row").alias("row")).select("row")
    return once.union(first).select("row.*")
