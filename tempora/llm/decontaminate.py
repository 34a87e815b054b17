"""Operator 4: benchmark decontamination, in DataFrame functions only.

Texts are lower-cased and cut into runs of letters and digits; shingles are
``k`` consecutive words, weighted by how often a window has them.

1. Every shingle of every text is hashed and joined with the benchmark's
   shingles (broadcast only after a count shows them small).  Candidates are
   the item-sized windows, at every offset, that hold as many shingles of
   items as the threshold asks for.  Their places go to the texts, which
   stay where they are while the places are few (counted).
2. Each candidate window gets a 64-bit SimHash of its weighted shingles.
3. Fingerprints are cut into ``blocks`` blocks.  An item is entered under
   every block value within ``radius // blocks`` bits of its own: two
   fingerprints within ``radius`` bits agree on one entry at least, so the
   multi-index join finds all pairs within the radius.
4. Pairs within the radius are verified exactly: the weighted Jaccard
   similarity (sum of minima over sum of maxima) of window and item has to
   reach ``threshold``.

At similarity 0.75 two windows differ in 11 of 64 bits on average with a
deviation of 3; the default radius of 23 is four deviations above that.

Defined results: null or word-less texts and items match nothing; items
under ``k`` words are compared by one shingle of all their words, texts
shorter than an item by one window of the whole text; rows that repeat an
id are judged one by one and reported once per item with the best window
(ties: the first); rows with a null id are reported with a null id; an
empty benchmark matches nothing; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tempora.session import cut_lineage

BITS = 64
# benchmark shingles, and index entries, up to this number of rows are broadcast (40 bytes each at most)
BROADCAST_ROWS = 1_000_000
# counters of the fingerprint are 16 bits wide up to this number of shingles, 32 beyond
SHORT_ITEM_SHINGLES = (1 << 15) - 1


def _step(df: DataFrame, **exprs) -> DataFrame:
    """Add columns computed once: the generator keeps the optimiser from repeating them inside lambdas."""
    have = df.columns
    made = F.explode(F.array(F.struct(*((F.expr(e) if isinstance(e, str) else e).alias(n)
                                        for n, e in exprs.items()))))
    return df.select(*have, made.alias("_s")).select(*have, *(F.col(f"_s.{n}").alias(n) for n in exprs))


def _shingled(df: DataFrame, k: int) -> DataFrame:
    """Replace ``text`` by ``n`` words and ``hs``: hashes of all k-word shingles (fewer words: none)."""
    df = _step(df, _w=r"""transform(filter(split(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), w -> w <> ''),
                                    w -> xxhash64(w))""").drop("text")
    df = _step(df.withColumn("n", F.size("_w")), hs=f"if(n >= {k}, slice(_w, 1, n - {k - 1}), array())")
    for i in range(1, k):
        df = _step(df.withColumnRenamed("hs", "_h"),
                   hs=f"zip_with(_h, slice(_w, {i + 1}, size(_h)), (a, b) -> xxhash64(a, b))").drop("_h")
    return df.drop("_w")


def _bit_sums(hs: str, lane: int) -> str:
    """How many of the hashes have each bit set: ``lane`` sums of every lane-th bit, in lanes of a long."""
    ones = sum(1 << b for b in range(0, BITS, lane))
    return "array({})".format(", ".join(
        f"aggregate({hs}, 0L, (a, h) -> a + (shiftrightunsigned(h, {b}) & {ones}))" for b in range(lane)))


def _fingerprint(df: DataFrame, lane: int = 16) -> DataFrame:
    """Add ``fp`` for the shingles in ``win``; a bit is set where most shingles have it."""
    df = _step(df, _sums=_bit_sums("win", lane))
    return _step(df, fp=f"""aggregate(sequence(0, 63), 0L, (a, i) -> a ^ if(
        2 * (shiftrightunsigned(_sums[i % {lane}], cast({lane} * (i div {lane}) as int)) & {(1 << lane) - 1}) > size(win),
        shiftleft(1L, i), 0L))""").drop("_sums")


def _block(fp: str, i: int, width: int) -> Column:
    return F.expr(f"shiftrightunsigned({fp}, {i * width}) & {(1 << width) - 1}")


def _variants(width: int, distance: int) -> list[int]:
    return [sum(1 << b for b in bits) for d in range(distance + 1) for bits in combinations(range(width), d)]


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _matches(docs: DataFrame, items: DataFrame, k: int, blocks: int, radius: int, num: int, den: int,
             lane: int = 16) -> DataFrame:
    """Verified (uid, doc_id, item_id, start, n_words, similarity, distance) for items of this shingle length."""
    items = cut_lineage(_fingerprint(items.withColumn("win", F.col("hs")), lane).select("item_id", "len", "hs", "fp"))
    known = items.select("len", F.explode("hs").alias("h")).distinct()
    n_known, n_items = known.count(), items.count()
    hits = _shingled(docs, k).select("uid", "n", F.posexplode("hs").alias("pos", "h")).join(_few(known, n_known), "h")
    # the item-sized windows around each common shingle, with how many of them they hold
    spots = hits.select("uid", "n", "len", F.explode(F.sequence(
        F.greatest(F.lit(0), F.least(F.col("pos") - (F.col("len") - k), F.col("n") - F.col("len"))),
        F.greatest(F.lit(0), F.least(F.col("pos"), F.col("n") - F.col("len"))))).alias("start")) \
        .groupBy("uid", "n", "len", "start").agg(F.count("*").alias("common"))
    # similarity num / den needs a share num / (num + den) of both sides' shingles in common
    both_sizes = F.least("n", "len") + F.col("len") - 2 * (k - 1)
    spots = spots.where((num + den) * F.col("common") >= num * both_sizes) \
        .groupBy("uid").agg(F.collect_set(F.struct("len", "start")).alias("spots"))
    spots = cut_lineage(spots)
    places = spots.agg(F.sum(F.size("spots"))).first()[0] or 0
    found = docs.join(_few(spots, places), "uid")
    found = _shingled(found, k).select("uid", "doc_id", "n", "hs", F.explode("spots").alias("s")) \
        .select("uid", "doc_id", "s.len", "s.start", F.least("n", "s.len").alias("n_words"),
                F.expr(f"slice(hs, s.start + 1, least(n, s.len) - {k - 1})").alias("win"))
    found = _fingerprint(found, lane)
    width = BITS // blocks
    entry = F.explode(F.array(*(F.struct(F.lit(i).alias("block"), _block("fp", i, width).alias("value"))
                                for i in range(blocks)))).alias("e")
    variants = _variants(width, radius // blocks)
    near = F.explode(F.transform(F.array(*map(F.lit, variants)), lambda v: F.col("e.value").bitwiseXOR(v))).alias("value")
    index = items.select("item_id", "len", F.col("fp").alias("item_fp"), entry) \
        .select("item_id", "len", "item_fp", "e.block", near)
    pairs = found.select("*", entry).select("uid", "doc_id", "len", "start", "n_words", "win", "fp", "e.*") \
        .join(_few(index, n_items * blocks * len(variants)), ["len", "block", "value"]) \
        .withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))) \
        .where(F.col("distance") <= radius) \
        .where(  # a pair may meet in several blocks: the first of them reports it
            F.col("block") == F.expr("array_min(filter(array({}), x -> x is not null))".format(", ".join(
                f"if(bit_count((shiftrightunsigned(fp ^ item_fp, {i * width})) & {(1 << width) - 1}) <= "
                f"{radius // blocks}, {i}, null)" for i in range(blocks)))))
    shingles = items.select("item_id", "len", F.col("hs").alias("item_hs"))
    pairs = pairs.join(_few(shingles, items.agg(F.sum(F.size("hs"))).first()[0] or 0), ["item_id", "len"])
    both = F.expr("""aggregate(array_distinct(item_hs), 0, (a, h) -> a + least(
        size(filter(win, x -> x = h)), size(filter(item_hs, x -> x = h))))""")
    pairs = _step(pairs, overlap=both, total="size(win) + size(item_hs)")
    return pairs.where((F.col("overlap") > 0) & (den * F.col("overlap") >= num * (F.col("total") - F.col("overlap")))) \
        .select("uid", "doc_id", "item_id", "start", "n_words",
                (F.col("overlap") / (F.col("total") - F.col("overlap"))).alias("similarity"), "distance")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", k: int = 5, blocks: int = 8,
                 radius: int = 23, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, start, n_words, similarity, distance.

    ``start`` counts normalised words; ``uid`` tells rows apart that share an id.
    """
    num, den = threshold
    docs = docs.select(uid(id_col, text_col), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                             F.col(f"`{item_text_col}`").cast("string").alias("text")).distinct()
    lengths = _shingled(items, 1).where("n > 0").groupBy("n").count().select("n").collect() \
        if items.limit(1).count() else []
    lane = 16 if all(r["n"] - k < SHORT_ITEM_SHINGLES for r in lengths) else 32
    out = None
    for size in sorted({min(k, r["n"]) for r in lengths}):  # k, and shorter where items are shorter
        own = _shingled(items, size).withColumnRenamed("n", "len") \
            .where("len >= {}".format(k) if size == k else f"len = {size}")
        part = _matches(docs, own, size, blocks, radius, num, den, lane)
        out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame(
            [], "uid long, doc_id long, item_id long, start int, n_words int, similarity double, distance int")
    best = F.max_by(F.struct("start", "n_words", "similarity", "distance"),
                    F.struct("similarity", (-F.col("start")).alias("s")))
    return out.groupBy("uid", "doc_id", "item_id").agg(best.alias("b")).select("uid", "doc_id", "item_id", "b.*")


def uid(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")).alias("uid")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The input rows that hold no benchmark item, with all their columns."""
    bad = cut_lineage(contaminated(docs, benchmark, id_col, text_col, **how).select("uid").distinct())
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), uid(id_col, text_col)) \
        .join(_few(bad, bad.count()), "uid", "left_anti").select("row.*")
