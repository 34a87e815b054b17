"""Operator 11: phrase collocations from FM-indexes of word ids, one per shard of documents.

1. A first pass counts the hashes of all phrases in a table of cells whose
   size follows the corpus up to a fixed bound.  A cell's sum is no less than
   the count of any phrase in it, so phrases whose cell stays below
   ``min_count`` cannot be frequent.  The cells that reach it are one bit
   each; a wrong "may" costs a row in a shuffle and never changes a count.
2. A map task cuts its texts into shards of about ``shard_bytes``, always
   between pieces.  The words of a shard become ids, one per language and
   word, with a separator at every piece border.
3. Two indexes are built for a shard, one of the id sequence and one of its
   reverse.  An index is the Burrows-Wheeler transform of suffixes sorted by
   their first ``depth`` words, which is enough for patterns up to that
   depth: the rows of a pattern are one interval, and the symbols of the
   transform in it are the words that extend the pattern on one side.  The
   interval in the other index moves along with it, so a pattern can grow on
   either side (``FmIndex.extend``, all patterns of a level at once).  Only
   patterns that may be frequent grow.
4. Spark sums the counts of all shards, which are exact.  Candidates, their
   cuts and the longer phrases that replace them are joins of the frequent
   phrases.  Scores are exact decimals.

Defined results: null text is empty; null language is ``und`` (and joins a
language of that name); repeated rows count each; a language without
candidates has no rows; ties in score and count are ordered by the phrase's
UTF-8 bytes; ids and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tempora.llm import grams
from tempora.session import cut_lineage

SHARD_BYTES = 3 << 20
# a cell for so many bytes of text; cells at the least and at the most (32 MB of bits per phrase size)
CELL_BYTES, MIN_CELLS, MAX_CELLS = 32, 1 << 16, 1 << 28
# cells that are sent together
PART_CELLS = 1 << 16
# parts of a language that are ranked apart before the language is
RANK_PARTS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class FmIndex:
    """Transform of ``text`` (ids, 0 separates) over suffixes sorted by their first ``depth`` ids."""

    def __init__(self, text: np.ndarray, depth: int):
        self.sigma = int(text.max(initial=0)) + 1
        key = text
        for d in range(1, depth):
            behind = np.concatenate([text[d:], np.zeros(min(d, len(text)), text.dtype)])
            key = np.unique(key.astype(np.int64) * self.sigma + behind, return_inverse=True)[1]
        order = np.argsort(key, kind="stable")
        self.bwt = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self.lf = np.empty(len(text), np.int64)
        self.lf[np.argsort(self.bwt, kind="stable")] = np.arange(len(text))

    def extend(self, low: np.ndarray, size: np.ndarray):
        """Every extension by one id of the patterns with rows ``low .. low + size - 1``.

        Returns (pattern, id, low, size, before): the new rows in this index, and how many rows of the old
        pattern go before them in the other one.
        """
        begin = np.cumsum(size) - size
        who = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(who)) + np.repeat(low - begin, size)
        key = who * self.sigma + self.bwt[row]
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(key)))
        who, word = key[at] // self.sigma, key[at] % self.sigma
        real = word > 0
        return (who[real], word[real], self.lf[row[at]][real], count[real], (at - begin[who])[real])


def _shards(raw: np.ndarray, offs: np.ndarray, limit: int):
    """(from byte, to byte) of about ``limit`` bytes each, cut behind a break or a document."""
    at = 0
    while at < len(raw):
        look = at + limit - 1
        end = int(offs[min(np.searchsorted(offs, look, "right"), len(offs) - 1)])
        while look < end:
            found = np.flatnonzero(_KIND[raw[look:min(look + limit, end)]] == 2)
            if len(found):
                end = look + int(found[0]) + 1
                break
            look += limit
        yield at, end
        at = end


class _Words:
    """The words of some pieces: codes into ``words``, language of each, and whether it begins a piece."""

    def __init__(self, raw: np.ndarray, border: np.ndarray, lang: np.ndarray):
        kind = _KIND[raw]
        word = kind == 0
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = border[(border > 0) & (border < len(raw))]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.n = len(start)
        doc = np.searchsorted(border, start, "right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == 2), start) + doc
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), self.n, [
            None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[word]])]).dictionary_encode()
        self.words, self.codes = coded.dictionary, coded.indices.to_numpy()
        self.lang = lang[doc].astype(np.int64)
        self.fresh = np.concatenate([[True], piece[1:] != piece[:-1]])[:self.n]

    def ids(self):
        """(text, word_of, lang_of): ids by language and word from 1, 0 before, between and behind pieces."""
        key, ids = np.unique(self.lang * len(self.words) + self.codes, return_inverse=True)
        text = np.zeros(self.n + int(self.fresh.sum()) + 1, np.int64)
        text[np.arange(self.n) + np.cumsum(self.fresh)] = ids + 1
        # id 0 has no word, so both lists have an unused first place
        return text, np.concatenate([[0], key % len(self.words)]), np.concatenate([[0], key // len(self.words)])


def _shard_words(batches, shard_bytes: int):
    """(words of a shard, hashes of its dictionary, languages, their hashes) for each shard."""
    for b in batches:
        raw, offs = grams.text_buffers(b.column(0))
        langs = b.column(1).dictionary_encode()
        code = langs.indices.to_numpy()
        for lo, hi in _shards(raw, offs, shard_bytes):
            found = _Words(raw[lo:hi], np.clip(offs, lo, hi)[:-1] - lo, code)
            if found.n:
                yield found, _hashes(found.words), langs.dictionary, _hashes(langs.dictionary)


def _hashes(strings: pa.Array) -> np.ndarray:
    raw, offs = grams.text_buffers(strings)
    # each string is one span of bytes; a space more keeps those without bytes apart
    whole = np.full(len(raw) + len(strings), 0x5F, np.uint8)
    whole[np.arange(len(raw)) + np.repeat(np.arange(len(strings)), np.diff(offs))] = raw
    at = offs + np.arange(len(offs))
    return grams.byte_spans(whole, at[:-1], at[1:])


def _cell(lang: np.ndarray, words: list[np.ndarray], cells: int) -> np.ndarray:
    """The cell of each phrase, from the hashes of its language and words."""
    h = lang
    for w in words:
        h = grams.mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return (h & np.uint64(cells - 1)).astype(np.int64)


def _may_be_frequent(docs: DataFrame, max_words: int, min_count: int, cells: int, shard_bytes: int) -> dict[int, bytes]:
    """For each size of phrase the bits of its cells, set where the sum reaches ``min_count``."""
    # sums beyond a byte need not be told apart: they pass
    least = min(min_count, 255)

    def count(batches):
        for found, word_hash, _, lang_hash in _shard_words(batches, shard_bytes):
            h, lang = word_hash[found.codes], lang_hash[found.lang]
            rows = {c: [] for c in ("size", "part", "cells", "counts")}
            inside = np.ones(found.n, bool)
            for size in range(1, max_words + 1):
                if size > 1:
                    # places whose next size - 1 words are in the same piece
                    inside = inside[:-1] & ~found.fresh[size - 1:]
                at = np.flatnonzero(inside)
                cell, n = np.unique(_cell(lang[at], [h[at + d] for d in range(size)], cells), return_counts=True)
                edge = np.flatnonzero(np.concatenate([[True], np.diff(cell // PART_CELLS) > 0, [True]])) \
                    if len(cell) else []
                for lo, hi in zip(edge[:-1], edge[1:]):
                    for c, v in zip(rows, (size, int(cell[lo]) // PART_CELLS,
                                           (cell[lo:hi] % PART_CELLS).astype(np.uint16).tobytes(),
                                           np.minimum(n[lo:hi], 255).astype(np.uint8).tobytes())):
                        rows[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["size"], pa.int32()), pa.array(rows["part"], pa.int32()),
                 pa.array(rows["cells"], pa.binary()), pa.array(rows["counts"], pa.binary())], list(rows))

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for size, part, at, n in zip(*(c.to_pylist() for c in b.columns)):
                have = sums.setdefault((size, part), np.zeros(PART_CELLS, np.uint8))
                at, n = np.frombuffer(at, np.uint16), np.frombuffer(n, np.uint8)
                have[at] = np.minimum(have[at].astype(np.uint16) + n, 255)
        for (size, part), have in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([np.packbits(have >= least, bitorder="little").tobytes()], pa.binary())],
                ["size", "part", "bits"])
    parts = max(8, min(2000, max_words * cells // PART_CELLS // 64))
    sums = docs.mapInArrow(count, "size int, part int, cells binary, counts binary") \
        .repartition(parts, "size", "part").mapInArrow(add, "size int, part int, bits binary")
    out = {size: bytearray(cells // 8) for size in range(1, max_words + 1)}
    for size, part, bits in sums.collect():
        out[size][part * PART_CELLS // 8:(part + 1) * PART_CELLS // 8] = bytes(bits)
    return {size: bytes(bits) for size, bits in out.items()}


def _count(docs: DataFrame, max_words: int, bits: dict[int, bytes], cells: int, shard_bytes: int) -> DataFrame:
    """(lang, size, phrase, a) per shard of the phrases that may be frequent; size 0 has the number of words."""
    def scan(batches):
        maps = {size: np.frombuffer(b, np.uint8) for size, b in bits.items()}

        def may(lang, words):
            cell = _cell(lang, words, cells)
            return (maps[len(words)][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1

        for found, word_hash, langs, lang_hash in _shard_words(batches, shard_bytes):
            text, word_of, lang_of = found.ids()
            hash_of, hash_of_lang = word_hash[word_of], lang_hash[lang_of]
            back = FmIndex(text[::-1].copy(), 2)
            ahead = FmIndex(text, max_words) if max_words > 2 else None
            total = np.bincount(found.lang)
            out = [(0, [], np.flatnonzero(total), total[total > 0])]
            one, n = np.arange(1, back.sigma), np.diff(back.first)[1:]
            keep = may(hash_of_lang[one], [hash_of[one]])
            one, n, low = one[keep], n[keep], back.first[1:-1][keep]
            out.append((1, [one], lang_of[one], n))
            # pairs: words grown to the right; the rows of a pair in ``ahead`` lie within those of its first word
            who, word, _, n, before = back.extend(low, n)
            ids, low = [one[who], word], low[who] + before
            for size in range(2, max_words + 1):
                keep = np.ones(len(n), bool)
                for d in range(1, size + 1):
                    # its ends of d words have to be frequent, too
                    for part in (ids[:d], ids[size - d:]):
                        keep[keep] = may(hash_of_lang[part[0][keep]], [hash_of[x[keep]] for x in part])
                ids, low, n = [x[keep] for x in ids], low[keep], n[keep]
                out.append((size, ids, lang_of[ids[0]], n))
                if size < max_words:
                    # longer phrases: grown to the left
                    who, word, low, n, _ = ahead.extend(low, n)
                    ids = [word] + [x[who] for x in ids]
            for size, ids, lang, n in out:
                text = [found.words.take(pa.array(word_of[x])) for x in ids]
                phrase = pc.binary_join_element_wise(*text, pa.scalar(" ", pa.large_string())) if text \
                    else pa.array([""] * len(n), pa.large_string())
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(lang)).cast(pa.string()), pa.array(np.full(len(n), size, np.int32)),
                     phrase.cast(pa.string()), pa.array(n)], ["lang", "size", "phrase", "a"])
    return docs.mapInArrow(scan, "lang string, size int, phrase string, a long")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                  min_count: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, size, phrase, a): exact counts of the phrases of 1 to ``max_words`` words found ``min_count`` times.

    Size 0 has the number of words of each language.
    """
    docs = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = min(MAX_CELLS, max(MIN_CELLS, 1 << (size // CELL_BYTES).bit_length()))
    bits = _may_be_frequent(docs, max_words, min_count, cells, shard_bytes)
    return cut_lineage(_count(docs, max_words, bits, cells, shard_bytes).groupBy("lang", "size", "phrase")
                       .agg(F.sum("a").alias("a")).where((F.col("size") == 0) | (F.col("a") >= min_count)))


def _sub(first, words):
    return F.concat_ws(" ", F.slice(F.split("phrase", " "), first, words))


def best_phrases(counts: DataFrame, cover: tuple[int, int], top: int) -> DataFrame:
    """The ranked phrases of a table of ``phrase_counts``, see ``collocations``."""
    parts = counts.where("size > 0")
    phrases = parts.where("size > 1")
    cuts = phrases.select("lang", "phrase", "size", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("cut")) \
        .withColumn("left", _sub(F.lit(1), F.col("cut"))) \
        .withColumn("right", _sub(F.col("cut") + 1, F.col("size") - F.col("cut")))
    side = lambda p, n: parts.select("lang", F.col("phrase").alias(p), F.col("a").alias(n))
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    best = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]) \
        .withColumn("_up", (exact("a") * exact("a") * F.lit(10 ** 6).cast("decimal(7,0)")).cast("decimal(38,0)")) \
        .withColumn("_low", exact("l") * exact("r")) \
        .withColumn("score", F.expr("cast(_up div _low as bigint)")) \
        .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    # the largest count of a longer phrase around each shorter one
    inner = phrases.where("size > 2").select("lang", "phrase", "size", "a", F.explode(
        F.expr("flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), f -> named_struct('f', f, 'w', w))))")
    ).alias("s")).select("lang", _sub(F.col("s.f"), F.col("s.w")).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    num, den = cover
    left = best.join(inner, ["lang", "phrase"], "left") \
        .where(F.col("longer").isNull() | (den * F.col("longer") < num * F.col("a"))) \
        .select("lang", "phrase", "a", "m.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ranked = left.withColumn("part", part) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .where(F.col("rank") <= top) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score",
                                            F.col("cut").cast("long").alias("cut"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                 min_count: int = 10, cover: tuple[int, int] = (50, 100), top: int = 2000,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words per language: lang, rank, phrase, a, l, r, n, score, cut.

    The score is the lowest of ``floor(10**6 a a / (l r))`` over the cuts in two parts with l and r
    occurrences.  Phrases inside a longer one with ``cover`` of their occurrences are left out.
    """
    return best_phrases(phrase_counts(docs, text_col, lang_col, max_words, min_count, shard_bytes), cover, top)


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, unnest(flatten(list_transform(range(1, 4), lambda d:
    list_transform(range(1, len(w) - d + 2), lambda i: {'size': d, 'p': w[i:i + d - 1]})))) AS x
  FROM words),
counts AS (SELECT lang, x.size AS size, x.p AS p, count(*) AS a FROM phrases GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
cand AS (SELECT * FROM counts WHERE size > 1 AND a >= 10),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.p, c.size, c.a, k, u.a AS l, v.a AS r,
    (1000000::HUGEINT * c.a * c.a) // (u.a::HUGEINT * v.a) AS score
  FROM cuts c JOIN counts u ON u.lang = c.lang AND u.p = c.p[1:k]
  JOIN counts v ON v.lang = c.lang AND v.p = c.p[k + 1:]),
best AS (SELECT * FROM scored
         QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand c WHERE b.size = 2 AND c.size = 3 AND c.lang = b.lang
    AND (c.p[1:2] = b.p OR c.p[2:3] = b.p) AND 100 * c.a >= 50 * b.a)),
ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score, k AS cut
FROM ranked JOIN total USING (lang)
QUALIFY rank <= 2000
"""
