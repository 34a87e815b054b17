"""Operator 9: language identification by compression.

Per language a Zstandard raw-content dictionary holds text of that language.
A text is encoded with every dictionary; the language whose frames are
smallest is chosen.  Long texts are encoded in segments, each a frame of its
own, so that the dictionary and not the text's own beginning explains it;
all segments of the whole text count.  Texts and dictionaries are lower-cased
and runs without letters become one space; the encoder takes matches from
three bytes with the optimal parser, as languages differ in short strings.

Training takes at most about ``max_rows`` labelled rows per language, by hash
of id and text, rows alike in both once.  Of each it takes ``row_chars``
characters from a hashed position, cut to an equal share of ``DICT_BYTES``;
what short pieces leave of their share goes to longer ones.  ``max_rows``,
``row_chars`` and ``DICT_BYTES`` (16 KB, the size of a dictionary) are the
documented bounds.  Prediction covers every row.

The margin is the saving of the best language over the next, as a share of
the next one's size; ``score`` maps it to 0.5 .. 1.  Below ``min_margin``
the operator rejects: ``und``, score kept.  Rejecting is off by default
(``min_margin`` 0), so that a tie still gets a language.

Defined results: null text and text without a letter are ``und`` with score
0; ties go to the language with more training rows, then by code point order;
one learned language always wins with score 1; without training rows all is
``und``.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DICT_BYTES = 16 << 10
SEGMENT_BYTES = 4096
MAX_LANGUAGES = 1000
_NO_LETTERS = re.compile(r"[\W\d_]+")


def _normal(text: str) -> bytes:
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def _shares(pieces: list[bytes], size: int) -> list[bytes]:
    """The pieces, in order, cut to equal shares of ``size`` bytes with the spaces between them."""
    left, most = size - len(pieces) + 1, {}
    for done, i in enumerate(sorted(range(len(pieces)), key=lambda i: len(pieces[i]))):
        most[i] = min(len(pieces[i]), max(0, left // (len(pieces) - done)))
        left -= most[i]
    # a character cut apart goes
    return [p[:most[i]].decode(errors="ignore").encode() for i, p in enumerate(pieces)]


def learn(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_rows: int = 100, row_chars: int = 200) -> dict[str, bytes]:
    """A raw-content dictionary per language, the most frequent one first; ``rows`` are the training rows."""
    rows = rows.where(f"`{lang_col}` is not null and `{text_col}` is not null") \
        .select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"),
                F.xxhash64(F.col(f"`{id_col}`").cast("string"), f"`{text_col}`").alias("key")).where("text rlike '\\\\p{L}'")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # about max_rows rows per language: rows whose hash falls under the language's share
    share = F.create_map(*(x for r in counts for x in (
        F.lit(r["lang"]), F.lit(min(1.0, max_rows / r["count"])))))
    start = F.pmod(F.xxhash64("key"), F.greatest(F.lit(1), F.length("text") - row_chars + 1)) + 1
    part = rows.where(F.pmod("key", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)) \
        .select("lang", "key", F.col("text").substr(start.cast("int"), F.lit(row_chars)).alias("text")) \
        .groupBy("lang", "key").agg(F.min("text").alias("text"))
    out = {}
    for r in part.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("t")).collect():
        out[r["lang"]] = b" ".join(_shares([_normal(x["text"]).strip() for x in r["t"]], DICT_BYTES))
    often = {r["lang"]: r["count"] for r in counts}
    return {lang: out[lang] for lang in sorted(out, key=lambda x: (-often[x], x))}


def _segments(data: bytes) -> list[bytes]:
    """Pieces of about SEGMENT_BYTES that end at a space where there is one."""
    out, at = [], 0
    while len(data) - at > SEGMENT_BYTES + SEGMENT_BYTES // 2:
        cut = data.find(b" ", at + SEGMENT_BYTES, at + SEGMENT_BYTES + SEGMENT_BYTES // 2)
        cut = cut if cut >= 0 else at + SEGMENT_BYTES
        out.append(data[at:cut])
        at = cut
    return [*out, data[at:]]


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
            extra: tuple[str, ...] = (), min_margin: float = 0.0, level: int = 3) -> DataFrame:
    """id, the ``extra`` columns, lang_pred, score and margin of every row."""
    keep = [id_col, *extra]

    def classify(batches):
        import zstandard as zstd
        langs = list(dictionaries)
        packers = []
        for lang in langs:
            words = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            how = zstd.ZstdCompressionParameters.from_level(
                level, dict_size=len(dictionaries[lang]), min_match=3, strategy=zstd.STRATEGY_BTOPT,
                write_content_size=False, write_checksum=False, write_dict_id=False)
            packers.append(zstd.ZstdCompressor(dict_data=words, compression_params=how).compress)
        for b in batches:
            preds, scores, margins = [], [], []
            for text, letter in zip(b.column("_t").to_pylist(), b.column("_letter").to_pylist()):
                if not letter or not langs:
                    preds.append("und")
                    scores.append(0.0)
                    margins.append(0.0)
                    continue
                parts = _segments(_normal(text))
                # a stable sort: ties keep the order of the dictionaries
                sizes = sorted(((sum(len(pack(p)) for p in parts), lang) for pack, lang in zip(packers, langs)),
                               key=lambda x: x[0])
                margin = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
                preds.append(sizes[0][1] if margin >= min_margin else "und")
                scores.append(min(1.0, 0.5 + 5 * margin))
                margins.append(margin)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                                               pa.array(margins, pa.float64())],
                [*keep, "lang_pred", "score", "margin"])
    text = F.col(f"`{text_col}`").cast("string")
    df = docs.select(*(F.col(f"`{c}`") for c in keep), text.alias("_t"),
                     F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        "lang_pred string", "score double", "margin double"])
    return df.mapInArrow(classify, schema)
