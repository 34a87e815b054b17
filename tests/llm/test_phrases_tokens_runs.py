"""Operators 11 to 13 against brute force, the tokenizer library and on awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tempora.llm import collocations, periodic, queries, token_counts

SF = "/root/testdata/sf0.001"
BPE = queries.BYTE_BPE
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, size string, rank string, phrase string, "
          "runs string, steps string, `a.b` int")


def frame(spark, rows):
    """(doc_id, text, lang) rows with extra columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, x, None, "s", "r", None, "q", "w", 1) for i, t, x in rows], SCHEMA)


# operator 11

def phrases_brute(rows, min_count=10, max_words=3, top=2000, cover=(50, 100)):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for d in range(1, max_words + 1):
                counts["und" if lang is None else lang].update(tuple(w[i:i + d]) for i in range(len(w) - d + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        longer = collections.Counter()
        for p, c in cand.items():
            for d in range(2, len(p)):
                for i in range(len(p) - d + 1):
                    longer[p[i:i + d]] = max(longer[p[i:i + d]], c)
        rest = []
        for p, a in cand.items():
            if longer[p] and cover[1] * longer[p] >= cover[0] * a:
                continue
            score, k = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rest.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], k))
        for rank, (s, a, p, left, right, k) in enumerate(sorted(rest)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s, k))
    return sorted(out)


def phrase_rows(seed=3, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "d'd", "Éa", "éa", "x\xa0y", "z-z", "1", "日本", "\x1f"]
    seps = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "; ", "!", "?\r\n", ":"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "en", "en", "fr", None, "und", ""])) for i in range(n)]
    return rows + [(None, None, "en"), (None, None, None), (1, "", "xx"), (2, " ., \n", "yy"), rows[0], rows[0],
                   (7, "a b c " * 3000, "en"), (8, "solo " * 200, "de"), (9, "solo." * 200, "nl")]


@pytest.mark.parametrize("shard_bytes,words,least,top", [(1 << 22, 3, 10, 2000), (50, 3, 3, 7), (400, 4, 5, 50), (300, 2, 2, 9)])
def test_phrases_against_brute_force(spark, shard_bytes, words, least, top):
    rows = phrase_rows()
    got = collocations.collocations(frame(spark, rows).repartition(4), max_words=words, min_count=least, top=top,
                                    shard_bytes=shard_bytes)
    assert sorted(map(tuple, got.collect())) == phrases_brute(rows, least, words, top)


def test_phrases_of_an_empty_table(spark):
    assert collocations.collocations(frame(spark, []), min_count=1).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None), (2, "one", "en")]), min_count=1).count() == 0


def test_cells_that_all_pass_change_nothing(spark, monkeypatch):
    rows = phrase_rows(4, 60)
    monkeypatch.setattr(collocations, "_may_be_frequent", lambda d, words, n, cells, size: {
        k: b"\xff" * (cells // 8) for k in range(1, words + 1)})
    got = collocations.collocations(frame(spark, rows), min_count=4, top=30)
    assert sorted(map(tuple, got.collect())) == phrases_brute(rows, 4, 3, 30)


@pytest.mark.parametrize("least", [2, 300])
def test_cells_never_miss_a_frequent_phrase(spark, least):
    rows = phrase_rows(6, 120)
    docs = frame(spark, rows).selectExpr("text", "coalesce(lang, 'und') lang")
    bits = collocations._may_be_frequent(docs, 2, least, collocations.MIN_CELLS, 500)
    counts = collocations.phrase_counts(frame(spark, rows), max_words=2, min_count=least).where("size > 0").collect()
    import pyarrow as pa
    hashed = lambda x: collocations._hashes(pa.array([x], pa.large_string()))
    assert counts
    for r in counts:
        cell = int(collocations._cell(hashed(r.lang), [hashed(w) for w in r.phrase.split(" ")], collocations.MIN_CELLS)[0])
        assert bits[r.size][cell >> 3] >> (cell & 7) & 1


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    counts = [("en", 0, "", 9 * big), ("en", 1, "x", big), ("en", 1, "y", 2 * big), ("en", 2, "x y", big - 1)]
    frame_ = spark.createDataFrame(counts, "lang string, size int, phrase string, a long")
    got = collocations.best_phrases(frame_, (50, 100), 5).collect()
    assert [tuple(r)[-2] for r in got] == [10 ** 6 * (big - 1) ** 2 // (big * 2 * big)]


def test_fm_index_extends_both_ways():
    rng = np.random.default_rng(1)
    text = np.concatenate([[0], rng.integers(0, 4, 300), [0]]).astype(np.int64)
    ahead, back = collocations.FmIndex(text, 3), collocations.FmIndex(text[::-1].copy(), 3)
    t = text.tolist()
    count = lambda p: sum(t[i:i + len(p)] == p for i in range(len(t)))
    one = np.arange(1, 4)
    n = np.diff(ahead.first)[1:]
    who, word, low_b, size, before = back.extend(back.first[1:-1], n)
    pairs = [[int(one[w]), int(x)] for w, x in zip(who, word)]
    assert [count(p) for p in pairs] == size.tolist()
    low = ahead.first[1:-1][who] + before
    who, word, _, size, _ = ahead.extend(low, size)
    assert [count([int(x)] + pairs[w]) for w, x in zip(who, word)] == size.tolist()
    assert len(size) == len({tuple(t[i:i + 3]) for i in range(len(t) - 2) if 0 not in t[i:i + 3]})


# operator 12

TRICKY = ["", " ", "a", "don't we're they'll I'd 'tis ''s x'rex", "  two  spaces  ", "a\n\n b \t c\n", "<|endoftext|>",
          " <|endoftext|> x", "a<|endoftext|><|endoftext|>b", "<|endoftex <|endoftext|", "ééé 日本語 😀😀 ​\xa0 x",
          "1234567 12,5 ?!?! ...", "\x1c\x85　z", "aaaaaaaaaaaaaaaaaaaaaaaa", "\r\n\r\n", " 's 'll\n'll  've"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    return lambda s: len(tok.encode(s, add_special_tokens=False).ids)


def test_every_prefix_has_the_librarys_count(library):
    rng = random.Random(2)
    letters = ["a", "the", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "é", "日本", "1", "22", "!", "<|endoftext|>",
               "<|endo", "ft", "\xa0", "\x1c", "😀", "qzx", "०"]
    texts = TRICKY + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 15))) for _ in range(300)]
    table = token_counts.Prefixes(BPE)
    for text in texts:
        steps = table.steps(text)
        steps = steps if isinstance(steps, np.ndarray) else np.frombuffer(steps, np.int8)
        assert [0, *np.cumsum(steps, dtype=np.int64).tolist()] == [library(text[:i]) for i in range(len(text) + 1)], text


def test_token_store_and_answers(spark, library):
    rows = [(i, t, None) for i, t in enumerate(TRICKY)] + [(None, None, None), (3, "x " * 30_000 + "y" * 30_000, None),
                                                          (0, "", None), (5, "again", "en"), (5, "again", "en")]
    store = token_counts.prefix_counts(frame(spark, rows), BPE).cache()
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(t or ""), library(t or "")) for i, t, _ in rows)
    assert sorted((r[0] if r[0] is not None else -1, *r[1:4]) for r in store.collect()) == want
    short = {i: t for i, t in enumerate(TRICKY) if i not in (0, 3, 5)}
    for r in token_counts.answer(store, [0, 4, 10 ** 9], [0, 2, 5]).collect():
        if r.doc_id in short:
            t = short[r.doc_id]
            n = [library(t[:i]) for i in range(len(t) + 1)]
            assert r.tokens_at == [0, n[min(4, len(t))], n[-1]]
            assert r.fits == [max(i for i, c in enumerate(n) if c <= b) for b in (0, 2, 5)]
    assert token_counts.prefix_counts(frame(spark, []), BPE).count() == 0


def test_steps_beyond_a_byte_are_listed(spark, monkeypatch):
    monkeypatch.setattr(token_counts.Prefixes, "chars", lambda self, u: [0] + list(range(300, 300 - len(u), -1)))
    monkeypatch.setattr(token_counts, "_made", {})
    table = token_counts.Prefixes(BPE)
    assert table.steps("ab cd").tolist() == [300, -1, 300, -1, -1]
    assert token_counts.counts(np.array([-128, -1, -128, -1, -1], np.int8).tobytes(), [
        {"at": 0, "step": 300}, {"at": 2, "step": 300}]).tolist() == [0, 300, 299, 599, 598, 597]


def test_token_query_on_the_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_token_counts(spark, SF).collect()}
    assert got == {d.doc_id: (len(d.text.encode()), n := library(d.text), n > 1024) for d in docs}


# operator 13

def runs_brute(w, least=24, exponent=3):
    """(start, period, length) of all runs, by comparing every place with the one q on."""
    found = {}
    n = len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, q, length) for (s, length), q in found.items())


def collapse_brute(w, runs):
    gone = {x for s, q, length in runs for x in range(s + q, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def periodic_texts(seed=9, n=250):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        vocab = rng.choice(["a", "ab", "abc", "abcdefgh"])
        words = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60]))]
            m = rng.choice([1, 2, 2.9, 3, 3, 3.1, 4, 7.5, 12])
            words += (unit * 13)[:int(len(unit) * m)]
            words += [rng.choice(vocab + "xyz") for _ in range(rng.randint(0, 9))]
        out.append(rng.choice([" ", "\n", "\t \x0b"]).join(words))
    return out


def test_runs_against_brute_force(spark):
    texts = periodic_texts()
    rows = [(i, t, None) for i, t in enumerate(texts)] + [
        (None, texts[0], None), (None, None, None), (1000, "", None), (1001, " \n", None), (5, texts[7], None),
        (6, texts[6], None), (1002, "w " * 9000, None), (1003, " ".join(f"w{i % 1500}" for i in range(7000)), None),
        (1004, " ".join(map(str, range(3000))), None)]
    # the slow brute force of the long ones is known
    known = {1002: [(0, 1, 9000)], 1003: [(0, 1500, 7000)], 1004: []}
    want = []
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        runs = known[i] if i in known else runs_brute(w)
        kept = collapse_brute(w, runs)
        want.append((str(i), len(w), runs, len(w) - len(kept), " ".join(kept)))
    got = [(str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.n_dropped, r.kept_text)
           for r in periodic.collapse(frame(spark, rows).repartition(3)).collect()]
    assert sorted(got) == sorted(want)
    few = frame(spark, rows[:60])
    assert sorted(map(tuple, periodic.find_runs(few).collect())) == sorted(
        {(i, *r) for i, t, _ in rows[:60] for r in runs_brute(WORD.findall(t))})
    assert periodic.collapse(frame(spark, [])).count() == 0


@pytest.mark.parametrize("least,exponent", [(12, 3), (40, 4), (100, 3)])
def test_runs_with_other_bounds(spark, least, exponent):
    rows = [(i, t, None) for i, t in enumerate(periodic_texts(11, 60))]
    got = {r.doc_id: [tuple(x) for x in r.runs]
           for r in periodic.collapse(frame(spark, rows), min_length=least, exponent=exponent).collect()}
    assert got == {i: runs_brute(WORD.findall(t), least, exponent) for i, t, _ in rows}


def test_small_tiles_stitch_to_whole_runs(spark, monkeypatch):
    text = " ".join(["q"] + [f"w{i % 37}" for i in range(4000)] + ["z"] + [f"v{i % 5}" for i in range(500)])
    word, first = np.arange(1, 2, dtype=np.uint64), np.array([0, 1])
    assert list(periodic.points(word, first, 24, 3)) == []
    got = periodic.collapse(frame(spark, [(1, text, None)])).first()
    assert [tuple(x) for x in got.runs] == [(1, 37, 4000), (4002, 5, 500)]
    assert periodic._tiles(periodic._keyed(frame(spark, [(1, text, None)]), "doc_id", "text").select("a", "b", "text"),
                           24, 3).where("step = 32").count() > 0


def digests(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(w)
    best = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, q, length in runs)), sha(" ".join(collapse_brute(w, runs))))


def test_runs_query_on_the_table(spark):
    docs = [d for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        if len(WORD.findall(d.text)) < 1500:
            assert got[d.doc_id] == digests(d.doc_id, d.text)


def test_period_texts_of_odd_rows(spark, tmp_path):
    rows = [(None, "a b"), (5, None), (6, ""), (7, " \n "), *((i, "a b c d e f g h i j k l " * 4) for i in range(100, 160))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    none = ("", "a b")
    want = [digests(i, t) for i, t in rows if i is not None] + [
        (None, 0, None, None, None, None, *(hashlib.sha256(s.encode()).hexdigest() for s in none))]
    assert got == sorted(want, key=str)
