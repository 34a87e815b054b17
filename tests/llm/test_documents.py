"""Operators 1-5, 8 and 9 against brute force, on awkward rows and on the small table."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from tempora.llm import decontaminate, langid, mixing, ngram_join, quality, sharding, substring

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, `odd.name` int"


def make(n=120, seed=5):
    """Rows with nulls, empty texts, copies, near copies, shared passages, repeated rows and long texts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghéü") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage, line = text(70), text(8)
    rows = [(0, None), (1, ""), (2, " \t\n\x0b"), (3, "one"), (4, "one two three four"), (5, "ONE two three FOUR"),
            (6, "   x"), (7, text(6000)), (None, text(60)), (None, None), (8, line + "\n" + line + "\n" + line)]
    for i in range(20, 20 + n):
        kind = rng.randrange(6)
        if kind == 0 and i > 25:
            t = rows[rng.randrange(11, len(rows))][1]
        elif kind == 1 and i > 25:
            w = (rows[rng.randrange(11, len(rows))][1] or "x").split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        elif kind == 2:
            t = text(rng.randint(0, 60)) + "\n" + passage + " " + text(rng.randint(0, 60))
        else:
            t = "\n".join(text(rng.randint(1, 30)) for _ in range(rng.randint(1, 6)))
        rows.append((i, t))
    rows += [rows[30], rows[30], (40, text(55))]
    src = ["a", "b", None, "c"]
    return [(i, t, None if k % 7 == 0 else "en", src[min(3, k % 9 % 4)], None, "clash", None, k)
            for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1 mixing

def test_targets_and_tree():
    goal = mixing.targets({"a": 100, "b": 100, None: 10})
    assert goal["a"] == 200 and goal[None] == 20 and goal["b"] == 95
    assert abs(sum(goal.values()) - 1.5 * 210) < 1e-9 and all(goal[s] <= 2 * n + 1e-9 for s, n in
                                                              (("a", 100), ("b", 100), (None, 10)))
    tree = mixing.split_tree([1000, 3, 0, 57], 7, seed=3)
    assert tree.sum(axis=0).tolist() == [1000, 3, 0, 57]
    assert set(tree.sum(axis=1)) <= {1060 // 7, 1060 // 7 + 1}
    assert (tree == mixing.split_tree([1000, 3, 0, 57], 7, seed=3)).all()


def test_mix(spark, rows, docs, empty):
    got = [tuple(r) for r in mixing.taken(docs).select("doc_id", "size", "source_size", "target", "copies").collect()]
    assert len(got) == len(rows)
    assert collections.Counter(r[:2] for r in got) == collections.Counter(
        (r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    by = collections.defaultdict(lambda: [0, 0, 0.0])
    for (_, size, whole, target, copies) in got:
        assert 0 <= copies <= 2
        by[whole][0] += size
        by[whole][1] += size * copies
        by[whole][2] = target
    for whole, (size, taken, target) in by.items():
        assert size == whole and abs(taken - target) <= max(60, 0.02 * target)
    again = mixing.taken(docs.repartition(3)).select("doc_id", "size", "source_size", "target", "copies").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.taken(docs).select(
        "doc_id", "size", "source_size", "target", "copies").collect())
    mixed = mixing.mix(docs, shards=3)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r[4] for r in got)
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0


# ---- 2 sharding

@pytest.mark.parametrize("share", [0.5, 1.5])
def test_mix_reaches_targets(spark, share):
    # one very long block among short ones: whatever the order, no block left out fits the words missing
    sizes = [300] * 500 + [150_000]
    df = spark.createDataFrame([(i, "w " * n, s, n) for s in "ab" for i, n in enumerate(sizes)],
                               "doc_id long, text string, source string, n long").repartition(4).cache()
    for seed in range(4):
        got = mixing.taken(df, weights=(1,), share=share, seed=seed).collect()
        for target, source in {(r["target"], r["source_size"]) for r in got}:
            took = sum(r["size"] * r["copies"] for r in got) / 2
            copies = min(r["copies"] for r in got)
            assert copies == int(share) and source == sum(sizes)
            least = min((r["size"] for r in got if r["copies"] == copies), default=0)
            assert 0 <= target - took < least, (seed, target, took)


def test_mix_deals_by_shard(spark, docs):
    mixed = mixing.mix(docs, shards=3, shard_col="size")
    assert mixed.columns == [c for c in docs.columns if c != "size"] + ["size"]
    got = mixed.rdd.mapPartitionsWithIndex(lambda i, rs: [(i, r["size"], r["doc_id"]) for r in rs]).collect()
    # a shard is one partition here, and holds what the tree deals to it
    assert len({(s, i) for i, s, _ in got}) == 3
    at = {}
    for i, s, _ in got:
        assert at.get(i, 0) <= s
        at[i] = s
    per = collections.Counter(s for _, s, _ in got)
    assert set(per) == {0, 1, 2} and max(per.values()) - min(per.values()) <= 1
    want = {(r["doc_id"], s) for r in mixing.taken(docs, shards=3).collect() for s in r["shards"] or []}
    assert {(d, s) for _, s, d in got} == want


def test_sharding(spark, rows, docs, empty):
    got = sharding.shard(docs, shards=7).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        size[r["shard"]] += r["size"]
    for s in size:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    largest = max(r["size"] for r in got)
    assert set(size) <= set(range(7)) and max(size.values()) - sum(size.values()) / 7 <= largest
    assert sharding.shard(empty, shards=7).count() == 0
    hot = spark.createDataFrame([(i, "same text") for i in range(700)], "doc_id long, text string")
    count = collections.Counter(r["shard"] for r in sharding.shard(hot, shards=7).select("shard").collect())
    assert count == {s: 100 for s in range(7)}  # one group of copies larger than a shard


# ---- 3 substrings

def removed(rows, window=50):
    first, out = {}, []
    for i, t in sorted(((r[0], r[1]) for r in rows if r[0] is not None), key=lambda x: x[0]):
        w = WORD.findall(t or "")
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j:j + window]), i)
    for r in rows:
        w = WORD.findall(r[1] or "")
        gone = set()
        if r[0] is not None:
            for j in range(len(w) - window + 1):
                if first[tuple(w[j:j + window])] < r[0]:
                    gone |= set(range(j, j + window))
        out.append((r[0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window", [50, 7])
def test_substrings(rows, docs, empty, window):
    got = substring.remove_repeats(docs, window=window).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=key) \
        == sorted(removed(rows, window), key=key)
    for r in got:  # intervals are maximal, in order and cover what is removed
        spans = [(s["first"], s["stop"]) for s in r["intervals"]]
        assert sum(b - a for a, b in spans) == r["n_removed"]
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert substring.remove_repeats(empty).count() == 0


# ---- 4 decontamination

def test_decontamination(spark, rows, docs, empty):
    rng = random.Random(1)
    long_doc = next(r[1] for r in rows if r[0] == 7).split(" ")
    item = long_doc[500:540]
    near = list(item)
    near[20] = "zzz"
    bench = [(1, " ".join(item).upper()), (2, " ".join(near[:38]) + " tail end"), (3, "one two three"), (4, None),
             (5, " "), (6, " ".join(rng.choice(long_doc) for _ in range(30))), (1, " ".join(item).upper())]
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = {}
    for d in rows:
        w = norm(d[1])
        for i, t in bench:
            b = norm(t)
            if not b:
                continue
            k = min(5, len(b))
            size = min(len(b), len(w))
            grams = lambda x: collections.Counter(tuple(x[a:a + k]) for a in range(len(x) - k + 1))
            for s in range(len(w) - size + 1):
                x, y = grams(w[s:s + size]), grams(b)
                over, total = sum((x & y).values()), sum((x | y).values())
                if over and 100 * over >= 75 * total:
                    have = want.get((d[0], i), (0,))
                    if over / total > have[0]:
                        want[d[0], i] = (over / total, s)
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"])
           for r in decontaminate.contaminated(docs, bench_df).collect()}
    assert (7, 1) in got and got == want
    left = decontaminate.clean(docs, bench_df)
    assert left.columns == docs.columns
    assert left.count() == sum(not any((r[0], i) in want for i, _ in bench) for r in rows)
    assert decontaminate.contaminated(empty, bench_df).count() == 0
    assert decontaminate.contaminated(docs, bench_df.limit(0)).count() == 0


# ---- 5 quality

def stats(t):
    w = WORD.findall(t or "")
    seen, dup = set(), 0
    for x in (t or "").split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    five = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover))


def test_quality_stats(spark, rows, docs, empty):
    more = [(900, "a b c d e a b c d e f", *rows[0][2:]), (901, "x " * 40, *rows[0][2:]),
            (902, "# $a %\n# $a %\n\n\n&|<> *", *rows[0][2:]), (903, "a b c d e f\na b c d e g", *rows[0][2:])]
    got = quality.word_stats(docs.union(spark.createDataFrame(more, SCHEMA))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["row"]["doc_id"], *(r[n] for n in names)) for r in got), key=key) == sorted(
        ((r[0], *stats(r[1])) for r in rows + more), key=key)
    assert quality.word_stats(empty).count() == 0


def test_quality_rules(spark, docs, empty):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    none = labels.limit(0)
    assert {r["kept"] == (not r["base_failed"]) for r in quality.judge(docs, none).collect()} == {True}
    assert quality.judge(empty, labels).count() == 0
    rules = [[("symbol_share", 0.05, True)], [("repeat_share", 0.5, True), ("n_words", 20.0, True)]]
    kept = quality.word_stats(table).withColumn("k", quality.verdict(rules))
    for r in kept.collect():
        bad = r["word_chars"] and r["n_symbols"] / r["word_chars"] > 0.05 or \
            r["n_words"] > 20 and r["n_repeat_words"] / r["n_words"] > 0.5
        assert r["k"] == (not bad)
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(big, marks).selectExpr("row.doc_id", "base_failed", "kept").join(marks, "doc_id").collect()
    assert all(r["kept"] for r in judged if r["quality"] == 1 and not r["base_failed"])
    assert not any(r["kept"] for r in judged if r["quality"] == 0)
    assert quality.keep_good(docs, marks).columns == docs.columns


# ---- 8 Jaccard join

def components(rows):
    sets = []
    for r in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        w = WORD.findall(w)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], len(s), None if r[0] is None else low[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def test_jaccard(spark, rows, docs, empty):
    key = lambda x: tuple(map(str, x))
    got = [tuple(r) for r in ngram_join.jaccard_components(docs).collect()]
    assert sorted(got, key=key) == sorted(components(rows), key=key)
    assert ngram_join.jaccard_components(empty).count() == 0
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    want = {r[0] for r in components(rows) if r[0] is not None and r[0] == r[2]}
    assert {r["doc_id"] for r in left.collect()} == want | {None}


def test_one_of_each_group(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(100))
    near = lambda x: text(x) + " more"
    rows = [(1, text("a"), 0), (2, near("a"), 1), (2, text("b"), 2), (3, near("b"), 3),  # id 2: a copy, and a leader
            (4, text("c"), 4), (4, near("c"), 5), (4, text("c").upper(), 6),  # one id, alike texts
            (None, text("a"), 7), (None, text("d"), 8), (None, text("d"), 9), (None, near("d"), 10),
            (None, text("e"), 11), (5, "", 12), (6, None, 13), (None, "", 14), (5, "", 15), (0, text("f"), 16)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    got = [tuple(r) for r in ngram_join.one_of_each(df).collect()]
    groups = [{0, 1, 7}, {2, 3}, {4, 5, 6}, {8, 9, 10}, {11}, {12, 15}, {13}, {14}, {16}]
    kept = [n for *_, n in got]
    assert sorted(map(len, [g & set(kept) for g in groups])) == [1] * len(groups) and len(kept) == len(groups)
    assert {0, 2, 13, 14, 16} <= set(kept)


def test_jaccard_chain_and_group(spark):
    """A chain of copies whose ends do not link, and a group of near copies around no common source."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows, now = [], list(base)
    for i in range(12):
        now = list(now)
        at = 15 * i
        now[at] = f"n{i}"
        rows.append((100 - i, " ".join(now)))
    for i in range(60):
        w = [f"g{k}" for k in range(150)]
        for _ in range(4):
            w[rng.randrange(150)] = f"x{rng.random()}"
        rows.append((200 + i, " ".join(w)))
    got = [tuple(r) for r in ngram_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(components(rows))


def test_rest_pairs(spark):
    """The last round makes the allowed pairs of different labels, and no others of a hot column."""
    rng = random.Random(4)
    num, den = 75, 100
    posts = {(rng.randrange(3), f"{i:03d}".encode()): (n, rng.randrange(6), f"{rng.choice([i, i, 0]):03d}".encode())
             for i, n in ((i, rng.randint(4, 24)) for i in range(120))}
    rows = [(g, node, n, pos, label) for (g, node), (n, pos, label) in posts.items()]
    schema = "g long, node binary, n long, pos long, label binary"
    want = set()
    for g, a, na, pa, la in rows:
        for h, b, nb, pb, lb in rows:
            need = -(-num * (na + nb) // (num + den))
            if g == h and a < b and la != lb and den * min(na, nb) >= num * max(na, nb) and \
                    pa <= na - need and pb <= nb - need:
                want.add((a, b))
    got = [(bytes(r["a"]), bytes(r["b"])) for r in ngram_join._rest_pairs(
        spark.createDataFrame(rows, schema), num, den).collect()]
    assert want and len(got) == len(want) and set(got) == want
    # two hundred thousand entries in one column: of short templates, and of one component but for one entry
    ids = spark.range(200_000)
    short = ids.selectExpr("1L as g", "cast(cast(id as string) as binary) as node", "4L as n", "1L as pos",
                           "cast(cast(id as string) as binary) as label")
    assert ngram_join._rest_pairs(short, num, den).count() == 0
    group = ids.selectExpr("1L as g", "cast(cast(id as string) as binary) as node", "40L as n", "0L as pos",
                           "cast(cast(least(id, 1) as string) as binary) as label")
    assert ngram_join._rest_pairs(group, num, den).count() == 199_999


def test_jaccard_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    assert sorted(tuple(r) for r in ngram_join.jaccard_components(table).collect()) == sorted(components(rows))


# ---- 9 language

def test_language(spark, docs, rows, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") \
        .selectExpr("*", "crc32(cast(doc_id as string)) % 4 = 2 as held")
    learned = langid.learn(table.where("not held"))
    assert set(learned) == {r["lang"] for r in table.where("lang is not null").select("lang").distinct().collect()}
    got = langid.predict(table, learned, extra=("held", "lang")).collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    even = spark.createDataFrame([(1, "b", "xx"), (2, "a", "xx"), (3, "b", "xx")], "doc_id long, lang string, text string")
    assert list(langid.learn(even)) == ["b", "a"]
    tie = langid.predict(even, {"b": b"xx", "a": b"xx"}).first()
    assert tie["lang_pred"] == "b" and tie["score"] == 0.5
    odd = langid.predict(docs, learned).collect()
    assert len(odd) == len(rows) and all(0 <= r["score"] <= 1 for r in odd)
    none = {r[0] for r in rows if r[0] is not None and not re.search(r"[^\W\d_]", r[1] or "")}
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und" and r["doc_id"] is not None} == none
    assert langid.learn(empty) == {} and langid.predict(empty, learned).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, {}).collect()} == {"und"}
    sure = langid.predict(table, learned, min_margin=0.05).collect()
    assert any(r["lang_pred"] == "und" for r in sure)


def test_language_training_sample(spark):
    # rows share a heading; each has a name of its own in the text, in letters of three bytes
    name = lambda i: "".join(chr(0x0905 + int(c)) for c in f"{i:04d}")
    text = lambda i: "common heading " * 20 + f"{name(i)} " * 200
    learned = langid.learn(spark.createDataFrame([(i, "a", text(i)) for i in range(90)],
                                                 "doc_id long, lang string, text string"))
    assert len(learned["a"]) <= langid.DICT_BYTES
    found = learned["a"].decode()
    # pieces come from anywhere in a row and every sampled row has its share
    assert sum(name(i) in found for i in range(90)) >= 75
    # null or repeated ids are sampled like others
    for ident in (None, 5):
        df = spark.createDataFrame([(ident, "a", f"x{name(i)}x") for i in range(2000)] + [(ident, "a", "again")] * 2000,
                                   "doc_id long, lang string, text string")
        assert 30 <= len(langid.learn(df)["a"].split()) <= 90
    assert langid._shares([b"abcdef", b"a", "éé".encode()], 9) == [b"abc", b"a", "é".encode()]


def test_queries_over_the_table(spark):
    from tempora.llm import queries
    got = {r["doc_id"]: r for r in queries.op3_substring_dedup(spark, SF).collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for i, n, gone, kept in removed(rows):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (
            n, gone, hashlib.sha256(kept.encode()).hexdigest())
    for r in queries.op2_byte_sharding(spark, SF).join(
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        assert r["text_crc32"] == zlib.crc32(r["text"].encode()) and r["grown_shard"] is None
