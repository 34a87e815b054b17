"""Queries without SQL over their whole small tables, against plain Python."""

import collections
import math
import re
import zlib
from fractions import Fraction

import zstandard as zstd
from pyspark.sql import functions as F

from tempora.llm import langid, quality, queries

SF, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_op1_targets_and_words_taken(spark):
    docs = {r.doc_id: (r.source, len(WORD.findall(r.text or "")))
            for r in spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "source", "text").collect()}
    got = {r.doc_id: r for r in queries.op1_source_mixing(spark, MORE).collect()}
    assert got.keys() == docs.keys()
    sizes = collections.Counter()
    for s, n in docs.values():
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, free = Fraction(3 * sum(sizes.values()), 2), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        for s in over or free:
            target[s] = Fraction(2 * sizes[s]) if over else share[s]
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    taken, most = collections.Counter(), {s: 1 if target[s] <= sizes[s] else 2 for s in order}
    for i, (s, n) in docs.items():
        r = got[i]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and math.isclose(r["target"], target[s], rel_tol=1e-9)
        assert r["taken"] <= most[s] * n and (not n or r["taken"] % n == 0)
        taken[s] += r["taken"]
    for s in order:
        gap = target[s] - taken[s]
        # no document that could still be taken fits the words missing
        assert gap >= 0 and not [i for i, (x, n) in docs.items() if x == s and 0 < n <= gap and got[i]["taken"] < most[s] * n]


def test_op4_against_every_window(spark):
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.start, r.similarity) for r in queries.op4_decontamination(spark, SF).collect()}
    want = {}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = norm(d.text)
        of = {k: [tuple(w[a:a + k]) for a in range(len(w) - k + 1)] for k in range(1, 6)}
        sets = {k: set(v) for k, v in of.items()}
        for item, b in items:
            k = min(5, len(b))
            y = collections.Counter(tuple(b[a:a + k]) for a in range(len(b) - k + 1))
            if not b or not w or sets[k].isdisjoint(y):
                continue  # no window has a common shingle: similarity 0
            size = min(len(b), len(w))
            wide = size - k + 1
            for s in range(len(w) - size + 1):
                x = collections.Counter(of[k][s:s + wide])
                over = sum((x & y).values())
                total = sum(x.values()) + sum(y.values()) - over
                if over and 100 * over >= 75 * total and over / total > want.get((d.doc_id, item), (0, 0))[1]:
                    want[d.doc_id, item] = (s, over / total)
    assert want and got == want


def _plain_rules(rows, quantiles=24, max_rules=8, max_conditions=3, min_precision=0.9, min_covered=3):
    """Sequential covering row by row; rows are (grow, bad, {feature: value})."""
    ends = {}
    for bad in (True, False):
        mine = [v for g, b, v in rows if g and b == bad]
        for f in quality.FEATURES:
            s = sorted(v[f] for v in mine)
            ends[bad, f] = [s[max(0, math.ceil(q * len(s) / quantiles) - 1)] for q in range(quantiles + 1)]
    cuts = {}
    for f in quality.FEATURES:
        v = sorted({*ends[True, f], *ends[False, f]})
        cuts[f] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    holds = lambda rule, v: all((v[f] > c) == above for f, c, above in rule)
    rules, banned = [], set()
    rows = list(rows)
    while len(rules) < max_rules:
        rule = []
        while len(rule) < max_conditions:
            part = [(b, v) for g, b, v in rows if g and holds(rule, v)]
            p0 = sum(b for b, _ in part)
            if not p0 or p0 == len(part):
                break
            best = (0.0, None)
            for f in quality.FEATURES:
                for above in (True, False):
                    for c in () if not rule and (f, above) in banned else cuts[f]:
                        hit = [b for b, v in part if (v[f] > c) == above]
                        if sum(hit) and len(hit) < len(part):
                            gain = sum(hit) * (math.log2(sum(hit) / len(hit)) - math.log2(p0 / len(part)))
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, c, above))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            hit = [b for g, b, v in rows if not g and holds(rule[:k], v)]
            p, n = sum(hit), len(hit) - sum(hit)
            worth.append((round((p - n) / max(1, p + n), 3), p, -k, n))
        _, p, k, n = max(worth)
        if p < min_covered or p < min_precision * (p + n):
            banned.add((rule[0][0], rule[0][2]))
            continue
        rules.append(rule[:-k])
        rows = [r for r in rows if not holds(rules[-1], r[2])]
    return rules


def test_op5_rules_are_those_of_plain_sequential_covering(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    sample = quality.word_stats(quality.labelled_sample(docs, labels, "doc_id", 20_000)).select("row.bad", *quality.STATS)
    rows = sample.select((F.pmod(F.xxhash64(*quality.STATS), F.lit(3)) < 2).alias("grow"), "bad",
                         *(F.expr(e).alias(f"f_{f}") for f, e in quality.FEATURES.items())).collect()
    plain = _plain_rules([(r.grow, r.bad, {f: r[f"f_{f}"] for f in quality.FEATURES}) for r in rows])
    assert plain and quality.learn_rules(sample) == plain


def test_op9_is_the_smallest_of_plain_encodings(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    learned = langid.learn(spark.read.parquet(f"{SF}/documents.parquet").where("crc32(cast(doc_id as string)) % 4 <> 2"))
    level = dict(min_match=3, strategy=zstd.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False)
    pack = {lang: zstd.ZstdCompressor(
        dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT),
        compression_params=zstd.ZstdCompressionParameters.from_level(3, dict_size=len(d), **level)) for lang, d in learned.items()}
    got = {r.doc_id: r for r in queries.op9_language_id(spark, SF).collect()}
    assert got.keys() == rows.keys()
    for i, text in rows.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not re.search(r"[^\W\d_]", text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        data, size = re.sub(r"[\W\d_]+", " ", text.lower()).encode(), collections.Counter()
        while data:
            cut = len(data)
            if cut > 6144:   # at the first space of the segment's last third, else after 4,096 bytes
                cut = data.find(b" ", 4096, 6144)
                cut = 4096 if cut < 0 else cut
            for lang in learned:
                size[lang] += len(pack[lang].compress(data[:cut]))
            data = data[cut:]
        assert got[i].lang_pred == min(learned, key=lambda x: size[x])   # of equals the first learned
        two = sorted(size.values())[:2]
        assert math.isclose(got[i].score, min(1.0, 0.5 + 5 * (1 - two[0] / two[1])))
