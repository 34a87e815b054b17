"""Operator 5: quality rules as a learned decision list, in DataFrame functions only.

``word_stats`` computes the statistics of every whole text inside its row:
no shuffle, one scan.  ``learn_rules`` fits an ordered list of threshold
conjunctions by sequential covering: each rule grows one condition at a time
by information gain on two thirds of the labelled rows, is cut back while
that helps on the other third, and the rows it covers leave both sets.  Only
counts per feature and threshold reach the driver.  ``verdict`` turns the
list into one conditional expression.

Defined results: null or word-less text has all counts 0 and fails the base
rule; without usable labels the list is empty and keeps everything; several
labels of one document count by majority (ties: good); other input columns
pass through untouched, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tempora.session import cut_lineage

WINDOW = 5
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word_chars": "coalesce(try_divide(word_chars, n_words), 0D)",
    "symbol_share": "coalesce(try_divide(n_symbols, word_chars), 0D)",
    "dup_line_share": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "echo_share": "coalesce(try_divide(n_echoes, n_words), 0D)",
}
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")


def _step(df: DataFrame, **exprs: str) -> DataFrame:
    """Add columns computed once.

    The generator keeps the optimiser from merging this projection into the
    next one, where each use inside a lambda would compute it again.
    """
    have = df.columns
    made = F.explode(F.array(F.struct(*(F.expr(e).alias(n) for n, e in exprs.items()))))
    return df.select(*have, made.alias("_s")).select(*have, *(F.col(f"_s.{n}").alias(n) for n in exprs))


def word_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (the input row) and STATS.

    ``n_echoes`` counts words equal to the next one, ``n_repeat_words`` words inside 5-word windows that the text has
    twice or more.  Words become 64-bit hashes, window hashes combine them by
    doubling (1, 2, 4, 4 + 1), and only texts with a repeated window sort
    their windows to find the covered positions.
    """
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_t"))
    df = _step(df, _w=r"""filter(split(_t, '[\\x20\\x09-\\x0D]+'), w -> w <> '')""",
               _lines=r"""filter(split(_t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')""",
               n_symbols="cast(regexp_count(_t, '[#*$%&|<>]') as long)")
    df = _step(df.drop("_t"), n_words="cast(size(_w) as long)", _h="transform(_w, w -> xxhash64(w))",
               word_chars="cast(length(array_join(_w, '')) as long)",
               n_lines="cast(size(_lines) as long)",
               n_dup_lines="cast(size(_lines) - size(array_distinct(_lines)) as long)").drop("_w", "_lines")
    df = _step(df, _h2="""if(n_words >= 5, zip_with(slice(_h, 1, size(_h) - 1), slice(_h, 2, size(_h) - 1),
                              (a, b) -> xxhash64(a, b)), null)""")
    df = _step(df, _h5="""zip_with(zip_with(slice(_h2, 1, size(_h2) - 3), slice(_h2, 3, size(_h2) - 3),
                              (a, b) -> xxhash64(a, b)), slice(_h, 5, size(_h) - 4),
                              (a, b) -> xxhash64(a, b))""",
               n_echoes="""if(n_words < 2, 0L, cast(size(filter(zip_with(slice(_h, 1, size(_h) - 1),
                              slice(_h, 2, size(_h) - 1), (a, b) -> a = b), e -> e)) as long))""").drop("_h", "_h2")
    df = _step(df, _s5="""if(size(array_distinct(_h5)) < size(_h5),
                             sort_array(transform(_h5, (h, i) -> struct(h, i))), null)""").drop("_h5")
    df = _step(df, _p="""sort_array(transform(filter(_s5, (x, i) -> x.h <=> get(_s5, i - 1).h
                                                                  or x.h <=> get(_s5, i + 1).h), x -> x.i))""")
    df = _step(df.drop("_s5"), n_repeat_words="""coalesce(aggregate(
        transform(_p, (x, i) -> least(5, coalesce(get(_p, i + 1) - x, 5))), 0L, (a, x) -> a + x), 0L)""")
    return df.select("row", *STATS)


def base_failed() -> Column:
    return F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, max_rows: int) -> DataFrame:
    """Documents with a label, at most about ``max_rows``: (row, bad), by hash of the id."""
    own = labels.where("quality is not null and doc_id is not null").groupBy("doc_id") \
        .agg((F.avg(F.col("quality").cast("double")) < 0.5).alias("bad"))
    n = own.count()
    share = min(1.0, max_rows / max(n, 1))
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) \
        .withColumnRenamed("doc_id", "_label_id")
    if max_rows <= 1_000_000:  # the bound on the sample is the bound on the broadcast
        picked = F.broadcast(picked)
    return docs.join(picked, F.col(f"`{id_col}`") == F.col("_label_id")).drop("_label_id")


def _best(counts, p0: int, n0: int, banned=frozenset()):
    """The (feature, threshold, above) of the highest FOIL gain over per-bucket counts."""
    best = (0.0, None)
    base = math.log2(p0 / (p0 + n0))
    for f, (cuts, bad, good) in counts.items():
        for above in (True, False):
            for c in () if (f, above) in banned else range(len(cuts)):
                p = sum(bad[c + 1:]) if above else sum(bad[:c + 1])
                n = sum(good[c + 1:]) if above else sum(good[:c + 1])
                if p == 0 or p + n == p0 + n0:
                    continue
                gain = p * (math.log2(p / (p + n)) - base)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cuts[c], above))
    return best[1]


def _holds(rule) -> str:
    return " and ".join(f"{FEATURES[f]} {'>' if above else '<='} {cut!r}D" for f, cut, above in rule) or "true"


def learn_rules(sample: DataFrame, quantiles: int = 24, max_rules: int = 8, max_conditions: int = 3,
                min_precision: float = 0.9, min_covered: int = 3) -> list[list[tuple[str, float, bool]]]:
    """Ordered rules that reject; ``sample`` has STATS and ``bad``.

    Thresholds lie midway between neighbouring quantiles of the good and of
    the bad rows (``quantiles`` each), so the driver receives a table of a
    size set by the parameters alone.  A rule that does not hold on the other
    third is dropped, and no later rule starts with its feature and direction.
    """
    data = cut_lineage(sample.select(
        "bad", (F.pmod(F.xxhash64(*STATS), F.lit(3)) < 2).alias("grow"), *STATS))
    steps = [q / quantiles for q in range(quantiles + 1)]
    ends = {r["bad"]: r for r in data.where("grow").groupBy("bad").agg(*(
        F.percentile_approx(F.expr(e), steps, 10_000).alias(f) for f, e in FEATURES.items())).collect()}
    if len(ends) < 2:
        return []
    cuts = {}
    for f in FEATURES:
        v = sorted({*ends[True][f], *ends[False][f]})
        cuts[f] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    bins = F.array(*(F.struct(F.lit(f).alias("f"), F.expr(
        f"size(filter(array({', '.join(f'{c!r}D' for c in cuts[f]) or '0D'}), c -> c < {FEATURES[f]}))"
    ).alias("bin")) for f in FEATURES))
    rules: list = []
    banned: set = set()  # first conditions whose rules failed on the other third
    left = "true"
    while len(rules) < max_rules:
        rule: list = []
        while len(rule) < max_conditions:
            part = data.where(f"grow and {left} and {_holds(rule)}")
            table = part.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.bin") \
                .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
            counts = {f: (cuts[f], [0] * (len(cuts[f]) + 1), [0] * (len(cuts[f]) + 1)) for f in FEATURES}
            for r in table:
                b = min(r["bin"], len(cuts[r["f"]]))
                counts[r["f"]][1][b] += r["p"]
                counts[r["f"]][2][b] += r["n"]
            _, bad, good = counts["n_words"]
            if not sum(bad) or not sum(good):
                break
            step = _best(counts, sum(bad), sum(good), () if rule else banned)
            if step is None:
                break
            rule.append(step)
        if not rule:
            break
        # cut back: the prefix of the rule that does best on the other third
        cutoffs = [F.struct(F.count_if(F.expr(f"bad and {_holds(rule[:k])}")).alias("p"),
                            F.count_if(F.expr(f"not bad and {_holds(rule[:k])}")).alias("n"))
                   for k in range(1, len(rule) + 1)]
        seen = data.where(f"not grow and {left}").agg(*(c.alias(f"k{i}") for i, c in enumerate(cutoffs))).first()
        worth = [((s["p"] - s["n"]) / max(1, s["p"] + s["n"]), s["p"], s["n"]) for s in seen]
        k = max(range(len(worth)), key=lambda i: (round(worth[i][0], 3), worth[i][1], -i))
        _, p, n = worth[k]
        if p < min_covered or p < min_precision * (p + n):
            banned.add((rule[0][0], rule[0][2]))
            continue
        rules.append(rule[:k + 1])
        left += f" and not ({_holds(rules[-1])})"
    return rules


def verdict(rules) -> Column:
    """The decision list as an ordered conditional: false where a rule rejects."""
    when = "".join(f" when {_holds(r)} then false" for r in rules)
    return F.expr(f"case{when} else true end") if when else F.lit(True)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = 20_000) -> DataFrame:
    """``row`` (the whole input row), STATS, ``base_failed`` and ``kept``.

    The rules learn from at most about ``max_labelled`` labelled rows, a
    documented bound; the verdict covers every row.
    """
    picked = labelled_sample(docs, labels, id_col, max_labelled)
    sample = word_stats(picked, text_col).select("row.bad", *STATS)
    rules = learn_rules(sample)
    return word_stats(docs, text_col).withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              max_labelled: int = 20_000) -> DataFrame:
    """The input rows that are kept."""
    return judge(docs, labels, id_col, text_col, max_labelled).where("kept").select("row.*")
