"""Plans of the native operators, fingerprints and recall of the decontamination, the pipeline on awkward rows."""

import contextlib
import io
import random

import pytest

import corpus_pipeline
from tempora.llm import decontaminate, queries, substring

SF, TABLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "PythonUDF", "MapInArrow", "MapInPandas", "FlatMapGroupsIn", "ExistingRDD")


@pytest.mark.parametrize("name", ["op2_byte_sharding", "op4_decontamination", "op5_quality_rules"])
def test_native_plans_stay_in_the_jvm(spark, name):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        queries.QUERIES[name](spark, SF).explain("formatted")
    # a checkpoint reads as an existing RDD, whose rows Spark itself wrote
    assert not [n for n in PYTHON_NODES[:-1] if n in out.getvalue()]


@pytest.mark.parametrize("size", [1, 2, 5, 64, 301])
def test_fingerprints_do_not_depend_on_the_lanes(spark, size):
    rng = random.Random(size)
    wins = [[rng.randrange(-2 ** 63, 2 ** 63) for _ in range(size)] for _ in range(20)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wins)], "i int, win array<long>")
    got = {lane: {r.i: r.fp for r in decontaminate._fingerprint(df, lane).collect()} for lane in (16, 32)}
    assert got[16] == got[32]
    for i, w in enumerate(wins):
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in w) > len(w))
        assert got[16][i] % 2 ** 64 == bits


def test_items_of_any_length(spark, monkeypatch):
    # as if the counters of 16 bits were too narrow
    monkeypatch.setattr(decontaminate, "SHORT_ITEM_SHINGLES", 3)
    rng = random.Random(2)
    words = [f"w{rng.randrange(300)}" for _ in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "none of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words[100:180])), (6, " ".join(words[300:309]))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.similarity) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [(1, 5, 100, 1.0), (1, 6, 300, 1.0)]


def test_recall_of_the_fingerprints_on_the_table(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{TABLE}/{t}.parquet") for t in ("documents", "benchmark"))
    key = lambda df: {(r.doc_id, r.item_id) for r in df.collect()}
    found = key(decontaminate.contaminated(docs, bench))
    # within 64 bits is every pair: all candidate windows are verified exactly
    everything = key(decontaminate.contaminated(docs, bench, radius=64))
    assert everything and found <= everything
    assert len(found) >= 0.99 * len(everything)
    # texts that move to their places give the same as places that go to the texts
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert key(decontaminate.contaminated(docs, bench)) == found


def test_pipeline_on_awkward_rows(spark, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(900_000, None, "en", "s", 0), (900_001, "", "en", "s", 0), (None, None, None, None, None), (None, " \n", None, None, None)]
    odd = base.unionByName(spark.createDataFrame(extra, base.schema)).unionByName(base.limit(30)) \
        .selectExpr("*", "'x' as row", "'y' as shard", "1 as size", "'z' as uid", "2 as label", "cast(null as string) as `a.b`")
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert set(odd.columns) - {"shard"} <= set(out.columns) and {"shard", "slot"} <= set(out.columns)
    rows = out.select("doc_id", "text", "shard", "slot").collect()
    assert rows and {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()}
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    # no two kept texts are alike
    plain = corpus_pipeline.run(spark, SF).select("doc_id", "text").distinct()
    assert {(r.doc_id, r.text) for r in plain.collect()} == {(r.doc_id, r.text) for r in rows if r.doc_id is not None}


def test_pipeline_of_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_hot_passage_is_dealt_over_parts(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(90)]
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 40))] + passage[rng.randint(0, 9):] +
                         [word() for _ in range(rng.randint(0, 40))])) for i in range(120)]
    rows += [(i, " ".join(word() for _ in range(100))) for i in range(200, 230)] + [(7, rows[7][1]), (None, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    run = lambda: sorted(map(str, substring.remove_repeats(docs).collect()))
    whole = run()
    monkeypatch.setattr(substring, "HOT_ROWS", 10)
    assert run() == whole
    monkeypatch.setattr(substring, "BROADCAST_HOT", 0)
    assert run() == whole
    spread = substring._join_split(spark.range(1000).selectExpr("1 as g", "id"),
                                   spark.createDataFrame([(1, 1000, "x")], "g int, rows long, v string"), ["g"], ["id"])
    assert spread.count() == 1000 and spread.columns == ["g", "id", "v"]
    # neighbouring windows are one row
    starts = spark.createDataFrame([(1, 0, a, 1) for a in (3, 4, 5, 9, 10)] + [(1, 1, 6, 2), (2, 0, 6, 1)],
                                   "doc_id long, tag int, at int, n int")
    assert sorted(map(tuple, substring._merged_starts(starts).collect())) == [(1, 0, 3, 3), (1, 0, 9, 2), (1, 1, 6, 2), (2, 0, 6, 1)]
