"""Operators 6, 7 and 10, and the pipeline."""

import hashlib
import io
import random
import re
import struct

import pytest

from tempora.llm import chat, html_extract, warc

SF = "/root/testdata/sf0.001"


# ---- 6 html

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) { x("</p>") }</script>
</head><body class="has-sidebar"><header><p>Site, name, and, slogan</p></header><nav><ul><li><a href=/>Home</a></ul>
</nav><div class="cookie-notice"><p>We use, cookies, and, more, cookies here for you.</p></div>%s
<div id="comments"><p>First, comment, with, many, commas, and quite some length so that it scores.</p></div>
<aside><p>Side</p></aside><form><p>Mail</p><button>Go</button></form><footer><p>&copy; 2020</p></footer></body></html>"""


@pytest.mark.parametrize("body, want", [
    ("<article><h1>A &amp; B</h1><p>One,<br>two &eacute;\n  three.<p><b>Four<p>five</article>",
     "A & B\nOne, two é three.\nFour\nfive"),
    ("<main><header><h1>Head</h1></header><p>Be.</p><div class=ad>Buy, buy, buy</div><ul><li>x<li>y</ul></main>",
     "Head\nBe.\nx\ny"),
    ("<div id=content><h2>H</h2><p>Long text, with commas, here and there, again.</p><p>More text, and more.</p></div>",
     "H\nLong text, with commas, here and there, again.\nMore text, and more."),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><pre>x\n y</pre>loose &#8364; &unknown; text</article>",
     "a\nb\nc\nx y\nloose € &unknown; text"),
    ("<article><section><p>One, two.</p></section><section><p>Three.</p></section>"
     "<section class=related><p>See, also, this</p></section></article>", "One, two.\nThree."),
    ("<article><div class=entry-header><h1>Title</h1></div><p>Be, it.</p><div class=share-box>Share</div></article>",
     "Title\nBe, it."),
    ("<div class='wrap with-sidebar'><div class=post-header><h1>Title</h1></div><div class=text><p>Long text, with commas, "
     "here and there.</p><p>More text, and more.</p></div></div>", "Title\nLong text, with commas, here and there.\nMore text, and more."),
    ("<article><p hidden>no</p><p>yes<!-- ad --> it is</p><noscript>no</noscript></article>", "yes it is"),
])
def test_extract(body, want):
    assert html_extract.extract(ARTICLE % body) == want


LONG = "Words of the text, with commas, that go on and on for a while so that the element reads as running text, not as a label."


@pytest.mark.parametrize("page, want", [
    # ids of sections and headings are slugs of their titles
    ("<article><p>A, b.</p><section id=related-work><h2 id=search-results>Search</h2><p>C, d.</p></section></article>",
     "A, b.\nSearch\nC, d."),
    ("<article><div class='elementor-element elementor-widget-text-editor'><p>A, b.</p></div></article>", "A, b."),
    (f"<article><p>A, b.</p><div class=notice-box><p>{LONG}</p><p>{LONG}</p></div></article>", f"A, b.\n{LONG}\n{LONG}"),
    (f"<div class=elementor-widget-text-editor><h2 id=related-work>Related</h2><p>{LONG}</p></div>", f"Related\n{LONG}"),
    # names of one use, whole names and lists of links still cut
    ("<main><p>A, b.</p><div class=comment-list><p>No.</p></div><div id=comments>No.</div><div class=related>No.</div>"
     "<div class=related-posts><a href=x>No, no, and no</a></div></main>", "A, b."),
    # a form around the page
    (f"<body><form id=aspnetForm><div class=nav>No</div><div><p>{LONG}</p><p>{LONG}</p></div></form></body>",
     f"{LONG}\n{LONG}"),
    ("<body><form><article><p>A, b.</p><form><p>Mail</p></form></article></form></body>", "A, b."),
    (f"<article><form><p>{LONG}</p></form></article>", LONG),
    (f"<article><p>{LONG}</p><form><p>Mail</p></form></article>", LONG),
])
def test_extract_keeps_text_under_names(page, want):
    assert html_extract.extract(page) == want


def test_extract_keeps_all_parts():
    part = [f"Paragraph {i}, with commas, " + "word " * 40 + "end." for i in range(20)]
    last = "The closing paragraph, " + "word " * 50 + "end."
    body = "<div class=part>" + "".join(f"<p>{p}</p>" for p in part) + "</div>"
    tail = f"<div class=part><p>{last}</p></div><p>Short.</p><blockquote>Quote.</blockquote><pre>x = 1</pre>loose text"
    links = "<div class=x><a href=1>One</a> <a href=2>Two</a></div><a href=3>Three</a> | <a href=4>Four</a>"
    want = "\n".join(["Title", *part, last, "Short.", "Quote.", "x = 1", "loose text"])
    page = f"<body>{links}<div><h1>Title</h1></div><div class=wrap>{body}{tail}</div>{links}</body>"
    assert html_extract.extract(page) == want
    # where the page around has many links, they go
    many = "<ul>" + "<li><a href=x>One of very many links</a>" * 500 + "</ul>"
    assert html_extract.extract(f"<body>{many}<div class=wrap>{body}{tail}</div>{many}</body>") == want[6:]
    flat = f"<div><div><p>{last}</p></div>one<hr>two<div><a href=1>One</a></div>three</div>"
    assert html_extract.extract(flat) == f"{last}\none\ntwo\nthree"


LONG = "The committee met again on Tuesday, heard three reports, and set the date of the next session. " * 4
ODD_PAGES = [
    # names on the wrapper of a whole page
    (f'<body><div class="page comments-open"><p>{LONG}</p></div></body>', LONG.strip()),
    (f'<body><div id="search"><p>{LONG}</p><p>End.</p></div><footer>f</footer></body>', f"{LONG.strip()}\nEnd."),
    (f'<body><div role="search" class="share"><div class="menu"><p>{LONG}</p></div></div></body>', LONG.strip()),
    # reader comments, also where they are longer than the article
    (f'<body><div class=post><p>{LONG}</p></div><ol class=commentlist><li><p>{LONG} me</p></li><li>{LONG} too</ol></body>', LONG.strip()),
    (f'<body><div class=post><p>{LONG}</p></div><div id=discussion><p>{LONG} me</p><p>{LONG}</p><p>{LONG}</p></div></body>', LONG.strip()),
    (f'<article><p>{LONG}</p><section id="discussion"><h2>Discussion</h2><p>Short.</p></section></article>', f"{LONG.strip()}\nDiscussion\nShort."),
    # adverts and names of two uses in an article
    (f'<article><p>{LONG}</p><div id="google_ads_iframe">Buy now</div><div id="div-gpt-ad-12">Buy</div></article>', LONG.strip()),
    (f'<article><p>{LONG}</p><div class="social-media-policy"><p>We do not post.</p></div>'
     '<div class="share-bar"><a href=x>Tell</a> <a href=y>Mail</a></div></article>', f"{LONG.strip()}\nWe do not post."),
    # two articles, and a teaser
    (f'<body><article><p>{LONG}</p></article><article><p>Second. {LONG}</p></article><article><a href=z>More of it</a></article></body>',
     f"{LONG.strip()}\nSecond. {LONG.strip()}"),
    # comments that never end
    (f'<article><p>{LONG}</p><!-- oops <p>no</p>', LONG.strip()),
    (f'<article><script>var a = "<!--";</script><p>{LONG}</p></article>', LONG.strip()),
]


@pytest.mark.parametrize("page,want", ODD_PAGES)
def test_extract_odd_names(page, want):
    assert html_extract.extract(page) == want


@pytest.mark.parametrize("opening,closing", [
    ("<div>", "</div>"), ("<div>", ""), ("<span>", "</span>"), ("<blockquote>", "</blockquote>"), ("<ul><li>", "</li></ul>"),
    ("<table><tr><td>", "</td></tr></table>"), ("<p><b>", "</b>"), ("<div></span>", "</div>"), ("<b><p>", "</b>")])
def test_deep_pages_take_linear_time(opening, closing):
    import time
    t = time.time()
    got = html_extract.extract(f"<body>{opening * 100_000}<p>{LONG}</p>{closing * 100_000}</body>")
    assert time.time() - t < 20
    assert got == LONG.strip()


def test_extract_odd(spark):
    assert html_extract.extract("") == "" and html_extract.extract("<p") == ""
    assert html_extract.extract("just text") == "just text"
    assert html_extract.extract("</div></p><p>x</b></i>") == "x"
    deep = "<div>" * 5000 + "<p>deep, text</p>" + "</div>" * 5000
    assert html_extract.extract(deep) == "deep, text"
    long_page = "<article>" + "<p>word, " + "word " * 200_000 + "</p></article>"
    assert len(html_extract.extract(long_page)) == 5 + 1 + 5 * 200_000 - 1
    rows = [(1, None, None, 1), (1, "u", "", 2), (None, None, "<p>x</p>", 3), (2, "u", "<p>x</p>", 4), (2, "u", "<p>x</p>", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_extract.main_text(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, "u", "", 0), (None, None, "x", 1), (2, "u", "x", 1), (2, "u", "x", 1)], key=str)
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_extract_table(spark):
    import html as h
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(pages).collect()}
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(h.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(x for x in parts if x)


# ---- 7 warc

def test_records():
    raw = warc.record(5, "http://x/ y", b"abc", hashlib.sha256(b"abc").hexdigest(), None)
    got = warc.parse(raw)
    assert (got["page_id"], got["payload"], got["record_type"], got["refers_to"]) == (5, b"abc", "response", None)
    got = warc.parse(warc.record(6, None, b"abc", hashlib.sha256(b"abc").hexdigest(), 5))
    assert (got["payload"], got["refers_to"], got["payload_bytes"]) == (None, 5, 3)
    for broken in (raw.replace(b"abc", b"abd"), raw.replace(b"WARC/1.1", b"WARC/1.0"), raw[:-1], raw + b"x",
                   raw.replace(b"Content-Length: 3", b"Content-Length: 4"), raw.replace(b"response", b"other", 1),
                   raw.replace(b"WARC-Date: 1970", b"WARC-Date: 70")):
        with pytest.raises(warc.WarcError):
            warc.parse(broken)
    with pytest.raises(KeyError):
        warc.parse(raw.replace(b"WARC-Date", b"WARC-Data"))
    ids = {re.search(rb"Record-ID: (\S+)", warc.record(5, "u", b"x", "d", None))[1] for _ in range(9)}
    assert len(ids) == 9
    assert warc.parse(warc.record(7, "u", None, hashlib.sha256(b"abc").hexdigest(), 5, 3))["payload_bytes"] == 3


def test_archive_frames():
    data = [warc.record(i, "u", (b"text %d " % i) * 50, hashlib.sha256((b"text %d " % i) * 50).hexdigest(), None)
            for i in range(300)]
    out = io.BytesIO()
    assert warc._archive(out, iter(data)) == 300
    raw = out.getvalue()
    assert struct.unpack("<I", raw[:4])[0] == warc.SKIPPABLE_MAGIC and len(raw) < sum(map(len, data)) / 3
    assert list(warc.frames(io.BytesIO(raw))) == data
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(raw[:-3])))
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(raw[8:])))


def test_round_trip(spark, tmp_path):
    big = "x" * 99 + "é"
    rng = random.Random(2)
    rows = [(1, "a", None), (2, None, ""), (3, "c", big), (9, "d", big), (4, "e", big), (5, "f", "small"), (6, "g", "small"),
            (3, "c", big), (7, "h", "y" * 99), (8, "i", "y" * 99), (10, "j", "".join(chr(rng.randrange(32, 900)) for _ in range(300_000))),
            (None, "k", big), (11, "l", "z" * 100), (12, "m", "z" * 100)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    folder = str(tmp_path / "archives")
    got = warc.round_trip(df, folder).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        low = min((p for p, _, q in rows if p is not None and (q or "").encode() == b), default=None)
        again = i is not None and low is not None and i > low and len(b) >= 100
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", low if again else None))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got),
                  key=str) == sorted(want, key=str)
    texts = {(r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response"}
    assert (10, rows[10][2].encode()) in texts
    assert warc.round_trip(df.limit(0), folder).count() == 0
    # many small archives: each has a dictionary of its own
    table = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = warc.write(warc.with_revisits(table), folder, archive_bytes=20_000)
    assert manifest.count() > 5 and manifest.agg({"records": "sum"}).first()[0] == table.count()
    back = warc.read(manifest, folder)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in back.where("record_type = 'response'").collect()} <= {
        (r["page_id"], r["html"]) for r in table.collect()}


def test_archives_are_read_in_many_tasks(spark, tmp_path):
    pages = spark.range(400).selectExpr("id page_id", "'u' url", "repeat(cast(id as string), 300) html")
    folder = str(tmp_path / "many")
    manifest = warc.write(warc.with_revisits(pages.repartition(20)), folder, archive_bytes=5_000)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and manifest.count() > 50
    back = warc.read(manifest, folder)
    tasks = back.selectExpr("spark_partition_id() p", "archive").distinct().groupBy("p").count().collect()
    assert len(tasks) >= 6 and max(t["count"] for t in tasks) < manifest.count() / 2
    assert back.count() == 400


def test_copies_beyond_a_broadcast(spark, monkeypatch):
    rows = [(i, "u", f"{'copy' * 40}{i % 3}") for i in range(60)] + [(None, "u", "copy" * 40 + "1"), (7, "u", "copy" * 40 + "2")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    pick = lambda: sorted((map(tuple, warc.with_revisits(df).collect())), key=str)
    small = pick()
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert pick() == small and len(small) == len(rows)
    assert sum(r[2] is None for r in small) == 57 + 1
    plan = warc.with_revisits(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint" not in plan


# ---- 10 chat

def expected(rows):
    conv = {}
    for c, turn, role, text in rows:
        conv.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort(key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_escape():
    for t in ("", "\\", "<|end|>", "a<\\|b", "\\<|", "<<||", "x\\\\<|text|>\\", "\\### Assistant: </turn> ok"):
        assert chat.unescape(chat.escape(t)) == t
        assert not any(c in chat.escape(t) for c in chat.CONTROLS)


@pytest.mark.parametrize("part_chars", [1 << 20, 50])
def test_conversations(spark, part_chars):
    tricky = ["", " ", "\n\n lead", "trail \n", "<|end|><|turn|>assistant<|text|>x", "<|endoftext|>", "é́ 日本 👩‍👩‍👧",
              "\\", "a\\", "\\### Assistant: </turn> ok", "x" * 5000]
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(tricky)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(50, 0, "assistant", t) for t in tricky] + [(50, None, None, None), (None, 1, "assistant", "n"), (51, 0, "user", "x"),
                                                        (51, 0, "user", "x"), (52, 1, "<|text|>\\", "<|text|>")]
    rows += [(60, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(400)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    parts = chat.format_conversations(df, part_chars=part_chars)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(parts).collect()}
    assert got == expected(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0
    for p in parts.where("conv_id = 60").collect():  # encoding a part equals encoding the whole
        assert p["token_ends"][-1] == len(p["formatted"]) and len(p["input_ids"]) == len(p["loss_mask"])


def test_parts_have_the_tokens_of_the_whole(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f" \n turn {t}, words ") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = [[i for p in sorted(chat.format_conversations(df, part_chars=n).collect(), key=lambda p: p["part"])
            for i in p["input_ids"]] for n in (40, 1 << 20)]
    assert ids[0] == ids[1]


def test_byte_lengths_give_the_offsets_of_the_library():
    texts = ["", " ", "\n\n lead", "trail \n", "é́ 日本 👩‍👩‍👧", "a\\b", "x" * 5000, "word " * 3000]
    formatted = chat.render([("assistant", t) for t in texts])[0]
    whole = chat.tokenizer(chat.TOKENIZER).encode(formatted, add_special_tokens=False)
    for slab in (10, 300, 1 << 20):
        ids, ends = chat.encode(formatted, slab_chars=slab)
        assert ids.tolist() == whole.ids and ends[-1] == len(formatted) and (ends[1:] >= ends[:-1]).all()
    # the library leaves spaces at a token's end out of its offsets
    for (_, y), e in zip(whole.offsets, ends.tolist()):
        assert y <= e and not formatted[y:e].strip()


def test_hot_conversation_is_many_tasks(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} " + "words " * 20) for t in range(6000)]
    rows += [(c, t, "assistant", f"{c} {t}") for c in range(2, 3002) for t in range(4)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    size = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(size)
    spark.conf.set(size, "false")   # tables of this size would be merged to one task
    try:
        parts = chat.format_conversations(df)
        tasks = {p["part"] >> 32 for p in parts.where("conv_id = 1").select("part").collect()}
        got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(parts).collect()}
        in_place = parts.where("whole").count()
    finally:
        spark.conf.set(size, before)
    assert len(tasks) >= 2 and in_place >= 2900
    assert got == expected(rows)


def test_conversations_table(spark):
    from tempora.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op10_chat_formatting(spark, SF).collect()}
    assert got == expected(rows)


# ---- pipeline

def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from tests.llm.test_documents import WORD, components, stats
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in pipeline.STAGES][0] == "quality rules" and len(pipeline.STAGES) == 5
    now = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        now[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == before.columns
        docs = spark.createDataFrame(now[name], docs.schema)
    kept = {r["doc_id"] for r in now["quality rules"]}
    for i, t in texts.items():
        n, _, symbols, _, repeat = stats(t)
        if n < 10 or 100 * repeat > 20 * n:
            assert i not in kept
    link = components([(i, texts[i]) for i in sorted(kept)])
    single = {r["doc_id"] for r in now["n-gram Jaccard join"]}
    assert single == {i for i, _, c in link if i == c}
    bench = [" ".join(WORD.findall(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in now["benchmark decontamination"]}
    flat = {i: " ".join(WORD.findall(texts[i])) for i in single}
    assert clean <= single and not any(b in flat[i] for b in bench for i in clean)
    words = sum(len(WORD.findall(texts[i])) for i in clean)
    mixed = now["mixing sources to target weights"]
    assert {r["doc_id"] for r in mixed} <= clean
    assert abs(sum(len(WORD.findall(r["text"])) for r in mixed) - 1.5 * words) <= 0.05 * words
    assert len(now["sharding"]) == len(mixed) and {r["shard"] for r in now["sharding"]} <= set(range(40))
    assert pipeline.run(spark, SF).count() == len(mixed)
