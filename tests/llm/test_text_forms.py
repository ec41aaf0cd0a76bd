"""Chat formatting, HTML extraction, WARC fixity, the pipeline."""

import hashlib

import pytest
from pyspark.sql import functions as F

from reviewflow.llm import chat, html_template, warc

EVENTS = "conv_id long, seq long, message_id long, kind string, role string, payload string"


def test_events_fold(spark):
    rows = [(1, 1, 1, "start", "user", None), (1, 2, 1, "delta", "user", "hel"), (1, 3, 1, "delta", "user", "lo"),
            (1, 4, 2, "start", "assistant", ""), (1, 5, 2, "delta", "assistant", "bad"), (1, 6, 2, "regenerate", "assistant", None),
            (1, 7, 2, "delta", "assistant", "good"), (1, 8, 1, "edit", "user", "bye"), (1, 9, 1, "delta", "user", "!"),
            (1, 10, 3, "start", "user", None), (1, 11, 3, "delta", "user", "x"), (1, 12, 3, "delete", "user", None),
            (None, 1, 1, "start", None, None), (2, 5, 9, "delta", "user", None)]
    events = spark.createDataFrame(rows, EVENTS)
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.render(chat.messages(events)).select(
        "conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("user", "bye!"), ("assistant", "good")], None: [("", "")], 2: [("user", "")]}
    assert chat.render(chat.messages(events.where("false"))).count() == 0


def test_turns_round_trip(spark):
    hard = ["", "</s>\n", "<s>user\nx</s>\n", "\\l<\\\\<l\\", "a\\", "[INST] ok", "x" * 3000, "é😀\n\n<"]
    rows = [(k % 3, k // 3, r, t, 0) for k, (r, t) in enumerate([(r, t) for t in hard for r in ("user", "assistant", "a<\\b")])]
    rows += [(7, 0, None, None, 0), (7, 1, "user", None, 0), (7, 1, "user", None, 0), (7, None, "user", "first", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int")
    done = chat.render(chat.messages(chat.events_of_turns(turns, delta_chars=7))).select(
        "conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns")).withColumn("loss", chat.loss_text(F.col("turns")))
    got = {r.conv_id: r for r in done.collect()}
    assert set(got) == {0, 1, 2, 7}
    for c, r in got.items():
        mine = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert r.loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r.formatted.count("</s>\n") == len(mine)


def test_roles_with_line_breaks_and_revised_logs(spark):
    rows = [(1, 0, "user\n", "hi\n"), (1, 1, "assistant\nx", "\\n"), (1, 2, "assistant", "x" * 1200), (1, 3, "user", ""), (1, 3, "user", ""),
            (2, 0, "assistant", None), (2, 1, "\\n\n<", "y" * 700), (3, 0, "user", "w " * 60_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for revised in (False, True):
        log = chat.events_of_turns(turns, revised=revised)
        back = chat.render(chat.messages(log)).select("conv_id", chat.parse(F.col("formatted")).alias("turns"))
        back = back.withColumn("loss", chat.loss_text(F.col("turns")))
        got = {r.conv_id: r for r in back.collect()}
        for c in (1, 2, 3):
            assert [tuple(t) for t in got[c].turns] == [(r, t or "") for k, _, r, t in rows if k == c]
        assert got[1].loss == "x" * 1200
    assert {r.kind for r in log.select("kind").distinct().collect()} == set(chat.KINDS)


def test_chat_plan_has_no_python(spark):
    from reviewflow.llm.queries import QUERIES
    plan = QUERIES["op7_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>"</p>"</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li>one<li>two</ul></nav><div class="ad-box">Buy</div><!-- c --><div id=x>Site motto</div>
%s<aside>side</aside><div class='cookie-notice'>ok?</div><form><input>f</form><div id="comments"><p>reader</div>
<footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &amp;amp; B</h1><p>one\n  two<br>three <b>bold</b>&nbsp;x</p><p></p></article>", "A &amp; B\none two\nthree bold x"),
    ("<main><p><b>open<p>next</main>", "open\nnext"),
    ("<article><p>a</p><div class=comments><p>no</div><script>no</script><ul><li>l1<li>l2</ul><table><tr><td>c1<td>c2</table>", "a\nl1\nl2\nc1\nc2"),
    ("<article><header><h1>T</h1></header><p>&lt;b&gt; &#233; &am</article>", "T\n<b> é &am"),
    ("<article></article>", ""),
])
def test_article(body, text):
    assert html_template.text_of(PAGE % body, frozenset()) == text


def test_templates_are_removed(spark):
    shell = "<body><div>Shared <i>motto</i></div><div><p>%s</p><p>common line</p></div><section>Links: a b</section></body>"
    rows = [(k, f"http://Host.example:80/{k}", shell % f"own {k}", k) for k in range(6)] + [(k, f"https://other.example/{k}", shell % f"own {k}", k) for k in range(50, 53)]
    rows += [(90, None, shell % "no host", 0), (91, "http://host.example/x", None, 0), (92, "http://host.example/y", "", 0),
             (93, "http://host.example/z", "<p>" + "word " * 50_000, 0), (None, "http://host.example/n", "<p>null id", 0), (0, rows[0][1], rows[0][2], 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    want = sorted([(k, f"own {k}") for k in range(6)] + [(0, "own 0")] + [(k, f"Shared motto\nown {k}\ncommon line\nLinks: a b") for k in range(50, 53)]
                  + [(90, "Shared motto\nno host\ncommon line\nLinks: a b"), (91, ""), (92, ""), (93, ("word " * 50_000).strip()), (-1, "null id")])
    for most in (html_template.MOST_HASHES, 0):  # by broadcast and by joins
        got = html_template.extract(pages, most_hashes=most).collect()
        assert sorted((-1 if r.page_id is None else r.page_id, r.text) for r in got) == want
    assert html_template.extract(pages.where("false")).count() == 0


def test_copies_of_an_article_stay(spark):
    rows = [(k, "http://h/1", "<body><nav>n</nav><article><p>the same</p><p>article</p></article></body>") for k in range(20)]
    got = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"the same\narticle"} and len(got) == 20


def texts_of(spark, pages):
    df = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in sorted(html_template.extract(df).collect(), key=lambda r: r.page_id)]


def test_copies_without_article_stay(spark):
    pages = [("http://h/1", "<body><div>the same</div><p>page</p></body>")] * 8
    assert texts_of(spark, pages) == ["the same\npage"] * 8


def test_prose_of_a_large_host_stays(spark):
    """What recurs on few of a host's many pages, or inline in a kept block, is text."""
    page = "<body><div>Site motto</div><div><p>own %d <b>always bold</b> end</p>%s</div></body>"
    pages = [("http://h/1", page % (k, "<p>Yes.</p>" if k % 8 == 0 else "")) for k in range(64)]
    assert texts_of(spark, pages) == [f"own {k} always bold end" + ("\nYes." if k % 8 == 0 else "") for k in range(64)]


def test_boxes_inside_articles_are_removed(spark):
    """Recurring blocks inside the marked article go; copies of an article in other shells stay."""
    page = "<body><p>%s</p><main><h1>T%d</h1><p>own %d</p><div class='x'>Also read: a b</div></main></body>"
    copy = "<body><p>shell %d</p><article><p>the same</p><p>article</p></article></body>"
    pages = [("http://h/1", page % (k, k, k)) for k in range(8)] + [("http://g/1", copy % k) for k in range(8)]
    assert texts_of(spark, pages) == [f"T{k}\nown {k}" for k in range(8)] + ["the same\narticle"] * 8


@pytest.mark.parametrize("name", ["entry-header", "article-header", "share-price", "menu-item", "notice-period", "social", "banner-image", "related"])
def test_names_of_content_inside_articles(name):
    body = f'<article><header class="{name}"><h1>T</h1></header><p class="{name}" id="{name}">a</p><div class="x share-buttons">no</div></article>'
    assert html_template.text_of(PAGE % body, frozenset()) == "T\na"


def damaged(rows):
    kept = [r for r in rows if r[0] not in (5, 700)]
    return [(i, u, (h or "") + "x") if i in (9, 5000) else (i, u, h) for i, u, h in kept] + [(-3, "u", "new"), (None, None, None)]


def test_fixity_audit(spark):
    rows = [(i, f"http://h/{i}", f"page {i} é") for i in (*range(0, 40), 700, 5000, 5001, 9000, -7)] + [(40, None, None), (41, "u", ""), (41, "u", ""), (42, "a", "x"), (42, "b", "y")]
    schema = "page_id long, url string, html string"
    ours, theirs = spark.createDataFrame(rows, schema), spark.createDataFrame(damaged(rows), schema)
    got = warc.audit(warc.records(ours), warc.records(theirs)).collect()
    assert {(r.page_id, r.status) for r in got if r.status != "intact"} == {
        (5, "missing"), (700, "missing"), (9, "changed"), (5000, "changed"), (-3, "extra"), (None, "extra")}
    assert len(got) == len(set(rows)) + 2
    bytes_of = {}
    for i, u, h in rows:
        block = (h or "").encode()
        bytes_of.setdefault(i, []).append(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: " + (u or "").encode()
                                          + b"\r\nContent-Type: text/html\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    for r in got:
        if r.status != "extra":
            assert r.digest in {hashlib.sha256(b).hexdigest() for b in bytes_of[r.page_id]}
    files = {}
    for r in sorted((r for r in got if r.file is not None), key=lambda r: (r.file, r.page_id, r.digest)):
        assert r.offset == files.get(r.file, 0)
        files[r.file] = r.offset + r.length * (2 if r.page_id == 41 else 1)
    same = warc.audit(warc.records(ours), warc.records(ours)).collect()
    assert {r.status for r in same} == {"intact"}


def test_fixity_of_large_ids(spark):
    ids = (2**62 + 4095, 2**53 + 4097, -2**62 - 1, 2**63 - 1)
    schema = "page_id long, url string, html string"
    ours, theirs = (spark.createDataFrame([(i, "u", h) for i in ids], schema) for h in ("a", "b"))
    got = warc.audit(warc.records(ours), warc.records(theirs)).collect()
    assert {(r.page_id, r.file, r.status) for r in got} == {(i, i // 4096, "changed") for i in ids}


def test_fixity_finds_moved_records(spark):
    schema = "page_id long, url string, html string, spot long, place string"
    rows = [(i, "u", f"page {i}", i // 2 if i % 2 else i // 2 + 5000, "x") for i in range(300)]
    rows += [(400, "u", "nowhere", None, "x"), (None, "u", "nobody", 7000, "x"), (-2**63, "u", "least", -2**63, "x")]
    there = {r[0]: r for r in rows}
    there[10], there[11] = (*there[10][:3], there[11][3], "x"), (*there[11][:3], there[10][3], "x")  # changed places
    there[20] = (*there[20][:3], 9000, "x")  # at a place of its own
    there[30] = (30, "u", "other", there[30][3], "x")
    del there[40], there[400]
    there[None] = (None, "u", "nobody", None, "x")
    ours, theirs = spark.createDataFrame(rows, schema), spark.createDataFrame(list(there.values()), schema)
    got = warc.audit(warc.records(ours, place="spot"), warc.records(theirs, place="spot")).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.status) for r in got if r.status != "intact"} == {
        (10, "moved"), (11, "moved"), (20, "moved"), (30, "changed"), (40, "missing"), (400, "missing"), (None, "moved")}
    offset = {}
    for r in sorted((r for r in got if r.page_id != 400), key=lambda r: (r.file, [x for x in rows if x[0] == r.page_id][0][3])):
        assert r.part == 0 and r.offset == offset.get(r.file, 0)
        offset[r.file] = r.offset + r.length


def test_fixity_of_a_long_record_and_many_at_one_place(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST", 20)
    schema = "page_id long, url string, html string"
    rows = [(1, "u", "x" * 300_000)] + [(None, "u", str(i)) for i in range(100)]
    ours, theirs = spark.createDataFrame(rows, schema), spark.createDataFrame([(1, "u", "x" * 299_999 + "y")] + rows[1:], schema)
    got = warc.audit(warc.records(ours), warc.records(theirs)).collect()
    assert {(r.page_id, r.status) for r in got} == {(1, "changed"), (None, "intact")}
    assert len({(r.file, r.part, r.offset) for r in got}) == 101


def test_descent_reads_only_differing_branches(spark):
    rows = [(i, "u", str(i)) for i in range(2000)]
    schema = "page_id long, url string, html string"
    a = warc.tree(warc.records(spark.createDataFrame(rows, schema)))
    b = warc.tree(warc.records(spark.createDataFrame([(i, u, h if i != 1234 else "!") for i, u, h in rows], schema)))
    assert [tuple(r) for r in warc.descend(a, b).collect()] == [(0, 1234)]
    assert [x.count() for x in a] == [2000, 125, 8, 1]
    empty = warc.records(spark.createDataFrame([], schema))
    assert warc.audit(empty, empty).count() == 0
    assert {r.status for r in warc.audit(warc.records(spark.createDataFrame(rows[:3], schema)), empty).collect()} == {"missing"}


def test_sql_oracles(spark):
    import duckdb
    from reviewflow.llm.queries import ORACLE, QUERIES
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, d)
        cur = con.execute(sql)
        names = [c[0] for c in cur.description]
        assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in got.select(*names).collect()), name


def test_pipeline(spark, library):
    import corpus_pipeline
    d = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, d).collect()
    assert 0 < len(out) < len(texts)
    for r in out:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_stages_take_odd_rows(spark):
    """Nulls, empty texts, repeated rows, columns with the stages' own names, no rows."""
    import corpus_pipeline
    d = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{d}/documents.parquet").limit(30)
    odd = real.withColumn("_toxicity", F.lit(1)).withColumn("_id", F.lit("x")).withColumn("score", F.lit(None).cast("string"))
    odd = odd.unionByName(odd.limit(3)).unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(
        odd.limit(2).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("text", F.lit(None).cast("string")))
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, d)
            assert (out.columns == docs.columns) == (name != "bpe")
            assert out.count() <= docs.count()
