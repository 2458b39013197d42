"""Line dedup, decontamination, packing, extraction and URL rules against brute force, and their awkward inputs."""

import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from churnkit.llm import decontaminate, html_extract, line_dedup, packing, queries, url_filter
from churnkit.llm.common import Scratch
from churnkit.llm.queries import tokenizer_path
from tests.conftest import SF001


# ------------------------------------------------------------------ lines
def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:k] + long_[k + 1 :] == short for k in range(len(long_)))


def brute_lines(rows, least=8):
    first, order = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for p, raw in enumerate(t.split("\n")):
            line = raw.strip(" ")
            if line and len(line.split(" ")) >= least:
                order.append((i, p, line))
                first.setdefault(line, (i, p))
    lines = sorted(first, key=first.get)
    near = {b for k, b in enumerate(lines) if any(distance_one(a.split(" "), b.split(" ")) for a in lines[:k])}
    gone = {}
    for i, p, line in order:
        if first[line] != (i, p) or line in near:
            gone.setdefault(i, set()).add(p)
    return {i: sorted(gone.get(i, ())) for i, _ in rows}


def test_lines_match_brute_force(spark, rnd, words):
    pool = [words(rnd.randint(5, 40)) for _ in range(40)]
    for line in list(pool):  # one word changed, dropped or put in
        w = line.split(" ")
        k = rnd.randrange(len(w))
        pool += [" ".join(w[:k] + [words(1)] + w[k + 1 :]), " ".join(w[:k] + w[k + 1 :]), " ".join(w[:k] + [words(1)] + w[k:])]
    template = words(12).split(" ")
    pool += [" ".join([*template[:5], str(k), *template[5:]]) for k in range(60)]  # all near to each other
    pool += ["same " * 30 + words(1) for _ in range(6)] + ["  " + pool[0] + " ", "", " "]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 8)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "\n".join(pool[:3])), (502, pool[0]), (503, "x " * 2000)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, dropped int, h string")
    got = line_dedup.dedup_lines(df, Scratch(spark), keep=("doc_id", "text")).collect()
    want = brute_lines(rows)
    assert {r.doc_id: list(r.dropped) for r in got if r.doc_id is not None} == {i: d for i, d in want.items() if i is not None}
    for r in got:
        if r.text is None:
            assert r.clean_text is None and r.n_lines == 0
        else:
            lines = r.text.split("\n")
            assert r.n_lines == len(lines)
            assert r.clean_text == "\n".join(x for p, x in enumerate(lines) if p not in r.dropped)


def test_lines_repeated_rows_and_empty_table(spark, words, empty):
    assert line_dedup.dedup_lines(empty("doc_id long, text string"), Scratch(spark)).count() == 0
    line = words(10)
    rows = [(1, line), (1, line), (2, f"{line}\nshort line"), (3, line + "\n" + line)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark)).collect()
    assert sorted((r.doc_id, list(r.dropped)) for r in got) == [(1, []), (1, []), (2, [0]), (3, [0, 1])]


def test_lines_need_no_python_and_no_pairs(spark, capsys):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    line_dedup.dedup_lines(df, Scratch(spark)).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_short_and_unspaced_lines_go_as_exact_copies(spark, tmp_path):
    texts = ["Read more\n\n  你好，世界。今天天气很好\na\tb\tc", "Read more\nread more\n\n你好，世界。今天天气很好", "a\tb\tc \nRead more\nRead"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_deletion_lines(spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.dropped) for r in got} == {0: [], 1: [0, 3], 2: [0, 1]}


# ---------------------------------------------------------- decontamination
def brute_tiles(doc, item, least):
    """Greedy string tiling as defined: the longest unmarked common passage first."""
    free_d, free_i, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i, j in itertools.product(range(len(doc)), range(len(item))):
            n = 0
            while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_d[i + n] and free_i[j + n]):
                n += 1
            if n > best[0]:
                best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        total += n
        for k in range(n):
            free_d[i + k] = free_i[j + k] = False


def test_tiling_covers_as_the_definition_does(rnd):
    for _ in range(120):
        item = [rnd.randrange(30) for _ in range(rnd.randint(5, 40))]
        cut = sorted(rnd.sample(range(1, len(item)), min(3, len(item) - 1)))
        pieces = [item[a:b] for a, b in itertools.pairwise([0, *cut, len(item)])]
        rnd.shuffle(pieces)
        doc = [rnd.randrange(100, 200) for _ in range(5)]
        for p in pieces:
            doc += p + [rnd.randrange(100, 200) for _ in range(rnd.randint(0, 2))]
        a, b = np.array(doc, np.uint64), np.array(item, np.uint64)
        tiles = decontaminate.tile(a, b, 3)
        assert all(doc[i : i + n] == item[j : j + n] and n >= 3 for i, j, n in tiles)
        for side in (0, 1):
            places = [x for t in tiles for x in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))
        # ties between equally long matches may be broken either way
        assert abs(sum(n for _, _, n in tiles) - brute_tiles(doc, item, 3)) <= 3


def test_decontamination_catches_reordered_passages(spark, rnd, words, empty):
    items = [(k, words(40)) for k in range(12)] + [(50, "too short"), (51, None), (52, "")]
    w = items[3][1].split(" ")
    docs = [(0, words(200)), (1, words(50) + " " + items[0][1] + " " + words(50)),
            (2, words(30) + " " + " ".join(w[20:]) + " " + words(5) + " " + " ".join(w[:20])),  # halves swapped
            (3, " ".join(items[5][1].split(" ")[:20])), (4, None), (5, ""), (6, items[1][1].upper().replace(" ", ", ")),
            (7, items[1][1] + "\n" + items[2][1]), (8, "too short"), (7, words(9))]
    df = spark.createDataFrame([(i, t, "a") for i, t in docs], "doc_id long, text string, item_ids string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, coverage int")
    one = [(r.doc_id, r.contaminated, list(r.item_ids)) for r in decontaminate.flag(df, bench).collect()]
    want = {1: [0], 2: [3], 6: [1]}
    assert one == [(i, i in want or t is not None and i == 7 and "\n" in t, want.get(i, [1, 2] if t and "\n" in t else [])) for i, t in docs]
    many = [(r.doc_id, r.contaminated, list(r.item_ids)) for r in decontaminate.flag(df, bench, block_bytes=300).collect()]
    assert sorted(many) == sorted(one)  # a benchmark in several blocks
    assert not any(r.contaminated for r in decontaminate.flag(df, empty("item_id long, text string")).collect())
    assert decontaminate.flag(empty("doc_id long, text string"), bench).count() == 0


# ------------------------------------------------------------------ packing
def test_units_encode_like_the_whole_text(rnd):
    bits = [" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\xa0", "　", "\x85", "\x1c", "a", "'s", "don't", "été", "12", ".",
            "!!", "日本", "😀", "<|endoftext|>", "_", "the", "\x0b", "​", "́", "ß"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(2500)]
    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    want = [np.array(x.ids, "<u4").tobytes() for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert packing.UnitTokenizer(tokenizer_path(), limit=500)(texts) == want


def test_tasks_of_a_worker_share_a_tokenizer_and_encode_a_unit_once():
    one = packing.document_tokenizer(tokenizer_path())
    assert packing.document_tokenizer(tokenizer_path()) is one
    work, asked = one._model, []
    one._forget()
    one._model = lambda part: asked.append(part) or work(part)
    try:
        first = one(["the hat, the hat été\nthe hat"])
        assert len(asked) == len(set(asked)) and one(["the hat, the hat été\nthe hat"]) == first
        assert len(asked) == len(set(asked))
    finally:
        del one._model


def test_added_tokens_are_encoded_as_the_tokenizer_does(spark):
    rows = [(0, "<|endoftext|>"), (1, "a b <|endoftext|> c\nd  <|endoftext|><|endoftext|>"), (2, "x" * 10), (3, "<|endoftext>")]
    whole = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()}
    for i, t in rows:
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        assert (got[i].length, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert got[0].length == 2


def check_packing(rows, packed, capacity):
    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in rows}
    used = {}
    for r in packed:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for seq in used.values():
        seq.sort()
        assert [o for o, _ in seq] == [sum(n for _, n in seq[:k]) for k in range(len(seq))]
        assert sum(n for _, n in seq) <= capacity
    return used


def test_lines_of_rows_that_repeat_an_id(spark, words):
    """No line is lost where two texts have one id, and equal rows lose the same lines."""
    x, a, y, own = (words(12) for _ in range(4))
    rows = [(1, a), (5, f"{x}\n{a}"), (5, f"{y}\n{own}"), (5, f"{y}\n{own}"), (6, f"{own}\n{x}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark)
    got = line_dedup.dedup_lines(df, scratch, keep=("doc_id", "text")).collect()
    clean = {(r.doc_id, r.text): r.clean_text for r in got}
    assert len(got) == 5 and clean == {(1, a): a, (5, rows[1][1]): x, (5, rows[2][1]): rows[2][1], (6, rows[4][1]): ""}
    scratch.drop("dropped")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch.base)
    assert not len(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))


def test_only_the_first_piece_is_shorter(spark, words):
    rows = [(1, words(3000)), (2, words(5)), (3, "a\n\nb\tc  d " * 900), (4, "x y " * 511 + "z")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()
    check_packing(rows, got, 1024)
    for i, _ in rows:
        mine = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == i)
        assert all(n == 1024 for _, _, n in mine[1:]) and [s for _, s, _ in mine] == [sum(n for _, _, n in mine[:k]) for k in range(len(mine))]


def test_packing_holds_every_token_once(spark, rnd, words, empty):
    rows = [(i, words(rnd.randint(0, 900))) for i in range(150)] + [(200, None), (201, ""), (202, words(5000))]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, piece int")
    got = packing.pack(df, tokenizer_path()).collect()
    used = check_packing(rows, got, 1024)
    for i, _ in rows:
        mine = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == i)
        assert [p for p, _, _ in mine] == list(range(len(mine)))
        assert [s for _, s, _ in mine] == [sum(n for _, _, n in mine[:k]) for k in range(len(mine))]
    assert len(used) <= 1.03 * sum(r.length for r in got) / 1024 + 1
    assert packing.pack(empty("doc_id long, text string"), tokenizer_path()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_respects_every_capacity(rnd, rule):
    length = np.array(sorted((rnd.randint(1, 100) for _ in range(800)), reverse=True))
    where, offset, n = packing.best_fit(length, 100, 3, 6000, (1.0, 0.5, 0.5), rule)
    for b in range(n):
        own = length[where == b]
        assert own.sum() <= 100 and len(own) <= 3 and (own * own).sum() <= max(6000, own.max() ** 2 if len(own) == 1 else 0)
    assert len(set(zip(where.tolist(), offset.tolist(), strict=True))) == len(length)


def test_repeated_rows_are_packed_each(spark, words):
    text = words(30)
    df = spark.createDataFrame([(1, text)] * 5, "doc_id long, text string")
    got = packing.pack(df, tokenizer_path()).collect()
    assert len(got) == 5 and len({(r.sequence_id, r.offset) for r in got}) == 5


# --------------------------------------------------------------- extraction
PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="home sidebar-left"><header>Site name</header><nav><ul><li><a href="/">No menu</a></ul></nav>
<div class="cookie-notice">We use no cookies, no.</div><div class="ad">No advert, buy.</div>
<main><article><header><h1>The &amp; Title</h1></header><p>First   paragraph,
with <b>bold</b> and <i>italic</i>text.<br>Same block.<p>Second &eacute; one; unclosed.
<ul><li>Item one.<li>Item two.</ul><form>no <input> form</form><blockquote>A quote.</blockquote>
<div class="share">no share</div></article>
<section id="comments"><div class="comment"><p>No reader comment, long, with words, and marks. And more.</p></div></section></main>
<aside>No sidebar, it has text.</aside><footer>&copy; no footer</footer></body></html>"""


def test_extraction_of_an_article():
    assert html_extract.extract(PAGE) == ("The & Title\nFirst paragraph, with bold and italictext. Same block.\n"
                                          "Second é one; unclosed.\nItem one.\nItem two.\nA quote.")


def test_extraction_without_an_article_element():
    text = [f"Paragraph {k} has enough words, a comma or two, and an end. It goes on; it ends." for k in range(6)]
    page = ("<html><body><div class=top><a>Home</a> <a>About</a> <a>More</a></div><div id=content><h2>Heading</h2>"
            + "".join(f"<p>{t}</p>" for t in text) + "</div><table><tr><td><a>x</a><td><a>y</a></table></body></html>")
    assert html_extract.extract(page) == "\n".join(["Heading", *text])


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a</p", "a"), ("<p>1 < 2 & 3", "1 < 2 & 3"), ("<script>x", ""),
    ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<p hidden>no</p><p>yes.</p>", "yes."), ("<p>a&nbsp;&nbsp;b</p>", "a b"),
    ("<P>UP<SCRIPT>no</ScRiPt> more</P>", "UP more")])
def test_extraction_of_odd_pages(page, want):
    assert html_extract.extract(page) == want


def test_extraction_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    for p in pages.collect():
        body = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        parts = re.sub("</?(?:p|h1)>", "\0", body).replace("<br>", " ")
        from html import unescape
        lines = [" ".join(unescape(re.sub("<[^>]+>", "", x)).split()) for x in parts.split("\0")]
        assert got[p.page_id].text == "\n".join(x for x in lines if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_extraction_of_a_very_long_page_and_an_empty_table(spark, empty):
    schema = "page_id long, url string, html string, text string"
    assert html_extract.extract_pages(empty(schema)).count() == 0
    deep = "<div>" * 20_000 + "<p>deep text, here.</p>" + "<" * 20_000
    df = spark.createDataFrame([(1, None, deep, "t"), (2, "u", "<p>x, y.</p>" * 50_000, "t")], schema)
    got = {r.page_id: r for r in html_extract.extract_pages(df).collect()}
    assert got[1].text.startswith("deep text, here.") and got[2].text.count("\n") == 49_999


# --------------------------------------------------------------------- urls
def test_urls_match_their_sql(spark):
    urls = [None, "", "no scheme/casino", "http://EXAMPLE.org/ES/x", "http://example.org/es/x", "https://a.example.org/en/1234?q",
            "https://example.org/en/2", "http://x.com/fr/", "http://x.com/de/a", "http://com", "http://org/", "ftp://a.b.org",
            "http://a.net/free-bets", "http://a.net/free", "http://a.net/freebets", "http://casino.net", "http://casinos.net",
            "http://a.net/?q=FREE&x=win#t", "http://a.net/ads/ads", "http://a.net/xxx://org/", "http://notorg.net/", "http://u:p@h.org:80/x",
            "http://a.net/spam-spam_spam", "http://é.org/\n/x", "http://a.net/sexé", "://", "http:///p", "http://a.net?x#y"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    got = url_filter.filter_urls(df)
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url").toPandas())
    cur = con.execute(url_filter.sql())
    names = [d[0] for d in cur.description]
    key = lambda r: r["page_id"]
    want = sorted((dict(zip(names, r, strict=True)) for r in cur.fetchall()), key=key)
    assert sorted((r.asDict() for r in got.collect()), key=key) == want
    verdict = {urls[r.page_id]: (r.rule, r.verdict) for r in got.collect() if r.page_id < len(urls)}
    assert verdict["http://example.org/es/x"] == ("example.org/es/", "block")
    assert verdict["https://example.org/en/2"] == ("org/", "allow")
    assert verdict["http://a.net/free-bets"] == (None, "block") and verdict["http://a.net/free"] == (None, "allow")


def test_urls_of_an_empty_table(spark, empty):
    assert url_filter.filter_urls(empty("page_id long, url string")).count() == 0
