"""Token counts, chat formatting, WARC archives and page extraction on small hand-made inputs."""

import hashlib
import random
import time

import public_tokenizers
import pytest
from cyclemart.llm import chat, extract, token_counts, warc
from cyclemart.llm.common import materialise, working_path


def greedy(pieces, word):
    longest, at, n = max(map(len, pieces)), 0, 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at:at + k] in pieces), 0)
        n += 1 if size else len(word[at].encode())
        at += size or 1
    return n


def test_automaton_counts_like_greedy_matching():
    r = random.Random(3)
    for _ in range(800):
        pieces = {"".join(r.choice("abcé") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 12))}
        automaton = token_counts.LongestMatch(sorted(pieces))
        for _ in range(5):
            word = "".join(r.choice("abcéz") for _ in range(r.randint(0, 14)))
            assert automaton.count(word) == greedy(pieces, word), (pieces, word)


def test_token_counts_of_a_table(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = set(token_counts.vocabulary(path))
    texts = ["the cat", None, "", "  ", "日本 zß\x00", "a " * 20000, "the cat"]
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    found = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(rows, path).collect()}
    for i, t in enumerate(texts):
        words = (t or "").split()
        assert found[i] == (len(words), sum(greedy(pieces, "▁" + w) for w in words))
    assert token_counts.token_counts(rows.limit(0), path).count() == 0


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (1, 3, "assistant", "fine"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "other"), (3, 0, "user", "hi"),
    (4, 0, "user", None), (4, 0, "user", None), (5, 0, None, "x"), (None, 0, "user", "hi"), (6, None, "assistant", "é\U0001f600"),
]


@pytest.fixture
def whole(spark):
    return chat.conversations(spark.createDataFrame(TURNS, "conv_id long, turn int, role string, text string"))


def test_siblings_are_paired_once(whole):
    pairs = [tuple(r) for r in chat.pair_by_opening(whole).collect()]
    assert pairs == [(1, 2)]
    for together in (1, 3):
        used = [x for r in chat.pair_by_opening(whole, together).collect() for x in r]
        assert len(used) == len(set(used)) == 2 and set(used) <= {1, 2, 3}


def test_prefix_is_rendered_once_and_masks_cover_replies(spark, whole):
    pairs = spark.createDataFrame([(1, 2), (1, 1), (1, 99)], "chosen long, rejected long")
    rows = {(r.chosen_id, r.rejected_id): r for r in chat.preference_examples(chat.named_pairs(whole, pairs)).collect()}
    assert set(rows) == {(1, 2), (1, 1)}
    row = rows[1, 2]
    assert row.common_turns == 2
    assert row.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    assert row.chosen == "<|im_start|>user\nmore<|im_end|>\n<|im_start|>assistant\nfine<|im_end|>\n"
    assert [row.chosen[m.start:m.stop] for m in row.chosen_mask] == ["fine<|im_end|>"]
    assert row.rejected_mask == []
    same = rows[1, 1]
    assert (same.common_turns, same.chosen, same.rejected) == (4, "", "")


def test_reply_swaps(whole):
    rows = {r.chosen_id: r for r in chat.preference_examples(chat.reply_swaps(whole)).collect()}
    assert set(rows) == {1, 2, 6}
    assert rows[1].common_turns == 3 and "fine" in rows[1].chosen and "yes" in rows[1].rejected
    assert rows[6].common_turns == 0 and [rows[6].chosen[m.start:m.stop] for m in rows[6].chosen_mask] == ["é\U0001f600<|im_end|>"]


def test_chat_on_no_rows(spark, whole):
    empty = whole.limit(0)
    assert chat.preference_examples(chat.named_pairs(empty, chat.pair_by_opening(empty))).count() == 0
    assert chat.preference_examples(chat.reply_swaps(empty)).count() == 0


PAGES = [
    (3, "http://a/x", "<p>same</p>"), (1, "http://a/y", "<p>same</p>"), (2, None, ""), (4, "http://b/%\r\nz", None),
    (5, "u", "é" * 70000), (6, "u", "WARC/1.1\r\n"), (6, "u", "WARC/1.1\r\n"), (None, "u", "<p>same</p>"), (None, "u", "alone"),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")
    rows = sorted((str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to), r.payload_digest) for r in warc.round_trip(pages).collect())
    first = {"<p>same</p>": 1, "": 2, "é" * 70000: 5, "WARC/1.1\r\n": 6, "alone": None}
    expected = sorted(
        (str(i), len((h or "").encode()), "response" if first[h or ""] == i else "revisit", str(None if first[h or ""] == i else first[h or ""]),
         warc.digest((h or "").encode())) for i, _, h in PAGES)
    assert rows == expected
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and len(hashlib.sha1(b"").digest()) == 20
    assert warc.round_trip(pages.limit(0)).count() == 0


def reader(data):
    at = [0]

    def read(n):
        at[0] += n
        return data[at[0] - n:at[0]]

    return read


def archive(compressed):
    records = [warc.record_bytes("response", str(i), f"http://h/{i}", b"x%d" % i * 3000, None) for i in range(6)]
    return [warc.member(r) if compressed else r for r in records]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_recovers_all_but_the_damaged(compressed, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 700)
    records = archive(compressed)
    for bad in range(6):
        broken = bytearray(records[bad])
        broken[len(broken) // 2] ^= 0x5A
        data = b"".join(bytes(broken) if i == bad else r for i, r in enumerate(records))
        rows = list(warc.salvage("f", reader(data)))
        assert [r["page_id"] for r in rows if not r["problem"]] == [str(i) for i in range(6) if i != bad]
        gaps = [(r["position"], r["stored"]) for r in rows if r["problem"]]
        assert gaps == [(sum(map(len, records[:bad])), len(broken))]
    cut = b"junk" + b"".join(records)[:-10]
    rows = list(warc.salvage("f", reader(cut)))
    assert [r["page_id"] for r in rows if not r["problem"]] == [str(i) for i in range(5)]
    assert sum(r["stored"] for r in rows) == len(cut)
    assert list(warc.salvage("f", reader(b""))) == []
    assert [r["stored"] for r in warc.salvage("f", reader(b"\x1f"))] == [1]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_reads_headers_of_any_length(compressed):
    urls = ["http://h/" + "q" * n for n in (0, 100_000, 5, 3_000_000)]
    records = [warc.record_bytes("response", str(i), u, b"x" * 50, None) for i, u in enumerate(urls)]
    rows = list(warc.salvage("f", reader(b"".join(warc.member(r) if compressed else r for r in records))))
    assert [(r["problem"], r["uri"]) for r in rows] == [(None, u) for u in urls]


def test_round_trip_keeps_long_urls_and_fails_on_lost_records(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "data:" + "é" * 100_000, "a"), (2, "u", "b")], "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.round_trip(pages).collect()) == [1, 2]
    write = warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda *a: write(*a).selectExpr("archive", "records + 1 AS records", "bytes"))
    with pytest.raises(RuntimeError, match="read back"):
        warc.round_trip(pages)


def test_archives_roll_over_and_keep_payloads(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    folder = working_path(spark, "warc-test")
    written = materialise(warc.write_archives(pages, folder, archive_bytes=600), "warc-test-list")
    assert written.count() > 3 and written.selectExpr("sum(records)").first()[0] == 40
    rows = warc.read_archives(spark, folder, written).collect()
    assert {r.page_id: r.payload.decode() for r in rows} == {str(i): f"page {i} " * 50 for i in range(40)}
    assert {r.uri for r in rows} == {f"u{i}" for i in range(40)}


def text_of(page):
    return "\n".join(b.text for b in extract.blocks(page) if b.declared != 0)


@pytest.mark.parametrize("page, text", [
    ("<body style='overflow-x: hidden'><div style=\"overflow:hidden\"><article>k</article></div></body>", "k"),
    ("<div data-id=ad data-class='nav' title='hidden role=menu'>k</div><div hidden>x</div><div class=a hidden=''>x</div>", "k"),
    ("<div style=overflow:hidden>k</div><div id=ad>x</div><div class=a class=nav>l</div><div aria-hidden=TRUE>x</div>", "k\nl"),
    ("<article><p>a</p><svg viewBox='0 0 1 1'/><p>b</p><math/><p>c</p></article>", "a\nb\nc"),
    *((f"<article><div><{t}>x<p>y</p></div><p>k</p></article><div><{t}>x</{t}></div><p>l</p>", "k\nl") for t in ("object", "select", "noscript", "svg", "math")),
    ("<p>a <svg><text>x</text><g><svg>y</svg>z</g></svg> b</p><p><a href=u>c<svg>x</a> d</p>", "a\nb\nc\nd"),
    ("<select><option>x<option>y</select><object><object>x</object>y</object><noscript><style>p{}</style><p>x</noscript><p>k</p>", "k"),
])
def test_blocks_of_ordinary_markup(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  &amp; text", "plain & text"),
    ("<article><h1>T</h1><p><b>One<br><p>two\n three</p></article><footer>f</footer>", "T\nOne\ntwo three"),
    ("<article><p>a &lt;b&gt; &#233;&am", "a <b> é&am"), ("<article><p>a</p></arti", "a"), ("<p>a <b>b</b><i>c</i></p>d", "a bc\nd"),
    ("<nav>n<p>m</nav><aside>x</aside><p>k</p><form>q</form>", "k"), ("<script>var t='</p>';</script><style>p{}</style><p>k</p><script>x", "k"),
    ("<div class='comments'><article><p>no</p></article></div><main><p>yes</p></main>", "yes"), ("<!-- c --><p title='a>b'>k</p><!-- cut", "k"),
    ("<div class=ad>x</div><div class='read-more'>y</div>", "y"), ("<header>h</header><article><header><h1>t</h1></header></article>", "t"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"), ("<p>a <span class=share>no</span> b</p>", "a b"), ("<a href=\"x", ""),
])
def test_blocks(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page", [
    '<div class="layout has-sidebar"><article>kept <b>text</b></article></div>', '<div class="page no-comments"><article>kept text</article></div>',
    '<form id="aspnetForm"><article>kept text</article></form>', '<div id="sidebar-layout"><nav>x</nav><main>kept text</main></div>',
    '<article>kept text</article><section class="comments"><article>a reader</article></section>',
    '<article>kept text</article><div class=ad><article>buy</article></div>', '<form><input>send<article>kept text</article></form>',
    '<article>kept <a class="ad">buy</a> text</article>'])
def test_an_article_survives_what_wraps_it(page):
    assert "\n".join(b.text for b in extract.blocks(page) if b.declared == 1) == "kept text"


@pytest.mark.parametrize("piece", ["<div>x", "<b>x", "<x-y>x", "</i>x<b>", "<p>x</q>", "<li>x<ul>", "<table><td>x"])
def test_long_pages_take_linear_time(piece):
    start = time.perf_counter()
    found = extract.blocks(piece * (150_000 // len(piece)))
    assert time.perf_counter() - start < 3 and "".join(b.text for b in found).replace(" ", "").count("x") == 150_000 // len(piece)
    assert max(len(b.path) for b in found) <= extract.DEPTH


def brute_importance(pages, s):
    """Importance of every style node of a host, from the definition."""
    import math

    texts, styles = {}, {}
    for number, page in enumerate(dict.fromkeys(pages)):
        for b in extract.blocks(page):
            if b.declared is None:
                for d in range(2, len(b.path) + 1):
                    texts.setdefault(b.path[:d], {}).setdefault(b.text, set()).add(number)
                    styles.setdefault(b.path[:d], {}).setdefault(number, []).append("/".join(b.path[d:]))
    out = {}
    for node, by_page in styles.items():
        n = len(by_page)
        if n > 1:
            content = 1 - sum(math.log(len(on)) / math.log(n) for on in texts[node].values()) / len(texts[node])
            kinds = {}
            for seen in by_page.values():
                kinds["|".join(seen)] = kinds.get("|".join(seen), 0) + 1
            shown = -sum(k / n * math.log(k / n) / math.log(n) for k in kinds.values())
            fade = s.gamma ** len(kinds)
            out["/".join(node)] = (1 - fade) * shown + fade * content
    return out


def test_importance_equals_brute_force(spark):
    r = random.Random(3)
    pages = []
    for _ in range(12):
        body = "".join(f"<div class=c{r.randint(0, 2)}>{r.choice(['same', f'word{r.randint(0, 99)}'])}<p>{r.randint(0, 4)}</p></div>" for _ in range(r.randint(1, 4)))
        pages.append(f"<html><body><div class=top>Home | News</div>{body}<div class=end>All rights</div></body></html>")
    pages += pages[:3]
    s = extract.ExtractSettings()
    source = spark.createDataFrame([("h", k % 12, p) for k, p in enumerate(pages)], "host string, page_hash long, page string")
    found = {r.node: r.importance for r in extract.importance(extract.style_nodes(source, "page"), s).collect()}
    expected = {extract._hash(k): v for k, v in brute_importance(pages, s).items()}
    assert found.keys() == expected.keys() and all(abs(found[k] - expected[k]) < 1e-9 for k in found)
    rows = spark.createDataFrame([(k, "http://h/x", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    cut = {k for k, v in brute_importance(pages, s).items() if v < s.threshold}
    for row in extract.extract(rows).collect():
        kept = [b.text for b in extract.blocks(pages[row.page_id]) if not any("/".join(b.path[:d]) in cut for d in range(2, len(b.path) + 1))]
        assert row.text == "\n".join(kept) and "Home" not in row.text and "rights" not in row.text



def test_style_tree_cuts_what_every_page_of_a_host_repeats(spark):
    def page(i):
        return f"<html><body><div class=top>menu one</div><div class=body><p>text {i} a</p><p>text {i} b</p></div><div class=end><b>all rights</b></div></body></html>"

    rows = [(i, "http://Host.example/x", page(i)) for i in range(6)] + [(9, "http://other.example/", page(9)), (10, None, page(10)), (11, "http://host.example:80/", None)]
    rows += [(20 + i, "http://copies.example/", page(0)) for i in range(5)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in extract.extract(pages).collect()}
    assert len(found) == len(rows)
    for i in range(6):
        assert found[i].text == f"text {i} a\ntext {i} b" and found[i].n_chars == 17
    # One distinct page is no evidence: nothing is cut from a single page or from copies of one.
    for i in (9, 10, 20, 24):
        assert found[i].text.startswith("menu one\ntext ") and found[i].text.endswith("all rights")
    assert found[11].text == "" and found[11].n_chars == 0
    assert extract.extract(pages.limit(0)).count() == 0
