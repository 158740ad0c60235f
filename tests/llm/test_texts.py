"""Page text, fingerprints, repetition and repeated passages."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import chunks, html_text, repetition, simhash

from .conftest import prose

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style><script>var a="</p>";</script></head>
<body class="has-sidebar nav-open"><header><a href=/>Home</a> Site name</header><div id="cookie-notice">We use cookies</div>
<nav><ul><li><a href=/a>Menu</a></ul></nav><!-- a comment --><div class="page sidebar-right">%s
<div class="sidebar"><p>Popular posts of the week</p></div></div><div class="ad">Buy now</div>
<form><p>Your mail <input></p></form><section id="comments"><p>%s</p></section><footer>&copy; 2024</footer></body></html>"""
COMMENT = "A reader comment that goes on and on and is much longer than the article so that density alone would choose it. " * 5


def test_article_without_the_page_around_it():
    article = "<article><h1>Tea &amp; milk</h1><p>First <b>bold</b>  text.<br>Next&nbsp;line<p>Short.<ul><li>one<li>two</ul></article>"
    want = "Tea & milk\nFirst bold text. Next line\nShort.\none\ntwo"
    assert html_text.main_text(PAGE % (article, COMMENT)) == want


def test_unmarked_article_is_found_by_density():
    body = "<div class=text>" + "".join(f"<p>Paragraph {i} has quite a few words and no links at all in it.</p>" for i in range(4)) + "</div>"
    got = html_text.main_text(PAGE % ("<h1>Heading</h1>" + body, COMMENT))
    assert got.split("\n")[-4:] == [f"Paragraph {i} has quite a few words and no links at all in it." for i in range(4)]
    assert "cookies" not in got and "comment" not in got and "Popular" not in got and "Menu" not in got


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>x", "x"), ("<script>var a='<p>';</script>", ""),
    ("<div>a<span>b</span> c<div>d</div>e</div>", "ab c\nd\ne"), ("<article><p>cut off <a href='x", "cut off"),
    ("<article><p>a &am</p></article>", "a &am"), ("<article></article><footer>x</footer>", ""), ("<p>a<!-- b", "a"),
    ("<article><p>" + "word " * 50000 + "</p></article>", " ".join(["word"] * 50000)),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
])
def test_odd_pages(html, want):
    assert html_text.main_text(html) == want


_LONG = "<p>" + "A paragraph of the article with quite a few words in it and no links. " * 4 + "</p>"
_LONG_TEXT = " ".join(("A paragraph of the article with quite a few words in it and no links. " * 4).split())


@pytest.mark.parametrize("html, want", [
    (f"<body><form id=aspnet><input type=hidden><div>{_LONG * 2}</div><select><option>x</select><button>Go</button></form></body>",
     f"{_LONG_TEXT}\n{_LONG_TEXT}"),
    ("<body><form role=form><article><p>Short.</p></article></form></body>", "Short."),
    (f"<body><div>{_LONG}</div><form><p>Your mail <input></p></form></body>", _LONG_TEXT),
    ("<script><!-- code </script><article><p>article</p></article>", "article"),
    ("<article><p title='<!--'>article</p><p>more</p></article>", "article\nmore"),
    ("<article><p>a</p><!-- b <p>c</p>", "a"),
    ("<body><div><p>Copyright reform passed the senate.</p></div></body>", "Copyright reform passed the senate."),
    (f"<body><div><p>Copyright 2019 was the year.</p>{_LONG}</div></body>", f"Copyright 2019 was the year.\n{_LONG_TEXT}"),
    (f"<body><div>{_LONG}</div><div>Copyright 2019 Example</div></body>", _LONG_TEXT),
    ("<body>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</body>", "deep"),
])
def test_article_text_is_not_dropped_by_rules(html, want):
    assert html_text.main_text(html) == want


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = Counter(tuple(r) for r in html_text.extract(pages).collect())
    assert got == Counter({(1, "u", "a", 1): 2, (None, None, "", 0): 1, (2, "v", "", 0): 1})
    assert html_text.extract(pages.limit(0)).count() == 0


def test_given_pages_have_the_text_of_their_article(spark):
    """The generated pages hold nothing but headings and paragraphs in their article."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S).group(1)
        parts = [re.sub(r"<br>", " ", p) for p in re.split(r"</?(?:p|h1)>", article)]
        texts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
        assert row.text == "\n".join(t for t in texts if t)


def by_hand(rows):
    """Fingerprint rows in descending order of id, null last; ties in any order are the same text here."""
    texts = [r[1] or "" for r in rows]
    out = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        marks = simhash.fingerprints([text, changed, following]).view(np.int64).tolist()
        out.append((rows[i][0], len(text), hashlib.sha256(changed.encode()).hexdigest(), *marks))
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 2000])
def test_fingerprints_against_a_loop(spark, odd_rows, part_bytes):
    rows = [r for r in odd_rows if r[0] not in (5, None)]
    rows.append((None, "short text"))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = simhash.fingerprint_documents(docs, part_bytes).collect()
    assert Counter(tuple(r) for r in got) == Counter(by_hand(ordered))


def test_fingerprints_of_odd_tables(odd, odd_rows, empty):
    got = simhash.fingerprint_documents(odd, 3000).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in odd_rows)
    assert all(r.edited_sha256 for r in got)
    assert simhash.fingerprint_documents(empty).count() == 0


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(4, "abcd")], "doc_id bigint, text string")
    row = simhash.fingerprint_documents(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.fingerprint == row.next_fingerprint


def test_near_copies_have_near_fingerprints():
    rnd = random.Random(2)
    a = prose(rnd, 400).split()
    b = list(a)
    b[200] = "other"
    c = prose(rnd, 400)
    x, y, z = (int(v) for v in simhash.fingerprints([" ".join(a), " ".join(b), c]))
    assert bin(x ^ y).count("1") < 10 < bin(x ^ z).count("1")


@pytest.mark.parametrize("radius, blocks", [(3, 6), (2, 4), (0, 3), (5, 7)])
def test_search_finds_all_within_the_radius(spark, radius, blocks):
    rnd = random.Random(radius)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    marks = set(centres)
    for c in centres:
        for _ in range(10):
            x = c
            for bit in rnd.sample(range(64), rnd.randint(0, radius + 2)):
                x ^= 1 << bit
            marks.add(x)
    signed = [int(np.uint64(m).view(np.int64)) for m in marks]
    frame = spark.createDataFrame([(m,) for m in signed], "fingerprint bigint")
    asked = frame.filter(F.pmod("fingerprint", F.lit(3)) == 0)
    got = [tuple(r) for r in simhash.within_radius(asked, frame, radius, blocks).collect()]
    mask = (1 << 64) - 1
    want = [
        (q, m, bin((q ^ m) & mask).count("1")) for q in signed if q % 3 == 0 for m in signed
        if bin((q ^ m) & mask).count("1") <= radius
    ]
    assert sorted(got) == sorted(want)


def slow_repeats(words, least=5):
    n, best = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best[i] = max(best[i], k)
    best = [b if b >= least else 0 for b in best]
    return len({p for i, b in enumerate(best) for p in range(i, i + b)}), max(best, default=0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aabc"), max_size=35), max_size=6))
def test_repeats_against_a_loop(docs):
    got = repetition.measure([" ".join(d) for d in docs])
    assert [(r[4], r[5]) for r in got.tolist()] == [slow_repeats(d) for d in docs]


def test_repetition_of_odd_rows(odd, odd_rows, empty):
    rows = {(r.doc_id, r.n_words): r for r in repetition.repetition(odd).collect()}
    assert repetition.repetition(odd).count() == len(odd_rows)
    assert rows[2, 0].base_failed and rows[3, 0].base_failed and rows[4, 0].word_chars == 0
    assert rows[7, 12].n_repeat_words == 12 and rows[7, 12].longest_repeat == 11 and not rows[7, 12].kept
    assert rows[0, 120].kept and rows[5, 6000].kept
    kept = repetition.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in repetition.repetition(odd).collect())
    assert repetition.repetition(empty).count() == 0 and repetition.keep_good(empty).count() == 0


def test_one_long_repeat_is_rejected():
    rnd = random.Random(3)
    part, rest = prose(rnd, 150), prose(rnd, 3000)
    counts = repetition.measure([f"{part} {rest} {part}", rest])
    failed, kept = repetition.verdicts(counts, 10, 20, 100)
    assert failed.tolist() == [False, False] and kept.tolist() == [False, True] and counts[0, 5] == 150


def test_symbols_and_lines():
    text = "a#b $5\n \nline\nline\n\tline\nline %&|<>*"
    n_words, chars, symbols, lines = repetition.measure([text])[0][:4]
    assert (n_words, symbols, lines) == (7, 8, 1) and chars == sum(len(w) for w in text.split())


def test_chunks_of_many_texts_are_those_of_each():
    rnd = random.Random(4)
    texts = [prose(rnd, n).encode() for n in (0, 3, 40, 400)] + [b"x" * 3000, "é😀 ".encode() * 300]
    owner, begins, stops, start, end = chunks.chunks(texts, 96, 32, 8)
    for i, text in enumerate(texts):
        own = owner == i
        alone = chunks.chunks([text], 96, 32, 8)
        assert [begins[own].tolist(), stops[own].tolist()] == [alone[1].tolist(), alone[2].tolist()]
        for b, e, s, f in zip(begins[own], stops[own], start[own], end[own], strict=True):
            assert text[b:e].decode() == text.decode()[s:f] and e - b >= 96
    assert chunks.chunks([], 96, 32, 8)[0].size == 0


def test_shared_passages_are_found_and_clean_documents_left_alone(spark):
    rnd = random.Random(6)
    passages = [prose(rnd, 55) for _ in range(20)]
    rows, planted = [], {}
    for i in range(60):
        own = [prose(rnd, rnd.randint(20, 80)), prose(rnd, rnd.randint(20, 80))]
        text = f"{own[0]} {passages[i % 20]} {own[1]}" if i < 40 else " ".join(own)
        planted[i] = (len(own[0]) + 1, len(own[0]) + 1 + len(passages[i % 20]))
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chunks.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} <= set(range(20, 40))
    assert len({r.doc_id for r in found}) >= 19
    for r in found:
        assert r.first_doc_id == r.doc_id - 20
        # a letter or two beside the passage may be equal by chance
        assert planted[r.doc_id][0] - 3 <= r.start < r.end <= planted[r.doc_id][1] + 3
    cut = {r.doc_id: r.text for r in chunks.without_repeats(docs).collect()}
    spans = {r.doc_id: (r.start, r.end) for r in found}
    for i, text in rows:
        lo, hi = spans.get(i, (0, 0))
        assert cut[i] == text[:lo] + text[hi:]


def test_repeated_passages_of_odd_tables(odd, empty):
    found = chunks.repeated_passages(odd).collect()
    assert {r.doc_id for r in found} <= {0, 1, 5, None}
    kept = chunks.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert chunks.repeated_passages(empty).count() == 0


def test_exact_copies_are_one_passage(spark):
    text = prose(random.Random(7), 200)
    docs = spark.createDataFrame([(i, text) for i in range(50)], "doc_id bigint, text string")
    found = chunks.repeated_passages(docs).collect()
    assert sorted((r.doc_id, r.start, r.end, r.first_doc_id) for r in found if r.doc_id) == [(i, 0, len(text), 0) for i in range(1, 50)]


def test_every_passage_of_51_words_holds_a_chunk(spark):
    rnd = random.Random(8)

    def words(n, longest):
        return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, longest))) for _ in range(n))

    rows, planted = [], {}
    for i in range(0, 400, 2):
        passage = words(51, 1 + i % 3)
        for j in (i, i + 1):
            own = words(rnd.randint(1, 60), 9)
            rows.append((j, f"{own} {passage} {words(rnd.randint(1, 60), 9)}"))
            planted[j] = len(own) + 1, len(own) + 1 + len(passage)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chunks.repeated_passages(docs).collect()
    hit = {r.doc_id for r in found if r.start < planted[r.doc_id][1] and planted[r.doc_id][0] < r.end and r.first_doc_id == r.doc_id - 1}
    assert hit == set(range(1, 400, 2)) and {r.doc_id for r in found} == hit


def test_copies_of_short_texts_are_repeats(spark):
    rows = [(1, "one short line"), (2, "one short line"), (3, "é"), (4, "é"), (5, " "), (6, " "), (7, ""), (8, ""), (9, "another line")]
    rows += [(10, " ".join("abcdefghijklmnopqrstuvwxyz") + " x"), (11, " ".join("abcdefghijklmnopqrstuvwxyz") + " x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.doc_id, r.start, r.end, r.first_doc_id) for r in chunks.repeated_passages(docs).collect())
    assert found == [(2, 0, 14, 1), (4, 0, 1, 3), (11, 0, 53, 10)]


def test_word_chunks_of_many_texts_are_those_of_each():
    rnd = random.Random(9)
    texts = [prose(rnd, n).encode() for n in (0, 3, 25, 26, 27, 51, 52, 400)] + [b"x" * 3000, b" \n", "é 😀 ".encode() * 300, b" lead " * 40]
    found = chunks.all_chunks(texts, 96, 32, 8)
    for i, text in enumerate(texts):
        own = found[0] == i
        assert [x[own].tolist() for x in found[1:]] == [x.tolist() for x in chunks.all_chunks([text], 96, 32, 8)[1:]]
        for _, b, e, s, f in zip(*[x[own] for x in found], strict=True):
            assert text[b:e].decode() == text.decode()[s:f] and e > b


LONG = "Some words of the article that go on for a while, so that they count. " * 4


@pytest.mark.parametrize("part, kept", [
    ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<p id="search-algorithms">Search algorithms find things.</p>', "Search algorithms find things."),
    ('<section class="social-history"><p>Social history of a town.</p></section>', "Social history of a town."),
    ('<section id="discussion"><h2>Discussion</h2><p>What it means.</p></section>', "What it means."),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p>", "Let x=2 hold."),
])
def test_names_do_not_drop_article_text(part, kept):
    page = f"<html><body><article><h1>Title</h1><p>{LONG}</p>{part}<p>{LONG}</p></article></body></html>"
    assert kept in html_text.main_text(page).split("\n")


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "with-ads", "sidebar"])
def test_the_holder_of_the_text_stays(name):
    page = f'<body><div class="{name}"><h2>Title</h2><p>{LONG}</p><p>{LONG}</p></div><div class="footer">Imprint of the page</div></body>'
    got = html_text.main_text(page)
    assert got.count("\n") >= 1 and got.count(LONG.strip()) == 2 and "Imprint" not in got


@pytest.mark.parametrize("name", ["ad", "global-nav", "social-links", "cookieBanner", "related-posts", "ADS", "comments-area", "newsletter-signup"])
def test_parts_named_as_no_article_go(name):
    page = f'<body><div><h2>Title</h2><p>{LONG}</p><div class="{name}"><p>Other things to see.</p></div><p>{LONG}</p></div></body>'
    assert "Other things" not in html_text.main_text(page)


@pytest.mark.parametrize("opened, closed", [("<span>", "</i>"), ("<b>", "</p>"), ("<p><b>", "</i>"), ("<div>", "</span>"), ("<span>", "<div>x</div>")])
def test_pages_with_very_many_open_tags(opened, closed):
    start = time.time()
    text = html_text.main_text("<body><p>begin</p>" + opened * 100_000 + "words of it" + closed * 100_000 + "<p>end</p>")
    assert "words of it" in text and time.time() - start < 30
