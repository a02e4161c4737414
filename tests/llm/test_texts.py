"""Functions on single texts, against plain versions of the same rules."""

import base64
import hashlib
import html as html_
import random
import re
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from catalogflow.llm import attribution, html, packing, pii, quality
from catalogflow.llm.tokens import Encoder

ODD = ["", " ", "  ", "a  b", "a \n b", " a", "a ", "x\n\n\ny", "日本 語　テ スト", "it's we'll <|endoftext|> z", "\x1c a \x1c", "é è  ü", "🙂 🙂a", "1 2 33 x", "\r\n a\t b", "é́ "]


def odd_texts(n=400):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "é", "日", "'s", "1", "!", " ", "\x1c", " ", "🙂", "\t", "<|endoftext|>", "Z", "̀", "​"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def whole():
    import public_tokenizers as public

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return t


def test_ids_and_spans_are_those_of_whole_texts(whole):
    small, large = Encoder(limit=16), Encoder()
    for text in odd_texts():
        want = whole.encode(text, add_special_tokens=False)
        for e in (small, large):
            assert np.frombuffer(e.ids(text), "<u4").tolist() == want.ids
        starts, ends = large.spans(text)
        assert len(starts) == len(want.ids)
        if len(starts):
            assert starts[0] == 0 and ends[-1] == len(text) and (starts < ends).all() and (np.diff(starts) >= 0).all()


def test_tokens_that_cross_a_bound_go_to_the_larger_part():
    starts, ends = np.array([0, 2, 6]), np.array([2, 6, 7])
    owner, crossing = attribution.allocate(starts, ends, np.array([0, 3, 7]))
    assert owner.tolist() == [0, 1, 1] and crossing.tolist() == [False, True, False]
    owner, _ = attribution.allocate(np.array([0]), np.array([2]), np.array([0, 1, 2]))
    assert owner.tolist() == [0]  # a tie goes to the earlier section
    assert attribution.sections_of("a\nb\n").tolist() == [0, 2, 4] and attribution.sections_of("").tolist() == [0, 0]


def plain_base(text):
    email = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    return email + ip


def test_base_spans():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b.c", "@", ".", "-", "1", "256", "0001", " ", "_", "é"]) for _ in range(rng.randrange(25)))
        assert [x for x in pii.detect(text) if x[0] < 2] == plain_base(text), text
    assert pii.detect("4111 1111 1111 1111") == [(2, 0, 19)] and pii.detect("4111 1111 1111 1112") == []
    assert pii.detect("+49 (30) 123-4567") == [(3, 0, 17)] and pii.detect("+12 34") == []


@pytest.mark.parametrize("text,kind,hidden", [
    ("write to john [at] mail [dot] example (dot) com today", "email", "john [at] mail [dot] example (dot) com"), ("john at mail dot example dot com", "email", "john at mail dot example dot com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"), ("a one nine two dot one six eight dot one dot one b", "ip", "one nine two dot one six eight dot one dot one"),
    ("plus four nine, one five one two three four five six seven", "phone", "plus four nine, one five one two three four five six seven"),
    ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"), ("null vier acht " + "eins " * 3, None, None), ("meet at noon. We are", None, None)])
def test_disguises(text, kind, hidden):
    assert [(pii.KINDS[k], text[a:b], base) for k, a, b, base in pii.find(text)] == ([(kind, hidden, False)] if kind else [])


@pytest.mark.parametrize("hidden", [
    "192[.]168[.]1[.]1", "192 [dot] 168 [dot] 1 [dot] 1", "10 dot 0 dot 0 dot 1", "10 punkt 0.0 (punto) 1", "192 dot one six eight dot 1 dot one", "one dot 0 dot zero dot 1", "one nine two [dot] one six eight [dot] one [dot] one"])
def test_disguised_dots_between_digits(hidden):
    text = f"see {hidden}, ok"
    assert [(pii.KINDS[k], text[a:b], base) for k, a, b, base in pii.find(text)] == [("ip", hidden, False)]
    assert pii.redact(text) == "see <IP>, ok"


@pytest.mark.parametrize("kind,hidden", [("phone", "+49 one seven six 1234567"), ("card", "4111 1111 1111 11 one one"), ("phone", "+49 (one seven) 61234567")])
def test_digits_spelled_in_part(kind, hidden):
    """A span depends on its own words alone."""
    for text in (f"call {hidden}; ok", f"call {hidden}; a [dot] b", f"\u0430 {hidden}; ok"):
        assert (pii.KINDS.index(kind), text.index(hidden), text.index(hidden) + len(hidden), False) in pii.find(text)


def test_redaction_and_long_runs():
    assert pii.redact("a x@y.zz b") == "a <EMAIL> b" and pii.redact(None) is None and pii.redact("") == ""
    assert pii.find("a" * 300_000) == [] and len(pii.find("a@b.c " * 20_000)) == 20_000


def test_counts():
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
        lines = text.split("\n")
        dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)

    rng = random.Random(3)
    for text in [*odd_texts(), *(" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) + rng.choice(["", "\nx\nx\n"]) for _ in range(300))]:
        assert quality.text_counts(text)[:5] == plain(text)
    assert quality.text_counts(None) == quality.text_counts("")


def test_chi2():
    assert abs(quality.chi2_quantile(0.95, 6) - 12.5916) < 1e-3


PAGE = """<body><header><h1>Site</h1></header><nav><a href=x>Menu</a></nav><div class="cookie-notice"><p>We use cookies, really a lot of them.</p></div>
<main><article><h1>Title &amp; more</h1><p>First <b>bo</b>ld paragraph with\n  words &lt;3 <a href=y>link</a>.<p>Second paragraph that was not closed<ul><li>one<li>two</ul><!-- <p>no</p> -->
<form><p>Sign up</p></form><script>var x = "<p>no</p>";</script></article><aside>Other</aside><section id="comments"><p>Reader says this is a very long comment indeed.</p></section></main><footer>&copy; x</footer>"""


def test_main_text():
    assert html.main_text(PAGE) == "Title & more First bold paragraph with words <3 link. Second paragraph that was not closed one two"
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x</script>") == ""
    assert html.main_text("plain &am text") == html_.unescape("plain &am text")
    assert html.main_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


LONG = "a sentence with quite a few words in it, " * 8


@pytest.mark.parametrize("page,want", [
    (f"<body><div id=content>Intro text<div><p>{LONG}</p><p>{LONG}</p></div><ul><li>short item</li><li>item <a href=x>two</a></li></ul></div></body>", f"Intro text {LONG} {LONG} short item item two"),
    (f"<body><div><div>By <b>A</b>nn, <a href=x>home</a>.<div><p>{LONG}</p><p>{LONG}</p></div>After &amp; all<ol><li>{LONG}</ol></div></div></body>", f"By Ann, home. {LONG} {LONG} After & all {LONG}"),
    (f"<body><div><a href=x>Home</a> | <a href=y>News</a></div><div><a href=x>Up</a> &nbsp;|<div><p>{LONG}</p><p>{LONG}</p></div><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div><div class=footer>no</div></body>", f"{LONG} {LONG}"),
    (f"<body><div class=menu>no</div>text in the body<div><div>{LONG}</div><div>{LONG}</div></div></body>", f"text in the body {LONG} {LONG}")])
def test_main_text_of_div_pages(page, want):
    assert html.main_text(page) == " ".join(want.split())


def test_open_sequences():
    rng = random.Random(4)
    for most in (1, 3, 50):
        bins, fill = packing.OpenSequences(100, most), {}
        for _ in range(3000):
            n = rng.randrange(1, 101)
            number, offset = bins.place(n)
            assert fill.get(number, 0) == offset and offset + n <= 100
            fill[number] = offset + n
            assert bins._open <= most
    assert base64.b32encode(hashlib.sha1(b"").digest()).decode() == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


# ---- marks of elements that hold the article --------------------------------------------------

ARTICLE = "<p>" + "The first paragraph has words enough to be dense. " * 4 + "</p><p>" + "And the second one as well, without a link. " * 4 + "</p>"
WORDS = " ".join(re.sub("<[^>]+>", " ", ARTICLE).split())


@pytest.mark.parametrize("page", [
    '<div class="content no-sidebar">{}</div>', '<div class="site has-sidebar"><article>{}</article></div>', '<body><form action="/x">{}</form></body>',
    '<form><article>{}</article></form>', '<div id="sidebar"><main>{}</main></div>', '<div class="widget"><div>{}</div></div><div class="sidebar">links here</div>',
    '<div class="page with-comments without-menu">{}</div>', '<article class="promo">{}</article>', '<div id="search"><div class="modal">{}</div></div>',
])
def test_elements_that_hold_the_article_stay(page):
    assert html.main_text(page.format(ARTICLE)) == WORDS


@pytest.mark.parametrize("mark", ['class="share-price"', 'id="related-work"', 'class="search-algorithm"', 'class="x notice-of-death y"', 'class="skip-list"', 'id="social-history"'])
def test_words_of_other_tokens_are_no_marks(mark):
    inner = f"<article>{ARTICLE}<div {mark}><p>A part of the article.</p></div></article>"
    assert html.main_text(inner) == WORDS + " A part of the article."


@pytest.mark.parametrize("mark", ['class="comments"', 'class="box comment-list"', 'id="main-menu"', 'class="site_footer"', 'class="cookie-banner"', 'role="navigation"', 'class="sidebar-left"', 'class="Newsletter"', 'class="ads-top"'])
def test_marked_elements_go(mark):
    for inner in (f"<article>{ARTICLE}<div {mark}><p>Not of it.</p></div></article>", f"<div>{ARTICLE}</div><div {mark}><p>Not of it.</p></div>"):
        assert html.main_text(inner) == WORDS


def test_comments_longer_than_the_article_go():
    remarks = "<div class='comments'>" + "<p>I have read this and say very much about it here.</p>" * 40 + "</div>"
    assert html.main_text(f"<div><div>{ARTICLE}</div>{remarks}</div>") == WORDS


@pytest.mark.parametrize("wrap", ["<div>{}</div>", "<article>{}</article>"])
def test_lists_and_text_within(wrap):
    inner = f"Text before. <div>{ARTICLE}</div><ul><li>A list item that is as long as a line of text should be.</li></ul>"
    assert html.main_text(wrap.format(inner)) == f"Text before. {WORDS} A list item that is as long as a line of text should be."


def test_deep_pages_in_linear_time():
    for page in ("<div>" * 50_000 + "word", "<div>" * 50_000 + "</x>" * 50_000 + "word", "<li>" * 20_000 + "<header>" * 20_000 + "</b>word", "<p>" * 50_000 + "word", "<table>" * 20_000 + "<td>" * 20_000 + "word"):
        began = time.perf_counter()
        html.main_text(page)
        assert time.perf_counter() - began < 5


def test_long_runs_of_digits_in_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "one " * 30_000):
        began = time.perf_counter()
        pii.find(text)
        assert time.perf_counter() - began < 5


def test_html_table(spark):
    schema = "page_id long, html string, text string, url string"
    rows = [(1, f"<article>{ARTICLE}</article>", "other", "u"), (1, f"<article>{ARTICLE}</article>", "other", "u"), (None, None, None, None), (2, "", "t", "u")]
    got = spark.createDataFrame(rows, schema).select("page_id", html.extract_main_text("html").alias("text")).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in got) == [("1", WORDS), ("1", WORDS), ("2", ""), ("None", "")]
    assert spark.createDataFrame([], schema).select(html.extract_main_text("html")).count() == 0
