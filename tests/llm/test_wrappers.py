import random
import re
import time
import tracemalloc
from html import unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewalk.llm import queries, wrappers
from tidewalk.llm.wrappers import Page, Wrapper, align, fold, main_text


def page(body, nav="<nav><ul><li>Home</li><li>News</li></ul></nav>", foot="<footer>&copy; us</footer>"):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{nav}{body}{foot}</body></html>"


def text_of(source, *others):
    pages = [Page(p) for p in (source, *others)]
    wrapper = Wrapper.of(pages[0])
    for other in pages[1:]:
        wrapper = wrapper.merge(Wrapper.of(other))
    return main_text(Page(source), Wrapper.loads(wrapper.dumps()))


def test_copies_fold_into_groups_and_nested_groups():
    nodes, first = fold(Page("<ul><li>a</li><li>b</li></ul><ul><li>c</li></ul><p>x</p><p>y</p><p>z</p>"))
    assert [n.label for n in nodes][-1] == "(<p> # </p>)+"
    assert len(set(first.values())) == 3  # one slot for a and b, one for c, one for the paragraphs


def test_alignment_keeps_order_and_length():
    assert align(list("abcd"), list("axcd")) == [(0, 0), (1, None), (None, 1), (2, 2), (3, 3)]
    assert align([], list("a")) == [(None, 0)] and align(list("ab"), list("ab")) == [(0, 0), (1, 1)]


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for k, y in enumerate(b):
            row.append(before[k] + 1 if x == y else max(row[-1], before[k + 1]))
    return row


@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40), st.sampled_from([0, 6, 1 << 16]))
@settings(max_examples=300, deadline=None)
def test_divided_alignments_are_as_long(a, b, cells):
    before, wrappers.TABLE_CELLS = wrappers.TABLE_CELLS, cells
    try:
        pairs = align(a, b)
    finally:
        wrappers.TABLE_CELLS = before
    assert [i for i, _ in pairs if i is not None] == list(range(len(a)))
    assert [j for _, j in pairs if j is not None] == list(range(len(b)))
    assert all(a[i] == b[j] for i, j in pairs if i is not None and j is not None)
    assert sum(i is not None and j is not None for i, j in pairs) == common_length(a, b)[-1]
    assert wrappers._common(a, b).tolist() == common_length(a, b)


def test_large_streams_are_aligned_in_little_memory():
    rng = random.Random(1)
    a = [f"t{rng.randrange(30)}" for _ in range(12_000)]
    b = [x for x in a if rng.random() < 0.9]
    tracemalloc.start()
    pairs = align(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(i is not None and j is not None for i, j in pairs) == len(b) and peak < 50 << 20


def test_long_groups_fold():
    card = "<li class=card><div><h3>{0}</h3><p>{0} text</p><p><a>{0} more</a></p><i>{0}</i></div></li>"
    pages = [Page("<ul>" + "".join(card.format(f"{i}.{k}") for k in range(180 + i)) + "</ul>") for i in range(3)]
    assert len(pages[0].labels) > 180 * 15
    wrapper = Wrapper.of(pages[0])
    for other in pages[1:]:
        wrapper = wrapper.merge(Wrapper.of(other))
    assert len(wrapper.nodes) == 3  # the list's tags and one repeated card
    group = "".join(f"<pre class={'abcdefg'[k % 7] * (k + 1)}>x</pre>" for k in range(60))
    nodes, first = fold(Page(group * 3))
    assert len(nodes) == 1 and len(set(first.values())) == 60


def test_ids_and_numbers_do_not_make_new_forms():
    forms = {Wrapper.of(Page(f"<article id=post-{i} class='post post-{i * 7}'><p id=p{i}>{i}</p></article>")).signature() for i in range(50)}
    assert len(forms) == 1


def test_lists_of_options_formulas_and_objects():
    assert text_of("<article><p>a</p><select><option>x<p>rest of the article</p></article>") == "a\nrest of the article"
    assert text_of("<article><p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><object><p>fallback</p></object></article>") == "a x=2 b\nfallback"
    assert text_of("<article><p>a</p><svg><text>label</text></svg><p>b</article>") == "a\nlabel\nb"
    assert text_of("<article><p>a</p><select><option>x</select><p>b</p><noscript>no</noscript><iframe>f</iframe><p>c") == "a\nb\nc"
    assert text_of("<article><p>a</p><iframe src=x><p>b</p></article>") == "a\nb"  # never closed: a plain tag


def test_a_page_of_many_tokens_and_a_host_of_many_forms():
    rng = random.Random(3)
    big = [Page("<article>" + "".join(f"<{t}>{k}</{t}>" for k, t in enumerate(rng.choices(["p", "h2", "pre", "li"], k=13_500))) + "</article>") for _ in range(2)]
    assert all(len(p.labels) > 40_000 for p in big)
    started = time.monotonic()
    wrapper = Wrapper.of(big[0]).merge(Wrapper.of(big[1]))
    assert main_text(big[0], wrapper).count("\n") == 13_499
    assert time.monotonic() - started < 120


def test_merging_gives_optional_and_repeated_groups():
    one = Wrapper.of(Page("<article><h1>a</h1><p>b</p></article>"))
    two = Wrapper.of(Page("<article><h1>a</h1><h2>s</h2><p>c</p><p>d</p></article>"))
    merged = one.merge(two)
    assert merged.signature() == "<article> <h1> # </h1> <h2>? #? </h2>? (<p> # </p>)+ </article>"
    constant = {n.label: [s[3] for s in n.slots] for n in merged.nodes}
    assert constant["(<p> # </p>)+"] == [None] and constant["#"][0] is not None


def test_article_without_furniture():
    body = (
        "<header>Site</header><div class='ad'>buy</div><div id=cookie-notice>we use</div><article><header><h1>T &amp; U</h1></header>"
        "<p>One\n  <b>two</b>&nbsp;three<br>four<p>five <i>six</i> <b>seven</b><div class=\"ad box\">ad</div><ul><li>l1<li>l2</ul>"
        "<form>f<input></form><style>x</style></article><aside>side</aside><section class=comments><article>c1</article></section>"
    )
    assert text_of(page(body)) == "T & U\nOne two three four\nfive six seven\nl1\nl2"


def test_pages_without_article_lose_the_texts_that_all_pages_share():
    pages = [page(f"<div>Welcome to us</div><div><p>story {i}</p></div>") for i in range(4)]
    assert text_of(pages[0], *pages[1:]) == "story 0"
    assert text_of(pages[0]) == "Welcome to us\nstory 0"


def test_a_block_that_one_page_alone_has_is_kept():
    plain = [page(f"<div>Welcome to us</div><div><p>story {i}</p></div>") for i in range(9)]
    special = page("<div>Welcome to us</div><div><h2>once</h2><p>story 9</p><blockquote>said once</blockquote></div>")
    for pages in ([special, *plain], [special, *plain[:2]], [special]):
        assert text_of(pages[0], *pages[1:]).endswith("once\nstory 9\nsaid once")
    assert text_of(special, *plain) == "once\nstory 9\nsaid once"  # the shared text still goes


def test_copies_of_a_page_count_once():
    copy, other = (page(f"<div>Welcome to us</div><div><p>story {name}</p></div>") for name in ("a", "b"))
    assert text_of(copy, *[copy] * 9) == "Welcome to us\nstory a"
    assert text_of(copy, *[copy] * 9, other) == "Welcome to us\nstory a"
    assert text_of(copy, *[copy.replace("<div>", f"<div data-n={i}>") for i in range(9)]) == "Welcome to us\nstory a"


def test_hosts_of_copies_and_optional_blocks(spark):
    copy = page("<div>Welcome</div><div><p>same</p></div>")
    rows = [(i, "http://copies.example/x", copy) for i in range(6)]
    rows += [(10 + i, "http://many.example/x", page(f"<div>Welcome</div><div><p>story {i}</p>{'<h2>once</h2>' * (i == 3)}</div>")) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    assert got == {i: "Welcome\nsame" for i in range(6)} | {10 + i: f"story {i}" + "\nonce" * (i == 3) for i in range(8)}


@pytest.mark.parametrize("source", [
    "", "plain text", "<", "<p", "<article", "<article><p>x", "</p></article>", "<!-- open", "<script>never closed", "a < b > c",
    "<p class='x>y</p>", "<a b=\"c>d", "<p>" * 2000, "<p>x</p>" * 5000, "<div><div>" * 500 + "x", "<b>" + "x" * 300_000, "&#0;&#x110000;&bad;",
    "<article><nav>m<article>t</article>",
])
def test_broken_pages_have_a_text(source):
    assert isinstance(text_of(source, page("<article><p>other</p></article>")), str)


def test_truncated_article_is_read_to_its_end():
    assert text_of("<article><p>one</p><p>two", page("<article><p>x</p></article>")) == "one\ntwo"


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "http://a.example/x", None), (3, None, page("<article><p>x</p></article>")),
            (4, "http://a.example/y", page("<article><p>y</p></article>")), (4, "http://a.example/y", page("<article><p>y</p></article>")),
            (None, "http://a.example/z", ""), (5, "nonsense", page("<article>" + "<p>w</p>" * 3000 + "</article>"))]
    pages = spark.createDataFrame([(*r, "t", "h") for r in rows], "page_id long, url string, html string, text string, host string")
    got = sorted((tuple(r) for r in wrappers.extract(pages.repartition(3)).collect()), key=str)
    texts = {1: "", 2: "", 3: "x", 4: "y", None: "", 5: "\n".join(["w"] * 3000)}
    assert got == sorted(((i, u, texts[i], len(texts[i])) for i, u, _ in rows), key=str)
    assert wrappers.extract(pages.where("page_id > 99")).collect() == []


def test_wrappers_joined_by_a_shuffle_give_the_same(spark, sf_dir, monkeypatch):
    query = queries.QUERIES["op6_html_extraction"]
    once = sorted(map(tuple, query(spark, sf_dir).collect()))
    monkeypatch.setattr(wrappers, "WRAPPERS_BROADCAST", 0)
    assert sorted(map(tuple, query(spark, sf_dir).collect())) == once


def test_query_gives_the_article_of_every_page(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op6_html_extraction"](spark, folder).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        plain = [" ".join(unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
        assert r["text"] == "\n".join(b for b in plain if b) and r["n_chars"] == len(r["text"])
