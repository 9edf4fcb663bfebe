"""HTML extraction."""

import html
import math
import random
import re
import time
from collections import Counter, defaultdict

from billscope.llm import sitetree
from billscope.llm.queries import QUERIES, prepared

SF = "/root/testdata/sf0.001"


def text_of(page, branches=frozenset(), contents=frozenset()):
    return sitetree.main_text(page, branches, contents)


def test_blocks_and_references():
    page = "<html><head><title>no</title><style>p{}</style></head><body><article><h1>A &amp;  B</h1><p>one<br>two\n three<p>four <b>five</b> &lt;six&gt;</article></body>"
    assert text_of(page) == "A & B\n\none two three\n\nfour five <six>"


def test_named_noise_goes():
    page = """<body><header>site</header><nav><ul><li>menu<li>more</ul></nav><main><header><h1>Title</h1></header><p>Text</p>
      <div class="ad-slot big">buy</div><aside>side</aside><div id="cookieNotice">ok?</div><form><input>find</form><section class="comments"><p>nice!</p></section>
      <p hidden>x</p><p style="display: none">y</p><ul><li>kept one<li>kept two</ul><script>var t="</p>";</script><!-- c --></main>
      <div class="sidebar"><p>links</p></div><footer>end</footer>"""
    assert text_of(page) == "Title\n\nText\n\nkept one\n\nkept two"


def test_names_of_layouts_are_no_noise():
    page = """<body class="with-sidebar"><div class="layout has-sidebar"><article class="post no-comments"><p>Text</p><article class="comment-item"><p>nice</p></article></article>
      <div class="sidebar-box">x</div></div></body>"""
    assert text_of(page) == "Text"


def test_broken_markup():
    assert text_of("") == "" and text_of("plain < text & more") == "plain < text & more"
    assert text_of("<p>a<div>b</div>c</p>d") == "a\n\nb\n\nc\n\nd"
    assert text_of("<p>open <b>bold<p>next</i>") == "open bold\n\nnext"
    assert text_of("<!-- never closed <p>x") == "" and text_of("<script>x") == ""
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
    assert len(text_of("<p>" + "<a" * 50_000 + ">z")) > 0 and text_of("<div>" * 5000 + "deep") == "deep"


def test_embedded_parts_end_where_they_end():
    article = "<article><p>Text</p></article>"
    for icon in ("<svg/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<svg><path d='x'/><title/><text>no</text></svg>", "<noscript>no</noscript>", "<object data=x><p>no</p></object>", "<iframe src=x>", "<svg/><svg><text>no</text></svg>"):
        assert text_of(f"<body>{icon}{article}") == "Text", icon
        assert text_of(f"<body><div>{icon}<p>Text</p></div><svg><text>no</text></svg></body>") == "Text", icon
    for part in ("object", "noscript", "template", "svg"):  # never closed, alone and before one that is
        assert text_of(f"<body><div><{part}><p>Text</p></div><p>more</p></body>") == "Text\n\nmore"
        assert text_of(f"<body><{part}><p>Text</p><{part}>no</{part}><p>more</p></body>") == "Text\n\nmore"


def test_names_of_an_articles_sections_stay():
    page = """<body><article><h1 id='notice'>Title</h1><section id='discussion'><p>one</p></section><h2 id='related-work'>Related</h2><p>two</p>
      <h2 id='search-algorithms'>Search</h2><section id='comments'><p>three</p></section><div class='section' id='notice'><p>four</p></div>
      <div class='follow-up'>five</div><div class='related-posts'><a href=x>other page</a></div></article></body>"""
    assert text_of(page) == "Title\n\none\n\nRelated\n\ntwo\n\nSearch\n\nthree\n\nfour\n\nfive"


def test_wrappers_of_the_page_stay():
    page = "<body><form id='aspnetForm'><div class='menu'><a href=x>menu</a></div><p>The text of the page</p><form>find</form></form></body>"
    assert text_of(page) == "The text of the page"
    assert text_of("<body><div class='widget-page'><p>Text of the page</p></div></body>") == "Text of the page"
    assert text_of("<body><form>find <a href=x>all of it</a></form><p>Text of the page</p></body>") == "Text of the page"


def test_a_teaser_is_not_the_page():
    story = "a story told in a plain part " * 30
    assert text_of(f"<body><div class=x><p>{story}</p></div><article>teaser</article></body>") == f"{story.strip()}\n\nteaser"
    assert text_of(f"<body><div class=x>some links</div><article><p>{story}</p></article></body>") == story.strip()


def test_names_beside_a_word_of_the_subject():
    for name in ("post-header", "side-by-side", "menu-review", "code-comment", "signup-intro", "cookie-recipe"):
        for page in ("<body><article><div class='{}'><h1>Head</h1></div><p>Text of it</p></article></body>", "<body><div class='{}'><h1>Head</h1></div><p>Text of it</p></body>"):
            assert text_of(page.format(name)) == "Head\n\nText of it", name
    for name in ("menu", "mainMenu", "comment-body", "comments", "reply-box", "header", "site-header", "cookie-bar", "signup-form", "footer-legal", "ad-leaderboard", "side"):
        assert text_of(f"<body><div class='{name}'>noise</div><p>Text of it</p></body>") == "Text of it", name


def test_inline_parts_nobody_reads():
    for attribute in ("hidden", "style='display: none'", "style='visibility:hidden'", "class=advert", "class='ad-link'"):
        assert text_of(f"<body><p>One <span {attribute}>no <b>no</b><a href=x>no</a></span>two</p><p>three</p></body>") == "One two\n\nthree", attribute
        assert text_of(f"<body><p>One <span {attribute}>no</p><p>three</p></body>") == "One\n\nthree"  # never closed
    assert text_of("<body><p>One <i aria-hidden=true>1</i> <span class='comment'>// kept</span></p></body>") == "One 1 // kept"


def test_time_does_not_grow_with_depth():
    pages = ["<div><p>some text</p>" * 8000, "<b>" * 8000 + "<b>x<p>y" * 1000, "<div>" * 8000 + "</x>" * 8000, "<ul>" + "<span>" * 8000 + "<li>x" * 1000, "<b>" * 8000 + "x<br>" * 8000]
    for page in pages:
        begin = time.process_time()
        sitetree.observations(page)
        text_of(page)
        assert time.process_time() - begin < 2


def test_contents_are_sequences_of_blocks():
    def hashes(page):
        nodes, blocks = sitetree.parse(page)
        found = sitetree.contents_of(nodes, blocks)
        return [found.get(i) for i, node in enumerate(nodes) if node.tag == "div"]

    one, other = hashes("<p>before</p><div><p>a</p><ul><li>b<li>c</ul></div>"), hashes("<div>a<p>b</p><b>c</b></div><p>x</p>")
    assert one == other and len({*one, *hashes("<div><p>a<p>c<p>b</div>"), *hashes("<div><p>a<p>b</div>"), *hashes("<div><p>ab<p>c</div>")}) == 4
    assert hashes("<p>x</p><div><p>alone</p></div>") == [sitetree.block_hash("alone")] and hashes("<div><div hidden>x</div></div>") == [None, None]


def site(n, extra=""):
    pages = []
    for i in range(n):
        body = "".join(f"<p>page {i} paragraph {k} says {i * k}</p>" for k in range(3 + i % 4))
        pages.append((i, f"http://h.example/{i}", f"<body><div class=top><b>Our site</b><i>Since 1990</i></div><div class=text><h2>Head {i}</h2>{body}<p>Copyright line</p></div>{extra}</body>"))
    return pages


def test_the_tree_cuts_what_repeats_over_a_host(spark):
    rows = site(30) + [(100, "http://other.example/a", "<body><div class=top><b>Our site</b></div><p>alone</p></body>"), (101, None, "<p>no host</p>"), (102, "http://h.example/x", None), (None, "http://h.example/y", "")]
    rows += [rows[3]]
    frame = prepared(spark).createDataFrame([(*row, "n") for row in rows], "page_id long, url string, html string, text string")
    got = sitetree.extract(frame).collect()
    assert len(got) == len(rows)
    found = {r["page_id"]: r for r in got}
    for i in range(30):
        want = [f"Head {i}"] + [f"page {i} paragraph {k} says {i * k}" for k in range(3 + i % 4)]
        assert found[i]["text"] == "\n\n".join(want) and found[i]["n_chars"] == len(found[i]["text"])
    assert found[100]["text"] == "Our site\n\nalone" and found[101]["text"] == "no host" and found[102]["text"] == found[None]["text"] == ""


def test_small_hosts_keep_all(spark):
    frame = prepared(spark).createDataFrame(site(5), "page_id long, url string, html string")
    assert all(r["text"].startswith("Our siteSince 1990\n\nHead") for r in sitetree.extract(frame).collect())
    assert sitetree.extract(frame.where("false")).collect() == []


def texts(spark, rows):
    frame = prepared(spark).createDataFrame([(i, f"http://h.example/{i}", page) for i, page in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(sitetree.extract(frame).collect(), key=lambda r: r["page_id"])]


def test_short_articles_under_a_long_template(spark):
    template = "<div class=t>" + "template of the site " * 25 + "</div>"
    pages = [f"<body>{template}<div class=x><p>{f'article {i} ' * 30}</p></div></body>" for i in range(12)]
    want = [f"article {i} " * 29 + f"article {i}" for i in range(12)]
    assert texts(spark, pages) == want
    assert texts(spark, pages[:6]) == want[:6]  # few pages, all alike in the template


def test_soft_names_and_the_tree(spark):
    """A softly named branch goes by its importance on the host: what varies stays, what repeats on most pages goes."""
    pages = [f"<body><p>page {i} is this</p><div class=notice>{'closed on Monday' if i < 17 else f'one {i}'}</div><div class=discussion>page {i} discussed</div></body>" for i in range(20)]
    assert texts(spark, pages)[:17] == [f"page {i} is this\n\npage {i} discussed" for i in range(17)]


def test_copies_of_a_page_are_one_page_of_the_tree(spark):
    copies = ["<body><div class=story><div class='intro budget'><p>All of it</p></div><p>More of it</p></div></body>"] * 12
    others = [f"<body><div class=story><p>Other text {i}</p><p>and {i * i}</p></div></body>" for i in range(3)]
    assert texts(spark, copies + others)[:12] == ["All of it\n\nMore of it"] * 12


def test_a_page_meets_its_own_low_branches_only(spark):
    """A host with many templates has many low branches; the cuts of a page do not grow with them."""
    rows = [f"<body><div class='t-{chr(97 + t)}'>template {t}</div><p>page {t} {i}</p></body>" for t in range(20) for i in range(8)]
    frame = prepared(spark).createDataFrame([(f"k{i}".encode(), "h", page) for i, page in enumerate(rows)], "key binary, host string, html string")
    seen = sitetree.observed(frame)
    low = sitetree.site_trees(seen)
    assert low.where(f"kind = {sitetree.PRESENCE}").count() == 20
    cuts = sitetree.page_cuts(seen, low).collect()
    assert len(cuts) == len(rows) and all(len(r["branches"]) == 1 and len(r["contents"]) <= 1 for r in cuts)
    assert texts(spark, rows) == [f"page {t} {i}" for t in range(20) for i in range(8)]


def direct_low(pages):
    """Low branches and content nodes of one host's distinct pages, by the definition of importance."""
    parts = defaultdict(lambda: defaultdict(Counter))
    for seen in {digest: seen for digest, seen in map(sitetree.observations, pages)}.values():
        for path, kind, value in seen:
            if kind != sitetree.BLOCK:
                parts[path][kind][value] += 1

    def logs(n):
        return math.log(max(n - sitetree.DOUBT, 1.0))

    low = set()
    for path, kinds in parts.items():
        m = kinds[sitetree.PRESENCE][0]
        if m < 2:
            continue
        presentation = 1 - sum(n / m * logs(n) / math.log(m) for n in kinds[sitetree.PRESENTATION].values())
        contents = kinds[sitetree.CONTENT]
        content = sum(n * (1 - logs(n) / math.log(m)) for n in contents.values()) / sum(contents.values()) if contents else 0.0
        prior = 1 - (1 - sitetree.SOFT_PRIOR) * kinds[sitetree.SOFTLY][0] / m
        if prior * ((1 - sitetree.CONTENT_SHARE) * presentation + sitetree.CONTENT_SHARE * content) < sitetree.LEAST_BRANCH:
            low.add((path, sitetree.PRESENCE, 0))
        low |= {(0, sitetree.BLOCK, value) for value, n in contents.items() if n > 1 and 1 - logs(n) / math.log(m) < sitetree.LEAST_CONTENT}
    return low


def test_importance_by_its_definition(spark):
    draw = random.Random(5)
    word = lambda most: f"w{draw.randrange(most)}"
    pages = []
    for i in range(60):
        parts = ["<div class=logo>Our site</div>"]
        parts += [f"<div class=mixed><p>{word(2)}</p></div>"] * draw.randrange(2) + [f"<div class=notice>{word(3)}</div>"] * draw.randrange(2)
        parts += [f"<p>{i} {word(99)}</p>" for _ in range(draw.randrange(1, 5))] + ["<p>All rights reserved</p>"] + [f"<div class=rare>{'same' if draw.random() < 0.9 else word(9)}</div>"] * draw.randrange(2)
        pages.append(f"<body>{''.join(parts)}</body>")
    pages += pages[:9]
    frame = prepared(spark).createDataFrame([(f"k{i}".encode(), "h", page) for i, page in enumerate(pages)], "key binary, host string, html string")
    got = {(r["path"], r["kind"], r["value"]) for r in sitetree.site_trees(sitetree.observed(frame)).collect()}
    assert got == direct_low(pages) and {kind for _, kind, _ in got} == {sitetree.PRESENCE, sitetree.BLOCK}


def test_pages_of_the_data_set(spark):
    """Every page of the data set has one article; read it here by its tags alone."""
    got = {r["page_id"]: r["text"] for r in QUERIES["op3_html_extraction"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?(?:p|h1)>", article)]
        assert got[row["page_id"]] == "\n\n".join(b for b in blocks if b)
