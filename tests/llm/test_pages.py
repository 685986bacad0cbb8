"""Main text and URL rules."""

import math
import random

import pytest

from ledgerline.llm import html_density, url_rules

ARTICLE = "<h1>A title</h1><p>First <b>bold</b> paragraph &amp; more.<p>Second\n  one,<br>with a break.</p><ul><li>item one<li>item two</ul>"
TEXT = "A title First bold paragraph & more. Second one, with a break. item one item two"
NOISE = (
    '<nav><a href="/a">Home</a> <a href="/b">About us</a></nav><div class="cookie-notice">We use cookies on this site</div>',
    '<aside>Read also other things</aside><form><label>Name</label><input></form><div class="comments"><p>Nice one, thanks</p></div>'
    "<footer>&copy; nobody</footer><script>var x = '</p><p>no';</script>",
)


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><style>p{}</style></head><body>{0}<article>{a}</article>{1}</body></html>",
        "<html><body>{0}<main><article>{a}</article></main>{1}</body></html>",
        '<html><body>{0}<div id="page"><div class="post">{a}</div></div>{1}</body></html>',
        "{0}<div>{a}</div>{1}",
        "<body><!-- <p>not this</p> -->{0}<article>{a}{1}</article></body>",
        "<BODY>{0}<ARTICLE>{a}</ARTICLE>{1}",
    ],
)
def test_main_text_of_many_layouts(page):
    html = page.replace("{0}", NOISE[0]).replace("{1}", NOISE[1]).replace("{a}", ARTICLE)
    assert html_density.main_text(html) == TEXT


def test_main_text_split_over_containers():
    part = "<div><p>" + "Some longer text that goes on. " * 5 + "</p><p>" + "And another paragraph here. " * 4 + "</p></div>"
    html = f"<body>{NOISE[0]}<div class='x'>{part}{part}{part}</div>{NOISE[1]}</body>"
    assert html_density.main_text(html).count("goes on.") == 15


def test_main_text_of_several_articles():
    parts = ["<article><h2>Part %d</h2><p>%s</p><p>Short.</p></article>" % (i, f"Sentence of part {i} that goes on. " * n) for i, n in enumerate((12, 5, 1, 9))]
    for page in ("<body>{0}%s{1}</body>", "<body>{0}<div><div>%s</div></div>{1}</body>", "<body>{0}<main>%s</main>{1}</body>"):
        text = html_density.main_text((page % "".join(parts)).replace("{0}", NOISE[0]).replace("{1}", NOISE[1]))
        assert [text.count(f"of part {i} ") for i in range(4)] == [12, 5, 1, 9] and text.count("Short.") == 4
        assert "Home" not in text and "thanks" not in text


def test_density_decides_between_and_within_articles():
    long = "<p>" + "A long sentence without any link in it. " * 8 + "</p>"
    links = "".join(f'<li><a href="/{i}">Teaser {i}</a></li>' for i in range(30))
    text = html_density.main_text(
        f"<body><article><ul>{links}</ul></article><article>Loose lead. <h1>Title</h1><div>{long * 4}</div><div><ul>{links}</ul></div><p>Of.</p></article></body>"
    )
    assert text.startswith("Loose lead. Title A long") and text.endswith("Of.") and "Teaser" not in text


@pytest.mark.parametrize("attributes", ['class="share-price table"', 'class="notice-board"', 'id="commentEnabled"', 'class="x shareholders"', 'class="menuette"'])
def test_names_of_other_things_delete_nothing(attributes):
    prose = "A sentence of the article that must stay where it is. " * 4
    page = f"<body>{NOISE[0]}<article class='post comment-enabled'><p>{prose}</p><div {attributes}><p>{prose}</p>Kept.</div><p {attributes}>{prose}</p></article>{NOISE[1]}</body>"
    text = html_density.main_text(page)
    assert text.count("must stay") == 12 and "Kept." in text and "Home" not in text


@pytest.mark.parametrize("attributes", ['class="adSlot"', 'class="ad-box top"', 'id="related-posts"', 'class="post share-buttons"', 'class="CommentsList"', 'role="complementary"'])
def test_names_of_parts_beside_the_text_do(attributes):
    prose = "A sentence of the article that must stay where it is. " * 4
    page = f"<body>{NOISE[0]}<article><p>{prose}</p><div {attributes}>Away with this text.</div><p>{prose}</p></article>{NOISE[1]}</body>"
    text = html_density.main_text(page)
    assert text.count("must stay") == 8 and "Away" not in text


def test_densities_by_their_definition():
    """Characters, tags and link shares of every node, and the sums, counted anew from the tree."""
    page = f"<body>{NOISE[0]}<div><h1>T &amp; x</h1><div><p>One <a href='/'>link</a> of <b>two</b>.</p><p>More text here.</p></div><ul><li><a href='/a'>a</a></li></ul></div></body>"
    nodes = html_density.parse(page)
    html_density._measure(nodes)
    html_density._score(nodes, next(n for n in nodes if n.tag == "body"))

    def under(node):
        for child in node.children:
            if not isinstance(child, str):
                yield child
                yield from under(child)

    def chars(node):
        return sum(len("".join(c.split())) if isinstance(c, str) else chars(c) for c in node.children)

    body = next(n for n in nodes if n.tag == "body")
    share = sum(chars(n) for n in under(body) if n.tag == "a") / chars(body)
    for node in nodes:
        below = list(under(node))
        links = chars(node) if node.tag == "a" else sum(chars(n) for n in below if n.tag == "a")
        link_tags = len(below) if node.tag == "a" else sum(1 for n in below if n.tag == "a")
        c, t = chars(node), max(len(below), 1)
        assert (node.chars, node.tags, node.link_chars, node.link_tags) == (c, len(below), links, link_tags)
        if c:
            base = math.log(math.log(c / max(c - links, 1) * links + share * c + math.e))
            density = c / t * math.log(max(c / max(links, 1) * t / max(link_tags, 1), 1)) / base if base > math.log(1.0001) else c / t
            assert node.density == pytest.approx(max(density, 0))
        assert node.sum == pytest.approx(sum(n.density for n in node.children if not isinstance(n, str)))


def test_odd_pages():
    for html in ("", "   ", "<", "<p", "</p>", "<!-- open", "<a href='x", "<script>", "&#xD800;", "<div hidden>x</div>"):
        html_density.main_text(html)
    assert html_density.main_text("just text &lt;b&gt;") == "just text <b>"
    assert html_density.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(html_density.main_text("<article><p>" + "word " * 200_000 + "</p></article>")) == 999_999


def test_extract_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", 7), (1, "u", f"<article>{ARTICLE}</article>", 7), (None, None, None, None), (2, "v", "", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    found = html_density.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found.collect()) == [
        ("1", TEXT, len(TEXT)), ("1", TEXT, len(TEXT)), ("2", "", 0), ("None", "", 0)
    ]
    assert html_density.extract(pages.limit(0)).count() == 0


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_url_rules_match_brute_force(spark):
    rng = random.Random(4)
    labels = ["com", "net", "a", "b", "www", "ab"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(25)]
    paths = ["/", "/a", "/a/", "/a/b", "/ab", "/b/", "", "/a/b/c"]
    rules = sorted({(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{rng.choice(hosts).upper()}{rng.choice(paths)}{rng.choice(['', 'x', '?q=1', '#f', '/b/c?x#y'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "http://", "x://com", "http://com.?q", "http://..com/a", "http://com:80/a", "http://évil.com/É"] + ["http://a.com/a"] * 50
    pages = spark.createDataFrame([(i % 7 or None, u, "r") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    found = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = sorted((str(r.page_id), str(r.url), r.host, r.path, str(r.rule), r.verdict) for r in found.collect())
    want = sorted((str(i % 7 or None), str(u), *[str(x) if k == 2 else x for k, x in enumerate(brute(u, rules))]) for i, u in enumerate(urls))
    assert got == want


def test_url_rules_of_nothing(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id int, url string")
    assert [tuple(r) for r in url_rules.judge(pages, rules, default="block").drop("url").collect()] == [(1, "a.com", "/x", None, "block")]
    assert url_rules.judge(pages.limit(0), rules).count() == 0
