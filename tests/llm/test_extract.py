"""Main text against the definition on plain trees, and on pages of many kinds."""

import html
import math
import random
import re
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from callscore.llm import extract
from callscore.llm.extract import main_text


# ---- the definition, on a tree that the standard parser builds from well-formed pages ----

class Tree(HTMLParser):
    def __init__(self, page):
        super().__init__()
        self.root = self.at = {"tag": "body", "up": None, "kids": [], "n": 0}
        self.count = 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.count += 1
        node = {"tag": tag, "up": self.at, "kids": [], "n": self.count, "attrs": dict(attrs)}
        self.at["kids"].append(node)
        self.at = node

    def handle_endtag(self, tag):
        self.at = self.at["up"]

    def handle_data(self, data):
        self.at["kids"].append(data)


def below(n):
    return [n] + [x for k in n["kids"] if not isinstance(k, str) for x in below(k)]


def text(n):
    return "".join(k if isinstance(k, str) else text(k) for k in n["kids"])


def size(s):
    return len(re.sub(r"\s", "", s))


def is_block(n):
    return n["tag"] in ("div", "p", "ul", "li", "section", "h2")


def brute(page):
    body = Tree(page).root
    every = below(body)
    linked = lambda n: sum(size(text(a)) for a in below(n) if a["tag"] == "a")
    share = linked(body) / max(size(text(body)), 1)

    def composite(c, t, lc, lt):
        if not c:
            return 0
        b = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(t, 1) * (1 if b <= 1 else math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / math.log(b))

    def density(n):
        inner = below(n)[1:]
        return composite(size(text(n)), len(inner), size(text(n)) if n["tag"] == "a" else linked(n), sum(x["tag"] == "a" for x in inner))

    def holds_blocks(n):
        return any(is_block(x) for x in below(n)[1:])

    def total(n):
        if not holds_blocks(n):
            return density(n)
        return sum(composite(size(k), 1, 0, 0) if isinstance(k, str) else density(k) for k in n["kids"])

    def parents(n):
        return [n] + (parents(n["up"]) if n["up"] else [])

    def reachable(n):
        return [n] + [x for k in n["kids"] if not isinstance(k, str) and holds_blocks(n) for x in reachable(k)]

    def largest(n):
        return max(reachable(n), key=lambda x: (total(x), -x["n"]))

    if not size(text(body)):
        return ""
    core = largest(body)
    threshold = min(density(x) for x in parents(core))
    marked = [core] + [largest(x) for x in reachable(body) if density(x) >= threshold and x is not body]
    top = max((x for x in every if all(any(x is y for y in parents(m)) for m in marked)), key=lambda x: len(parents(x)))
    out, line = [], []

    def flush():
        if (t := " ".join("".join(line).split())):
            out.append(t)
        line.clear()

    def walk(n):
        for k in n["kids"]:
            if isinstance(k, str):
                line.append(k)
                continue
            if is_block(k):
                flush()
            if not (k["tag"] in ("ul", "div", "section") and 2 * linked(k) > size(text(k))):
                walk(k)
            if is_block(k):
                flush()

    walk(top)
    flush()
    return "\n".join(out)


def random_page(r, deep=0):
    words = lambda n: " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 9))) for _ in range(n))
    parts = []
    for _ in range(r.randint(1, 5)):
        kind = r.random()
        if kind < 0.3 and deep < 4:
            parts.append(f"<{(t := r.choice(['div', 'section']))}>{random_page(r, deep + 1)}</{t}>")
        elif kind < 0.6:
            parts.append(f"<p>{words(r.randint(1, 40))}<b>{words(2)}</b> <a href='x'>{words(r.randint(1, 4))}</a>{words(r.randint(0, 9))}</p>")
        elif kind < 0.75:
            parts.append("<ul>" + "".join(f"<li><a href='y'>{words(2)}</a>{words(r.randint(0, 2))}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
        elif kind < 0.9:
            parts.append(f"<h2>{words(3)}</h2>\n")
        else:
            parts.append(words(r.randint(1, 30)))
    return "".join(parts)


def test_brute_force():
    for seed in range(400):
        page = random_page(random.Random(seed))
        assert main_text(page) == brute(page), (seed, page)


# ---- pages of many kinds ----

PARAGRAPHS = ["The first paragraph of the article says at some length what this is all about, and it goes on a little.",
              "Short one.", "A third paragraph with a <a href='/x'>link inside</a> and <em>marked</em> words, so that tags are not a reason to leave it out."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = "\n".join(["Title", *[re.sub(r"<[^>]+>", "", p) for p in PARAGRAPHS]])
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Section number {i}</a></li>" for i in range(8)) + "</ul>"


def page(before="", after="", inside="", holder="article"):
    return f"<!DOCTYPE html><html><head><title>No</title><script>if (a < b) x('</p>');</script><style>p>b{{}}</style></head><body>{before}<{holder}><h1>Title</h1>{inside}{BODY}</{holder}>{after}</body></html>"


def test_what_is_not_the_article_goes():
    junk = [f"<nav>{MENU}</nav>", "<header><h1>Site</h1>A site about all sorts of things.</header>", "<footer>Address, imprint and rights of this site.</footer>",
            "<aside>More about the author, who has written a lot of things over the years.</aside>", "<div class='ad'>Buy this very good thing now, it is cheap today.</div>",
            "<div id='cookie-notice'>We use cookies, as everybody does. Accept?</div>", "<form><label>Your address</label><input><button>Send</button></form>",
            "<section class='comments'><div class='comment'><p>I read all of this and I do not agree with a single word of it, sorry.</p></div></section>",
            "<article class='comment'><p>Another reader wrote this long and winding answer to the article above.</p></article>",
            "<div role='complementary'>Beside the point, but here for some reason.</div>", "<noscript>Turn scripts on.</noscript>", "<!-- ad <p>no</p> -->",
            "<div style='display: none'>Hidden words.</div>", "<div hidden>Hidden words.</div>", "<template><p>Not yet</p></template>", "<div class='sidebarRight'>Things to see on the right.</div>"]
    for j in junk:
        for where in ("before", "after", "inside"):
            if where == "inside" and j.startswith("<header"):
                continue    # an article's own header holds its title
            assert main_text(page(**{where: j})) == TEXT, (where, j)
    assert main_text(page(before="".join(junk[:8]), after="".join(junk[8:]))) == TEXT
    for holder in ("main", "div", "div class='content with-sidebar'", "section id='story'"):
        assert main_text(page(before=f"<nav>{MENU}</nav><div>{MENU}</div>", after=f"<div>{MENU}</div>", holder=holder).replace(f"</{holder}>", f"</{holder.split()[0]}>")) == TEXT, holder


def test_nested_parts_are_covered_without_an_article_element():
    parts = "".join(f"<div><h2>Part {i}</h2>{BODY * (i + 1)}</div>" for i in range(3))
    got = main_text(f"<body><div>{MENU}</div><div id='x'><h1>Title</h1>{parts}</div><div>{MENU}</div></body>")
    assert got.startswith("Title\nPart 0\n") and got.count("Short one.") == 6 and "Section" not in got


def test_markup_that_leaves_things_out():
    assert main_text("<article><h1>One<p><b>two.<br><p>three <i>four</p>five</b><ul><li>six<li>seven</ul>eight") == "One\ntwo.\nthree four\nfive\nsix\nseven\neight"
    assert main_text("<article>a&amp;b &lt;p&gt; &eacute;&#233;&#x41; &copy 5 &nosuch; a < b, c<3<br>d&nbsp;e\t\n f</article>") == "a&b <p> ééA © 5 &nosuch; a < b, c<3 d e f"
    assert main_text("<ARTICLE><P CLASS='x' data-a=\"1 > 0\">Up</P><p>per</ARTICLE>") == "Up\nper"
    assert main_text("<article><table><tr><td>a<td>b<tr><td>c</table></div></p>end") == "a b\nc\nend"
    for cut in ("<p class='", "<p", "<!-- no", "<script>no", "</"):
        assert main_text("<article><p>kept</p>" + cut) == "kept"
    for nothing in (None, "", " \n", "<nav>menu</nav>", "<p></p>", "<", "<script>x</script>"):
        assert main_text(nothing) == ("<" if nothing == "<" else "")


def test_time_follows_the_length():
    deep = "<div>x" * 30_000
    for odd in (deep, deep + "</section></b>" * 30_000, "<b>" * 60_000 + "</i>" * 60_000, "<p " + "a='" * 50_000, "<" * 200_000, "<!--" * 100_000, "&" * 200_000,
                "<article>" * 20_000 + "x", "<li>a" * 50_000, "<table><tr><td>" * 20_000 + "x", "<p>word <a>link</a></p>" * 30_000):
        began = time.time()
        main_text(odd)
        assert time.time() - began < 30, odd[:40]


def test_rows(spark, small_dir):
    """The table's pages against a pattern for their one layout; nulls, repeats, clashing names and no rows."""
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")

    def expected(page):
        article = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
        lines = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article))
        return "\n".join(x for x in lines if x)

    want = {r["page_id"]: expected(r["html"]) for r in pages.collect()}
    got = extract.extract_text(pages.unionByName(pages)).collect()
    assert len(got) == 2 * len(want) and all(r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"]) for r in got)
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", page()), (2, "u", "")], "page_id long, url string, html string")
    odd = odd.withColumn("Text", F.lit("clash")).withColumn("n_chars", F.lit(True)).withColumn("a.b", F.lit(1))
    rows = extract.extract_text(odd)
    assert rows.columns == ["page_id", "url", "a.b", "text", "n_chars"]
    assert sorted(((r["page_id"], r["text"], r["n_chars"]) for r in rows.collect()), key=str) == [(1, "", 0), (1, "", 0), (2, "", 0), (None, TEXT, len(TEXT))]
    assert extract.extract_text(odd.where("false")).count() == 0
