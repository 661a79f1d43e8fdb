"""HTML main text: flat text blocks classified by a decision tree.

A page is cut into text blocks at block-level tags.  Each block has its word
count and link density, those of its neighbours (the next ones, and the most unlinked
words of a block within ``REACH`` blocks, itself included), and flags from the markup around it (``headline``: a
heading right before an article's first block).  A decision tree (Spark ML) trained on a small labelled table of
pages (``LABELLED_PAGES``) tells article blocks from the rest; its splits become
one Column expression, so blocks never leave their page's row.

Defined cases: a null or empty page has empty text; unclosed comments, scripts and styles
run to the end of the page, other dropped elements without an end tag lose their tag only
(a title its text too); a self-closed dropped element is empty; a head ends at its end tag, at the
body or at the first block-level tag; repeated rows and ids stay as they are;
very long pages are parsed whole; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: element names and the words of class and id that mark page furniture
DROPPED = "script style noscript template svg iframe object canvas audio video select button textarea title math"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr input".split())
CONTAINERS = frozenset("nav header footer aside form section div article main ul ol dl table tr td th body "
                       "figure details dialog menu center fieldset".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
FURNITURE_WORDS = frozenset("nav navbar navigation menu footer foot sidebar aside ad ads advert adverts advertisement "
                            "advertising banner promo promoted sponsor sponsored cookie cookies consent gdpr notice notices "
                            "alert popup modal overlay newsletter subscribe subscription share sharing social related "
                            "recommended breadcrumb breadcrumbs comment comments reply replies respond disqus login "
                            "signup widget toolbar pagination pager copyright legal complementary contentinfo search "
                            "searchform".split())
# an article element is furniture only by these, the page's body and main part never by class
NO_ARTICLE_WORDS = frozenset("comment comments reply replies related recommended promo ad ads advert sponsored teaser".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
CONTENT_WORDS = frozenset("article post entry story content main body text".split())
# a class or id of several words marks furniture by its last word once these are taken off ("share-price" does not)
LAYOUT_WORDS = frozenset("box bar wrapper wrap container list links link block section buttons button area slot panel top bottom left "
                         "right inner outer unit item items thread row col column group icons form site page global main".split())
QUOTES = frozenset("blockquote pre dd dt figcaption".split())      # their own class says nothing about furniture
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "furniture", "article",
            "heading", "has_article", "near_words", "headline")
REACH = 3                   # blocks before and after that count as near

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<drop>" + "|".join(DROPPED.split()) + r")(?=[\s/>])(?:(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attr>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^<>]*>|<[!?/][^<>]*>",
    re.I | re.S)
_SELF_CLOSED = re.compile(r"<[a-z]+(?:\s+[^\s\"'>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]++))?)*+\s*/>", re.I)
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in [*DROPPED.split(), "head"]}
IN_HEAD = frozenset("html head meta link base".split())
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def _kind(tag: str, attr: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(furniture, header, article) that an opening container tag starts."""
    names: set = set()
    if attr and "=" in attr:
        for m in _NAMED.finditer(attr):
            for name in (m[1] or m[2] or m[3] or "").lower().split():
                said = _WORDS.findall(name)
                while len(said) > 1 and (said[-1] in LAYOUT_WORDS or said[-1].isdigit()):
                    said.pop()
                names.update(said[-1:])
    words = NO_ARTICLE_WORDS if tag == "article" else frozenset() if tag in ("body", "main") else FURNITURE_WORDS
    furniture = tag in FURNITURE_TAGS or bool(names & words)
    header = tag == "header" or bool(names & HEADER_WORDS)
    article = (tag in ("article", "main") and not furniture) or (bool(names & CONTENT_WORDS) and tag in ("div", "section") and not furniture)
    if header and not in_article and not article:
        return True, False, False
    return furniture, header, article


class _EndTags:
    """Where the next end tag of a dropped element (or the head) ends; every tag is looked for once per end tag."""

    def __init__(self, page: str):
        self.page = page
        self.found: dict = {}

    def after(self, tag: str, at: int) -> int | None:
        start, end = self.found.get(tag, (-1, -1))
        if start is not None and start < at:
            m = _ENDS[tag].search(self.page, at)
            start, end = self.found[tag] = m.span() if m else (None, None)
        return end


def _dropped_to(page: str, m: re.Match, ends: _EndTags) -> int:
    """Where the dropped element that starts with ``m`` ends."""
    tag = m["drop"].lower()
    if m[0].endswith("/>") and _SELF_CLOSED.fullmatch(m[0]):
        return m.end()
    end = ends.after(tag, m.end())
    if end is not None:
        return end
    if tag in ("script", "style"):
        return len(page)
    if tag == "title":
        end = page.find("<", m.end())
        return end if end >= 0 else len(page)
    return m.end()


def blocks_of(page: str) -> list[tuple[str, list[float]]]:
    """(text, features) of every text block of a page, in order."""
    out: list[list] = []                # text, words, links, furniture, article, heading
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    parts: list[str] = []
    link_parts: list[str] = []
    in_link = heading = has_article = own_furniture = in_head = False
    ends = _EndTags(page)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                words = len(text.split(" "))
                linked = len(html.unescape("".join(link_parts)).split()) if link_parts else 0
                _, furniture, header, article = stack[-1]
                out.append([text, words, min(1.0, linked / words), furniture or own_furniture or (header and not heading), article, heading])
            parts.clear()
            link_parts.clear()

    def add(piece: str) -> None:
        if piece and not in_head:
            parts.append(piece)
            if in_link:
                link_parts.append(piece)

    at = 0
    while (m := _TOKEN.search(page, at)) is not None:
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["drop"] is not None:
                at = _dropped_to(page, m, ends)
                if m["drop"].lower() not in ("button", "svg", "math", "object"):
                    close()
            continue
        tag = tag.lower()
        if tag == "br":
            add(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
                if link_parts:
                    link_parts.append(" ")
            elif tag in ("img", "input"):
                pass
            continue
        close()
        if tag == "head":
            in_head = not m["end"] and ends.after("head", at) is not None
        elif tag not in IN_HEAD:
            in_head = False
        # a paragraph, list item or heading may be marked itself
        own_furniture = (not m["end"] and tag not in CONTAINERS and tag not in QUOTES and bool(m["attr"]) and _kind(tag, m["attr"], True)[0])
        if tag in HEADINGS:
            heading = not m["end"]
        elif tag in CONTAINERS:
            heading = in_link = False
            if m["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif not (m["attr"] or "").endswith("/"):
                _, f, h, a = stack[-1]
                furniture, header, article = _kind(tag, m["attr"], a)
                has_article |= article
                stack.append((tag, f or furniture, h or header, a or article))
        else:
            heading = False
    add(page[at:])
    close()
    rows = []
    for i, (text, words, links, furniture, article, head) in enumerate(out):
        pw, pl = out[i - 1][1:3] if i else (0, 0.0)
        nw, nl = out[i + 1][1:3] if i + 1 < len(out) else (0, 0.0)
        near = max((o[1] * (1 - o[2]) for o in out[max(0, i - REACH):i + 1 + REACH] if not o[3]), default=0)
        near = 0 if furniture else near                     # marked blocks have no part in the text around them
        headline = head and not furniture and i + 1 < len(out) and out[i + 1][4] and not out[i + 1][3]
        rows.append((text, [float(words), float(links), float(pw), float(pl), float(nw), float(nl), float(furniture),
                            float(article), float(head), float(has_article), float(near), float(headline)]))
    return rows


# ------------------------------------------------- the small labelled table
# (name, label of its blocks in order: 1 article, 0 other, page)
LABELLED_PAGES = (
    ("news", "000111110", """<body><nav><ul><li><a href=1>Home</a></li><li><a href=2>Sport</a></li></ul></nav><div class="ad">Buy one new car today and get a second one for half the price.</div>
      <article><h1>River rises after a week of rain</h1><p>The river rose by two metres over the weekend, the water office said on Monday, and several roads along the bank were closed.</p><p>Be careful.</p><p>People in the old town were asked to move their cars to <a href=3>higher ground</a>, and schools stayed shut.</p><p>More rain is due.</p></article><footer>&copy; the daily page, all rights reserved.</footer></body>"""),
    ("shop notice", "0011110", """<body><header>The long name of a site and what it is about</header><div class="cookie-notice">We use cookies to improve our service, please agree to our terms before you go on reading.</div>
      <article><h1>Ten soups</h1><p>Soup is warm.</p><p>Cut the onions, fry them slowly in a large pot with some oil, then add water, salt and whatever is left in the kitchen.</p><p>Serve hot.</p></article><footer><p>Imprint and terms</p></footer></body>"""),
    ("comments", "0111000", """<body><nav><a href=1>Start</a> <a href=2>All posts of this year</a></nav><article><h1>On walking</h1><p>I walk every day for an hour, in any weather, and I have done so for as long as I can remember.</p><p>It helps.</p></article>
      <section class="comments"><h3>What readers say</h3><p>I do the same, and I find that an hour in the rain is as good as an hour in the sun, as you say in your text.</p><p>Nice.</p></section></body>"""),
    ("sidebar", "011100", """<body><header><a href=0>Logo of the paper</a></header><main><h1>City opens a library</h1><p>The new library has room for a hundred thousand books and is open to all, day and night, without a fee.</p><p>It is near.</p></main>
      <aside><p>Most read this week: the story of a lost dog that came back after three long years at sea.</p></aside><div class="sidebar"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div></body>"""),
    ("no article tag", "0011100", """<body><div><a href=1>Home</a> <a href=2>News</a> <a href=3>Contact</a></div><div><a href=1>Log in</a></div><div><p>The council met on Tuesday to talk about the new bridge, which is to be built next year if the money can be found in time.</p><p>Most members spoke in favour of the plan, though some asked for a further study of the traffic in the narrow streets near it.</p><p>A vote will follow in March, when the report of the engineers has been read by the members and by the public.</p></div>
      <div><a href=5>Terms</a> <a href=6>Privacy</a></div><div><a href=7>Top</a></div></body>"""),
    ("no article tag 2", "01100", """<body><table><tr><td><a href=1>Index of pages</a></td><td><p>Wood has been used for houses since people first built them, and it is still one of the best materials that we have for small homes.</p><p>It is light, strong and easy to work, it keeps the heat well and, if it is kept dry, it lasts for many hundreds of years.</p></td><td><a href=2>Next page</a></td></tr></table><div><a href=3>Copyright of the owner</a></div></body>"""),
    ("forms", "011000", """<body><nav><a href=1>Home</a></nav><article><h2>Letters</h2><p>Yes.</p></article><form><p>Sign up for our letter and get the news of the week in your mail each Sunday.</p><label>Your mail</label></form><div id="share">Share this with all of your friends and family</div></body>"""),
    ("short", "0110", """<body><nav><ul><li><a href=1>der</a></li></ul></nav><article><h1>Kurz</h1><p>Von.</p></article><footer>&copy; m.example.net</footer></body>"""),
    ("lists", "00111100", """<body><div class="breadcrumb"><a href=1>Home</a> / <a href=2>Food</a></div><div class="ad">The best knives of the year are on sale now, only here.</div><article><header><h1>Bread</h1></header><ul><li>Flour</li><li>Water</li></ul><p>Mix it all and wait for a night, then bake it in a hot oven until it is brown and sounds hollow.</p><p><a href=3>A longer recipe</a></p></article><div class="related"><a href=4>More bread</a></div></body>"""),
    ("banner in article", "010110", """<body><header class="site-header">All about gardens and the people who love them</header><article><p>Roses need sun, water and a little care in spring, when the old wood is cut back and the new shoots begin to grow.</p><div class="advert">New shears for every garden, now with a free pair of gloves for all who order today.</div><p>Good luck.</p><p>Then wait for June, and enjoy what the warm days bring to you and to your guests.</p></article><footer>About us</footer></body>"""),
    ("no article tag 3", "000111110", """<body><div class="notice">This page is no longer kept up to date, and some of what it says may be wrong by now, so please look at the new page before you do what it tells you to do.</div><div id="menu"><a href=1>A</a> <a href=2>B</a></div><div class="banner">Read the paper for four weeks at half the price, and get a bag with our name on it as well, if you order it before the end of the month.</div>
      <div><p>The old mill stands at the end of the village, where the road turns towards the hills, and it has not been used since the war, when the last miller left it to his sister and went to live by the sea with his three sons and a dog.</p><p>It was sold in spring.</p><p>The new owner, who came from the city, wants to turn it into a house for painters, with room for six of them at a time, a garden and a kitchen that they all can use.</p><p>Work has begun on the roof, which had let in the rain for years, and on the great wheel, which is to turn again when the stream is full, as it did a hundred years ago.</p><p>All are welcome to come and see it on the first day of May.</p></div><div class="comments"><p>My mother was born in that house and told us about the wheel and the noise it made at night, so I am glad that it will turn again at last, and I will come to see it.</p></div></body>"""),
    ("text beside article", "0111000", """<body><div>Our paper has been read in this town for more than a hundred years, and we thank all who have helped us to keep it alive.</div><article><h1>New bells</h1><p>The church has three new bells, cast in the north and brought here by ship, cart and, over the last mile, by the hands of the people.</p><p>They ring at noon.</p></article><div>Write to us at the old address in the main street, or call at any time of day between nine and five.</div><div class="newsletter">Get the news of the town in your mail once a week, with all that is on and all that has been, free of any cost to you.</div><aside>In other news, the baker has moved to the square, the school has a new roof and the summer fair will be held in June, as in each year.</aside></body>"""),
    ("no article tag 4", "000110", """<body><form><p>Find a book, a film or a song in the great list of all that we have, or ask one of us to find it for you if you do not know its name.</p></form><nav><p>You are here: the list of all the notes on the garden, by the month in which they were written, from the first one on.</p></nav><aside><p>Note that all of the seeds that are named here can be had from us, by mail or in the shop, from the end of the winter until the first frost.</p></aside>
      <div><p>Beans are sown in May, when the ground is warm, two inches deep and a hand apart, along a line of poles that are tied together at the top so that the wind does not blow them over.</p><p>They should be picked when they are young, for then they are tender and the plant will go on to bear more of them until the cold nights come at the end of September.</p></div><footer>Text and pictures may be used for any end that does not earn money, as long as the name of the writer and of this page are given with them each time.</footer></body>"""),
)

# paragraph lengths (words) of further labelled pages built by rule
PATTERNS = ((1, 1, 40, 2, 60, 1), (3, 90, 1, 1, 1, 25), (7, 30, 30, 2, 2, 120), (2, 2, 2, 2), (50, 1, 200, 3, 1),
            (1,), (15, 8, 8, 33, 4, 70, 1, 1), (9, 45, 12, 3, 28, 6))


def patterned_pages(patterns=PATTERNS) -> list[tuple[str, str, str]]:
    """Labelled pages whose paragraphs have the lengths of ``patterns``: the
    article in its element, between furniture with text of like length, with a
    loose block beside it, with lists of links and half linked paragraphs inside, with
    its headline right before it, among unmarked short blocks and far headings; and the longer
    ones without an article element, between menus that only their links tell apart."""
    say = lambda n: " ".join(["word"] * n) + "."                         # noqa: E731
    link = lambda n: f"<a href=1>{say(n)}</a>"                             # noqa: E731
    pages = []
    for i, lengths in enumerate(patterns):
        body = "".join(f"<p>{say(n)}</p>" for n in lengths)
        side = f"<div class='ad'>{say(lengths[-1] + i)}</div>"
        loose = f"<div>{say(4 + 9 * i)}</div>"
        foot = f"<footer>{say(3 + 5 * i)}</footer>"
        pages.append((f"pattern {i}", "0" + "1" * (len(lengths) + 1) + "00",
                      f"<nav><a href=1>{say(2)}</a></nav><article><h1>{say(3 + i)}</h1>{body}</article>{side}{foot}"))
        pages.append((f"pattern {i} ad first", "00" + "1" * len(lengths) + "0",
                      f"<header>{say(1 + i)}</header>{side}<main>{body}</main>{foot}"))
        pages.append((f"pattern {i} links", "01" + "11" * len(lengths) + "000",
                      f"<div>{link(1 + i)}</div><article><h1>{say(2 + i)}</h1>"
                      + "".join(f"<p>{say(n)}</p><p>{say(1 + n // 3)} <b>{link(2 + 2 * (n // 3))}</b></p>" for n in lengths)
                      + f"<ul><li>{link(2 + i)}</li><li>{link(3 + 9 * i)}</li></ul></article><div>{link(2)}</div>"))
        pages.append((f"pattern {i} headline", "01" + "1" * len(lengths) + "0",
                      f"<div>{say(3 + 4 * i)}</div><h1>{say(3 + i)}</h1><article>{body}</article>{foot}"))
        pages.append((f"pattern {i} beside", "000" + "1" * len(lengths) + "0000",
                      f"<h1>{say(1 + i)}</h1><div>{say(1 + i)}</div><div>{say(2 + 3 * i)}</div><article>{body}</article>"
                      f"<div>{say(1 + 2 * i)}</div><h3>{say(2 + i)}</h3><p>{say(5 + 7 * i)}</p><div>{link(3)}</div>"))
        if max(lengths) >= 25:
            menu = "".join(f"<li>{link(n)}</li>" for n in (1, 2 + i, 1, 3))
            pages.append((f"pattern {i} menus", "0000" + "0" + "0000" + "1" + "1" * len(lengths) + "0000" + "0" + "0000",
                          f"{menu}<li>{say(2 + 2 * i)}</li>{menu}<h2>{say(4 + i)}</h2>{body}{menu}<li>{say(1 + i)}</li>{menu}"))
            pages.append((f"pattern {i} plain", "1" + "1" * len(lengths), f"<h1>{say(2 + i)}</h1>{body}"))
            pages.append((f"pattern {i} bare", "001" + "1" * len(lengths) + "11000",
                          f"<div>{link(2 + i)}</div><div>{link(12)}</div><div><h1>{say(2 + i)}</h1>{body}"
                          f"<p>{say(20 + 3 * i)} {link(1 + 2 * i)}</p><p>{say(4 + i)} {link(3 + i)} {say(9)}</p></div>"
                          f"<div>{link(1 + 3 * i)}</div><div>{say(1)} {link(6 + 8 * i)}</div>{foot}"))
        pages.append((f"pattern {i} loose", "0" + "1" * len(lengths) + "0", f"{loose}<article>{body}</article>{foot}"))
    return pages


def train_tree(spark: SparkSession):
    """Decision tree on the blocks of ``LABELLED_PAGES`` and ``patterned_pages``."""
    rows = []
    for name, labels, page in (*LABELLED_PAGES, *patterned_pages()):
        blocks = blocks_of(page)
        if len(blocks) != len(labels):
            raise ValueError(f"{name}: {len(blocks)} blocks, {len(labels)} labels")
        rows += [(float(y), Vectors.dense(x)) for y, (_, x) in zip(labels, blocks)]
    table = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    return DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=1, seed=7).fit(table)


def tree_column(model, x: Column) -> Column:
    """The tree's decision on a feature array as one expression."""
    def walk(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(node.prediction() > 0.5)
        split = node.split()
        return (F.when(x[split.featureIndex()] <= split.threshold(), walk(node.leftChild()))
                 .otherwise(walk(node.rightChild())))
    return walk(model._java_obj.rootNode())


_BLOCK = pa.struct([("text", pa.string()), ("x", pa.list_(pa.float32()))])


def _parse(batches):
    for batch in batches:
        pages = batch.column("html").to_pylist()
        found = [[{"text": t, "x": x} for t, x in blocks_of(p)] if p else [] for p in pages]
        names = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(found, pa.list_(_BLOCK))],
                                         names + ["blocks"])


def page_blocks(pages: DataFrame) -> DataFrame:
    """page_id, url, blocks: array of (text, x features) in page order."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _parse, "page_id bigint, url string, blocks array<struct<text: string, x: array<float>>>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_kept for every row of ``pages``."""
    model = train_tree(pages.sparkSession)
    kept = F.filter("blocks", lambda b: tree_column(model, b["x"]))
    d = page_blocks(pages).select("page_id", "url", F.size("blocks").alias("n_blocks"), kept.alias("kept"))
    text = F.array_join(F.transform("kept", lambda b: b["text"]), " ")
    return d.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"),
                    "n_blocks", F.size("kept").alias("n_kept"))
