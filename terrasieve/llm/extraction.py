"""Main text of web pages by composite text density.

Every element gets its link-adjusted characters per tag; a block's sum is that of the blocks right below it. The block with
the largest sum is the core; the least density on its path to the body is the page's threshold. From the body down, each
block that reaches the threshold gives the largest-sum subtree in it, and what those subtrees hold is the text.
"""

from __future__ import annotations

import html
import re
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?--!?>|.*)|<[!?][^>]*+(?:>|$)|</[^a-zA-Z][^>]*+(?:>|$)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|$)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)

words = lambda s: frozenset(s.split())
VOID = words("area base br col embed hr img input link meta param source track wbr")
RAW = words("script style textarea title noscript iframe noembed noframes xmp template")  # their text is none of the page's
BLOCK = words(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead title tr ul"
)
CONTAINER = BLOCK | words("td th")  # what sums are of: bold type or a link is no part of a page by itself
ENDS_P = BLOCK - words("body caption dd dt html legend tbody tfoot thead title tr")
#: What a start tag closes if it is open, up to what holds both.
CLOSES = {
    "li": (words("li"), words("ul ol menu dir")), "dd": (words("dd dt"), words("dl")), "dt": (words("dd dt"), words("dl")), "tr": (words("tr"), words("table")), "td": (words("td th"), words("tr table")),
    "th": (words("td th"), words("tr table")), "option": (words("option"), words("select")), "a": (words("a"), words("table")), "body": (words("head"), words("")), "tbody": (words("thead tbody tfoot"), words("table")),
    "tfoot": (words("thead tbody tfoot"), words("table")),
}
BARRIER = words("article aside body blockquote div dd details figure footer form header html li main nav section table td th")  # that an implied end of a paragraph does not cross

#: Elements, roles and parts of class names and ids that are no article text.
NOISE_TAGS = words("aside audio button canvas datalist dialog footer input menu nav object optgroup option output progress select svg video")
NOISE_ROLES = words("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tablist")
NOISE_PARTS = words(
    "ad ads adsense advert advertisement advertising advertorial alert announcement banner breadcrumb breadcrumbs byline-share captcha colophon combx comment comments consent cookie cookies copyright disclaimer "
    "disqus dropdown footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promoted promotion recommendation "
    "recommendations recommended related replies reply respond rss share sharing shoutbox sidebar sidebars signup skip skyscraper social sponsor sponsored sponsors subscribe subscription taboola tags toolbar topbar widget widgets"
)
BARE = words("address center div fieldset section table tbody td th tr")  # that say nothing of their text: without blocks in them, they must be as dense as the core
MENU_LINKS = 3  # so many links with nine tenths of the characters are a menu, wherever they stand
COMMENT_PARTS = words("comment comments disqus replies reply respond")
NEGATIONS = words("has with no without is")


def _noisy(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is none of the article's by its name, role, class or id."""
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return True
    if not rest.strip(" \t\r\n/"):
        return False
    for m in ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and value != "until-found" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in NOISE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            for token in value.split():
                parts = [p for p in re.split(r"[\d_:-]+", token) if p]
                ends = {*parts[:1], *parts[-1:]}
                known = COMMENT_PARTS if tag == "article" else NOISE_PARTS
                if ends & known and parts[0] not in NEGATIONS or not in_article and tag != "article" and ends & {"header"}:
                    return True
    return False


class Page:
    """The elements of a page in order, each with its parent, and the texts between tags with element and block."""

    def __init__(self, source: str):
        self.tags, self.parents, self.noise, self.texts = ["#page"], [0], [False], []
        stack, open_tags, block, at, body = [0], {}, 0, 0, 0

        def close() -> None:
            gone = self.tags[stack.pop()]
            open_tags[gone] -= 1

        def close_to(names: frozenset[str], barrier: frozenset[str]) -> None:
            if any(open_tags.get(n) for n in names):
                for k in range(len(stack) - 1, 0, -1):
                    tag = self.tags[stack[k]]
                    if tag in names:
                        while len(stack) > k:
                            close()
                        return
                    if tag in barrier:
                        return

        while at < len(source):
            m = TOKEN.search(source, at)
            start = m.start() if m else len(source)
            if start > at:
                self.texts.append((stack[-1], block, source[at:start]))
            if not m:
                break
            at = m.end()
            name = m["name"] or m["name2"]
            if name is None:
                continue
            tag, ends, rest = name.lower(), m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
            if tag in BLOCK:
                block += 1
            elif tag in ("br", "td", "th"):
                self.texts.append((stack[-1], block, " "))
            if ends:
                if open_tags.get(tag) and tag not in ("html", "body"):
                    while self.tags[stack[-1]] != tag:
                        close()
                    close()
                continue
            if tag in ("html", "body", "head") and open_tags.get(tag):
                continue
            if tag in ENDS_P:
                close_to(frozenset(("p",)), BARRIER)
            if tag in CLOSES:
                close_to(*CLOSES[tag])
            if tag in RAW:
                m = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
                at = m.start() if m else len(source)
                continue
            node, up = len(self.tags), stack[-1]
            self.tags.append(tag)
            self.parents.append(up)
            in_article = bool(open_tags.get("article") or open_tags.get("main"))
            self.noise.append(self.noise[up] or _noisy(tag, rest, in_article))
            if tag == "body" and not body:
                body = node
            if tag not in VOID:
                stack.append(node)
                open_tags[tag] = open_tags.get(tag, 0) + 1
        self.body = body

    def clean(self) -> None:
        """Decodes references and leaves out what is noise; a form too, unless it holds the larger part of the text."""
        self.texts = [(node, block, html.unescape(text)) for node, block, text in self.texts if not self.noise[node]]
        own = [0] * len(self.tags)
        for node, _, text in self.texts:
            own[node] += len(text) - text.count(" ")
        whole = own[:]
        for i in range(len(whole) - 1, 0, -1):
            whole[self.parents[i]] += whole[i]
        for i, tag in enumerate(self.tags):
            self.noise[i] = self.noise[i] or self.noise[self.parents[i]] or tag == "form" and 2 * whole[i] <= whole[0]
        self.texts = [x for x in self.texts if not self.noise[x[0]]]

    def densities(self) -> tuple[list[float], list[bool]]:
        """Of every element: characters per tag, the higher the fewer of both are links'; and whether it is a list of links."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags, in_link = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parents[i]] or self.tags[i] == "a"
        for node, _, text in self.texts:
            size = len(" ".join(text.split()))
            chars[node] += size
            if in_link[node]:
                link_chars[node] += size
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            if not self.noise[i]:
                chars[up] += chars[i]
                link_chars[up] += link_chars[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (self.tags[i] == "a")
        share = link_chars[self.body] / max(chars[self.body], 1)
        out = [0.0] * n
        for i in range(n):
            if chars[i] and not self.noise[i]:
                c, t, lc, lt = chars[i], max(tags[i], 1), link_chars[i], max(link_tags[i], 1)
                spread = log(c / max(c - lc, 1) * lc + share * c + e)
                links = log(c / max(lc, 1) * (t / lt))
                out[i] = c / t * (links / log(spread) if share else links)
        return out, [link_tags[i] >= MENU_LINKS and 10 * link_chars[i] >= 9 * chars[i] for i in range(n)]

    def main_text(self) -> str:
        self.clean()
        n, body = len(self.tags), self.body
        density, menu = self.densities()
        block, above = [i == body or t in CONTAINER for i, t in enumerate(self.tags)], [0] * n  # above: the next block up
        for i in range(body + 1, n):
            up = self.parents[i]
            above[i] = up if block[up] else above[up]
        total, best = [0.0] * n, list(range(n))  # best: of each subtree, the block with the largest sum
        for i in range(body + 1, n):
            if block[i]:
                total[above[i]] += density[i]
        for i in range(n - 1, body, -1):
            if block[i] and (total[best[i]], -best[i]) > (total[best[above[i]]], -best[above[i]]):
                best[above[i]] = best[i]
        core = best[body]
        threshold, at = density[body], core
        while at != body:
            threshold = min(threshold, density[at])
            at = above[at]
        titles = [i for i, tag in enumerate(self.tags) if tag == "h1" and density[i] > 0]
        reached, marks = [False] * n, {core, *(titles if len(titles) == 1 else ())}
        reached[body] = True
        for i in range(body + 1, n):
            least = density[core] if self.tags[i] in BARE and total[i] == 0 else threshold
            if block[i] and reached[above[i]] and density[i] >= least and density[i] > 0:
                reached[i] = True
                marks.add(best[i])
        kept = [False] * n
        for i in range(n):
            kept[i] = (i in marks or i > 0 and kept[self.parents[i]]) and not menu[i]
        blocks: dict[int, list[str]] = {}
        for node, number, text in self.texts:
            if kept[node]:
                blocks.setdefault(number, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n\n".join(line for line in lines if line)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page, blocks joined by empty lines.

    Null and empty pages give an empty text; repeated rows count each; other columns are not read. Broken markup is read as
    browsers do: implied ends, ends without a start, unclosed comments and tags. A page is read in one pass, whatever its
    length. White space, no-break spaces too, becomes one space in a block; a line break tag counts as white space.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(sources: pd.Series) -> pd.Series:
        return sources.map(lambda source: Page(source).main_text() if source else "")

    text = main_text(F.coalesce(F.col(html_col), F.lit("")))
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
