"""HTML main text by consensus host paths.

1. Every page's containers are scored by the text of the paragraphs in them
   (all of it for the parent, half for the grandparent).  The article is the
   lowest element around all containers that score nearly as well as the best,
   and grows as long as its parent adds text that is not mostly links; an
   article or main element around it is taken whole.  It votes with its
   generalised tag-class path (digits dropped), hashed link by link.
2. Spark counts the votes per host; the path with most votes wins.
3. Every page is extracted again from the containers on its host's winning
   path, or from its own best container if it has none there.

Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
and styles are left out, by element or by the words of class, id and role;
headings, quotations and preformatted text only by words that name nothing else.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from netbaseline.operators.sizing import is_small

from .common import stored
from .url_reputation import url_host

MAX_BROADCAST_HOSTS = 200_000  # winning paths (one short row per host) broadcast up to here; beyond, a salted join
SALTS = 32

# Elements of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe object svg select".split())
LEFT_OUT = frozenset("nav header footer aside form button dialog menu head".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th summary address".split())
CONTAINERS = frozenset("html body div section article main ul ol dl table tbody thead tfoot tr figure center details "
                       "fieldset hgroup legend".split())
BLOCKS = PARAGRAPHS | CONTAINERS | LEFT_OUT
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}}

_markup = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                     r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_attribute = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_unwanted = re.compile(
    r"ads?|adsby\w*|advert\w*|adsense|sponsor\w*|promo\w*|banners?|\w*sidebar\w*|rail|"
    r"(?:top|side|sub|main|site|bottom)?(?:nav\w*|menu\w*)|breadcrumbs?|footer|header|masthead|topbar|cookies?|consent|"
    r"gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|shar(?:e|ing)|social|"
    r"related|recommend\w*|comments?|commentlist|feedback|repl(?:y|ies)|respond|disqus|discussion|widgets?|toolbar|"
    r"pagination|pager|search|copyright|disclaimer|contentinfo|complementary")
# Words that also name parts of an article: they say nothing about a heading, a quotation or preformatted text.
_weak = frozenset("alert alerts notice notices header footer search rail banner banners promo copyright disclaimer modal overlay "
                  "widget widgets toolbar".split())
QUOTES = frozenset("blockquote pre h1 h2 h3 h4 h5 h6 figcaption caption".split())
NEAR_BEST = 0.25           # score, as a share of the best one, of a container that belongs to the article too
MAX_LINKS = 0.3            # share of link text in what a parent may add


class Page:
    """Blocks of text of a page and the elements that hold them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.path, self.out, self.links = ["#"], [-1], [""], [False], [0]
        self.soft: set[int] = set()                  # left out unless the article is inside
        self.blocks: list[tuple[int, str]] = []      # (element, text) in page order
        self._build(source)
        for k, tag in enumerate(self.tag):
            if tag in ("article", "main") and k not in self.soft:
                up = self.parent[k]
                while up >= 0:
                    self.soft.discard(up)
                    up = self.parent[up]
        for k in range(1, len(self.tag)):            # parents come before their children
            self.out[k] = self.out[k] or k in self.soft or self.out[self.parent[k]]

    @staticmethod
    def _attributes(text: str, tag: str = "") -> tuple[dict[str, str], bool, bool]:
        """Attributes of an element, whether their words are unwanted, and whether it is hidden."""
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(text)}
        words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", " ".join(
            found.get(a, "") for a in ("class", "id", "role"))).lower())
        odd = {w for w in words if _unwanted.fullmatch(w)}
        if tag in QUOTES:
            odd -= _weak
        if "results" in words or "result" in words:
            odd.discard("search")
        hidden = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                  or "display:none" in found.get("style", "").replace(" ", "").lower())
        return found, bool(odd), hidden

    def _open(self, tag: str, attributes: str, under: int) -> int:
        path, unwanted, hidden = tag, False, False
        if attributes and not attributes.isspace():
            found, unwanted, hidden = self._attributes(attributes, tag)
            kinds = sorted(set(re.sub(r"\d+", "", found.get("class", "")).split()))
            path = ".".join([tag, *kinds])
        k = len(self.tag)
        self.tag.append(tag)
        self.parent.append(under)
        self.path.append(xxhash.xxh3_64_hexdigest(f"{self.path[under]}>{path}"))
        self.links.append(0)
        self.out.append(hidden or (tag in LEFT_OUT and tag != "form"))
        if tag not in ("html", "body") and (tag == "form" or unwanted):
            self.soft.add(k)
        return k

    def _build(self, source: str) -> None:
        stack, pieces, at, n = [0], [], 0, len(source)
        cut_out: list[str] = []                       # open inline elements whose text is left out
        linked = [False]

        def text(piece: str) -> None:
            if piece and not cut_out:
                pieces.append(html.unescape(piece) if "&" in piece else piece)
                if linked[0]:
                    self.links[stack[-1]] += len(piece)

        def flush() -> None:
            if pieces:
                words = "".join(pieces).split()
                pieces.clear()
                if words:
                    self.blocks.append((stack[-1], " ".join(words)))

        while at < n:
            m = _markup.search(source, at)
            if m is None:
                break
            text(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag in RAW and not closing:
                if not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else n
                continue
            if tag in ("br", "hr"):
                flush()
                continue
            if tag in VOID:
                continue
            if tag == "a":
                linked[0] = not closing
            if tag not in BLOCKS:                     # inline markup: not seen, unless it is left out
                if closing and tag not in cut_out or not closing and not (
                        m[3] and "=" in m[3] and any(self._attributes(m[3])[1:])):
                    continue
                cut_out.remove(tag) if closing else cut_out.append(tag)
                continue
            cut_out.clear()                           # a block ends what was left open
            linked[0] = False
            flush()
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == tag:
                        del stack[depth:]
                        break
                continue
            if self.tag[stack[-1]] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                stack.pop()                           # a block ends an open paragraph
            if tag in CLOSES:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] in CLOSES[tag]:
                        del stack[depth:]
                        break
                    if self.tag[stack[depth]] in SCOPE[tag]:
                        break
            stack.append(self._open(tag, m[3], stack[-1]))
        text(source[at:])
        flush()

    def _scores(self) -> tuple[dict[int, float], dict[int, float]]:
        """Per container the text of its own paragraphs, and that with half of its children's."""
        own: dict[int, float] = {}
        score: dict[int, float] = {}
        for k, block in self.blocks:
            if self.out[k]:
                continue
            holder = self.parent[k] if self.tag[k] in PARAGRAPHS else k
            if self.tag[holder] in ("ul", "ol", "dl", "tr", "tbody", "table", "blockquote"):
                holder = max(0, self.parent[holder])
            weight = len(block) if len(block) >= 25 else len(block) / 2
            own[holder] = own.get(holder, 0.0) + weight
            score[holder] = score.get(holder, 0.0) + weight
            if self.parent[holder] > 0:
                score[self.parent[holder]] = score.get(self.parent[holder], 0.0) + weight / 2
        return own, score

    def best(self) -> tuple[int, float]:
        """The element that holds the article, and the score of its best container; (-1, 0): no text."""
        own, score = self._scores()
        top = max(score, key=lambda k: (score[k], -k), default=-1)
        if top < 0:
            return -1, 0.0
        # Text and link text inside every element; parents come before their children.
        inside, links = [0] * len(self.tag), [n if not o else 0 for n, o in zip(self.links, self.out)]
        for k, block in self.blocks:
            if not self.out[k]:
                inside[k] += len(block)
        for k in range(len(self.tag) - 1, 0, -1):
            inside[self.parent[k]] += inside[k]
            links[self.parent[k]] += links[k]
        most = score[top]
        near = [k for k in own if own[k] >= NEAR_BEST * most and links[k] <= MAX_LINKS * inside[k]]
        around = [0] * len(self.tag)                 # well scoring containers inside an element
        for k in near:
            around[k] += 1
        for k in range(len(self.tag) - 1, 0, -1):
            around[self.parent[k]] += around[k]
        while top > 0 and around[top] < len(near):
            top = self.parent[top]
        while self.parent[top] > 0 and self.tag[self.parent[top]] not in ("body", "html"):
            up = self.parent[top]
            if links[up] - links[top] > MAX_LINKS * (inside[up] - inside[top]):
                break
            top = up
        up = top
        while up > 0 and self.tag[up] not in ("article", "main"):
            up = self.parent[up]
        return (up if up > 0 else top), most

    def text(self, path: str | None) -> str:
        """Blocks under the elements on ``path``; under the page's best container if there are none."""
        def below(roots: set[int]) -> list[str]:
            inside = [k in roots for k in range(len(self.tag))]
            for k in range(1, len(self.tag)):
                inside[k] = inside[k] or inside[self.parent[k]]
            return [block for k, block in self.blocks if inside[k] and not self.out[k]]

        found = below({k for k, p in enumerate(self.path) if p == path}) if path is not None else []
        if not found:
            top, _ = self.best()
            found = below({top}) if top >= 0 else []
        return "\n".join(found)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, source in batch.itertuples(index=False):
            page = Page(source)
            top, score = page.best()
            if top >= 0:
                rows.append((host, page.path[top], score))
        votes = pd.DataFrame(rows, columns=["w_host", "w_path", "w_score"])
        yield votes.groupby(["w_host", "w_path"], as_index=False).agg(
            w_n=("w_score", "size"), w_score=("w_score", "sum"))[["w_host", "w_path", "w_n", "w_score"]]


def winning_paths(pages: DataFrame) -> DataFrame:
    """``pages(p_host, p_html)`` -> ``(w_host, w_path)``: most votes, then most text, then the smallest path."""
    votes = (pages.where("p_html is not null").select("p_host", "p_html")
             .mapInPandas(_votes, "w_host string, w_path string, w_n long, w_score double")
             .groupBy("w_host", "w_path").agg(F.sum("w_n").alias("n"), F.sum(F.round("w_score")).alias("score")))
    order = Window.partitionBy("w_host").orderBy(F.desc("n"), F.desc("score"), "w_path")
    return votes.withColumn("place", F.row_number().over(order)).where("place = 1").select("w_host", "w_path")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)``, one row per page.

    Null and empty html give the empty text.  Pages without a host share the
    empty host.  Votes are counted map-side, so that a host with a third of
    all pages is a few rows a task; the join back is by broadcast below a
    checked number of hosts, else salted.
    """
    rows = pages.select(F.col(id_col).alias("p_id"), F.col(url_col).alias("p_url"), F.col(html_col).alias("p_html"),
                        url_host(F.col(url_col)).alias("p_host"))
    winners = stored(winning_paths(rows), "host-paths")
    if is_small(winners, MAX_BROADCAST_HOSTS):
        joined = rows.join(F.broadcast(winners), F.col("p_host") == F.col("w_host"), "left")
    else:
        salted = winners.withColumn("w_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("p_salt", F.pmod(F.hash("p_id"), F.lit(SALTS)))
        joined = rows.join(salted, (F.col("p_host") == F.col("w_host")) & (F.col("p_salt") == F.col("w_salt")), "left")

    @F.pandas_udf("string")
    def again(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([Page(s).text(p) if s else "" for s, p in zip(sources, paths)], dtype=object)

    out = joined.select("p_id", "p_url", again("p_html", "w_path").alias("p_text"))
    return out.select(F.col("p_id").alias(id_col), F.col("p_url").alias(url_col), F.col("p_text").alias("text"),
                      F.length("p_text").cast("long").alias("n_chars"))
