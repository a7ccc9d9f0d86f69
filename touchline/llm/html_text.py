"""Main text of web pages with site template removal.

A page's markup becomes a light element tree. Two things mark a subtree as not part of the article: what the element says it
is (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts), and its being a template, that is, the
same subtree recurring on many pages of its host. For the latter each page emits hashes of its block subtrees, Spark counts
on how many different articles of the host each occurs, and the template hashes go back to the pages that carry them.

Every page is parsed twice: once for the hashes of the subtrees that would be part of its text, which are kept as a small table,
once for the text. Hashes are counted by page first, and only those on enough pages go on to be counted by different articles, so
copies of an article do not look like a template. Pages that may hold a template (a bitmap of fixed size tells) are shuffled
to meet their hashes; all others are read where they lie. Hosts of any size are spread by hash.

A subtree is a template if it occurs with at least ``least(n)`` of its host's ``n`` different articles, a number that grows like the
logarithm. Elements of running text inside an article (headings, paragraphs, list items and the like) must besides occur in a
share of them, so that a passage which a few articles quote stays.

A class or id marks an element only if all of its parts are names of page furniture, or its last part is the name of comments,
adverts, notices or the like; elements of running text only by the latter, and never by the names of comments. Articles that call
themselves teasers do not count as the page's article.

Null and empty pages give an empty text. Repeated rows get equal results. A page without an article or main element is taken
whole but for what is marked. Broken and unclosed markup is read as far as it goes. Pages are read one at a time whatever their
length. An empty table gives no rows. Columns besides those named are not looked at; ``keep`` must not name ``text``.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, may_hold

#: Least number of different articles that a template occurs with, and least share of them for elements of running text.
LEAST_PAGES, LEAST_SHARE = 5, 0.4

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(/?)>|([^<]+|<)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
RAW = frozenset({"script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noembed", "noframes"})
#: Elements of running text.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th caption figcaption blockquote pre xmp address hr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th pre blockquote figure "
    "figcaption address nav header footer aside form fieldset details summary hgroup center hr menu dialog search xmp".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video nav header footer aside form button select textarea "
    "input label fieldset dialog menu search title annotation annotation-xml".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
#: Names of adverts, notices and the like; the last part of a class or id is enough.
NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr newsletter "
    "subscribe subscription signup disqus share sharing breadcrumb breadcrumbs pagination popup".split()
)
COMMENTS = frozenset("comment comments reply replies".split())
#: Names of page furniture; a class or id must be made of these, of the names above and of fillers only.
FURNITURE = frozenset("banner notice modal overlay sidebar menu nav navbar navigation footer header masthead social related recommended widget pager skip toolbar".split())
FILLERS = frozenset(
    "site page main top bottom left right primary secondary global box bar block container wrapper wrap list section area inner links link "
    "buttons button slot unit form panel row item items module component region the user reader readers web mobile desktop sticky fixed "
    "content posts stories articles icons".split()
)
TEASERS = frozenset("teaser teasers card cards preview excerpt".split())
#: An open element is closed by the start of one of these.
CLOSED_BY = {
    "p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "option": frozenset({"option"}),
}
_MOD = (1 << 61) - 1
_BASE = 0x1A2B3C4D5E6F71


def _name_parts(value: str) -> list[list[str]]:
    """The lower-case parts of every name in a class or id: ``site-Footer relatedPosts`` gives [site, footer], [related, posts]."""
    return [[part.lower() for part in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)] for name in value.split()]


def _named(tag: str, value: str) -> bool:
    """Whether a class or id says that the element is page furniture, an advert, a notice or reader comments."""
    for parts in _name_parts(value):
        if not parts:
            continue
        if parts[-1] in NOTICES or parts[-1] in COMMENTS and tag not in PROSE:
            return True
        names = [p for p in parts if p in FURNITURE or p in NOTICES or p in COMMENTS and tag not in PROSE]
        if tag not in PROSE and names and all(p in FILLERS or p in FURNITURE or p in NOTICES or p in COMMENTS for p in parts):
            return True
    return False


def _marked(tag: str, attributes: str) -> bool:
    """Whether an element says that it is no part of the article."""
    if tag in DROPPED:
        return True
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        lowered = value.lower()
        if name == "role" and lowered in ROLES or name == "hidden" or name == "aria-hidden" and lowered == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", lowered):
            return True
        if name in ("class", "id") and _named(tag, value):
            return True
    return False


def _teaser(attributes: str) -> bool:
    return any(not TEASERS.isdisjoint(parts) for name, value in ATTRIBUTE.findall(attributes) if name.lower() == "class" for parts in _name_parts(value.strip("\"'")))


class Page:
    """Elements in page order: tag, parent, whether marked, and the range of text pieces below; text pieces with their parent."""

    def __init__(self, source: str):
        self.tag, self.parent, self.own_mark, self.first, self.last, self.teaser = ["#root"], [-1], [False], [0], [0], set()
        self.texts: list[tuple[int, str]] = []
        stack, at, n = [0], 0, len(source)
        open_tags: dict[str, int] = {}
        while at < n:
            m = TOKEN.match(source, at)
            at = m.end()
            tag = m[2]
            if tag is None:
                if m[5] is not None:
                    self.texts.append((stack[-1], m[5]))
                continue
            tag = tag.lower()
            if m[1]:
                if open_tags.get(tag):
                    while True:
                        k = stack.pop()
                        self.last[k] = len(self.texts)
                        open_tags[self.tag[k]] -= 1
                        if self.tag[k] == tag:
                            break
                continue
            while len(stack) > 1 and tag in CLOSED_BY.get(self.tag[stack[-1]], ()):
                k = stack.pop()
                self.last[k] = len(self.texts)
                open_tags[self.tag[k]] -= 1
            if tag in BLOCK and tag != "p" and open_tags.get("p") or tag == "p" and open_tags.get("p"):
                self._close_paragraph(stack, open_tags)
            k = len(self.tag)
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.own_mark.append(_marked(tag, m[3]))
            if tag == "article" and _teaser(m[3]):
                self.teaser.add(k)
            self.first.append(len(self.texts))
            self.last.append(len(self.texts))
            if tag in VOID or m[4] and tag not in BLOCK:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                if tag == "xmp":
                    # shown as it stands: its character references are text
                    self.texts.append((k, source[at : end.start() if end else n].replace("&", "&amp;")))
                    self.last[k] = len(self.texts)
                at = end.start() if end else n
                close = source.find(">", at)
                at = close + 1 if end and close >= 0 else n
                continue
            stack.append(k)
            open_tags[tag] = open_tags.get(tag, 0) + 1
        for k in stack:
            self.last[k] = len(self.texts)
        self._settle()

    def _close_paragraph(self, stack: list[int], open_tags: dict[str, int]) -> None:
        """Close an open paragraph below inline elements (they stay open without effect on the blocks)."""
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[depth]]
            if tag == "p":
                for k in stack[depth:]:
                    self.last[k] = len(self.texts)
                    open_tags[self.tag[k]] -= 1
                del stack[depth:]
                return
            if tag in BLOCK:
                return

    def _settle(self) -> None:
        """Marks that stand: class and id names count only on elements that hold no article."""
        holds = [False] * len(self.tag)
        for k in range(len(self.tag) - 1, 0, -1):
            if holds[k] or self.tag[k] in ("article", "main") and k not in self.teaser:
                holds[self.parent[k]] = True
        self.main = [k for k, t in enumerate(self.tag) if t in ("article", "main") and k not in self.teaser]
        self.mark = [own and not (holds[k] and self.tag[k] not in DROPPED) for k, own in enumerate(self.own_mark)]
        for k in range(1, len(self.tag)):
            self.mark[k] = self.mark[k] or self.mark[self.parent[k]]
        self.main = [k for k in self.main if not self.mark[k]]
        self.inside = [not self.main] * len(self.tag)
        for k in self.main:
            self.inside[k] = True
        for k in range(1, len(self.tag)):
            self.inside[k] = self.inside[k] or self.inside[self.parent[k]]

    def subtrees(self) -> list[tuple[int, int]]:
        """Block elements that are part of the text, below its outermost ones, with their hash: of the words below and of where
        blocks begin. An odd hash is that of an element of running text inside an article."""
        sums, power = [0], [1]
        starts: dict[int, int] = {}
        for k in range(1, len(self.tag)):
            if self.tag[k] in BLOCK:
                starts[self.first[k]] = starts.get(self.first[k], 0) + 1
        for i, (_, text) in enumerate(self.texts):
            piece = " ".join(text.split())
            value = xxhash.xxh3_64_intdigest(piece) % _MOD if piece else 0
            sums.append((sums[-1] * _BASE + value + starts.get(i, 0)) % _MOD if piece else sums[-1])
            power.append(power[-1] * _BASE % _MOD if piece else power[-1])
        out = []
        for k in range(1, len(self.tag)):
            a, b = self.first[k], self.last[k]
            counts = self.tag[k] in BLOCK and not self.mark[k] and self.inside[self.parent[k]] and self.tag[k] not in ("html", "body")
            if counts and power[a] != power[b]:
                grown = power[b] * pow(power[a], -1, _MOD) % _MOD
                prose = bool(self.main) and self.tag[k] in PROSE
                out.append((k, xxhash.xxh3_64_intdigest(f"{self.tag[k]}:{(sums[b] - sums[a] * grown) % _MOD}") >> 1 << 1 | prose))
        return out

    def text(self, host: str, templates: frozenset[int]) -> str:
        """The article: its blocks in page order, without marked subtrees and those whose hash is a template of the host."""
        gone = list(self.mark)
        if templates:
            for k, h in self.subtrees():
                gone[k] = gone[k] or keyed(host, h) in templates
        inside, block = self.inside, [0] * len(self.tag)
        for k in range(1, len(self.tag)):
            p = self.parent[k]
            gone[k] = gone[k] or gone[p]
            block[k] = k if self.tag[k] in BLOCK else block[p]
        breaks = sorted({x for k in range(1, len(self.tag)) if self.tag[k] in BLOCK for x in (self.first[k], self.last[k])})
        lines: list[str] = []
        parts: list[str] = []
        gaps = {self.first[k] for k in range(1, len(self.tag)) if self.tag[k] in ("br", "img", "wbr")}
        following = iter([*breaks, 1 << 60])
        edge = next(following)

        def close() -> None:
            line = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if line:
                lines.append(line)

        for i, (k, piece) in enumerate(self.texts):
            if i >= edge:
                close()
                while i >= edge:
                    edge = next(following)
            if inside[k] and not gone[k]:
                if i in gaps:
                    parts.append(" ")
                parts.append(piece)
        close()
        return "\n".join(lines)


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def keyed(host: str, subtree: int) -> int:
    """One signed 64-bit key for a subtree of a host; odd for elements of running text, like the subtree's hash."""
    return (xxhash.xxh3_64_intdigest(f"{host}\0{subtree}") >> 1 << 1 | subtree & 1) - (1 << 63)


def _subtree_rows(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out: dict[str, list] = {"page": part.column("page").to_pylist(), "host": [], "article": [], "keys": []}
            for url, source in zip(part.column("url").to_pylist(), part.column("html").to_pylist()):
                host, page = host_of(url), Page(source or "")
                out["host"].append(xxhash.xxh3_64_intdigest(host) - (1 << 63))
                out["article"].append(xxhash.xxh3_64_intdigest(page.text(host, frozenset())) - (1 << 63))
                out["keys"].append(list({keyed(host, h) for _, h in page.subtrees()}))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("page", pa.int64()), ("host", pa.int64()), ("article", pa.int64()), ("keys", pa.list_(pa.int64()))]))


def least_articles(articles: Column, least_pages: int) -> Column:
    """How many different articles a template must occur with on a host that has so many: ``least_pages`` or the logarithm."""
    return F.greatest(F.lit(least_pages), F.ceil(F.log2(articles)).cast("int"))


def template_keys(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``page`` and its template ``keys``, for pages that have any; ``pages`` has ``page`` (a hash of its content), url and html."""
    found = checkpointed(pages.select("page", "url", "html").mapInArrow(_subtree_rows, "page long, host long, article long, keys array<long>"))
    each = found.select("page", "host", "article", F.explode("keys").alias("key"))
    often = checkpointed(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages).select("key"))
    some = may_hold(each, F.col("key"), often, F.col("key"), "maybe").filter("maybe").drop("maybe")
    articles = found.groupBy("host", "article").agg(F.lit(1)).groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    counted = some.groupBy("host", "key", "article").agg(F.lit(1)).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    prose = F.col("key").bitwiseAND(F.lit(1)) == 1
    enough = (F.col("n") >= least_articles(F.col("articles"), least_pages)) & (~prose | (F.col("n") >= least_share * F.col("articles")))
    templates = counted.filter(F.col("n") >= least_pages).join(articles, "host").filter(enough).select("key")
    return checkpointed(some.select("page", "key").join(templates, "key").groupBy("page").agg(F.collect_set("key").alias("keys")))


def _text_rows(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [
                Page(source or "").text(host_of(url), frozenset(keys or ()))
                for url, source, keys in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), part.column("keys").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def extract(
    df: DataFrame, html: str = "html", url: str = "url", keep: list[str] | None = None, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE
) -> DataFrame:
    """The columns ``keep`` (default ``page_id`` and ``url``) of every page and its main ``text``."""
    kept = keep or ["page_id", "url"]
    if "text" in kept:
        raise ValueError("the result has a column text already")
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    pages = df.select(row, F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")).withColumn("page", F.xxhash64("url", "html"))
    marked = template_keys(pages, least_pages, least_share)
    tried = may_hold(pages, F.col("page"), marked, F.col("page"), "maybe")
    plain = tried.filter(~F.col("maybe")).select("row", "url", "html", F.lit(None).cast("array<long>").alias("keys"))
    held = tried.filter("maybe").join(marked.withColumnRenamed("page", "of"), F.col("page") == F.col("of"), "left").select("row", "url", "html", "keys")
    schema = f"row {plain.schema['row'].dataType.simpleString()}, text string"
    return plain.unionByName(held).mapInArrow(_text_rows, schema).select("row.*", "text")
