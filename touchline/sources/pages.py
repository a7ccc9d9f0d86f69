"""Tables out of crawled HTML pages.

Splitting HTML into cells needs a parser, so that one step runs in Arrow batches next to the data;
everything after it (cell choice, suffix strip, link parameters) is column expressions. Parsing takes far longer
per byte than reading: where the splits of a scan are few, deal the rows to more tasks first (``dealt``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.json import json_field, url_parameter
from touchline.functions.numbers import strip_signed_suffix

_CELL_ARRAY = "ARRAY<STRUCT<text:STRING,p:STRING,a:STRING,href:STRING,sup:BOOLEAN>>"
_CELLS = pa.list_(pa.struct([("text", pa.string()), ("p", pa.string()), ("a", pa.string()), ("href", pa.string()), ("sup", pa.bool_())]))

#: Text and the tag after it, in the plain form that leaves nothing to interpretation; anything else is the parser's.
_PLAIN = re.compile(
    r"([^<]*+)<(/?)([a-zA-Z][a-zA-Z0-9]*+)((?:[ \t\n\r\f]++[a-zA-Z][-a-zA-Z0-9]*+=\"(?:[^\"<>&]|&amp;)*+\")*+)[ \t\n\r\f]*+(/?)>"
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-a-zA-Z0-9]*)=\"([^\"]*)\"")
_USED = frozenset(["table", "tbody", "tr", "td", "p", "a", "sup"])
#: Elements whose content is, or in some versions of the parser may be, other than markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())


class _Ended(Exception):
    """The wanted table is over; what follows it changes nothing."""


class _FirstTable(HTMLParser):
    """Cells of the first table (with the wanted class) in document order."""

    def __init__(self, css_class: str | None):
        super().__init__(convert_charrefs=True)
        self.css_class, self.rows, self.state = css_class, [], "before"
        self.depth, self.bodies, self.in_body, self.cell, self.open = 0, 0, False, None, []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "table":
            wanted = self.css_class is None or self.css_class in (attrs.get("class") or "").split()
            if self.state == "before" and wanted:
                self.state = "inside"
            self.depth += self.state == "inside"
        if self.state != "inside":
            return
        if tag == "tbody":
            if self.depth == 1:
                self.bodies += 1
            self.in_body = self.bodies == 1
        elif tag == "tr" and self.in_body:
            self.rows.append([])
        elif tag == "td" and self.in_body and self.rows:
            self.cell = {"text": "", "p": None, "a": None, "href": None, "sup": False}
            self.open = []
            self.rows[-1].append(self.cell)
        elif self.cell is not None and tag in ("p", "a", "sup"):
            if tag == "sup":
                self.cell["sup"] = True
            elif self.cell[tag] is None:
                self.cell[tag] = ""
                self.open.append(tag)
                if tag == "a":
                    self.cell["href"] = attrs.get("href")

    def handle_endtag(self, tag):
        if self.state != "inside":
            return
        if tag == "table":
            self.depth -= 1
            if self.depth == 0:
                raise _Ended
        elif tag == "tbody" and self.depth == 1:
            self.in_body = False
        elif tag == "td":
            self.cell = None
        elif tag in self.open:
            self.open.remove(tag)

    def handle_data(self, data):
        if self.state == "inside" and self.cell is not None:
            self.cell["text"] += data.strip()
            for tag in self.open:
                self.cell[tag] += data.strip()


def _plain_rows(page: str, css_class: str | None) -> list | None:
    """What ``_FirstTable`` finds, for pages that are plain as far as the table reaches; None for others."""
    table, at = _FirstTable(css_class), 0
    try:
        while found := _PLAIN.match(page, at):
            text, closing, tag, attrs, single = found.groups()
            tag, at = tag.lower(), found.end()
            if tag in _RAW or closing and (attrs or single):
                return None
            if text and table.cell is not None:
                table.handle_data(unescape(text))
            if tag not in _USED:
                continue
            if not closing:
                table.handle_starttag(tag, [(k.lower(), unescape(v)) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else [])
            if closing or single:
                table.handle_endtag(tag)
    except _Ended:
        return table.rows
    return [] if at == len(page) and table.state == "before" else None


def _table_rows(page: str, css_class: str | None) -> list:
    rows = _plain_rows(page, css_class)
    if rows is not None:
        return rows
    parser = _FirstTable(css_class)
    try:
        parser.feed(page)
    except _Ended:
        pass
    return parser.rows


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their ``keys`` to as many tasks as a shuffle has, or the cluster cores if those are more."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *keys)


def table_cells(pages: DataFrame, html: str = "html", css_class: str | None = None) -> DataFrame:
    """Body rows of each page's first table: all page columns but the HTML, ``row_no`` and ``cells``."""
    kept = [c for c in pages.columns if c != html]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers, cells = [], [], []
            for place, page in enumerate(batch.column(html).to_pylist()):
                rows = _table_rows(page or "", css_class)
                places.extend([place] * len(rows))
                numbers.extend(range(len(rows)))
                cells.extend(rows)
            at = pa.array(places, pa.int64())
            columns = [batch.column(c).take(at) for c in kept]
            columns += [pa.array(numbers, pa.int32()), pa.array(cells, _CELLS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "row_no", "cells"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in kept]
    return pages.mapInArrow(parse, ", ".join([*fields, "row_no INT", f"cells {_CELL_ARRAY}"]))


def _cell(i: int, part: str = "text") -> Column:
    return F.get("cells", F.lit(i))[part]


def _pick(rows: DataFrame, names: list[str], first: int) -> list[Column]:
    return [_cell(i + first).alias(n) for i, n in enumerate(names)]


def _others(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != "cells"]


def league_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """League table rows with at least ten cells and a team name."""
    rows = table_cells(pages, html, "table").filter((F.size("cells") >= 10) & _cell(1, "p").isNotNull())
    return rows.select(
        *_others(rows), _cell(0).alias("rank"), _cell(1, "p").alias("team"),
        link_parameter(_cell(1, "href"), "club_id").alias("club_id"),
        *_pick(rows, ["played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_diff", "points"], 2),
    )


def scorer_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Scorer rows of a club page; page columns (such as its team) stay on every row."""
    rows = table_cells(pages, html, "table").filter((F.size("cells") >= 8) & _cell(0, "p").isNotNull())
    return rows.select(
        *_others(rows), _cell(0, "p").alias("player"), *_pick(rows, ["goals", "fh", "sh", "fs", "ls", "h", "a"], 1)
    )


def expected_goal_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of the expected-goals table; the signed difference after a figure is cut off."""
    rows = table_cells(pages, html).filter(F.size("cells") >= 11)

    def figure(i: int, otherwise: Column) -> Column:
        return F.when(_cell(i, "sup"), strip_signed_suffix(_cell(i))).otherwise(otherwise)

    return rows.select(
        *_others(rows), _cell(0).alias("rank"), F.coalesce(_cell(1, "a"), F.lit("")).alias("team"),
        *_pick(rows, ["played", "wins", "draws", "losses", "goals_for", "goals_against", "points"], 2),
        figure(9, _cell(9)).alias("xG"), figure(10, _cell(10)).alias("xGA"), figure(11, F.lit("")).alias("xPTS"),
    )


def link_parameter(href: Column | str, name: str) -> Column:
    """Q4 for relative links too."""
    href = F.col(href) if isinstance(href, str) else href
    absolute = F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).otherwise(
        F.concat(F.lit("http://h/"), F.regexp_replace(href, "^/+", ""))
    )
    return url_parameter(absolute, name)


def player_array(pages: DataFrame, body: str = "body") -> DataFrame:
    """The players array of a JSON page as text, an empty array when it is missing."""
    players = F.to_json(json_field(body, "$.players", "variant"))
    return pages.withColumn("players", F.coalesce(players, F.lit("[]"))).drop(body)
