"""Main text of web pages by differencing each page with the nearest page of its host.

Pages are sorted by host and URL path; a page is paired with the neighbour of its host whose path is
nearest and which is no near copy. Text lines (blocks) of the pair are aligned by a longest common
subsequence, and lines shared with the other page are deleted. Markup is an extra guard: lines of
menus, headers, footers, sidebars, notices, adverts, forms and comments go although no other page has
them, and so do lines beside the article of a page that has one.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from marginfold.llm.components import connected_components
from marginfold.sources.scratch import discard, scratch_folder, written

_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that never hold main text.
_DROPPED = frozenset(
    "script style noscript template head title nav aside footer form button select textarea iframe object svg canvas audio "
    "video dialog menu".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
# Words that mark the same where a class token or an id consists of them, alone or with _PLACE_WORDS.
_DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead comment comments "
    "commentlist disqus respond replies share sharing social related recommended newsletter subscribe signup login popup modal "
    "overlay pagination pager widget toolbar".split()
)
# Words that say where or in what form something is.
_PLACE_WORDS = frozenset(
    "site page main global top bottom left right primary secondary box bar block area container wrapper list item items link links "
    "button buttons icon icons form posts"
    .split()
)
# Of these words, the ones that also name a part of an article.
_ARTICLE_WORDS = frozenset("notice notices alert aside promotion".split())
_WORD = re.compile("[a-z0-9]+")
_MAIN = ("article", "main")
# A form with a heading or a line of so many words holds more than fields.
_TEXT_WORDS = 25


def _ends(names: str, closed: str, scope: str) -> dict[str, tuple[frozenset[str], frozenset[str]]]:
    return dict.fromkeys(names.split(), (frozenset(closed.split()), frozenset(scope.split())))


# Start tags that imply end tags: which elements they close, and those that they do not look beyond.
_IMPLIED_ENDS = (
    _ends(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section summary table ul",
        "p",
        "table caption td th button object template",
    )
    | _ends("li", "li", "ul ol menu dir table td th")
    | _ends("dt dd", "dt dd", "dl table td th")
    | _ends("option optgroup", "option", "select datalist")
    | _ends("td th", "td th caption", "tr table")
    | _ends("tr", "tr td th caption", "table")
    | _ends("tbody thead tfoot", "tbody thead tfoot tr td th caption", "table")
)


class _Lines(HTMLParser):
    """Collects (line, is_main, owners) of a page; lines of dropped elements are left out.

    Elements dropped for their class or id, and forms, may hold the article: they are ``owners`` of
    their lines, which page_lines drops when all of the page is known.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, bool, tuple[int, ...]]] = []
        self.forms: set[int] = set()
        self.text_forms: set[int] = set()
        self.article_owners: set[int] = set()
        self._open: list[tuple[str, bool, bool, bool]] = []
        # Where each element name is in the list of open ones.
        self._places: dict[str, list[int]] = {}
        self._owners: list[int] = []
        self._n_owners = 0
        self._text: list[str] = []
        self._dropping = self._in_main = 0

    def _end_line(self) -> None:
        line = " ".join("".join(self._text).split())
        self._text.clear()
        if line:
            self.lines.append((line, self._in_main > 0, tuple(self._owners)))
            if self._owners and line.count(" ") + 1 >= _TEXT_WORDS:
                self.text_forms.update(self.forms.intersection(self._owners))

    def _is_dropped(self, tag: str, attributes: list[tuple[str, str | None]]) -> bool:
        if tag in _DROPPED and tag != "form" or tag == "header" and not self._in_main:
            return True
        if tag in ("html", "body", "main"):
            return False
        return any(name == "hidden" or name == "role" and (value or "").lower() in _DROPPED_ROLES for name, value in attributes)

    def _is_owner(self, tag: str, attributes: list[tuple[str, str | None]]) -> bool:
        """Whether a form, or marked by its class or id; articles are not, except those inside one."""
        if tag == "form":
            return True
        if tag in ("html", "body", "main") or tag == "article" and not self._in_main:
            return False
        # An article inside an article is a comment or teaser if it says so.
        marks = _DROPPED_WORDS - _ARTICLE_WORDS if self._in_main and tag != "article" else _DROPPED_WORDS
        for name, value in attributes:
            if name in ("class", "id"):
                for token in (value or "").lower().split():
                    words = set(_WORD.findall(token))
                    if words & marks and words <= _DROPPED_WORDS | _PLACE_WORDS:
                        return True
        return False

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS:
            self._end_line()
        closed, scope = _IMPLIED_ENDS.get(tag, ((), ()))
        if closed:
            self._close_in_scope(closed, scope)
        if tag in _VOID:
            return
        if tag == "body":
            # An end tag of the head may be missing.
            self._close_down_to("head")
        dropped = self._is_dropped(tag, attributes)
        owner = not dropped and self._is_owner(tag, attributes)
        main = tag in _MAIN or ("role", "main") in attributes
        if not self._dropping and (main or tag == "h1"):
            self.text_forms.update(self.forms.intersection(self._owners))
            if main and not self._in_main:
                self.article_owners.update(self._owners)
        if owner:
            self._n_owners += 1
            self._owners.append(self._n_owners)
            if tag == "form":
                self.forms.add(self._n_owners)
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append((tag, dropped, main, owner))
        self._dropping += dropped
        self._in_main += main

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS:
            self._end_line()

    def _close(self) -> None:
        tag, dropped, main, owner = self._open.pop()
        self._places[tag].pop()
        self._dropping -= dropped
        self._in_main -= main
        if owner:
            self._owners.pop()

    def _close_in_scope(self, closed: frozenset[str], scope: frozenset[str]) -> None:
        barrier = max((self._places[name][-1] for name in scope if self._places.get(name)), default=-1)
        left = len(self._open)
        for name in closed:
            places = self._places.get(name)
            if places and places[-1] > barrier:
                left = min(left, places[bisect(places, barrier)])
        while len(self._open) > left:
            self._close()

    def _close_down_to(self, tag: str) -> None:
        if not self._places.get(tag):
            return
        while self._open[-1][0] != tag:
            self._close()
        self._close()

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._end_line()
        self._close_down_to(tag)

    def handle_data(self, data: str) -> None:
        if not self._dropping:
            self._text.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)


def _ended_markup(html: str) -> tuple[str, str]:
    """What the parser reads, and the text behind it that is no markup.

    A tag or comment that never ends would be looked through again from each of its characters. Nothing
    behind the last ``>`` is a whole tag, so that is text. A comment that is open at the end of the page
    holds all the rest.
    """
    opened = html.rfind("<!--")
    ended = max(html.rfind("-->"), html.rfind("--!>"))
    if opened > ended:
        opened = html.find("<!--", max(ended, 0))
        html = html[:opened]
    last = html.rfind(">") + 1
    return html[:last], html[last:]


def page_lines(html: str | None) -> list[tuple[str, bool]]:
    """(line, is_main) for each block with text, in page order; is_main inside an article or main element."""
    parser = _Lines()
    tagged, rest = _ended_markup(html or "")
    parser.feed(tagged)
    parser.close()
    parser.handle_data(unescape(rest))
    parser._end_line()

    def outside(kept: set[int]) -> list[tuple[str, bool]]:
        return [(line, main) for line, main, owners in parser.lines if kept.issuperset(owners)]

    lines = outside(parser.text_forms)
    if parser.article_owners and not any(main for _, main in lines):
        # The only article is inside a marked element, which then is the page's wrapper.
        lines = outside(parser.text_forms | parser.article_owners)
    return lines or outside(parser.forms)


_MOST_BITS = 1 << 31


def _rows(a: Sequence, b: Sequence) -> Iterator[int]:
    """Bit rows of the alignment: after each element of ``a``, zero bits where the length grows along ``b``."""
    places: dict = {}
    for j, element in enumerate(b):
        places[element] = places.get(element, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for element in a:
        met = row & places.get(element, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def _lengths(a: Sequence, b: Sequence) -> list[int]:
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    lengths = [0]
    for bit in reversed(f"{row:0{len(b)}b}" if b else ""):
        lengths.append(lengths[-1] + (bit == "0"))
    return lengths


def common_subsequence(a: Sequence, b: Sequence, most_bits: int = _MOST_BITS) -> list[int]:
    """The places in ``a`` of a longest common subsequence with ``b``.

    Rows are bit vectors; where all of them would take too much memory, ``a`` is halved.
    """
    in_a, in_b = set(a), set(b)
    at = [i for i, element in enumerate(a) if element in in_b]
    a, b = [a[i] for i in at], [element for element in b if element in in_a]
    if not a:
        return []
    if len(a) > 1 and len(a) * len(b) > most_bits:
        middle = len(a) // 2
        before = _lengths(a[:middle], b)
        after = _lengths(a[middle:][::-1], b[::-1])[::-1]
        cut = max(range(len(b) + 1), key=lambda j: before[j] + after[j])
        left = common_subsequence(a[:middle], b[:cut], most_bits)
        right = common_subsequence(a[middle:], b[cut:], most_bits)
        return [at[i] for i in left] + [at[middle + i] for i in right]
    rows = list(_rows(a, b))
    found, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.append(at[i])
        elif rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return found[::-1]


def _relevant(is_main: Sequence[bool]) -> list[int]:
    """The places of the lines that can be main text: those inside an article or main element, else all."""
    return [i for i, main in enumerate(is_main) if main] or list(range(len(is_main)))


# Lines that are shared with another page are its frame, unless they make up this share of the
# characters: then the page is a near copy. An article holds less frame than a page without one.
_COPY_OF_ARTICLE, _COPY_OF_PAGE = 0.6, 0.8
# Articles share a short line by chance, or quote a common text such as a licence. One at an article's
# edge is its site's frame if it stands so, and is shared, on this many different pages of one host, and
# of no other.
LEAST_PAGES = 3


def shared_lines(
    lines: Sequence, sizes: Sequence[int], is_main: Sequence[bool], other: Sequence, other_sizes: Sequence[int], other_is_main: Sequence[bool]
) -> list[int] | None:
    """The places of a page's lines that the other page has too; None if one of the two is a near copy of the other or of a part of it.

    Of an article's lines only those at its edges count: before its first and behind its last line of its own.
    """
    at, other_at = _relevant(is_main), _relevant(other_is_main)
    shared = [at[i] for i in common_subsequence([lines[i] for i in at], other)]
    least = min(sum(sizes[i] for i in at), sum(other_sizes[i] for i in other_at))
    limit = _COPY_OF_ARTICLE if any(is_main) and any(other_is_main) else _COPY_OF_PAGE
    if shared and sum(sizes[i] for i in shared) >= limit * least:
        return None
    return at_edges(at, shared) if any(is_main) else shared


def at_edges(places: Sequence[int], shared: Sequence[int]) -> list[int]:
    """Those of ``shared`` that nothing else of ``places`` stands before, or behind."""
    found, gone = set(), frozenset(shared)
    for order in (places, reversed(places)):
        found.update(takewhile(gone.__contains__, order))
    return sorted(found)


def kept_text(lines: Sequence[str], is_main: Sequence[bool], shared: Sequence[int] | None) -> str:
    """The lines inside article or main elements, or all if there are none, without the shared ones, joined by spaces."""
    gone = frozenset(shared or ())
    return " ".join(lines[i] for i in _relevant(is_main) if i not in gone)


def main_text(lines: Sequence[str], is_main: Sequence[bool], other: Sequence[str] | None, other_is_main: Sequence[bool] | None = None) -> str:
    """The lines of a page that are its main text, joined by spaces.

    With an article or main element these are the lines inside, else all; lines shared with the other
    page go, unless it is a near copy.
    """
    if not other:
        return kept_text(lines, is_main, None)
    other_is_main = other_is_main or [False] * len(other)
    shared = shared_lines(lines, [*map(len, lines)], is_main, other, [*map(len, other)], other_is_main)
    return kept_text(lines, is_main, shared)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield batch.slice(start, 256)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        parsed = [page_lines(value.as_py()) for value in part.column("html")]
        lines = pa.array([[line for line, _ in page] for page in parsed], pa.list_(pa.string()))
        mains = pa.array([[main for _, main in page] for page in parsed], pa.list_(pa.bool_()))
        names = ["page_id", "url", "host", "path"]
        yield pa.record_batch([*map(part.column, names), lines, mains], names=[*names, "lines", "is_main"])


_SIDES = ("hashes", "sizes", "is_main", "other_hashes", "other_sizes", "other_is_main")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, rank, shared) of the rows; ``shared`` is null for near copies."""
    for part in _slices(batches):
        shared = [shared_lines(*(side.as_py() for side in sides)) for sides in zip(*map(part.column, _SIDES))]
        columns = [part.column("place"), part.column("rank"), pa.array(shared, pa.list_(pa.int32()))]
        yield pa.record_batch(columns, names=["place", "rank", "shared"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        columns = map(part.column, ("lines", "is_main", "shared"))
        texts = [kept_text(*(value.as_py() for value in row)) for row in zip(*columns)]
        yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


_ADDRESS = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)"


def _steps_in_common(a: str, b: str) -> Column:
    """How many leading steps two paths have in common."""
    left, right = F.split(a, "/"), F.split(b, "/")
    return F.aggregate(
        F.sequence(F.lit(0), F.size(left)),
        F.lit(0),
        lambda n, i: F.when((n == i) & (F.get(left, i) == F.get(right, i)), n + 1).otherwise(n),
    )


def _parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, lines, is_main, content) of every page."""
    url = F.coalesce("url", F.lit(""))
    schema = T.StructType(
        [
            pages.schema["page_id"],
            pages.schema["url"],
            T.StructField("host", T.StringType()),
            T.StructField("path", T.StringType()),
            T.StructField("lines", T.ArrayType(T.StringType())),
            T.StructField("is_main", T.ArrayType(T.BooleanType())),
        ]
    )
    addressed = pages.select(
        "page_id",
        "url",
        "html",
        F.lower(F.regexp_extract(url, _ADDRESS, 1)).alias("host"),
        F.regexp_extract(url, _ADDRESS, 2).alias("path"),
    )
    return addressed.mapInArrow(_parse, schema).withColumn("content", F.xxhash64("lines", "is_main"))


def _contents(parsed: DataFrame) -> DataFrame:
    """(host, content, path, hashes, sizes, is_main): one row for the equal pages of a host, lines as hashes and lengths."""
    return (
        parsed.where("host <> '' AND size(lines) > 0")
        .select(
            "host",
            "content",
            "path",
            F.transform("lines", lambda line: F.xxhash64(line)).alias("hashes"),
            F.transform("lines", lambda line: F.length(line)).alias("sizes"),
            "is_main",
        )
        .groupBy("host", "content")
        .agg(F.min("path").alias("path"), *(F.first(name).alias(name) for name in ("hashes", "sizes", "is_main")))
    )


def _placed(contents: DataFrame, n_parts: int) -> DataFrame:
    """(place, host, path, content): the contents in the order of host and path, without their lines.

    Keys are range-partitioned, so a host with many pages spreads; a place is the number of pages in
    the partitions before, one number for each, and the place in the partition. Where partitions end
    depends on a sample, so they are written to the shared folder.
    """
    keys = ["host", "path", "content"]
    in_order = contents.select(*keys).repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    numbered = in_order.withColumn("number", F.monotonically_increasing_id())
    parts = written(
        numbered.withColumns(
            {"part": F.shiftright("number", 33).cast("int"), "at": F.expr("number & 8589934591")}
        ).drop("number")
    )
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return parts.join(starts, "part").withColumn("place", F.col("start") + F.col("at")).drop("part", "at", "start")


def _compared(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """(place, rank, shared) of ``pairs`` (place, mate, rank): ``shared`` are the places of common lines, null for near copies."""
    sides = ("hashes", "sizes", "is_main")
    own = placed.select("place", *sides)
    other = placed.select(F.col("place").alias("mate"), *(F.col(side).alias(f"other_{side}") for side in sides))
    schema = T.StructType([pairs.schema["place"], pairs.schema["rank"], T.StructField("shared", T.ArrayType(T.IntegerType()))])
    return pairs.join(other, "mate").join(own, "place").mapInArrow(_compare, schema)


def _mates(placed: DataFrame) -> DataFrame:
    """(place, mate, rank): for every page the nearest pages of its host before and after it that are no near copies.

    Near copies that follow each other are one run, and its pages have the page before and the one
    after the run as mates. The greater rank has the nearer path, the page before on a tie.
    """
    keys = placed.select("place", "host", "path")
    after = keys.select((F.col("place") - 1).alias("place"), F.col("place").alias("mate"), F.col("host").alias("other_host"))
    following = keys.join(after, "place").where("host = other_host").select("place", "mate", F.lit(0).alias("rank"))
    near = _compared(following, placed).where("shared IS NULL")
    runs = written(connected_components(near.select(F.col("place").alias("a"), (F.col("place") + 1).alias("b"))))
    ends = runs.groupBy("root").agg(F.max("node").alias("end"))
    spans = runs.join(ends, "root").select(F.col("node").alias("place"), F.col("root").alias("start"), "end")
    spanned = keys.join(spans, "place", "left")
    sides = F.array(
        F.struct((F.coalesce("start", "place") - 1).alias("mate"), F.lit(1).alias("before")),
        F.struct((F.coalesce("end", "place") + 1).alias("mate"), F.lit(0).alias("before")),
    )
    wanted = spanned.withColumn("side", F.explode(sides)).select("place", "host", "path", "side.mate", "side.before")
    other = keys.select(F.col("place").alias("mate"), F.col("host").alias("other_host"), F.col("path").alias("other_path"))
    rank = 2 * _steps_in_common("path", "other_path") + F.col("before")
    return wanted.join(other, "mate").where("host = other_host").select("place", "mate", rank.alias("rank"))


def _deletions(parsed: DataFrame, pages_per_part: int) -> DataFrame:
    """(host, content, shared): the places of the lines to delete, for pages that have any.

    These are the lines that a page shares with its mate; in an article those at its edges that other pages
    of the host have there too, and pages of no other host.
    """
    spark = parsed.sparkSession
    path = scratch_folder(spark)
    contents = written(_contents(parsed), path)
    n_parts = max(1, -(-contents.count() // pages_per_part))
    placed = written(_placed(contents, n_parts).join(contents.drop("path"), ["host", "content"]))
    discard(spark, path)
    compared = _compared(_mates(placed), placed).where("shared IS NOT NULL")
    best = compared.groupBy("place").agg(F.max_by("shared", "rank").alias("shared")).where("size(shared) > 0")
    found = placed.select("place", "host", "content", "hashes", F.exists("is_main", lambda main: main).alias("has_article")).join(best, "place")
    lines = found.select("place", "host", "content", "has_article", F.posexplode("hashes").alias("at", "line"), "shared")
    lines = written(lines.where(F.array_contains("shared", F.col("at"))).drop("shared"))
    # Each row is of another content of the host; a line that begins and ends an article counts once.
    pages = F.count_distinct("content").alias("n_pages")
    frame = (
        lines.where("has_article")
        .groupBy("line", "host")
        .agg(pages)
        .groupBy("line")
        .agg(F.count("*").alias("n_hosts"), F.min("host").alias("host"), F.min("n_pages").alias("n_pages"))
        .where((F.col("n_hosts") == 1) & (F.col("n_pages") >= LEAST_PAGES))
    )
    certain = lines.where("has_article").join(frame.select("host", "line"), ["host", "line"]).select("host", "content", "at")
    deleted = certain.union(lines.where("NOT has_article").select("host", "content", "at"))
    return deleted.groupBy("host", "content").agg(F.array_agg("at").alias("shared"))


def extract_text(pages: DataFrame, pages_per_part: int = 2000) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    The whole html is read. References are decoded, white space in a block becomes one space, blocks
    are joined by one space. A null or empty html has the text ''. Equal pages of a host are compared
    as one, and near copies are passed over; a page of a host that has nothing but near copies of it
    is compared with none, and so is a url without a host, or null. Repeated rows give equal texts,
    and columns besides the three are ignored.

    Pages are compared by hashes of their lines; lines are written once, and shuffled only to meet the
    places of the shared ones.
    """
    parsed = written(_parsed(pages))
    deletions = written(_deletions(parsed, pages_per_part))
    columns = ["page_id", "url", "lines", "is_main", "shared"]
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])
    texts = parsed.join(deletions, ["host", "content"], "left").select(*columns).mapInArrow(_keep, schema)
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
