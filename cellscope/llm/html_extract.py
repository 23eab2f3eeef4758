r"""Operator 6: main text of web pages by nearest-URL page differencing.

A page is read into blocks (the text between block tags, character references decoded,
white space inside a block made one space).  Pages of a host are sorted by URL path and
each is paired with the neighbour whose path agrees longest; the blocks of the two are
aligned by longest common subsequence, and blocks that both have are the site's frame
and deleted.  A neighbour that has more than ``COPY_SHARE`` of the page's text may be a copy and
tells nothing by itself: the other neighbour is taken; if that one has as much, the blocks that
all three have are the frame, unless they are nearly the whole page (``SAME_SHARE``: copies).

Some parts are known from markup alone: scripts, styles, navigation, headers, footers,
forms, and elements whose class, id or role names a menu, advert, notice, sidebar or reader
comments are left out, as are runs of blocks that are nothing but links.  Where a page marks its article
(article element, else main element, outside those), what differencing leaves of the marked blocks is the
text if it is a share of ``MARK_SHARE`` or more of all that is left; otherwise the marks name teasers, and
the blocks around them count as well.

A marked block that the neighbour has too may well be the article's own (a quotation, a licence line, a
sentence that two articles share).  It is deleted only if both neighbours have it at the same place (the
same path of elements and classes, as far from the first or the last marked block) and no page of another
host has it inside its marks.

All pages stand in one order (host, path, query, page id, hash of the html), cut into ranges
of a sampled size, so a hot host is spread over many ranges and one path serves any number of
pages.  A range's first and last page also go to the range before and after, so every
page meets its exact neighbours; inside a range pages stream past three at a time.  Only hashes of blocks travel for that; what
comes back is which blocks of a page to keep.  Texts are read a second time and shuffled once, to
meet their verdict.

Cases: null and empty html, and pages without text, give an empty text; null URLs form
one host without a name; equal paths are ordered by page id; repeated rows are pages
of their own (equal in all columns: with one text); unclosed tags end with the page or with the block that holds them; an empty
table gives no rows; other columns are left aside; pages are read whole.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import math
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import arrow_batches, map_batches, materialize
from cellscope.session import default_parallelism

BUCKET_PAGES = 256          # pages of a range, at least about so many; the cut changes no result
ORDER = ("host", "path", "query", "page_id", "tie")
COPY_SHARE = 0.5            # of a page's text in common with its neighbour: perhaps a copy
SAME_SHARE = 0.9            # of a page's text in common with both: copies
MARK_SHARE = 1 / 3          # of the text left by differencing inside marks: the marks hold the article

# HTML elements by what they do.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
                   "option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select canvas head "
                "xmp noembed noframes".split())
FRAME = frozenset("nav footer aside form menu dialog button".split())
CLOSED_BY_OUTER = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# Words in class or id that name a part outside the article.
FRAME_NAMES = frozenset("""
ad ads advert adverts advertisement advertising adsense banner billboard breadcrumb breadcrumbs comment comments
consent cookie cookies dialog disqus disclaimer footer footnav gdpr header login masthead menu menus modal nav
navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion
recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored
subscribe subscription tags toolbar topbar tracking widget widgets
""".split())

_NOT_ITSELF = frozenset("has with no without hide show is".split())
MENU_BLOCKS = 3             # so many blocks of nothing but links in a row are a menu

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_CLASS = re.compile(r"""\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _is_frame(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is a part outside the article, by its tag or names."""
    if tag in FRAME or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "main") or not attributes:
        return False
    for m in _NAMES.finditer(attributes):
        key, value = m.group(1).lower(), next((g for g in m.groups()[1:] if g is not None), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in FRAME_ROLES:
            return True
        if key in ("class", "id") and any(_names_frame(x, in_article) for x in value.split()):
            return True
    return False


def _names_frame(name: str, in_article: bool) -> bool:
    """Whether one class or id names a part outside the article; ``has-sidebar`` names none."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in _NOT_ITSELF:
        return False
    return any(w in FRAME_NAMES and not (w == "header" and in_article) for w in words)


def _step(path: int, tag: str, attributes: str) -> int:
    """The place below ``path`` that an element with these attributes makes."""
    classes = _CLASS.search(attributes) if attributes else None
    return zlib.crc32(f"{tag} {classes.group(1) if classes else ''}".encode(), path)


def read_blocks(page: str) -> tuple[list[str], list[int], list[int]]:
    """The blocks of a page outside its known frame, where each stands (in an article: 3,
    in the main element: 2, elsewhere: 1, elsewhere and in a run of links: 0), and the place of
    each (a hash of the open elements and their classes)."""
    blocks: list[str] = []
    inside: list[int] = []
    places: list[int] = []
    text: list[str] = []
    open_: list[tuple[str, bool, bool, int]] = []   # tag, frame, article or main, place
    frames = articles = mains = links = 0
    plain = False               # the open block has text outside links

    def close_block():
        nonlocal plain
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if block:
                blocks.append(block)
                inside.append(3 if articles else 2 if mains else 1 if plain else 0)
                places.append(open_[-1][3] if open_ else 0)
        plain = False

    def pop():
        nonlocal frames, articles, mains, links
        tag, frame, article, _ = open_.pop()
        frames -= frame
        articles -= article and tag == "article"
        mains -= article and tag == "main"
        links -= tag == "a"

    at, skip_to = 0, None
    for m in _TAG.finditer(page):
        if skip_to is not None:
            # Inside raw content only its own end tag counts.
            if m.group(1) != "/" or (m.group(2) or "").lower() != skip_to:
                continue
            skip_to, at = None, m.end()
            continue
        if m.start() > at and not frames:
            text.append(page[at:m.start()])
            plain = plain or not links and not page[at:m.start()].isspace()
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if tag == "br":
            text.append(" ")
            continue
        if m.group(1) == "/":
            if tag in BLOCKS:
                close_block()
            starts = [i for i, x in enumerate(open_) if x[0] == tag]
            # An end tag without a start in the same frame closes nothing.
            if starts and not any(x[1] for x in open_[starts[-1] + 1:]):
                while len(open_) > starts[-1]:
                    pop()
            continue
        if tag in RAW:
            if not m.group(3).rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, m.end())
                if end or tag != "head":
                    skip_to = tag
                    if tag in BLOCKS:
                        close_block()
            continue
        if tag in BLOCKS:
            close_block()
            # A new block of its kind, or a block after an open paragraph, ends the open one.
            while open_ and open_[-1][0] in CLOSED_BY_OUTER and not open_[-1][1] and (
                    open_[-1][0] == tag or open_[-1][0] == "p"):
                pop()
        if tag in VOID or m.group(3).rstrip().endswith("/"):
            continue
        frame = _is_frame(tag, m.group(3), articles > 0)
        article = tag in ("article", "main") and not frames and not frame
        open_.append((tag, frame, article, _step(open_[-1][3] if open_ else 0, tag, m.group(3))))
        frames += frame
        articles += article and tag == "article"
        mains += article and tag == "main"
        links += tag == "a"
    if skip_to is None and not frames and at < len(page):
        text.append(re.sub(r"<[^>]*\Z", "", page[at:]))
        plain = True
    close_block()
    # Single blocks of links are text; only several in a row are a menu.
    lo = 0
    while lo < len(inside):
        hi = lo
        while hi < len(inside) and not inside[hi]:
            hi += 1
        if 0 < hi - lo < MENU_BLOCKS:
            inside[lo:hi] = [1] * (hi - lo)
        lo = max(hi, lo + 1)
    return blocks, inside, places


def common_blocks(a: list[str], b: list[str]) -> list[bool]:
    """Which blocks of ``a`` belong to a longest common subsequence with ``b``.

    Equal starts and ends belong to one; blocks that only one side has belong to none."""
    out = [False] * len(a)
    lo, most = 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        out[lo] = True
        lo += 1
    end = 0
    while end < most - lo and a[-1 - end] == b[-1 - end]:
        out[-1 - end] = True
        end += 1
    in_a, in_b = set(a[lo:len(a) - end]), set(b[lo:len(b) - end])
    places = [i for i in range(lo, len(a) - end) if a[i] in in_b]
    inner = _common([a[i] for i in places], [x for x in b[lo:len(b) - end] if x in in_a])
    for i, is_common in zip(places, inner):
        out[i] = is_common
    return out


def _common(a: list[str], b: list[str]) -> list[bool]:
    """Bit-parallel: row i holds, for the first i blocks of a, the places in b where the
    length of the subsequence grows (cleared bits).  Every ``step``-th row is kept and those
    between are made again on the way back, so that memory follows the root of the length."""
    place: dict[str, int] = {}
    for j, x in enumerate(b):
        place[x] = place.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    step = math.isqrt(len(a)) + 1

    def rows_after(row, lo, hi):
        rows = [row]
        for x in a[lo:hi]:
            match = row & place.get(x, 0)
            row = ((row + match) | (row - match)) & every
            rows.append(row)
        return rows

    starts = [every]
    for lo in range(0, len(a), step):
        starts.append(rows_after(starts[-1], lo, lo + step)[-1])
    out, j = [False] * len(a), len(b)
    for lo in range((len(a) - 1) // step * step, -1, -step):
        rows = rows_after(starts[lo // step], lo, lo + step)
        for i in range(len(rows) - 1, 0, -1):
            while j and rows[i] >> (j - 1) & 1:
                j -= 1              # the length doesn't grow here
            if not j:
                return out
            # It grows at j with block i, unless it grew there before.
            if rows[i - 1] >> (j - 1) & 1:
                out[lo + i - 1] = True
                j -= 1
    return out


def _same_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


KEEP, DOUBT, DROP = 0, 1, 2


def block_hash(block: str) -> int:
    return int.from_bytes(hashlib.blake2b(block.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Page:
    """What pages are compared by: ``blocks`` (hashes, or texts), ``sizes``, ``inside``, ``places``."""

    def __init__(self, row: dict):
        self.row = row
        self.blocks, self.sizes, self.inside, self.places = (row[c] for c in ("blocks", "sizes", "inside", "places"))
        self.address = row["path"] + row.get("query", "")

    def marked(self) -> dict[int, tuple]:
        """The marked blocks with what they must have in common with others: text, place, and
        how far they are from the first and the last marked block."""
        at = [i for i, mark in enumerate(self.inside) if mark >= 2]
        return {i: (self.blocks[i], self.places[i], n, len(at) - 1 - n) for n, i in enumerate(at)}

    def judged(self, before: "Page | None", after: "Page | None") -> list[int]:
        """KEEP, DOUBT (to be kept if another host has it) or DROP for every block, told by
        the neighbours."""
        near = [p for p in (before, after) if p is not None]
        near.sort(key=lambda p: -_same_start(self.address, p.address))
        size = sum(self.sizes)
        frame, shared = [False] * len(self.blocks), []
        for other in near:
            shared.append(common_blocks(self.blocks, other.blocks))
            if self._length(shared[-1]) <= COPY_SHARE * size:
                frame = shared[-1]
                break
        else:
            if len(near) == 2:
                both = [x and y for x, y in zip(*shared, strict=True)]
                if self._length(both) <= SAME_SHARE * size:
                    frame = both
        verdict = [DROP if f or not mark else KEEP for f, mark in zip(frame, self.inside, strict=True)]
        mine = self.marked()
        if any(verdict[i] for i in mine):
            sides = [p.marked().values() for p in near] if len(near) == 2 else []
            same = [{(t, place, "first", n) for t, place, n, _ in side} | {(t, place, "last", m) for t, place, _, m in side}
                    for side in sides]
            for i, (t, place, n, m) in mine.items():
                confirmed = bool(same) and all((t, place, "first", n) in s or (t, place, "last", m) in s for s in same)
                verdict[i] = DOUBT if verdict[i] and confirmed else KEEP
        # By mark, the text left at it or at a higher one.
        held = [sum(n for n, i, v in zip(self.sizes, self.inside, verdict, strict=True) if not v and i >= mark)
                for mark in range(4)]
        least = next((m for m in (3, 2) if held[m] and held[m] >= MARK_SHARE * held[1]), 1)
        return [v if i >= least else DROP for v, i in zip(verdict, self.inside, strict=True)]

    def _length(self, which: list[bool]) -> int:
        return sum(n for n, x in zip(self.sizes, which, strict=True) if x)


def _key(host, path, query, page_id, tie) -> tuple:
    """A page's place in the order, as Spark sorts it: null ids first."""
    return host, path, query, page_id is not None, page_id, tie


def _ranges(located: DataFrame) -> list[tuple[tuple, tuple]]:
    """First and last key of every range of the order: a table of at most so many rows as
    there are shuffle partitions."""
    keys = materialize(located.select(*ORDER), "html-keys")
    n = max(1, min(default_parallelism(keys.sparkSession), keys.count() // BUCKET_PAGES))
    got = keys.repartitionByRange(n, *ORDER).groupBy(F.spark_partition_id().alias("range")).agg(
        F.min(F.struct(*ORDER)).alias("first"), F.max(F.struct(*ORDER)).alias("last")).collect()
    return sorted((_key(*r["first"]), _key(*r["last"])) for r in got)


def _places(key: tuple, firsts: list[tuple], lasts: list[tuple]) -> list[tuple[int, bool]]:
    """The ranges that a page goes to, and whether it is only a neighbour there."""
    at = max(0, bisect.bisect_right(firsts, key) - 1)
    out = [(at, False)]
    if at and key == firsts[at] and lasts[at - 1][0] == key[0]:
        out.append((at - 1, True))
    if at + 1 < len(firsts) and key == lasts[at] and firsts[at + 1][0] == key[0]:
        out.append((at + 1, True))
    return out


_FIELDS = ("blocks", "sizes", "inside", "places")


def _read(located: DataFrame, ranges: list[tuple[tuple, tuple]]) -> DataFrame:
    """range, halo, k1, k2, the columns of the order, and hashes, sizes, marks and places of blocks."""
    kind = dict(located.dtypes)["page_id"]
    firsts, lasts = [f for f, _ in ranges], [x for _, x in ranges]
    names = ["k1", "k2", *ORDER]

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "html"):
            read = []
            for page in batch.column("html").to_pylist():
                blocks, inside, places = read_blocks(page or "")
                read.append(([block_hash(b) for b in blocks], [len(b) for b in blocks], inside, places))
            keys = zip(*(batch.column(c).to_pylist() for c in ORDER))
            sent = [(i, at, halo) for i, k in enumerate(keys) for at, halo in _places(_key(*k), firsts, lasts)]
            rows = pa.array([i for i, _, _ in sent], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([at for _, at, _ in sent], pa.int32()), pa.array([h for _, _, h in sent], pa.bool_()),
                 *(batch.column(c).take(rows) for c in names),
                 *(pa.array([read[i][k] for i, _, _ in sent], pa.list_(pa.int64())) for k in range(4))],
                ["range", "halo", *names, *_FIELDS])

    return map_batches(located.select(*names, "html"), run,
                       f"range int, halo boolean, k1 long, k2 long, host string, path string, query string, page_id {kind}, "
                       "tie long, " + ", ".join(f"{c} array<long>" for c in _FIELDS))


def _located(pages: DataFrame) -> DataFrame:
    """page_id, url, html, k1 and k2 (hashes of the row) and what the order needs."""
    url = F.coalesce(F.col("url"), F.lit(""))
    row = [F.col("page_id"), F.col("url"), F.col("html"), F.isnull("page_id"), F.isnull("url"), F.isnull("html")]
    return pages.select("page_id", "url", "html", F.xxhash64(*row).alias("k1"), F.xxhash64(F.lit(7), *row).alias("k2"),
                        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
                        F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""),
                                         r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "").alias("path"),
                        F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1).alias("query"), F.xxhash64("html").alias("tie"))


def _judged(blocks: DataFrame, ranges: int) -> DataFrame:
    """For every page: k1, k2, host, keep (places of the blocks to keep), doubts (places and
    hashes of those that depend on other hosts), marked (hashes of the marked blocks)."""
    dealt = blocks.repartitionById(max(1, ranges), "range").sortWithinPartitions("range", *ORDER)

    def run(batches):
        import pyarrow as pa

        def pages_of():
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    for row in batch.slice(lo, 64).to_pylist():
                        yield Page(row)

        def same_group(a, b):
            return a is not None and b is not None and all(a.row[c] == b.row[c] for c in ("host", "range"))

        def verdicts():
            before, page = None, None
            for after in pages_of():
                if page is not None and not page.row["halo"]:
                    yield page, page.judged(before if same_group(before, page) else None,
                                            after if same_group(page, after) else None)
                before, page = page, after
            if page is not None and not page.row["halo"]:
                yield page, page.judged(before if same_group(before, page) else None, None)

        def out(rows):
            columns = list(zip(*rows, strict=True))
            doubt = pa.list_(pa.struct({"at": pa.int32(), "part": pa.int64()}))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), doubt, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        names = ["k1", "k2", "host", "keep", "doubts", "marked"]
        rows = []
        for page, verdict in verdicts():
            rows.append((page.row["k1"], page.row["k2"], page.row["host"], [i for i, v in enumerate(verdict) if v == KEEP],
                         [{"at": i, "part": page.blocks[i]} for i, v in enumerate(verdict) if v == DOUBT],
                         [page.blocks[i] for i in page.marked()]))
            if len(rows) == 1000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)

    return map_batches(dealt, run, "k1 long, k2 long, host string, keep array<int>, "
                                   "doubts array<struct<at: int, part: long>>, marked array<long>")


def _verdicts(judged: DataFrame) -> DataFrame:
    """k1, k2, keep: the doubts decided by whether two hosts have the block inside their marks."""
    one = judged.dropDuplicates(["k1", "k2"])
    doubts = one.select("k1", "k2", F.explode("doubts").alias("d")).select("k1", "k2", "d.at", "d.part")
    held = judged.select("host", F.explode("marked").alias("part")).join(
        doubts.select("part").distinct(), "part", "left_semi")
    held = held.groupBy("part").agg(F.min("host").alias("a"), F.max("host").alias("b")).where("a <> b").select("part")
    saved = doubts.join(held, "part").groupBy("k1", "k2").agg(F.collect_list("at").alias("saved"))
    saved = one.select("k1", "k2", "keep").join(saved, ["k1", "k2"], "left")
    return saved.select("k1", "k2", F.array_sort(F.concat(
        "keep", F.coalesce("saved", F.array().cast("array<int>")))).alias("keep"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    located = _located(pages)
    ranges = _ranges(located)
    judged = materialize(_judged(_read(located, ranges), len(ranges)), "html-judged")
    verdicts = materialize(_verdicts(judged), "html-verdicts")
    kind = dict(pages.dtypes)["page_id"]

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "html"):
            blocks = [read_blocks(h or "")[0] for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(blocks, pa.list_(pa.string()))],
                                             [*names, "blocks"])

    names = ["k1", "k2", "page_id", "url"]
    read = map_batches(located.select(*names, "html"), run,
                       f"k1 long, k2 long, page_id {kind}, url string, blocks array<string>")
    text = F.array_join(F.transform("keep", lambda i: F.get("blocks", i)), "\n\n")
    rows = read.join(verdicts, ["k1", "k2"]).select("page_id", "url", text.alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
