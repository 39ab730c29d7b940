"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by their URL path and each is paired with the
neighbour whose path it shares the longest beginning with.  The text lines
(blocks) of the two are aligned by their longest common subsequence, and lines
that both have are the site's, not the page's: they are deleted.  Pages of a host
with equal lines are one page, so the neighbour always differs.  One that has nine
tenths of the page's lines may be a version of it, so the next one is asked, up to
the sixth; if all have, the one that has the fewest decides.  A neighbour that has
all the lines tells nothing; if each one has, the page keeps them.

What markup says outright is believed first: elements that are menus, headers,
footers, sidebars, forms, notices, adverts or comments by their tag, role, class
or id hold no main text, and an ``article`` or ``main`` holds all of it.  A class
or id says so as a whole word or by the last part of one (``site-header``); other
words leave the element to the alignment.  An article inside such an element is
the main text where no article is outside of them.  Plain
prose inside that element (no class or id between) needs more evidence, because
articles of a site also quote the same sentences: it is compared with the prose
of up to six neighbours, of which those that have half of it or more are versions
of the page and say nothing.  The others are witnesses, and a line that most of
them have may be the site's; with fewer than three it must also begin or end the
prose of both.  It is the site's if the host has it on a share of its pages that is
``FAR`` times the other hosts' share (``NEAR`` times, if half of its pages have it):
a sentence that many hosts have is quoted.
Where every neighbour has half of a page's prose, it stays.

Only URLs meet for the order (a range sort, so a host of any size is spread
over many tasks), only 8-byte line hashes meet for the alignment and the counts,
and each page's text moves once.  Reading a page is one pass whatever its markup:
the ends of elements and the articles are found once, and stray or missing tags
cost nothing more.

Defined cases: null html is empty text; a null url, or one without ``://``, is
ordered under an empty host; copies (the same host and lines) are one page for the
pairing, at the first of their paths, and keep one result each; a page alone on its host keeps all unmarked lines; broken or
cut markup is read as far as it goes; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import urlfilter
from .common import written

COPY_SHARE = 0.9
#: A neighbour with so much of an article's prose is a version of it, no witness.
PROSE_SHARE = 0.5
#: A host's line in an article: its share of the host's pages over that of the
#: other hosts' pages, and the same for lines that half of the host's pages have.
FAR, NEAR = 4, 2
#: From so many witnesses on, the place of a line in an article doesn't matter.
MANY = 3
#: Neighbours that are asked: so many places before and after a page.
STEPS = (1, 2, 4)

# HTML's elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea title select canvas audio video".split())
CHROME = frozenset("head nav footer aside form button menu dialog fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
MAIN = frozenset(("article", "main"))
#: A start tag closes an open element of these kinds before it.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
#: Elements whose end tag may be missing: their content is read to see where they end.
LOOSE = frozenset("p li dt dd tr td th option".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CHROME_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising alert alerts banner banners
breadcrumb breadcrumbs byline-share comment comments consent cookie cookies dialog disqus footer footers gdpr login masthead
menu menus modal nav navbar navbars navigation newsletter newsletters notice notices overlay pagination pager popup popups
promo promos promotion promotions recommendation recommendations recommended related replies reply search share sharing
sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription tags toolbar topbar widget widgets""".split())
#: A word that begins so says what the element has beside it, not what it is.
BESIDE = frozenset("has have is no not with without".split())

_TOKEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)"
                    r"|!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z))", re.S)
_ANY = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(?=[\s/>])([^>]*)>")
_MAIN = re.compile(r"<(?:article|main)(?=[\s/>])|role=[\"']?main\b", re.I)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[a-z0-9]+")


def _chrome(tag: str, attrs: str, in_main: bool) -> tuple[bool, bool]:
    """(holds no main text, has a class or id) of a start tag."""
    if tag in CHROME or (tag == "header" and not in_main):
        return True, False
    if "=" not in attrs and "hidden" not in attrs:
        return False, False
    named = False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in CHROME_ROLES):
            return True, named
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True, named
        if name in ("class", "id") and value:
            named = True
            if tag in ("html", "body") or tag in MAIN:
                continue
            for word in value.split():
                parts = _NAMES.findall(word)
                if word in CHROME_NAMES or (parts and parts[0] not in BESIDE and (
                        parts[-1] in CHROME_NAMES or (not in_main and parts[-1] == "header"))):
                    return True, named
    return False, named


class _Ends:
    """Where each element of a page ends, and where its articles begin; made once,
    when first asked."""

    def __init__(self, html: str):
        self.html = html
        self.ends: dict[int, int] | None = None
        self.mains: list[int] = []

    def after(self, at: int) -> int:
        """The end of the element whose start tag ends at ``at``; 0 if it isn't
        closed, or has an article or main inside."""
        if self.ends is None:
            self.ends = {}
            open_: dict[str, list[int]] = {}
            for m in _ANY.finditer(self.html):
                own = open_.setdefault(m[2].lower(), [])
                if not m[1]:
                    if not m[3].endswith("/"):
                        own.append(m.end())
                elif own:
                    self.ends[own.pop()] = m.end()
            self.mains = [m.start() for m in _MAIN.finditer(self.html)]
        end = self.ends.get(at, 0)
        k = bisect_left(self.mains, at)
        return 0 if k < len(self.mains) and self.mains[k] < end else end


@lru_cache(maxsize=64)
def _raw_end(tag: str):
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


def page_lines(html: str) -> list[tuple[str, bool]]:
    """(line, protected) of the blocks that may be main text, in page order."""
    stack: list[tuple[str, bool, int, bool]] = []  # tag, chrome, part, named within main
    open_: Counter[str] = Counter()  # tags of the stack
    blocks: list[int] = []  # places of block elements in it
    ends = _Ends(html)
    out: list[tuple[str, int, bool]] = []
    held: list[str] = []
    chrome = named = False
    main = 0  # in no article or main; in one inside an element that would be dropped; in a main; in an article
    at, n = 0, len(html)

    def flush():
        if held:
            line = " ".join(unescape("".join(held)).split())
            held.clear()
            if line:
                out.append((line, main, main > 0 and not named))

    def text(i, j):
        if i < j and not chrome:
            held.append(html[i:j])

    def push(*element):
        if element[0] in BLOCKS:
            blocks.append(len(stack))
        open_[element[0]] += 1
        stack.append(element)
        return element[1:]

    def cut(k):
        """Close the stack's elements from ``k`` on."""
        for x in stack[k:]:
            open_[x[0]] -= 1
        del stack[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()
        return stack[-1][1:] if stack else (False, 0, False)

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            continue
        if m[1]:  # end tag
            if tag in BLOCKS:
                flush()
            if open_[tag]:
                chrome, main, named = cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = _raw_end(tag).search(html, at)
                at = end.end() if end else n
            held.append(" ") if not chrome else None
            continue
        if tag in BLOCKS:
            flush()
            # an open paragraph ends where a block begins
            if blocks and (stack[blocks[-1]][0] == "p" or stack[blocks[-1]][0] in CLOSES.get(tag, ())):
                chrome, main, named = cut(blocks[-1])
        elif tag == "br":
            if not chrome:
                held.append(" ")
        if tag in VOID or m[3].endswith("/"):
            continue
        drops, has_name = _chrome(tag, m[3], main > 0)
        if drops and tag not in LOOSE and (end := ends.after(at)):
            at = end
            continue
        opens = 0 if drops else 3 if tag == "article" else 2 if tag == "main" or 'role="main"' in m[3] else 0
        if opens and chrome and main < 3:  # the article that a dropped element holds
            chrome, main, named = push(tag, False, 1, False)
        elif tag in BLOCKS or drops:
            chrome, main, named = push(tag, chrome or drops, main if main == 1 else max(main, opens), named or (main > 0 and has_name))
        else:
            push(tag, chrome, main, named)
    flush()
    if any(x[1] for x in out):
        least = 2 if any(x[1] == 3 for x in out) else 1
        out = [x for x in out if x[1] >= least]
    return [(x[0], x[2]) for x in out]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b`` (Hunt and
    Szymanski: over equal pairs only)."""
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a):
        for j in where.get(x, ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def _hashed(lines: list[tuple[str, bool]]) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x, _ in lines]


def _key(host: str, lines: list[tuple[str, bool]]) -> bytes:
    """Equal for the pages of a host whose lines are equal, with their marks (16
    bytes of a cryptographic hash)."""
    text = hashlib.sha256(host.encode("utf-8", "surrogatepass"))
    for line, safe in lines:
        text.update((b"\n+" if safe else b"\n-") + line.encode("utf-8", "surrogatepass"))
    return text.digest()[:16]


def _placed(pages: DataFrame) -> DataFrame:
    return pages.select(urlfilter.host(F.col("url")).alias("host"), urlfilter.path(F.col("url")).alias("path"), "key").distinct()


def neighbours(keys: DataFrame, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """(key, other, n, d): pages (host, path, key) and those so many places
    before and after them on the host, with the length of the common path."""
    ordered = keys.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    rows = written(ordered.withColumn("id", F.monotonically_increasing_id()), "url-order")
    # partition and position from the written ids; one row per partition meets
    part = F.shiftrightunsigned("id", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    base, at = [], 0
    for r in sizes:
        base.append((r["part"], at))
        at += r["n"]
    bases = F.broadcast(keys.sparkSession.createDataFrame(base, "part long, base long"))
    at = F.col("base") + F.col("id").bitwiseAND((1 << 33) - 1)
    placed = written(rows.withColumn("part", part).join(bases, "part").select(at.alias("at"), "host", "path", "key"), "url-places")
    follows = placed.select("at", F.col("host").alias("h"), F.col("path").alias("p"), F.col("key").alias("k"),
                            F.explode(F.array(*[F.lit(x) for x in steps])).alias("d")).withColumn("at", F.col("at") - F.col("d"))
    pairs = placed.join(follows, "at").where("host = h").select("key", "path", F.col("k").alias("other"), F.col("p").alias("near"), "d")
    both = pairs.unionByName(pairs.select(F.col("other").alias("key"), F.col("near").alias("path"), F.col("key").alias("other"),
                                          F.col("path").alias("near"), "d"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = [len(os.path.commonprefix(x)) for x in zip(b.column("path").to_pylist(), b.column("near").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("other"), pa.array(n, pa.int64()), b.column("d")],
                                             names=["key", "other", "n", "d"])
    kind = keys.schema["key"].dataType.simpleString()
    return both.mapInArrow(run, f"key {kind}, other {kind}, n long, d int")


def nearest(pages: DataFrame) -> DataFrame:
    """(key, other): each page and its nearest URL on the host, if any."""
    return neighbours(_placed(pages), (1,)).groupBy("key").agg(F.max_by("other", F.struct("n", "other")).alias("other"))


def site_lines(lines: list[int], safe: list[bool], others: list[tuple[list[int], list[bool]]]) -> tuple[list[int], list[int]]:
    """(positions of the site's lines in a page, those of an article's lines that
    may be the site's); ``others`` are the page's neighbours, nearest first."""
    best: list[int] | None = None
    for other, _ in others if not all(safe) else ():
        got = common_lines(lines, other)
        if len(got) == len(lines):
            continue  # would leave nothing
        if best is None or len(got) < len(best):
            best = got
        if len(got) < COPY_SHARE * len(lines):
            break
    out = [i for i in best or () if not safe[i]]
    at = [i for i, x in enumerate(safe) if x]
    prose = [lines[i] for i in at]
    anywhere: Counter[int] = Counter()
    edges: Counter[int] = Counter()
    witnesses = 0
    for other, marks in others:
        theirs = [x for x, m in zip(other, marks, strict=True) if m]
        got = common_lines(prose, theirs)
        if len(got) >= PROSE_SHARE * len(prose) or not theirs:
            continue  # a version of the page, or no article: says nothing of its prose
        witnesses += 1
        anywhere.update(got)
        same = [x == y for x, y in zip(prose, theirs)]
        tail = [x == y for x, y in zip(prose[::-1], theirs[::-1])]
        first, last = (x.index(False) if False in x else len(x) for x in (same, tail))
        edges.update({*range(first), *range(len(prose) - last, len(prose))})
    often = anywhere if witnesses >= MANY else edges
    return out, sorted(at[i] for i, k in often.items() if 2 * k > witnesses)


def hosts_own(lines: DataFrame, doubtful: DataFrame) -> DataFrame:
    """Those (host, line) of ``doubtful`` that are the host's by their share of its
    pages and of all other hosts' pages.
    ``lines`` has a row (host, lines) per page; counts are summed in tasks first."""
    asked = written(doubtful.select("host", "line").distinct(), "doubtful-lines")
    every = lines.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    per_host = every.join(asked.select("line").distinct(), "line", "left_semi").groupBy("line", "host").agg(F.count(F.lit(1)).alias("here"))
    overall = per_host.groupBy("line").agg(F.sum("here").alias("everywhere"))
    pages = lines.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    total = lines.count()
    got = asked.join(per_host, ["line", "host"]).join(overall, "line").join(pages, "host")
    elsewhere = (F.col("everywhere") - F.col("here")) / F.greatest(F.lit(1), F.lit(total) - F.col("pages"))
    share = F.col("here") / F.col("pages")
    return got.where((share >= FAR * elsewhere) | ((share >= 0.5) & (share >= NEAR * elsewhere))).select("host", "line")


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, shared): positions of a page's lines that are its site's; ``pages``
    has host, path and html, and pages of one key are one page."""
    def hashes(batches):
        import pyarrow as pa

        for b in batches:
            got = [page_lines(x or "") for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(h, g) for h, g in zip(b.column("host").to_pylist(), got, strict=True)], pa.binary()),
                 b.column("host"), b.column("path"), pa.array([_hashed(x) for x in got], pa.list_(pa.int64())),
                 pa.array([[m for _, m in x] for x in got], pa.list_(pa.bool_()))], names=["key", "host", "path", "lines", "safe"])

    def align(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for k, h, x, m, near in zip(*(b.column(c).to_pylist() for c in ("key", "host", "lines", "safe", "near")), strict=True):
                near.sort(key=lambda o: (-o["n"], o["d"], o["other"]))
                sure, maybe = site_lines(x, m, [(o["lines"], o["safe"]) for o in near])
                rows += [(k, h, i, x[i], True) for i in sure] + [(k, h, i, x[i], False) for i in maybe]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.bool_()), strict=True)],
                names=["key", "host", "i", "line", "sure"])

    read = pages.select("host", "path", "html").mapInArrow(
        hashes, "key binary, host string, path string, lines array<long>, safe array<boolean>")
    # copies are one page, at the first of their paths (partial steps: a large group meets as a row a task)
    lines = written(read.groupBy("key").agg(F.min(F.struct("host", "path", "lines", "safe")).alias("x")).select("key", "x.*"), "page-lines")
    pairs = neighbours(lines.select("host", "path", "key"))
    own = lines.select("key", "host", "lines", "safe")
    theirs = pairs.join(own.drop("host").withColumnRenamed("key", "other"), "other")
    near = theirs.groupBy("key").agg(F.collect_list(F.struct("n", "d", "other", "lines", "safe")).alias("near"))
    found = written(near.join(own, "key").select("key", "host", "lines", "safe", "near").mapInArrow(
        align, "key binary, host string, i int, line long, sure boolean"), "shared-lines")
    maybe = found.where("not sure")
    if not maybe.isEmpty():
        kept = maybe.join(written(hosts_own(lines.select("host", "lines"), maybe), "site-lines"), ["host", "line"], "left_semi")
        found = found.where("sure").unionByName(kept.select(*found.columns))
    else:
        found = found.where("sure")
    return found.groupBy("key").agg(F.collect_set("i").alias("shared"))


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"host": urlfilter.host(F.col("url")), "path": urlfilter.path(F.col("url"))})
    shared = written(shared_lines(rows), "deleted-lines")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [page_lines(x or "") for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"),
                 pa.array([_key(h, x) for h, x in zip(b.column("host").to_pylist(), got, strict=True)], pa.binary()),
                 pa.array([[x for x, _ in g] for g in got], pa.list_(pa.string()))],
                names=["page_id", "url", "key", "lines"])

    parsed = rows.select("page_id", "url", "host", "html").mapInArrow(run, "page_id long, url string, key binary, lines array<string>")
    keep = F.filter("lines", lambda _, i: ~F.coalesce(F.array_contains("shared", i), F.lit(False)))
    text = F.array_join(keep, "\n")
    return (parsed.join(shared, "key", "left").select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
