"""Problem 5: page boilerplate mixed with main content.

Site template removal. A page is a tree: elements of its markup where there is markup, and a root whose leaves are the
lines of its text. Each element is hashed with all that stands below it, with numbers and the site's own name masked (so
one template of many sites is one hash); a leaf's hash is its text's, whether it stands in markup or is a line. For a line
there is also a hash of the part that recurs while the rest changes: its head up to a separator, the first entry of a
menu, the opening of a notice. In Spark the different documents of each site and of all sites are counted by hash;
subtrees recurring in a share of a site's documents, or in a share of all documents on several sites, are template and go
with everything below them. A container most of whose leaves are template goes too, which takes along its changing parts
(links, trails). Where there is no markup, the runs of titles below a template caption are such parts.

Counting is by sums with map-side combine. Verdicts are broadcast if they are few (SMALL_ROWS), else joined by (site,
hash), each split by document, so that a line of a third of all documents is many tasks' work.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.joins import salted
from webloom.llm.common import documents, fold, fold_line, map_rows, table
from webloom.llm.mojibake import invert
from webloom.session import SMALL_ROWS, cut

SITE_DOCUMENTS, SITE_SHARE = 3, 0.03
GLOBAL_SHARE, HEAD_GLOBAL_SHARE, MENU_GLOBAL_SHARE, GLOBAL_SITES = 0.002, 0.01, 0.0005, 4
LONG_WORDS, LONG_DOCUMENTS, OPENING = 20, 8, 6

TITLE, PROSE, BYLINE, TIMED, CAPTION, LONG, LETTERS, SOLID = (1 << i for i in range(8))

#: Words that open a byline, folded.
BYLINE_HEADS = ("γραφει", "γραφουν", "κειμενο", "κειμενα", "συντακτησ", "συντακτρια", "απο τον/την", "του συνεργατη μασ", "τησ συνεργατιδασ μασ", "επιμελεια", "ρεπορταζ", "by ", "written by", "author", "von ", "par ", "υπευθυνοσ επικοινωνιασ")
_BYLINE = re.compile("^(?:" + "|".join(map(re.escape, BYLINE_HEADS)) + ")")
_SEPARATOR = re.compile(r" ?[:>»|/·–—-] ")
_MENU = re.compile(r"\s+[|/·»>-]\s+|\s{2,}|\t")
_NAMED = re.compile(r"[^\W\d_]|#")
_DIGITS = re.compile(r"\d+")
_LATIN_LETTER = re.compile("[a-z]")
_LATIN = re.compile(r"[a-z0]*[a-z]{4}[a-z0]*")
_GREEK = re.compile("[α-ω]")
_SENTENCE = re.compile(r"[.!?;…][\s»\"')]|[.!?;…»]$")
_TIME = re.compile(r" \d{1,2}[:.]\d\d$")
_LATIN1 = re.compile("[\xc0-\xff]")
_HIGH_PAIR = re.compile("[ÎÏÃÂΞΟâ][^\\sa-zA-Zα-ωΑ-Ω]|[\x80-\x9f]")
#: A character that every line has that can be repaired.
_ODD = re.compile("[\x80-\x9f\xc0-\xffâΞΟЬЭЮЯ]")
_CYRILLIC_ODD = re.compile("[а-я][ЬЭЮЯ]|[ЬЭЮЯ][а-я]")


def quick_repair(line: str) -> str:
    """The line with a wrong decoding undone where its structure alone shows it; for comparing lines only."""
    if not _ODD.search(line):
        return line
    for _ in range(2):
        if not _HIGH_PAIR.search(line):
            break
        read_as = "cp1253" if line.count("Ξ") + line.count("Ο") > line.count("Î") + line.count("Ã") else "cp1252"
        fixed = invert(line, read_as, "utf-8")
        if not fixed or len(fixed) > 0.8 * len(line):
            break
        line = fixed
    if len(_LATIN1.findall(line)) * 2 > len(line.replace(" ", "")):
        line = invert(line, "cp1252", "cp1253") or line
    elif _CYRILLIC_ODD.search(line):
        line = invert(line, "cp1251", "cp1253") or line
    return line


def normal(line: str, site: str) -> str:
    """A line as a template sees it: folded, numbers, the site's name and foreign names masked."""
    f = _DIGITS.sub("0", fold_line(line))
    if len(site) > 3:
        f = f.replace(site, "#")
    if _LATIN_LETTER.search(f) and _GREEK.search(f):
        f = _LATIN.sub("#", f)
    return f


def head(line: str, f: str, s: int) -> int | None:
    """Hash of the part of a line that recurs while the rest changes: the first entry of a menu, what stands before the
    first separator, or the opening words of a notice of one or two sentences."""
    shown = line.strip()
    # Without these signs, and with single spaces only, there is no menu.
    parts = _MENU.split(shown) if any(map(shown.__contains__, "|/·»>\t-")) or shown.count(" ") != f.count(" ") else ()
    if len(parts) >= 4 and all(x and x.count(" ") <= 2 for x in parts):
        return _hash("m", fold(parts[0])) | 1
    m = _SEPARATOR.search(f)
    if m and m.start() < 40 and m.end() < len(f) and _NAMED.search(f[: m.start()]):
        return _hash("h", f[: m.end()]) & ~1
    if s & PROSE and not s & LONG:
        words = f.split(" ", OPENING)
        if len(words) > OPENING:
            return _hash("o", " ".join(words[:OPENING])) & ~1
    return None


def shape(line: str, f: str) -> int:
    n = f.count(" ") + 1
    ends = len(_SENTENCE.findall(line.rstrip()))
    last = f[-1:]
    out = 0
    if _NAMED.search(f):
        out |= LETTERS
    if _TIME.search(line.rstrip()):
        out |= TIMED
    if 4 <= n <= 18 and (f[0].isalpha() or f[0] in "«\"(") and last not in ".!;…»" and ends <= 1 and "|" not in f and ";" not in f and "\t" not in line:
        out |= TITLE
    if n >= 6 and last in ".!?;…»\"" and not f.endswith(" τεμ."):
        out |= PROSE
    if _BYLINE.match(f) and n <= 9:
        out |= BYLINE
    if n <= 3 and ends == 0:
        out |= CAPTION
    if n >= LONG_WORDS:
        out |= LONG
    return out


def _hash(kind: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(kind + text) - (1 << 63)


_TOKEN = re.compile(r"<!--.*?-->|<(script|style|head|title)\b.*?</\1\s*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^<>]*)>|([^<]+)", re.S | re.I)
_CONTAINERS = frozenset("nav aside footer header div section ul ol article main form body html".split())
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td tr th a span pre blockquote figcaption button label dt dd".split())
#: Elements that hold a page's own content, so that they never go as a whole, even if the same page stands at several addresses.
_CONTENT = frozenset(("", "html", "body", "main", "article"))


class Element:
    """A container: its parent's number (-1 for the root), opening tag, and its leaves and containers in order."""

    def __init__(self, parent: int, tag: str, opening: str) -> None:
        self.parent, self.tag, self.opening = parent, tag, opening
        self.parts: list[tuple[str, bool] | int] = []

    @property
    def leaves(self) -> list[tuple[str, bool]]:
        """Own leaves: text and whether it is a heading or paragraph."""
        return [x for x in self.parts if not isinstance(x, int)]


def tree(html: str) -> list[Element]:
    """The containers of a page, parents before children, the root first. Unclosed and stray tags are forgiven."""
    import html as entities

    nodes = [Element(-1, "", "")]
    stack = [0]
    text: list[str] = []
    kind = ""

    def leaf() -> None:
        s = " ".join(entities.unescape(entities.unescape("".join(text))).split())
        text.clear()
        if s:
            nodes[stack[-1]].parts.append((s, kind in ("p", "h1", "h2")))

    for m in _TOKEN.finditer(html):
        tag = (m[3] or "").lower()
        if m[5]:
            text.append(m[5])
        elif tag in _CONTAINERS:
            leaf()
            kind = ""
            if not m[2]:
                nodes[stack[-1]].parts.append(len(nodes))
                nodes.append(Element(stack[-1], tag, f"{tag} {' '.join(m[4].split())}".strip()))
                stack.append(len(nodes) - 1)
            elif any(nodes[k].tag == tag for k in stack):
                while nodes[stack.pop()].tag != tag:
                    pass
        elif tag in _LEAVES or tag == "br":
            leaf()
            if tag != "br":
                kind = "" if m[2] else tag
    leaf()
    return nodes


def subtree_hashes(nodes: list[Element], keys: Callable[[str], str]) -> list[int]:
    """A hash of each container with all its descendants, from the last to the root; odd, as menus' are."""
    out = [0] * len(nodes)
    for k in range(len(nodes) - 1, -1, -1):
        n = nodes[k]
        out[k] = _hash("s", "\n".join([n.opening, *(str(out[x]) if isinstance(x, int) else keys(x[0]) for x in n.parts)])) | 1
    return out


ELEMENTS = "doc_id bigint, site string, line_no int, full bigint, top bigint, shape int, first boolean, first_top boolean, line_a bigint, line_b bigint"
#: A function of a (repaired) line and the line as it stands that gives two numbers to go with it, 0 and 0 for nothing.
Extra = Callable[[str, str], tuple[int, int]]


def line_elements(docs: DataFrame, extra: Extra | None = None) -> DataFrame:
    """One row a non-blank line: its hashes, shape, whether it is the first of its hash in the document, and what `extra` gives.

    A row with line_no 0 stands for the document itself. A null site is the empty site; null texts give only that row.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], sites: list[str | None], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, domain, text in zip(ids, sites, texts, strict=True):
                domain = domain or ""
                site = domain.split(".")[0]
                yield i, domain, 0, None, None, 0, False, False, 0, 0
                seen: set[int] = set()
                for k, raw in enumerate((text or "").split("\n"), 1):
                    if not raw or raw.isspace():
                        continue
                    line = quick_repair(raw)
                    n = normal(line, site)
                    a, b = extra(line, raw) if extra else (0, 0)
                    if not n:
                        if a or b:
                            yield i, domain, k, None, None, 0, False, False, a, b
                        continue
                    s = shape(line, n)
                    full, top = _hash("f", n), head(line, n, s)
                    new, new_top = full not in seen, top is not None and top not in seen
                    seen.add(full)
                    if top is not None:
                        seen.add(top)
                    yield i, domain, k, full, top, s, new, new_top, a, b

        return f

    return map_rows(docs, ["doc_id", "url_host_registered_domain", "text"], ELEMENTS, make)


def page_elements(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The markup of documents that have some: line_no = -(number of the container, from 1).

    A row a container, with its subtree's hash as top, no full hash, and shape = 2 * (number of its parent) + (1 if it may
    go as a whole); and a row a leaf, with its hash as full. Leaves are not counted, as the text's lines are.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], sites: list[str | None], htmls: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, domain, html in zip(ids, sites, htmls, strict=True):
                domain = domain or ""
                site = domain.split(".")[0]
                known: dict[str, str] = {}

                def key(text: str, known: dict[str, str] = known, site: str = site) -> str:
                    if text not in known:
                        known[text] = normal(quick_repair(text), site)
                    return known[text]

                nodes = tree(html or "")
                seen: set[int] = set()
                for c, (node, h) in enumerate(zip(nodes, subtree_hashes(nodes, key), strict=True), 1):
                    yield i, domain, -c, None, h, 2 * (node.parent + 1) + (node.tag not in _CONTENT), False, h not in seen, 0, 0
                    seen.add(h)
                    for x, solid in node.leaves:
                        if k := key(x):
                            yield i, domain, -c, _hash("f", k), None, shape(x, k) | (SOLID if solid else 0), False, False, 0, 0

        return f

    keyed = pages.where("url is not null").select("url", "html").join(docs.where("url is not null").select("url", "doc_id", "url_host_registered_domain"), "url")
    return map_rows(keyed, ["doc_id", "url_host_registered_domain", "html"], ELEMENTS, make)


def site_sizes(docs: DataFrame) -> DataFrame:
    """(site, site_n): documents of each site, null as the empty one."""
    return docs.groupBy(F.coalesce("url_host_registered_domain", F.lit("")).alias("site")).agg(F.count(F.lit(1)).alias("site_n"))


def templates(elements: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(site, key, n) of the hashes that recur within their site, and (key, full_wide, top_wide) of those that do over sites.

    A site's size is asked only where its share is more than SITE_DOCUMENTS; the joins are split by hash, so that a site
    with a third of all documents is many tasks' work.
    """
    one = elements.select("site", F.explode(F.array(F.struct(F.col("full").alias("key"), F.col("first").cast("int").alias("n")), F.struct(F.col("top").alias("key"), F.col("first_top").cast("int").alias("n")))).alias("e")).select("site", "e.*")
    counts = one.where("key is not null and n > 0").groupBy("site", "key").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= SITE_DOCUMENTS)
    large = sizes.where(F.col("site_n") * SITE_SHARE > SITE_DOCUMENTS)
    local = salted(often, large, ["site"], "left", "key").where(F.col("n") >= SITE_SHARE * F.coalesce("site_n", F.lit(0))).select("site", "key", "n")
    everywhere = sizes.agg(F.sum("site_n")).first()[0] or 0
    share = counts.groupBy("key").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("sites")).where((F.col("sites") >= GLOBAL_SITES) & (F.col("all_n") >= MENU_GLOBAL_SHARE * everywhere))
    line = F.col("all_n") >= GLOBAL_SHARE * everywhere
    part = F.when(F.col("key").bitwiseAND(1) == 1, F.lit(True)).otherwise(F.col("all_n") >= HEAD_GLOBAL_SHARE * everywhere)
    return cut(local), cut(share.select("key", line.alias("full_wide"), part.alias("top_wide")))


def flags(elements: DataFrame, sizes: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Elements with verdicts: hit (its full hash is template), hit_top (its head or subtree is template).

    At most `most` verdicts are broadcast; beyond that they meet the elements by shuffle joins, split by document.
    """
    local, wide = templates(elements, sizes)
    full = local.select("site", F.col("key").alias("full"), F.col("n").alias("full_n"))
    top = local.select("site", F.col("key").alias("top"), F.lit(True).alias("top_here"))
    wide_full, wide_top = wide.select(F.col("key").alias("full"), "full_wide"), wide.select(F.col("key").alias("top"), "top_wide")
    few = [df.limit(most + 1).count() <= most for df in (local, wide)]

    def met(left: DataFrame, right: DataFrame, keys: list[str], broadcast: bool) -> DataFrame:
        return left.join(F.broadcast(right), keys, "left") if broadcast else salted(left, right, keys, "left", "doc_id")

    e = met(met(elements, full, ["site", "full"], few[0]), top, ["site", "top"], few[0])
    e = met(met(e, wide_full, ["full"], few[1]), wide_top, ["top"], few[1])
    is_long = F.col("shape").bitwiseAND(LONG) != 0
    enough = F.coalesce(F.col("full_n"), F.lit(0)) >= F.when(is_long, LONG_DOCUMENTS).otherwise(SITE_DOCUMENTS)
    return e.select("doc_id", "line_no", "full", "shape", (enough | F.coalesce("full_wide", F.lit(False))).alias("hit"), (F.coalesce("top_here", F.lit(False)) | F.coalesce("top_wide", F.lit(False))).alias("hit_top"), "line_a", "line_b")


Row = tuple[int, int | None, int, bool, bool]


def pruned(rows: list[Row]) -> tuple[set[int], set[int]]:
    """Leaf hashes below subtrees that go, and those of elements that stay with prose, from a page's containers and leaves."""
    parent: dict[int, tuple[int, bool]] = {}
    by: dict[int, list[Row]] = {}
    for r in rows:
        if r[1] is None:
            parent[-r[0]] = (r[2] >> 1, bool(r[2] & 1) and r[4])
        else:
            by.setdefault(-r[0], []).append(r)
    gone: set[int] = set()
    kept: set[int] = set()
    dead: set[int] = set()
    for c in sorted(parent):
        up, recurs = parent[c]
        leaves = by.get(c, [])
        if recurs or up in dead:
            dead.add(c)
            gone.update(x[1] for x in leaves)
            continue
        hits, prose = sum(x[3] for x in leaves), sum(bool(x[2] & PROSE) and not x[3] for x in leaves)
        if 2 * hits > len(leaves) or (hits and not prose):
            gone.update(x[1] for x in leaves if not x[2] & (BYLINE | SOLID))
        elif prose:
            kept.update(x[1] for x in leaves)
    return gone, kept


def decide(rows: list[Row]) -> list[int]:
    """Line numbers of furniture, from (line_no, full, shape, hit, hit_top) of a document's lines and markup."""
    gone, kept = pruned([r for r in rows if r[0] < 0])
    out = []
    below = body = False  # below a caption; after a line of the article
    for k, full, s, hit, hit_top in sorted(r for r in rows if r[0] > 0 and r[1] is not None):
        if not s & LETTERS or s & BYLINE:
            below = below and not s & BYLINE
            continue
        if full in gone and full not in kept:
            furniture = True
        elif hit:
            furniture = True
        elif full in kept:
            furniture = False
        else:
            furniture = hit_top or (bool(s & TITLE) and (bool(s & TIMED) or (below and body)))
        if furniture:
            out.append(k)
            if hit and not s & PROSE:
                below = bool(s & CAPTION) or below
        else:
            body = True
            below = False
    return out


def judged(docs: DataFrame, pages: DataFrame, extra: Extra | None = None) -> DataFrame:
    """(doc_id, rows): all elements of each document with their verdicts, from one pass over its lines and one over its markup."""
    elements = cut(line_elements(docs, extra).unionByName(page_elements(pages, docs)))
    return flags(elements, cut(site_sizes(docs))).groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "full", "shape", "hit", "hit_top", "line_a", "line_b")).alias("rows"))


def found(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, line_no) of lines that belong to a page's furniture."""

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], groups: list[list[dict[str, Any]]]) -> Iterator[tuple[Any, ...]]:
            for i, rows in zip(ids, groups, strict=True):
                for k in decide([(r["line_no"], r["full"], r["shape"], r["hit"], r["hit_top"]) for r in rows]):
                    yield i, k

        return f

    return map_rows(judged(docs, pages), ["doc_id", "rows"], "doc_id bigint, line_no bigint", make)


def body(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Every document without its furniture lines: doc_id, n_removed, text. A null text stays null."""
    gone = found(docs, pages).groupBy("doc_id").agg(F.collect_set(F.col("line_no").cast("int")).alias("gone"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i + 1))
    return docs.select("doc_id", "text").join(gone, "doc_id", "left").select("doc_id", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return found(documents(spark, d), table(spark, d, "pages"))


def p5_body(spark: SparkSession, d: str) -> DataFrame:
    return body(documents(spark, d), table(spark, d, "pages"))
