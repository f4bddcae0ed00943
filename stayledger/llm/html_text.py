"""Main text of web pages: page structure, and repeats within a host.

A page with an article element says itself what its main text is: the blocks inside, without
menus, footers, forms, adverts and comments. For pages without one, it is all blocks that are not
marked as such. The words of all blocks of all pages, those outside of articles too, stand in a
stream for each page. Streams of one host are searched for long substrings that recur on distinct
pages, as neighbours in a suffix array have them in common: it is enough to sort suffixes by their
first ``GRAM`` words, so equal beginnings are grouped by hash and host. Words covered by such
substrings are boilerplate, on pages that name their main text and on those that do not, and runs of
words that are not stay; only paragraphs and headings of a named article stay, as articles may share passages.

Copies of an article are no distinct pages. Pages count as copies of each other if hardly any
words are in blocks of their own and the block that tells most about them is the same.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import pieces, store

#: Words that a repeated substring has at least; blocks shorter than this are compared whole.
GRAM = 6
#: Distinct pages of a host that boilerplate is on at least, however many pages the host has.
PAGES = 3
#: Words of a repeated run that goes from the middle of a block; shorter ones go as whole blocks only.
LONG = 12
#: A page is no copy of others if this share of its words is in blocks that no other page has.
OWN = 0.2

#: Element names of HTML, and words that sites use for parts beside the article.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
_SKIP = frozenset(
    "nav footer aside form script style head noscript template iframe button select textarea dialog menu svg "
    "canvas object audio video datalist option fieldset title math".split())
_RAW = "script|style|textarea|title|iframe|noscript|template|xmp|noembed|noframes"
_BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|"
    r"promotion|sidebar|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|newsletter|subscribe|"
    r"signup|share|sharing|social|comment|comments|commentlist|disqus|respond|reply|replies|related|"
    r"recommended|breadcrumb|breadcrumbs|menu|nav|navbar|navigation|footer|pagination|pager|widget|toolbar|"
    r"skip|paywall|login)(?:$|[\s_-])", re.I)
#: Class words that say what a page is not laid out with, or has beside its text.
_LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:with|without|no|non|not|has|have)[_-]\S*", re.I)
#: Whole class names of adverts, comments and teasers: an element of such a name is no article of the page.
_APART = re.compile(
    r"(?:^|\s)(?:div-)?(?:ads?|advert|adverts|advertisement|comment|comments|reply|replies|respond|disqus|related|"
    r"recommended|teaser)(?:[_-](?:body|box|card|content|entry|item|list|post|\d+))?(?:$|\s)", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|</?[a-z][^>]*(?:>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Elements of running text: in an article they are its own, whatever other pages share.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())


def _kind(name: str, rest: str, inside: bool) -> str:
    """``main``, ``beside``, ``named`` (beside by a class or id only) or nothing, for what an element holds."""
    if name in _SKIP or name == "header" and not inside:
        return "beside"
    found = {a.lower(): (b or c or d) for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}
    role = found.get("role", "").lower()
    if (role in _ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)):
        return "beside"
    if name == "main" or role == "main" or found.get("itemprop", "").lower() == "articlebody":
        return "main"
    marks = [_LAYOUT.sub("", x) for x in (found.get("class", ""), found.get("id", "")) if x]
    if name not in ("html", "body") and any(_APART.search(x) for x in marks):
        return "beside"
    if name == "article":
        return "main"
    return "named" if name not in ("html", "body") and any(_BESIDE.search(x) for x in marks) else ""


#: What text counts as below an element of some kind: outside and inside of the article, below a
#: class or id that stands for parts beside it (``marked`` inside of the article), in an article
#: there, and left out.
_STEPS = {
    "outer": {"main": "inner", "beside": "left", "named": "aside"},
    "inner": {"beside": "left", "named": "marked"},
    "marked": {"beside": "left"},
    "aside": {"main": "within", "beside": "left"},
    "within": {"beside": "left", "named": "left"},
    "left": {}}


def _read(page: str) -> tuple[bool, list[tuple[str, bool]], list[str]]:
    """Whether the page names its main text; the blocks of that, or else of all that is not marked
    as standing beside it, each with whether repeats may remove it; the other blocks."""
    stack: list[tuple[str, str]] = []
    state, tag, named, held, found = "outer", "", False, [], []

    def done() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text and state != "left":
            found.append((state, text, state in ("outer", "aside") or tag not in _PROSE))

    at = 0
    for token in _TOKEN.finditer(page):
        if state != "left" and token.start() > at:
            held.append(page[at:token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name not in _INLINE and state != "left":
            done()
        elif name == "br" and state != "left":
            held.append(" ")
        if token["end"]:
            if any(x == name for x, _ in stack):
                while stack[-1][0] != name:
                    stack.pop()
                before = stack.pop()[1]
                if before != state:
                    done()
                state = before
            if name not in _INLINE:
                tag = next((x for x, _ in reversed(stack) if x not in _INLINE), "")
        elif name not in _VOID:
            kind = _kind(name, token["rest"], state in ("inner", "within", "marked"))
            after = _STEPS[state].get(kind, state)
            if after != state:
                done()
            if name not in ("b", "i", "em", "p", "li") or kind:  # often left open; they change nothing
                stack.append((name, state))
                state = after
            named = named or state == "inner"
            if name not in _INLINE:
                tag = name
    held.append(page[at:])
    done()
    # a class or id never hides the text of a page: what stands below one counts if it outweighs the rest
    mass = {x: sum(len(text) for of, text, _ in found if of == x) for x in _STEPS}
    if mass["within"] > mass["outer"] and not mass["inner"]:
        named, kept = True, {"within"}
    elif named:
        kept = {"inner", "marked"} if mass["marked"] > mass["inner"] else {"inner"}
    else:
        kept = {"outer", "aside"} if mass["aside"] > mass["outer"] else {"outer"}
    return named, [(text, free) for of, text, free in found if of in kept], [
        text for of, text, _ in found if named and of == "outer"]


def blocks(page: str) -> tuple[bool, list[str]]:
    """Whether the page names its main text, and the blocks of that or else of all that is not
    marked as standing beside it."""
    named, found, _ = _read(page)
    return named, [x for x, _ in found]


def _parse(pages: DataFrame) -> DataFrame:
    """Columns of ``pages`` (row, page_id, url, html) with the parts of ``html`` in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 500):
                found = [_read(x) for x in batch["html"].to_pylist()]
                yield pa.record_batch({
                    "row": batch["row"], "page_id": batch["page_id"], "url": batch["url"],
                    "named": pa.array([n for n, _, _ in found], pa.bool_()),
                    "blocks": pa.array([[x for x, _ in b] for _, b, _ in found], pa.list_(pa.string())),
                    "open": pa.array([[x for _, x in b] for _, b, _ in found], pa.list_(pa.bool_())),
                    "others": pa.array([o for _, _, o in found], pa.list_(pa.string()))})

    return pages.mapInArrow(run, "row long, page_id long, url string, named boolean, blocks array<string>, "
                                 "open array<boolean>, others array<string>")


def _uncovered(words: list[str], at: list[int]) -> list[str]:
    """The words of a block outside of the runs that the repeated substrings at ``at`` cover
    together; runs under ``LONG`` words count only if they are the whole block."""
    out, low, high = [], 0, 0
    for i in [*sorted(at), len(words) + GRAM]:
        if i > high:  # the run low..high ends here
            if high - low < LONG and high - low < len(words):
                out += words[low:high]
            out += words[high:i]
            low = i
        high = max(high, min(i + GRAM, len(words)))
    return out


def _articles(pages: DataFrame) -> DataFrame:
    """(row, article): what each page counts as, the same for copies of an article."""
    parts = pages.select("row", "host", "copy", F.explode("body").alias("text")).select(
        "row", "host", "copy", F.xxhash64("text").alias("part"), F.size(F.split("text", " ")).alias("words"))
    on = parts.select("host", "part", "copy").distinct().groupBy("host", "part").agg(F.count("*").alias("on"))
    weight = F.struct(F.col("words") / F.log2(F.col("on") + 1), -F.col("on"), "part")
    return parts.join(on, ["host", "part"]).groupBy("row", "copy").agg(
        F.sum("words").alias("words"), F.sum(F.when(F.col("on") == 1, F.col("words")).otherwise(0)).alias("own"),
        F.max_by("part", weight).alias("part")).select("row", F.when(
            F.col("own") >= OWN * F.col("words"), F.col("copy")).otherwise(F.col("part")).alias("article"))


def _unrepeated(parsed: DataFrame) -> DataFrame:
    """``blocks`` of all pages without the boilerplate of their host."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]*)", 1)), F.lit(""))
    pages = store(parsed.withColumn("host", F.xxhash64(host)), "pages")
    # where no block may go, repeats decide nothing: such hosts need no counts
    hosts = store(pages.where(F.exists("open", lambda x: x)).select("host").distinct(), "hosts")
    body = F.when(F.col("named") & (F.size("blocks") > 0), F.col("blocks")).otherwise(F.concat("blocks", "others"))
    seen = pages.join(hosts, "host", "left_semi").withColumn("body", body).withColumn("copy", F.xxhash64("body"))
    seen = seen.join(_articles(seen), "row").select("row", "host", "article", "blocks", "open", "others")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        names = ("row", "host", "article", "blocks", "open", "others")
        for whole in batches:
            for batch in pieces(whole, 200):
                rows = []
                for row, host, article, texts, free, others in zip(*(batch[c].to_pylist() for c in names)):
                    seed = host & (1 << 64) - 1
                    for k, (text, may_go) in enumerate(zip(texts + others, free + [False] * len(others))):
                        words = text.split(" ")
                        for i in range(max(1, len(words) - GRAM + 1)):
                            h = digest(" ".join(words[i:i + GRAM]).encode(), seed)
                            rows.append((row, article, k, i, may_go, h - (1 << 64) if h >> 63 else h))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        ["row", "article", "block", "at", "open", "gram"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 500):
                kept = []
                for texts, gone in zip(batch["blocks"].to_pylist(), batch["gone"].to_pylist()):
                    for part in gone:
                        words = texts[part["block"]].split(" ")
                        texts[part["block"]] = " ".join(_uncovered(words, part["at"]))
                    kept.append([x for x in texts if x])
                yield pa.record_batch({"page_id": batch["page_id"], "url": batch["url"],
                                       "blocks": pa.array(kept, pa.list_(pa.string()))})

    suffixes = store(seen.mapInArrow(
        grams, "row long, article long, block int, at int, open boolean, gram long"), "suffixes")
    # grams of different hosts differ by the seed of their hash; copies of an article count once
    shared = suffixes.select("gram", "article").distinct().groupBy("gram").agg(
        F.count("*").alias("n")).where(F.col("n") >= PAGES).select("gram")
    gone = store(suffixes.where("open").join(shared, "gram").groupBy("row", "block").agg(
        F.collect_set("at").alias("at")).groupBy("row").agg(
        F.collect_list(F.struct("block", "at")).alias("gone")), "gone")
    whole = pages.join(gone, "row", "left_anti").select("page_id", "url", "blocks")
    return whole.unionByName(pages.join(gone, "row").select("page_id", "url", "blocks", "gone").mapInArrow(
        cut, "page_id long, url string, blocks array<string>"))


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text): main text of every page, its blocks joined by line feeds.

    Null and empty pages have the text ''; a null url is a host of its own; rows without an id
    keep their null; repeated rows are returned as often, and as boilerplate count once; other
    columns play no part; no rows give no rows.
    """
    page = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.xxhash64(F.col(id).cast("long"), F.col(url), page).alias("row"),
                        F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        page.alias("html"))
    return _unrepeated(_parse(rows)).select("page_id", "url", F.array_join("blocks", "\n").alias("text"))
