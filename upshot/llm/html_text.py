"""Main text of web pages through wrappers inferred for each host.

A page is read as a stream of blocks, each in a slot named by the open
elements around it. Runs of the same slots collapse to repeated groups. Pages
of a host are told apart by template: the kind of their main region (an
article, a main element, or the element that holds most text). The streams of
one template are aligned one after the other into a union-free regular
expression: what both have stays, a slot repeated in one of them becomes a
repeated group, what only one of them has becomes optional, and the text in
every slot is left open. Every page is matched against the expression of its
template, and each place of the expression is judged by the text that all pages
have there: the places inside the main region, without boilerplate, are the
text.

Only distinct streams are aligned, in as many levels of salted parts as the
distinct streams of a template need. Pages meet their template's wrapper in a
join that the optimizer may broadcast by size; html itself is never grouped.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare
from upshot.llm.url_filter import host_of

BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol
option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text.
OUT_TAGS = frozenset("""aside button dialog fieldset footer form head label legend menu nav option select title""".split())
#: Words in class, id or role of elements that never hold article text.
OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
comments complementary consent contentinfo cookie cookies disqus footer gdpr login masthead menu modal nav navbar
navigation newsletter notice notices notification pager pagination paywall popup promo promoted promotion recommended
related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar
widget widgets""".split())
ARTICLE_WORDS = frozenset("articlebody article-body entry-content post-content main".split())
_SELF_CLOSE = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
               "th": {"td", "th", "tr"}, "option": {"option"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(script|style|textarea)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^\"'>])*+(?<=/)>"
    r"|<(noscript|template|svg|iframe|object|math|canvas|audio|video)(?=[\s/>])[^>]*+>.*?</\2\s*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+|[^>]*+)>", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Streams that one task aligns at a time (about).
FOLD = 32


def _signature(tag: str, attributes: str) -> str:
    words = {w for m in _ATTR.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").lower().split()}
    return ".".join([tag, *sorted(w for w in words if not any(ch.isdigit() or ch in "./# " for ch in w))])


def page_blocks(page: str) -> Iterable[tuple[str, str, int]]:
    """(slot, text, characters inside links) of every block with text, in page order."""
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        found = ("/".join(s for _, s in stack), text, linked) if text else None
        parts.clear()
        linked = 0
        return found

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked += len(text)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[4] is None:
            continue
        tag = m[4].lower()
        if tag == "a":
            in_link = 0 if m[3] else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            if (found := flush()) is not None:
                yield found
            in_link = 0
            if m[3]:
                names = [t for t, _ in stack]
                if tag in names:
                    del stack[len(names) - 1 - names[::-1].index(tag):]
            else:
                while stack and tag in _SELF_CLOSE.get(stack[-1][0], ()):
                    stack.pop()
                if tag not in VOID:
                    stack.append((tag, _signature(tag, m[5] or "")))
    if at < len(page):
        add(page[at:])
    if (found := flush()) is not None:
        yield found


def runs(slots: list[str]) -> list[tuple[tuple[str, ...], int]]:
    """A stream as (item, blocks): items ("", slot), or ("+", slots...) for a unit of up to four slots that repeats."""
    out: list[tuple[tuple[str, ...], int]] = []
    i = 0
    while i < len(slots):
        for u in (1, 2, 3, 4):
            unit, k = slots[i:i + u], 1
            while len(unit) == u and slots[i + k * u:i + (k + 1) * u] == unit:
                k += 1
            if k > 1:
                out.append((("+", *unit), k * u))
                i += k * u
                break
        else:
            out.append((("", slots[i]), 1))
            i += 1
    return out


def collapse(slots: list[str]) -> list[tuple[str, ...]]:
    return [item for item, _ in runs(slots)]


def match(items: list[tuple[str, ...]], wrapper: list[tuple[str, ...]]) -> list[int]:
    """The place in the wrapper of each item of a stream, -1 for items that it does not have there."""
    n, m = len(items), len(wrapper)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        here, below, own = best[i], best[i + 1], items[i][1:]
        for j in range(m - 1, -1, -1):
            here[j] = below[j + 1] + 1 if own == wrapper[j][1:] else max(below[j], here[j + 1])
    out, i, j = [-1] * n, 0, 0
    while i < n and j < m:
        if items[i][1:] == wrapper[j][1:]:
            out[i] = j
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def places(slots: list[str], wrapper: list[tuple[str, ...]]) -> list[tuple[int, int]]:
    """(item of the wrapper, slot in its unit) of each block of a stream."""
    found = runs(slots)
    at = match([item for item, _ in found], wrapper)
    return [(j, k % (len(item) - 1)) for (item, n), j in zip(found, at, strict=True) for k in range(n)]


def align(a: list[tuple[str, ...]], b: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The union-free expression of two: common items in order, repeated if one repeats, the others optional.

    An item's first element holds its marks: "+" repeated, "?" optional.
    """
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if a[i][1:] == b[j][1:] else max(best[i + 1][j], best[i][j + 1]))
    out: list[tuple[str, ...]] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and a[i][1:] == b[j][1:]:
            out.append(("".join(sorted(set(a[i][0] + b[j][0]))), *a[i][1:]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(("".join(sorted(set(a[i][0] + "?"))), *a[i][1:]))
            i += 1
        else:
            out.append(("".join(sorted(set(b[j][0] + "?"))), *b[j][1:]))
            j += 1
    return out


def _write(items: list[tuple[str, ...]]) -> str:
    return "\n".join("\t".join(x) for x in items)


def _read(text: str) -> list[tuple[str, ...]]:
    return [tuple(line.split("\t")) for line in text.split("\n")] if text else []


def _fold(streams: Iterable[str]) -> str:
    wrapper: list[tuple[str, ...]] | None = None
    for s in streams:
        wrapper = _read(s) if wrapper is None else align(wrapper, _read(s))
    return _write(wrapper or [])


def _sign(part: str) -> str:
    """The kind of main region that an element opens, if any."""
    tag, *words = part.split(".")
    return "article" if tag == "article" else "main" if tag == "main" or any(w in ARTICLE_WORDS for w in words) else ""


def _outside(slot: str, around: bool = True) -> bool:
    """Whether a slot lies in an element that never holds article text.

    Words count as whole names, or if all words of a compound do, and never on
    html and body; without ``around`` not on elements around an article or main
    region either.
    """
    parts = slot.split("/")
    signs = [i for i, p in enumerate(parts) if _sign(p)]
    free = signs[-1] if signs and not around else 0
    for i, part in enumerate(parts):
        tag, *words = part.split(".")
        if tag in OUT_TAGS or tag == "header" and not any(_sign(p) for p in parts[:i]):
            return True
        if i >= free and tag not in ("html", "body") and any(
                w in OUT_WORDS or all(x in OUT_WORDS for x in re.split(r"[-_]", w)) for w in words):
            return True
    return False


def _region(slots: Iterable[str]) -> tuple[str, frozenset[str]]:
    """(kind of the main region, slots in it): article, else main, else none with all slots outside boilerplate.

    Elements around a region are held against it only if another region is left.
    """
    own = set(slots)
    for kind in ("article", "main"):
        for around in (True, False):
            found = frozenset(s for s in own if not _outside(s, around) and any(_sign(p) == kind for p in s.split("/")))
            if found:
                return kind, found
    return "", frozenset(s for s in own if not _outside(s))


def _root(rest: Iterable[tuple[str, int, int]]) -> str:
    """The element whose own blocks hold most text that is not links, of (slot, characters, in links)."""
    text: dict[str, int] = {}
    for s, chars, links in rest:
        parent = s.rpartition("/")[0]
        text[parent] = text.get(parent, 0) + chars - links
    return max(sorted(text), key=lambda p: text[p]) if text else ""


def template(slots: Iterable[tuple[str, int, int]]) -> str:
    """What tells a page's template: its kind of main region, or "/" and its root without any."""
    slots = list(slots)
    kind, own = _region(s for s, _, _ in slots)
    return kind or "/" + _root(x for x in slots if x[0] in own)


def main_places(sums: dict[tuple[int, int], tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The places of a wrapper that hold the article; ``sums``: place -> (slot, characters, characters in links).

    Places in an article or main element if there is one with text, else those
    inside the element whose own blocks hold most text, without places that are
    mostly links.
    """
    kind, own = _region(s for s, _, _ in sums.values())
    rest = {p: v for p, v in sums.items() if v[0] in own}
    if kind:
        return sorted(rest)
    root = _root(rest.values())
    return sorted(p for p, (s, chars, links) in rest.items() if (s == root or s.startswith(root + "/") or not root)
                  and 2 * links <= chars)


def _streams(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, template, stream, n, chars, links) of every distinct stream; the sums are of its blocks in order, collapsed."""

    @F.arrow_udf("struct<stream:string,template:string,sums:array<struct<chars:bigint,links:bigint>>>")
    def read(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            blocks = list(page_blocks(t.as_py() or ""))
            sums, k = [], 0
            for item, n in runs([s for s, _, _ in blocks]):
                u = len(item) - 1
                for j in range(u):
                    mine = blocks[k + j:k + n:u]
                    sums.append({"chars": sum(len(x) for _, x, _ in mine), "links": sum(x for _, _, x in mine)})
                k += n
            out.append({"stream": _write(collapse([s for s, _, _ in blocks])),
                        "template": template((s, len(x), y) for s, x, y in blocks), "sums": sums})
        return pa.array(out, pa.struct([("stream", pa.string()), ("template", pa.string()), ("sums", pa.list_(pa.struct(
            [("chars", pa.int64()), ("links", pa.int64())])))]))

    seen = pages.select(host_of(F.col(url_col)).alias("host"), read(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("r"))
    each = seen.select("host", "r.template", "r.stream", F.posexplode_outer("r.sums").alias("k", "x"))
    each = each.groupBy("host", "template", "stream", "k").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x.chars").alias("chars"), F.sum("x.links").alias("links"))
    return cut(each.groupBy("host", "template", "stream").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("k", "chars", "links"))).alias("sums")), "streams")


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, template, wrapper, places): each template's expression, one item a line, and its main places.

    Null urls are one host, ''.
    """
    prepare(pages.sparkSession)
    streams = _streams(pages, url_col, html_col)
    parts = streams.groupBy("host", "template").agg(F.count(F.lit(1)).alias("parts"))
    largest = parts.agg(F.max("parts")).first()[0] or 0
    level = (streams.join(parts, ["host", "template"]).select(
        "host", "template", "stream", "n", "parts", F.abs(F.xxhash64("stream") % F.lit(2**31)).alias("salt")))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "stream"], ascending=[False, True])
        one = pdf.iloc[:1][["host", "template"]].copy()
        return one.assign(stream=[_fold(pdf.stream)], n=[int(pdf.n.sum())], parts=[int(pdf.parts.iloc[0])], salt=[int(pdf.salt.iloc[0])])

    while True:
        largest = -(-largest // FOLD)
        level = level.withColumn("parts", F.ceil(F.col("parts") / FOLD)).withColumn("salt", F.col("salt") % F.col("parts"))
        level = level.groupBy("host", "template", "salt").applyInPandas(
            fold, "host string, template string, stream string, n long, parts long, salt long")
        if largest <= 1:
            break
    aligned = level.select("host", "template", F.col("stream").alias("wrapper"))

    @F.arrow_udf("array<struct<item:int,unit:int,slot:string,chars:bigint,links:bigint>>")
    def sums_of(lines: pa.Array, wrapper: pa.Array, sums: pa.Array) -> pa.Array:
        out = []
        for t, w, v in zip(lines, wrapper, sums, strict=True):
            items, v = _read(t.as_py()), v.as_py()
            where = [(j, k, slot) for item, j in zip(items, match(items, _read(w.as_py())), strict=True)
                     for k, slot in enumerate(item[1:])]
            out.append([{"item": j, "unit": k, "slot": slot, "chars": x["chars"], "links": x["links"]}
                        for (j, k, slot), x in zip(where, v, strict=False)])
        return pa.array(out, pa.list_(pa.struct([("item", pa.int32()), ("unit", pa.int32()), ("slot", pa.string()),
                                                 ("chars", pa.int64()), ("links", pa.int64())])))

    aligned = cut(aligned, "expressions")
    sums = (streams.join(aligned, ["host", "template"]).select("host", "template", F.explode(sums_of("stream", "wrapper", "sums")).alias("s"))
            .where("s.item >= 0").groupBy("host", "template", "s.item", "s.unit", "s.slot")
            .agg(F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"))
            .groupBy("host", "template").agg(F.collect_list(F.struct("item", "unit", "slot", "chars", "links")).alias("sums")))

    @F.arrow_udf("array<struct<item:int,unit:int>>")
    def choose(lists: pa.Array) -> pa.Array:
        return pa.array([[{"item": i, "unit": k} for i, k in main_places(
            {(x["item"], x["unit"]): (x["slot"], x["chars"], x["links"]) for x in v.as_py() or ()})] for v in lists],
            pa.list_(pa.struct([("item", pa.int32()), ("unit", pa.int32())])))

    return cut(aligned.join(sums, ["host", "template"], "left")
               .select("host", "template", "wrapper", choose(F.col("sums")).alias("places")), "wrappers")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "__text") -> DataFrame:
    """``pages`` with the main text as one column more.

    Blocks at the main places of their template's wrapper in page order, joined
    by one line feed; character references decoded, white space inside a block
    one space. Null and empty html, and pages without main places, have an empty
    text. Repeated rows and extra columns stay.
    """
    found = wrappers(pages, url_col, html_col).groupBy(F.col("host").alias("__h")).agg(
        F.collect_list(F.struct("template", "wrapper", "places")).alias("__wrappers"))

    @F.arrow_udf("string")
    def text_of(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out, known, at = [], {}, {}
        coded = lists.dictionary_encode()
        for t, c in zip(texts, coded.indices.to_pylist(), strict=True):
            if c is not None and c not in known:     # one reading a host and batch
                known[c] = {w["template"]: (_read(w["wrapper"]), {(p["item"], p["unit"]) for p in w["places"] or ()})
                            for w in json.loads(coded.dictionary[c].as_py())}
            blocks = list(page_blocks(t.as_py() or ""))
            own = template((s, len(x), y) for s, x, y in blocks)
            wrapper, main = known.get(c, {}).get(own, ([], set()))
            slots = tuple(s for s, _, _ in blocks)
            if (c, own, slots) not in at:
                at[c, own, slots] = places(list(slots), wrapper)
            out.append("\n".join(x for (_, x, _), p in zip(blocks, at[c, own, slots], strict=True) if p in main))
        return pa.array(out, pa.string())

    rows = pages.withColumn("__host", host_of(F.col(url_col)))
    return (rows.join(found, F.col("__host") == F.col("__h"), "left")
            .withColumn(name, text_of(F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.to_json("__wrappers")))
            .drop("__host", "__h", "__wrappers"))
