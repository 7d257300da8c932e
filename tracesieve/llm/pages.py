"""Main text of web pages by equivalence-class template deduction.

Tokens are a page's tags, told apart by their path (each tag with its class, id and role words), and
its texts with their path. The pages of a host give every token an occurrence vector (how
often it stands on each page); it is kept as sums of hashes, which add up over partitions in any
order, so that a hot host is never gathered and repeated pages count as often as they stand. Tokens
with one vector form an equivalence class; classes on enough of the host's pages are valid. Ordered
by their places and nested by their paths they are the template: a tree of tags, with constant
texts. What is left are slots, and each tag's slots are weighed by the characters that vary in
them. The article is in the tag to which one gets from the body by tags that stand once on every
page, as long as one of them holds SHARE of all that varies and the text doesn't stand in the
tag itself (as headings or paragraphs).

Inside it the slots are taken and the template is left: a constant text goes, unless such texts are more than the rest (then
the pages are copies, and theirs is the article). Where a host's articles stand in headings and paragraphs, by SHARE of what varies,
a box (div, section, span and the like) that holds none of these is no part of the article: so comments and adverts go whatever
they are called. Names decide only between what this can't tell apart: an article element goes before what is around it, and
parts named as menus, notices, adverts, forms or reader comments are left out.

Null html: the empty text. Null url: the host "". A host of few pages, or of copies, has no template, and a page
may lack its host's tag: such pages are read by names alone. Repeated rows: a result for each. Empty
tables: no rows. Very long pages are read whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import cut, mix64

#: A class is valid from this share of a host's pages, and this many pages.
SUPPORT, PAGES = 0.5, 3
#: Of what varies on a host's pages, what the article's tag holds at least.
SHARE = 0.6
#: Of all text on a host's pages, what varies at least; below it they are copies of each other and tell no template.
VARIES = 0.2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_NAMES = re.compile(r"""\b(?:(class)|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements that end a block, that have no content, and that are page furniture.
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe li main menu nav ol option p pre section select summary
table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside form menu button select iframe dialog svg object".split())
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer
header masthead menu nav navbar navigation newsletter notice promo promotion related replies share sharing sidebar social sponsor sponsored subscribe
toolbar widget alert popup modal complementary contentinfo search""".split())
CONTENT_WORDS = frozenset("article main content post entry story".split())
# Elements whose names alone say nothing, so that their words count; and prose.
BOXES = frozenset("div section table dl span ins figure details".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())


def _token(name: str, attributes: str) -> str:
    """The tag's name with its class, id and role words; digits of ids are left out."""
    words = [w for m in _NAMES.finditer(attributes) for w in re.split(r"[^a-z0-9]+" if m[1] else r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()) if w]
    return " ".join([name, *sorted(set(words))])


def tokens(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, token) of all markup; kind is open, close or skip."""
    for m in _TOKEN.finditer(page):
        if m[3] is None:
            yield m.start(), m.end(), "skip", (m[1] or "").lower()
        else:
            name = m[3].lower()
            yield m.start(), m.end(), "close" if m[2] else "open", _token(name, m[4]) if not m[2] else name


def _furniture(token: str) -> bool:
    name, *words = token.split(" ")
    return name in FURNITURE or name in BOXES and not FURNITURE_WORDS.isdisjoint(words)


def _container(token: str) -> int:
    """How surely the tag holds the article: 0 for not at all."""
    name, *words = token.split(" ")
    if _furniture(token):
        return 0
    return 3 if name == "article" else 2 if name == "main" or "main" in words else 1 if not CONTENT_WORDS.isdisjoint(words) else 0


def extract(page: str, container: int | None = None, constants: frozenset[int] = frozenset(), prose: bool = False) -> str:
    """The text of the page's content. By the host's template, if it has one: container, the path of the tag that holds the
    article; constants, the tokens of the texts that stand on the host's pages; prose, whether articles stand in headings and paragraphs."""
    parts = list(tokens(page))
    closes = _matching(parts)
    own, _, before = _paths(parts, closes)
    first, end = 0, len(parts)
    if container is not None and container in own:
        first = own.index(container)
        end = closes[first]
    else:
        constants, prose = frozenset(), False
    ranks = [_container(t) if k == "open" else 0 for _, _, k, t in parts]
    # an article element inside of what the template names goes before it, other names only without it
    best = max((r for r in ranks[first:end] if r == 3 or end == len(parts) and not first), default=0)
    boxes = _bare_boxes(parts, closes, first, end) if prose else frozenset()
    kept, dropped = _read(page, parts, closes, first, end, ranks, best, _constant_texts(page, parts, closes, before, constants), boxes)
    if dropped > (1 - SHARE) * (dropped + len(kept)):
        kept, _ = _read(page, parts, closes, first, end, ranks, best, frozenset(), boxes)
    return kept


def _constant_texts(page: str, parts: list[tuple[int, int, str, str]], closes: list[int], before: list[int], constants: frozenset[int]) -> frozenset[int]:
    """The texts, by the part that ends them, whose block has constant texts only: one in a line that varies stays."""
    if not constants:
        return frozenset()
    of_block: dict[int, list[tuple[int, bool]]] = {}
    at, stack = 0, []
    for i, (a, b, kind, token) in enumerate([*parts, (len(page), len(page), "end", "")]):
        text = " ".join(page[at:a].split())
        if text:
            of_block.setdefault(stack[-1][1] if stack else -1, []).append((i, _hash(before[i], f"#{text}") in constants))
        while stack and stack[-1][0] <= i:
            stack.pop()
        name = token.split(" ")[0]
        if kind == "open" and name in BLOCKS and name not in VOID:
            stack.append((closes[i], i))
        at = b
    return frozenset(i for texts in of_block.values() if all(c for _, c in texts) for i, _ in texts)


def _bare_boxes(parts: list[tuple[int, int, str, str]], closes: list[int], first: int, end: int) -> frozenset[int]:
    """The boxes inside a container that neither hold prose nor stand in it."""
    inside, out = -1, []
    held = np.cumsum([0] + [k == "open" and t.split(" ")[0] in PROSE for _, _, k, t in parts])
    for i in range(first + 1, min(end, len(parts))):
        _, _, kind, token = parts[i]
        name = token.split(" ")[0]
        if kind != "open" or i <= inside:
            continue
        if name in PROSE:
            inside = closes[i]
        elif name in BOXES and held[closes[i]] == held[i + 1]:
            out.append(i)
            inside = closes[i]
    return frozenset(out)


def _read(page, parts, closes, first, end, ranks, best, constants, boxes) -> tuple[str, int]:
    """The content's text, and how many characters of constant texts were left out of it."""
    whole = not best
    out, block, dropped = [], [], 0
    depth_end = end if whole else -1  # up to which part the content reaches
    start = first if whole else None
    skip_to = first - 1 if whole and first else -1
    at = parts[first][1] if whole and first else 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(block)).split())
        if text:
            out.append(text)
        block.clear()

    def take(i: int, text: str) -> None:
        nonlocal dropped
        if i in constants:
            dropped += len(" ".join(text.split()))
            block.append(" ")
        else:
            block.append(text)

    for i, (a, b, kind, token) in enumerate(parts):
        if whole and (i <= first and first or i > end):
            continue
        inside = i <= depth_end and start is not None
        if inside and i > skip_to:
            take(i, page[at:a])
        at = b
        name = token.split(" ")[0]
        if kind == "skip":
            continue
        if name in BLOCKS and i > skip_to:
            flush()
        if kind == "open" and i > skip_to:
            if best and first <= i < end and ranks[i] == best and i > depth_end:
                start, depth_end = i, closes[i]
            elif (_furniture(token) and name not in VOID) or i in boxes:
                skip_to = closes[i]
    if depth_end >= len(parts) and len(parts) > skip_to:
        take(len(parts), page[at:])
    flush()
    return " ".join(out), dropped


def _paths(parts: list[tuple[int, int, str, str]], closes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """For each part the path of the tag it opens (0 if it opens none), of the tag around it, and of the
    tag that the text before it stands in (with one more for the text after the last)."""
    own, around, before, stack = [0] * len(parts), [0] * len(parts), [0] * (len(parts) + 1), []
    for i, (_, _, kind, token) in enumerate(parts):
        before[i] = stack[-1][1] if stack else 0
        while stack and stack[-1][0] <= i:
            stack.pop()
        around[i] = stack[-1][1] if stack else 0
        if kind == "open":
            own[i] = _hash(around[i], token)
            if token.split(" ")[0] not in VOID:
                stack.append((closes[i], own[i]))
    before[-1] = stack[-1][1] if stack else 0
    return own, around, before


def _hash(parent: int, token: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent} {token}".encode(), digest_size=8).digest(), "little", signed=True)


def _matching(parts: list[tuple[int, int, str, str]]) -> list[int]:
    """For each opening tag the part that closes it: its own end tag, or else the end tag of the
    nearest open ancestor, or the end of the page."""
    out, open_, count = [len(parts)] * len(parts), [], Counter()
    for i, (_, _, kind, token) in enumerate(parts):
        name = token.split(" ")[0]
        if kind == "open" and name not in VOID:
            open_.append((i, name))
            count[name] += 1
        elif kind == "close" and count[name]:
            while True:
                j, other = open_.pop()
                count[other] -= 1
                out[j] = i
                if other == name:
                    break
    return out


def hosts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, html), nothing null but page_id and url."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))


_KINDS = {"body": 1, **dict.fromkeys(PROSE, 2)}
_TEXT = 9
_COUNTED = "host string, token long, parent long, kind int, one long, two long, pages long, times long, chars long, place double"
_LOW = (1 << 31) - 1


def _found(page: str) -> dict[int, list]:
    """Each token of a page: parent, kind, times, characters of text in it, first place."""
    parts = list(tokens(page))
    closes = _matching(parts)
    own, around, before = _paths(parts, closes)
    out: dict[int, list] = {0: [0, 0, 1, 0, 0]}  # the page itself
    parent = {0: 0}
    at = 0
    for i, (a, b, kind, token) in enumerate([*parts, (len(page), len(page), "end", "")]):
        text = " ".join(page[at:a].split())
        if text:
            inside = before[i]
            x = out.setdefault(_hash(inside, f"#{text}"), [inside, _TEXT, 0, 0, i])
            x[2] += 1
            x[3] += len(text)
            node = inside
            while node:
                out[node][3] += len(text)
                node = parent[node]
        at = b
        if kind == "open":
            x = out.setdefault(own[i], [around[i], _KINDS.get(token.split(" ")[0], 0), 0, 0, i])
            x[2] += 1
            parent[own[i]] = around[i]
    return out


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, html) to _COUNTED, a row for each host and token of a batch. one and two are
    sums of two parts of a hash of page and times."""
    for batch in batches:
        totals: dict[tuple[str, int], list] = {}
        for host, page, text in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html"), strict=True):
            found = _found(text.as_py())
            mixed = mix64(np.array([x[2] for x in found.values()], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(page & 0xFFFFFFFFFFFFFFFF)).tolist()
            for (token, (parent, kind, times, chars, place)), m in zip(found.items(), mixed, strict=True):
                x = totals.setdefault((host, token), [parent, kind, 0, 0, 0, 0, 0, 0.0])
                for k, v in enumerate((m & _LOW, m >> 31 & _LOW, 1, times, chars, place), 2):
                    x[k] += v
        columns = [*zip(*totals, strict=True), *zip(*totals.values(), strict=True)] if totals else [[]] * 10
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in _COUNTED.split(", ")])


def classes(pages: DataFrame, support: float = SUPPORT, least: int = PAGES) -> DataFrame:
    """host, one, two, pages, tokens: the valid equivalence classes, their tokens in the order of
    their places, with parent, kind, whether they stand once on a page, and characters."""
    rows = hosts(pages).select("host", F.xxhash64("page_id", "html").alias("page"), "html").mapInArrow(_occurrences, _COUNTED)
    sums = [F.sum(c).alias(c) for c in ("one", "two", "pages", "times", "chars", "place")]
    each = cut(rows.groupBy("host", "token", "parent", "kind").agg(*sums))
    of_host = each.filter("token = 0").select("host", F.col("pages").alias("of"))
    # what is collected is at most a host's average page, divided by the support
    valid = each.filter((F.col("token") != 0) & (F.col("pages") >= least)).join(of_host, "host").filter(F.col("pages") >= support * F.col("of"))
    token = F.struct((F.col("place") / F.col("pages")).alias("place"), "token", "parent", "kind", (F.col("times") == F.col("pages")).alias("once"), "chars")
    return valid.groupBy("host", "one", "two", "pages").agg(F.array_sort(F.collect_list(token)).alias("tokens"))


def nested(found: list[dict]) -> tuple[int, list[int], bool] | None:
    """Of the template of the tokens found: the path of the article's tag, the constant texts inside of it, and whether what varies
    in it stands in prose; null if there is no such tag."""
    nodes = {t["token"]: t for t in found if t["kind"] != _TEXT}
    varies = {k: t["chars"] for k, t in nodes.items()}
    for t in found:
        node = t["parent"]
        while t["kind"] == _TEXT and node in nodes:  # a constant text
            varies[node] -= t["chars"]
            node = nodes[node]["parent"]
    inner: dict[int, list[int]] = {}
    for k, t in sorted(nodes.items(), key=lambda x: (x[1]["place"], x[0])):
        inner.setdefault(t["parent"], []).append(k)
    bodies = [k for k, t in nodes.items() if t["kind"] == 1 and t["once"]]
    if not bodies:
        return None
    at = bodies[0]
    whole = varies[at]
    if whole < VARIES * nodes[at]["chars"]:
        return None
    while whole > 0:
        below = inner.get(at, [])
        if any(nodes[k]["kind"] == 2 and varies[k] > 0 for k in below):
            break
        below = [k for k in below if nodes[k]["once"] and varies[k] >= SHARE * whole]
        if not below:
            break
        at = max(below, key=lambda k: (varies[k], -nodes[k]["place"]))
    if at == bodies[0]:
        return None

    def inside(node: int) -> bool:
        while node in nodes and node != at:
            node = nodes[node]["parent"]
        return node == at

    prose, open_ = 0, [at]
    while open_:
        for k in inner.get(open_.pop(), []):
            if nodes[k]["kind"] == 2:
                prose += varies[k]
            else:
                open_.append(k)
    return at, sorted(t["token"] for t in found if t["kind"] == _TEXT and inside(t["parent"])), prose >= SHARE * varies[at] > 0


_TEMPLATE = "container long, constants array<long>, prose boolean"


def templates(pages: DataFrame, support: float = SUPPORT, least: int = PAGES) -> DataFrame:
    """host; container, the path of the tag that holds the article; constants, the tokens of constant texts in it; prose, whether
    it holds headings and paragraphs, mostly."""

    def run(tokens_: pa.Array) -> pa.Array:
        found = [nested(x) for x in tokens_.to_pylist()]
        kinds = [("container", pa.int64()), ("constants", pa.list_(pa.int64())), ("prose", pa.bool_())]
        return pa.StructArray.from_arrays([pa.array([x and x[k] for x in found], t) for k, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

    run.__annotations__ = {"tokens_": pa.Array, "return": pa.Array}
    found = classes(pages, support, least).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    return found.select("host", F.arrow_udf(run, _TEMPLATE)("tokens").alias("t")).select("host", "t.*").filter("container is not null")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: a row for each row of pages. The hosts' templates are broadcast
    only if Spark finds their table small enough (its threshold in bytes), else joined by host."""
    template = cut(templates(pages))

    def run(page: pa.Array, container: pa.Array, constants: pa.Array, prose: pa.Array) -> pa.Array:
        rows = zip(page, container, constants, prose, strict=True)
        return pa.array([extract(x.as_py(), c.as_py(), frozenset(k.as_py() or ()), bool(p.as_py())) for x, c, k, p in rows], pa.string())

    run.__annotations__ = {"page": pa.Array, "container": pa.Array, "constants": pa.Array, "prose": pa.Array, "return": pa.Array}
    rows = hosts(pages).join(template, "host", "left")
    text = F.arrow_udf(run, "string")("html", "container", "constants", "prose")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
