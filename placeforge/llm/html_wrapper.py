"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page's tags and text runs, with left-out ends added, nest like an expression: runs of like elements are a
repeated group, text runs are slots. The pages of a host are aligned one after the other; what one has and another lacks
becomes optional, what repeats in one becomes repeated. Each slot of the wrapper carries counts over all pages of the host
(different pages, characters, characters in links, whether its text is always the same). From these, and from the names that
the wrapper's elements have, it is decided which slots are article and which are page furniture. Of the regions of a page
(articles, main parts, elements named like content, others) the one with most varied text outside links is its text, with what
a main part has before its article. Articles that are menus or the same on all pages stand for themselves, apart from a page's other articles.

A large host does not meet in a task: pages of like structure are folded to one row by a partial aggregate, and the
different structures are aligned level by level: in salted groups of about ``GROUP``, then the groups' wrappers likewise,
until a host has few enough for one group. The number of levels grows with the logarithm of the host.

Nulls: a null html is empty and gives an empty text; a null url is a host of its own; null ids are kept. Repeated rows give
a row each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.skew import with_groups
from placeforge.llm.words import slices
from placeforge.session import durable

SALTS = 16  # groups of a host on the last level but one
GROUP = 256  # expressions that meet in a group on the levels before
LONGEST_GROUP = 6  # elements in a repeated group
DEEPEST = 100  # elements nested deeper count as their ancestor at this depth
LINKED = 0.6  # a slot with this part of its characters in links is a menu
WEAK = -1  # stands for the articles of a page that are cards or menus by their looks
SAME_ON = 3  # a slot outside an article with one text on so many different pages belongs to the template

# fixed values: elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
FURNITURE = frozenset(
    "head nav footer aside form script style textarea title noscript template button select option datalist iframe object svg math canvas audio video dialog menu "
    "xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# which open elements a new one ends, up to an element that holds them
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
# names in classes and ids that sites give to page furniture
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended recommendations pagination "
    "pager search widget skip copyright toolbar form hidden disclaimer".split()
)
CONTENT = frozenset("article content story post entry main".split())
# words that make such a name one of the page's layout, as in "has-sidebar"
LAYOUT = frozenset("has with no without open closed enabled layout".split())
WRAPS = frozenset("wrap wrapper container".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[a-zA-Z/!?][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(maxsize=20_000)
def _label(name: str, rest: str) -> str:
    """Element name with its class and id names, its role and whether it is hidden; numbers are left out."""
    if "=" not in rest and "hidden" not in rest:
        return name
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
    names = sorted({re.sub(r"\d+", "", w) for w in f"{found.get('class', '')} {found.get('id', '')}".split()} - {""})
    label = ".".join([name, *names]).replace("/", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    role = found.get("role", "").lower()
    return label + (f"@{role}" if role else "") + ("!" if hidden else "")


def _names_furniture(name: str) -> bool:
    words = {w.lower() for w in _WORD.findall(name)}
    around_all = bool(words & LAYOUT) or bool(words & {"content", "main"} and words & WRAPS)
    return bool(words & NAMES) and not around_all


@lru_cache(maxsize=20_000)
def _is_furniture(label: str, inside: bool) -> bool:
    """By the element's names alone; a header inside an article is its head and stays."""
    bare, _, role = label.rstrip("!").partition("@")
    name, *names = bare.split(".")
    if name in ("html", "body"):
        return False
    words = {w.lower() for n in names for w in _WORD.findall(n)}
    header = (name == "header" or "header" in words) and not inside and not words & CONTENT
    return label.endswith("!") or name in FURNITURE or role in ROLES or any(map(_names_furniture, names)) or header


@lru_cache(maxsize=20_000)
def _region(label: str) -> int:
    """3 for an article, 2 for a main part, 1 for an element named like content, 0 for any other."""
    bare, _, role = label.partition("@")
    name, *names = bare.split(".")
    if name == "article" or role == "article":
        return 3
    if name == "main" or role == "main":
        return 2
    return int(any(w.lower() in CONTENT for n in names for w in _WORD.findall(n)))


@lru_cache(maxsize=50_000)
def region_of(path: str) -> int:
    """The best region among a slot's elements; -1 for furniture."""
    best = 0
    for label in path.split("/"):
        if _is_furniture(label, best > 0):
            return -1
        best = max(best, _region(label))
    return best


def read_page(html: str) -> tuple[list, list[tuple[str, str, int]]]:
    """(tree, blocks): nested [label, children] with "#" for text, and (path, text, characters in links) in page order."""
    root: list = ["", []]
    stack, names = [root], [""]
    blocks: list[tuple[str, str, int]] = []
    parts: list[str] = []
    linked, in_link, dropped = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            children = stack[-1][1]
            if not children or children[-1] != "#":
                children.append("#")
            blocks.append(("/".join(node[0] for node in stack[1:DEEPEST]), text, linked))
        linked = 0

    def close(to: int) -> None:
        flush()
        del stack[to:], names[to:]

    at = 0
    while (m := _TOKEN.match(html, at)) is not None:
        at = m.end()
        text = m["text"]
        if text is not None:
            if not dropped:
                text = unescape(text)
                parts.append(text)
                linked += len(text) if in_link else 0
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name in INLINE:
                in_link = max(0, in_link - (name == "a"))
                dropped = max(0, dropped - 1) if dropped else 0
            elif name in names:
                close(len(names) - 1 - names[::-1].index(name))
                in_link = dropped = 0
            continue
        label = _label(name, m["rest"])
        if name in INLINE:
            in_link += name == "a"
            if dropped or label != name and _is_furniture(label, True):
                dropped += 1
        elif name == "br" or name == "wbr":
            parts.append(" " if name == "br" else "")
        elif name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            flush()
            in_link = dropped = 0
            if names[-1] == "p":
                close(len(names) - 1)
            ended, holders = ENDS.get(name, (set(), set()))
            for i in range(len(names) - 1, 0, -1):
                if names[i] in holders:
                    break
                if names[i] in ended:
                    close(i)
            node: list = [label, []] if len(stack) < DEEPEST else stack[-1]
            if node is not stack[-1]:
                stack[-1][1].append(node)
            if not m["rest"].endswith("/"):
                stack.append(node)
                names.append(name)
    close(1)
    return root, blocks


# ---- expressions: "#" for a slot, or [label, quantifier, children]; a repeated group has the label "()" ----

def _label_of(e) -> str:
    return e if e == "#" else e[0] if e[0] != "()" else "()" + ",".join(map(_label_of, e[2]))


def fold(children: list) -> list:
    """Neighbours that repeat, alone or in groups, become one repeated element."""
    out = [c if c == "#" or len(c) == 3 else [c[0], "1", fold(c[1])] for c in children]
    for size in range(1, LONGEST_GROUP + 1):
        at, folded = 0, []
        labels = [_label_of(e) for e in out]
        while at < len(out):
            end = at + size
            while end + size <= len(out) and labels[end : end + size] == labels[at : at + size]:
                end += size
            if end == at + size:
                folded.append(out[at])
                at += 1
                continue
            group = out[at : at + size]
            for other in range(at + size, end, size):
                group = [_merge(a, b) for a, b in zip(group, out[other : other + size], strict=True)]
            folded.append(group[0] if size == 1 and group[0] == "#" else [group[0][0], _wider(group[0][1], "+"), group[0][2]] if size == 1 else ["()", "+", group])
            at = end
        out = folded
    return out


def _wider(a: str, b: str) -> str:
    """The quantifier that allows what either allows."""
    least, many = "?" in a + b or "*" in a + b, "+" in a + b or "*" in a + b
    return "*" if least and many else "?" if least else "+" if many else "1"


def _merge(a, b):
    """One expression for both of a label."""
    if a == "#":
        return a
    return [a[0], _wider(a[1], b[1]), align(a[2], b[2])]


def _optional(e):
    return e if e == "#" else [e[0], _wider(e[1], "?"), e[2]]


def align(a: list, b: list) -> list:
    """One sequence for both: like elements are merged in order, all others are optional."""
    if a == b:
        return a
    out: list = []
    for kind, i, k, j, m in difflib.SequenceMatcher(None, [_label_of(e) for e in a], [_label_of(e) for e in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_merge(x, y) for x, y in zip(a[i:k], b[j:m], strict=True)]
        else:
            out += map(_optional, a[i:k] + b[j:m])
    return fold(out)


def slots_of(expression: list, path: str = "") -> Iterator[str]:
    for e in expression:
        if e == "#":
            yield path
        elif e[0] == "()":
            yield from slots_of(e[2], path)
        else:
            yield from slots_of(e[2], f"{path}/{e[0]}" if path else e[0])


def structures(pages: DataFrame) -> DataFrame:
    """(host, expression, slots) per page; slots are (path, characters, in links, hash of the texts)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("chars", pa.int64()), ("linked", pa.int64()), ("hash", pa.int64())]))
        for rows, texts in slices(batches, "html"):
            expressions, slots = [], []
            for html in texts.to_pylist():
                tree, blocks = read_page(html)
                expressions.append(json.dumps(fold(tree[1]), ensure_ascii=False, separators=(",", ":")))
                own: dict[str, list] = {}
                for path, text, linked in blocks:
                    slot = own.setdefault(path, [0, 0, xxhash.xxh3_64()])
                    slot[0] += len(text)
                    slot[1] += min(linked, len(text))
                    slot[2].update(text)
                slots.append([{"path": p, "chars": c, "linked": k, "hash": h.intdigest() >> 1} for p, (c, k, h) in own.items()])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(expressions, pa.string()), pa.array(slots, kind)], ["host", "expression", "slots"])

    schema = "host string, expression string, slots array<struct<path: string, chars: bigint, linked: bigint, hash: bigint>>"
    return durable(pages.select("host", "html").mapInArrow(read, schema), "structures")


def _folded(rows: DataFrame, keys: list[str], combine: Callable[[list, list], list]) -> DataFrame:
    """One expression for each key; a key's expressions pass one after the other."""
    n = len(keys)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current[0]], pa.string()), pa.array([json.dumps(held, ensure_ascii=False, separators=(",", ":"))])], ["host", "expression"]
            )

        for b in batches:
            for *key, expression in zip(*(b.column(i).to_pylist() for i in range(n + 1)), strict=True):
                if key != current:
                    if current is not None:
                        yield out()
                    current, held = key, json.loads(expression)
                else:
                    held = combine(held, json.loads(expression))
        if current is not None:
            yield out()

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "expression").select(*keys, "expression")
    return dealt.mapInArrow(merge, "host string, expression string")


def levels(most: int) -> list[int]:
    """Groups per host on each level, for at most so many expressions of a host."""
    found = []
    while (most := -(-most // GROUP)) > SALTS:
        found.append(most)
    return [*found, SALTS]


def infer_wrappers(found: DataFrame) -> DataFrame:
    """(host, pages, expression, slots) from ``structures``; slots are (path, pages, chars, linked, one_text)."""
    rows = durable(found.select("host", "expression").distinct(), "expressions")
    most = rows.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    for groups in levels(most):
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("expression"), F.lit(groups)).cast("string"))
        rows = _folded(salted, ["host", "salt"], align)
        if groups > SALTS:
            rows = durable(rows, "level")
    wrappers = _folded(rows, ["host"], align)
    different = found.select("host", "slots").distinct()  # copies of a page tell nothing about the template
    one = different.select("host", F.explode("slots").alias("s")).select("host", "s.*")
    slots = one.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), (F.min("hash") == F.max("hash")).alias("one_text")
    )
    # as many rows per host as its wrapper has slots
    lists = slots.groupBy("host").agg(F.collect_list(F.struct("path", "pages", "chars", "linked", "one_text")).alias("slots"))
    pages = found.groupBy("host").agg(F.count("*").alias("pages"))
    return pages.join(wrappers, "host", "left").join(lists, "host", "left")


def _inner(path: str, region: int) -> str:
    """The path down to the innermost element of a region; "" without one."""
    labels = path.split("/")
    return next(("/".join(labels[:i]) for i in range(len(labels), 0, -1) if _region(labels[i - 1]) == region), "")


def article_slots(expression: list, slots: list[dict]) -> dict[str, tuple[int, float, bool]]:
    """(region, characters of varied text outside links per page, whether weak) of every slot of the wrapper that is no furniture.

    Weak are the slots of an <article> that as a whole is a menu or the same on all pages, as cards of other pages are.
    """
    facts = {s["path"]: s for s in slots}
    varied = any(not s["one_text"] for s in slots if s["pages"] >= SAME_ON)
    is_fixed = lambda s: varied and s["one_text"] and s["pages"] >= SAME_ON
    articles: dict[str, list[dict]] = {}
    kept = {}
    for path in set(slots_of(expression)):
        region, slot = region_of(path), facts.get(path)
        if region < 0:
            continue
        if slot and region < 3 and (slot["linked"] >= LINKED * slot["chars"] or is_fixed(slot)):
            continue
        if slot and region == 3:
            articles.setdefault(_inner(path, 3), []).append(slot)
        weight = 0.0 if not slot or is_fixed(slot) else (slot["chars"] - slot["linked"]) / slot["pages"]
        kept[path] = (region, weight, False)
    for own in articles.values():
        menu = sum(s["linked"] for s in own) >= LINKED * sum(s["chars"] for s in own)
        if menu or all(map(is_fixed, own)):
            for slot in own:
                kept[slot["path"]] = (*kept[slot["path"]][:2], True)
    return kept


def decided(wrappers: DataFrame) -> DataFrame:
    """(host, pages, paths, regions, weights, weak): the slots that may hold article text; see ``article_slots``."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[], [], [], []]
            for expression, slots in zip(*(b.column(i).to_pylist() for i in (2, 3)), strict=True):
                kept = article_slots(json.loads(expression or "[]"), slots or [])
                for column, values in zip(columns, (list(kept), *([v[i] for v in kept.values()] for i in range(3))), strict=True):
                    column.append(values)
            kinds = (pa.string(), pa.int32(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True))],
                ["host", "pages", "paths", "regions", "weights", "weak"],
            )

    rows = wrappers.select("host", "pages", "expression", "slots")
    schema = "host string, pages long, paths array<string>, regions array<int>, weights array<double>, weak array<boolean>"
    return durable(rows.mapInArrow(decide, schema), "wrappers")


def _main_text(html: str, facts: dict[str, tuple[int, float, bool]]) -> str:
    """The blocks of the region with most text, by the host's pages and by this page; of equals the better region."""
    _, blocks = read_page(html)
    here = [facts.get(path, (-1, 0.0, False)) for path, _, _ in blocks]
    of_host: dict[int, dict[str, float]] = {}
    of_page: dict[int, int] = {}
    for (region, weight, weak), (path, text, linked) in zip(here, blocks, strict=True):
        if region >= 0:
            region = WEAK if weak else region
            of_host.setdefault(region, {})[path] = weight
            of_page[region] = of_page.get(region, 0) + (max(0, len(text) - linked) if weight else 0)
    if not of_host:
        return ""
    best = max(of_host, key=lambda r: (sum(of_host[r].values()) * of_page[r], r))
    chosen = [i for i, (r, _, weak) in enumerate(here) if r == (3 if best == WEAK else best) and (best == WEAK or not weak)]
    lead: list[int] = []
    around = _inner(_inner(blocks[chosen[0]][0], 3), 2) if best == 3 else ""
    if around:  # a heading or lead in the main part, before the article in it
        for i in range(chosen[0] - 1, -1, -1):
            if not f"{blocks[i][0]}/".startswith(f"{around}/"):
                break
            if here[i][0] == 2:
                lead.append(i)
    return "\n".join(blocks[i][1] for i in lead[::-1] + chosen)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its article's blocks, joined by line breaks."""
    host = F.regexp_extract(F.lower(F.col("url").cast("string")), r"^[a-z][a-z0-9+.-]*://([^/:?#]*)", 1)
    rows = pages.select(
        F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html"), F.coalesce(host, F.lit("")).alias("host")
    )
    found = structures(rows)
    wrappers = decided(infer_wrappers(found))
    met = with_groups(rows, wrappers, "host", "pages", found.count(), F.xxhash64("page_id", "url"))
    met = met.select("page_id", "url", "html", "host", *(F.col(f"group.{c}").alias(c) for c in ("paths", "regions", "weights", "weak")))
    kinds = dict(pages.dtypes)

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, htmls in slices(batches, "html"):
            texts, held = [], {}
            for i, (html, host) in enumerate(zip(htmls.to_pylist(), part.column(3).to_pylist(), strict=True)):
                if host not in held:
                    paths, *facts = (part.column(c)[i].as_py() or () for c in range(4, 8))
                    held[host] = dict(zip(paths, zip(*facts, strict=True), strict=True))
                texts.append(_main_text(html, held[host]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return met.mapInArrow(text, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
