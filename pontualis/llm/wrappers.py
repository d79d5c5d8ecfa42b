"""HTML extraction by union-free regular expressions inferred for each host.

A page becomes a stream of tags and texts.  Within a page, neighbouring equal groups are
folded into one repeated group.  The streams of a host's pages are then aligned, one after
another: equal texts stay template text, texts that differ become slots, and what only one
side has becomes optional, or joins a neighbouring repeated group that it equals.  The
result, the host's wrapper, is a regular expression of tags, text slots, optional and
repeated groups without unions.  Pages of the same folded stream are merged in place, so
every page takes part; each task makes wrappers of its own pages, and those of a host are
aligned in two levels, which spreads a host that has most of the pages.

Every text slot of a wrapper knows how many words all pages of the host have there.  These are
the votes that decide, host by host, which element holds the main text where pages have an
``article`` and a ``main`` (a teaser's few words lose), and which elements with the name of a
menu, notice, advert, comment or the like are one: an element that holds half of the main
text's words or more is none, whatever its name.  Names count on containers, not on
paragraphs, headings and list items.

A page's text is then that of its main element without menus, headers, footers, sidebars,
notices, adverts, forms and comments, which tags, roles and the votes on names tell; of a page
without main element, that of the body without the texts that at least three, and at least
half, of the host's pages or of those among them without such an element hold.

Defined cases: null or empty html has an empty text; a null url is a host of its own; unclosed
and stray tags are tolerated; whatever is left open ends with the page; repeated rows are pages
as any other, extra columns are ignored, an empty table gives no rows.  A very long page is
read in one go, in time proportional to it.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.sources.scratch import materialize

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is not text.
_RAW = frozenset("script style noscript template iframe svg canvas object title textarea".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label
    mark q s samp small span strike strong sub sup time tt u var wbr""".split())
_CHROME = frozenset("""nav header footer aside form menu dialog button select fieldset head
    noscript""".split())
_CHROME_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert
    alertdialog menu menubar form""".split())
_CHROME_NAME = re.compile(
    r"(?:ads?|adverts?|advertisement|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?"
    r"|side ?bar|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|cookies?|notices?"
    r"|consent|gdpr|popup|modal|overlay|comments?|disqus|replies|share|sharing|social|related"
    r"|recommended|widget|subscribe|subscription|newsletter|signup|login|search|toolbar|pager"
    r"|pagination|copyright|legal|disclaimer)")
#: Names that say that something is not there, or only beside.
_DENIED = frozenset("no non not without has have with hide hidden is".split())
#: Elements whose names tell of style, not of a part of the page.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre figure figcaption td th tr".split())
_MAIN = ("article", "main")
_LONGEST_GROUP = 12
_LONGEST_TEMPLATE = 200

#: (key, payload, optional); the payload is a group's items, or, of a text, (text or None for a slot,
#: words of all pages there), or None.
Item = tuple


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) with kind ``open``, ``close`` or ``text``."""
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at:found.start()]
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                yield "text", "", html.escape(found[0][9:].removesuffix("]]>"))
            continue
        name = found[2].lower()
        if found[1]:
            yield "close", name, ""
            continue
        yield "open", name, found[3]
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            yield "close", name, ""


def hinted(label: str) -> bool:
    """Whether a class or id has the name of a part that is no main text."""
    for word in label.split():
        parts = re.split(r"[-_]+", word)
        if _DENIED.isdisjoint(parts) and any(
                _CHROME_NAME.fullmatch(x) for x in (word, " ".join(parts), parts[0], parts[-1])):
            return True
    return False


def names(rest: str) -> tuple[str, bool]:
    """The class and id of a tag, and whether its attributes say that it is no main text."""
    if "=" not in rest:
        return "", "hidden" in rest.split()
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    label = " ".join(filter(None, (found.get("class"), found.get("id")))).lower()
    away = found.get("role", "").lower() in _CHROME_ROLES or found.get("aria-hidden") == "true"
    return label, (away or "hidden" in found
                   or "display:none" in found.get("style", "").replace(" ", ""))


# -- wrappers ------------------------------------------------------------------------


def stream(page: str) -> list[Item]:
    out: list[Item] = []
    for kind, name, rest in tokens(page):
        if kind == "text":
            text = " ".join(html.unescape(rest).split())
            if text:
                out.append(("#", (text if len(text) <= _LONGEST_TEMPLATE else None, text.count(" ") + 1),
                            False))
        elif kind == "close":
            out.append((f"</{name}>", None, False))
        else:
            label = names(rest)[0]
            out.append((f"<{name} {label}>" if label else f"<{name}>", None, False))
    return out


def merged(a: Item, b: Item) -> Item:
    """Two items of equal key as one."""
    if a[0] == "#":
        payload = a[1][0] if a[1][0] == b[1][0] else None, a[1][1] + b[1][1]
    elif isinstance(a[0], tuple):
        payload = aligned(a[1], b[1])
        return _group(payload, a[2] or b[2])
    else:
        payload = None
    return a[0], payload, a[2] or b[2]


def _group(items: list[Item], optional: bool) -> Item:
    return ("+", *[i[0] for i in items]), items, optional


def _keys(items: list[Item]) -> list:
    return [i[0] for i in items]


def folded(items: list[Item]) -> list[Item]:
    """Neighbouring equal groups as one repeated group."""
    out: list[Item] = []
    for item in items:
        out.append(item)
        again = True
        while again:
            again = False
            key = out[-1][0]
            if isinstance(key, tuple) and len(out) > 1:
                size = len(out[-1][1])  # equal items before a repeated group join it
                before = _plain(out[-size - 1:-1])
                if len(before) == size and _keys(before) == _keys(out[-1][1]):
                    body = [merged(x, y) for x, y in zip(before, out[-1][1], strict=True)]
                    out[-size - 1:] = [_group(body, out[-1][2])]
                    again = True
                    continue
                if out[-2][0] == key:
                    out[-2:] = [merged(out[-2], out[-1])]
                    again = True
                    continue
            for size in range(1, min(_LONGEST_GROUP, len(out)) + 1):
                last = out[-size:]
                before = out[-size - 1] if len(out) > size else None
                if before is not None and isinstance(before[0], tuple) and \
                        len(before[1]) == size and list(before[0][1:]) == _keys(last):
                    body = [merged(x, y) for x, y in zip(before[1], _plain(last), strict=True)]
                    out[-size - 1:] = [_group(body, before[2])]
                    again = True
                    break
                if size > 1 and last[0][0] == out[-2 * size][0] if len(out) >= 2 * size else False:
                    previous = out[-2 * size:-size]
                    if _keys(previous) == _keys(last) and _balanced(last):
                        body = [merged(x, y) for x, y in zip(previous, last, strict=True)]
                        out[-2 * size:] = [_group(body, False)]
                        again = True
                        break
    return out


def _plain(items: list[Item]) -> list[Item]:
    """A group that is optional as a whole, without that mark on each item."""
    if all(optional for _, _, optional in items):
        return [(key, payload, False) for key, payload, _ in items]
    return items


def _balanced(items: list[Item]) -> bool:
    """Whether a group begins with a tag, as repeated groups do."""
    key = items[0][0]
    return isinstance(key, str) and key.startswith("<") and not key.startswith("</")


def _match_key(item: Item):
    key = item[0]
    while isinstance(key, tuple):
        key = f"+{key[1]}" if not isinstance(key[1], tuple) else key[1]
    return key


def aligned(a: list[Item], b: list[Item]) -> list[Item]:
    """The wrapper of everything that ``a`` or ``b`` matches."""
    if _keys(a) == _keys(b):
        return [merged(x, y) for x, y in zip(a, b, strict=True)]
    out: list[Item] = []
    match = SequenceMatcher(None, [_match_key(x) for x in a], [_match_key(x) for x in b],
                            autojunk=False)
    for kind, a1, a2, b1, b2 in match.get_opcodes():
        if kind == "equal":
            out += [merged(x, y) for x, y in zip(a[a1:a2], b[b1:b2], strict=True)]
        else:
            out += [(key, payload, True) for key, payload, _ in (*a[a1:a2], *b[b1:b2])]
    return _joined(folded(out))


def _joined(items: list[Item]) -> list[Item]:
    """Neighbouring groups that begin with the same tag as one repeated group, so that
    wrappers do not grow with the number of pages."""
    out: list[Item] = []
    for item in _grouped(items):
        if out and isinstance(item[0], tuple) and isinstance(out[-1][0], tuple) \
                and _match_key(item) == _match_key(out[-1]):
            out[-1] = _flat(_group(aligned(out[-1][1], item[1]), out[-1][2] and item[2]))
        else:
            out.append(_flat(item) if isinstance(item[0], tuple) else item)
    return out


def _flat(item: Item) -> Item:
    """A repeated group without groups in it that begin with its own tag."""
    tag, close, depth = item[0][1], None, 0
    if not isinstance(tag, str) or not tag.startswith("<"):
        return item
    close = f"</{tag[1:].split()[0].rstrip('>')}>"
    parts: list[list[Item]] = [[]]
    for x in item[1]:
        if isinstance(x[0], tuple) and _match_key(x) == f"+{tag}":
            parts.append(x[1])
            parts.append([])
            continue
        if x[0] == tag:
            if depth == 0 and parts[-1]:
                parts.append([])
            depth += 1
        depth -= x[0] == close
        parts[-1].append(x)
    parts = [part for part in parts if part]
    if len(parts) < 2:
        return item
    body = parts[0]
    for part in parts[1:]:
        if part[0][0] != tag:  # what follows an inner group belongs to the outer one
            part = [item[1][0], *part]
        body = aligned(body, part)
    if len(body) == 1 and isinstance(body[0][0], tuple):
        body = body[0][1]
    return _group(body, item[2])


def _grouped(items: list[Item]) -> list[Item]:
    """Runs of optional items that begin like a repeated group beside them, as such groups."""
    tags = {_match_key(x) for x in items if isinstance(x[0], tuple)}
    out: list[Item] = []
    run: list[Item] = []

    def close() -> None:
        if run:
            out.append(_group(_plain(run), True))
            run.clear()

    for item in items:
        single = not isinstance(item[0], tuple)
        if single and item[2] and f"+{item[0]}" in tags:
            close()
            run.append(item)
        elif run and item[2]:
            run.append(item)
        else:
            close()
            out.append(item)
    close()
    return out


def as_text(items: list[Item]) -> str:
    """A wrapper in the notation of regular expressions: ``#`` a slot, ``( )+``, ``( )?``."""
    out = []
    for key, payload, optional in items:
        if isinstance(key, tuple):
            word = f"( {as_text(payload)} )" + ("*" if optional else "+")
        else:
            word = payload[0] if key == "#" and payload[0] else key
            word = f"( {word} )?" if optional else word
        out.append(word)
    return " ".join(out)


def _loaded(raw: str) -> list[Item]:
    def item(x):
        if x[0] is None:
            return _group([item(y) for y in x[1]], x[2])
        return x[0], tuple(x[1]) if x[0] == "#" else x[1], x[2]

    return [item(x) for x in json.loads(raw)]


def _dumped(items: list[Item]) -> str:
    def plain(x):
        return [None, [plain(y) for y in x[1]], x[2]] if isinstance(x[1], list) else list(x)

    return json.dumps([plain(x) for x in items], ensure_ascii=False)


def votes(items: list[Item]) -> tuple[str | None, list[str]]:
    """What the words in a wrapper's slots say: the main text's element, and the names of elements
    that hold half of its words or more, so that they are no mere part beside it."""
    words: dict = {}
    opened: list[tuple[str, str]] = []

    def walk(some: list[Item]) -> None:
        for key, payload, _ in some:
            if isinstance(payload, list):
                walk(payload)
            elif key == "#":
                if any(tag in _CHROME or tag in _RAW for tag, _ in opened):
                    continue
                inside = {tag for tag, _ in opened}.intersection(_MAIN)
                for where in {*inside, ""}:
                    words[where] = words.get(where, 0) + payload[1]
                    for label in {label for _, label in opened if label}:
                        words[where, label] = words.get((where, label), 0) + payload[1]
            elif key.startswith("</"):
                tag = key[2:-1]
                if any(x == tag for x, _ in opened):
                    while opened.pop()[0] != tag:
                        pass
            else:
                tag, _, label = key[1:-1].partition(" ")
                words.setdefault(tag, 0)
                if tag not in _VOID:
                    opened.append((tag, label if tag not in _PROSE and hinted(label) else ""))

    walk(items)
    article, main = words.get("article"), words.get("main")
    best = "article" if article is not None and (main is None or 2 * article >= main) else \
        "main" if main is not None else None
    root = best or ""
    whole = words.get(root, 0)
    kept = sorted(x[1] for x in words if isinstance(x, tuple) and x[0] == root
                  and 2 * words[x] >= whole > 0)
    return best, kept


def infer(pages: DataFrame) -> DataFrame:
    """``host, pages, wrapper, main, kept`` from rows of ``host`` and ``html``; the last two are
    the :func:`votes`."""
    schema = "host string, part int, pages long, wrapper string"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(batches):
            shapes: dict = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                items = folded(stream(page or ""))
                key = host, tuple(_keys(items))
                old = shapes.get(key)
                shapes[key] = (items, 1) if old is None else (
                    [merged(x, y) for x, y in zip(old[0], items, strict=True)], old[1] + 1)
            hosts: dict = {}
            for (host, _), (items, count) in shapes.items():
                old = hosts.get(host)
                hosts[host] = (items, count) if old is None else (
                    aligned(old[0], items), old[1] + count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(hosts), pa.string()), pa.array([n % 8] * len(hosts), pa.int32()),
                 pa.array([x[1] for x in hosts.values()], pa.int64()),
                 pa.array([_dumped(x[0]) for x in hosts.values()], pa.string())],
                ["host", "part", "pages", "wrapper"])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["pages", "wrapper"], ascending=[False, True])
        items = None
        for raw in group["wrapper"].drop_duplicates():
            items = _loaded(raw) if items is None else aligned(items, _loaded(raw))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "part": [0],
                             "pages": [group["pages"].sum()], "wrapper": [_dumped(items)]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        one = together(group)
        items = _loaded(one["wrapper"].iloc[0])
        main, kept = votes(items)
        one["main"], one["kept"] = [main], [kept]
        return one.drop(columns="part")

    parts = pages.select("host", "html").mapInArrow(local, schema)
    mixed = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(64)).cast("int"))
    return (mixed.groupBy("host", "part").applyInPandas(together, schema)
            .groupBy("host").applyInPandas(
                finish, "host string, pages long, wrapper string, main string, kept array<string>"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: texts that at least three, and at least half, of the different pages
    of a host hold, or of those of its pages that have no main element; for hosts with such
    pages."""
    @F.arrow_udf("boolean")
    def without_main(column: pa.Array) -> pa.Array:
        return pa.array([main_of(p or "") is None for p in column.to_pylist()], pa.bool_())

    marked = pages.select("host", "html", without_main("html").alias("bare"))
    bare_hosts = materialize(marked.filter("bare").select("host").distinct(), "bare_hosts")
    different = marked.join(bare_hosts, "host", "left_semi").distinct()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, t, b) for h, p, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for t in {*blocks(p or "", None), ""}]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.string()),
                 pa.array([x[2] for x in rows], pa.bool_())], ["host", "text", "bare"])

    counts = (different.mapInArrow(texts, "host string, text string, bare boolean")
              .groupBy("host", "text").agg(F.count(F.lit(1)).alias("count"),
                                           F.count_if("bare").alias("bare")))
    counts = materialize(counts.filter("text = '' OR count >= 3"), "template_texts")
    pages_of = counts.filter("text = ''").select("host", F.col("count").alias("pages"),
                                                 F.col("bare").alias("bare_pages"))
    often = counts.filter("text <> ''").join(pages_of, "host").filter(
        "2 * count >= pages OR bare >= 3 AND 2 * bare >= bare_pages")
    return often.groupBy("host").agg(F.collect_list("text").alias("template"))


# -- extraction ----------------------------------------------------------------------


def main_text(page: str, main: str | None, template: frozenset = frozenset(),
              kept: frozenset = frozenset()) -> str:
    """The text of ``page``: its blocks without template texts, unless it has no others."""
    found = blocks(page, main, kept)
    return " ".join([x for x in found if x not in template] or found)


def _page_text(page: str, template: list[str] | None, main: str | None, kept: list[str] | None) -> str:
    # Where a page has both elements, its host's votes say which; where one, there is no choice.
    main = main_of(page, tuple(sorted(_MAIN, key=lambda x: x != main)))
    # Template texts are looked for in whole bodies; what an article says is its own.
    return main_text(page, main, frozenset(template or () if main is None else ()),
                     frozenset(kept or ()))


def main_of(page: str, elements: tuple[str, ...] = _MAIN) -> str | None:
    """The first of ``elements`` that ``page`` has as a tag, not in a comment or script."""
    maybe = [x for x in elements if re.search(rf"<{x}\b", page, re.IGNORECASE)]
    seen = set()
    for kind, name, _ in tokens(page) if maybe else ():
        if kind == "open" and name in maybe:
            seen.add(name)
            if name == maybe[0]:
                break
    return next((x for x in maybe if x in seen), None)


def blocks(page: str, main: str | None, kept: frozenset = frozenset()) -> list[str]:
    """The blocks of ``page`` inside ``main`` (or everywhere, if it has none).  Names in ``kept`` are
    those of main text."""
    out, pending = [], []
    stack: list[tuple[str, bool]] = []
    away = inside = 0
    if main is not None:
        main = main_of(page, (main,))

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            out.append(text)

    for kind, name, rest in tokens(page):
        if kind == "text":
            if not away and (main is None or inside):
                pending.append(html.unescape(rest))
            continue
        if name not in _INLINE:
            flush()
        if kind == "open":
            label, chrome = names(rest)
            chrome = chrome or name in _CHROME or (
                name not in _PROSE and label not in kept and hinted(label))
            chrome = chrome and name not in ("html", "body", main)
            if name not in _VOID and not rest.endswith("/"):
                stack.append((name, chrome))
                away += chrome
                inside += name == main
        elif any(open_name == name for open_name, _ in stack):
            while True:
                open_name, chrome = stack.pop()
                away -= chrome
                inside -= open_name == main
                if open_name == name:
                    break
    flush()
    return out


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^:/]*:?//([^/?#]*)", 1)), F.lit(""))


def extract(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> tuple[DataFrame, DataFrame]:
    """(``id, url, text`` of every page, the wrappers of all hosts)."""
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"),
                        F.col(html_column).alias("html"), _host(F.col(url_column)).alias("host"))
    found = materialize(infer(rows), "wrappers")

    @F.arrow_udf("string")
    def text(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in columns:
            rows = zip(*(x.to_pylist() for x in arrays), strict=True)
            yield pa.array([_page_text(p or "", t, m, k) for p, t, m, k in rows], pa.string())

    common = materialize(templates(rows), "templates")
    joined = (rows.join(common, "host", "left")
              .join(found.select("host", F.col("main").alias("vote"), "kept"), "host", "left"))
    return joined.select("id", "url", text("html", "template", "vote", "kept").alias("text")), found
