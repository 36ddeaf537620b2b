"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tags and texts. Its pattern keeps the tags; neighbouring groups with the same tag
become one repeated group. Patterns of the same host are aligned one after the other:
what only one side has becomes optional, what differs in number becomes repeated, texts that
differ become slots. The result, the wrapper, says which groups a host's pages are made of and which
texts never change. From that follow the main regions of the host and its fixed texts, and each page
is read with them.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices
from millrace.operators.joins import checked_broadcast
from millrace.session import stored

# Element names of HTML by their kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
KEEPS_OPEN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
PLAIN = {"div", "section", "span"}
NOISE_TAGS = set("head nav footer aside form button select dialog menu search object".split())
HEAD_TAGS = set("base link meta title".split())
NOISE_WORDS = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead "
    "menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo related reply replies respond share sharing sidebar "
    "social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
MAIN_WORDS = ("article", "entry-content", "post-content", "article-body", "post-body", "main-content", "content-main", "story-body", "content")

DEEPEST = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|math|canvas|object)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

Event = tuple[str, str]


def events(html: str) -> Iterator[Event]:
    """Balanced opening and closing of elements and the texts between them; scripts, styles and comments are left out.

    An opened element is its tag, then its class, id and role words. End tags that pages leave out are put in.
    """
    stack: list[str] = []
    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            yield "text", html[at : m.start()]
        at = m.end()
        if not m.group(3):
            continue
        name = m.group(3).lower()
        if m.group(2):
            if name in stack:
                while True:
                    last = stack.pop()
                    yield "close", last
                    if last == name:
                        break
            continue
        if name in VOID:
            yield "void", name
            continue
        if name not in HEAD_TAGS and "head" in stack and name != "head":
            while True:
                last = stack.pop()
                yield "close", last
                if last == "head":
                    break
        ends = CLOSES.get(name, set())
        if name in BLOCK and "p" in stack and not {"td", "th", "li", "button"} & set(stack[stack.index("p") :]):
            while True:
                last = stack.pop()
                yield "close", last
                if last == "p":
                    break
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in KEEPS_OPEN[name]:
                    break
                if stack[i] in ends:
                    while len(stack) > i:
                        yield "close", stack.pop()
                    break
        stack.append(name)
        yield "open", name + _words(m.group(4))
    if at < len(html):
        yield "text", html[at:]
    while stack:
        yield "close", stack.pop()


def _words(attributes: str) -> str:
    if not attributes:
        return ""
    out = []
    for m in _NAMES.finditer(attributes):
        kind, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        out += ["!hidden"] if kind == "hidden" else [("@" if kind == "role" else ".") + w for w in value.split()]
    return "".join(out)


def is_noise(symbol: str) -> bool:
    """Whether an element is something other than the article by its tag, or by a word of its class, id or role."""
    tag, *words = re.split(r"(?=[.@!])", symbol)
    if tag in NOISE_TAGS or "!hidden" in words:
        return True
    if tag in ("article", "main", "body", "html"):
        return False
    return any(w[1:] in NOISE_ROLES if w[0] == "@" else not NOISE_WORDS.isdisjoint(re.split(r"[-_]", w[1:])) for w in words)


def is_main(symbol: str) -> bool:
    tag, *words = re.split(r"(?=[.@!])", symbol)
    return tag in ("article", "main") or "@main" in words or any(w[1:] in MAIN_WORDS for w in words if w[0] == ".")


def is_named(symbol: str) -> bool:
    """Whether only a word of its class, id or role makes an element noise."""
    tag, *words = re.split(r"(?=[.@!])", symbol)
    return tag not in NOISE_TAGS and "!hidden" not in words


def holds_main(groups: list) -> bool:
    return any(s != "#" and (is_main(s) and not is_noise(s) or holds_main(i)) for s, _, _, i in groups)


# A pattern is a list of groups [symbol, optional, repeated, inner pattern]; a text is ["#", optional, repeated, its fingerprint or None].


def pattern(html: str) -> list:
    """The pattern of one page, with the fingerprints of its texts.

    What is nested deeper than ``DEEPEST`` elements stands side by side at that depth, so patterns of any page can be walked; no element is left out.
    """
    root: list = []
    levels = [root]
    for kind, value in events(html):
        if kind == "open":
            inner: list = []
            levels[-1].append([value, False, False, inner])
            levels.append(inner if len(levels) < DEEPEST else levels[-1])
        elif kind == "close":
            if len(levels) > 1:
                levels.pop()
        elif kind == "text" and value.strip():
            levels[-1].append(["#", False, False, value])
    return folded(_with_texts(root))


def _with_texts(groups: list) -> list:
    return [[s, o, r, fingerprint(i) if s == "#" else _with_texts(i)] for s, o, r, i in groups]


def fingerprint(text: str) -> str:
    return f"{zlib.crc32(' '.join(entities.unescape(text).split()).encode('utf-8', 'surrogatepass')):08x}"


def folded(groups: list) -> list:
    """Neighbouring groups with one symbol become one repeated group, from the inside out; containers without a name only if they look alike."""
    out: list = []
    for symbol, optional, repeated, inner in groups:
        inner = folded(inner) if symbol != "#" else inner
        if out and out[-1][0] == symbol and (symbol not in PLAIN or expression(out[-1][3]) == expression(inner)):
            out[-1] = [symbol, optional and out[-1][1], True, aligned(out[-1][3], inner) if symbol != "#" else None]
        else:
            out.append([symbol, optional, repeated, inner])
    return out


def aligned(a: list, b: list) -> list:
    """One pattern for what either pattern matches: groups in common, in order, stay; others become optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    spare = spared([g[0] for g in a], [g[0] for g in b])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            symbol = a[i][0]
            inner = aligned(a[i][3], b[j][3]) if symbol != "#" else a[i][3] if a[i][3] == b[j][3] else None
            out.append([symbol, a[i][1] or b[j][1], a[i][2] or b[j][2], inner])
            i, j = i + 1, j + 1
        elif j == m or i < n and spare[j] >> (n - 1 - i) & 1:
            out.append([a[i][0], True, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], True, *b[j][2:]])
            j += 1
    return folded(out)


def spared(a: list[str], b: list[str]) -> list[int]:
    """For each place in ``b``, a bit for each place in ``a``, the last one lowest: whether the longest common subsequence of what
    follows either place stays as long without that symbol of ``a``. Bit-parallel: one bit for a pair of symbols."""
    full = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, symbol in enumerate(reversed(a)):
        where[symbol] = where.get(symbol, 0) | 1 << i
    row, rows = full, [full]
    for symbol in reversed(b):
        met = row & where.get(symbol, 0)
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    return rows[::-1]


def expression(groups: list) -> str:
    """The wrapper written as a regular expression over tags and text slots."""
    out = []
    for symbol, optional, repeated, inner in groups:
        one = "#text" if symbol == "#" else f"<{symbol}>{expression(inner)}</>"
        mark = "*" if optional and repeated else "+" if repeated else "?" if optional else ""
        out.append(f"({one}){mark}" if mark else one)
    return "".join(out)


@lru_cache(maxsize=256)
def reading(wrapper: str, pages: int) -> tuple[bool, frozenset[tuple[str, str]]]:
    """Whether the host marks its main regions, and the texts that all its pages have alike, with their paths (if there are three pages or more)."""
    fixed: set[tuple[str, str]] = set()
    marked = False

    def walk(groups: list, path: str, always: bool) -> None:
        nonlocal marked
        for symbol, optional, _, inner in groups:
            if symbol == "#":
                if inner is not None and always and not optional and pages >= 3:
                    fixed.add((path, inner))
            elif not is_noise(symbol) or holds_main(inner):
                marked = marked or is_main(symbol)
                walk(inner, f"{path}/{symbol}", always and not optional)

    walk(json.loads(wrapper), "", True)
    return marked, frozenset(fixed)


def main_text(html: str, marked: bool, fixed: frozenset[tuple[str, str]], within: bool = False) -> str:
    """Blocks of the main regions, each on one line, with an empty line between them; blocks of nothing but the host's fixed texts
    are left out. A block that holds any other text stays whole, and a heading of a main region stays as it is.

    On a host without marked regions, or on a page that lacks them, all blocks count but noise. A main element, or on a page without other
    main regions (``within``) any of them, counts in a container that only its class, id or role makes noise.
    """
    blocks: list[str] = []
    in_main: list[bool] = []
    text: list[str] = []
    path: list[str] = []
    varies = False
    noise = main = 0
    outside: list[tuple[int, int]] = []  # depth of a main region within a named container, and the noise around it

    def flush() -> None:
        nonlocal varies
        block = " ".join(entities.unescape("".join(text)).split())
        if block and varies:
            blocks.append(block)
            in_main.append(main > 0)
        text.clear()
        varies = False

    def is_fixed(value: str) -> bool:
        if ("".join(f"/{p}" for p in path), fingerprint(value)) not in fixed:
            return False
        return not (main and any(re.split(r"[.@!]", p, maxsplit=1)[0] in HEADINGS for p in path))

    for kind, value in events(html):
        if kind == "text":
            if not noise:
                text.append(value)
                varies = varies or bool(value.strip()) and not (fixed and is_fixed(value))
        elif kind == "void":
            if value in BLOCK:
                flush()
            else:
                text.append(" " if value == "br" and not noise else "")
        elif kind == "open":
            if value.split(".", 1)[0].split("@", 1)[0].split("!", 1)[0] in BLOCK:
                flush()
            path.append(value)
            if noise and is_main(value) and not is_noise(value) and (within or value.split(".", 1)[0] in ("main", "main@main") or "@main" in value):
                around = [p for p in path[:-1] if is_noise(p)]
                if all(map(is_named, around)):
                    outside.append((len(path), noise))
                    noise = 0
            noise += noise > 0 or is_noise(value)
            main += main > 0 or not noise and is_main(value)
        else:
            if value in BLOCK:
                flush()
            if outside and outside[-1][0] == len(path):
                noise = outside.pop()[1] + 1
            if path:
                path.pop()
            noise = max(0, noise - 1)
            main = max(0, main - 1)
    flush()
    if marked and not any(in_main) and not within:
        return main_text(html, marked, fixed, True)
    if marked and any(in_main):
        blocks = [b for b, inside in zip(blocks, in_main) if inside]
    return "\n\n".join(blocks)


def host(url):
    """Host of an address in lower case, without user and port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper, n_pages: the aligned pattern of all pages of each host and how many differ, stored.

    Equal patterns of a host count once, summed up before they move. A host's patterns are aligned in 64 parts first, so
    a host with a third of all pages is shared out; each task holds one wrapper at a time.
    """
    page_schema = pa.schema([("host", pa.string()), ("pattern", pa.string()), ("n", pa.int64())])

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            seen = {
                (name, json.dumps(pattern(page or ""), separators=(",", ":")), zlib.crc32((page or "").encode("utf-8", "surrogatepass")))
                for name, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist())
            }
            yield batch({"host": [h for h, _, _ in seen], "pattern": [p for _, p, _ in seen], "n": [c for _, _, c in seen]}, page_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, merged, n = None, None, 0
        for part in batches:
            out: dict[str, list] = {f.name: [] for f in page_schema}
            for row_host, text, count in zip(*(part.column(c).to_pylist() for c in ("host", "pattern", "n"))):
                if merged is not None and row_host == name:
                    merged, n = aligned(merged, json.loads(text)), n + count
                    continue
                if merged is not None:
                    for column, value in zip(out.values(), (name, json.dumps(merged, separators=(",", ":")), n)):
                        column.append(value)
                name, merged, n = row_host, json.loads(text), count
            yield batch(out, page_schema)
        if merged is not None:
            yield batch({"host": [name], "pattern": [json.dumps(merged, separators=(",", ":"))], "n": [n]}, page_schema)

    ddl = "host string, pattern string, n long"
    # copies of one page tell nothing about what is fixed, so different pages count
    counted = pages.select("host", "html").mapInArrow(patterns, ddl).groupBy("host", "pattern").agg(F.approx_count_distinct("n").alias("n"))
    cut = counted.withColumn("cut", F.pmod(F.xxhash64("pattern"), F.lit(64)))
    parts = cut.repartition("host", "cut").sortWithinPartitions("host", "cut", "pattern").select("host", "pattern", "n").mapInArrow(fold, ddl)
    whole = parts.repartition("host").sortWithinPartitions("host", "pattern").mapInArrow(fold, ddl)
    return stored(whole.select("host", F.col("pattern").alias("wrapper"), F.col("n").alias("n_pages")), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page, by the wrapper of its host.

    ``pages`` needs page_id, url, html. Columns: page_id, url, text, n_chars. A null or empty html, or one without main text, gives an empty
    text; pages without a host share one wrapper; rows may repeat.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host(F.col("url")))
    wrappers = checked_broadcast(infer_wrappers(rows).withColumnRenamed("host", "_host"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = []
            for page, wrapper, n in zip(*(part.column(c).to_pylist() for c in ("html", "wrapper", "n_pages"))):
                out.append(main_text(page or "", *reading(wrapper or "[]", n or 0)).encode("utf-8", "replace").decode())
            yield batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": out, "n_chars": list(map(len, out))}, schema)

    joined = rows.join(wrappers, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "wrapper", "n_pages")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
