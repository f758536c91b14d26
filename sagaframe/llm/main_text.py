"""HTML extraction (operator 9): consensus host paths.

Each page is read into blocks with the path of the container they stand in; a path is made of tags and their classes, digits
generalised. A page scores its containers: a block gives its text, less its link text, to its own container and half of that to
the next one. The page votes for its best container, or for one around it whose further text is no small part of the whole (an article
cut into several containers). Votes are summed over a host's pages in Spark, and every page is extracted again with the best path of
all its host's paths that it has, however many there are, with the headings that stand before it in the containers around it.

What is never text: scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts, reader comments (by tag, or by
the words of class, id and role), comments and other markup. Names of paragraphs and inline elements count only where they name adverts,
notices or comments: a paragraph of tags or a highlighted search word is text.

The table of paths goes to all workers if it has MOST_BYTES at most; beyond that the pages' own short lists of paths are joined with it,
by host and path, and each page with its choice, by a hash of the whole row, so that no host is one task's.

Defined results: null and empty html give an empty text, as do pages without text; unclosed or truncated tags end where HTML ends
them or at the end; very long pages are read whole; null and odd urls share the empty host; repeated rows give equal rows; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.session import cut, prepare, spread

#: Bytes up to which the table of the hosts' paths is sent to all workers.
MOST_BYTES = 16 << 20
#: Share of a container's text that its neighbours must add for the vote to go to the container around them.
WIDER = 0.5

# Element names of HTML by what they are for.
RAW = "script style noscript template iframe textarea title select xmp noembed noframes object".split()
SKIPPED = frozenset("nav header footer aside form dialog menu button head audio video canvas fieldset".split())
CONTAINERS = frozenset("body main article section div td center blockquote".split())
BLOCKS = CONTAINERS | SKIPPED | frozenset("html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption pre hr figure figcaption address details summary".split())
#: Elements whose names tell what they are for; others hold text.
STRUCTURE = CONTAINERS | SKIPPED | frozenset("ul ol dl table tr li figure details".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role names that mark what is not the article.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "header masthead topbar footer bottombar sidebar aside side rail widget widgets related recommended recommendations cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login paywall comment comments commentlist disqus replies reply respond share sharing social "
    "search form complementary contentinfo toolbar pagination pager tags skip".split()
)
#: Those that count for paragraphs and inline elements, too.
NOISE_ANYWHERE = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo cookie cookies consent gdpr notice notices newsletter comment comments".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: First words of class names that tell how a wrapper is laid out, not what it is.
LAYOUT = frozenset("has with without no is not layout".split())
#: An article or main element is left out only for these.
NOT_ARTICLE = frozenset("ad ads advert advertisement sponsored promo related comment comments reply".split())
GOOD = frozenset("article content entry story post main text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"(?<![-\w])(class|id|role)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def _attributes(tag: str, raw: str) -> tuple[str, bool]:
    """Name of the path step, and whether the element is not part of any article."""
    name, skip = tag, tag in SKIPPED
    if raw and not raw.isspace():
        for m in _ATTR.finditer(raw):
            kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if kind == "class":
                name += "".join("." + _DIGITS.sub("0", c) for c in sorted(set(value.split())))
            if kind in ("class", "id", "role") and tag not in ("body", "html"):
                bad = NOT_ARTICLE if tag in ("article", "main") else NOISE if tag in STRUCTURE else NOISE_ANYWHERE
                for part in value.split():
                    words = [w.lower() for w in _NAME.findall(part)]
                    skip |= bool(words) and words[0] not in LAYOUT and not bad.isdisjoint(words)
    return name, skip


def blocks_of(page: str | None) -> list[tuple[str, str, int, bool]]:
    """(container path, text, length of link text, whether a heading) of each block in page order."""
    page = page or ""
    out: list[tuple[str, str, int, bool]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, container path, skipped
    parts: list[str] = []
    link_from, linked = -1, 0
    at = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((stack[-1][1], text, linked, stack[-1][0] in HEADINGS) if stack else ("", text, linked, False))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at and not (stack and stack[-1][2]):
            parts.append(page[at : m.start()])
            if link_from >= 0:
                linked += m.start() - at
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        ends = (m[2] or m[5]) == "/"
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            link_from = -1 if ends else at
        if tag not in BLOCKS and not (stack and stack[-1][2]):
            if not ends and tag not in VOID and tag != "a":
                raw = m[4] or m[7] or ""
                if raw and not raw.isspace() and not raw.endswith("/") and _attributes(tag, raw)[1]:
                    stack.append((tag, stack[-1][1] if stack else "", True))
            continue
        if tag not in BLOCKS:  # inside a skipped element: only its own kind can nest or end it
            if stack[-1][0] == tag:
                if ends:
                    stack.pop()
                elif tag not in VOID:
                    stack.append(stack[-1])
            continue
        close()
        link_from = -1
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()  # no block stands in a paragraph
        if tag in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == tag:
            stack.pop()
        name, skip = _attributes(tag, m[4] or m[7] or "")
        path, skipped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        if tag in CONTAINERS:
            path = f"{path}>{name}" if path else name
        stack.append((tag, path, skipped or skip))
    if not (stack and stack[-1][2]):
        parts.append(page[at:])
    close()
    return out


def worth(text: str, linked: int) -> float:
    return float(max(0, len(text) - 2 * linked))


def good_name(path: str) -> bool:
    return not GOOD.isdisjoint(w.lower() for w in _NAME.findall(path.rpartition(">")[2]))


def scores(blocks: list[tuple[str, str, int, bool]]) -> dict[str, float]:
    """Score of each container path of a page."""
    out: dict[str, float] = {}
    for path, text, linked, _ in blocks:
        value = worth(text, linked)
        for share in (1.0, 0.5):
            bonus = 4.0 if path.rpartition(">")[2].split(".")[0] in ("article", "main") else 2.0 if good_name(path) else 1.0
            out[path] = out.get(path, 0.0) + share * bonus * value
            path = path.rpartition(">")[0]
            if not path:
                break
    return out


def vote(blocks: list[tuple[str, str, int, bool]]) -> tuple[str, float] | None:
    """The path that a page votes for, and with what score."""
    found = scores(blocks)
    top = min(found, key=lambda p: (-found[p], len(p), p), default=None)
    if top is None or found[top] <= 0:
        return None
    inside = lambda p: sum(worth(t, n) for q, t, n, _ in blocks if q == p or q.startswith(f"{p}>"))
    path, held = top, inside(top)
    while path and path.rpartition(">")[2].split(".")[0] not in ("article", "main"):
        around = next((a for a in ancestors(path) if inside(a) - held >= held * (1.0 if good_name(path) else WIDER)), None)
        if around is None:
            break
        path, held = around, inside(around)
    return path, found[top]


def ancestors(path: str) -> list[str]:
    """The paths of the containers around one, innermost first."""
    out = []
    while path := path.rpartition(">")[0]:
        out.append(path)
    return out


def paths_of(blocks: list[tuple[str, str, int, bool]]) -> set[str]:
    """All containers that hold text."""
    return {q for p in {b[0] for b in blocks} for q in (p, *ancestors(p))}


def extract(blocks: list[tuple[str, str, int, bool]], path: str | None) -> str:
    """Blocks in and under a path, joined by line ends, after the headings that stand before them around it; without a path by the page's own vote."""
    if path is None:
        path = (vote(blocks) or ("",))[0]
    under = f"{path}>"
    at = [i for i, b in enumerate(blocks) if b[0] == path or b[0].startswith(under) or not path]
    around = {*ancestors(path), ""}
    heads = [b[1] for b in blocks[: at[0]] if b[3] and b[0] in around] if at else []
    return "\n".join(heads + [blocks[i][1] for i in at])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, str], list[float]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if top := vote(blocks_of(page)):
                s = sums.setdefault((host, top[0]), [0, 0.0])
                s[0] += 1
                s[1] += top[1]
        rows = [(h, p, int(n), v) for (h, p), (n, v) in sums.items()]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.float64()), strict=True)], names=["host", "path", "pages", "score"])


def _texts(ranks=None):
    """Over rows (id, url, html, host or, without the table of ranks, the path): texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, way in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                blocks = blocks_of(page)
                if ranks is not None:
                    known = ranks.value.get(way, {})
                    way = min((p for p in paths_of(blocks) if p in known), key=known.__getitem__, default=None)
                texts.append(extract(blocks, way))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return run


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [sorted(paths_of(blocks_of(page))) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(paths, pa.list_(pa.string()))], names=["key", "host", "paths"])


def host_of(url):
    """Lower-case host of a url column without www. and port; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:\s]*)", 1)
    return F.coalesce(host, F.lit(""))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text."""
    prepare(pages.sparkSession)
    rows = spread(pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))).withColumn("host", host_of(F.col("url")))
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string, pages long, score double").groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("score").alias("score"))
    rank = Window.partitionBy("host").orderBy(F.col("score").desc(), F.col("path"))
    ranked = cut(votes.select("host", "path", F.row_number().over(rank).alias("rank")))
    schema = "id long, url string, text string"
    size = ranked.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16).alias("n")).first().n or 0
    if size <= MOST_BYTES:
        table: dict[str, dict[str, int]] = {}
        for r in ranked.toLocalIterator():
            table.setdefault(r.host, {})[r.path] = r["rank"]
        return rows.select("id", "url", "html", "host").mapInArrow(_texts(pages.sparkSession.sparkContext.broadcast(table)), schema)
    keyed = rows.withColumn("key", F.xxhash64("id", "url", "html"))
    own = keyed.select("key", "host", "html").mapInArrow(_paths, "key long, host string, paths array<string>").dropDuplicates(["key"])
    choice = own.select("key", "host", F.explode("paths").alias("path")).join(ranked, ["host", "path"]).groupBy("key").agg(F.min_by("path", "rank").alias("way"))
    return keyed.join(choice, "key", "left").select("id", "url", "html", "way").mapInArrow(_texts(), schema)
