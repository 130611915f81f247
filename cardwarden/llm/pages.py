"""Main text of web pages by consensus of each host's container paths.

First every page is scored by itself: its blocks of text are weighed, and the highest
container that has nothing but furniture and links beside it gets the page's vote, as a
path of tags and classes with numbers generalised. A name alone makes no furniture of an
element that is the page's text. Votes are counted for each host in Spark, and
the pages are read again with the host's winning paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import stored

#: Share of a host's votes that a path needs to win; so a host has at most ten winners.
WINS = 0.1
#: Share of a page's own weight that a winner must hold to be taken.
HOLDS = 0.5
#: A named element is text after all if it holds this share of the page's text, and the
#: page has nothing but this share of it elsewhere, outside of all furniture.
MOST, ELSEWHERE = 0.5, 0.1
#: Letters of text for each control of a form that is not mostly controls.
LETTERS_A_CONTROL = 80
#: Weight of text inside article and main.
MEANT = 3

# Fixed names of the HTML standard.
_RAW = "script|style|noscript|template|iframe|svg|textarea|select|object|canvas|math"
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main"
    " menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_CONTAINERS = set("article body center div dl main ol section table tbody td th tr ul".split())
_PARTS_OUT = set("button dialog footer head input label menu nav option title".split())
_PARTS_DOUBTED = {"aside", "form"}
_CONTROLS = set("button input label option select textarea".split())
_TEXT_ROOTS = {"article", "main", "h1"}
_TITLES = {"main", "h1"}
# Words that name a page's furniture in classes, ids and roles.
_NAMES_OUT = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs captcha comment"
    " comments consent contentinfo cookie cookies copyright dialog disclaimer discussion"
    " disqus footer gdpr legal login masthead menu modal nav navbar navigation newsletter"
    " notice notices notification pager pagination popup privacy promo promotion related"
    " recommended replies reply search share sharing sidebar signup skip social sponsor"
    " sponsored subscribe subscription toolbar widget widgets".split()
)
# Those of them that never name an article: what readers and the site say beside it.
_ASIDE_NAMES = set(
    "ad ads advert advertisement adverts captcha comment comments consent cookie cookies"
    " discussion disqus gdpr notice notices replies reply".split()
)
_HEADERS = {"header", "topbar"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CONTENT = set("article body container content layout main page post story wrap wrapper".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([\w-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _furniture(tag: str, have: dict[str, str], in_article: bool) -> str:
    """``sure``, ``form``, ``named`` or ``beside`` for an element that may be furniture."""
    if tag in _PARTS_OUT:
        return "sure"
    if tag in _PARTS_DOUBTED:
        return "form" if tag == "form" else "named"
    if tag == "header" and not in_article:
        return "named"
    if not have:
        return ""
    style = have.get("style", "").replace(" ", "").lower()
    if "hidden" in have or have.get("aria-hidden") == "true" or "display:none" in style:
        return "sure"
    if tag in ("html", "body", "main", "article"):
        return ""
    named = " ".join(have.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in _WORD.findall(named)}
    if words & _CONTENT and not words & {"comment", "comments"}:
        return ""
    if words & _ASIDE_NAMES:
        return "beside"
    return "named" if words & _NAMES_OUT or (words & _HEADERS and not in_article) else ""


class _Doubted:
    """An element that its tag or name makes furniture, unless it is the page's text."""

    def __init__(self, kind: str, above: _Doubted | None) -> None:
        self.kind, self.above = kind, above
        self.letters = self.controls = 0
        self.tags: set[str] = set()

    def line(self) -> Iterator[_Doubted]:
        """Itself and those around it."""
        at: _Doubted | None = self
        while at is not None:
            yield at
            at = at.above


def _opened(blocks: list[tuple], doubted: list[_Doubted]) -> set[_Doubted]:
    """The doubted elements that are text after all, from the outermost inward.

    One holds most of the page's text, in blocks and not in links, and the rest of the
    page has hardly any outside furniture, or it has the article, main part or first
    heading. A form must not be mostly controls, and what is named as comments, notices or
    adverts must have the main part or first heading, since readers write articles, too.
    """
    plain = 0
    for _, text, linked, _, inside in blocks:
        letters = max(0, len(text) - 2 * linked)
        plain += letters if inside is None else 0
        for element in inside.line() if inside is not None else ():
            element.letters += letters
    whole = plain + sum(x.letters for x in doubted if x.above is None)
    opened: set[_Doubted] = set()
    for x in doubted:
        if x.letters <= MOST * whole or (x.above is not None and x.above not in opened):
            continue
        if x.kind == "form" and x.letters < LETTERS_A_CONTROL * x.controls:
            continue
        if x.tags & (_TITLES if x.kind == "beside" else _TEXT_ROOTS):
            opened.add(x)
        elif x.kind != "beside" and plain <= ELSEWHERE * x.letters:
            opened.add(x)
    return opened


def _name(tag: str, have: dict[str, str]) -> str:
    kinds = [re.sub(r"\d+", "#", c) for c in have.get("class", "").split()[:2]]
    return ".".join([tag, *sorted(kinds)])


def blocks(html: str) -> list[tuple[str, str, int, str]]:
    """Path, text, characters inside links and tag of each block that is no furniture.

    A container's path is its own and its parents' names. Unclosed and misnested tags
    are taken as browsers do in broad terms: an end tag closes what is open inside, and
    one without a start counts for nothing.
    """
    out: list[tuple[str, str, int, str, _Doubted | None]] = []
    doubted: list[_Doubted] = []
    # Tag, path, whether it is furniture for sure, the doubted element it stands in, and the
    # text of the block around it, which goes on behind it.
    stack: list[tuple[str, str, bool, _Doubted | None, tuple | None]] = [("", "", False, None, None)]
    held: list[str] = []
    linked, in_link, at = 0, False, 0

    def close_block() -> None:
        nonlocal linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append((stack[-1][1], text, min(linked, len(text)), stack[-1][0], stack[-1][3]))
            held.clear()
        linked = 0

    def note(tag: str) -> None:
        for element in stack[-1][3].line() if stack[-1][3] is not None else ():
            element.controls += tag in _CONTROLS
            element.tags.add(tag)

    def leave(to: int) -> None:
        nonlocal linked
        while len(stack) > to:
            if stack[-1][4] is not None or stack[-1][0] in _BLOCKS:
                close_block()
            around = stack.pop()[4]
            if around is not None:
                held[:], linked = around

    for m in _TOKEN.finditer(html):
        if m.start() > at and not stack[-1][2]:
            held.append(html[at : m.start()])
            linked += (m.start() - at) * in_link
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1] and m[1].lower() in _CONTROLS:
                note(m[1].lower())
            continue
        ends = bool(m[2] or m[5])
        if tag == "a":
            in_link = not ends
        if tag == "br" and not stack[-1][2]:
            held.append(" ")
        if tag in _BLOCKS:
            close_block()
        if ends:
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if where:
                leave(where)
            continue
        if tag in _BLOCKS and stack[-1][0] == "p" or tag == stack[-1][0] == "li":
            stack.pop()
        if tag == "body":
            leave(next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "html"), 0) + 1)
        if tag in _VOID or m[4] is not None and m[4].endswith("/"):
            if tag in _CONTROLS:
                note(tag)
            continue
        given = m[4] if m[4] is not None else m[7]
        have = _attributes(given) if given and given.strip() else {}
        path = stack[-1][1]
        in_article = "/article" in path or "/main" in path
        kind, within = _furniture(tag, have, in_article), stack[-1][3]
        furniture = stack[-1][2] or kind == "sure"
        if tag in _CONTROLS or tag in _TEXT_ROOTS:
            note(tag)
        around = None
        if kind and not furniture:
            within = _Doubted(kind, within)
            doubted.append(within)
            if tag not in _BLOCKS:
                around = held.copy(), linked
                held.clear()
                linked = 0
        if tag in _CONTAINERS:
            path = f"{path}/{_name(tag, have)}"
        if tag in _BLOCKS or furniture != stack[-1][2] or within is not stack[-1][3]:
            stack.append((tag, path, furniture, within, around))
    if not stack[-1][2]:
        held.append(html[at:])
    close_block()
    leave(1)
    close_block()
    opened = _opened(out, doubted)
    return [x[:4] for x in out if x[4] is None or all(y in opened for y in x[4].line())]


def _under(path: str, container: str) -> bool:
    return path == container or path.startswith(f"{container}/")


def _weight(path: str, text: str, linked: int) -> int:
    """Letters outside of links, more of them in an article or main part."""
    value = max(0, len(text) - 2 * linked)
    return value * MEANT if "/article" in path or "/main" in path else value


def vote(found: list[tuple[str, str, int, str]]) -> str:
    """The highest path that has only furniture beside it; of none, the whole page.

    From the whole page down, a container is entered as long as what stays outside is
    mostly links. Nothing is entered past an h1, a heading or text of the parent's own,
    and an article is taken whole.
    """
    worth = [(path, _weight(path, text, linked), tag) for path, text, linked, tag in found]
    least = sum(value for _, value, _ in worth)
    at = ""
    while at.rpartition("/")[2].partition(".")[0] != "article":
        weight: dict[str, int] = {}
        for path, value, tag in worth:
            if path != at:
                inner = f"{at}/{path[len(at) + 1 :].partition('/')[0]}"
                weight[inner] = weight.get(inner, 0) + value
            elif value or tag in _HEADINGS:
                return at
        into = max(weight, key=lambda p: (weight[p], p), default="")
        if not weight.get(into) or weight[into] < least:
            return at
        if any(tag == "h1" and not _under(path, into) for path, _, tag in worth):
            return at
        worth = [x for x in worth if _under(x[0], into)]
        at = into
    return at


def read_main(html: str, winners: list[str]) -> tuple[str, str]:
    """Text by the first winning path that holds most of the page, or by its own vote; the path.

    A page whose own vote is a container around the winning path is read by its own, as
    there is more than furniture beside the winner.
    """
    found = blocks(html)
    own = vote(found)
    whole = sum(_weight(p, text, linked) for p, text, linked, _ in found)
    for path in winners:
        held = [_weight(p, text, linked) for p, text, linked, _ in found if _under(p, path)]
        if held and sum(held) >= HOLDS * whole:
            own = own if _under(path, own) else path
            break
    return "\n".join(t for p, t, *_ in found if _under(p, own)), own


def extract(pages: DataFrame, keys: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """``keys`` with text, n_chars and path: the main text of every page.

    A null or empty html has an empty text; so has a page of furniture only. A page
    without an address, or with one without a host, is read by its own best path. Hosts
    are compared in lower case. Repeated pages vote each. Of paths with equal votes the
    deeper wins, then the later by name. Whole pages are read, of any length. Votes are
    counted before their shuffle. The winners are a stored table, at most ten paths a host,
    so Spark broadcasts them if their files are small; beyond that html is shuffled by
    host, and adaptive execution splits a host with a third of all pages.
    """
    rows = pages.select(
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(keys)),
        F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)).alias("host"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [vote(blocks(x.as_py())) for x in batch.column(1)]
            columns = [batch.column(0), pa.array(paths, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path"])

    known = rows.where(F.length("host") > 0).select("host", "html")
    counts = known.mapInArrow(votes, "host string, path string").groupBy("host", "path").count()
    counts = stored(counts, "votes")
    of_host = counts.groupBy("host").agg(F.sum("count").alias("pages"))
    order = F.struct("count", F.size(F.split("path", "/")).alias("depth"), "path")
    winners = (
        counts.where(F.col("path") != "")
        .join(of_host, "host")
        .where(F.col("count") >= WINS * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(order), asc=False).getField("path").alias("winners"))
    )
    winners = stored(winners, "winners")
    n = len(keys)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                read_main(x.as_py(), w.as_py() or [])
                for x, w in zip(batch.column(n), batch.column(n + 1), strict=True)
            ]
            text, path = ([x[i] for x in found] for i in (0, 1))
            columns = [*batch.columns[:n], pa.array(text, pa.string())]
            columns += [pa.array([len(x) for x in text], pa.int64()), pa.array(path, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "text", "n_chars", "path"])

    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keys)
    ready = rows.join(winners, "host", "left")
    ready = ready.select(*(f"k{i}" for i in range(n)), "html", "winners")
    return ready.mapInArrow(read, f"{kept}, text string, n_chars long, path string")
