"""Main text of web pages by the distribution of text over lines.

Markup is stripped to one line per block of the page. A line weighs what its
text is long; a line of menus, adverts, forms, comments and the like, told by
elements, roles, classes and ids, weighs nothing, and neither does one outside
the page's article, where it marks one. Nothing else is left out.
The lines that have weight are the text, however far apart or short they are.
Weights are summed over windows of consecutive lines; the sums surge where much
text lies together. They decide what marks alone can't: an `article` beside
which windows surge higher, over far more text, is a teaser and not the page's
article. An element whose name is as much that of a main part as that of
furniture (`main-widget`) is the text where nothing else has any weight.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column

WINDOW = 3
# How many times the text of a teaser the page's own text has, at least.
TEASER = 3

# Elements and names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style template noscript iframe object svg math canvas audio video select datalist".split())
_CHROME = frozenset("head nav header footer aside form menu dialog button textarea fieldset title search".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody tfoot thead title tr ul".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
# Words that a class or id of elements that are no part of an article consists of.
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside masthead footer cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe signup comment comments disqus respond replies reply share sharing social login "
    "widget banner topbar toolbar pagination pager".split()
)
# Of these, those of elements whose articles are comments, and words that may stand beside one.
_TALK = frozenset("comment comments disqus respond replies reply".split())
_BESIDE = frozenset(
    "area bar block body bottom box button buttons container form global icons inner item items left links list main "
    "outer page primary right secondary section site slot top unit wrap wrapper".split()
)

# Of these, those that stay what they are beside `main`.
_GUIDES = _TALK | frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer toolbar topbar cookie cookies consent".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
# Each attribute in turn, so that names are whole ones and values are passed over.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_NAMING = frozenset(("class", "id", "role"))
# Elements of other languages than HTML, which a slash at the end closes.
_FOREIGN = frozenset(("svg", "math"))
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Line:
    __slots__ = ("parts", "chrome", "main")

    def __init__(self):
        self.parts: list[str] = []
        self.chrome: tuple[_Chrome, ...] = ()
        self.main: tuple[_Chrome, ...] | None = None


class _Chrome:
    """An element that is no part of an article.

    That does not hold where an article lies inside and only its class or id
    says so, or it is a form, which may span a page, or it is never closed.
    """

    __slots__ = ("holds", "named", "talk", "doubt", "closed")

    def __init__(self, named: bool, talk: bool = False, doubt: bool = False):
        self.holds, self.named, self.talk, self.doubt, self.closed = True, named, talk, doubt, False


def _inside(chrome: tuple[_Chrome, ...]) -> bool:
    return any(c.holds for c in chrome)


def lines_of(page: str) -> tuple[list[tuple[str, bool, bool, bool]], bool, bool]:
    """(text, chrome, in the article, chrome in doubt) of each block in page order; whether an article and whether a main part is marked."""
    lines: list[_Line] = []
    line = _Line()
    whole = False
    # Open elements: name, the chrome around, the chrome around the article that it is in.
    stack: list[tuple[str, tuple[_Chrome, ...], tuple[_Chrome, ...] | None]] = []
    mains: list[tuple[_Chrome, ...]] = []
    at = 0

    def text(piece: str) -> None:
        chrome, main = stack[-1][1:] if stack else ((), None)
        nonlocal line
        if line.parts and (line.chrome, line.main) != (chrome, main):
            lines.append(line)
            line = _Line()
        line.chrome, line.main = chrome, main
        line.parts.append(html.unescape(piece))

    def ends() -> None:
        nonlocal line
        if line.parts:
            lines.append(line)
            line = _Line()

    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            break
        if tag.start() > at:
            text(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                text(tag[0][9:].removesuffix("]]>"))
            continue
        if name in _BLOCKS:
            ends()
        if tag["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if len(stack[k][1]) > (len(stack[k - 1][1]) if k else 0):
                        stack[k][1][-1].closed = True
                    del stack[k:]
                    break
            continue
        if name in ("br", "td", "th", "img"):
            text(" ")
        if name in _VOID:
            continue
        if name in _FOREIGN and tag["rest"].endswith("/"):
            continue
        if name in _SKIPPED:
            close = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in _BLOCKS:
            _close_implied(stack, name)
        chrome, main = stack[-1][1:] if stack else ((), None)
        roles, own, doubt = _names(tag["rest"])
        is_main = name in ("article", "main") or "main" in roles
        named = False
        if name not in ("html", "body"):
            if name in _CHROME or roles & _ROLES:
                chrome = (*chrome, _Chrome(name == "form" and not roles & _ROLES))
            elif own and name != "main":
                named = True
                chrome = (*chrome, _Chrome(True, bool(own & _TALK), doubt))
        if is_main and not named:
            for c in chrome:
                c.holds = c.holds and (c.talk or not c.named)
            main = chrome
            mains.append(chrome)
            whole = whole or (name != "article" and not _inside(chrome))
        if not tag["rest"].endswith("/") or name in _BLOCKS:
            stack.append((name, chrome, main))
    if at < len(page):
        text(page[at:])
    ends()
    for c in (c for m in mains for c in m if not c.closed and not c.talk):
        c.holds = False
    if all(_inside(m) for m in mains):
        # The only article lies in what else would be comments.
        for c in (c for m in mains for c in m if c.talk):
            c.holds = False
    found = ((" ".join("".join(x.parts).split()), x) for x in lines)
    marked = not all(_inside(m) for m in mains)
    lines_ = [
        (t, _inside(x.chrome), x.main is not None and not _inside(x.main), all(c.doubt for c in x.chrome if c.holds)) for t, x in found if t
    ]
    return lines_, marked, whole


def _close_implied(stack: list[tuple], name: str) -> None:
    """Close the paragraph, list item or the like that the start of a block ends."""
    if stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "a", "u", "font"):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in _BLOCKS:
                if stack[k][0] == "p":
                    del stack[k:]
                break
    if stack and name in ("li", "dt", "dd", "tr", "option") and stack[-1][0] == name:
        stack.pop()


def _names(attributes: str) -> tuple[set[str], set[str], bool]:
    """Roles, the words of _NAMES that name the element, and whether `main` stands beside each of them.

    Words name it where a class or id holds no words but those of _NAMES and _BESIDE.
    """
    roles: set[str] = set()
    own: set[str] = set()
    doubt, seen = True, set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        kind, value = name.lower(), a or b or c
        if kind not in _NAMING or kind in seen:
            continue
        # Of attributes that repeat, the first counts.
        seen.add(kind)
        if kind == "role":
            roles.add(value.strip().lower())
            continue
        for name in value.split():
            words = {x.lower() for x in _NAME.findall(name)}
            if words <= _NAMES | _BESIDE and words & _NAMES:
                own |= words & _NAMES
                doubt = doubt and "main" in words
    return roles, own, doubt and bool(own) and not own & _GUIDES


def main_text(page: str | None, window: int = WINDOW) -> str:
    """The page's main text: its blocks, joined by two line ends."""
    lines, marked, whole = lines_of(page or "")
    free = [0 if chrome else len(text) for text, chrome, _, _ in lines]
    weights = free
    if marked:
        weights = [n if main else 0 for n, (_, _, main, _) in zip(free, lines)]
        beside = [n - k for n, k in zip(free, weights)]
        if not whole and sum(beside) >= TEASER * sum(weights) and max(_sums(beside, window)) > max(_sums(weights, window)):
            weights = free
    if not any(weights):
        weights = [len(text) if doubt else 0 for text, _, _, doubt in lines]
    return "\n\n".join(text for (text, _, _, _), weight in zip(lines, weights) if weight)


def _sums(weights: list[int], window: int) -> list[int]:
    """Sums over windows that begin before the first line and end behind the last."""
    padded = [0] * (window - 1) + weights + [0] * (window - 1)
    total, sums = sum(padded[:window]), []
    for k in range(len(weights) + window - 1):
        sums.append(total)
        if k + window < len(padded):
            total += padded[k + window] - padded[k]
    return sums


def extract(pages: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The key columns, text and n_chars (code points) of every page; a null page counts as empty, no text is ''.

    Equal rows give equal rows, null keys stay null, further columns are not read. Pages are read where they lie, without a shuffle.
    """
    source = pages.select(*(column(pages, k).alias(k) for k in keys), column(pages, html_col).cast("string").alias("html_"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch["html_"]]
            columns = [batch[k] for k in keys]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "text", "n_chars"])

    return source.mapInArrow(read, f"{kinds}, text string, n_chars long")
