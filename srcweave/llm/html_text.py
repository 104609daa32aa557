"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block-level element; text inside menus,
scripts, forms and the like leaves an empty line.  The text lengths of BLOCK
consecutive lines are summed over a sliding window.  Where the sum surges the
main text begins, where it dives to nothing it ends, and the lines between are
kept, with the lines before that are joined to them (a heading, a byline, a
short lead).  A page that marks its article has its text nowhere else: other lines
count as empty, and every line from the first surge to the last dive is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK = 3
# Characters in BLOCK lines from which an unmarked page's text is taken to begin.
SURGE = 86

# Elements whose text is not page text.
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "title", "select")
_ASIDE = frozenset("nav header footer aside form button menu dialog label fieldset datalist head".split())
# Words in a class, id or role that name something beside the article.
_BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices "
    "alert sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments reply replies discussion disqus "
    "related share sharing social newsletter subscribe popup modal footer header masthead widget complementary "
    "contentinfo search pagination pager toolbar".split()
)
# Elements that begin and end a line.
_LINES = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset(("article", "main"))

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[A-Za-z]+")


def _beside(name: str, rest: str) -> bool:
    """Whether an opening tag starts something beside the article."""
    if name in _ASIDE:
        return True
    if name in ("html", "body", *_MAIN) or "=" not in rest:
        return False
    found = " ".join(a or b or c for a, b, c in _NAMES.findall(rest)).lower()
    return not _BESIDE.isdisjoint(_WORD.findall(found))


def lines_of(page: str) -> tuple[list[str], list[bool], bool]:
    """Lines of a page in order, which of them lie in a marked article, and whether one is marked."""
    lines, inside, held = [], [], []
    skipped: list[tuple[str, int]] = []  # open elements beside the article: name and nesting of that name
    main = 0
    marked = False
    at = 0

    def end_line() -> None:
        lines.append(" ".join(html.unescape("".join(held)).split()) if held else "")
        inside.append(main > 0)
        held.clear()

    for tag in _TAG.finditer(page):
        if not skipped and tag.start() > at:
            held.append(page[at : tag.start()])
        at = tag.end()
        if tag["name"] is None:
            if tag["raw"] and tag["raw"].lower() == "title":
                end_line()
            continue
        name, closing = tag["name"].lower(), bool(tag["close"])
        if skipped:
            inner, depth = skipped[-1]
            if name in _MAIN and not closing and inner not in _ASIDE:
                skipped.clear()  # a wrapper only seemed to be beside the article
            elif name == inner:
                depth += -1 if closing else 0 if name in ("p", "li") else 1
                skipped[-1] = (inner, depth)
                if depth == 0:
                    skipped.pop()
                    continue
                if closing or name not in ("p", "li"):
                    continue
                skipped.pop()  # the next paragraph or list item ends one left open
            elif inner == "p" and name in _LINES and name != "br":
                skipped.pop()
            elif closing and name in ("body", "html") or closing and name in _MAIN and inner not in _ASIDE:
                skipped.clear()
            else:
                continue
        if name in _LINES:
            end_line()
        if name in _MAIN:
            main = max(0, main - 1) if closing else main + 1
            marked = True
        elif not closing and name not in _VOID and not tag["rest"].endswith("/") and _beside(name, tag["rest"]):
            end_line()
            skipped.append((name, 1))
    if not skipped:
        held.append(page[at:])
    end_line()
    return lines, inside, marked


def _zones(lengths: list[int], surge: int) -> list[tuple[int, int]]:
    """(first, last + 1) line of each stretch with a surge, from the dive before it to the next one."""
    sums = [sum(lengths[i : i + BLOCK]) for i in range(len(lengths))]
    found, i = [], 0
    dive = 0  # line behind the last dive
    while i < len(lengths):
        if not sums[i]:
            dive = i + 1
        if sums[i] > surge and lengths[i]:
            j = i
            while j < len(lengths) and sums[j]:
                j += 1
            found.append((next(k for k in range(dive, j) if lengths[k]), j))
            i = dive = j
        i += 1
    return found


def main_text(page: str | None) -> str:
    """Main text of one page: its lines joined by a blank; empty if there is none."""
    if not page:
        return ""
    lines, inside, marked = lines_of(page)
    if marked:
        lines = [x if own else "" for x, own in zip(lines, inside, strict=True)]
    lengths = [len(x) for x in lines]
    zones = _zones(lengths, 0 if marked else SURGE) or _zones(lengths, 0)  # a short page never surges
    return " ".join(x for x in lines[zones[0][0] : zones[-1][1]] if x) if zones else ""


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """Every row of `pages` with `text` (main text) and `n_chars` (its code points).

    A null or empty page, and one without main text, has an empty text.
    Columns of these names in the input are replaced.
    """
    kept = pages.drop(*({"text", "n_chars"} - {column}))
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=[*batch.schema.names, "text", "n_chars"],
            )

    return kept.mapInArrow(run, schema)
