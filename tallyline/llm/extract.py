"""Main text of web pages with a site style tree.

Each page is read into branches: a branch is a path of block elements with their classes. All pages of a host are merged into the
host's style tree: per branch, how many pages have it and with which contents. A branch's importance is the entropy of its contents
over its pages, and that of its presentation (how the branch's children are laid out), whichever is larger, divided by the logarithm
of the number of pages: 1 if every page differs, 0 if all are alike. It is smoothed by DOUBT pages of importance 1, so that few pages
say little and no size of a host is treated differently. Branches with a class or id of their own whose importance is below
`threshold` are site furniture and cut from every page.

Entropy alone cannot tell furniture that rotates from an article that does not, and needs many pages of a host. So elements whose tag,
role or class names their purpose (menus, headers, footers, sidebars, notices, adverts, forms, comments) are cut too. A class or id names
it by a word, or by a part of a compound word (`site-header`, `commentList`), but not where the compound tells a state of the page
(`has-sidebar`, `no-comments`). Some names are also used for what surrounds the text itself (DOUBTFUL): such an element is cut only
if it holds no more than half of the text of its article, or else of the page. A marked article below such an element is kept if it
holds more text than all that lies outside of such elements. On pages that mark their article only the article is kept, unless text
elements and sentences outside hold more text than it. Plain text elements (paragraphs, headings, lists) are never cut by entropy.

Text: character references are decoded, white space within a block becomes one space, blocks are trimmed and joined in page order by
one line end, empty blocks fall away. Unclosed elements end where the next block or their parent ends.

Defined results: null or empty html gives an empty text; a null url counts as the host ''. Pages of any length are read whole. Rows that
share a page_id, or have none, are pages of their own; repeated rows get equal results. Where an article and the text outside hold
the same, the article is kept. Extra columns are not read. The table of cut branches is joined by host, broadcast only after it was counted and found small.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.store import small_or_not, written
from tallyline.llm.urlfilter import host_of

THRESHOLD, DOUBT = 0.1, 2.0
#: Elements nested deeper belong to the branch of their ancestor at this depth.
DEEPEST = 64

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|object|svg|xmp|noembed|noframes"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS_ITEMS = frozenset("ul ol menu dir dl table select".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tfoot tr td th figure figcaption caption".split())
FURNITURE = frozenset("nav header footer aside form head button select menu dialog input datalist".split())
ARTICLE = frozenset(("article", "main"))
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar menu menus nav navbar "
    "navigation breadcrumb breadcrumbs header footer masthead cookie cookies notice notices consent gdpr popup modal newsletter subscribe "
    "social share sharing related comment comments disqus reply replies widget widgets form login search toolbar pagination pager "
    "copyright disclaimer alert".split()
)
DOUBTFUL = frozenset(
    "alert banner banners form header masthead notice notices promo promotion related share sharing sidebar social widget widgets".split()
)
STATES = frozenset("disabled enabled fixed has hide is no none not open show sticky with without".split())
#: Words of text outside of text elements from which it counts as a sentence.
SENTENCE = 5
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Block(NamedTuple):
    """Text of one block; its branch and those above it that may be cut; furniture by purpose; within a marked article; that article
    lies within furniture; the doubtful elements around it, by their numbers."""

    text: str
    branches: tuple[str, ...]
    furniture: bool
    article: bool
    inside: bool
    doubtful: tuple[int, ...] = ()


class _Open(NamedTuple):
    tag: str
    branches: tuple[str, ...]
    furniture: bool
    article: bool
    inside: bool
    doubtful: tuple[int, ...] = ()


def _attributes(more: str) -> dict[str, str]:
    return {k.lower(): (a or b or c).strip() for k, a, b, c in _ATTRIBUTE.findall(more)} if "=" in more else {}


def purposes(names: str) -> set[str]:
    """What the words of a class or id, or the parts of compound ones, say an element is for."""
    found: set[str] = set()
    for name in names.split():
        parts = {p.lower() for p in _PART.findall(name)} | {name.lower()}
        if STATES.isdisjoint(parts):
            found |= parts & FURNITURE_NAMES
    return found


def _opened(tag: str, more: str, above: _Open, number: int) -> _Open:
    found = _attributes(more)
    named = " ".join((found.get("class", ""), found.get("id", "")))
    names = named.lower()
    inside = above.inside or (tag in ARTICLE and (above.furniture or bool(above.doubtful)))
    furniture = (above.furniture and tag not in ARTICLE) or tag in FURNITURE or found.get("role", "").lower() in FURNITURE_ROLES
    doubtful = () if tag in ARTICLE else above.doubtful
    if names.strip() and tag not in ARTICLE and tag not in ("html", "body") and not re.fullmatch("h[1-6]", tag):
        purpose = purposes(named)
        furniture = furniture or bool(purpose - DOUBTFUL)
        doubtful = (*doubtful, number) if purpose & DOUBTFUL else doubtful
    branches = above.branches
    if tag in BLOCK and tag not in ("html", "body") and len(branches) < DEEPEST:
        own = tag + "".join(f".{n}" for n in sorted(set(names.split())))
        own = own if len(own) <= 60 else f"{tag}.{xxhash.xxh3_64_hexdigest(own)}"
        branches = (*branches, f"{branches[-1] if branches else ''}/{own}")
    return _Open(tag, branches, furniture, above.article or tag in ARTICLE, inside, doubtful)


def blocks_of(page: str) -> list[Block]:
    """All non-empty blocks of a page in page order."""
    root = _Open("", (), False, False, False)
    stack, text, found, at = [root], [], [], 0

    def close_block() -> None:
        joined = " ".join(references.unescape("".join(text)).split())
        text.clear()
        if joined:
            top = stack[-1]
            found.append(Block(joined, top.branches, top.furniture, top.article, top.inside, top.doubtful))

    def pop_to(depth: int) -> None:
        below = stack[depth - 1]
        if any(o.tag in BLOCK or (o.furniture, o.doubtful) != (below.furniture, below.doubtful) for o in stack[depth:]):
            close_block()
        del stack[depth:]

    for token in _TOKEN.finditer(page):
        text.append(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
                if tag not in BLOCK and stack[depth].tag in BLOCK:
                    break  # an inline element does not end beyond its block
            continue
        if tag in VOID:
            if tag == "hr":
                close_block()
            else:
                text.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            close_block()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    pop_to(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
            ends = ENDS_ITSELF.get(tag, ())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    pop_to(depth)
                    if tag != "tr":
                        break
                elif stack[depth].tag in HOLDS_ITEMS:
                    break
        new = _opened(tag, token["more"] or "", stack[-1], token.start())
        if (new.furniture, new.doubtful) != (stack[-1].furniture, stack[-1].doubtful):
            close_block()
        stack.append(new)
    text.append(page[at:])
    pop_to(1)
    close_block()
    return found


def can_be_cut(branch: str) -> bool:
    """Text elements without a class or id carry the article itself and stay."""
    last = branch.rpartition("/")[2]
    return last not in TEXTUAL and last.partition(".")[0] not in ARTICLE


def main_text(page: str, cut: frozenset[str] = frozenset()) -> str:
    blocks = [b for b in blocks_of(page) if not b.furniture and cut.isdisjoint(b.branches)]

    def size(some: Iterable[Block]) -> int:
        return sum(len(b.text) for b in some)

    if any(b.doubtful for b in blocks):
        whole, article = size(blocks), size(b for b in blocks if b.article)
        within = {k: [b for b in blocks if k in b.doubtful] for k in {k for b in blocks for k in b.doubtful}}
        cuts = {k for k, some in within.items() if 2 * size(some) <= (article if some[0].article else whole)}
        blocks = [b for b in blocks if cuts.isdisjoint(b.doubtful)]
    if size(b for b in blocks if b.inside) <= size(b for b in blocks if not b.inside):
        blocks = [b for b in blocks if not b.inside]
    articles = [b for b in blocks if b.article]
    outside = (b for b in blocks if not b.article)
    plain = (b for b in outside if b.text.count(" ") >= SENTENCE - 1 or (b.branches and b.branches[-1].rpartition("/")[2] in TEXTUAL))
    if articles and size(articles) >= size(plain):
        blocks = articles
    return "\n".join(b.text for b in blocks)


def site_branches(pages: DataFrame) -> DataFrame:
    """(host, branch, pages, importance) of all branches that may be cut, over all pages; importance is not smoothed."""

    def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str, int, int], int] = {}
            for host, page in zip(batch["host"], batch["html"], strict=True):
                inside: dict[str, list[Block]] = {}
                for block in blocks_of(page):
                    for branch in block.branches:
                        if can_be_cut(branch) and not block.furniture:
                            inside.setdefault(branch, []).append(block)
                for branch, blocks in inside.items():
                    content = xxhash.xxh3_64_intdigest("\n".join(b.text for b in blocks)) >> 1
                    layout = xxhash.xxh3_64_intdigest("\n".join(b.branches[-1] for b in blocks)) >> 1
                    key = (host, branch, content, layout)
                    seen[key] = seen.get(key, 0) + 1
            rows = [(*k, n) for k, n in seen.items()]
            yield pd.DataFrame(rows, columns=["host", "branch", "content", "layout", "n"])

    seen = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html")).mapInPandas(
        observe, "host string, branch string, content long, layout long, n long"
    )
    key = ["host", "branch"]
    seen = seen.groupBy(*key, "content", "layout").agg(F.sum("n").alias("n"))

    def entropy(kind: str) -> DataFrame:
        kinds = seen.groupBy(*key, kind).agg(F.sum("n").alias("n")).groupBy(*key)
        total = F.sum("n")
        return kinds.agg(total.alias("pages"), (F.log(total) - F.sum(F.col("n") * F.log("n")) / total).alias(f"{kind}_entropy"))

    both = entropy("content").join(entropy("layout").drop("pages"), key)
    most = F.greatest("content_entropy", "layout_entropy")
    return both.select(*key, "pages", F.when(F.col("pages") > 1, most / F.log("pages")).otherwise(1.0).alias("importance"))


def extract_main_text(pages: DataFrame, threshold: float = THRESHOLD, doubt: float = DOUBT) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    smoothed = (F.col("importance") * F.col("pages") + doubt) / (F.col("pages") + doubt)
    low = site_branches(pages).where(smoothed < threshold)
    low = written(low.groupBy(F.col("host").alias("site")).agg(F.array_sort(F.collect_list("branch")).alias("cut")), "cut-branches")
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of().alias("host"))
    read = read.join(small_or_not(low), F.col("host") == F.col("site"), "left").select("page_id", "url", "html", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [frozenset(c or ()) for c in batch.column("cut").to_pylist()]
            texts = [main_text(page, cut) for page, cut in zip(batch.column("html").to_pylist(), cuts, strict=True)]
            same = [batch.column(c) for c in ("page_id", "url")]
            values = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*same, *values], ["page_id", "url", "text", "n_chars"])

    types = dict(read.dtypes)
    return read.mapInArrow(run, f"page_id {types['page_id']}, url string, text string, n_chars long")
