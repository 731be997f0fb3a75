"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags. A block has its word count and
link density, those of the blocks before and after it, and what its markup says
(inside a menu, sidebar, form and the like; inside an article; heading). A
decision tree fitted on LABELLED, a small table of blocks of hand-marked pages,
decides which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sessionweave.llm.common import bounded_batches

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "boilerplate", "article", "heading", "article_on_page",
)

# Elements whose content is no markup and runs to the page's end if unclosed, and others that are left out once closed.
_RAW = "script|style|noscript|iframe|textarea|title"
SKIPPED = frozenset("template svg math object canvas select button audio video".split())
FOREIGN = frozenset(("svg", "math"))
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])([^>]*)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAME = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)

# Tags that end a text block; tags and names of parts of a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
PART_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
HOLDER_TAGS = frozenset("nav footer aside form menu dialog fieldset header article main section div ul ol table details figure body span p td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_NAMES = frozenset("article main content post entry story articlebody".split())
PART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer header masthead topbar sidebar side aside widget related recommended trending popular "
    "comment comments respond reply replies disqus discussion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search form share sharing social toolbar pagination pager copyright legal "
    "disclaimer tags tagcloud contentinfo complementary".split()
)
COMMENT_NAMES = frozenset("comment comments respond replies disqus discussion".split())
# Words that make a class name speak of a state of the page ("has-sidebar", "comments-closed").
STATE_WORDS = frozenset("has have with without no open opened closed enabled disabled fixed layout".split())
WHOLE_TAGS = frozenset("body main article".split())

_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Block:
    """A text block: words, share of them in links, and what the markup around it says."""

    text: str
    words: int
    link_density: float
    boilerplate: bool
    article: bool
    heading: bool


def _names(attributes: str) -> set[str]:
    """Words of an element's class names and the like; names that tell a state are left out."""
    found: set[str] = set()
    for m in _NAME.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
            parts = set(_SPLIT.split(name))
            if not parts & STATE_WORDS:
                found |= parts
    return found


def _part(tag: str, names: set[str]) -> str:
    """``part`` for menus and the like, ``comments``, ``main`` for the article, ``header``, or nothing.

    Names never exclude the body, the main part or an article, but for an article that is one reader's comment.
    """
    if tag in WHOLE_TAGS:
        if tag == "article" and "comment" in names and not names & MAIN_NAMES:
            return "comments"
        return "" if tag == "body" else "main"
    if names & COMMENT_NAMES:
        return "comments"
    if tag in PART_TAGS or names & PART_NAMES:
        return "part"
    if tag == "header":
        return "header"
    if names & MAIN_NAMES:
        return "main"
    return ""


def tags(page: str) -> list[tuple[int, int, bool, str, str]]:
    """``start, end, closing, name, attributes`` of the markup in order; no name if only its place matters.

    A skipped element and all in it is one entry, if it is closed: a closing tag ends
    the nearest open one of its name. Without closing tag its tags are ordinary ones.
    ``<svg/>`` and ``<math/>`` are empty, and so is any such tag inside them.
    """
    found: list[tuple[int, int, bool, str, str]] = []
    opened: list[tuple[str, int]] = []  # skipped elements that are open, and where they are in ``found``
    number = dict.fromkeys(SKIPPED, 0)
    at = 0
    while m := _TAG.search(page, at):
        at = m.end()
        if m[1] is not None and m[2].endswith("/") and any(number[x] for x in FOREIGN):
            at = m.end(2) + 1
        name = (m[4] or "").lower()
        found.append((m.start(), at, m[3] == "/", name, m[5] or ""))
        if name not in SKIPPED or (name in FOREIGN and m[5].endswith("/")):
            continue
        if m[3] != "/":
            opened.append((name, len(found) - 1))
            number[name] += 1
        elif number[name]:
            last, i = "", 0
            while last != name:
                last, i = opened.pop()
                number[last] -= 1
            found[i:] = [(found[i][0], at, False, "", "")]
    return found


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; markup may be unclosed or misnested."""
    found: list[Block] = []
    open_tags: list[tuple[str, str]] = []
    texts: list[str] = []
    link_words = [0]
    state = {"link": 0, "heading": False}

    def flush() -> None:
        text = " ".join(html.unescape("".join(texts)).split())
        texts.clear()
        if text:
            parts = [p for _, p in open_tags if p]
            last_main = max((i for i, p in enumerate(parts) if p == "main"), default=-1)
            after = parts[last_main + 1 :]
            bad = "comments" in parts or "part" in after or ("header" in after and not (last_main >= 0 and state["heading"]))
            n = len(text.split())
            found.append(Block(text, n, min(1.0, link_words[0] / n), bad, last_main >= 0 and not bad, state["heading"]))
        link_words[0] = 0

    def add(text: str) -> None:
        texts.append(text)
        if state["link"]:
            link_words[0] += len(text.split())

    at = 0
    for start, end, closing, tag, attributes in tags(page):
        if start > at:
            add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            texts.append(" ")
            continue
        if tag == "a":
            state["link"] = 0 if closing else 1
        if tag in BLOCK_TAGS:
            flush()
            state["link"] = 0
            state["heading"] = tag in HEADINGS and not closing
        if tag not in HOLDER_TAGS or attributes.rstrip().endswith("/"):
            continue
        if closing:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    if tag in BLOCK_TAGS or open_tags[i][1]:
                        flush()
                    del open_tags[i:]
                    break
        else:
            part = _part(tag, _names(attributes) if attributes.strip() else set())
            if tag in ("p", "span", "td") and not part:
                continue
            if part and tag not in BLOCK_TAGS:
                flush()
            open_tags.append((tag, part))
    if at < len(page):
        add(page[at:])
    flush()
    return found


def rows(found: list[Block]) -> list[list[float]]:
    """Feature rows of the blocks of one page, in the order of FEATURES."""
    out = []
    on_page = float(any(b.article and not b.boilerplate for b in found))
    for i, b in enumerate(found):
        before = found[i - 1] if i else Block("", 0, 0.0, False, False, False)
        after = found[i + 1] if i + 1 < len(found) else Block("", 0, 0.0, False, False, False)
        out.append(
            [float(b.words), b.link_density, float(before.words), before.link_density, float(after.words), after.link_density]
            + [float(b.boilerplate), float(b.article), float(b.heading), on_page]
        )
    return out


# Labelled pages. A line is one block: main text or not (1/0), its tags, words, words in links.
# Markers: B inside a menu, sidebar, form, notice, advert or comment; A inside the article; H heading; - none.
LABELLED = """
page: article with menu, advert and footer
0 B 1 1|0 B 1 1|0 B 1 1|0 B 1 1|0 B 9 0|1 AH 8 0|1 A 60 0|1 A 3 0|1 A 41 2|1 A 1 0|1 A 120 0|1 A 25 0|0 B 14 0
page: article with long advert, comments and a form
0 B 2 2|0 B 2 2|0 B 55 0|1 AH 5 0|1 A 80 4|1 A 12 0|1 A 2 0|1 A 30 30|0 B 40 0|0 B 75 2|0 B 6 0|0 B 22 3
page: article only
1 AH 6 0|1 A 15 0|1 A 8 0|1 A 200 3|1 A 5 5|1 A 33 0|1 A 1 0
page: article with sidebar and header, some text loose in the body
0 B 4 1|0 B 3 3|0 - 7 7|0 - 5 0|1 AH 9 0|1 A 44 0|1 A 4 0|1 A 90 6|0 B 30 28|0 B 18 18|0 - 12 4|0 - 40 0
page: paragraphs without an article
0 - 2 2|0 - 3 3|0 - 1 1|1 H 7 0|1 - 64 1|1 - 30 0|1 - 4 0|1 - 110 5|1 - 21 0|0 - 6 6|0 - 2 2|0 - 5 4
page: paragraphs without an article, marked menu and footer
0 B 1 1|0 B 2 2|1 H 10 0|1 - 50 0|1 - 3 0|1 - 9 0|1 - 72 0|0 B 16 2|0 B 8 0
page: list of links only
0 - 3 3|0 - 4 4|0 - 5 5|0 - 2 2|0 - 6 6|0 - 4 4|0 B 9 1
page: short page without an article
1 H 3 0|1 - 14 0|1 - 20 2|0 - 4 4|0 - 1 1
page: long text, one paragraph with links
0 - 5 5|1 - 300 12|1 - 45 40|1 - 88 0|0 - 7 7|0 B 60 0
page: article with notice, short paragraphs
0 B 25 2|0 B 1 1|1 AH 2 0|1 A 2 0|1 A 3 0|1 A 1 0|1 A 5 0|1 A 2 2|0 B 2 0|0 B 30 5
page: plain text without any markup
1 - 12 0
page: one long block
1 - 250 0
page: loose short texts around an article
0 - 6 0|1 A 18 0|1 A 7 0|0 - 3 0|0 - 30 1|0 - 15 0
page: menu as plain list, text, list
0 - 1 1|0 - 1 1|0 - 2 2|1 - 28 0|1 - 6 0|1 - 35 2|0 - 3 3|0 - 3 2|0 - 1 1
page: no marks, lists of links around the text, legal line after them
0 - 1 1|0 - 1 1|0 - 2 2|1 H 8 0|1 - 70 0|1 - 6 0|1 - 40 2|0 - 3 3|0 - 4 4|0 - 9 0
page: no marks, slogan among the links, legal text between links
0 - 2 2|0 - 6 0|0 - 1 1|1 H 5 0|1 - 33 0|1 - 90 3|1 - 12 0|0 - 2 2|0 - 1 1|0 - 26 1|0 - 2 2
page: no marks, address between links
0 - 4 4|0 - 1 1|1 H 6 0|1 - 21 0|1 - 3 0|1 - 55 0|0 - 5 5|0 - 14 0|0 - 1 1|0 - 7 0
page: no marks and no heading
0 - 1 1|0 - 3 0|0 - 2 2|0 - 1 1|1 - 48 0|1 - 9 0|1 - 17 0|1 - 62 4|0 - 2 2|0 - 11 0
page: no marks, short article between long lists
0 - 1 1|0 - 2 2|0 - 1 1|0 - 3 3|1 H 4 0|1 - 31 0|1 - 2 0|1 - 27 0|0 - 1 1|0 - 2 2|0 - 5 0|0 - 1 1|0 - 8 0
page: article between lists of links without marks, one-word blocks in it
0 - 1 1|0 - 2 2|0 - 1 1|1 AH 4 0|1 A 1 0|1 A 33 1|1 A 1 0|1 A 2 2|1 A 6 0|1 A 1 1|1 A 9 0|1 A 1 0|0 - 2 2|0 - 30 0|0 - 1 1
page: article of short lines
1 AH 2 0|1 A 3 0|1 A 5 1|1 A 1 0|1 A 7 0|1 A 4 4|1 A 3 0|1 A 1 0|0 - 26 0|0 - 9 0
page: long texts without marks around an article
0 - 50 0|0 - 33 1|0 H 3 0|0 - 24 0|1 AH 6 0|1 A 70 0|1 A 2 0|0 H 2 0|0 - 45 0|0 - 60 2|0 - 80 0|0 - 10 0
page: teasers without marks after an article
1 AH 7 0|1 A 120 0|1 A 64 3|0 H 4 0|0 - 35 0|0 - 28 0|0 H 5 0|0 - 31 2|0 - 47 0|0 - 12 0|0 H 2 2|0 - 22 0
page: no marks, sections with headings between link lists
0 - 2 2|0 - 1 1|1 H 6 0|1 - 45 0|1 - 38 2|1 H 3 0|1 - 52 0|1 - 2 0|1 - 5 0|1 H 4 0|1 - 66 1|0 - 3 3|0 - 1 1|0 - 16 0
page: no article, marked notice, sidebar and comments of many words
0 B 40 0|0 B 22 1|0 B 5 0|1 H 5 0|1 - 60 2|1 - 44 0|0 B 35 0|0 B 3 0|1 - 71 4|1 - 18 0|0 B 6 0|0 B 80 0|0 B 54 1|0 B 12 0
page: no article, marked adverts and forms between the paragraphs
1 - 41 1|0 B 30 0|1 - 9 0|1 - 52 3|0 B 2 0|0 B 17 0|1 - 38 0|1 - 3 0|0 B 63 0|0 B 44 0
page: text that ends in a short block after a paragraph with links
1 H 4 0|1 - 30 2|1 - 6 0
page: the same before a marked footer
1 - 55 6|1 - 11 0|0 B 9 0
page: links in several paragraphs
1 H 3 0|1 - 80 5|1 - 64 4|1 - 2 0
page: no heading, links in every paragraph but the last
1 - 26 2|1 - 20 1|1 - 35 0
page: one-word blocks in the text, links before them
1 - 48 3|1 - 1 0|1 - 33 2|1 - 1 0|1 - 1 0|1 - 21 1|1 - 2 0|1 - 1 0
"""


def labelled_rows() -> list[tuple[int, list[float]]]:
    """Label and features of every block of LABELLED."""
    out = []
    for line in LABELLED.strip().splitlines():
        if line.startswith("page:"):
            continue
        page, labels = [], []
        for part in line.split("|"):
            label, marks, words, links = part.split()
            labels.append(int(label))
            page.append(Block("", int(words), int(links) / int(words), "B" in marks, "A" in marks, "H" in marks))
        out += zip(labels, rows(page))
    return out


def train(spark: SparkSession, depth: int = 8) -> list:
    """The fitted tree as nested lists: ``[feature, threshold, left, right]`` or a label."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    table = spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in labelled_rows()], ["label", "features"])
    table = table.coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=2, maxBins=256, seed=1).fit(table)

    def nested(node):
        if node.subtreeDepth() == 0:
            return int(node.prediction())
        split = node.split()
        return [split.featureIndex(), split.threshold(), nested(node.leftChild()), nested(node.rightChild())]

    return nested(model._call_java("rootNode"))


def decide(tree, row: list[float]) -> bool:
    while isinstance(tree, list):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def main_text(page: str, tree) -> str:
    """Text of the page's main blocks, one line each."""
    found = blocks(page)
    return "\n".join(b.text for b, r in zip(found, rows(found)) if decide(tree, r))


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    A null or empty html gives an empty text. Repeated rows are repeated; extra
    columns are ignored. Nothing moves between tasks.
    """
    tree = train(pages.sparkSession)
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", tree) for p in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    spec = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    return bounded_batches(pages).select("page_id", "url", "html").mapInArrow(extract, spec)
