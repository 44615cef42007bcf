"""HTML extraction (1): flat text blocks judged by a decision tree on their neighbourhood."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.extract_labels import LABELLED_PAGES

#: What an attribute is given: a value in quotes right after the equals sign, else all up to white space.
VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+"""
MARKUP = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|{VALUE})*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]+)))?+""")
#: Elements whose content is never text of the page.
HIDDEN = frozenset("script style noscript template svg annotation iframe object textarea select button title".split())
#: Those of them whose content has no tags: only their own end tag ends it.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in "script style iframe textarea title".split()}
#: Elements that do not end the head; any other does, its own end tag left out or not.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
#: Elements that do not end a block.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub "
                   "msup msubsup munder mover munderover mstyle mpadded mphantom semantics".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and roles of a region which the article is not in.
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of a class or id that name such a region where no element does.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus footer form gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination pager popup promo promotion related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split())
#: First and last words of names that tell a state of the page, not what the element is.
STATE_BEFORE = frozenset("no not has have is with without hide show".split())
STATE_AFTER = frozenset("on off enabled disabled true false ready loaded".split())
#: Words beside which ``header`` names the head of the article.
OF_ARTICLE = frozenset("article entry post story content".split())
FEATURES = ("words", "links", "density", "prev_words", "prev_links", "prev2_words", "prev2_links", "next_words",
            "next_links", "next2_words", "next2_links", "article", "has_article", "heading", "sentence")
#: Characters of a line of text, for the density (words a full line).
LINE = 80


class Block:
    """A run of text without a block-level tag inside."""

    __slots__ = ("text", "words", "linked", "aside", "article", "heading", "keep")

    def __init__(self, text: str, linked: int, aside: bool, article: bool, heading: bool, keep: bool) -> None:
        self.text, self.linked, self.aside, self.article, self.heading, self.keep = (
            text, linked, aside, article, heading, keep)
        self.words = text.count(" ") + 1


def names_aside(name: str) -> bool:
    """Whether one class or id names a region beside the article (``ad-box``, ``siteFooter``), not a state
    of the page (``no-sidebar``, ``share-enabled``) or the article's own head (``entry-header``)."""
    parts = [x.lower() for x in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]
    if not parts or parts[0] in STATE_BEFORE or parts[-1] in STATE_AFTER:
        return False
    found = HINTS.intersection(parts)
    return bool(found) and not (found == {"header"} and OF_ARTICLE.intersection(parts))


def marks(attributes: str) -> tuple[bool, bool, bool]:
    """What the attributes of an element say: ``aside, article, labelled main text``."""
    aside = article = main = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role":
            aside, article = aside or value.lower() in ASIDE_ROLES, article or value.lower() in ("main", "article")
        elif name in ("class", "id"):
            aside = aside or any(map(names_aside, value.split()))
        elif name == "data-main":
            main = True
    return aside, article, main


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page in its order.

    Character references are decoded, white space inside a block is one space.  Scripts,
    styles, comments and a tag that the end of the page cuts off are no text; a script, style,
    title or the like ends at its own end tag, whatever is in it.  Other hidden elements (buttons,
    drawings) end with their end tag or the element around them; without an end tag later in the page
    they hide nothing but the text up to the next tag.  The head has no text; it ends
    with its end tag or before the first element or text that belongs to the body.  A region
    ends where its element ends, or an element around it; a ``header`` inside the article belongs to it.
    """
    page = page or ""
    last: dict[str, int] = {}  # the last end tag of a hidden element
    out: list[Block] = []
    text: list[str] = []
    linked = 0
    top = ("", False, False, False, False)
    open_: list[tuple[str, bool, bool, bool, bool]] = []  # name, aside, article, labelled main text, hidden
    count: dict[str, int] = {}
    aside = article = keep = hidden = False
    anchors = 0
    heading = False
    skip = False  # the text right behind the tag of a hidden element that never ends
    head = began = False  # inside the head; past the start of the head or body
    at = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Block(joined, linked, aside, article, heading, keep))
        text.clear()
        linked = 0

    def more(raw: str) -> None:
        nonlocal linked, head, began
        if raw and not hidden and not skip:
            if not raw.isspace():
                head, began = False, True
            decoded = entities.unescape(raw) if "&" in raw else raw
            text.append(decoded)
            if anchors:
                linked += len(decoded.split())

    def pop() -> str:
        nonlocal aside, article, keep, hidden
        name = open_.pop()[0]
        count[name] -= 1
        _, aside, article, keep, hidden = open_[-1] if open_ else top
        return name

    def push(name: str) -> None:
        open_.append((name, aside, article, keep, hidden))
        count[name] = count.get(name, 0) + 1

    while m := MARKUP.search(page, at):
        if m.start() > at:
            more(page[at:m.start()])
        at = m.end()
        skip = False
        close, name, attributes = m.groups()
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not close and not attributes.endswith("/"):
            end = RAW[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "head" and not hidden:
            flush()
            head, began = not close and not began, True
            continue
        if name not in IN_HEAD and not close:
            head, began = False, True
        if name in HIDDEN and not close:
            if not attributes.endswith("/"):
                text.append(" ")
                if name not in last:
                    last[name] = max((e.start() for e in re.finditer(f"</{name}", page[at:], re.I)), default=-1) + at
                if last[name] < at:
                    skip = True
                else:
                    hidden = True
                    push(name)
            continue
        if name == "a" and not hidden:
            anchors = max(0, anchors - 1) if close else 1
        if name in INLINE:
            continue
        if not hidden and name not in HIDDEN:
            flush()
        if close:
            if count.get(name):
                if name not in HIDDEN:
                    anchors, heading = 0, False
                while pop() != name:
                    pass
            continue
        if name in VOID:
            continue
        if hidden:
            if not attributes.endswith("/"):
                push(name)
            continue
        if re.fullmatch("h[1-6]", name):
            heading = True
        elif name == "p":
            heading = False
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_ and open_[-1][0] == name:
            pop()  # such an element ends at the next of its kind
        within = article
        named, main_role, main = marks(attributes) if attributes else (False, False, False)
        if name not in ("html", "body"):
            aside = aside or named or (name in ASIDE and not (name == "header" and within))
            article = article or main_role or name in ("article", "main")
        keep = keep or main
        push(name)
    if at < len(page):
        more(page[at:])
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block: its own and its neighbours' word count and link density.

    Neighbours are the two blocks on each side in page order, whatever region they are in."""
    n = len(found)
    x = np.zeros((n, len(FEATURES)))
    if not n:
        return x
    words = np.array([b.words for b in found], float)
    links = np.array([b.linked / b.words for b in found]).clip(0, 1)
    x[:, 0], x[:, 1] = words, links
    x[:, 2] = words / np.maximum(1, np.array([len(b.text) for b in found]) // LINE)
    for k, (before, after) in enumerate(((3, 7), (5, 9)), 1):
        for c, v in enumerate((words, links)):
            x[k:, before + c] = v[:-k]
            x[:-k, after + c] = v[k:]
    x[:, 11] = [b.article for b in found]
    x[:, 12] = any(b.article and not b.aside for b in found)
    x[:, 13] = [b.heading for b in found]
    x[:, 14] = [b.text[-1:] in ".!?…\"'”)" for b in found]
    return x


def train(spark: SparkSession, labelled: tuple[str, ...] = LABELLED_PAGES, depth: int = 8) -> list[tuple]:
    """Decision tree from the small labelled table (blocks inside ``data-main`` are main text).

    Blocks of regions that the markup names as menus, adverts, comments and the like are
    never main text, and neither teach nor ask the tree.  Returns its nodes as ``(feature, threshold, left, right, main)``, a few dozen rows.
    """
    rows = []
    for page in labelled:
        found = blocks(page)
        rows += [(float(b.keep), Vectors.dense(x))
                 for b, x in zip(found, features(found).tolist(), strict=True) if not b.aside]
    table = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    model: DecisionTreeClassificationModel = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(table)
    nodes: list[tuple] = []

    def walk(node) -> int:
        k = len(nodes)
        nodes.append(None)
        if node.numDescendants() == 0:
            nodes[k] = (-1, 0.0, -1, -1, bool(node.prediction()))
        else:
            split = node.split()
            nodes[k] = (split.featureIndex(), float(split.threshold()), walk(node.leftChild()),
                        walk(node.rightChild()), False)
        return k

    walk(model._java_obj.rootNode())
    return nodes


def predict(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
    """Which blocks are main text."""
    keep = np.zeros(len(x), bool)

    def go(k: int, rows: np.ndarray) -> None:
        feature, threshold, left, right, main = nodes[k]
        if feature < 0:
            keep[rows] = main
            return
        low = x[rows, feature] <= threshold
        go(left, rows[low])
        go(right, rows[~low])

    go(0, np.arange(len(x)))
    return keep


def choose(nodes: list[tuple], pages: list[list[Block]]) -> list[np.ndarray]:
    """Per page, which of its blocks are main text: those that the tree takes outside the named regions."""
    keep = predict(nodes, np.concatenate([features(f) for f in pages]))
    keep &= ~np.array([b.aside for f in pages for b in f], bool)
    return np.split(keep, np.cumsum([len(f) for f in pages])[:-1])


def extract(pages: DataFrame, nodes: list[tuple] | None = None) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars, n_blocks, n_kept``.

    The main blocks of the whole page joined by line breaks; an empty string if there is
    none, and for a null or empty page.  Pages are independent: no shuffle, repeated
    rows give repeated results, other columns are dropped.  The model is the node list
    of one small tree.
    """
    tree = train(pages.sparkSession) if nodes is None else nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                found = [blocks(x.as_py()) for x in b.column(2)]
                keep = choose(tree, found)
                texts = ["\n".join(k.text for k, y in zip(f, m, strict=True) if y)
                         for f, m in zip(found, keep, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                     pa.array(map(len, found), pa.int32()), pa.array([int(m.sum()) for m in keep], pa.int32())],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int")
