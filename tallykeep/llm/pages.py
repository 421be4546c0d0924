"""HTML extraction: flat text blocks classified by a decision tree.

A page is cut into text blocks at block-level tags. Each block has its number of words
and the share of them inside links, the same of the block before and after, and what its
open elements and their class names say: counts of elements named like page furniture or like an
article, where an element named like both counts as neither. Reader comments are what stands in an
element named after them, or in an article inside an article. A decision tree, trained by Spark on a small
labelled table (the blocks of the example pages below), decides which blocks are the
main text. What open elements say is kept as running counts, so time grows with the page, however
deep its elements nest. Kept blocks have character references decoded and white space folded, and are
joined in page order by one space.

Defined cases: null or empty html gives an empty text; what is cut off in a page that
ends early is closed there; an unclosed comment, script or style hides the rest;
repeated rows are extracted each; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.llm.common import bounded_batches

_TOKEN = re.compile(
    r"<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"
    # a quote that is never closed does not count, and the tag ends at its first >
    r"([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*(?=>|\Z)|[^>]*)(?:>|\Z))",
    re.S,
)
# Names of a class list, each of some words.
_NAMES_OF_LIST = re.compile(r"[^\s]+")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS_OF_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"data-main")

# Elements whose content is not text of the page.
RAW = {
    name: re.compile(rf"</{name}\b[^>]*>?", re.I)
    for name in ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "title")
}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
END_LEFT_OUT = frozenset("p li td th tr dt dd option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navigation navbar menu "
    "breadcrumb breadcrumbs sidebar widget footer header masthead topbar cookie cookies consent gdpr notice alert popup modal "
    "share sharing social related recommended newsletter subscribe subscription "
    "signup login search pagination pager tags copyright disclaimer legal toolbar skip toc".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist respond disqus reply replies".split())
# Boilerplate that an article inside it does not end; a form may wrap a whole page.
LASTING = BOILERPLATE - {"form"}
ARTICLE_NAMES = frozenset("article content main post story entry body text prose".split())

FEATURES = (
    "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after",
    "in_article", "beside_article", "in_boilerplate", "named_boilerplate", "named_article", "heading", "in_list", "in_comments",
)


class Block:
    """A run of text without a block-level tag inside."""

    __slots__ = ("text", "words", "linked", "flags", "marked")

    def __init__(self, pieces: list[tuple[str, bool]], flags: tuple, marked: bool):
        self.text = " ".join(entities.unescape("".join(piece for piece, _ in pieces)).split())
        self.words = self.text.count(" ") + 1 if self.text else 0
        self.linked = sum(len(entities.unescape(piece).split()) for piece, link in pieces if link)
        self.flags = flags
        self.marked = marked

    @property
    def link_share(self) -> float:
        return min(1.0, self.linked / self.words)


class Open(NamedTuple):
    """What an open element and those around it say."""

    name: str = ""
    articles: int = 0
    in_article: int = 0
    lasting: int = 0
    in_form: int = 0
    named_boilerplate: int = 0
    named_article: int = 0
    heading: int = 0
    in_list: int = 0
    in_comments: int = 0
    marked: bool = False

    def within(self, name: str, attributes: str) -> Open:
        """The state inside a further element."""
        whole = name in ("body", "html") or name in ARTICLE
        furniture, article, comments = (0, 0, 0) if whole else _named(attributes)
        fresh = name in ARTICLE and not self.in_comments
        in_article = int(self.in_article or name in ARTICLE)
        return Open(
            name,
            self.articles + (name == "article"),
            in_article,
            self.lasting + (name in LASTING and not (name == "header" and in_article)),
            0 if fresh else self.in_form + (name == "form"),
            (0 if fresh else self.named_boilerplate) + furniture,
            self.named_article + article,
            int(self.heading or name in HEADINGS),
            int(self.in_list or name in ("ul", "ol", "dl")),
            int(self.in_comments or comments or (name == "article" and self.articles > 0)),
            self.marked or bool(_HIDDEN.search(attributes)),
        )

    @property
    def flags(self) -> tuple:
        in_boilerplate = int(self.lasting > 0 or self.in_form > 0)
        return self.in_article, in_boilerplate, self.named_boilerplate, self.named_article, self.heading, self.in_list, self.in_comments


def _named(attributes: str) -> tuple[int, int, int]:
    """Whether class, id and role name page furniture, an article, or comments."""
    furniture = article = comments = 0
    if "=" in attributes:
        for value in _NAMES.findall(attributes):
            for one in _NAMES_OF_LIST.findall("".join(value).lower()):
                words = _WORDS_OF_NAME.findall(one)
                comments |= bool(words) and words[0] in COMMENT_NAMES
                furniture |= not BOILERPLATE_NAMES.isdisjoint(words)
                article |= not ARTICLE_NAMES.isdisjoint(words)
    return int(furniture and not article), int(article and not furniture and not comments), int(comments)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; the empty ones are left out."""
    found: list[Block] = []
    stack: list[Open] = []
    opened: Counter[str] = Counter()
    outside = Open()
    pieces: list[tuple[str, bool]] = []
    link = False
    done = 0

    def end_block() -> None:
        if pieces:
            state = stack[-1] if stack else outside
            block = Block(pieces, state.flags, state.marked)
            if block.words:
                found.append(block)
            pieces.clear()

    def close() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    while True:
        token = _TOKEN.search(page, done)
        text = page[done : token.start()] if token else page[done:]
        if text:
            pieces.append((text, link))
        if not token:
            break
        done = token.end()
        closing, name, attributes = token.group(1), token.group(2), token.group(3)
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = RAW[name].search(page, done)
                done = end.end() if end else len(page)
        elif name == "br":
            pieces.append((" ", link))
        elif name in INLINE:
            if name == "a":
                link = not closing
        elif closing:
            if opened[name]:
                end_block()
                link = False
                while close() != name:
                    pass
            elif name == "p":
                end_block()
        else:
            end_block()
            if stack and (stack[-1].name == "p" or (stack[-1].name == name and name in END_LEFT_OUT)):
                close()
            if name not in VOID and not attributes.endswith("/"):
                stack.append((stack[-1] if stack else outside).within(name, attributes))
                opened[name] += 1
    end_block()
    return found


def features(found: list[Block]) -> list[tuple[float, ...]]:
    rows = []
    has_article = any(block.flags[0] for block in found)
    for i, block in enumerate(found):
        before, after = found[i - 1] if i else None, found[i + 1] if i + 1 < len(found) else None
        rows.append(
            (
                float(block.words),
                block.link_share,
                float(before.words) if before else 0.0,
                before.link_share if before else 0.0,
                float(after.words) if after else 0.0,
                after.link_share if after else 0.0,
                float(block.flags[0]),
                float(has_article and not block.flags[0]),
                *map(float, block.flags[1:]),
            )
        )
    return rows


_LONG = "The council met on Tuesday to hear what the new bridge would cost and who would have to pay for all of it in the end."
_SHORT = "Nobody was hurt."
_LINKS = "<ul><li><a href=/a>Home</a></li><li><a href=/b>World news</a></li><li><a href=/c>Sport</a></li></ul>"
# Elements of the main text are marked with data-main; everything else is not.
EXAMPLES = (
    f"<nav>{_LINKS}</nav><div class=ad>Buy a new car today.</div><article><h1 data-main>Bridge</h1><p data-main>{_LONG}</p>"
    f"<p data-main>{_SHORT}</p><p data-main>{_LONG}</p></article><footer>&copy; site. {_LONG}</footer>",
    f"<header><h1>Daily Site</h1>{_LINKS}</header><main><h1 data-main>Bridge</h1><p data-main>{_SHORT}</p><p data-main>{_LONG}</p>"
    f"<aside><p>{_LONG}</p></aside><p data-main>{_SHORT}</p></main><footer><p>{_SHORT}</p></footer>",
    f"<div class=menu>{_LINKS}</div><div class='post-content'><h2 data-main>Bridge</h2><p data-main>{_LONG}</p><p data-main>{_SHORT}</p>"
    f"<ul data-main><li>One pier</li><li>Two piers</li></ul></div><div id=comments><p>{_LONG}</p><p>{_SHORT}</p></div>",
    f"<div><a href=/>Home</a> <a href=/n>News</a></div><div><h1 data-main>Bridge</h1><p data-main>{_LONG}</p><p data-main>{_LONG}</p>"
    f"<p data-main>{_LONG}</p></div><div><a href=/t>Terms</a> <a href=/p>Privacy</a></div>",
    f"<div class='cookie-notice'><p>{_LONG}</p><button>OK</button></div><article><header><h1 data-main>Bridge</h1></header><p data-main>{_LONG}</p>"
    f"<div class=advert><p>{_LONG}</p></div><p data-main>{_SHORT}</p><form><p>{_SHORT}</p></form>"
    f"<section class=comments><h3>Comments</h3><p>{_LONG}</p></section></article>",
    f"<div id=sidebar><h3>Popular</h3>{_LINKS}<p>{_LONG}</p></div><div id=main><p data-main>{_LONG}</p><p data-main>{_SHORT}</p>"
    f"<div class=related><h4>Related</h4>{_LINKS}</div></div><div class=footer><p>{_LONG}</p></div>",
    f"<table><tr><td><a href=/1>One</a><td data-main>{_LONG}<tr><td><a href=/2>Two</a><td data-main>{_LONG}</table>",
    f"<article><p data-main>{_SHORT}</p></article><aside class=widget><p>{_LONG}</p><p>{_LONG}</p></aside>",
    f"<article><p data-main>{_SHORT}</p><p data-main>{_SHORT}</p><ul data-main><li><a href=/x>A source</a></li><li>{_SHORT}</li></ul></article>"
    f"<form><p>{_LONG}</p></form><footer>{_LINKS}</footer>",
    f"<div class=content><div class=share><a href=/s>Share</a></div><p data-main>{_LONG}</p><p data-main>{_SHORT}</p></div>"
    f"<div class=newsletter><p>{_LONG}</p></div>",
    f"<div>{_LONG}</div><article><p data-main>{_LONG}</p><p data-main>{_SHORT}</p></article><div><p>{_SHORT}</p><p>{_LONG}</p></div>",
    f"<p data-main>{_LONG}</p><div><a href=/r>Read this one too</a></div><p data-main>{_LONG}</p>{_LINKS}<p data-main>{_SHORT}</p><p data-main>{_LONG}</p>",
    f"<p data-main>{_SHORT}</p>{_LINKS}<p data-main>{_SHORT}</p>",
    f"<article><p data-main><a href=/s>The source of all of this</a></p><p data-main>{_LONG}</p><p data-main><a href=/t>Its second part</a></p></article>",
    f"<nav>{_LINKS}<p>{_LONG}</p></nav><article><p data-main>{_LONG}</p></article><footer><p>{_LONG}</p><p>{_LONG}</p><p>{_SHORT}</p></footer>",
    f"<header><p>{_LONG}</p><p>{_LONG}</p></header><div class=text><p data-main>{_SHORT}</p><p data-main>{_LONG}</p></div>",
    f"<form><p>{_SHORT}</p><p>{_LONG}</p></form><div class=ads><p>{_SHORT}</p><p>{_LONG}</p></div><p data-main>{_LONG}</p>",
    f"<article><nav>{_LINKS}</nav><h2 data-main>Bridge</h2><p data-main>{_LONG}</p><footer><p>{_SHORT}</p></footer></article>",
    f"<article><p data-main>{_LONG}</p><p data-main>{_SHORT}</p></article><section class=comments><article><p>{_LONG}</p></article>"
    f"<article><p>{_SHORT}</p></article></section>",
    f"<main><article><p data-main>{_LONG}</p><section><article><p>{_LONG}</p></article><article><p>{_SHORT}</p></article></section></article></main>",
    f"<div class='post tags-science'><p data-main>{_LONG}</p><p data-main>{_SHORT}</p></div><div class=sidebar><p>{_LONG}</p></div>",
    f"<div class=story><div class='story-header'><h1 data-main>Bridge</h1><p data-main>{_LONG}</p></div><p data-main>{_LONG}</p></div>"
    f"<ol class=commentlist><li class='comment byuser'><p>{_LONG}</p></li><li class='comment'><div class='comment-content'><p>{_SHORT}</p></div></li></ol>",
    f"<form><article><p data-main>{_LONG}</p><p data-main>{_SHORT}</p></article></form><aside><article><p>{_LONG}</p></article></aside>",
    f"<div id=respond><p>{_SHORT}</p><p>{_LONG}</p></div><div><p data-main>{_LONG}</p><p data-main>{_LONG}</p></div>",
    f"<div class='layout has-sidebar'><article class='post'><p data-main>{_LONG}</p></article><div class='sidebar'><p>{_LONG}</p><p>{_SHORT}</p></div></div>",
)

Node = tuple  # (feature, limit, node if not above, node if above) or (keep,)


def _tree(printed: str) -> Node:
    lines = iter([line.strip() for line in printed.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def node() -> Node:
        line = next(lines)
        if found := re.match(r"Predict: (\S+)", line):
            return (float(found[1]) == 1.0,)
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        next(lines)
        return int(feature), float(limit), low, node()

    return node()


def _train(spark: SparkSession) -> Node:
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = []
    for page in EXAMPLES:
        found = blocks(page)
        rows += [(*row, float(block.marked)) for row, block in zip(features(found), found)]
    values = ", ".join("(" + ", ".join(f"double('{value}')" for value in row) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join((*FEATURES, 'label'))})").coalesce(1)
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    return _tree(DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=1, seed=1).fit(ready).toDebugString)


_trained: dict[str, Node] = {}


def classifier(spark: SparkSession) -> Node:
    """The decision tree, trained once per application."""
    application = spark.sparkContext.applicationId
    if application not in _trained:
        _trained[application] = _train(spark)
    return _trained[application]


def is_main(tree: Node, row: tuple[float, ...]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    return " ".join(block.text for block, row in zip(found, features(found)) if is_main(tree, row))


def _extract(tree: Node):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", tree) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return extract


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    spark = pages.sparkSession
    bounded_batches(spark)
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return chosen.mapInArrow(_extract(classifier(spark)), "page_id long, url string, text string, n_chars long")
