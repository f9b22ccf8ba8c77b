"""Main text of HTML pages by tag-path ratios.

Text nodes are grouped by their path of tags from the root. Each path gets the length of its text and the
punctuation per node, fused to one score; scores are smoothed over the paths, so that the short paths beside prose
(headings, lists, emphasis) share in it, the more the larger the part of the way from the root that they have in common. Paths
whose score reaches a share of the page's highest are content. What the markup names (article and main; navigation,
forms, comments and so on) weighs a path up or down and decides nothing by itself.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import without

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、]")

#: fixed word lists: elements without content, without end tag, of a line, and those that end a paragraph
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
#: an open element of the value ends where the key begins
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("article main section div body html ul ol dl table td th blockquote form nav aside header footer".split())
#: elements and words of class, id and role that name what is no article
NO_CONTENT = set("head nav footer aside form button select option dialog menu svg canvas object audio video map fieldset".split())
NO_CONTENT_WORDS = set(
    "nav navbar navigation menu menubar header masthead topbar footer sidebar aside widget widgets cookie cookies consent notice notices "
    "banner alert popup modal overlay ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo "
    "promotion comment comments commentlist disqus reply replies respond share sharing social subscribe subscription newsletter breadcrumb "
    "breadcrumbs related recommended login signin signup search pagination pager form toolbar skip complementary contentinfo gdpr paywall".split()
)
CONTENT = {"article", "main"}
CONTENT_WORDS = ("articlebody", "main")
#: weights of paths that the markup names as the content or as no content; width of the smoothing; least share of the highest score, and least score
CONTENT_WEIGHT = 16.0
NO_CONTENT_WEIGHT = 1 / 256
WIDTH = 0.2
LEAST_SHARE = 0.12
LEAST_SCORE = 8.0


def _named(attributes: str) -> tuple[bool, bool, str]:
    """Whether attributes name something that is no content, name the content, and the words that tell paths apart."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return False, False, ""
    out, main, label = False, False, ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            out = True
        elif name in ("class", "id", "role"):
            words = {w.lower() for w in _WORD.findall(value)}
            out = out or bool(words & NO_CONTENT_WORDS)
            main = main or name == "role" and value.lower() == "main"
            label += "." + value if name == "class" else ""
        elif name == "itemprop":
            main = main or value.lower() == "articlebody"
    return out, main, label


class _Page:
    """The text nodes of a page: path, block, text, weight, whether in a link."""

    def __init__(self, markup: str) -> None:
        self.nodes: list[tuple[tuple[str, ...], int, str, float, bool]] = []
        self.block = 0
        self.stack: list[tuple[str, str, bool, bool]] = []  # tag, label, out, main
        self.read(markup)

    def read(self, markup: str) -> None:
        at = 0
        while at < len(markup):
            token = _TOKEN.match(markup, at)
            at = token.end()
            tag = token[2]
            if tag is None:
                if not token[0].startswith(("<!", "<?", "</")):
                    self.text(token[0])
                continue
            tag = tag.lower()
            if token[1]:
                self.close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?|\Z", re.I).search(markup, at)
                at = end.end()
            else:
                self.open(tag, token[3])

    def open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.block += 1
            self.end_open("p", SCOPES)
        if tag in CLOSES:
            for other in CLOSES[tag]:
                self.end_open(other, SCOPES - {other} if other in ("td", "th") else SCOPES)
        if tag in VOID:
            return
        _, _, out, main = self.stack[-1] if self.stack else ("", "", False, False)
        named_out, named_main, label = _named(attributes)
        if tag in ("html", "body", "main", "article"):
            named_out = False
        out = out or named_out or tag in NO_CONTENT or tag == "header" and not main
        main = main or named_main or tag in CONTENT
        if not attributes.rstrip().endswith("/") or tag not in ("svg", "path"):
            self.stack.append((tag, tag + label, out, main))

    def end_open(self, tag: str, scopes: set[str]) -> None:
        """End the innermost open ``tag`` unless one of ``scopes`` lies between."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if self.stack[i][0] in scopes:
                return

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return  # a stray end tag of a line ends nothing around it

    def text(self, raw: str) -> None:
        _, _, out, main = self.stack[-1] if self.stack else ("", "", False, False)
        weight = (NO_CONTENT_WEIGHT if out else 1.0) * (CONTENT_WEIGHT if main else 1.0)
        self.nodes.append((tuple(s[1] for s in self.stack), self.block, html.unescape(raw), weight, any(s[0] == "a" for s in self.stack)))


Path = tuple[tuple[str, ...], float]


def path_ratios(nodes: list[tuple[tuple[str, ...], int, str, float, bool]]) -> dict[Path, float]:
    """Fused ratio of each path: its text per node times its punctuation per node. Text of links does not count."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, _, text, weight, link in nodes:
        if text.strip():
            at = (path, weight)
            count[at] += 1
            length[at] += 0 if link else len(" ".join(text.split()))
            marks[at] += 0 if link else len(_PUNCTUATION.findall(text))
    return {at: length[at] / n * (1 + marks[at] / n) for at, n in count.items()}


def likeness(common: int, one: int, other: int) -> float:
    """How much a path of ``one`` tags shares in the score of one of ``other`` tags with which it has the first ``common`` in common."""
    apart = 1 - 2 * common / (one + other) if one + other else 0.0
    return math.exp(-((apart / WIDTH) ** 2) / 2)


def path_scores(nodes: list[tuple[tuple[str, ...], int, str, float, bool]]) -> dict[Path, float]:
    """Weighed score of each path: the highest ratio of any path, by how alike the two are.

    Paths meet at what they have in common: every prefix keeps the highest ratio for each length of path below it. Links share in nothing: a block of
    bare links is no content, whatever lies beside it.
    """
    ratios = path_ratios(nodes)
    below: dict[int, dict[int, float]] = defaultdict(dict)
    prefixes: dict[tuple[int, str], int] = {}
    ways = {}
    for (path, weight), ratio in ratios.items():
        way = [0]
        for tag in path:
            way.append(prefixes.setdefault((way[-1], tag), len(prefixes) + 1))
        ways[path] = way
        # only what is not named as no content lends its ratio to others
        for place in way if weight >= 1 else ():
            below[place][len(path)] = max(ratio, below[place].get(len(path), 0.0))
    scores = {}
    for (path, weight), ratio in ratios.items():
        way = () if any(tag.split(".")[0] == "a" for tag in path) else ways[path]
        shared = max((likeness(common, len(path), other) * best for common, place in enumerate(way) for other, best in below[place].items()), default=0.0)
        scores[path, weight] = max(ratio, shared) * weight
    return scores


def _chosen(nodes: list) -> list[bool]:
    """Which nodes are content: those of paths with a share of the highest score, and what else lies in their blocks, links for one."""
    scores = path_scores(nodes)
    least = max(LEAST_SCORE, LEAST_SHARE * max(scores.values(), default=0.0))
    paths = {at for at, score in scores.items() if score >= least}
    blocks = {block for path, block, text, weight, _ in nodes if text.strip() and (path, weight) in paths}
    return [block in blocks for _, block, *_ in nodes]


def main_text(markup: str | None) -> str:
    """Content blocks in page order, joined by one space; white space inside a block is one space."""
    if not markup:
        return ""
    nodes = _Page(markup).nodes
    blocks: dict[int, list[str]] = defaultdict(list)
    for (_, block, text, _, _), content in zip(nodes, _chosen(nodes)):
        if content:
            blocks[block].append(text)
    cleaned = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return " ".join(b for b in cleaned if b)


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``text_col`` in place of ``html_col``: the main text of each page, '' if it has none.

    Character references are decoded. Null and empty pages, and pages of markup only, give ''. Broken markup is read to its end:
    unclosed elements end with their surroundings, an unclosed comment or tag with the page. Plain text without tags is its own content if it reads
    like prose. Pages of any length are read whole; repeated rows give equal results; an empty table gives an empty result.
    An input column named ``text_col`` is replaced; others pass through.
    """
    kept = without(pages, text_col)
    names = [text_col if c == html_col else c for c in kept.columns]
    schema = StructType([StructField(text_col, StringType()) if f.name == html_col else f for f in kept.schema.fields])
    at = kept.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([main_text(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.withColumn(html_col, F.col(html_col).cast("string")).mapInArrow(run, schema)
