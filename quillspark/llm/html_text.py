"""Main text of web pages: flat text blocks, classified by a decision tree on words and link density of a block and its neighbours.

The tree is MLlib's, fitted to the small table of labelled blocks below, and broadcast. One pass without a shuffle cuts each
whole page into blocks, in time linear in the page however deep it is nested, classifies them and joins the article's. Beside
the densities a block has the kind of its element, the standing of its container where that names itself (nav, footer, an
element of class ``ad``, readers' comments though they be articles in an article), the share of the page's unlinked words that
an article holds, which tells whether text outside of it matters, and whether it says what notices at a page's foot say.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import fresh, mapped
from quillspark.llm.trees import exported, leaves

#: Elements that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are tracked because they say what stands inside them.
CONTAINERS = frozenset("article main section div nav header footer aside form ul ol dl table tbody tr td th figure body details dialog fieldset menu".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
_BOILER_NAMES = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|alert|banner|breadcrumbs?|comments?|commentlist|complementary|consent|contentinfo|cookies?|copyright|dialog|disclaimer|disqus|footer|form|header|login"
    r"|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|replies|respond|search(?:$|[_-](?:ba?r|box|button|field|form|input|nav|widget))|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[_-])",
    re.I,
)
#: Names of readers' comments and the like, which may themselves be articles in an article.
_READERS = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|comments?|commentlist|disqus|guestbook|promo\w*|repl(?:y|ies)|respond|sponsor\w*|teaser)(?:$|[_-])|(?:user|customer|reader|visitor|guest)s?[_-]?(?:comments?|posts?|reviews?|ratings?)|^reviews$", re.I)
#: Names like has-sidebar tell of what stands beside an element, not of what it is.
_BESIDE = re.compile(r"(?:has|with|without|no|is|page)[_-]", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story)(?:$|[\s_-])", re.I)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements that are left out with all that they hold. Of the raw ones everything up to their end tag is text.
_RAW = frozenset("script style title textarea iframe".split())
_DROPPED = frozenset("noscript template svg select object canvas button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an svg left open, as in HTML's tree construction.
_BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article section main aside nav header footer figure form".split())
# A quote opens a value only after an equals sign.
_ATTRS = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+|[^>]*+)"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-z][a-z0-9:-]*){_ATTRS}>|<[!?][^>]*>", re.S | re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
#: A slash right after an unquoted value belongs to the value.
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"'>]*/\Z""")
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "paragraph", "item", "in_main", "in_boiler", "main_share", "notice")
#: What notices at a page's foot say, in a short block.
_NOTICE = re.compile(r"(?i)©|\(c\) ?\d{4}|\bcopyright\b|all rights reserved|privacy policy|terms of (?:use|service)|powered by|\bcookies?\b")
#: Elements whose text is a paragraph, and one entry of a list.
_PARAGRAPHS, _ITEMS = frozenset("p blockquote pre".split()), frozenset("li dt dd".split())


def _standing(name: str, attributes: str, main: bool) -> tuple[bool, bool]:
    """Whether an element, by its tag and names, holds an article, and whether it holds boilerplate."""
    named = " ".join(b or c or d for _, b, c, d in _NAMED.findall(attributes))
    article = name in ("article", "main")
    boiler = name in _BOILER_TAGS or (name == "header" and not main) or bool(_HIDDEN.search(attributes))
    if named:
        # An article that names itself holds its own comments, if any; what stands in one may be a comment.
        names = _READERS if article else _BOILER_NAMES
        boiler |= any((names.search(n) or _READERS.search(n)) and not _BESIDE.match(n) for n in named.split() if not (article and not main and n.startswith("has")))
        article = article or (name in ("div", "section") and bool(_MAIN_NAMES.search(named)))
    return article, boiler


def blocks(html: str | None) -> list[tuple[str, float, bool, bool, bool, bool, bool]]:
    """Text, link density, heading, paragraph, item, in an article, in boilerplate: the non-empty text blocks of a page, in its order."""
    out: list[tuple[str, float, bool, bool, bool, bool, bool]] = []
    # element, in an article, in boilerplate, how often other elements are open in it
    stack: list[tuple[str, bool, bool, dict[str, int]]] = [("", False, False, {})]
    # How often each name is on the stack, and in how many of its elements others of a name are open.
    standing, inside_of = Counter(), Counter()
    dropped: list[str] = []  # an element that is left out, and those open in it
    in_dropped: Counter[str] = Counter()
    parts: list[str] = []
    state = {"link": False, "linked": 0, "heading": False, "paragraph": False, "item": False, "aside": False}

    def text(piece: str) -> None:
        if piece:
            parts.append(piece)
            if state["link"]:
                state["linked"] += len(piece.strip())

    def end() -> None:
        if parts:
            whole = "".join(parts)
            words = (unescape(whole) if "&" in whole else whole).split()
            if words:
                joined = " ".join(words)
                out.append((joined, min(1.0, state["linked"] / max(1, len(whole.strip()))), state["heading"], state["paragraph"], state["item"], stack[-1][1], stack[-1][2] or state["aside"]))
            parts.clear()
        state["linked"] = 0

    def drop(name: str) -> None:
        dropped.append(name)
        in_dropped[name] += 1

    def left_out(name: str, closing: bool, closed: bool) -> bool:
        """Whether a tag is part of the dropped element; else it ends an element left open, as its container's end does."""
        if closing:
            if in_dropped[name]:
                last = None
                while last != name:
                    last = dropped.pop()
                    in_dropped[last] -= 1
                return True
            return not (standing[name] or inside_of[name])
        if dropped[0] == "svg" and name in _BREAKOUT and not in_dropped["foreignobject"] and not in_dropped["desc"]:
            return False
        if name == dropped[0] and name in ("button", "select"):  # these do not nest
            del dropped[1:]
            in_dropped.clear()
            in_dropped[name] = 1
        elif not closed and name not in _VOID:
            drop(name)
        return True

    def leave() -> str:
        name, _, _, inside = stack.pop()
        standing[name] -= 1
        for other, n in inside.items():
            inside_of[other] -= n > 0
        return name

    page, at = html or "", 0
    last = page.rfind(">") + 1  # no tag ends beyond; only a comment left open may begin there
    while m := _TAG.search(page, at, last):
        if not dropped:
            text(page[at : m.start()])
        at = len(page) if m[0].startswith("<!--") and not m[0].endswith("-->") else m.end()
        closing, name, attributes = bool(m[1]), (m[2] or "").lower(), m[3] or ""
        if not name:
            continue
        foreign = in_dropped["svg"] > 0 and not in_dropped["foreignobject"]
        if name in _RAW and not closing and not foreign:
            over = _RAW_END[name].search(page, at)
            at = over.end() if over else len(page)
            continue
        closed = not closing and attributes.endswith("/") and not _UNQUOTED_SLASH.search(attributes)
        if dropped:
            if left_out(name, closing, closed):
                continue
            dropped.clear()
            in_dropped.clear()
        if name in _DROPPED and not closing:
            if not (name == "svg" and closed):
                drop(name)
            continue
        if name not in CONTAINERS and name not in _VOID:
            inside = stack[-1][3]
            n = inside.get(name, 0)
            inside[name] = max(0, n + (-1 if closing else 1))
            inside_of[name] += (inside[name] > 0) - (n > 0)
        if name in INLINE:
            if name == "a":
                state["link"] = not closing
            continue
        end()
        if name in CONTAINERS:
            if closing:
                if standing[name]:
                    while leave() != name:
                        pass
            else:
                main, boiler = stack[-1][1:3]
                article, out_of_text = _standing(name, attributes, main)
                stack.append((name, main or article, boiler or out_of_text, {}))
                standing[name] += 1
            state["link"] = state["aside"] = state["paragraph"] = state["item"] = False
        else:
            # Paragraphs, items and headings, often left open, stand for themselves until the next one begins.
            if name != "br":
                state["paragraph"], state["item"] = not closing and name in _PARAGRAPHS, not closing and name in _ITEMS
                state["aside"] = not closing and bool(attributes) and name not in ("body", "html") and _standing(name, attributes, True)[1]
            if re.fullmatch("h[1-6]", name):
                state["heading"] = not closing
            elif name == "p" and not closing:
                state["heading"] = False
    if not dropped:
        text(page[at:].partition("<!--")[0])
    end()
    return out


def measured(found: list[tuple[str, float, bool, bool, bool, bool, bool]]) -> np.ndarray:
    """FEATURES of the blocks of one page. Before the first and after the last stands an empty block."""
    x = np.zeros((len(found), len(FEATURES)))
    if len(x):
        x[:, 0] = [b[0].count(" ") + 1 for b in found]
        x[:, 1] = [b[1] for b in found]
        x[1:, 2:4], x[:-1, 4:6] = x[:-1, :2], x[1:, :2]
        x[:, 6:11] = [b[2:] for b in found]
        x[:, 9] *= 1 - x[:, 10]  # boilerplate in an article is none of it
        said = x[:, 0] * (1 - x[:, 1]) * (1 - x[:, 10])
        x[:, 11] = (said * x[:, 9]).sum() / max(said.sum(), 1e-9)
        x[:, 12] = [len(b[0]) < 200 and bool(_NOTICE.search(b[0])) for b in found]
    return x


#: Labelled blocks of pages: element, with its container where that has a standing; words; share of them in links; + for
#: main text. A line is a page. Containers: m an article, b boilerplate, - none of these; ! a notice.
LABELLED = """
- div 3 1 -|b li 1 1 -|b li 1 1 -|b li 2 1 -|m h1 8 0 +|m p 3 0 +|m p 45 0 +|m p 60 .05 +|m h2 3 0 +|m p 30 0 +|m li 4 0 +|m li 9 0 +|m li 6 1 +|m p 5 0 +|b p 14 0 -|b p 30 0 -|- div! 6 0 -
- div 2 0 -|b li 1 1 -|m h1 6 1 +|m p 12 1 +|m p 80 0 +|m h2 4 1 +|m p 25 .4 +|m p 2 0 +|m div 40 0 +|m div 5 0 +|m div 2 1 -|m div 3 1 -|m div 1 1 -|b div 9 .5 -|b p 20 0 -
b li 1 1 -|b p 40 0 -|m h1 4 0 +|m p 2 0 +|m p 7 0 +|m p 4 0 +|m p 3 .3 +|b p 55 .1 -|b p 3 0 -|b h3 2 0 -|- p! 9 0 -|- div! 4 .5 -
m h1 3 0 +|m p 6 0 +|b p 8 0 -|m p 6 0 +|b p 12 .2 -|m p 4 0 +|- p! 40 0 -|- p 6 1 -
- div 1 1 -|- div 2 1 -|- h2 4 0 +|- p 60 0 +|- p 35 0 +|- p 6 0 +|- p 50 .1 +|- h3 3 0 +|- p 28 0 +|- div 2 1 -|- div! 4 0 -
- li 1 1 -|- li 2 1 -|- li 1 1 -|- h1 7 0 +|- div 90 0 +|- div 45 .1 +|- div 30 0 +|- li 2 1 -|- li 3 1 -|- li 2 1 -
- p 3 0 +|- p 3 0 +|- p 2 0 +
- h1 2 0 +|- p 4 0 +|- p 7 0 +|- p 5 0 +|- p 12 0 +|- p 3 0 +
- h1 5 0 +|- p 9 0 +|- p 14 .2 +|- h2 2 0 +|- p 8 0 +|- li 3 0 +|- li 7 0 +|- li 5 .3 +|- p 11 0 +
- p 40 0 +|- p 2 0 +|- p 25 0 +|- p 8 0 +
- div 60 0 +|- div 40 0 +|- div! 4 0 -
- div 60 0 +|- div 40 0 +|- div 4 0 +
- div 8 0 +|- div 11 0 +|- div 3 0 +
- div 20 0 +|- div 5 0 +|- div 30 0 +|- div 2 0 +
- div 25 .1 +|- div! 7 .3 -|- div! 3 0 -
- div 20 0 +
- div 3 0 +
- div 1 0 -
- div! 3 0 -
- div! 12 .2 -
- div 2 1 -
- p 12 0 +
- p 30 .1 +
- li 4 0 +|- li 9 0 +|- li 2 0 +
- h1 3 0 +|- li 5 0 +|- li 7 .1 +|- li 1 0 +
- li 1 1 -|- li 1 1 -|- p 3 1 -|- p 5 0 +|- p 16 0 +|- p 4 0 +|- p 2 1 -|- div! 3 0 -
- div 2 1 -|- div 5 .6 -|- div 3 1 -|- div! 2 0 -|- div 4 .5 -|- div 2 1 -
- h3 2 1 -|- li 4 1 -|- li 5 1 -|- h3 2 0 -|- li 3 1 -|- li 6 1 -|- p 4 1 -
b li 1 1 -|b li 1 0 -|b h2 3 0 -|b p 25 0 -|b p 60 0 -|b div 12 0 -|b div 35 .2 -|b li 9 0 -|b p 4 1 -|b h1 5 0 -
b h1 4 0 -|b p 3 0 -|- p 30 0 +|- p 12 0 +|b p 18 0 -|- p 45 0 +|b li 2 1 -|b p 9 .4 -
b div 4 0 -|b div! 9 0 -|- div 22 0 +|- div 3 0 +|b div 2 1 -|b div 15 0 -
m p 15 0 +|m p 3 1 +|m p 9 0 +|m h2 2 1 +|m p 22 1 +|m p 5 0 +|m li 8 .2 +|m li 2 0 +|m div 8 .1 +|m div 15 .3 +
m p 30 0 +|m li 4 1 +|m li 5 1 +|m li 3 1 +|m p 20 0 +
m p 30 0 +|m li 2 1 +|m li 2 1 +|m p 6 0 +|m li 1 0 +
m h2 3 0 +|m li 1 1 +|m li 1 1 +|m li 2 1 +|m li 1 1 +
m p 12 0 +|m li 1 0 +|m li 1 0 +
m h1 4 0 +|m p 50 0 +|m li 6 .5 +|m li 2 1 +|m li 9 0 +|m div 3 0 +
m div 1 0 +
m div 4 0 +|m div 2 0 +
m p 1 0 +
m li 1 0 +|m li 2 0 +
m h1 1 0 +
m div 14 0 +|m div 22 .1 +|m div 3 0 +|b div 9 0 -|- div 5 0 -
m h1 5 0 +|m div 30 0 +|m div 6 0 +|m div 1 0 +|- div 3 0 -|- li 1 1 -
m p 25 0 +|m p! 9 0 +|m p! 4 0 +|m li! 5 0 +|- p! 9 .2 -
m h3 2 0 +|m p 9 0 +|m h3 2 0 +|m p 2 0 +|m div 2 0 +|m li 3 1 +|m li 3 1 +|b p 30 0 -|b p 6 0 -|b li 12 0 -
- div 3 0 -|- li 1 1 -|- li 2 1 -|m p 40 0 +|m div 9 0 +|- p 12 0 -|- li 2 0 -
- h2 3 0 -|m h1 5 0 +|m p 18 0 +|m p 33 0 +|- h3 2 0 -|- p 15 .2 -|- p 9 0 -
- p 6 .3 +|- li 5 0 +|- li 4 .4 +|- p 19 0 +|- li 2 1 -|- li 2 1 -
- h1 4 0 +|- div 12 0 +|- div 3 0 +|- div 16 .2 +|- div 1 1 -|- div 2 1 -|- div! 6 .4 -
- li 1 1 -|- li 1 1 -|- h2 2 0 +|- p 2 0 +|- p 7 0 +|- li 1 1 -
- li 2 1 -|- h2 4 0 +|- p 5 0 +|- h3 1 0 +|- p 21 0 +|- p 2 1 -
- td 3 0 +|- td 5 0 +|- td 2 0 +|- p 14 0 +
m td 1 0 +|m td 2 1 +|m td 4 0 +|m th 1 0 +
"""


def _examples() -> list[tuple[float, list[float]]]:
    """Label and features of the labelled blocks; each page at half, whole and double length."""
    out = []
    for page in LABELLED.strip().splitlines():
        for times in (0.5, 1, 2):
            found, labels = [], []
            for row in page.split("|"):
                holder, kind, words, linked, label = row.split()
                n = max(1, round(int(words) * times))
                found.append((" ".join([*["w"] * n, *["©"] * kind.endswith("!")]), float(linked), kind[0] == "h", kind.strip("!") == "p", kind.strip("!") == "li", holder == "m", holder == "b"))
                labels.append(float(label == "+"))
            out += zip(labels, measured(found).tolist(), strict=True)
    return out


def fit(spark: SparkSession, depth: int = 10) -> tuple[np.ndarray, ...]:
    """The decision tree of the labelled table, as arrays."""
    table = spark.createDataFrame(_examples(), "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    return exported(DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=7).fit(table.coalesce(1)))


def main_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of ``pages`` but ``column``, and text, n_chars: the main text of each row's whole page.

    The blocks that the tree keeps are joined by one space, in page order; white space inside a block is one space,
    character references are decoded. A null or empty page, or one without main text, gives an empty text; pages of any
    length are read whole. Repeated rows are returned as often as they occur; columns called text or n_chars are replaced.
    """
    tree = fit(pages.sparkSession)
    kept = [c for c in pages.columns if c not in ("text", "n_chars", column)]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(column).cast("string").alias(fresh(pages, "_html")[0]))

    def of(batches):
        for batch in batches:
            found = [blocks(h) for h in batch.column(len(kept)).to_pylist()]
            x = np.concatenate([np.zeros((0, len(FEATURES))), *map(measured, found)])
            main = tree[4][leaves(tree, x)] > 0.5
            texts, at = [], 0
            for page in found:
                texts.append(" ".join(b[0] for b, m in zip(page, main[at : at + len(page)], strict=True) if m))
                at += len(page)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, "text"])

    fields = source.schema.fields[:-1]
    out = mapped(source, of, type(source.schema)([*fields]).add("text", "string"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
