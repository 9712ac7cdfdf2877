"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

1. Each page is read into a tree of elements (missing end tags are implied, raw text of
   scripts and styles is skipped, character references are decoded).
2. Every element gets figures: text, tags, links and punctuation of its subtree, tokens of its
   attributes, tag, depth, place and size among its siblings, kinds of its ancestors.
3. A gradient-boosted ensemble of small trees says how likely the element holds main text.
   There are no labels of pages; it is trained on the pages themselves. The teacher goes by the
   meaning of tags and attribute tokens, and where they leave next to no text, by where most of the
   page's long pieces stand. It is trained on ``TRAINING_PAGES`` pages by order of a hash (at most
   ``TRAINING_NODES`` elements of each, evenly spaced), on
   copies of these with their text rearranged under other tags and tokens, and once more with
   tags and tokens hidden, so that it also learns what main text looks like.
4. Hierarchical decoding: each element is kept or removed, and nothing is kept under a removed
   element. Of all such choices the most likely one is taken, by a sum up the tree.
5. The text of kept elements, in page order: block ends and line breaks are white space, runs
   of white space become one blank.

Cases: a null or empty page, or one without main text, gives an empty text. A page without
any element that the trees accept keeps nothing. Rows are extracted each, also with null or
repeated ids; further columns do not matter. Without pages to learn from, the teacher alone decides. Very long pages are
read whole. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import shared
from annolink.staging import stage

TRAINING_PAGES, TRAINING_NODES = 600, 200
TREES, DEPTH, RATE, BINS = 30, 4, 0.3, 32

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# Elements that a start tag ends, up to the first of the elements that hold them.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = {"ul", "ol", "menu", "dl", "table", "select", "td", "th", "button", "body", "html"}
_OPENS_P = BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dt", "dd", "option", "legend", "button", "select"}

AWAY_TAGS = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "head", "input", "label", "fieldset"} | RAW
MAIN_TAGS = {"article", "main"}
# Tokens here describe the page, not a part of it.
_WHOLE = {"#root", "html", "body"} | MAIN_TAGS
AWAY_TOKENS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs footer foot sidebar side aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login form search share sharing social related recommended recommendations comment comments disqus "
    "reply replies respond discussion pagination pager tags skip copyright legal disclaimer toolbar tooltip hidden complementary contentinfo".split()
)
# Names of parts that may hold more text than the article.
COMMENT_TOKENS = set("comment comments disqus reply replies respond discussion".split())
# Words of names that tell of the page's state: what follows them is no name of this element.
FLAG_TOKENS = {"has", "with", "without", "no", "not"}
# Pieces of text from this length on look like sentences; most of them, and next to none of them.
LONG_PIECE, MOST, SCANT = 60, 0.6, 0.2
# With fewer long pieces than these, names are all there is to go by.
FEW = 3
# Headers count as such outside the main text only, where they may hold the title.
HEADER_TOKENS = {"header", "masthead", "topbar", "banner"}
MAIN_TOKENS = set("article content main post entry body story text articlebody maincontent postcontent entrycontent".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?]")


class Page:
    """Elements in page order: tag, parent, tokens; and pieces of text with their element."""

    def __init__(self, source: str):
        self.tags, self.parents, self.tokens, self.hidden = ["#root"], [-1], [()], [False]
        # (element, text), or (element, None) at the ends of blocks.
        self.pieces: list[tuple[int, str | None]] = []
        self._read(source)

    def _open(self, tag: str, attributes: str, stack: list[int]) -> None:
        tokens, hidden = [], False
        if attributes and not attributes.isspace():
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name == "style":
                    hidden |= "display:none" in value.replace(" ", "").lower()
                elif name in ("hidden", "aria-hidden"):
                    hidden |= name == "hidden" or value.lower() == "true"
                else:
                    for part in value.split():
                        for token in map(str.lower, _TOKEN.findall(part)):
                            if token in FLAG_TOKENS:
                                break
                            tokens.append(token)
        self.tags.append(tag)
        self.parents.append(stack[-1])
        self.tokens.append(tuple(tokens))
        self.hidden.append(hidden)
        stack.append(len(self.tags) - 1)

    def _end_implied(self, names: tuple, stack: list[int]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[at]]
            if tag in names:
                del stack[at:]
                return
            if tag in _HOLDS:
                return

    def _read(self, source: str) -> None:
        stack, at, end, tags, pieces = [0], 0, len(source), self.tags, self.pieces
        lower = None
        while at < end:
            found = _TAG.search(source, at)
            text = source[at : found.start() if found else end]
            if text:
                pieces.append((stack[-1], text))
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found[1] or found[4], found[2] or found[5], found[3]
            if not tag:
                continue
            tag = tag.lower()
            if tag == "br":
                pieces.append((stack[-1], None))
                continue
            if closing:
                for place in range(len(stack) - 1, 0, -1):
                    if tags[stack[place]] == tag:
                        del stack[place:]
                        break
                if tag in BLOCK:
                    pieces.append((stack[-1], None))
                continue
            if tag in BLOCK:
                pieces.append((stack[-1], None))
            if tag in _OPENS_P:
                self._end_implied(("p",), stack)
            if tag in _ENDS:
                self._end_implied(_ENDS[tag], stack)
            self._open(tag, attributes or "", stack)
            if tag in VOID or (attributes or "").endswith("/") and tag not in BLOCK:
                stack.pop()
            elif tag in RAW:
                lower = lower or source.lower()
                close = lower.find("</" + tag, at)
                at = end if close < 0 else max(at, lower.find(">", close) + 1 or end)
                stack.pop()

    def text(self, kept: list[bool]) -> str:
        parts = [" " if text is None else html.unescape(text) if "&" in text else text for node, text in self.pieces if kept[node]]
        return " ".join("".join(parts).split())


KINDS = ["p", "div", "section", "article", "main", "h1", "h2", "h3", "li", "ul", "a", "span", "b", "table", "td", "header", "footer", "nav", "aside", "form"]
_KIND = {tag: i for i, tag in enumerate(KINDS)}
NAMES = [
    "away tag", "main tag", "away tokens", "main tokens", "tokens", "kind", "under away", "under main", "hidden",
    "depth", "own text", "subtree text", "share of page", "subtree tags", "density", "links", "link texts", "marks", "mean piece",
    "siblings", "place", "same tag", "share of siblings", "longest sibling", "children", "paragraphs", "share of parent",
]
N_HINTS = 9
HIDDEN_HINTS = np.array([0, 0, 0, 0, 0, len(KINDS), 0, 0, 0], float)


def _marks_of(page: Page, released: set[int], region: int) -> tuple[list[tuple], list[bool], list[bool]]:
    own, away, main, named = [], [], [], []
    for i, (tag, tokens, parent, hidden) in enumerate(zip(page.tags, page.tokens, page.parents, page.hidden, strict=True)):
        under_away, under_main, under_named = (away[parent], main[parent], named[parent]) if parent >= 0 else (False, False, False)
        away_tokens, main_tokens = 0, 0
        if tag not in _WHOLE:
            if i not in released:
                away_tokens = sum(t in AWAY_TOKENS or t in HEADER_TOKENS and not under_named for t in tokens)
            main_tokens = sum(t in MAIN_TOKENS for t in tokens)
        if i == region:
            main_tokens = max(1, main_tokens)
        away_tag = tag in AWAY_TAGS or tag == "header" and not under_named
        own.append((away_tag, tag in MAIN_TAGS, away_tokens, main_tokens))
        is_away = away_tag or away_tokens > 0 or hidden
        is_main = tag in MAIN_TAGS or main_tokens > 0
        away.append(under_away or is_away)
        main.append(under_main or is_main and not is_away)
        # The page as a whole may be the region, but its headers are no headers of the text.
        named.append(under_named or is_main and not is_away and tag not in ("#root", "html", "body"))
    return own, away, main


def _long_texts(page: Page) -> tuple[list[int], list[int]]:
    """Per element, the text of its subtree in long pieces that are no link, and their number."""
    n = len(page.tags)
    linked, whole, count = [False] * n, [0] * n, [0] * n
    for i in range(1, n):
        linked[i] = page.tags[i] == "a" or linked[page.parents[i]]
    for node, text in page.pieces:
        if text is not None and not linked[node] and (size := len(text.strip())) >= LONG_PIECE:
            whole[node] += size
            count[node] += 1
    for i in range(n - 1, 0, -1):
        whole[page.parents[i]] += whole[i]
        count[page.parents[i]] += count[i]
    return whole, count


def _hints(page: Page) -> tuple[list[tuple], list[bool], list[bool]]:
    """Per element (away tag, main tag, away tokens, main tokens); away and main, itself or above.

    Names are believed where they leave main text. Where they leave next to none, an element with most of
    the page's long pieces is no part to be removed by its name, but a wrapper (comments but not so);
    and where no name tells of main text, the smallest element with most long pieces stands for it.
    """
    marks = _marks_of(page, set(), -1)
    whole, n_long = _long_texts(page)
    total = whole[0]
    if n_long[0] < FEW:
        return marks

    def kept(marks) -> int:
        return sum(len(t.strip()) for node, t in page.pieces if t is not None and marks[2][node] and not marks[1][node] and len(t.strip()) >= LONG_PIECE)

    if kept(marks) >= SCANT * total:
        return marks
    released = {
        i for i, tokens in enumerate(page.tokens)
        if marks[0][i][2] and n_long[i] >= FEW and whole[i] >= MOST * total and not page.hidden[i] and not marks[0][i][0] and COMMENT_TOKENS.isdisjoint(tokens)
    }
    if released:
        marks = _marks_of(page, released, -1)
        if kept(marks) >= SCANT * total:
            return marks
    # From the root down to the element that no single child speaks for.
    free = _marks_of(page, released, 0)[1]
    below: dict[int, list[int]] = {}
    for i in range(1, len(page.tags)):
        below.setdefault(page.parents[i], []).append(i)
    region = 0
    while True:
        inner = [i for i in below.get(region, ()) if not free[i] and whole[i] >= MOST * whole[region] and page.tags[i] in BLOCK and page.tags[i] != "p"]
        if not inner:
            break
        region = inner[0]
    return _marks_of(page, released, region)


def figures(page: Page) -> np.ndarray:
    """A row of NAMES for each element."""
    n, tags, parents = len(page.tags), page.tags, page.parents
    own, marks, pieces = [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        if text is not None and not text.isspace():
            own[node] += len(text)
            pieces[node] += 1
            marks[node] += len(_MARKS.findall(text))
    whole, count, links, link_texts, paragraphs = own[:], [1] * n, [0] * n, [0] * n, [0] * n
    children, same, longest = [0] * n, [{} for _ in range(n)], [0] * n
    for i in range(n - 1, 0, -1):
        parent = parents[i]
        if tags[i] == "a":
            links[i] += 1
            link_texts[i] = whole[i]
        if tags[i] == "p":
            paragraphs[i] += 1
        for held in (whole, count, links, link_texts, marks, paragraphs, pieces):
            held[parent] += held[i]
        children[parent] += 1
        same[parent][tags[i]] = same[parent].get(tags[i], 0) + 1
        longest[parent] = max(longest[parent], whole[i])
    rows, seen, depth = [], [0] * n, [0] * n
    hints, away, main = _hints(page)
    log, total = math.log1p, max(1, whole[0])
    for i in range(n):
        parent = parents[i]
        up = max(parent, 0)
        depth[i] = depth[up] + 1 if parent >= 0 else 0
        if parent >= 0:
            seen[up] += 1
        siblings = children[up]
        rows.append(
            [
                *hints[i], len(page.tokens[i]), _KIND.get(tags[i], len(KINDS)), i > 0 and away[up], i > 0 and main[up], page.hidden[i],
                depth[i], log(own[i]), log(whole[i]), whole[i] / total, log(count[i]), log(whole[i] / count[i]), links[i] / count[i],
                link_texts[i] / max(1, whole[i]), marks[i] / max(1, whole[i]), log(whole[i] / max(1, pieces[i])),
                log(siblings), seen[up] / max(1, siblings), same[up].get(tags[i], 0) / max(1, siblings), whole[i] * siblings / max(1, whole[up]),
                whole[i] / max(1, longest[up]), log(children[i]), log(paragraphs[i]), whole[i] / max(1, whole[up]),
            ]
        )
    return np.array(rows, float)


def teacher(page: Page) -> np.ndarray:
    """1 for elements with main text in their subtree, 0 for others, by tags and tokens."""
    label, (_, away, main) = np.zeros(len(page.tags), np.int64), _hints(page)
    for node, text in page.pieces:
        if text is not None and not text.isspace() and main[node] and not away[node]:
            while node >= 0 and not label[node]:
                label[node], node = 1, page.parents[node]
    return label


def rearranged(page: Page, seed: int) -> str:
    """A page made of the text of another: main text and other parts under other tags and tokens."""
    draw = np.random.default_rng(seed)
    label = teacher(page)
    kept = [html.escape(t.strip()) for node, t in page.pieces if t and not t.isspace() and label[node]]
    pick = lambda of: of[int(draw.integers(len(of)))]
    away_tokens, main_tokens, headers = sorted(AWAY_TOKENS), sorted(MAIN_TOKENS), sorted(HEADER_TOKENS)

    def paragraphs(n):
        forms = ["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>", "<ul><li>{}</li><li>{}</li></ul>", "<h2>{}</h2>"]
        return "".join(pick(forms).format(pick(kept), pick(kept)[:80]) for _ in range(n))

    def part(inside):
        kind = draw.integers(4)
        links = "".join(f'<li><a href="/{i}">{pick(kept)[:20]}</a></li>' for i in range(int(draw.integers(2, 9))))
        words = [f"<ul>{links}</ul>", paragraphs(int(draw.integers(1, 5))), pick(kept)[:60], f"<h3>{pick(kept)[:30]}</h3><p>{pick(kept)}</p>"][kind]
        name = pick(away_tokens if inside or draw.random() < 0.8 else headers)
        tag = pick(["nav", "aside", "footer", "form", "header"][: 4 if inside else 5])
        how = draw.integers(4)
        if how == 0:
            return f"<{tag}>{words}</{tag}>"
        return [f'<div class="{name}">{words}</div>', f'<section id="{name}">{words}</section>', f'<div class="x-{name} y">{words}</div>'][how - 1]

    body = paragraphs(int(draw.integers(1, 6))) + (part(True) if draw.random() < 0.6 else "") + paragraphs(int(draw.integers(1, 6)))
    title = f"<h1>{pick(kept)[:60]}</h1>"
    opening = pick(["article", "main", 'div class="{}"', 'section id="{}"', 'div id="{}" class="wide"', 'div class="{}-wrap"']).format(pick(main_tokens))
    body = f"<{opening}>{title}{body}</{opening.split()[0]}>"
    for _ in range(int(draw.integers(3))):
        body = f"<div>{body}</div>"
    before, after = ("".join(part(False) for _ in range(int(draw.integers(4)))) for _ in range(2))
    return f"<html><head><title>{pick(kept)[:40]}</title></head><body>{before}{body}{after}</body></html>"


class Boosted:
    """Gradient-boosted regression trees of fixed depth for the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = math.log(share / (1 - share)), []
        raw = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            tree, values = self._tree(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            raw += values

    def _tree(self, binned, gradient, curve):
        """Feature, bin per inner node, value per leaf; the values of the rows."""
        features, cuts = np.zeros(2**DEPTH, np.int64), np.full(2**DEPTH, BINS, np.int64)
        node = np.ones(len(binned), np.int64)
        for level in range(DEPTH):
            width = 2 ** (level + 1)
            best = np.full(width, 1e-6)
            for j in range(binned.shape[1]):
                at = node * BINS + binned[:, j]
                g = np.bincount(at, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(at, curve, width * BINS).reshape(width, BINS).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (whole_g - g) ** 2 / (whole_h - h + 1) - whole_g**2 / (whole_h + 1)
                gain[:, -1] = 0
                cut = gain.argmax(axis=1)
                value = gain[np.arange(width), cut]
                better = value > best
                best[better] = value[better]
                features[:width][better], cuts[:width][better] = j, cut[better]
            node = 2 * node + (binned[np.arange(len(binned)), features[node]] > cuts[node])
        g, h = np.bincount(node, gradient, 2 ** (DEPTH + 1)), np.bincount(node, curve, 2 ** (DEPTH + 1))
        leaves = -RATE * g / (h + 1)
        return (features, cuts, leaves), leaves[node]

    def logit(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        for features, cuts, leaves in self.trees:
            node = np.ones(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + (binned[rows, features[node]] > cuts[node])
            raw += leaves[node]
        return raw


def decode(parents: list[int], logits: np.ndarray) -> list[bool]:
    """The most likely choice of kept elements in which nothing is kept under a removed one."""
    n = len(parents)
    gain, loss = logits.clip(-8, 8).tolist(), (-logits.clip(-8, 8)).tolist()
    # Over whole subtrees: gain if the element is kept (its children at their best), loss if not.
    for i in range(n - 1, 0, -1):
        gain[parents[i]] += max(gain[i], loss[i])
        loss[parents[i]] += loss[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[parents[i]] and gain[i] > loss[i]
    return kept


def _training(pages: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Figures and labels of elements of a bounded sample of pages."""
    rows = pages.where(F.octet_length("html") > 0)
    sample = stage(rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(limit).coalesce(1))
    rows = rows.join(F.broadcast(sample), "page_id", "left_semi").select(F.xxhash64("html").alias("h"), F.col("html").cast("binary").alias("html"))

    def task(batches):
        for batch in batches:
            held, labels, order = [], [], []
            for name, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page(source.as_py().decode("utf-8", "replace"))
                if not teacher(page).any():
                    continue
                for page in (page, Page(rearranged(page, name % 2**32)), Page(rearranged(page, name % 2**31))):
                    label = teacher(page)
                    at = np.unique(np.linspace(0, len(label) - 1, min(len(label), TRAINING_NODES)).astype(int))
                    held += list(figures(page)[at])
                    labels += label[at].tolist()
                    order += [name] * len(at)
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(held, pa.list_(pa.float64())), pa.array(labels, pa.int64())], ["h", "x", "y"])

    found = rows.mapInArrow(task, "h long, x array<double>, y long").orderBy("h", "x", "y").limit(6 * limit * TRAINING_NODES).toArrow()
    return np.asarray(found["x"].combine_chunks().flatten(), float).reshape(found.num_rows, len(NAMES)), found["y"].to_numpy()


def train(pages: DataFrame, limit: int = TRAINING_PAGES) -> Boosted | None:
    x, y = _training(pages, limit)
    if not len(y) or y.min() == y.max():
        return None
    bare = x.copy()
    bare[:, :N_HINTS] = HIDDEN_HINTS
    # Most rows with their tags and tokens, so that these stay the better guide.
    return Boosted(np.concatenate([x, x, bare[::2]]), np.concatenate([y, y, y[::2]]))


def extract(source: str, model: Boosted | None) -> str:
    page = Page(source)
    logits = 4.0 * (2 * teacher(page) - 1) if model is None else model.logit(figures(page))
    return page.text(decode(page.parents, logits))


def main_texts(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars per row."""
    held = shared(pages.sparkSession, train(pages, training_pages))
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def task(batches):
        model = held()
        for batch in batches:
            texts = [extract(source.as_py().decode("utf-8", "replace"), model) for source in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))
    found = rows.mapInArrow(task, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
