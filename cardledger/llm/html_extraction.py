"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. A word's score is positive where its open elements
(names, class and id words) speak for content and negative where they speak against it; a tag's
score is negative. The weights are log odds counted on labelled pages: pages that mark their content
by one article (or one main) element. One linear scan finds the contiguous region of the highest
sum; its text, without what lies in elements that are never content, is the page's text.

Elements and attribute words that the labelled pages do not show have weights from small tables of
fixed values, so menus or comments of a kind not seen in training still count against a region.

Blocks: text is cut at block elements; inline elements and line breaks are not block borders (a line
break counts as white space). Character references are decoded, white space becomes one blank.

Defined cases: null or empty html, and pages without any word of positive score, give an empty text.
A tag left open ends with its parent or the page; an end tag that was never opened is ignored. An
unclosed comment, script, style or title runs to the end of the page. Repeated rows give repeated results.
Without labelled pages the fixed values alone give the weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cardledger.llm.texts import as_bytes

MAX_LABELLED = 1_000  # labelled pages that training takes at most, chosen by a hash of their id

# Element names.
RAW = "script|style|textarea|title|iframe"  # what is inside is not markup
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul caption".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SPACES = set("br td th".split())
NEVER = set(
    "nav footer aside form button head menu dialog label noscript template svg object select".split()
)
CONTENT = ("article", "main")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
MARKED = "+"  # before the names of tags inside such an element
# Words of class, id and role attributes that stand for what is not the article.
JUNK_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "outbrain pagination pager popup promo promoted related replies reply responses share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription taboola toolbar widget alert copyright login search skip".split()
)
# Elements that stand anywhere: what they hold says nothing, only their tags cost.
NEUTRAL = set("ul ol li a div span section table tbody tr td th i em strong u small sup sub font center html body dl dt dd".split())
BIAS = 0.2  # log odds of a word with no name around it that says anything
# Fixed log odds of elements that the labelled pages do not show.
UNSEEN = {"p": 2.0, "article": 4.0, "main": 3.0, "h1": 0.5, "h2": 0.5, "h3": 0.5, "blockquote": 1.0, "pre": 1.0}

_token = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>|<[!?][^>]*+>",
    re.S | re.I,
)
_attribute = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_part = re.compile(r"[a-zA-Z]+")


def junk(names: set[str]) -> bool:
    return not names.isdisjoint(JUNK_WORDS)


class Weights:
    """Log odds of words by the names around them, and costs of tags by their name."""

    def __init__(self, inside: Counter, outside: Counter, tags_in: Counter, tags_out: Counter):
        total_in, total_out = inside["*"] + 2, outside["*"] + 2
        self.words: dict[str, float] = {}
        for key in {*inside, *outside} - {"*", *NEUTRAL}:
            odds = math.log((inside[key] + 1) / total_in) - math.log((outside[key] + 1) / total_out)
            self.words[key] = max(-4.0, min(4.0, odds))
        # The more of a name's tags lie outside content, the more each costs.
        self.tags = {
            name: -0.02 - 2 * (tags_out[name] + 1) / (tags_in[name] + tags_out[name] + 2)
            if tags_out[name] > tags_in[name]
            else -0.02
            for name in {*tags_in, *tags_out}
        }

    def word(self, key: str) -> float:
        if key in self.words:
            return self.words[key]
        if key in UNSEEN:
            return UNSEEN[key]
        return -4.0 if key in NEVER or key.startswith(".:") and key[2:] in JUNK_WORDS else 0.0

    def tag(self, name: str) -> float:
        if name.startswith(MARKED):
            return -0.02
        return self.tags.get(name, -0.02 if name in UNSEEN else -0.2)


class Page:
    """The tokens of a page: runs of text with their elements' keys, and tags.

    A run of text: (block number, text, words, elements, is it never content, is it marked). A tag: its name, with
    MARKED before it inside a content element.
    """

    def __init__(self, html: str):
        self.items: list[tuple | str] = []
        stack: list[tuple[str, tuple[str, ...], bool, bool]] = [("", (), False, False)]
        open_names: Counter = Counter()
        block = at = 0

        def text(raw: str) -> None:
            name, keys, never, content = stack[-1]
            plain = unescape(raw) if "&" in raw else raw
            self.items.append((block, plain, len(plain.split()), keys, never, content))

        def tag(name: str) -> None:
            self.items.append(f"{MARKED}{name}" if stack[-1][3] else name)

        def close(to: int) -> None:
            for entry in stack[to:]:
                open_names[entry[0]] -= 1
            del stack[to:]

        for m in _token.finditer(html):
            if m.start() > at:
                text(html[at : m.start()])
            at = m.end()
            name = (m[3] or "").lower()
            if not name:
                if m[1]:
                    tag(m[1].lower())
                continue
            tag(name)
            if name in BLOCKS:
                block += 1
            elif name in SPACES:
                text(" ")
            if m[2]:  # an end tag closes its element and what is open inside
                if open_names[name] > 0:
                    close(max(i for i in range(1, len(stack)) if stack[i][0] == name))
                continue
            if name in VOID or (m[4] or "").endswith("/"):
                continue
            if name in BLOCKS and name != "p" and open_names["p"] > 0 or name == "p" and open_names["p"] > 0:
                i = max(i for i in range(1, len(stack)) if stack[i][0] == "p")
                # a paragraph ends where the next block starts, unless a block inside it is open
                if not any(e[0] in BLOCKS for e in stack[i + 1 :]):
                    close(i)
            if name == "li" and open_names["li"] > 0:
                i = max(i for i in range(1, len(stack)) if stack[i][0] == "li")
                if not any(e[0] in ("ul", "ol", "menu") for e in stack[i + 1 :]):
                    close(i)
            _, keys, never, content = stack[-1]
            words: set[str] = set()
            telling: set[str] = set()
            if m[4]:
                for kind, a, b, c in _attribute.findall(m[4]):
                    parts = {w.lower() for w in _part.findall(a or b or c)}
                    words |= parts
                    # In marked content an id names a place of the text, such as a section on search.
                    if not (content and kind.lower() == "id"):
                        telling |= parts
            never = never or name in NEVER or (name == "header" and not content)
            judged = name not in CONTENT and name not in ("html", "body") and not (content and name in HEADINGS)
            never = never or (judged and junk(telling))
            own = (name, *sorted(f".:{w}" for w in words))
            stack.append((name, keys + own, never, content or name in CONTENT))
            open_names[name] += 1
        if at < len(html):
            text(html[at:])


def train(pages: list[str]) -> Weights:
    """Weights from pages that mark their content."""
    inside, outside, tags_in, tags_out = Counter(), Counter(), Counter(), Counter()
    for html in pages:
        for item in Page(html).items:
            if isinstance(item, str):
                (tags_in if item.startswith(MARKED) else tags_out)[item.removeprefix(MARKED)] += 1
                continue
            _, _, n, keys, never, marked = item
            counter = inside if marked and not never else outside
            counter["*"] += n
            for key in set(keys):
                counter[key] += n
    return Weights(inside, outside, tags_in, tags_out)


def extract(html: str, weights: Weights) -> str:
    """The text of the best contiguous region."""
    items = Page(html).items
    best = total = 0.0
    start, chosen = 0, (0, 0)
    scored: dict[tuple, float] = {}
    for i, item in enumerate(items):
        if isinstance(item, str):
            total += weights.tag(item)
        elif item[2]:
            _, _, n, keys, never, marked = item
            if keys not in scored:
                odds = BIAS + sum(weights.word(k) for k in dict.fromkeys(keys))
                # A word is worth 1 where all speaks for content, -1 where all speaks against it; what
                # will be left out in the middle of marked content is worth nothing.
                scored[keys] = (0.0 if marked else -1.0) if never else math.tanh(odds / 2)
            total += n * scored[keys]
        if total > best:
            best, chosen = total, (start, i + 1)
        if total <= 0:
            total, start = 0.0, i + 1
    blocks: dict[int, list[str]] = {}
    for item in items[chosen[0] : chosen[1]]:
        if not isinstance(item, str) and not item[4]:
            blocks.setdefault(item[0], []).append(item[1])
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def labelled_pages(
    pages: DataFrame, most: int = MAX_LABELLED, html_col: str = "html", id_col: str = "page_id"
) -> list[str]:
    """At most `most` pages with one content element, on the driver, chosen by a hash of their id."""
    marked = F.size(F.split(F.lower(html_col), r"<article[\s>]")) == 2
    marked |= F.size(F.split(F.lower(html_col), r"<main[\s>]")) == 2
    found = pages.where(marked).select(
        F.col(html_col).alias("html"), F.xxhash64(id_col, html_col).alias("by")
    )
    total = found.count()
    if total > most:  # about `most` before the sort, so that tasks hand over few pages
        found = found.where(F.pmod("by", F.lit(1_000_000)) < int(1_000_000 * 1.2 * most / total) + 1)
    return [r.html for r in found.orderBy("by", "html").limit(most).collect()]


TEXTS = StructType(
    [
        StructField("page_id", LongType()),
        StructField("url", StringType()),
        StructField("text", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def main_text(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """TEXTS for every row of `pages`; only the three named columns are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.decode(), weights) if h else "" for h in as_bytes(batch["html"])]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=TEXTS.names,
            )

    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return slim.mapInArrow(run, TEXTS)
