"""The main text of web pages as the maximum-scoring run of words and tags.

1. One linear pass cuts a page into words and tags. Scripts, styles and comments of the
   markup are skipped, elements that the page leaves open are closed as browsers do.
2. Words are judged by the elements around them, block by block: a logistic model over tag
   names and the words of ``class``, ``id`` and ``role``. A word of content scores up to one,
   a word of anything else nothing. Tags score below zero, the more so the rarer they are in
   content. Model and tag scores are learnt here, in numpy, from the labelled pages below.
3. One linear scan finds the contiguous run of words and tags with the largest sum. If it
   lies in an element that frames the content of labelled pages, it grows to that element, so
   that a long list of links inside an article costs nothing of what follows it.
4. The blocks of words inside the run that score are the text; adverts, forms or comments in
   it have no score and stay out.

The labelled pages are made by a rule: parts of pages in common markup, each known to be
content or not, in common frames. They are a fixed number, so what is shipped to the tasks
has a fixed size, and a page gives the same text in every table. Pages are independent of each
other: the query is one map over the table without a shuffle.

Defined cases: a NULL or empty page, one of white space, and one without any content give an
empty text; plain text without tags is content; an unclosed script, style or comment ends the
page; character references are decoded once, those that are none stay; rows that repeat give
a row each; other columns are carried along by ``extract`` and may have any names; an empty
table gives an empty result. Nothing is cut or capped.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import table

# Names fixed by HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes template noscript".split())
UNSEEN = frozenset("svg math object canvas audio video select datalist option optgroup".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Elements that part words without ending a block.
GAPS = frozenset("br td th img input button label".split())
#: An opening tag ends an open element of these names, up to the nearest of the others.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "a": ({"a"}, BLOCKS),
}
#: An open paragraph ends before a block, unless one of these stands between.
PARAGRAPH_ENDS = ({"p"}, {"td", "th", "table", "button", "li", "div", "article", "section", "blockquote"})

MARKUP = re.compile(
    r"<!--(?:(?:>|->)|(?:.*?(?:--!?>|\Z)))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^<>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)>"""
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I
)
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Names that tell a page's topic and not an element's purpose.
TOPIC = re.compile(r"(?:tag|category|cat|topic|author|lang)[-_]", re.I)
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# ---------------------------------------------------------------------------------------------
# Labelled pages. A part is markup with words ``w``; whether they are content is its label.

CONTENT_PARTS = (
    "<h1>w w w</h1>", "<h2>w w</h2>", "<h3>w w</h3>", "<p>w w w w w w</p>", "<p>w w <a>w</a> w w w</p>",
    "<p>w <em>w</em> w <b>w w</b> w</p>", "<blockquote><p>w w w w</p></blockquote>",
    "<ul><li>w w w w</li><li>w w w <a>w</a> w</li></ul>", "<ol><li>w w w w</li><li>w w w w</li></ol>",
    "<pre><code>w w w w</code></pre>", "<figure><img><figcaption>w w w</figcaption></figure>",
    "<table><tr><th>w</th><th>w</th></tr><tr><td>w w</td><td>w w</td></tr></table>",
    "<dl><dt>w</dt><dd>w w w</dd></dl>", "<div>w w w w w w w</div>", "<section><h2>w w</h2><p>w w w w</p></section>",
    "<header><h1>w w w</h1></header>", "w w w w w<br><br>w w w w w",
)
CONTENT_FRAMES = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
    '<div id="content">{}</div>', '<div class="article-body">{}</div>', '<div class="post-content">{}</div>',
    '<div class="entry-content">{}</div>', '<div class="story">{}</div>', '<section class="text">{}</section>',
    '<div class="post">{}</div>', '<div id="main">{}</div>', '<div role="main">{}</div>',
    '<div class="body-text">{}</div>', "<div>{}</div>", "<section>{}</section>",
    "<table><tr><td>{}</td></tr></table>", "{}",
)
#: Frames that say nothing of what they hold.
PLAIN_FRAMES = CONTENT_FRAMES[-4:]
LINKS = "<ul><li><a>w</a></li><li><a>w w</a></li><li><a>w</a></li></ul>"
#: Names in ``class``, ``id`` or ``role`` of what is not content.
OTHER_NAMES = (
    "ad", "ads", "advert", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "cookie", "cookies", "consent", "gdpr", "notice", "alert", "notification", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "paywall", "disclaimer", "copyright", "legal",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "topbar", "toolbar",
    "header", "masthead", "footer", "colophon", "sidebar", "aside", "widget", "rail", "related", "recommended",
    "trending", "popular", "teaser", "share", "sharing", "social", "tags", "complementary", "contentinfo",
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion", "feedback",
    "search", "form", "skip", "hidden",
)
OTHER_PARTS = (
    f"<nav>{LINKS}</nav>", f"<header><a>w w</a>{LINKS}</header>", "<header><p>w w w</p></header>",
    f"<footer><p>w w w w</p>{LINKS}</footer>", "<footer>w w w <a>w</a></footer>", f"<aside><h3>w w</h3>{LINKS}</aside>",
    "<aside><p>w w w w w</p></aside>", "<form><p>w w</p><label>w w</label><button>w</button></form>",
    "<dialog><p>w w w w</p></dialog>", "<menu><li><a>w</a></li></menu>", "<button>w w</button>",
    "<search>w w</search>",
)
#: Elements that hold anything.
NEUTRAL_FRAMES = (
    "{}", "<div>{}</div>", "<div><div>{}</div></div>", '<div class="container"><div class="row">{}</div></div>',
    '<div id="page"><div class="wrapper">{}</div></div>',
)
OTHER_BODIES = ("w w w w w", "<p>w w w w w w</p>", f"<h3>w w</h3>{LINKS}", "<div><p>w w w</p><a>w w</a></div>")
OTHER_HOLDERS = (
    '<div class="{}">{}</div>', '<section id="{}">{}</section>', '<article class="{}">{}</article>',
    '<ul class="{}"><li>{}</li></ul>', '<ol class="{}"><li>{}</li></ol>',
)


def frame_names() -> frozenset[str]:
    """Names of elements that hold the content of labelled pages, and not just anything."""
    def seen(frames) -> set[str]:
        tags = (found for frame in frames for found in MARKUP.finditer(frame) if not found["end"])
        return {one for found in tags for one in names_of(found["name"], found["rest"])}

    return frozenset(seen(CONTENT_FRAMES) - seen(PLAIN_FRAMES) - seen(NEUTRAL_FRAMES))


def labelled_parts() -> list[tuple[str, int]]:
    """Markup of parts of pages and whether their words are content."""
    made = []
    for number, frame in enumerate(CONTENT_FRAMES):
        for part in CONTENT_PARTS:
            made.append((frame.format(part), 1))
    for number, name in enumerate(OTHER_NAMES):
        for body in OTHER_BODIES:
            for holder in OTHER_HOLDERS:
                # Such parts stand alone and inside the content's own frames.
                made.append((holder.format(name, body), 0))
                made.append((CONTENT_FRAMES[number % len(CONTENT_FRAMES)].format(holder.format(name, body)), 0))
                made.append((CONTENT_FRAMES[number % 3].format(holder.format(name, body)), 0))
    for frame in PLAIN_FRAMES:
        made += [(frame.format(LINKS), 0)] * 16
    for part in OTHER_PARTS:
        made += [(part, 0)] * 4
        for frame in CONTENT_FRAMES:
            made.append((frame.format(part), 0))
    return [(NEUTRAL_FRAMES[at % len(NEUTRAL_FRAMES)].format(part), label) for at, (part, label) in enumerate(made)]


# ---------------------------------------------------------------------------------------------
# Cutting a page.


def names_of(tag: str, rest: str) -> list[str]:
    """What the model sees of an element: its name and the words of its naming attributes."""
    found = [tag]
    if rest and ("=" in rest or "hidden" in rest.lower()):
        for attribute, value in ATTRIBUTE.findall(rest):
            kind = attribute.lower()
            if kind in ("hidden", "aria-hidden", "style"):
                shown = {"hidden": False, "aria-hidden": value.strip("\"'").lower() != "true"}
                if not shown.get(kind, not NOT_SHOWN.search(value)):
                    found.append(".hidden")
                continue
            for name in value.strip("\"'").split():
                if not TOPIC.match(name):
                    found += ["." + word.lower() for word in NAME_PART.findall(name)]
    return found


def _markup(source: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Where markup starts and ends, and its match if it is a tag to follow."""
    at = 0
    while (found := MARKUP.search(source, at)) is not None:
        at, name = found.end(), (found["name"] or "").lower()
        if name in RAW and not found["end"]:
            stop = RAW_ENDS[name].search(source, at)
            at = stop.end() if stop else len(source)
        yield found.start(), at, found if name and name not in RAW else None


#: What a frame of content may at least add to the logit; a comment's frame adds less.
FRAME = -2.0


class Page:
    """A page as a list of items: runs of words in one block, and tags.

    ``kinds[i]`` is a tag's name or NULL for words, ``texts[i]`` the decoded words, ``blocks[i]``
    the block they belong to. A block has the logit of the elements around its words; elements
    know their parent, their first and last item and whether they are a frame of content.
    """

    def __init__(self, source: str, weights: dict[str, float], frames: frozenset[str] = frozenset()):
        self.weights, self.frames = weights, frames
        self.kinds: list[str | None] = []
        self.texts: list[str] = []
        self.blocks: list[int] = []
        self.block_logits: list[list[tuple[float, int]]] = []
        self.parents, self.firsts, self.lasts, self.framing = [-1], [0], [0], [False]
        self.owners: list[int] = []
        self._open: list[tuple[str, int, list[str]]] = [("", 0, [])]
        self._names: Counter = Counter()
        self._seen: Counter = Counter()
        self._logit = 0.0
        self._fresh = True
        self._unseen = 0
        self._read(source)
        while self._open:
            self._close()

    def _read(self, source: str) -> None:
        at = 0
        for start, end, found in _markup(source):
            if start > at:
                self._words(source[at:start])
            at = end
            if found is None:
                continue
            if found["end"]:
                self._end(found["name"].lower())
            else:
                self._start(found["name"].lower(), found["rest"])
        if at < len(source):
            self._words(source[at:])

    def _words(self, raw: str) -> None:
        if self._unseen:
            return
        text = html.unescape(raw)
        if self._fresh:
            if text.isspace():
                return
            self.block_logits.append([])
            self._fresh = False
        self.kinds.append(None)
        self.texts.append(text)
        self.blocks.append(len(self.block_logits) - 1)
        self.owners.append(self._open[-1][1])
        self.block_logits[-1].append((self._logit, len(text.split())))

    def _tag(self, name: str) -> None:
        self.kinds.append(name)
        self.texts.append("")
        self.blocks.append(-1)
        self.owners.append(self._open[-1][1] if self._open else 0)

    def _parts(self, name: str, names: list[str]) -> bool:
        """Whether the element is a block, by its name or by being marked as no content."""
        return name in BLOCKS or any(self.weights.get(one, 0.0) < -1 for one in names if one[0] == ".")

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body", "head"):
            return
        if name in BLOCKS and self._names["p"]:
            self._end_open(*PARAGRAPH_ENDS)
        if name in ENDS and any(self._names[one] for one in ENDS[name][0]):
            self._end_open(*ENDS[name])
        names = names_of(name, rest)
        if self._parts(name, names):
            self._fresh = True
        self._tag(name)
        if name in GAPS and not self._fresh and not self._unseen:
            self.texts[-1] = " "
            self.blocks[-1] = len(self.block_logits) - 1
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            return
        added = []
        for one in set(names):
            self._seen[one] += 1
            if self._seen[one] == 1:
                added.append(one)
        self._logit += sum(self.weights.get(one, 0.0) for one in added)
        self.parents.append(self._open[-1][1])
        self.firsts.append(len(self.kinds) - 1)
        self.lasts.append(-1)
        own = sum(self.weights.get(one, 0.0) for one in set(names))
        self.framing.append(own > FRAME and not self.frames.isdisjoint(names))
        self._open.append((name, len(self.framing) - 1, names))
        self._names[name] += 1
        self._unseen += name in UNSEEN

    def _end_open(self, ended: set[str], walls) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            name = self._open[depth][0]
            if name in ended:
                while len(self._open) > depth:
                    self._close()
                return
            if name in walls:
                return

    def _end(self, name: str) -> None:
        if name in ("html", "body", "head"):
            return
        if name == "br":
            self._start("br", "")
            return
        if not self._names[name]:
            if name in BLOCKS:
                self._fresh = True
            return
        while True:
            last = self._open[-1][0]
            self._close()
            if last == name:
                break
        self._tag(name)
        if name in GAPS and not self._fresh:
            self.texts[-1] = " "
            self.blocks[-1] = len(self.block_logits) - 1

    def _close(self) -> None:
        name, number, names = self._open.pop()
        self.lasts[number] = len(self.kinds)
        if not number:
            return
        for one in set(names):
            self._seen[one] -= 1
            if not self._seen[one]:
                self._logit -= self.weights.get(one, 0.0)
        self._names[name] -= 1
        self._unseen -= name in UNSEEN
        if self._parts(name, names):
            self._fresh = True

    def block_scores(self, bias: float) -> list[float]:
        """What a word of each block scores, from the mean logit of its words."""
        scores = []
        for told in self.block_logits:
            words = sum(count for _, count in told)
            logit = bias + (sum(one * count for one, count in told) / words if words else 0.0)
            scores.append(max(0.0, float(np.tanh(logit / 2))))
        return scores


# ---------------------------------------------------------------------------------------------
# Learning and extracting.


#: The score of a tag that no labelled page has.
UNKNOWN_TAG = -0.1


class Model:
    """Weights of names, the bias, the scores of tags, and the names of frames of content."""

    def __init__(self, weights: dict[str, float], bias: float, tags: dict[str, float], frames: frozenset[str]):
        self.weights, self.bias, self.tags, self.frames = weights, bias, tags, frames

    def score(self, tag: str) -> float:
        return self.tags.get(tag, UNKNOWN_TAG)


def train(parts: list[tuple[str, int]], steps: int = 3000, decay: float = 1e-4) -> Model:
    """Logistic regression on blocks of labelled parts, and tag scores from the same parts.

    Full gradient steps from zero: the result does not depend on any order or chance.
    """
    names, rows, labels, counted = {}, [], [], {0: Counter(), 1: Counter()}
    for source, label in parts:
        page = _Contexts(source)
        rows += page.contexts
        labels += [label] * len(page.contexts)
        counted[label].update(kind for kind in page.kinds if kind)
        for context in page.contexts:
            for one in context:
                names.setdefault(one, len(names))
    matrix = np.zeros((len(rows), len(names) + 1), dtype=np.float64)
    for number, context in enumerate(rows):
        matrix[number, [names[one] for one in context]] = 1
    matrix[:, -1] = 1
    truth = np.array(labels, dtype=float)
    # Both classes weigh the same, and content a little more where nothing is known.
    share = np.where(truth == 1, 1.2 / max(1, truth.sum()), 1 / max(1, (1 - truth).sum()))
    solved, momentum = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-(matrix @ solved)))
        slope = matrix.T @ (share * (guess - truth)) + decay * np.append(solved[:-1], 0)
        momentum = 0.9 * momentum + slope
        solved -= 0.5 * momentum
    totals = {label: sum(tags.values()) + 1 for label, tags in counted.items()}

    def cost(tag: str) -> float:
        odds = np.log((counted[1][tag] + 1) / totals[1]) - np.log((counted[0][tag] + 1) / totals[0])
        return min(-0.02, float(odds) / 4)

    tags = {tag: cost(tag) for tag in {*counted[0], *counted[1]}}
    weights = {one: float(solved[at]) for one, at in names.items()}
    return Model(weights, float(solved[-1]), tags, frame_names())


class _Contexts(Page):
    """The names around each block of words of a labelled part."""

    def __init__(self, source: str):
        self.contexts: list[frozenset[str]] = []
        super().__init__(source, {})

    def _words(self, raw: str) -> None:
        fresh = self._fresh
        super()._words(raw)
        if fresh and not self._fresh:
            self.contexts.append(frozenset(one for one, times in self._seen.items() if times))


@functools.cache
def default_model() -> Model:
    """The model of the labelled pages above; the same in every process."""
    return train(labelled_parts())


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum above zero, the first if several."""
    best, low, high, total, start = 0.0, 0, 0, 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, low, high = total, start, at + 1
    return low, high


def extract_text(source: str | None, model: Model) -> str:
    """The main text of one page; blocks are joined by an empty line."""
    if not source:
        return ""
    page = Page(source, model.weights, model.frames)
    words = page.block_scores(model.bias)
    scores = [
        words[page.blocks[at]] * len(text.split()) if kind is None else model.score(kind)
        for at, (kind, text) in enumerate(zip(page.kinds, page.texts))
    ]
    low, high = best_run(scores)
    if low == high:
        return ""
    while page.kinds[low] is not None:
        low += 1
    owner = page.owners[low]
    while owner and page.lasts[owner] < high:
        owner = page.parents[owner]
    while owner and not page.framing[owner]:
        owner = page.parents[owner]
    if owner:
        low, high = min(low, page.firsts[owner]), max(high, page.lasts[owner])
    found: dict[int, list[str]] = {}
    for at in range(low, high):
        block = page.blocks[at]
        if block >= 0 and words[block] > 0:
            found.setdefault(block, []).append(page.texts[at])
    texts = (" ".join("".join(pieces).split()) for pieces in found.values())
    return "\n\n".join(text for text in texts if text)


def extract(pages: DataFrame, source: str = "html", model: Model | None = None) -> DataFrame:
    """``row`` with all columns of a page, and its main ``text``."""
    model = model or default_model()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time, so that the texts of a large batch are never all held.
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [extract_text(one.as_py(), model) for one in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], ["row", "text"]
                )

    rows = pages.select(F.struct("*").alias("row"), F.col(source).cast("string").alias("source"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(read, f"row {kind}, text string")


def op13_main_text(spark, sf_dir) -> DataFrame:
    """The main text of every page and its length."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )
