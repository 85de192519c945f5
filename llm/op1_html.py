"""Main text of web pages by a maximum-scoring subsequence of their tokens.

A page is read as a sequence of words and tags. Words score by where they stand (kind of block, link, size
of the block, signs of boilerplate, being in an `article` or `main`), tags score below zero. The weights are log odds learned from pages that
label themselves with an `article` or `main` element. One linear scan finds the contiguous region of highest
score; its blocks, without those marked as boilerplate inside it, are the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import own, table
from llm.text import weigh

#: Pages used for the weights, at most (about), picked by a hash of the page's id.
SAMPLE = 4000
BATCH_BYTES = 4 << 20
#: Counts that a feature needs to move its weight.
SHRINK = 20

#: Names of the HTML standard.
BLOCKS = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup option
    p pre search section summary table tbody td tfoot th thead title tr ul""".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = "script|style|noscript|template|textarea|svg|math|iframe|object|select|title|audio|video|canvas|button"
#: Elements, roles and words of class and id that mark what is not the article.
ASIDE_TAGS = set("nav footer aside form menu dialog search head fieldset".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
ASIDE_WORDS = set(
    """ad ads adbox adsense advert adverts advertisement advertising alert banner bottombar breadcrumb breadcrumbs byline
    colophon comment commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr header
    infobar legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay
    pager pagination paywall popular popup promo promoted promotion rail recommended related replies reply respond search
    share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar
    trending widget widgets""".split()
)
#: A class with one of these speaks of the page's layout, not of the element.
LAYOUT_WORDS = set("has with no without layout page wrapper container site".split())
TITLE_WORDS = set("article entry post story title heading headline".split())

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?:svg|math)\b(?:[^>"'/]|/(?!>)|"[^"]*"|'[^']*')*/>
    |<(?P<unread>{UNREAD})\b(?:[^>"']|"[^"]*"|'[^']*')*(?:/>|>.*?(?:</(?P=unread)\s*[^>]*>|\Z)|\Z)
    |<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Run:
    """A stretch of text between tags (`tag` empty), or a tag."""

    tag: str = ""
    text: str = ""
    words: int = 0
    block: int = 0
    kind: str = ""  #: name of the innermost block element
    link: bool = False
    aside: bool = False
    article: bool = False


@dataclass
class Page:
    runs: list[Run] = field(default_factory=list)
    has_article: bool = False


def is_aside(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is boilerplate by its name, role, or words in its class and id."""
    if name in ASIDE_TAGS:
        return True
    found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attrs)} if attrs.strip(" /") else {}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role", "").lower() in ASIDE_ROLES:
        return True
    named = {w.lower() for w in NAME_PARTS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if name == "header":
        return not in_article and not named & TITLE_WORDS
    if name in ("html", "body", "main") or not named & ASIDE_WORDS or named & LAYOUT_WORDS:
        return False
    return not (named & TITLE_WORDS and named & ASIDE_WORDS <= {"header", "byline", "banner"})


def read(html: str) -> Page:
    """Runs of a page, in order. Elements left open end with their parent; a stray end tag is ignored."""
    page = Page()
    stack: list[tuple[str, bool, bool, bool, str]] = []  # name, aside, article, link, block
    aside = article = link = False
    kind, block, at = "", 0, 0

    def text(raw: str) -> None:
        if raw:
            raw = entities.unescape(raw) if "&" in raw else raw
            page.runs.append(Run("", raw, len(raw.split()), block, kind, link, aside, article))

    def restore() -> None:
        nonlocal aside, article, link, kind
        _, aside, article, link, kind = stack[-1] if stack else ("", False, False, False, "")

    for found in TOKEN.finditer(html):
        text(html[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            text(" ")
        if name in BLOCKS:
            block += 1
        if found["end"]:
            page.runs.append(Run(name, "", 0, block, kind, link, aside, article))
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    restore()
                    break
        else:
            if name in BLOCKS or name in ("body",):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p" or (name == "li" and stack[depth][0] == "li"):
                        del stack[depth:]
                        restore()
                        break
                    if stack[depth][0] in BLOCKS:
                        break
            if name not in VOID and not found["attrs"].endswith("/"):
                aside = aside or is_aside(name, found["attrs"], article)
                article = article or (name in ("article", "main") and not aside)
                page.has_article |= article
                link = link or name == "a"
                kind = name if name in BLOCKS else kind
                stack.append((name, aside, article, link, kind))
            page.runs.append(Run(name, "", 0, block, kind, link, aside, article))
    text(html[at:])
    return page


def size_class(words: int) -> str:
    return "n<5" if words < 5 else "n<15" if words < 15 else "n<50" if words < 50 else "n>=50"


def block_sizes(page: Page) -> Counter:
    sizes: Counter = Counter()
    for run in page.runs:
        sizes[run.block] += run.words
    return sizes


def word_features(page: Page, run: Run, words_in_block: int) -> tuple[str, ...]:
    found = (f"b:{run.kind}", f"l:{int(run.link)}", size_class(words_in_block), f"a:{int(run.aside)}")
    # Not being in an article says something only where there is one.
    return (*found, f"r:{int(run.article)}") if page.has_article else found


def count_features(page: Page) -> Counter:
    """`(feature, inside)`: words and tags of a self-labelled page by feature, inside its article or not."""
    out: Counter = Counter()
    sizes = block_sizes(page)
    for run in page.runs:
        inside = int(run.article and not run.aside)
        if run.tag and not run.aside:
            out[f"t:{run.tag}", inside] += 1
        elif run.words:
            for feature in word_features(page, run, sizes[run.block]):
                # What is boilerplate by its mark says nothing against the kind of block it is in.
                if not (run.aside and feature[0] == "b"):
                    out[feature, inside] += run.words
    return out


@dataclass
class Weights:
    """Log odds of features; what has not been seen counts a little for content."""

    odds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def fit(counts: dict[tuple[str, int], int]) -> Weights:
        """Log odds against the share of all words that is inside, shrunk to zero for what was rarely seen."""
        counts = Counter(counts)
        counts["a:1", 0] += 100
        counts["l:1", 0] += 20
        inside, outside = (sum(n for (f, side), n in counts.items() if f[0] == "n" and side == s) + 1 for s in (1, 0))
        share = inside / (inside + outside)
        odds = {}
        for f in {f for f, _ in counts}:
            a, b = counts[f, 1] + SHRINK * share, counts[f, 0] + SHRINK * (1 - share)
            odds[f] = math.log(a / b) - math.log(inside / outside)
        return Weights(odds)

    def tag(self, name: str) -> float:
        return max(-1.0, min(-0.02, 0.2 * self.odds.get(f"t:{name}", -1.0)))

    def word(self, page: Page, run: Run, words_in_block: int) -> float:
        """Score of each word of a run."""
        features = word_features(page, run, words_in_block)
        return sum(max(-3.0, min(3.0, self.odds.get(f, 0.5))) for f in features) / len(features)


def main_text(html: str | None, weights: Weights) -> str:
    """Text of the region of highest score: white space in a block becomes one space, blocks are joined by an empty line."""
    if not html:
        return ""
    page = read(html)
    sizes = block_sizes(page)
    # Marked boilerplate is never part of the text, so it neither ends nor extends a region.
    scores = [
        0.0
        if run.aside
        else weights.tag(run.tag)
        if run.tag
        else run.words * weights.word(page, run, sizes[run.block])
        for run in page.runs
    ]
    best, best_begin, best_end = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_begin, best_end = total, begin, i + 1
    blocks: dict[int, list[str]] = {}
    whole = {run.block for run, score in zip(page.runs[best_begin:best_end], scores[best_begin:best_end]) if score > 0}
    for run in page.runs:
        if not run.tag and not run.aside and run.block in whole:
            blocks.setdefault(run.block, []).append(run.text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(b for b in joined if b)


def fit(pages: DataFrame, page_id: str, html: str) -> Weights:
    """Weights from a bounded sample of the self-labelled pages."""
    rows = pages.count()
    part = F.pmod(F.xxhash64(F.lit(3), F.col(f"`{page_id}`")), F.lit(1 << 20))
    sample = pages if rows <= SAMPLE else pages.where(part < int((1 << 20) * SAMPLE / rows))

    def run(batches):
        for batch in batches:
            total: Counter = Counter()
            for page in map(read, filter(None, batch.column(0).to_pylist())):
                if page.has_article:
                    total.update(count_features(page))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in total], pa.string()),
                    pa.array([k[1] for k in total], pa.int32()),
                    pa.array(list(total.values()), pa.int64()),
                ],
                names=["feature", "inside", "n"],
            )

    counted = sample.select(F.col(f"`{html}`")).mapInArrow(run, "feature string, inside int, n bigint")
    # Features are names of HTML elements: the thousand most frequent are more than the standard has.
    summed = counted.groupBy("feature", "inside").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "feature", "inside")
    return Weights.fit({(r["feature"], r["inside"]): r["n"] for r in summed.limit(1000).collect()})


def add_main_text(pages: DataFrame, html: str, name: str, page_id: str = "page_id") -> DataFrame:
    """Append the main text of `html` in column `name`. Null, empty and contentless pages give empty text.

    Repeated pages give repeated rows; an empty table gives an empty result.
    """
    weights = fit(pages, page_id, html)

    def run(batches):
        for batch in batches:
            for part in weigh([batch], html, BATCH_BYTES):
                texts = [main_text(h, weights) for h in part.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, name]
                )

    return pages.mapInArrow(run, pages.withColumn(name, F.lit("").cast("string")).schema)


def op1_html(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    (text,) = own("text")
    done = add_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "html", text)
    return done.select(
        "page_id", "url", F.col(text).alias("text"), F.length(text).cast("long").alias("n_chars")
    )


QUERIES = {"op1_html": op1_html}
ORACLES: dict[str, str] = {}
