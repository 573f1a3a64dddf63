"""The main text of web pages: the stretch of a page with the highest sum of scores.

A page is a sequence of tags and words. Words score above zero and tags below, by weights learnt from labelled pages;
one scan finds the contiguous stretch with the highest sum (``best_stretch``). Menus, adverts and their like have many tags and
few words, so the stretch is the article. What lies within it but is marked as no part of an article (``Page.cut``: navigation, asides,
forms, comments and so on) counts as one tag in the sequence and is left out of the text. Lists, tables and paragraphs right beside the
stretch are part of it, unless they are links (``grown``): their many tags would else cut an article's end.

Weights depend on a word's or tag's context: whether it is inside an element that names the article, outside of
one, or on a page without any; the block's tag; for words, whether they are in links. A weight is the share of the context's words
(or tags) that labelled pages have in their article (outside of it), with a prior from the coarser
context: detail within tag, tag within place, place. Labelled pages are those that name exactly one article themselves (``article``,
``main``, a role or property that says so); pages that name none get the weights of tags without the place.

Counts for the weights are summed over all labelled pages of the table; there are a few for each element name.
Names other than the known ones share one. Pages are read whole, one at a time; time and memory grow
with the length of the longest.

Text: character references are decoded, white space within a block (any that Unicode calls so) becomes one blank, blocks are joined by an empty
line. Cases: null, empty and wordless pages, and those where no stretch scores above zero, have an empty text. Rows that repeat a page_id
are pages of their own. Other columns are ignored. An empty table gives no rows; without labelled pages the
priors are the weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import BATCH_ROWS
from tidemart.llm.page_markup import BLOCKS, FLOW, Page, read_page

# What a word gains inside an article and a tag costs outside of one, and the shares assumed beforehand.
WORD_GAIN, TAG_COST = 1.5, 5.0
PRIOR_SHARE = {"in": {"word": 0.95, "tag": 0.95}, "out": {"word": 0.05, "tag": 0.05}, "none": {"word": 0.67, "tag": 0.5}}
PRIOR_WEIGHT = {"word": 50.0, "tag": 20.0}
LEAST = 0.01

Context = tuple[str, str, str]
Counts = dict[tuple[str, ...], tuple[float, float]]


class Sequence:
    """A page's tokens: ``(kind, context, count, item)``, where kind is "word" or "tag" and context is (place, tag, detail)."""

    def __init__(self, page: Page):
        self.page = page
        self.cut = cut = page.cut()
        outermost = {kind: self._outermost(page, cut, kind) for kind in ("article", "main")}
        one = len(outermost["article"]) == 1 or not outermost["main"]
        self.articles = outermost["article"] if one else outermost["main"]
        chosen = set(self.articles)
        within = [False] * len(page.tag)
        for k in range(1, len(page.tag)):
            within[k] = within[page.parent[k]] or k in chosen
        self.within = within
        self.tokens: list[tuple[str, Context, int, int]] = []
        for number, (element, text, words, linked) in enumerate(page.items):
            node = element if element >= 0 else ~element
            place = "none" if not chosen else "in" if within[node] else "out"
            tag = page.tag[node] if page.tag[node] in BLOCKS else "other"
            if cut[node]:
                # All of a cut element is one tag.
                if cut[node] == element and text is None:
                    self.tokens.append(("tag", (place, "cut", tag), 1, number))
            elif text is None:
                self.tokens.append(("tag", (place, tag, ""), 1, number))
            else:
                if words > linked:
                    self.tokens.append(("word", (place, tag, ""), words - linked, number))
                if linked:
                    self.tokens.append(("word", (place, tag, "link"), linked, number))

    @staticmethod
    def _outermost(page: Page, cut: list[int], kind: str) -> list[int]:
        """The elements of this kind that are not cut and in no other of it."""
        found = []
        inside = [False] * len(page.tag)
        for k in range(1, len(page.tag)):
            inside[k] = inside[page.parent[k]]
            if page.kind[k] == kind and not cut[k] and not inside[k]:
                inside[k] = True
                found.append(k)
        return found

    def labelled(self) -> Iterator[tuple[str, Context, int, bool]]:
        """Kind, context, count and whether it is in the article, for a page that names just one."""
        if len(self.articles) == 1:
            for kind, context, count, number in self.tokens:
                element = self.page.items[number][0]
                yield kind, context, count, self.within[element if element >= 0 else ~element]


def counted(sequences: Iterable[Sequence]) -> Counter:
    """(kind, place, tag, detail, in the article) -> count."""
    found: Counter = Counter()
    for sequence in sequences:
        for kind, context, count, inside in sequence.labelled():
            found[kind, *context, inside] += count
    return found


class Weights:
    """Scores of contexts, from counts over labelled pages."""

    def __init__(self, counts: dict[tuple, int]):
        self.sums: Counts = {}
        for (kind, place, tag, detail, inside), count in counts.items():
            # A page without a named article is scored by tags and details alone.
            for key in {(kind, place)} | {(kind, where, *context) for where in (place, "none") for context in ((tag,), (tag, detail))}:
                good, bad = self.sums.get(key, (0.0, 0.0))
                self.sums[key] = (good + count, bad) if inside else (good, bad + count)
        self.known: dict[tuple, float] = {}

    def share(self, kind: str, context: Context) -> float:
        """The share of a context that lies in articles; each step from coarse to fine starts from the one before."""
        place, tag, detail = context
        share, weight = PRIOR_SHARE[place][kind], PRIOR_WEIGHT[kind]
        steps = [(kind, place), (kind, place, tag), (kind, place, tag, detail)]
        for key in steps[1:] if place == "none" else steps:
            good, bad = self.sums.get(key, (0.0, 0.0))
            share = (good + weight * share) / (good + bad + weight)
        return share

    def score(self, kind: str, context: Context) -> float:
        """Above zero for a word, below for a tag."""
        if (kind, context) not in self.known:
            share = self.share(kind, context)
            self.known[kind, context] = (
                WORD_GAIN * max(share, LEAST) if kind == "word" else -TAG_COST * max(1 - share, LEAST)
            )
        return self.known[kind, context]


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the highest sum above zero, the first of equal ones; (0, 0) for none."""
    best, found = 0.0, (0, 0)
    total, start = 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, found = total, (start, k + 1)
    return found


def common_element(page: Page, elements: Iterable[int]) -> int:
    """The innermost element around all of these that can hold more than one of an article's blocks."""
    found = -1
    for element in set(elements):
        found = element if found < 0 else found
        while found != element:
            # A parent has a smaller number than what it holds.
            if found > element:
                found = page.parent[found]
            else:
                element = page.parent[element]
    while page.tag[found] in FLOW:
        found = page.parent[found]
    return found


def grown(page: Page, cut: list[int], chosen: list[int]) -> list[int]:
    """The chosen text items with the lists, tables and other blocks of text right beside them.

    Neighbours are those within the element that holds all chosen items; they count if at most half of their words
    are links. Cut and empty elements between do not matter.
    """
    within = common_element(page, (page.items[number][0] for number in chosen))
    words, linked, top = [0] * len(page.tag), [0] * len(page.tag), [0] * len(page.tag)
    for element, text, n, links in page.items:
        if text is not None and not cut[element]:
            words[element] += n
            linked[element] += links
    for k in range(len(page.tag) - 1, 0, -1):
        words[page.parent[k]] += words[k]
        linked[page.parent[k]] += linked[k]
    for k in range(1, len(page.tag)):
        top[k] = k if page.parent[k] == within else top[page.parent[k]]
    held = {top[page.items[number][0]] for number in chosen} - {0}
    children = [k for k in range(1, len(page.tag)) if top[k] == k]
    if not held:
        return chosen
    taken, low, high = set(held), min(held), max(held)
    for side in ([k for k in reversed(children) if k < low], [k for k in children if k > high]):
        for k in side:
            if words[k] and not (page.tag[k] in FLOW and 2 * linked[k] <= words[k]):
                break
            taken.add(k)
    texts = [n for n, (element, text, _, _) in enumerate(page.items) if text is not None and not cut[element]]
    inside = [n for n in texts if top[page.items[n][0]] in taken or chosen[0] <= n <= chosen[-1]]
    return [n for n in texts if inside[0] <= n <= inside[-1]]


def main_text(page: Page, weights: Weights) -> str:
    """The text of the best stretch, with the blocks of text right beside it."""
    sequence = Sequence(page)
    scores = [weights.score(kind, context) * count for kind, context, count, _ in sequence.tokens]
    start, end = best_stretch(scores)
    chosen = sorted({number for kind, _, _, number in sequence.tokens[start:end] if kind == "word"})
    if not chosen:
        return ""
    return "\n\n".join(page.items[number][1] for number in grown(page, sequence.cut, chosen))


def learn_weights(pages: DataFrame) -> Weights:
    """Weights from those of ``pages`` (html) that name their article."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = counted(Sequence(read_page(html.as_py())) for html in batch.column(0))
            columns = list(zip(*(key + (count,) for key, count in found.items()))) or [()] * 6
            types = (pa.string(),) * 4 + (pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, of) for column, of in zip(columns, types)],
                names=["kind", "place", "tag", "detail", "inside", "n"],
            )

    schema = "kind string, place string, tag string, detail string, inside boolean, n bigint"
    sums = pages.select(F.col("html").cast("string")).mapInArrow(rows, schema)
    sums = sums.groupBy("kind", "place", "tag", "detail", "inside").agg(F.sum("n").alias("n"))
    # One row per element name and a few details of it.
    return Weights({(r.kind, r.place, r.tag, r.detail, r.inside): r.n for r in sums.collect()})


def main_texts(spark: SparkSession, pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of ``pages`` (page_id, url, html); without ``weights``, they are learnt from these pages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS // 4)
    weights = weights or learn_weights(pages)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(read_page(html.as_py()), weights) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    given = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return given.mapInArrow(rows, "page_id bigint, url string, text string, n_chars bigint")
