"""The main text of a page: its maximum-scoring contiguous run of words and tags.

Words score positive and tags negative; the run with the largest sum is found in one scan. Weights come
from labelled pages, those that mark their text themselves (`LABELS`): a tag costs more the more often it
stands outside the marked text, and words count nothing when they lie in an element whose
name or class is seen mostly outside. The marks are used for learning only.
"""

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import short_batches, stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|iframe|title|select|object|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# fixed values: elements of HTML
LABELS = {"article", "main", "articlebody"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# elements that are no part of a text
ASIDE = set("nav footer aside form menu dialog button fieldset head".split())
# What names mostly stand for while nothing has been learned of them: a word of the first list, alone, at the end of
# a name (`site-footer`) or before words of the second only (`share-buttons`); `no-sidebar` and the like tell a state.
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsors sponsored promo promos promotion banner banners "
    "cookie cookies consent gdpr notice notices alert alerts popup modal newsletter subscribe signup nav navbar navigation "
    "navi menu menus breadcrumb breadcrumbs sidebar side aside footer masthead comment comments disqus replies respond "
    "share sharing social related recommended widget widgets toolbar pagination pager login search complementary "
    "contentinfo".split()
)
BESIDE_WORDS = set(
    "area bar block body box btn button buttons container content cookies footer form header icon icons inner item items "
    "left link links list main outer panel post posts primary right secondary section signup thread title top wrap wrapper".split()
)
STATE_WORDS = set("no not has with without is are hide hidden show open closed js".split())
SECTIONS = set("header section div table ul ol dl figure".split())


@dataclass
class Weights:
    """Scores of tags (at most `LEAST`), the names whose words are no main text, and the names that sound so but mostly
    hold a page's text; `totals` are the words and tags of the pages learned from, inside and outside."""

    tags: dict[str, float] = field(default_factory=lambda: dict(LISTED))
    outside: set[str] = field(default_factory=set)
    inside: set[str] = field(default_factory=set)
    totals: dict[str, tuple[int, int]] = field(default_factory=dict, compare=False, repr=False)

    def add(self, kind: str, name: str, inside: int, outside: int) -> None:
        if kind == "words":
            if inside * 20 < outside:
                self.outside.add(name)
            return
        if kind == "body":
            if inside > outside:
                self.inside.add(name)
            return
        all_in, all_out = self.totals[kind]
        odds = np.log((inside + 0.5) / (all_in + 1)) - np.log((outside + 0.5) / (all_out + 1))
        self.tags[name] = float(min(LEAST, max(WORST, odds)))


LEAST, UNSEEN, WORST = -0.05, -0.25, -4.0
# Names with this share of all words (or tags) are at hand in each task, those of the rest are joined.
COMMON = 1e-5
COUNTS = "kind = 'tags' or kind = 'words' and inside * 20 < outside or kind = 'body' and inside > outside"
# Before anything is learned: lists and cells are more often outside.
LISTED = {name: -1.0 for tag in ("ul", "ol", "li", "td", "th", "option") for name in (tag, "/" + tag)}


def names_of(tag: str, attributes: str) -> list[str]:
    """An element's names: its tag if it can set a part of a page off, and words of class, id and role."""
    names = [tag] if tag in ASIDE or tag in SECTIONS or tag in LABELS else []
    if attributes:
        for kind, *values in NAMES.findall(attributes):
            for word in "".join(values).lower().split():
                names.append(f"{kind.lower()}={word}")
    return names


def is_aside(name: str) -> bool:
    """Whether a name that nothing is known of mostly stands for what is no main text."""
    _, _, word = name.partition("=")
    first, *more = re.split(r"[-_]+", word.strip("-_"))
    if not more:
        return first in ASIDE_WORDS
    if first in STATE_WORDS:
        return False
    return more[-1] in ASIDE_WORDS or first in ASIDE_WORDS and all(w in BESIDE_WORDS for w in more)


def is_label(name: str) -> bool:
    return name in LABELS or name == "itemprop=articlebody"


class Page:
    """A page's elements, in the order they begin, and its events (element, text, tag): one of the two is None.

    Element 0 is the page. `fresh` are the names of an element that no element around it has.
    """

    def __init__(self, page: str):
        self.parents, self.names, self.tags = [0], [()], [""]
        self.fresh: list[tuple[str, ...]] = [()]
        self.events: list[tuple[int, str | None, str | None]] = []
        self.stack, self.open_tags, self.open_names = [0], Counter(), Counter()
        at = 0
        for found in TOKEN.finditer(page):
            if found.start() > at:
                self.events.append((self.stack[-1], page[at : found.start()], None))
            at = found.end()
            _, end, tag, attributes, end2, tag2, attributes2 = found.groups()
            tag = tag or tag2
            if tag:
                self.tag(tag.lower(), bool(end or end2), attributes or attributes2 or "")
        if at < len(page):
            self.events.append((self.stack[-1], page[at:], None))
        size = len(self.parents)
        self.words = [0] * size
        for element, text, _ in self.events:
            if text is not None:
                self.words[element] += len(text.split())
        self.inside = [False] * size
        for e in range(size):
            self.inside[e] = self.inside[self.parents[e]] or any(map(is_label, self.names[e]))

    def tag(self, tag: str, end: bool, attributes: str) -> None:
        if end:
            if self.open_tags[tag]:
                while self.pop() != tag:
                    pass
            self.events.append((self.stack[-1], None, "/" + tag))
            return
        if tag not in INLINE and self.tags[self.stack[-1]] == "p":  # a block ends a paragraph
            self.pop()
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            own = names_of(tag, attributes)
            if own or tag not in INLINE:
                self.fresh.append(tuple({n for n in own if not self.open_names[n]}))
                self.open_names.update(own)
                self.open_tags[tag] += 1
                self.parents.append(self.stack[-1])
                self.names.append(tuple(own))
                self.tags.append(tag)
                self.stack.append(len(self.tags) - 1)
        self.events.append((self.stack[-1], None, tag))

    def pop(self) -> str:
        element = self.stack.pop()
        self.open_names.subtract(self.names[element])
        self.open_tags[self.tags[element]] -= 1
        return self.tags[element]

    def summed(self, values: list) -> list:
        """What each element and the elements in it have of `values`."""
        total = list(values)
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return total

    def outside(self, weights: Weights) -> list[bool]:
        """Whether each element is no main text: as its tag, what was learned of its names, or else their words say.

        Names count nothing where an element holds most of the page: its text mark and half of the words, or
        without a mark four fifths of them (learned names: 19 of 20). Names that nothing is learned of count nothing beside
        one that was learned to hold texts.
        """
        fixed = [False] * len(self.tags)
        for e in range(1, len(fixed)):
            tag = self.tags[e]
            fixed[e] = fixed[self.parents[e]] or tag in ASIDE and tag != "form" or tag == "header" and not self.inside[e]
        held = self.summed([0 if f else n for f, n in zip(fixed, self.words)])
        marks = [any(map(is_label, names)) and not any(is_aside(n) for n in names) for names in self.names]
        marks = self.summed(marks)
        out = [False] * len(fixed)
        for e in range(1, len(out)):
            tag, names = self.tags[e], self.names[e]
            if out[self.parents[e]] or fixed[e]:
                out[e] = True
            elif tag not in ("html", "body"):
                share = held[e] / held[0] if held[0] else 0.0
                if share < (0.5 if marks[e] else 0.95) and any(n in weights.outside for n in names):
                    out[e] = True
                elif share < (0.5 if marks[e] else 0.8) and not any(n in weights.inside for n in names):
                    out[e] = tag == "form" or any("=" in n and is_aside(n) for n in names)
        return out


def counts_of(page: str) -> Counter | None:
    """Of a labelled page: (kind, name, inside) with the number of words or tags; None for others."""
    p = Page(page)
    if not any(p.inside):
        return None
    counts = Counter()
    for element, text, tag in p.events:
        if text is None and tag.strip("/") not in LABELS:
            counts["tags", tag, p.inside[element]] += 1
    for inside in (True, False):
        words = p.summed([n if i == inside else 0 for n, i in zip(p.words, p.inside)])
        for names, n in zip([("",), *p.fresh[1:]], words):
            for name in names:
                if n and not is_label(name):
                    counts["words", name, inside] += n
                    if is_aside(name):
                        counts["body", name, inside and n * 2 >= words[0]] += n
    return counts


def learn(pages: DataFrame) -> Weights:
    """Weights of common names from all labelled pages of `pages` (html), see `learned`."""
    return learned(pages)[0]


def learned(pages: DataFrame) -> tuple[Weights, DataFrame, set[tuple[str, str]]]:
    """Weights from all labelled pages of `pages` (html), rarer names, and the common ones as (kind, name).

    Names of at least a hundred-thousandth of all words reach the driver, so what does is bounded;
    kind, name, inside and outside of the rarer ones that count are rows of a table. Without labelled
    pages the fixed names are all there is.
    """

    def compute(batches):
        total = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                total.update(counts_of(page or "") or {})
            if len(total) > 200_000:
                yield out(total)
                total = Counter()
        yield out(total)

    def out(total):
        rows = [(*key, n) for key, n in total.items()]
        columns = zip(*rows) if rows else ([],) * 4
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "name", "inside", "n"])

    short_batches(pages.sparkSession, 256)
    rows = pages.select(F.col("html").cast("string")).mapInArrow(compute, "kind string, name string, inside boolean, n long")
    sums = stored(
        rows.groupBy("kind", "name").agg(
            F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
            F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("outside"),
        )
    )
    words = sums.where("kind = 'words' and name = ''").first()
    tags = sums.where("kind = 'tags'").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).first()
    if words is None:
        return Weights(), sums.limit(0), set()
    weights = Weights(totals={"tags": (tags["inside"] or 0, tags["outside"] or 0)})
    limits = COMMON * (words["inside"] + words["outside"]), COMMON * sum(weights.totals["tags"])
    enough = F.col("inside") + F.col("outside") >= F.when(F.col("kind") == "tags", limits[1]).otherwise(limits[0])
    named = sums.where("name <> ''")
    common = set()
    for row in named.where(enough).collect():
        weights.add(*row)
        common.add((row["kind"], row["name"]))
    return weights, named.where(~enough).where(COUNTS), common


def names_in(page: str) -> set[tuple[str, str]]:
    """(kind, name) of all that a weight may be known of."""
    p = Page(page)
    names = {name for names in p.names for name in names if not is_label(name)}
    found = {("words", name) for name in names} | {("body", name) for name in names if is_aside(name)}
    return found | {("tags", tag) for _, _, tag in p.events if tag and tag.strip("/") not in LABELS}


def extract(page: str, weights: Weights) -> str:
    """The text of the best run: blocks joined by an empty line, references decoded, words of
    outside elements left out. Those and the tags among them score nothing, so that a box of any length costs a run
    no more than its end tag. The work grows with the page's length, however deep its elements lie."""
    p = Page(page)
    away = p.outside(weights)
    parts, scores = [], []
    for element, text, tag in p.events:
        outside = away[element]
        if text is not None:
            parts.append((None if outside else text, ""))
            scores.append(0.0 if outside else float(len(text.split())))
            continue
        if outside:
            score = 0.0
        elif tag.strip("/") in LABELS:  # the marks are not looked at
            score = LEAST
        else:
            score = weights.tags.get(tag, UNSEEN if tag.strip("/") not in INLINE else LEAST)
        parts.append((None, tag))
        scores.append(score)
    best, total, first, start, stop = 0.0, 0.0, 0, 0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, start, stop = total, first, i + 1
    blocks, held = [], []

    def close():
        block = " ".join(html.unescape("".join(held)).split())
        if block:
            blocks.append(block)
        held.clear()

    for text, tag in parts[start:stop]:
        if text is not None:
            held.append(text)
        elif tag == "br":
            held.append(" ")
        elif tag and tag.strip("/") not in INLINE:
            close()
    close()
    return "\n\n".join(blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (its code points) of every row of `pages` (page_id, url, html).

    A null or empty page, and one without words, has an empty text. Null ids
    and urls stay; repeated rows get a row each; an empty table gives no rows;
    further columns are not looked at.
    """
    weights, rare, common = learned(pages)
    columns = "page_id long, url string, text string, n_chars long"
    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))

    def compute(batches):
        for batch in batches:
            texts = [extract(page or "", weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    def first(batches):
        """Pages without rarer names are done; of others the names to ask for go on."""
        row, part = 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, asked = [], []
            for page in batch.column(2).to_pylist():
                names = sorted(names_in(page or "") - common)
                asked.append([{"kind": k, "name": n} for k, n in names])
                texts.append(None if names else extract(page or "", weights))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(part + row, part + row + len(texts)), pa.int64()), batch.column(0), batch.column(1),
                    pa.array([p if t is None else None for p, t in zip(batch.column(2).to_pylist(), texts)], pa.string()),
                    pa.array(texts, pa.string()), pa.array([None if t is None else len(t) for t in texts], pa.int64()), pa.array(asked, ASKED),
                ],
                names=["row", "page_id", "url", "html", "text", "n_chars", "asked"],
            )
            row += len(texts)

    def second(batches):
        for batch in batches:
            texts = []
            for page, more in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own = Weights(dict(weights.tags), set(weights.outside), set(weights.inside), weights.totals) if more else weights
                for x in more or ():
                    own.add(x["kind"], x["name"], x["inside"], x["outside"])
                texts.append(extract(page, own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    short_batches(pages.sparkSession, 256)
    if not rare.limit(1).count():
        return plain.mapInArrow(compute, columns)
    read_once = stored(plain.mapInArrow(
        first, "row long, page_id long, url string, html string, text string, n_chars long, asked array<struct<kind: string, name: string>>"
    ))
    asked = read_once.select("row", F.explode("asked").alias("x")).select("row", "x.kind", "x.name")
    found = asked.join(rare, ["kind", "name"]).groupBy("row").agg(F.collect_list(F.struct("kind", "name", "inside", "outside")).alias("more"))
    rest = read_once.where("text is null").join(found, "row", "left").select("page_id", "url", "html", "more")
    return read_once.where("text is not null").select("page_id", "url", "text", "n_chars").unionByName(rest.mapInArrow(second, columns))


ASKED = pa.list_(pa.struct([("kind", pa.string()), ("name", pa.string())]))
