"""Main text of pages by wrappers that are inferred per host.

A wrapper is a regular expression without unions over a host's pages: elements, optional and
repeated groups, fixed texts and text slots. It is formed from all different pages: each is a wrapper of
itself; pages of one structure are counted together, and the others are aligned with the wrapper so
far, level by level, first in each task, then per host. Elements that only one side has become
optional, neighbours that look alike become one repeated group, and a text becomes a slot unless one
has the majority. The article is where the slots hold most text, unless it is marked as such.

Which texts are template is decided by all pages of the host, too: every run of text between two block
borders is counted with its place, once per different page, and a run that most of them have is
part of the template, not of the article.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby
import json
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass, arrow_schema, stored
from shelfscan.llm.markup import INLINE, VOID, Element, parse

#: Structures of a host that a task keeps apart before it aligns them.
KINDS = 500
#: The former name, when so many pages of a host were all that was read.
SAMPLE_PAGES = KINDS
#: Levels of two pages with more pairs of neighbours are aligned by the signs that both have once.
WIDE = 250_000
#: Longer texts of a wrapper are kept by their beginning and a hash.
TEXT_CHARS = 60
#: Different pages that a host needs before a text of theirs can count as part of the template, which
#: more than this share of them have to have at the same place.
FIXED_PAGES = 4
FIXED_SHARE = 0.5
#: Levels of a page that a wrapper describes; what lies deeper is text of the last one.
LEVELS = 60
#: Wrappers up to this many bytes in all are broadcast; more are joined by shuffling.
BROADCAST_BYTES = 32 << 20

FOUND = "page_id long, url string, text string, n_chars long"
RULES = "host string, wrapper string, rules string"
FACTS = "host string, h long, marks array<long>, shape string, texts string"
GATHERED = "host string, shape string, texts string, pages long"
START = 0

SKIPPED = frozenset(
    "nav footer aside form head button select input option datalist fieldset iframe object svg "
    "canvas audio video map dialog menu figure-ad".split())
#: Words in class, id or role of parts that are not the article.
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies "
    "consent gdpr banner notice popup modal overlay related recommended recommendations share "
    "sharing social comment comments reply replies discussion disqus respond newsletter "
    "subscribe signup login search widget pagination pager toolbar complementary contentinfo "
    "copyright skip".split())
#: Those that name such a part also as a piece of a longer name inside an article.
SURE_WORDS = frozenset(
    "advert adverts advertisement adsense sponsor sponsored promo promotion sidebar navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr popup modal "
    "comment comments reply replies disqus respond newsletter subscribe signup login pagination "
    "pager toolbar".split())
#: Pieces of names that say nothing of the content.
LAYOUT_WORDS = frozenset(
    "area articles bar block box button buttons container content group icon icons inner item items "
    "link links list outer panel post posts row section stories unit wrap wrapper".split())
ARTICLE_WORDS = frozenset("article articlebody main".split())
HEADINGS = frozenset("h1 h2 h3".split())


class Part:
    """An element or a text of a wrapper of so many ``pages``.

    ``text`` is the one that most of the ``seen`` texts may be; its votes are those for it that are
    left when each other text has taken one away. With votes of more than half it is fixed.
    """

    __slots__ = ("sign", "children", "text", "votes", "seen", "optional", "repeated", "pages", "chars")

    def __init__(self, sign: str, children=(), text: str | None = None, chars: int = 0):
        self.sign, self.children, self.text = sign, list(children), text
        self.optional = self.repeated = False
        self.votes = self.seen = self.pages = 1
        self.chars = chars

    @property
    def slot(self) -> bool:
        return 2 * self.votes <= self.seen

    def __str__(self) -> str:
        if self.sign == "#text":
            body = "#PCDATA" if self.slot else repr(self.text)
        else:
            body = f"<{self.sign}>{''.join(map(str, self.children))}</>"
        mark = ("+" if self.repeated else "") + ("?" if self.optional else "")
        return f"({body}){mark}" if mark else body


def below(path: int, sign: str) -> int:
    """The place of an element with this sign under a place."""
    return xxhash.xxh3_64_intdigest(sign.encode(), seed=path)


def part_of(element: Element, levels: int = LEVELS) -> Part:
    """A page as a wrapper of itself."""
    children = []
    for child in element.children:
        if not isinstance(child, str) and levels > 0:
            children.append(part_of(child, levels - 1))
            continue
        text = " ".join((child if isinstance(child, str) else " ".join(child.texts())).split())
        if text:
            children.append(Part("#text", text=shortened(text), chars=len(text)))
    return Part(element.sign, folded(children))


def shortened(text: str) -> str:
    if len(text) <= TEXT_CHARS:
        return text
    return f"{text[:TEXT_CHARS // 2]}… {xxhash.xxh3_64_hexdigest(text.encode())}"


def folded(parts: list[Part]) -> list[Part]:
    """Repetitions of one to three neighbours as one repeated group each."""
    for size in (1, 2, 3):
        done, rest = [], parts[::-1]
        while len(rest) >= 2 * size:
            one, two = rest[:-size - 1:-1], rest[-size - 1:-2 * size - 1:-1]
            if [p.sign for p in one] == [p.sign for p in two] and one[0].sign != "#text":
                joined = [united(a, b, same_page=True) for a, b in zip(one, two)]
                for part in joined:
                    part.repeated = True
                rest[-2 * size:] = joined[::-1]
            else:
                done.append(rest.pop())
        parts = done + rest[::-1]
    return parts


def united(a: Part, b: Part, same_page: bool = False) -> Part:
    """The wrapper of two parts with one sign."""
    found = Part(a.sign, chars=a.chars + b.chars)
    found.text, found.votes = voted(a.text, a.votes, b.text, b.votes)
    found.seen = a.seen + b.seen
    found.optional, found.repeated = a.optional or b.optional, a.repeated or b.repeated
    found.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    found.children = aligned(a.children, b.children, same_page)
    return found


def voted(one: str | None, votes: int, two: str | None, others: int) -> tuple[str | None, int]:
    if one == two:
        return one, votes + others
    return (one, votes - others) if votes >= others else (two, others - votes)


def aligned(one: list[Part], two: list[Part], same_page: bool) -> list[Part]:
    a, b = [p.sign for p in one], [p.sign for p in two]
    if a == b:
        return [united(x, y, same_page) for x, y in zip(one, two)]
    found: list[Part] = []
    i = j = 0
    for at, to, size in (*matching(a, b), (len(a), len(b), 0)):
        for part in (*one[i:at], *two[j:to]):
            part.optional = True
            found.append(part)
        found.extend(united(x, y, same_page) for x, y in zip(one[at:at + size], two[to:to + size]))
        i, j = at + size, to + size
    return folded(found)


def matching(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of what is alike, in order."""
    if len(a) * len(b) <= WIDE:
        return [tuple(m) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()]
    times_a, times_b = Counter(a), Counter(b)
    place = {sign: n for n, sign in enumerate(b) if times_b[sign] == 1}
    pairs = [(n, place[sign]) for n, sign in enumerate(a) if times_a[sign] == 1 and sign in place]
    # the longest rising sequence of places in b
    ends: list[int] = []
    last: list[int] = []
    before = []
    for n, (_, to) in enumerate(pairs):
        at = bisect_left(ends, to)
        ends[at:at + 1], last[at:at + 1] = [to], [n]
        before.append(last[at - 1] if at else -1)
    found, n = [], last[-1] if last else -1
    while n >= 0:
        found.append((*pairs[n], 1))
        n = before[n]
    return found[::-1]


def infer(pages: list[str | None]) -> Part:
    """The wrapper of the different pages of a host."""
    parts = [part_of(parse(text or "")) for text in dict.fromkeys(pages)]
    wrapper = parts[0]
    for part in parts[1:]:
        wrapper = united(wrapper, part)
    return wrapper


def written(wrapper: Part) -> tuple[str, str]:
    """The shape of a wrapper, which pages of one structure share, and its texts in order."""
    texts = []

    def shape(part: Part):
        marks = part.optional + 2 * part.repeated
        if part.sign == "#text":
            texts.append((part.text, part.votes, part.seen, part.chars))
            return marks
        return [part.sign, marks, *map(shape, part.children)]

    shaped = shape(wrapper)
    return tuple(json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in (shaped, texts))


def rebuilt(shape: str, texts: list[list], pages: int) -> Part:
    """The wrapper that was written; ``pages`` is set for all its parts."""
    rest = iter(texts)

    def part(given) -> Part:
        if isinstance(given, int):
            marks, found = given, Part("#text")
            found.text, found.votes, found.seen, found.chars = next(rest)
        else:
            marks, found = given[1], Part(given[0], map(part, given[2:]))
        found.optional, found.repeated, found.pages = bool(marks & 1), bool(marks & 2), pages
        return found

    return part(json.loads(shape))


def gathered(rows: Iterable[tuple[str, str, int]]) -> Part:
    """The wrapper of written wrappers with their numbers of pages. Those of one shape are counted
    together; the others are aligned, the most frequent first."""
    kinds: dict[str, list] = {}
    wrapper = None

    def joined() -> Part:
        found = wrapper
        for shape in sorted(kinds, key=lambda shape: (-kinds[shape][1], shape)):
            part = rebuilt(shape, *kinds[shape])
            found = united(found, part) if found else part
        return found

    for shape, texts, pages in rows:
        texts = json.loads(texts)
        known = kinds.get(shape)
        if known is None:
            if len(kinds) >= KINDS:
                wrapper = joined()
                kinds.clear()
            kinds[shape] = [texts, pages]
            continue
        known[1] += pages
        for one, two in zip(known[0], texts):
            one[:] = *voted(one[0], one[1], two[0], two[1]), one[2] + two[2], one[3] + two[3]
    return joined()


def words_of(sign: str) -> set[str]:
    return set(re.findall("[a-z]+", sign.partition(".")[2]))


def skipped(sign: str, inside: bool) -> bool:
    """Whether an element is not part of the article; ``inside`` an article or not.

    Inside, a listed word counts as a whole name, or next to words of layout; a longer name such as
    ``related-work`` may well be the article's own.
    """
    name, words = sign.partition(".")[0], words_of(sign)
    if name in SKIPPED or name == "header" and not inside:
        return True
    if name in ("html", "body") or words & ARTICLE_WORDS:
        return False
    if not inside:
        return bool(words & SKIPPED_WORDS)
    if words & SURE_WORDS:
        return True
    names = [set(re.findall("[a-z]+", part)) for part in sign.partition(".")[2].split()]
    return any(part & SKIPPED_WORDS and part <= SKIPPED_WORDS | LAYOUT_WORDS for part in names)


def holds_article(sign: str) -> bool:
    return sign.partition(".")[0] in ("article", "main") or bool(words_of(sign) & ARTICLE_WORDS)


def weight(part: Part, several: bool = False) -> int:
    """Characters of running text; text of links and of skipped parts does not count.

    In the wrapper of ``several`` pages only slots count.
    """
    if part.sign == "#text":
        return part.chars if part.slot or not several else 0
    if skipped(part.sign, False) or part.sign.partition(".")[0] == "a":
        return 0
    return sum(weight(child, several) for child in part.children)


def articles_of(wrapper: Part) -> tuple[list[tuple[tuple[int, ...], Part]], bool]:
    """Places, with those of all elements around them, and parts of the article; and whether they
    are marked as such."""
    articles: list[tuple[tuple[int, ...], Part]] = []

    def find(part: Part, path: tuple[int, ...]) -> None:
        for child in part.children:
            if child.sign == "#text" or skipped(child.sign, False):
                continue
            place = (*path, below(path[-1], child.sign))
            if holds_article(child.sign):
                articles.append((place, child))
            else:
                find(child, place)

    find(wrapper, (START,))
    # a main part that is only a frame around articles is entered
    for at, (path, part) in enumerate(articles):
        inner = [((*path, below(path[-1], c.sign)), c) for c in part.children
                 if c.sign.partition(".")[0] == "article" and not skipped(c.sign, True)]
        if inner and sum(weight(c) for _, c in inner) >= 0.5 * weight(part):
            articles[at:at + 1] = inner
            break
    return (articles, True) if articles else ([densest(wrapper)], False)


def densest(wrapper: Part) -> tuple[tuple[int, ...], Part]:
    """The lowest part with most of the running text, of the slots where pages differ."""
    several = wrapper.pages > 1 and weight(wrapper, True) > 0
    path, part = (START,), wrapper
    while True:
        total = weight(part, several)
        down = max((c for c in part.children if c.sign != "#text"),
                   key=lambda c: weight(c, several), default=None)
        name = down.sign.partition(".")[0] if down else ""
        if (not down or down.repeated or name in INLINE or name in ("p", "li", "td", "pre")
                or weight(down, several) < 0.7 * total or not total):
            return path, part
        path, part = (*path, below(path[-1], down.sign)), down


def rules_of(wrapper: Part) -> dict:
    """``main``: places of the article; ``around``: places of what is around them."""
    articles, _ = articles_of(wrapper)
    return {"main": sorted({path[-1] for path, _ in articles}),
            "around": sorted({place for path, _ in articles for place in path[:-1]})}


def runs_of(root: Element, begin, enter) -> list[tuple[int, str]]:
    """The runs of text between block borders, with the place of the block around them.

    ``enter(element, place, state)`` gives the state in an element, None to leave it out; text of
    a state whose second item is true counts. No recursion: pages may be nested without end.
    """
    found: list[tuple[int, str]] = []
    held: list[str] = []

    def close(block: int) -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            found.append((block, text))

    open_ = [(iter(root.children), START, START, begin, True)]
    while open_:
        rest, path, block, state, is_block = open_[-1]
        for child in rest:
            if isinstance(child, str):
                if state[1]:
                    held.append(child)
                continue
            place = below(path, child.sign)
            inner = enter(child, place, state)
            breaks = child.name not in INLINE and child.name not in VOID
            if breaks:
                close(block)
            if inner is None or child.name == "br":
                held.append(" ")
                continue
            open_.append((iter(child.children), place, place if breaks else block, inner, breaks))
            break
        else:
            open_.pop()
            if is_block:
                close(block)
    return found


def run_mark(place: int, text: str) -> int:
    """A run and its place as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(text.encode(), seed=place) - (1 << 63)


def page_marks(text: str | None) -> list[int]:
    """The different runs of a page, whatever part they are in."""
    return _marks_of(parse(text or ""))


def _marks_of(root: Element) -> list[int]:
    runs = runs_of(root, (True, True), lambda element, place, state: state)
    return sorted({run_mark(place, run) for place, run in runs})


def main_text(root: Element, rules: dict, own=()) -> str:
    """The article of a page: blocks in order, white space as one blank. ``own`` are more places.

    Runs of the template are left out, unless they are half of the article or more: then the pages
    of the host are copies of it.
    """
    main, fixed = {*rules["main"], *own}, rules.get("fixed", ())

    def enter(element: Element, place: int, state):
        inside, _, heading_only = state
        if skipped(element.sign, inside):
            return None
        within = heading_only or inside and element.name == "header"
        inside, heading_only = inside or place in main, within and element.name not in HEADINGS
        return inside, inside and not heading_only, heading_only

    start = START in main
    runs = runs_of(root, (start, start, False), enter)
    kept = [text for place, text in runs if run_mark(place, text) not in fixed] if fixed else runs
    if fixed and 2 * sum(map(len, kept)) > sum(len(text) for _, text in runs):
        return " ".join(kept)
    return " ".join(text for _, text in runs)


@lru_cache(maxsize=4096)
def read_rules(rules: str) -> dict:
    found = json.loads(rules)
    return {**found, "fixed": frozenset(found.get("fixed", ()))}


def extract(text: str | None, rules: str | None) -> str:
    """The main text of one page, by the articles of its host and by its own. A page without the
    article of its host is read by itself."""
    if not text:
        return ""
    root = parse(text)
    own = part_of(root)
    if rules:
        known = read_rules(rules)
        articles, marked = articles_of(own)
        # where nothing is marked, the host tells better what is inside a frame
        places = [path[-1] for path, _ in articles if marked or path[-1] not in known["around"]]
        found = main_text(root, known, places)
        if found:
            return found
    return main_text(root, rules_of(own))


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*://([^/?#]*)", 1))


def page_facts(pages: DataFrame) -> DataFrame:
    """``host, h, marks, shape, texts`` of each page, written once: the marks of its runs and its own
    wrapper. Pages with equal ``host`` and ``h`` are copies.

    A page without an absolute address belongs to the host "".
    """

    def make():
        def step(columns):
            roots = (parse(text) for text in columns[2])
            found = [(_marks_of(root), *written(part_of(root))) for root in roots]
            return [columns[0], columns[1], *(zip(*found) if found else [[]] * 3)]

        return step

    known = pages.where(F.col("html").isNotNull()).select(
        host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("h"), "html")
    return stored(arrow_pass(known, FACTS, make), "facts")


def infer_wrappers(pages: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``host, wrapper, rules`` per host, from all its different pages.

    Pages meet by host and hash, so those of a large host are gathered in many tasks; a task
    sends one wrapper per host. The order of pages, and so an alignment with several good ways, may
    depend on the number of tasks.
    """
    facts = page_facts(pages) if facts is None else facts
    schema = arrow_schema(pages.sparkSession, GATHERED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for host, group in groupby(rows, key=lambda row: row[0]):
            wrapper = gathered((shape, texts, 1) for _, _, shape, texts in group)
            shape, texts = written(wrapper)
            yield pa.RecordBatch.from_pydict({"host": [host], "shape": [shape], "texts": [texts],
                                              "pages": [wrapper.pages]}, schema=schema)

    def form(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pages", "shape", "texts"], ascending=[False, True, True])
        wrapper = gathered(zip(rows["shape"], rows["texts"], rows["pages"].tolist()))
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [str(wrapper)],
                             "rules": [json.dumps(rules_of(wrapper), ensure_ascii=False)]})

    # copies of a page count once
    different = facts.select("host", "h", "shape", "texts").dropDuplicates(["host", "h"])
    return different.sortWithinPartitions("host", "h").mapInArrow(run, GATHERED).groupBy(
        "host").applyInPandas(form, RULES)


def fixed_runs(pages: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``host, fixed``: marks of the runs that most different pages of a host have.

    All pages are counted, by their marks: what meets under a host is one number per run and page,
    and sums of these. At most twice as many runs are found as a page has on average.
    """
    marks = page_facts(pages) if facts is None else facts
    hosts = marks.select("host", "h").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= FIXED_PAGES)
    # copies of a page count once
    counts = marks.select("host", "h", F.explode("marks").alias("mark")).distinct().groupBy(
        "host", "mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return counts.join(hosts, "host").where(F.col("n") > F.col("pages") * FIXED_SHARE).groupBy(
        "host").agg(F.array_sort(F.collect_list("mark")).alias("fixed"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    Null html counts as empty and gives an empty text; null addresses share a host; repeated rows
    give repeated rows; extra columns are ignored; an empty table gives an empty table.
    """
    facts = page_facts(pages)
    rules = infer_wrappers(pages, facts).join(fixed_runs(pages, facts), "host", "left").select(
        "host", F.concat(F.expr("substring(rules, 1, length(rules) - 1)"), F.lit(', "fixed": '),
                         F.coalesce(F.to_json("fixed"), F.lit("[]")), F.lit("}")).alias("rules"))
    wrappers = stored(rules, "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("rules") + F.octet_length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(
        wrappers, "host", "left").select("page_id", "url", "html", "rules")

    def make():
        def step(columns):
            ids, urls, htmls, rules = columns
            texts = [extract(html, rule) for html, rule in zip(htmls, rules)]
            return [ids, urls, texts, [len(text) for text in texts]]

        return step

    return arrow_pass(rows, FOUND, make)
