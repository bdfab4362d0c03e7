"""Benchmark passages in documents, found through an FM-index per shard of documents.

A shard is an Arrow batch. Its words become numbers of benchmark words (others: a separator). The
index covers the stretches whose neighbouring words all stand side by side somewhere in the
benchmark, as nothing else can hold a phrase (with one-word phrases: every benchmark word). All
phrases are searched backward at once, their places are located by sampled suffix positions, and
the places are merged into spans.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass
from shelfscan.llm.fmindex import FmIndex
from shelfscan.llm.secret_scan import rewritten

WINDOW = 10
#: Bytes of benchmark text that one broadcast model covers; more text makes more models.
MODEL_BYTES = 16 << 20

FOUND = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
         "contaminated boolean")
HITS = "`__n` long, `__hits` array<int>, `__items` array<string>"

#: A word in either case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
LOWER = bytes.maketrans(
    bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b" " * len(_SEPARATORS))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return text.encode().translate(LOWER).split() if text else []


class Phrases:
    """The windows of some benchmark items, as numbers."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1)
                   for w in words_of(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1) if ids else ():
                owners.setdefault(tuple(ids[at:at + size]), set()).add(item)
        self.owners = list(owners.values())
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(key) for key in owners], dtype=np.int64)
        for length in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == length)
            keys = list(owners)
            self.by_length[length] = (
                np.array([keys[i] for i in which], dtype=np.int64).reshape(-1, length), which)
        self.symbols = len(self.numbers) + 2  # the last one separates
        pairs = {a * self.symbols + b for key in owners for a, b in zip(key, key[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def occurrences(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all phrases in the documents (word numbers, 0: no benchmark word): the place in
        the documents set end to end, with one 0 after each, the length, and the phrase."""
        none = np.zeros(0, dtype=np.int64)
        if not self.by_length or not docs:
            return none, none, none
        flat = np.concatenate([x for d in docs for x in (d, np.zeros(1, dtype=np.int64))])
        keep = self._kept(flat)
        starts = np.flatnonzero(keep & ~np.append(False, keep[:-1]))
        places = np.flatnonzero(keep)
        if not len(places):
            return none, none, none
        # stretches side by side, a separator after each
        order = np.searchsorted(starts, places, side="right") - 1
        at = np.arange(len(places)) + order
        sequence = np.full(len(places) + len(starts), self.symbols - 1, dtype=np.int64)
        sequence[at] = flat[places]
        origin = np.full(len(sequence), -1, dtype=np.int64)
        origin[at] = places
        index = FmIndex(sequence, self.symbols)
        found = []
        for length, (patterns, which) in self.by_length.items():
            low, high = index.ranges(patterns)
            counts = high - low
            total = int(counts.sum())
            if total:
                rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(total)
                found.append((origin[index.locate(rows)], np.full(total, length),
                              np.repeat(which, counts)))
        if not found:
            return none, none, none
        return tuple(np.concatenate(part) for part in zip(*found))

    def _kept(self, flat: np.ndarray) -> np.ndarray:
        shortest = min(self.by_length)
        if shortest == 1:
            return flat > 0
        pair = flat[:-1] * self.symbols + flat[1:]
        spot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        linked = (self.pairs[spot] == pair) & (flat[:-1] > 0) & (flat[1:] > 0)
        # runs of at least shortest - 1 linked pairs
        edge = np.diff(np.concatenate(([0], linked.astype(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - begin >= shortest - 1
        cover = np.zeros(len(flat) + 1, dtype=np.int64)
        np.add.at(cover, begin[long], 1)
        np.add.at(cover, end[long] + 1, -1)
        return np.cumsum(cover[:-1]) > 0

    def hits(self, texts: list[str | None]) -> list[tuple[int, np.ndarray, list[str]]]:
        """Per text: the number of words, the hit words' numbers, the items."""
        get = self.numbers.get
        counts, docs = [], []
        for text in texts:
            words = [w for w in words_of(text)]
            counts.append(len(words))
            docs.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        place, length, phrase = self.occurrences(docs)
        begins = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])))
        owner = np.searchsorted(begins, place, side="right") - 1
        order = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[order], np.arange(len(docs) + 1))
        found = []
        for i, n in enumerate(counts):
            mine = order[cut[i]:cut[i + 1]]
            if not len(mine):
                found.append((n, np.zeros(0, dtype=np.int64), []))
                continue
            cover = np.zeros(n + 1, dtype=np.int64)
            np.add.at(cover, place[mine] - begins[i], 1)
            np.add.at(cover, place[mine] - begins[i] + length[mine], -1)
            items = set().union(*(self.owners[k] for k in np.unique(phrase[mine])))
            found.append((n, np.flatnonzero(np.cumsum(cover[:-1]) > 0), sorted(items)))
        return found


def phrase_models(benchmark: DataFrame, window: int = WINDOW) -> list:
    """Broadcast models, each over at most about ``MODEL_BYTES`` of benchmark text.

    The size is measured first. The blocks of a large benchmark are fetched one by one.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // MODEL_BYTES) or 1
    keyed = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    models = []
    for block in range(blocks):
        rows = keyed.where(F.col("block") == block).select("item", "text").collect()
        models.append(spark.sparkContext.broadcast(
            Phrases([("" if r.item is None else r.item, r.text) for r in rows], window)))
    return models


def mark_hits(docs: DataFrame, models: list) -> DataFrame:
    """``doc_id, text`` with word count, hit words and items; one narrow pass per model."""
    marked = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("__n"),
        F.array().cast("array<int>").alias("__hits"),
        F.array().cast("array<string>").alias("__items"))
    for model in models:
        def make(model=model):
            def step(columns):
                ids, texts, _, hits, items = columns
                found = model.value.hits(texts)
                return [ids, texts, [n for n, _, _ in found],
                        [sorted({*old, *new.tolist()}) for old, (_, new, _) in zip(hits, found)],
                        [sorted({*old, *new}) for old, (_, _, new) in zip(items, found)]]

            return step

        marked = arrow_pass(marked, f"doc_id long, text string, {HITS}", make)
    return marked


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hit words and items per row of ``docs``.

    Null or empty text has no words. A null ``item_id`` counts as the empty string; null or empty
    items have no windows. Repeated rows give repeated rows; extra columns are ignored; an empty
    table on either side gives no hits.
    """
    marked = mark_hits(docs.withColumn("doc_id", F.col("doc_id").cast("long")),
                       phrase_models(benchmark))
    n_hit = F.size("__hits").cast("long")
    return marked.select(
        "doc_id", F.col("__n").alias("n_words"), n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def without_spans(text: str, hits: np.ndarray) -> str:
    """The text without the hit words; runs of neighbouring words go with what is between."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    breaks = np.flatnonzero(np.diff(hits) != 1) + 1
    for run in np.split(hits, breaks):
        out.append(text[at:spans[run[0]][0]])
        at = spans[run[-1]][1]
    return "".join([*out, text[at:]])


def remove_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with benchmark passages cut out of ``text``, ``n_chars`` set anew.

    Cutting is repeated until no passage is left, so what a cut joins is searched again. All rows
    stay.
    """
    models = phrase_models(benchmark)

    def make():
        def change(texts):
            texts, open_ = list(texts), range(len(texts))
            while open_:
                part = [texts[i] for i in open_]
                found = [[hits for _, hits, _ in model.value.hits(part)] for model in models]
                hits = [np.unique(np.concatenate(each)) for each in zip(*found)]
                open_ = [i for i, hit in zip(open_, hits) if len(hit)]
                for i, hit in zip(open_, [hit for hit in hits if len(hit)]):
                    texts[i] = without_spans(texts[i], hit)
            return texts

        return change

    return rewritten(docs, make)
