"""Benchmark passages against a scan by hand; the FM-index against a plain search."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F
import pytest

from shelfscan.llm import decontamination as D
from shelfscan.llm.common import prepare
from shelfscan.llm.fmindex import FmIndex

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for at in range(len(w) - size + 1) if w else ():
            windows.setdefault(tuple(w[at:at + size]), set()).add(str(item))
    found = []
    for doc_id, text in docs:
        w, hit, owners = words(text), set(), set()
        for size in {len(key) for key in windows}:
            for at in range(len(w) - size + 1):
                if (key := tuple(w[at:at + size])) in windows:
                    owners |= windows[key]
                    hit.update(range(at, at + size))
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(owners), digest, bool(hit)))
    return sorted(found)


def test_index_finds_every_place():
    rng = np.random.default_rng(1)
    for symbols in (2, 3, 9):
        sequence = rng.integers(1, symbols, 300)
        index = FmIndex(sequence, symbols)
        for length in (1, 2, 5):
            patterns = np.array([sequence[i:i + length] for i in range(0, 290, 7)])
            low, high = index.ranges(patterns)
            for pattern, a, b in zip(patterns, low, high):
                wanted = [i for i in range(len(sequence) - length + 1)
                          if (sequence[i:i + length] == pattern).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


@pytest.mark.parametrize("shortest", [1, 4, 12])
def test_hits_against_a_scan_by_hand(spark, shortest):
    prepare(spark)
    rng = random.Random(shortest)
    vocabulary = ["aa", "B", "cc", "é", "Ünd", "x1", "日本"]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "\n"]) for _ in range(n))
    items = [(n, make(shortest + n)) for n in range(6)] + [(20, None), (21, "...")]
    docs = [(n, " ".join([make(rng.randint(0, 40)), items[n % 6][1].upper() if n % 2 else "",
                          make(rng.randint(0, 40))])) for n in range(30)]
    docs += [(100, None), (101, ""), (102, items[2][1] * 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = sorted(map(tuple, D.find_contamination(frame, bench).collect()))
    assert found == by_hand(docs, items)
    several = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    D_bytes, D.MODEL_BYTES = D.MODEL_BYTES, 64
    try:
        assert sorted(map(tuple, D.find_contamination(frame, several).collect())) == found
        cut = D.remove_contamination(frame, several)
        assert cut.columns == frame.columns
        assert not any(r.contaminated for r in D.find_contamination(cut, bench).collect())
    finally:
        D.MODEL_BYTES = D_bytes
    assert D.find_contamination(frame, bench.limit(0)).where("contaminated").count() == 0
    assert D.find_contamination(frame.limit(0), bench).count() == 0


def test_only_the_passage_is_cut(spark):
    prepare(spark)
    passage = "Alpha beta, GAMMA delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame(
        [(1, f"Keep THIS. {passage.upper()}! And that.", 7), (2, "Nothing here", 12)],
        "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = {r.doc_id: (r.text, r.n_chars) for r in D.remove_contamination(docs, bench).collect()}
    text = "Keep THIS. ! And that."
    assert found == {1: (text, len(text)), 2: ("Nothing here", 12)}
