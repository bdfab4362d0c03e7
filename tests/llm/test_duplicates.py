"""Repeated substrings, SimHash and vectors against brute force; components."""

from collections import Counter
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F
import pytest
import xxhash

from shelfscan.llm import lattice, simhash, substrings
from shelfscan.llm.common import prepare
from shelfscan.llm.graph import connected
from shelfscan.llm.gray import GrayIndex, components
from shelfscan.llm.suffixes import Hashed, merge_sort


def made_docs():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdé ") for _ in range(900))
    docs = [(n, "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 1500)))
             + passage[rng.randint(0, 300):rng.randint(400, 900)]
             + "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 90)))) for n in range(40)]
    docs += [(50, docs[3][1]), (51, docs[3][1]), (52, "a" * 3000), (53, ""), (54, None),
             (None, passage), (55, "ab" * 500 + passage), (3, docs[3][1]), (56, "z" * 399)]
    return docs


def removed_by_hand(docs):
    counts, found = Counter(), []
    for _, text in docs:
        data = (text or "").encode()
        counts.update(data[i:i + 400] for i in range(len(data) - 399))
    for doc_id, text in docs:
        data = (text or "").encode()
        cover = bytearray(len(data))
        for i in range(len(data) - 399):
            if counts[data[i:i + 400]] > 1:
                cover[i:i + 400] = b"\1" * 400
        kept = bytes(c for c, m in zip(data, cover) if not m)
        found.append((str(doc_id), len(data), sum(cover), len(re.findall(rb"\x01+", bytes(cover))),
                      hashlib.sha256(kept).hexdigest()))
    return sorted(found)


@pytest.mark.parametrize("group", [substrings.GROUP, 5, 0])
def test_repeats_against_brute_force(spark, monkeypatch, group):
    """With few or no stretches allowed in a task, anchors are split, down to single windows."""
    prepare(spark)
    monkeypatch.setattr(substrings, "GROUP", group)
    docs = made_docs()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"h": F.lit("x"), "spans": F.lit(1)})
    found = substrings.remove_repeats(frame).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == removed_by_hand(docs)
    assert substrings.remove_repeats(frame.limit(0)).count() == 0


def test_windows_across_chunks(monkeypatch):
    rng = random.Random(1)
    data = bytes(rng.choice(b"ab") for _ in range(5000))
    monkeypatch.setattr(substrings, "CHUNK", 700)
    starts = [start + i for start, _, size, _, _ in substrings.members_of(data) for i in range(size)]
    assert starts == list(range(len(data) - 399))


def test_suffixes_are_sorted_and_wrong_hashes_found_out():
    rng = random.Random(2)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    buffer = b"".join(parts)
    data = np.frombuffer(buffer, np.uint8)
    end = np.cumsum([len(p) for p in parts])
    begin = end - [len(p) for p in parts]
    group = np.sort(np.random.default_rng(1).integers(0, 9, 300))
    order = merge_sort(data, Hashed(data), begin, end, group)
    assert order.tolist() == sorted(range(300), key=lambda i: (group[i], parts[i], i))
    assert substrings.verified(b"xabcyabd", 1, 5, 1, 3) == (0, 2)


def brute_components(codes, limit):
    label = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if bin(a ^ codes[j]).count("1") <= limit and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_index_finds_all_near_codes():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    codes = np.unique(np.concatenate([base] + [
        base ^ (np.uint64(1) << rng.integers(0, 64, 20, dtype=np.uint64)) for _ in range(15)]))
    group = (codes % np.uint64(3)).astype(np.int64)
    for limit in (0, 2, 5):
        found = {tuple(sorted(p)) for i, j in GrayIndex(codes, group).near(limit)
                 for p in zip(i.tolist(), j.tolist())}
        wanted = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes))
                  if group[i] == group[j] and int(codes[i] ^ codes[j]).bit_count() <= limit}
        assert found == wanted


def test_fingerprints_and_components_against_brute_force(spark):
    prepare(spark)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcÄö") for _ in range(rng.randint(1, 5)))
    base = [" ".join(word() for _ in range(300)) for _ in range(4)]
    texts = [None, "", " \t", "one", "One two", *base]
    for text in base:
        for _ in range(12):
            w = text.split(" ")
            w[rng.randrange(len(w))] = word()
            texts.append(rng.choice([" ", "\n\x0b"]).join(w).upper() if rng.random() < .2 else " ".join(w))
    docs = list(enumerate(texts)) + [(9, texts[9])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("code", F.lit(1))
    codes = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        codes.append(sum(1 << b for b in range(64)
                         if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = brute_components(codes, 2)
    wanted = sorted((d, f"{c:016x}", docs[label[i]][0]) for i, ((d, _), c) in enumerate(zip(docs, codes)))
    assert sorted(map(tuple, simhash.fingerprint_components(frame).collect())) == wanted
    assert simhash.fingerprint_components(frame.limit(0)).count() == 0


def test_near_duplicates_keep_one_of_each_group(spark):
    prepare(spark)
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs, groups = [], []
    for size in (8, 30, 200, 1500):
        base = fresh(size)
        group = [base, list(base)]
        if size > 100:
            group += [base[:-3] + fresh(3), fresh(3) + base[3:], base[:size // 2] + base[size // 2 + 1:]]
        groups.append(range(len(docs), len(docs) + len(group)))
        docs += group
        docs.append(base[:size // 2] + fresh(size // 2))
    rows = [(n, " ".join(d), "en", n) for n, d in enumerate(docs)]
    rows += [rows[0], (None, "alone without an id here", "en", 1), (99, "one", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, root long")
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    wanted = {n for n in range(len(docs))} - {n for g in groups for n in g[1:]} | {None, 99}
    found = [r.doc_id for r in kept.collect()]
    assert set(found) == wanted and len(found) == len(wanted)
    assert simhash.drop_near_duplicates(frame.limit(0)).count() == 0


def shingle_set(text, words=5):
    w = text.split()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def test_near_duplicates_are_decided_on_their_shingles(spark):
    """Pairs just below the similarity stay, those at it that meet in a band do not."""
    prepare(spark)
    rng = random.Random(12)
    rows, below, reached = [], set(), set()
    for n in range(120):
        # of 90 shingles each, 10 new words at the end leave 80 (0.8), 11 leave 79 (0.782)
        new = (10, 11)[n % 2]
        base = [f"w{rng.randrange(10**9)}" for _ in range(94)]
        pair = [" ".join(base), " ".join(base[:-new] + [f"v{rng.randrange(10**9)}" for _ in range(new)])]
        a, b = map(shingle_set, pair)
        one, two = (np.frombuffer(simhash.signature(t)[1], "<u2", simhash.BANDS) for t in pair)
        if len(a & b) / len(a | b) < 0.8:
            below.add(2 * n + 1)
        elif (one == two).any():
            reached.add(2 * n + 1)
        rows += [(2 * n, pair[0]), (2 * n + 1, pair[1])]
    assert len(below) == 60 and len(reached) > 50
    kept = {r.doc_id for r in simhash.drop_near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert below <= kept and not reached & kept
    assert {n for n in range(0, 240, 2)} <= kept


def test_short_near_duplicates_are_all_found(spark):
    """4 against 5 shingles, exactly 0.8, share no band in about a tenth of the pairs."""
    prepare(spark)
    rng = random.Random(13)
    rows, apart = [], 0
    for n in range(150):
        words = [f"w{rng.randrange(10**9)}" for _ in range(9)]
        pair = [" ".join(words[:8]), " ".join(words)]
        one, two = (np.frombuffer(simhash.signature(t)[1], "<u2", simhash.BANDS) for t in pair)
        apart += not (one == two).any()
        rows += [(2 * n, pair[0]), (2 * n + 1, pair[1])]
    assert apart
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 300, 2))


def test_all_pairs_of_dealt_rows_meet(spark):
    rows = simhash.dealt(spark.range(40).select(F.col("id").alias("node"), F.lit(3).alias("shares")))
    groups = {}
    for r in rows.collect():
        groups.setdefault((r.i, r.j), set()).add(r.node)
    met = {(a, b) for g in groups.values() for a in g for b in g}
    assert met == {(a, b) for a in range(40) for b in range(40)} and len(groups) == 6


def test_large_buckets_are_linked_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 10)
    rng = random.Random(3)
    base = [f"w{n}" for n in range(300)]
    texts = [" ".join(base[:k] + [f"v{rng.random()}"] + base[k + 1:]) for k in rng.sample(range(300), 45)]
    made = [simhash.signature(t) for t in [*texts, " ".join(base[::-1])]]
    bits = np.array([np.frombuffer(s, "<u8", simhash.BANDS // 4) for _, s in made])
    sizes = np.array([n for n, _ in made])
    label = components(46, *simhash._large_links(bits, sizes, [set()] * 46, 0, 46, 0.8))
    assert label.tolist() == [0] * 45 + [45]


def test_links_through_rows_that_are_no_heads(monkeypatch):
    """The first row and the last are linked by the second only, which is no head in its block."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 1)
    base = [f"w{n}" for n in range(300)]
    texts = [base[:-22] + [f"x{n}" for n in range(22)], base, [f"y{n}" for n in range(22)] + base[22:]]
    made = [simhash.signature(" ".join(t)) for t in texts]
    bits = np.array([np.frombuffer(s, "<u8", simhash.BANDS // 4) for _, s in made])
    sizes = np.array([n for n, _ in made])
    links = lambda rows: components(len(rows), *simhash._large_links(
        bits[rows], sizes[rows], [set()] * len(rows), 0, len(rows), 0.8)).tolist()
    assert links([0, 1]) == links([1, 2]) == [0, 0] and links([0, 2]) == [0, 1]
    assert links([0, 1, 2]) == [0, 0, 0]


def test_large_buckets_are_dealt_whole(spark, monkeypatch):
    """Blocks of few rows and buckets that are not searched give the same groups."""
    prepare(spark)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 7)
    monkeypatch.setattr(simhash, "MEET_ROWS", 20)
    base = [f"w{n}" for n in range(300)]
    rows = [(n, " ".join(base[:3 * n] + [f"v{n}"] + base[3 * n + 1:])) for n in range(90)]
    rows.append((90, " ".join(base[::-1])))
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 90]


def test_components_of_paths_and_stars(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(7, n) for n in range(10, 40)] + [(5, 5), (3, 2), (2, 3)]
    found = {r.a: r.b for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    wanted = {n: 100 for n in range(101, 161)} | {n: 7 for n in range(10, 40)} | {3: 2}
    assert found == wanted
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_e8_points_are_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    point = lattice.decode(x)
    assert len(lattice.MINIMAL) == 240
    distance = ((x - point) ** 2).sum(axis=1)
    for move in lattice.MINIMAL:
        assert (((x - point - move) ** 2).sum(axis=1) >= distance - 1e-9).all()


def test_vectors_against_brute_force(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(lattice, "CELL_ROWS", 5)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 64))
    near = base[:60] + rng.normal(size=(60, 64)) * 0.15
    crowd = base[0] + rng.normal(size=(40, 64)) * 0.05
    vectors = np.concatenate((base, near, crowd, base[:5], 2 * base[5:9])).astype(np.float32)
    rows = [(n, v.tolist(), "x") for n, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 64), (902, [float("nan")] * 64), (903, [None, 1.0]), (904, []),
           (905, [float("inf"), 1.0]), (906, [3.0, 4.0]), (907, [6.0, 8.0]), (None, [5.0, 1.0, 2.0])]
    frame = spark.createDataFrame(rows + [(i, v, "x") for i, v in odd],
                                  "vec_id long, embedding array<float>, node string")
    found = {r.vec_id: r for r in lattice.near_vectors(frame).collect()}
    assert len(found) == len(rows) + len(odd)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    links = np.array([found[n].n_links for n in range(len(rows))])
    assert (links <= close.sum(axis=1)).all()
    assert links.sum() >= 0.97 * close.sum()
    assert all(found[n].component_id <= n and found[n].kept == (found[n].component_id == n) for n in range(len(rows)))
    assert [(found[i].n_links, found[i].component_id) for i, _ in odd[:6]] == [(0, i) for i, _ in odd[:6]]
    assert found[906].n_links == found[907].n_links == 1 and found[907].component_id == 906
    assert lattice.near_vectors(frame.limit(0)).count() == 0
