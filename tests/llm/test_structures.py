"""Merkle manifest, prefix trie and quality scores against brute force, and their reference SQL."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscan.llm import merkle, quality, trie
from shelfscan.llm.common import prepare, table
from shelfscan.llm.queries import ORACLES, QUERIES, op13_quality
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_reference_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) is None


# ------------------------------------------------------------- manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sized(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(leaves):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def audited(rows):
    def leaf(row, text):
        return digest(*map(sized, (*row[:1], row[3], row[2], row[4], text)))

    def first(value):
        return (value is not None, value if value is not None else 0)

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, own = [], {}
    for source in sources:
        own[source] = sorted((r for r in rows if r[3] == source),
                             key=lambda r: (first(r[0]), leaf(r, r[1])))
        trees.append(tree_of([leaf(r, r[1]) for r in own[source]]))
    top = tree_of([t[-1][0] for t in trees])
    root, found = top[-1][0], []
    for s, (source, levels) in enumerate(zip(sources, trees)):
        for n, row in enumerate(own[source]):
            odd = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 2
            text = row[1] if odd or row[1] is None else row[1].replace("\n", "")
            at, siblings, fold = n, [], leaf(row, text)
            for path, start in ((levels, n), (top, s)):
                at = start
                for level in path[:-1]:
                    run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
                    siblings += [level[i] for i in run if i != at]
                    fold = digest(*[fold if i == at else level[i] for i in run])
                    at //= 3
            found.append((str(row[0]), leaf(row, row[1]), levels[-1][0], root, digest(*siblings),
                          fold, fold == root))
    return sorted(found)


def manifest_docs():
    rng = random.Random(3)
    rows = [(n, f"line {n}\nnext", rng.choice(["de", None]), rng.choice(["a", "é", "z", "B", "hot", "hot"]),
             rng.randint(0, 99)) for n in range(120)]
    rows += [(7, "other text", "en", "hot", 3), (8, None, None, None, None), (None, "x\n", "en", None, 1),
             (9, "", "", "", 0), (10, "ñ" * 50_000 + "\n", "es", "one", 5)]
    return rows + [rows[0]] * 40 + [rows[3]]


def test_manifest_against_brute_force(spark):
    rows = manifest_docs()
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"tree": F.lit(1), "number": F.lit("x"), "leaf": F.lit("y")})
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    given = F.when(F.crc32(number.cast("binary")) % 2 == 0,
                   F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.audit(docs, given)
    assert tuple(found.columns) == merkle.AUDIT
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == audited(rows)
    assert merkle.audit(docs).where("verified").count() == len(rows)
    assert merkle.audit(docs.limit(0)).count() == 0


def test_proofs_of_wanted_leaves_only(spark):
    docs = spark.createDataFrame(
        manifest_docs(), "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle.build_manifest(docs)
    wanted = spark.createDataFrame([(0, 0), (4, 31), (4, 31), (4, 999), (99, 0)], "tree long, number long")
    every = {(r.tree, r.number): r for r in merkle.proofs(manifest).collect()}
    found = merkle.proofs(manifest, wanted).collect()
    assert sorted((r.tree, r.number) for r in found) == [k for k in ((0, 0), (4, 31)) if k in every]
    assert all(r == every[r.tree, r.number] for r in found)
    # equal subtrees share a record
    assert manifest.store.count() == manifest.store.select("digest").distinct().count()


# ------------------------------------------------------------- trie

def trie_rows():
    rng = random.Random(4)
    rows = []
    for conv in range(150):
        hot = rng.random() < 0.5
        for turn in range(rng.randint(1, 12)):
            text = "start" if hot and turn < 3 else rng.choice(["yes", "no", "é" * turn, "why?"])
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if turn > 3 else "user", text))
    rows += [(500 + n, t, "user", "same") for n in range(30) for t in range(6)]
    rows += [(900, None, None, "null turn"), (900, 2, "user", None), (None, 0, "user", "lost"),
             (None, 1, "user", "id"), (901, 5, "user", "later"), (-3, 1, "user", "minus"),
             (-5, 1, "user", "below"), (902, 1, "user", "long " * 20_000)]
    return rows


def trie_by_hand(rows):
    own = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        own[conv] = [(r[2] or "", r[3] or "") for r in mine]
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(b"" if conv is None else str(conv).encode()) % 9
        base = own.get(conv - conv % 5, []) if conv is not None else []
        rebuilt[conv] = base[:h] + turns[h:]

    def order(conv):
        return (conv is not None, conv or 0)

    nodes = {}
    for conv in sorted(rebuilt, key=order):
        for depth in range(len(rebuilt[conv]) + 1):
            nodes.setdefault(tuple(rebuilt[conv][:depth]), []).append(conv)
    children, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        gain = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += gain
            leaves[path[:depth]] += path not in children
    return sorted((str(m[0]), len(p), str(nodes[p[:-1]][0]) if p else "None", len(m),
                   children.get(p, 0), leaves[p], saved[p], digest(",".join(
                       "" if c is None else str(c) for c in m if len(rebuilt[c]) == len(p))))
                  for p, m in nodes.items())


@pytest.mark.parametrize("shard, prefix", [(trie.SHARD_TURNS, trie.PREFIX_TURNS), (50, 10)])
def test_trie_against_brute_force(spark, shard, prefix):
    """With small shards, prefixes are split and the states above them are merged."""
    rows = trie_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({"id": F.lit(1), "key": F.lit("x"), "turns": F.lit(0)}).repartition(7)
    found = trie.prefix_trie(trie.spliced(trie.sequences(frame)), shard, prefix)
    assert tuple(found.columns) == trie.NODES
    assert sorted((str(r[0]), r[1], str(r[2]), *r[3:]) for r in found.collect()) == trie_by_hand(rows)
    assert trie.prefix_trie(trie.sequences(frame.limit(0))).count() == 0


def test_trie_of_equal_turn_numbers_and_repeated_rows(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 1, "user", "a"),
            (2, 1, "user", "b"), (2, 1, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = trie.prefix_trie(trie.sequences(frame)).collect()
    assert sorted((r.depth, r.n_convs) for r in found) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_double_array_holds_its_edges_and_no_others():
    rng = random.Random(6)
    for _ in range(60):
        paths = [[rng.randrange(rng.choice([3, 200])) for _ in range(rng.randint(0, 8))] for _ in range(40)]
        flat = np.array([t for p in paths for t in p], np.int64)
        lengths = np.array([len(p) for p in paths])
        parents, labels, renamed = trie.edges_of(flat, np.cumsum(lengths) - lengths, lengths)
        array = trie.DoubleArray(parents.tolist(), labels.tolist())
        known = {tuple(p[:d]) for p in paths for d in range(len(p) + 1)}
        assert len(parents) == len(known) - 1 == (array.check >= 0).sum()
        width = int(labels.max()) + 3 if len(labels) else 3
        back = {int(renamed[t]): t for t in set(flat.tolist())}
        states = {(): 0}
        for path in sorted(known, key=len):
            state = states[path]
            step = array.step(np.full(width, state), np.arange(width))
            for label, child in enumerate(step.tolist()):
                below = (*path, back.get(label, -1))
                assert (child >= 0) == (below in known)
                if child >= 0:
                    states[below] = child
        assert len(set(states.values())) == len(known)


# ------------------------------------------------------------- quality

def test_scores_are_the_softmax_of_the_averaged_vectors():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=(quality.BUCKETS, quality.WIDTH)).astype(np.float32),
                          rng.normal(size=(2, quality.WIDTH)).astype(np.float32),
                          np.array([0.3, -0.1], np.float32))
    texts = ["one two two three", "", None, "x", "q" * 2500 + " end", "é ß   😀", "a " * 3000, "one two"]
    score = quality.Scorer(model.row_scores(), model.base_score())
    for _ in range(2):  # the second time from memory
        for text, found in zip(texts, score(texts)):
            at, shares = quality.features(text)
            logits = model.out @ (shares @ model.vectors[at]) + model.bias
            assert found == pytest.approx(1 / (1 + np.exp(logits[0] - logits[1])), abs=1e-4)


def test_features_by_hand():
    at, shares = quality.features("to to be")
    words = ["to", "be"]
    rows, owner, hashes = quality.word_rows(words)
    # per word: "^to$" has grams ^to, to$, ^to$; and the word itself
    assert np.bincount(owner).tolist() == [4, 4] and len(set(rows.tolist())) == 8
    alone = [quality.word_rows([word]) for word in words]
    assert sorted(rows.tolist()) == sorted(np.concatenate([a[0] for a in alone]).tolist())
    assert hashes.tolist() == [int(a[2][0]) for a in alone]
    assert shares.sum() == pytest.approx(1) and len(at) == 10
    assert shares.max() == pytest.approx(2 / 14)


def test_learns_and_keeps_held_out_labels_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    prepare(spark)
    found = op13_quality(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("d"), "quality")
    rows = found.join(labels, found.doc_id == labels.d, "left").collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    held = [r for r in rows if r.quality is not None and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    # labels of the held-out fold change nothing
    docs, given = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    flipped = given.withColumn("quality", F.when(
        quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(
        docs, quality.train(docs, flipped)).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_quality_of_odd_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (None, "some text"), (3, "w" * 300_000), (3, "w" * 300_000), (4, "ok ok")],
        "doc_id long, text string").withColumns({"score": F.lit("x"), "quality": F.lit(5)})
    labels = spark.createDataFrame(
        [(1, 1), (3, 0), (3, 0), (4, None), (None, 1), (77, 1)], "doc_id long, quality int")
    found = quality.score_quality(docs, quality.train(docs, labels)).collect()
    assert len(found) == 6 and len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), nothing).count() == 0
