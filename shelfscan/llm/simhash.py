"""SimHash near duplicates.

``fingerprint_components`` links fingerprints of 64 bits that differ in at most two. The bits are
parted into six blocks; two differences leave four blocks equal, so fingerprints meet under one of
15 keys. What meets under a key differs in two blocks of at most 22 bits, which bounds a group by
2**22 distinct fingerprints, however many documents there are. Groups are searched through the Gray
index and give one link per fingerprint.

``near_duplicates`` works at a similarity of word shingles. Documents meet when one of 64 bands of
16 bits is equal, and small sets of shingles also under their least hashes; 1024 bits estimate the similarity and form loose components. Inside these, a pair
counts when its shingle sets reach the similarity exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
import xxhash

from shelfscan.llm.common import arrow_pass, arrow_schema, stored
from shelfscan.llm.graph import connected
from shelfscan.llm.gray import GrayIndex, components, gray_rank

SEED = 42
MAX_BITS = 2
BLOCKS = (11, 11, 11, 11, 10, 10)
SHINGLE_WORDS = 3

NEAR_WORDS = 5
SIMILARITY = 0.8
BANDS = 64
#: Shingle sets up to this size are carried along and compared exactly.
SMALL_SET = 32
#: Bits of the first 64 that may differ before the full signature is looked at.
LOOSE_BITS = 20
#: How far the estimate from the bits, whose spread is about 0.026, may stay below the similarity.
LOOSE = 0.15
#: Shingles of one block of a loose component, about.
BLOCK_SHINGLES = 1 << 20
#: Rows up to which a bucket is small: all are compared at once with those of other small ones.
SMALL_BUCKET = 64
#: Rows of a block, about: larger buckets and components are dealt into pairs of blocks.
BLOCK_ROWS = 2048
#: Rows up to which a bucket is searched for loosely near ones; larger buckets go on whole.
MEET_ROWS = 8192

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included."""
    # bytes.split() parts at the blank and 0x09 to 0x0D, as needed
    found = text.encode().translate(LOWER).split() if text else []
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[:len(found) - words + 1].tolist()
    ends = (ends - 1)[words - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Per column of 64-bit hashes, the bits set in over half the rows, as 64-bit numbers."""
    n, width = hashes.shape
    counts = np.zeros(width * 64, dtype=np.int64)
    for begin in range(0, n, 4096):
        part = hashes[begin:begin + 4096]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1)
        for at in range(0, len(bits), 255):
            counts += np.add.reduce(bits[at:at + 255], axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > n).view(">u8").astype(np.uint64)


def fingerprint(text: str | None) -> int:
    hashes = shingle_hashes(text, SHINGLE_WORDS)
    return int(majority(hashes[:, None])[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    def make():
        def step(columns):
            found = np.array([fingerprint(text) for text in columns[1]], dtype=np.uint64)
            return [columns[0], found.view(np.int64)]

        return step

    return arrow_pass(docs.select("doc_id", "text"), "doc_id long, code long", make)


def key_masks() -> list[int]:
    """Masks of every four of the six blocks, as signed numbers."""
    blocks, low = [], 0
    for size in BLOCKS:
        blocks.append(((1 << size) - 1) << low)
        low += size
    found = [sum(four) for four in combinations(blocks, len(BLOCKS) - MAX_BITS)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in found]


def groups_in(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int
              ) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows from batches sorted by ``keys``; a key's rows stay
    together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        differ = np.zeros(size - 1, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            differ |= values[1:] != values[:-1]
        cut = int(differ.nonzero()[0][-1]) + 1 if differ.any() else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size -= cut
    if held:
        yield pa.Table.from_batches(held)


def links_of_codes(codes: DataFrame) -> DataFrame:
    """``a, b``: each of the distinct ``code`` values with the smallest it reaches in a group."""
    schema = arrow_schema(codes.sparkSession, "a long, b long")

    def run(batches):
        for table in groups_in(batches, ["mask", "part"], 100_000):
            code = table.column("code").to_numpy()
            mask, part = table.column("mask").to_numpy(), table.column("part").to_numpy()
            new = (mask[1:] != mask[:-1]) | (part[1:] != part[:-1])
            group = np.concatenate(([0], np.cumsum(new)))
            several = np.bincount(group)[group] > 1
            code, group = code[several], group[several]
            if not len(code):
                continue
            index = GrayIndex(code.view(np.uint64), group)
            pairs = list(index.near(MAX_BITS))
            if not pairs:
                continue
            label = components(len(code), *map(np.concatenate, zip(*pairs)))
            moved = np.flatnonzero(code != code[label])
            yield pa.RecordBatch.from_arrays([code[moved], code[label[moved]]], schema=schema)

    keyed = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("code").bitwiseAND(F.lit(mask)).alias("part"))
        for i, mask in enumerate(key_masks())])).alias("key")).select("code", "key.*")
    grouped = keyed.repartition("mask", "part").sortWithinPartitions("mask", "part")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def fingerprint_components(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Null, empty and blank texts have fingerprint zero and are linked like any other. A null
    ``doc_id`` never names a component unless it has no other. Repeated rows give repeated rows,
    extra columns are ignored, an empty table gives an empty table.
    """
    coded = stored(fingerprints(docs), "fingerprints")
    codes = stored(coded.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    root = connected(links_of_codes(codes)).select(F.col("a").alias("code"), F.col("b").alias("root"))
    rooted = codes.join(root, "code", "left").withColumn("root", F.coalesce("root", "code"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_code = rooted.join(named, "root").select("code", "component_id")
    return coded.join(of_code, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def signature(text: str | None, words: int = NEAR_WORDS) -> tuple[int, bytes]:
    """The number of distinct shingles, and 1024 bits followed by a small set's hashes."""
    hashes = np.unique(shingle_hashes(text, words))
    if not len(hashes):
        return 0, b""
    spread = np.arange(1, BANDS // 4 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = hashes[:, None] ^ spread[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    bits = majority(mixed ^ (mixed >> np.uint64(31))).astype("<u8").tobytes()
    small = hashes.astype("<u8").tobytes() if len(hashes) <= SMALL_SET else b""
    return len(hashes), bits + small


def estimated(bits: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray,
              similarity: float) -> np.ndarray:
    """Whether the rows i and j reach the similarity by their bits."""
    angle = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1) * (math.pi / (16 * BANDS))
    a, b = sizes[i].astype(float), sizes[j].astype(float)
    both = np.minimum(np.cos(angle) * np.sqrt(a * b), np.minimum(a, b))
    return (both >= similarity * (a + b - both)) & (
        np.minimum(a, b) >= similarity * np.maximum(a, b))


def similar(bits: np.ndarray, sizes: np.ndarray, sets: list, i: np.ndarray, j: np.ndarray,
            similarity: float) -> np.ndarray:
    """Whether the rows i and j reach the similarity: exact for small sets, else estimated."""
    hit = estimated(bits, sizes, i, j, similarity)
    a, b = sizes[i].astype(float), sizes[j].astype(float)
    exact = np.flatnonzero((sizes[i] <= SMALL_SET) & (sizes[j] <= SMALL_SET)
                           & (np.minimum(a, b) >= similarity * np.maximum(a, b)))
    for k in exact.tolist():
        one, two = sets[i[k]], sets[j[k]]
        shared = len(one & two)
        hit[k] = shared >= similarity * (len(one) + len(two) - shared)
    return hit


def signed_nodes(docs: DataFrame, words: int) -> DataFrame:
    """``node, n, sig, least`` per distinct signature; ``least`` is its first document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")

    def make():
        def step(columns):
            found = [signature(text, words) for text in columns[2]]
            return [columns[0], columns[1], [n for n, _ in found], [sig for _, sig in found]]

        return step

    signed = arrow_pass(rows, "doc_id long, h long, n int, sig binary", make)
    return stored(
        signed.groupBy("n", "sig").agg(F.min(F.struct("doc_id", "h")).alias("least"))
        .withColumn("node", F.xxhash64("n", "sig")), "signatures")


def met_in_prefixes(nodes: DataFrame, similarity: float) -> DataFrame:
    """``bucket, node`` under the least shingle hashes of small sets: two sets that reach the
    similarity share one of these."""
    def make():
        def step(columns):
            node, sizes, sigs = columns
            keys = [np.frombuffer(s, "<i8", offset=2 * BANDS)[:n - math.ceil(similarity * n - 1e-9) + 1]
                    .tolist() for n, s in zip(sizes, sigs)]
            return [node, keys]

        return step

    small = nodes.where(F.col("n").between(1, SMALL_SET)).select("node", "n", "sig")
    keyed = arrow_pass(small, "node long, keys array<long>", make)
    return keyed.select(F.explode("keys").alias("bucket"), "node")


def met_in_bands(nodes: DataFrame) -> DataFrame:
    """``bucket, node``: nodes that are loosely near another one of their bucket."""
    spark = nodes.sparkSession

    def make():
        def step(columns):
            node, sig = columns
            bands = [np.frombuffer(s[:2 * BANDS], "<u2").tolist() for s in sig]
            codes = np.array([int.from_bytes(s[:8], "little") for s in sig], dtype=np.uint64)
            return [node, bands, codes.view(np.int64)]

        return step

    banded = stored(arrow_pass(nodes.where("n > 0").select("node", "sig"),
                               "node long, bands array<int>, code long", make), "bands")
    rows = banded.select("node", "code", F.posexplode("bands").alias("band", "value")).select(
        (F.col("band") * 65536 + F.col("value")).alias("bucket"), "node", "code")
    large = F.broadcast(rows.groupBy("bucket").count().where(F.col("count") > MEET_ROWS)
                        .select("bucket"))
    schema = arrow_schema(spark, "bucket int, node long")

    def run(batches):
        for table in groups_in(batches, ["bucket"], 50_000):
            bucket, code = table.column("bucket").to_numpy(), table.column("code").to_numpy()
            node = table.column("node").to_numpy()
            index = GrayIndex(code.view(np.uint64), bucket)
            met = np.zeros(len(code), dtype=bool)
            for i, j in index.near(LOOSE_BITS):
                met[i] = met[j] = True
            yield pa.RecordBatch.from_arrays([bucket[met], node[met]], schema=schema)

    ordered = (rows.join(large, "bucket", "left_anti").repartition("bucket")
               .sortWithinPartitions("bucket", "code"))
    return ordered.mapInArrow(run, "bucket int, node long").union(
        rows.join(large, "bucket", "left_semi").select("bucket", "node"))


def links_of_nodes(nodes: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: similar nodes of a bucket, as many as span what is connected there.

    Each pair of nodes in a bucket is compared, unless other pairs connect it already."""
    spark = nodes.sparkSession
    met = stored(met_in_bands(nodes).withColumn("bucket", F.col("bucket").cast("long"))
                 .union(met_in_prefixes(nodes, similarity)), "met")
    large = F.broadcast(met.groupBy("bucket").count().where(F.col("count") > BLOCK_ROWS).select(
        "bucket", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("shares")))
    shared = met.join(large, "bucket", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    schema = arrow_schema(spark, "a long, b long")

    def run(batches):
        for table in groups_in(batches, ["bucket", "i", "j"], 4 * BLOCK_ROWS):
            bucket, i, j = (table.column(c).to_numpy() for c in ("bucket", "i", "j"))
            node, block = table.column("node").to_numpy(), table.column("block").to_numpy()
            sizes = table.column("n").to_numpy()
            sigs = table.column("sig").to_pylist()
            bits = np.array([np.frombuffer(s, "<u8", BANDS // 4) for s in sigs])
            sets = [set(np.frombuffer(s, "<u8", offset=2 * BANDS).tolist()) for s in sigs]
            new = (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
            group = np.concatenate(([0], np.cumsum(new)))
            edge = np.concatenate(([0], np.flatnonzero(new) + 1, [len(bucket)]))
            long = np.diff(edge) > SMALL_BUCKET
            found = [_small_links(bits, sizes, sets, group, np.repeat(~long, np.diff(edge)),
                                  similarity)]
            for begin, end in zip(edge[:-1][long], edge[1:][long]):
                cut = int((block[begin:end] == i[begin]).sum()) if i[begin] != j[begin] else 0
                found.append(_large_links(bits, sizes, sets, begin, end, similarity, cut))
            label = components(len(bucket), *map(np.concatenate, zip(*found)))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([node[moved], node[label[moved]]], schema=schema)

    ordered = (dealt(shared).join(nodes.select("node", "n", "sig"), "node")
               .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block", "node"))
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _small_links(bits, sizes, sets, bucket, small, similarity):
    """Links inside the small buckets: each row with those at every distance after it."""
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for step in range(1, SMALL_BUCKET):
        i = np.flatnonzero((bucket[step:] == bucket[:-step]) & small[step:])
        if not len(i):
            break
        for at in range(0, len(i), 1 << 16):
            part = i[at:at + (1 << 16)]
            hit = part[similar(bits, sizes, sets, part, part + step, similarity)]
            left.append(hit)
            right.append(hit + step)
    return np.concatenate(left), np.concatenate(right)


def _large_links(bits, sizes, sets, begin: int, end: int, similarity: float, cut: int = 0):
    """Links inside one bucket: the first ``cut`` rows are compared with the others, or all with
    each other if it is 0. Rows that are connected already are left out."""
    n = end - begin
    own, label = np.arange(n), np.arange(n)
    for low in range(0, cut or n, 64):
        one, two = own[low:min(low + 64, cut or n)], own[cut or low:]
        i, j = np.repeat(one, len(two)), np.tile(two, len(one))
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        hit = similar(bits, sizes, sets, begin + i, begin + j, similarity)
        moved = np.flatnonzero(label != own)
        label = components(n, np.concatenate((moved, i[hit])), np.concatenate((label[moved], j[hit])))
    moved = np.flatnonzero(label != own)
    return begin + moved, begin + label[moved]


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block, i, j`` for ``shares``: the rows of a key fall into so many blocks, and
    each block meets itself and every other one, as the pair i <= j."""
    return (rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("shares", "other"))


def reaches(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingles, as different hashes, reach the similarity."""
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return shared >= similarity * (len(one) + len(two) - shared)


def exact_links(bits: np.ndarray, sets: list[np.ndarray], cut: int, similarity: float
                ) -> tuple[list[int], list[int]]:
    """Similar rows, as many as span their components: those before ``cut`` against the others, or
    all against each other if it is the number of rows."""
    n = len(sets)
    sizes, label = np.array([len(s) for s in sets]), np.arange(n)
    left, right = [], []
    for i in range(cut):
        two = np.arange(cut if cut < n else i + 1, n)
        two = two[label[two] != label[i]]
        one = np.full(len(two), i)
        maybe = estimated(bits, sizes, one, two, similarity - LOOSE)
        maybe |= np.maximum(sizes[one], sizes[two]) <= SMALL_SET
        maybe &= np.minimum(sizes[one], sizes[two]) >= similarity * np.maximum(sizes[one], sizes[two])
        for j in two[maybe].tolist():
            if label[j] != label[i] and reaches(sets[i], sets[j], similarity):
                left.append(i)
                right.append(j)
                label[label == label[j]] = label[i]
    return left, right


def verified_links(docs: DataFrame, nodes: DataFrame, loose: DataFrame, words: int,
                   similarity: float) -> DataFrame:
    """``a, b``: nodes that reach the similarity on their shingles, within what the links ``loose``
    connect."""
    root = connected(loose)
    members = (root.select(F.col("a").alias("node"), F.col("b").alias("root"))
               .union(root.select("b", "b").distinct()).join(nodes, "node"))
    shares = members.groupBy("root").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("shares"))
    members = members.join(shares, "root").select(
        "root", "node", "shares", "sig", F.col("least.doc_id").alias("id"), F.col("least.h").alias("own"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("h"), "text")
    # repeated rows come once
    found = texts.join(members, texts["doc_id"].eqNullSafe(members["id"])
                       & (texts["h"] == members["own"])).groupBy("root", "node", "shares", "sig").agg(
        F.first("text").alias("text"))

    def make():
        def step(columns):
            *kept, sigs, texts = columns
            return [*kept, [s[:2 * BANDS] for s in sigs],
                    [np.unique(shingle_hashes(t, words)).astype("<u8").tobytes() for t in texts]]

        return step

    sets = arrow_pass(found.select("root", "node", "shares", "sig", "text"),
                      "root long, node long, shares int, bits binary, hashes binary", make)
    schema = arrow_schema(docs.sparkSession, "a long, b long")

    def run(batches):
        for table in groups_in(batches, ["root", "i", "j"], 1):
            root, i, j = (table.column(c).to_numpy() for c in ("root", "i", "j"))
            node, block = table.column("node").to_numpy(), table.column("block").to_numpy()
            bits = np.array([np.frombuffer(b.as_buffer(), "<u8") for b in table.column("bits")])
            sets = [np.frombuffer(b.as_buffer(), "<u8") for b in table.column("hashes")]
            new = (np.diff(root) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
            edge = [0, *(np.flatnonzero(new) + 1).tolist(), len(root)]
            a, b = [], []
            for low, high in zip(edge, edge[1:]):
                cut = int((block[low:high] == i[low]).sum())
                if cut == high - low and i[low] != j[low]:
                    continue
                left, right = exact_links(bits[low:high], sets[low:high], cut, similarity)
                a += [low + k for k in left]
                b += [low + k for k in right]
            yield pa.RecordBatch.from_arrays(
                [node[np.array(a, dtype=np.int64)], node[np.array(b, dtype=np.int64)]], schema=schema)

    ordered = dealt(sets).repartition("root", "i", "j").sortWithinPartitions(
        "root", "i", "j", "block", "node")
    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = NEAR_WORDS, similarity: float = SIMILARITY
                    ) -> DataFrame:
    """``doc_id, h`` of the document that stands for each group; h is the hash of its text.

    Documents without words are copies of each other. The first ``doc_id`` stands for a group.
    """
    nodes = signed_nodes(docs, words)
    loose = stored(links_of_nodes(nodes, similarity - LOOSE), "loose")
    root = connected(verified_links(docs, nodes, loose, words, similarity))
    rooted = nodes.join(root.select(F.col("a").alias("node"), F.col("b").alias("root")),
                        "node", "left")
    return (rooted.groupBy(F.coalesce("root", "node").alias("root"))
            .agg(F.min("least").alias("least")).select("least.*"))


def drop_near_duplicates(docs: DataFrame, words: int = NEAR_WORDS, similarity: float = SIMILARITY
                         ) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; columns stay as they are.

    Of repeated rows one stays. Null ids and texts are handled like any other.
    """
    keepers = near_duplicates(docs, words, similarity).select(
        F.col("doc_id").alias("__id"), F.col("h").alias("__h"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.withColumn("__own", F.xxhash64("text"))
    kept = hashed.join(keepers, hashed["doc_id"].cast("long").eqNullSafe(keepers["__id"])
                       & (hashed["__own"] == keepers["__h"]))
    one = Window.partitionBy("__id", "__h").orderBy("__h")
    return kept.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*columns)
