"""Merkle manifest of a dataset as a content-addressed store, with a proof for every row.

A row's leaf is the digest of its fields. The leaves of a source, in order of ``doc_id``, form a tree
of runs of three, and the sources' roots form another on top. The store keeps one record per inner
digest, the digests of its children; equal subtrees share a record. Proofs come from the store
alone: requested leaves descend from the root by the digits of their rank to base three. Requests
that still agree descend as one, and each step looks up the record of the digest it has reached,
takes the child that the digit names and keeps the others as a segment in front of the path. At the
leaf, the path therefore lists the segments from the leaf up.

Ranks come from range partitions and small counts per partition, so a source of any size is spread.
Three levels are one grouping on the way up, and each level is one join on the way down, at three
times the rows of the one before. Digests travel as 32 bytes; they are hashed as lowercase hex text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.common import stored

RUN = 3
WIDTH = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
AUDIT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
#: Bits of a row's place that count rows inside its partition.
PLACE_BITS = 33
#: Levels that one pass adds on the way up, or goes down between two written tables.
LIFT = 3


@dataclass
class Manifest:
    """``leaves``: doc_id, source, leaf, delivered, tree, number. ``sources``: source, number, size,
    subroot, levels. ``store``: digest, children. ``levels`` lie between the root and the sources;
    ``root`` is None for an empty dataset."""

    leaves: DataFrame
    sources: DataFrame
    store: DataFrame
    root: bytes | None
    levels: int


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def sized(value: Column) -> Column:
    """A field as its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(sized, fields)), 256))


def inner_of(children: Column) -> Column:
    return F.unhex(F.sha2(hexed(children), 256))


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with their ``place``: increasing in this order, counted from 0 in each partition.

    Rows that agree in all of ``order`` are dealt by their place in the input, so that even one
    row repeated without end is spread.
    """
    keys = [F.col(name).asc_nulls_first() for name in order]
    dealt = rows.withColumn("dealt", F.monotonically_increasing_id())
    return stored(
        dealt.repartitionByRange(*keys, F.col("dealt")).sortWithinPartitions(*keys, "dealt")
        .withColumn("place", F.monotonically_increasing_id()).drop("dealt"), "ordered")


def in_tree(counts: DataFrame, *tree: str) -> DataFrame:
    """Per partition and tree: the rows of the tree in earlier partitions, and in all."""
    whole = Window.partitionBy(*tree)
    return counts.select(
        *tree, "part", "first",
        (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(whole).alias("size"))


def partitions_of(ordered: DataFrame, *tree: str) -> DataFrame:
    return ordered.groupBy(*tree, F.shiftright("place", PLACE_BITS).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))


def numbered_sources(parts: DataFrame) -> DataFrame:
    """``source, number, sources``: all sources, null first, numbered from 0."""
    ordered = in_order(parts.select("source").distinct(), "source")
    counts = in_tree(partitions_of(ordered))
    return ordered.withColumn("part", F.shiftright("place", PLACE_BITS)).join(counts, "part").select(
        "source", (F.col("before") + F.col("place") - F.col("first")).alias("number"),
        F.col("size").alias("sources"))


def numbered_leaves(docs: DataFrame, delivered: Column) -> tuple[DataFrame, DataFrame]:
    """The leaves with their tree, which is their source's number, and their number there; and the
    sources with their sizes."""
    fields = [F.col(name) for name in FIELDS]
    leaves = docs.select(*fields, delivered.alias("given")).select(
        "doc_id", "source", leaf_of(*fields).alias("leaf"),
        leaf_of(*fields[:-1], F.col("given")).alias("delivered"))
    ordered = in_order(stored(leaves, "leaves"), "source", "doc_id", "leaf")
    parts = stored(partitions_of(ordered, "source"), "parts")
    counts = in_tree(parts, "source")
    sources = stored(numbered_sources(parts), "sources")
    named = counts.join(sources.select(F.col("source").alias("s"), "number", "sources"),
                        F.col("source").eqNullSafe(F.col("s")))
    named = stored(named.drop("s"), "counts")
    at = named.select(F.col("source").alias("s"), "part", "first", "before", "size",
                      F.col("number").alias("tree"))
    found = ordered.withColumn("p", F.shiftright("place", PLACE_BITS)).join(
        at, F.col("source").eqNullSafe(F.col("s")) & (F.col("p") == F.col("part"))).select(
        "doc_id", "source", "leaf", "delivered", "tree", "size",
        (F.col("before") + F.col("place") - F.col("first")).alias("number"))
    return found, named.select("source", "number", "size", "sources").distinct()


def runs_of(digests: Column) -> Column:
    """The digests of each run of neighbours, one behind the other."""
    return F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(digests) / RUN).cast("int") - 1),
        lambda i: F.aggregate(F.slice(digests, i * RUN + 1, RUN), F.lit(b""), lambda a, x: F.concat(a, x)))


def lifted(nodes: DataFrame) -> DataFrame:
    """Up to ``LIFT`` levels on top of the nodes of trees with several: the nodes that end there, with
    the children of all inner nodes in between."""
    block = RUN ** LIFT
    found = nodes.groupBy("tree", F.floor(F.col("number") / block).alias("number")).agg(
        F.max("size").alias("size"), F.max("levels").alias("levels"),
        F.transform(F.sort_array(F.collect_list(F.struct("number", "digest"))),
                    lambda node: node["digest"]).alias("digests0"))
    empty = F.array().cast("array<binary>")
    for step in range(1, LIFT + 1):
        below, runs = F.col(f"digests{step - 1}"), f"runs{step}"
        found = found.withColumn(runs, F.when(
            F.col("size") > (RUN ** (step - 1) if step > 1 else 0), runs_of(below)).otherwise(empty))
        found = found.withColumn(f"digests{step}", F.transform(runs, inner_of))
    ends = F.coalesce(*[F.get(f"digests{step}", F.lit(0)) for step in range(LIFT, 0, -1)])
    levels = sum((F.size(f"runs{step}") > 0).cast("int") for step in range(1, LIFT + 1))
    return found.select(
        "tree", "number", F.ceil(F.col("size") / block).alias("size"), ends.alias("digest"),
        (F.col("levels") + levels).alias("levels"),
        F.concat(*[f"runs{step}" for step in range(1, LIFT + 1)]).alias("inner"))


def grown(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``tree, number, digest, size``: the roots ``tree, digest, levels``, and the ``children``
    of each inner node."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    level = nodes.withColumn("levels", F.lit(0))
    roots = level.where("size = 1").select("tree", "digest", "levels")
    children = level.limit(0).select(F.col("digest").alias("children"))
    while most > 1:
        most = -(-most // RUN ** LIFT)
        level = stored(lifted(level.where("size > 1")), "level")
        roots = roots.union(level.where("size = 1").select("tree", "digest", "levels"))
        children = children.union(level.select(F.explode("inner")))
    return roots, children


def build_manifest(docs: DataFrame, delivered: Column | None = None) -> Manifest:
    """Leaves, trees and store of ``docs``, which has the columns of ``FIELDS``.

    ``delivered`` is the text that is later held against the manifest, the text itself by default.
    Null fields are hashed as ``-``; null sources form a source of their own, the first one; null
    ids come first. Rows of equal source and id follow their leaf's digest, and repeated rows are
    leaves of their own. Extra columns are ignored. An empty table has no root.
    """
    leaves, sources = numbered_leaves(docs, F.col("text") if delivered is None else delivered)
    leaves, sources = stored(leaves, "numbered"), stored(sources, "sources")
    roots, below = grown(leaves.select("tree", "number", F.col("leaf").alias("digest"), "size"))
    sources = stored(sources.join(roots.select(
        F.col("tree").alias("number"), F.col("digest").alias("subroot"), "levels"), "number"),
        "subroots")
    top, above = grown(sources.select(
        F.lit(0).alias("tree"), "number", F.col("subroot").alias("digest"),
        F.col("sources").alias("size")))
    root = top.first()
    store = below.union(above).select(inner_of(F.col("children")).alias("digest"), "children")
    return Manifest(leaves, sources, stored(store.dropDuplicates(["digest"]), "store"),
                    bytes(root.digest) if root else None, root.levels if root else 0)


def descended(store: DataFrame, start: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``tree, number, digest, subroot, path`` of the leaves below ``start``.

    ``start`` has ``tree, levels, digest, subroot, path``: roots and the path that leads to them. Flat
    trees set out later, so that all arrive at once. ``wanted`` (``tree, number``) names the leaves to
    reach; all without.
    """
    at = None
    for level in range(start.agg(F.max("levels")).first()[0] or 0, -1, -1):
        begun = start.where(F.col("levels") == level).select(
            "tree", F.lit(0).cast("long").alias("number"), "digest", "subroot", "path")
        if at is None:
            at = begun
            continue
        at = one_down(store, at).union(begun)
        if wanted is not None:
            at = at.join(wanted.select("tree", F.expr(f"number div {RUN ** level}L").alias("number"))
                         .distinct(), ["tree", "number"], "left_semi")
        if level % LIFT == 0:
            at = stored(at, "descent")
    return at


def one_down(store: DataFrame, at: DataFrame) -> DataFrame:
    """The children of the nodes reached, each with its siblings in front of the path."""
    found = at.join(store, "digest").select(
        "tree", "number", "subroot", "path", "children", F.explode(F.sequence(
            F.lit(0), F.expr(f"cast(octet_length(children) div {WIDTH} AS int) - 1"))).alias("digit"))
    segment = F.struct(F.expr(f"substring(children, 1, {WIDTH} * digit)").alias("before"),
                       F.expr(f"substring(children, {WIDTH} * (digit + 1) + 1)").alias("behind"))
    return found.select(
        "tree", (F.col("number") * RUN + F.col("digit")).alias("number"),
        F.expr(f"substring(children, {WIDTH} * digit + 1, {WIDTH})").alias("digest"), "subroot",
        F.concat(F.array(segment), F.col("path")).alias("path"))


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``tree, number, digest, subroot, path`` per wanted leaf (``tree, number``), or per leaf.

    ``path`` has a struct of the siblings' digests ``before`` and ``behind`` per level, leaf first.
    Wanted leaves that do not exist are left out; one that is wanted twice comes once.
    """
    spark = manifest.store.sparkSession
    top = spark.range(1 if manifest.root else 0).select(
        F.lit(0).cast("long").alias("tree"), F.lit(manifest.levels).alias("levels"),
        F.lit(manifest.root).cast("binary").alias("digest"), F.lit(b"").alias("subroot"),
        F.array().cast("array<struct<before: binary, behind: binary>>").alias("path"))
    sources = None if wanted is None else wanted.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number")).distinct()
    start = descended(manifest.store, top, sources).select(
        F.col("number").alias("tree"), "digest", F.col("digest").alias("subroot"), "path").join(
        manifest.sources.select(F.col("number").alias("tree"), "levels"), "tree")
    return descended(manifest.store, stored(start, "subroots"), wanted)


def folded(leaf: Column, path: Column) -> Column:
    """The root, as hex, that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, hexed(leaf), lambda at, level: F.sha2(
        F.concat(hexed(level["before"]), at, hexed(level["behind"])), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.aggregate(path, F.lit(""), lambda text, level: F.concat(
        text, hexed(level["before"]), hexed(level["behind"]))), 256)


def audit(docs: DataFrame, delivered: Column | None = None) -> DataFrame:
    """The columns of ``AUDIT`` per row of ``docs``: its proof, and whether the delivered text leads
    to the root. Odd input is handled as in ``build_manifest``; an empty table gives an empty table.
    """
    manifest = build_manifest(docs, delivered)
    found = proofs(manifest).select(
        "tree", "number", "subroot", "path").join(manifest.leaves, ["tree", "number"])
    root = hexed(F.lit(manifest.root).cast("binary"))
    return found.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("delivered"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
