"""Prefix trie of conversations in double arrays, one per prefix shard.

Equal conversations become one sequence with a count. Sequences are dealt to shards by a prefix: the
first turn or, where too many turns lie under it, the first two, four, eight and so on. A shard
numbers its distinct turns densely and packs its trie into two arrays: the child of state ``s`` by
turn ``t`` is ``BASE[s] + t``, if ``CHECK`` there says ``s``. All sequences are then walked through
the arrays at once, which gives the members of every state.

States as deep as the prefix of their shard or deeper lie in that shard alone and are final there.
The states above, the root first, are shared by shards: their parts are merged by the digest of
their path, and what lies below is added up over the ancestors of each.
"""

from __future__ import annotations

from collections.abc import Sequence
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_schema, stored

#: Turns and sequences in a shard, on average, and those that a prefix may bring along.
SHARD_TURNS = 100_000
PREFIX_TURNS = SHARD_TURNS // 8
#: The members of a sequence meet first in blocks of ids that agree but for these bits.
ID_BITS = 12
#: Free places that are tried for several children before they go behind the end.
TRIES = 64
KEY_BYTES = 16
ROOT_KEY = bytes(KEY_BYTES)
NO_ID = -1 << 63
NO_ENDS = hashlib.sha256(b"").hexdigest()

FREE, TOP = -1, -2
STATES = ("shared boolean, key binary, parent binary, above array<binary>, conv_id long, "
          "parent_conv_id long, depth long, n_convs long, last_bytes long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string")
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
         "ends_sha256")


# ------------------------------------------------------------- sequences

def short_digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, KEY_BYTES)


def sequences(conversations: DataFrame) -> DataFrame:
    """``id, turns`` per conversation: digest and text bytes of its turns in order, null first.

    Null roles and texts are empty. Equal turn numbers, repeated rows too, follow their digest. Rows
    without ``conv_id`` are one conversation, first of all. One conversation's digests meet in a task.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    key = short_digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("id"), "turn",
        key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "key", "bytes")))
    return rows.groupBy("id").agg(
        F.transform(turns, lambda t: F.struct(t["key"], t["bytes"])).alias("turns"))


def spliced(found: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """``id, turns`` with the first turns replaced by those of the conversation at the multiple of
    ``every`` below: as many as the checksum of the id says, modulo ``heads``."""
    known = F.col("id") != NO_ID
    number = F.when(known, F.col("id").cast("string")).otherwise("")
    rows = found.select(
        "id", "turns", (F.crc32(number.cast("binary")) % heads).cast("int").alias("h"),
        F.when(known, F.try_subtract("id", F.pmod("id", F.lit(every)))).alias("base"))
    starts = found.where(known & (F.pmod("id", F.lit(every)) == 0)).select(
        F.col("id").alias("base"), F.slice("turns", 1, heads - 1).alias("start"))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return rows.join(starts, "base", "left").select("id", F.concat(F.coalesce(
        F.slice("start", F.lit(1), F.col("h")), F.slice("turns", 1, 0)), own).alias("turns"))


def path_digest(turns: Column) -> Column:
    return short_digest(F.array_join(F.transform(turns, lambda t: F.hex(t["key"])), ""))


def ends_of(members: DataFrame) -> DataFrame:
    """``seq, n, low, ends``: count, smallest id and digest of the ids, ascending, of each sequence.

    Ids meet in blocks first; the blocks of a sequence then pass one task in order, which keeps
    nothing but the state of the digest.
    """
    number = lambda i: F.when(i == NO_ID, "").otherwise(i.cast("string"))
    blocks = members.groupBy("seq", F.shiftright("id", ID_BITS).alias("block")).agg(
        F.array_sort(F.collect_list("id")).alias("ids")).select(
        "seq", "block", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("low"),
        F.array_join(F.transform("ids", number), ",").alias("ids"))
    out = arrow_schema(members.sparkSession, "seq binary, n long, low long, ends string")

    def run(batches):
        seq, n, low, state = None, 0, 0, None
        for batch in batches:
            done = []
            for key, _, more, first, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != seq:
                    if seq is not None:
                        done.append((seq, n, low, state.hexdigest()))
                    seq, n, low, state = key, 0, first, hashlib.sha256()
                n += more
                state.update((ids if n == more else f",{ids}").encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)
        if seq is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((seq, n, low, state.hexdigest()), out)],
                schema=out)

    return blocks.repartition("seq").sortWithinPartitions("seq", "block").mapInArrow(
        run, "seq binary, n long, low long, ends string")


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """``turns, n_turns, n, low, ends`` per distinct sequence."""
    rows = stored(rows.withColumn("seq", path_digest(F.col("turns"))), "sequences")
    return rows.groupBy("seq").agg(F.first("turns").alias("turns")).join(
        ends_of(rows.select("seq", "id")), "seq").select(
        "turns", F.size("turns").alias("n_turns"), "n", "low", "ends")


def sharded(rows: DataFrame, shard_turns: int, prefix_turns: int) -> DataFrame:
    """The sequences with their ``shard`` and ``split``, the depth that is all its own."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.col("n_turns") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_turns))
    placed, split = None, 1
    while True:
        keyed = rows.withColumn("prefix", path_digest(F.slice("turns", 1, split)))
        crowded = stored(keyed.groupBy("prefix").agg(
            F.sum(F.col("n_turns") + 1).alias("size"), F.count(F.lit(1)).alias("several")).where(
            (F.col("size") > prefix_turns) & (F.col("several") > 1)).select("prefix"), "crowded")
        last = crowded.isEmpty()
        fit = (keyed if last else keyed.join(crowded, "prefix", "left_anti")).select(
            F.pmod(F.xxhash64("prefix"), F.lit(shards)).alias("shard"),
            F.lit(split).alias("split"), "turns", "n", "low", "ends")
        placed = fit if placed is None else placed.union(fit)
        if last:
            return placed
        rows = stored(keyed.join(crowded, "prefix", "left_semi").drop("prefix"), "crowd")
        split *= 2


# ------------------------------------------------------------- double array

class DoubleArray:
    """``base`` and ``check`` over dense turn ids; state 0 is the root."""

    def __init__(self, parents: Sequence[int], labels: Sequence[int]):
        """Edges by parent and label; edge i leads to node i + 1, parents come first."""
        base, check, place = [0], [TOP], [0] * (len(parents) + 1)
        head, at, n = 1, 0, len(parents)
        while at < n:
            parent, first = parents[at], at
            while at < n and parents[at] == parent:
                at += 1
            low, more = labels[first], [label - labels[first] for label in labels[first + 1:at]]
            spot = self._spot(check, head, more)
            need = spot + (more[-1] if more else 0) + 1
            if need > len(check):
                check.extend([FREE] * (need - len(check)))
                base.extend([0] * (need - len(base)))
            owner = place[parent]
            base[owner] = spot - low
            for node, ahead in enumerate((0, *more), first + 1):
                check[spot + ahead] = owner
                place[node] = spot + ahead
            while head < len(check) and check[head] != FREE:
                head += 1
        self.base, self.check = np.array(base, np.int64), np.array(check, np.int64)

    @staticmethod
    def _spot(check: list[int], head: int, more: list[int]) -> int:
        size = len(check)
        if not more:
            return head
        for spot in range(head, min(head + TRIES, size)):
            if check[spot] == FREE and all(
                    spot + ahead >= size or check[spot + ahead] == FREE for ahead in more):
                return spot
        return size

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The child of each state by its label; -1 where there is none."""
        found = self.base[states] + labels
        inside = (found >= 0) & (found < len(self.check))
        found = np.where(inside, found, 0)
        return np.where(inside & (self.check[found] == states), found, -1)


def edges_of(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Parent and label of each node but the root, level by level, and new numbers for the turns:
    in order of their first edge, so that the children of a node have close numbers."""
    state, nodes = np.zeros(len(starts), np.int64), 1
    width = int(ids.max()) + 1 if len(ids) else 1
    parents, labels = [], []
    active = np.flatnonzero(lengths > 0)
    depth = 0
    while len(active):
        pairs, number = np.unique(
            state[active] * width + ids[starts[active] + depth], return_inverse=True)
        parents.append(pairs // width)
        labels.append(pairs % width)
        state[active] = nodes + number
        nodes += len(pairs)
        depth += 1
        active = active[lengths[active] > depth]
    parents, labels = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, labels))
    seen, first = np.unique(labels, return_index=True)
    renamed = np.zeros(width, np.int64)
    renamed[seen[np.argsort(first)]] = np.arange(len(seen))
    labels = renamed[labels]
    # within a parent by the new numbers; where a child's own edges hang must follow
    order = np.lexsort((labels, parents))
    place = np.zeros(nodes, np.int64)
    place[order + 1] = np.arange(1, nodes)
    return place[parents[order]], labels[order], renamed


def shard_states(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """All states of one shard's trie, with what its sequences say about them."""
    turns = table.column("turns").combine_chunks()
    flat = turns.flatten()
    lengths = np.diff(turns.offsets.to_numpy()).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    keys = flat.field("key").dictionary_encode()
    sizes = flat.field("bytes").to_numpy(zero_copy_only=False)
    parents, labels, renamed = edges_of(
        keys.indices.to_numpy().astype(np.int64), starts, lengths)
    ids = renamed[keys.indices.to_numpy()] if len(keys) else np.zeros(0, np.int64)
    keys = keys.dictionary.to_pylist()
    key_of = dict(zip(renamed[:len(keys)].tolist(), keys))
    n, low, split = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "low", "split"))
    ends = table.column("ends").to_pylist()

    trie = DoubleArray(parents.tolist(), labels.tolist())
    size = len(trie.check)
    count, saved, leaves, children, last = (np.zeros(size, np.int64) for _ in range(5))
    least = np.full(size, np.iinfo(np.int64).max)
    shared, ended = np.zeros(size, bool), {}
    names: dict[int, tuple] = {0: (ROOT_KEY, None, [])}
    at, active, depth = np.zeros(len(n), np.int64), np.arange(len(n)), 0
    levels = []
    while len(active):
        state = at[active]
        np.add.at(count, state, n[active])
        np.minimum.at(least, state, low[active])
        shared[state] |= split[active] > depth
        levels.append(np.unique(state))
        for row in active[lengths[active] == depth].tolist():
            ended[int(at[row])] = ends[row]
        active = active[lengths[active] > depth]
        labels_now = ids[starts[active] + depth]
        state = at[active]
        at[active] = trie.step(state, labels_now)
        assert (at[active] >= 0).all(), "a sequence has left its trie"
        last[at[active]] = sizes[starts[active] + depth]
        below, which = np.unique(at[active], return_index=True)
        for child, i in zip(below.tolist(), which.tolist()):
            # only shared states need a name
            if split[active[i]] > depth + 1:
                key, _, above = names[int(state[i])]
                name = hashlib.sha256(key + key_of[int(labels_now[i])]).digest()[:KEY_BYTES]
                names[child] = (name, key, [*above, key])
        depth += 1
    depths = np.zeros(size, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        depths[level] = depth
        own = level[~shared[level]]
        leaves[own] += children[own] == 0
        saved[own] += (count[own] - 1) * last[own]
        if depth:
            above = trie.check[own]
            np.add.at(children, above, 1)
            np.add.at(leaves, above, leaves[own])
            np.add.at(saved, above, saved[own])
    states = np.concatenate(levels)
    above = np.maximum(trie.check[states], 0)
    hung = shared[above] | (states == 0)  # the parent's smallest id is not known here
    name = [names.get(s, (None, None, None)) if is_shared
            else (None, names[a][0], None) if under else (None, None, None)
            for s, is_shared, a, under in zip(
                states.tolist(), shared[states].tolist(), above.tolist(), hung.tolist())]
    columns = [
        shared[states], [x[0] for x in name], [x[1] for x in name], [x[2] for x in name],
        least[states], np.ma.masked_array(least[above], hung).tolist(), depths[states],
        count[states], last[states], children[states], leaves[states], saved[states],
        [ended.get(s) for s in states.tolist()]]
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# ------------------------------------------------------------- all shards

def merged(shared: DataFrame) -> DataFrame:
    """One row per shared state, with what lies below it in all shards."""
    one = stored(shared.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("above").alias("above"),
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.max("last_bytes").alias("last_bytes"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256")),
        "shared")
    kids = one.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("kids"))
    whole = one.join(kids, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    below = whole.select(
        F.explode(F.concat("above", F.array("key"))).alias("key"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("last_bytes")).alias("saved"))
    sums = below.groupBy("key").agg(F.sum("leaves").alias("n_leaves"),
                                    F.sum("saved").alias("saved_tokens"))
    return whole.drop("n_leaves", "saved_tokens").join(sums, "key")


def prefix_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS,
                prefix_turns: int = PREFIX_TURNS) -> DataFrame:
    """The columns of ``NODES`` per distinct prefix of the sequences ``id, turns``.

    The root has no parent and is left out with all else where there is no sequence. A sequence
    without turns is a member of the root. The id of rows without one is null, and smallest.
    """
    placed = sharded(stored(distinct_sequences(rows), "distinct"), shard_turns, prefix_turns)
    schema = arrow_schema(rows.sparkSession, STATES)
    states = stored(placed.groupBy("shard").applyInArrow(
        lambda table: shard_states(table, schema), STATES), "states")
    upper = stored(merged(states.where("shared")), "upper")
    parents = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("upper_conv"))
    hung = upper.select("parent", *[c for c in NODES if c != "parent_conv_id"]).union(
        states.where("NOT shared AND parent IS NOT NULL").select(
            "parent", *[c for c in NODES if c != "parent_conv_id"])).join(
        parents, "parent", "left").withColumnRenamed("upper_conv", "parent_conv_id")
    found = hung.select(*NODES).union(
        states.where("NOT shared AND parent IS NULL").select(*NODES))
    known = lambda name: F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
    return found.select(
        known("conv_id"), "depth", known("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
