"""Removal of repeated substrings by suffix sorting.

Every window of ``LENGTH`` bytes is named by the smallest hash of ``GRAM`` bytes in it, its anchor.
Equal windows have equal anchors at equal places, so windows can be looked at anchor by anchor: a
member is an anchor with the stretch of neighbouring windows it names. Anchors seen once are done,
and so are members with equal stretches. What is left under an anchor is sorted: suffixes from the
anchor on by hashed comparison, and neighbours in that order are compared to the left of the
anchor, as far as their agreement on the right can make a window. Agreements are verified on the
bytes.

An anchor with more than ``GROUP`` different stretches is not gathered in one task. It is split by
further bytes: its windows are halved by how far they begin before the anchor, and the members of
each half are parted by the bytes that all its windows hold. Members that say the same about a half
count as one. What is still too large is split again; a half of one window has one member.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import xxhash

from shelfscan.llm.common import arrow_pass, arrow_schema, stored
from shelfscan.llm.simhash import groups_in
from shelfscan.llm.suffixes import Hashed, merge_sort

LENGTH = 400
GRAM = 64
GROUP = 1024
#: A window begins at most this far before its anchor.
MOST_LEAD = LENGTH - GRAM
#: Window starts of a text that are worked on at once.
CHUNK = 1 << 20

_PLACE_BITS = 24
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)

MEMBERS = "array<struct<start: long, lead: int, size: int, gram: long, stretch: long>>"
FOUND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by minima up to and from block borders."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n - width + 1], up[width - 1:n])


def members_of(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """(start, lead, size, gram, stretch) of each run of windows with one anchor.

    The run's windows start at start .. start + size - 1, the anchor lies ``lead`` bytes after
    start, ``gram`` is its hash and ``stretch`` that of all bytes of the windows.
    """
    found = []
    for base in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        part = data[base:base + CHUNK + LENGTH - 1]
        grams = gram_hashes(np.frombuffer(part, np.uint8))
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchor = (window_minima(keys, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        size = np.diff(np.append(first, len(anchor)))
        gram = grams[anchor[first]].view(np.int64).tolist()
        lead = (anchor[first] - first).tolist()
        for at, ahead, n, key in zip(first.tolist(), lead, size.tolist(), gram):
            digest = xxhash.xxh3_64_intdigest(part[at:at + n - 1 + LENGTH])
            found.append((base + at, ahead, n, key, digest - (1 << 63)))
    return found


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hashes of all ``GRAM`` bytes in a row."""
    hashed = Hashed(data)
    n = len(data) - GRAM + 1
    grams = (hashed.sums[GRAM:] - hashed.sums[:n]) * hashed.down[:n]
    grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return grams ^ (grams >> np.uint64(32))


def repeated_starts(stretches: list[bytes], lead: np.ndarray, size: np.ndarray,
                    group: np.ndarray) -> list[tuple[int, int, int]]:
    """(member, first, last): window starts, counted from the member's first, that are repeated
    in another member of its group. Groups lie together; stretches of a group differ."""
    buffer = b"".join(stretches)
    data = np.frombuffer(buffer, np.uint8)
    length = np.array([len(s) for s in stretches], dtype=np.int64)
    end = np.cumsum(length)
    anchor = end - length + lead
    hashed = Hashed(data)
    order = merge_sort(data, hashed, anchor, end, group)
    anchor, end, lead, size, group = (x[order] for x in (anchor, end, lead, size, group))
    reach = end - anchor
    most_lead = np.maximum.reduceat(lead, np.searchsorted(group, np.unique(group))) if len(lead) \
        else lead
    _, number = np.unique(group, return_inverse=True)
    need = LENGTH - most_lead[number]
    found = []
    # right agreement of ranks i and i + step, which can only shrink as the step grows
    i = np.flatnonzero(group[1:] == group[:-1])
    step, right = 1, None
    adjacent = np.zeros(len(group), dtype=np.int64)
    # longest left agreement found with a later and with an earlier rank
    longest = np.full((2, len(group)), -1, dtype=np.int64)
    while len(i):
        j = i + step
        if step == 1:
            adjacent[i] = hashed.agree_right(anchor[i], anchor[j], np.minimum(reach[i], reach[j]))
            right = adjacent[i]
        else:
            right = np.minimum(right, adjacent[j - 1])
        wide = right >= need[i]
        i, right = i[wide], right[wide]
        j = i + step
        # a farther neighbour agrees less on the right: it only counts where the left is longer
        useful = np.flatnonzero((longest[0][i] < lead[i]) | (longest[1][j] < lead[j]))
        a, b, y = i[useful], j[useful], right[useful]
        x = hashed.agree_left(anchor[a], anchor[b], np.minimum(lead[a], lead[b]))
        hit = (x + y >= LENGTH) & ((x > longest[0][a]) | (x > longest[1][b]))
        a, b, x, y = a[hit], b[hit], x[hit], y[hit]
        longest[0][a] = np.maximum(longest[0][a], x)
        longest[1][b] = np.maximum(longest[1][b], x)
        for a, b, x, y in zip(*(v.tolist() for v in (a, b, x, y))):
            x, y = verified(buffer, int(anchor[a]), int(anchor[b]), x, y)
            for member in (a, b):
                low = max(int(lead[member]) - x, 0)
                high = min(int(lead[member]) - (LENGTH - y), int(size[member]) - 1)
                if low <= high:
                    found.append((int(order[member]), low, high))
        step += 1
        keep = (i + step < len(group))
        i, right = i[keep], right[keep]
        keep = group[i + step] == group[i]
        i, right = i[keep], right[keep]
    return found


def verified(buffer: bytes, a: int, b: int, left: int, right: int) -> tuple[int, int]:
    """The agreement around a and b, counted byte by byte where the hashes were wrong."""
    if buffer[a - left:a + right] == buffer[b - left:b + right]:
        return left, right
    ahead = next((n for n in range(right) if buffer[a + n] != buffer[b + n]), right)
    back = next((n for n in range(left) if buffer[a - n - 1] != buffer[b - n - 1]), left)
    return back, ahead


def all_members(docs: DataFrame) -> DataFrame:
    """``doc_id, h, start, lead, size, gram, stretch`` of all texts, written once."""

    def make():
        def step(columns):
            ids, hashes, texts = columns
            found = [[dict(zip(("start", "lead", "size", "gram", "stretch"), m))
                      for m in members_of(text.encode())] if text else [] for text in texts]
            return [ids, hashes, found]

        return step

    rows = arrow_pass(docs.select("doc_id", "h", "text"),
                      f"doc_id long, h long, members {MEMBERS}", make)
    return stored(rows.where(F.size("members") > 0), "members").select(
        "doc_id", "h", F.explode("members").alias("m")).select("doc_id", "h", "m.*")


def stretches_of(members: DataFrame, docs: DataFrame) -> DataFrame:
    """``gram, stretch, lead, size, data`` for one occurrence of each of the members."""
    wanted = members.groupBy("at.doc_id", "at.h").agg(F.collect_list(F.struct(
        "gram", "stretch", "lead", "size", "at.start", "large")).alias("members"))
    rows = docs.select("doc_id", "h", "text").join(wanted.select(
        F.col("doc_id").alias("d"), F.col("h").alias("g"), "members"),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")))

    def make():
        def step(columns):
            out = []
            for text, members in zip(*columns):
                data = text.encode()
                out.extend((m["gram"], m["stretch"], m["lead"], m["size"], m["large"],
                            data[m["start"]:m["start"] + m["size"] - 1 + LENGTH])
                           for m in members)
            return list(zip(*out)) if out else [[]] * 6

        return step

    return arrow_pass(rows.select("text", "members"),
                      "gram long, stretch long, lead int, size int, large boolean, data binary",
                      make)


SORTED = "node long, content long, first int, last int"
PIECES = ("node long, content long, gram long, stretch long, shift int, lead int, size int, low int, "
          "high int, data binary")


def sorted_starts(rows: DataFrame) -> DataFrame:
    """``node, content, first, last`` from sorting the suffixes of each node's members."""
    schema = arrow_schema(rows.sparkSession, SORTED)

    def run(batches):
        for table in groups_in(batches, ["node"], 4000):
            node, content = table.column("node").to_numpy(), table.column("content").to_numpy()
            new = np.concatenate(([True], (node[1:] != node[:-1]) | (content[1:] != content[:-1])))
            table = table.filter(pa.array(new))  # repeated rows of a document
            node, content = node[new], content[new]
            found = repeated_starts(
                table.column("data").to_pylist(),
                table.column("lead").to_numpy().astype(np.int64),
                table.column("size").to_numpy().astype(np.int64), node)
            if found:
                member, first, last = (np.array(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [node[member], content[member], first.astype(np.int32),
                     last.astype(np.int32)], schema=schema)

    return (rows.select("node", "content", "lead", "size", "data").repartition("node")
            .sortWithinPartitions("node", "content").mapInArrow(run, SORTED).distinct())


def halves_of(gram: int, stretch: int, shift: int, lead: int, size: int, low: int, high: int,
              data: bytes) -> list[tuple]:
    """A member of the windows that begin ``low`` to ``high - 1`` bytes before the anchor, as up to
    two members of half of these windows each."""
    found, middle = [], (low + high + 1) // 2
    for a, b in ((low, middle), (middle, high)):
        least, most = max(a, lead - size + 1), min(b - 1, lead)
        if least > most:
            continue
        part = data[lead - most:lead - least + LENGTH]
        common = data[lead - a:lead + LENGTH - b + 1]
        node = xxhash.xxh3_64_intdigest(common, seed=a * LENGTH + b) ^ (gram & (1 << 64) - 1)
        content = xxhash.xxh3_64_intdigest(part, seed=most * LENGTH + least)
        found.append((node - (1 << 63), content - (1 << 63), gram, stretch, shift + lead - most,
                      most, most - least + 1, a, b, part))
    return found


def split_starts(rows: DataFrame) -> DataFrame:
    """``gram, stretch, first, last`` of the members of large anchors, half by half."""

    def make():
        def step(columns):
            out = [half for row in zip(*columns) for half in halves_of(*row)]
            return list(zip(*out)) if out else [[]] * 10

        return step

    found = rows.limit(0).select("gram", "stretch", F.col("shift").alias("first"),
                                 F.col("shift").alias("last"))
    both = ["node", "content"]
    while not rows.isEmpty():
        halves = stored(arrow_pass(
            rows.select("gram", "stretch", "shift", "lead", "size", "low", "high", "data"),
            PIECES, make), "halves")
        kinds = stored(halves.groupBy(*both).agg(F.count(F.lit(1)).alias("n")), "kinds")
        places = halves.drop("data")
        whole = places.join(kinds.where("n > 1"), both).select(
            "gram", "stretch", F.col("shift").alias("first"),
            (F.col("shift") + F.col("size") - 1).alias("last"))
        nodes = kinds.groupBy("node").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        several = halves.dropDuplicates(both).join(nodes, "node")
        solved = sorted_starts(several.where(F.col("kinds") <= GROUP)).join(places, both).select(
            "gram", "stretch", (F.col("first") + F.col("shift")).alias("first"),
            (F.col("last") + F.col("shift")).alias("last"))
        found = found.union(stored(whole.union(solved), "solved"))
        rows = stored(several.where(F.col("kinds") > GROUP), "crowded")
    return found


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, h, spans``: byte spans of repeated windows per document that has some.

    ``docs`` has ``doc_id, h, text``; rows of equal ``doc_id`` and ``h`` are repeated rows.
    """
    members = all_members(docs)
    # an anchor seen once has no repeats; one with one stretch only has nothing to sort
    anchors = members.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high"))
    anchors = stored(anchors.where("n > 1").select(
        "gram", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
    seen = stored(members.join(anchors, "gram"), "seen")
    mixed = seen.where("mixed").groupBy("gram", "stretch").agg(
        F.count("*").alias("n"), F.first("lead").alias("lead"), F.first("size").alias("size"),
        F.min(F.struct("doc_id", "h", "start")).alias("at"))
    mixed = stored(mixed, "mixed")
    large = mixed.groupBy("gram").agg((F.count("*") > GROUP).alias("large"))
    data = stored(stretches_of(mixed.join(large, "gram"), docs), "stretches")
    whole = mixed.where("n > 1").select(
        "gram", "stretch", F.lit(0).alias("first"), (F.col("size") - 1).alias("last"))
    solved = whole.union(sorted_starts(data.where("NOT large").select(
        F.col("gram").alias("node"), F.col("stretch").alias("content"), "lead", "size", "data"))).union(
        split_starts(data.where("large").dropDuplicates(["gram", "stretch"]).withColumns(
            {"shift": F.lit(0), "low": F.lit(0), "high": F.lit(MOST_LEAD + 1)})))
    spans = seen.where("NOT mixed").select(
        "doc_id", "h", "start", (F.col("start") + F.col("size") - 1 + LENGTH).alias("end")).union(
        seen.where("mixed").join(solved, ["gram", "stretch"]).select(
            "doc_id", "h", (F.col("start") + F.col("first")).alias("start"),
            (F.col("start") + F.col("last") + LENGTH).alias("end")))
    return spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the bytes of the spans."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def with_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` per row of ``docs``; spans are null where nothing is repeated."""
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
    spans = repeated_spans(docs).select(
        F.col("doc_id").alias("d"), F.col("h").alias("g"), "spans")
    return docs.join(
        spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left").select(
        "doc_id", "text", "spans")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` per row of ``docs``.

    Bytes covered by a string of ``LENGTH`` bytes that starts anywhere else too are removed; what
    is kept is joined as bytes. Null text counts as empty; texts shorter than ``LENGTH`` stay
    whole; null ids are like any other; a repeated row repeats all its strings; extra columns are
    ignored; an empty table gives an empty table.
    """

    def make():
        def step(columns):
            out = []
            for doc_id, text, spans in zip(*columns):
                data = (text or "").encode()
                runs = merged([(s["start"], s["end"]) for s in spans or ()])
                borders = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2]))
                out.append((doc_id, len(data), len(data) - len(kept), len(runs),
                            hashlib.sha256(kept).hexdigest(), kept))
            return list(zip(*out)) if out else [[]] * 6

        return step

    return arrow_pass(with_spans(docs), FOUND + ", kept binary", make)
