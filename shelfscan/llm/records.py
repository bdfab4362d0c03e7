"""Token ids in length-delimited binary files with an offset index.

A file starts with ``MAGIC`` and the width of an id in bytes. A record is: payload length
(8 bytes), masked checksum of that length (4), payload, masked checksum of the payload (4), all
little-endian. The payload is a flag (1 if the document has an id), the document id (8) and the
token ids. Beside ``x.rec`` lies ``x.idx``, the offset of each record as 8 bytes, so that records
can be read in any order.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
import struct
import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_schema
from shelfscan.llm.tokens import encode_ids, tokenizer

MAGIC = b"IDS1"
END_ID = 2
WRITTEN = "part int, path string, n_records long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    """A rotated CRC-32 plus a constant, so that checksums of checksummed data stay apart."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: bytes) -> bytes:
    payload = struct.pack("<Bq", doc_id is not None, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload,
                     struct.pack("<I", masked(payload))))


def unframed(read) -> tuple[int | None, bytes] | None:
    """The next record from ``read(n)``; None at the end of the file."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    size = struct.unpack("<Q", head[:8])[0]
    payload, check = read(size), read(4)
    if len(payload) < size or len(check) < 4 or masked(payload) != struct.unpack("<I", check)[0]:
        raise ValueError("damaged record")
    known, doc_id = struct.unpack_from("<Bq", payload)
    return (doc_id if known else None), payload[9:]


def narrowed(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widened(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def write_file(path: str, records: Iterable[tuple[int | None, bytes]], width: int) -> tuple[int, int]:
    """Write a file and its index; the numbers of records and ids."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    offsets, n_ids = array("Q"), 0
    with store.open_output_stream(f"{place}.rec") as out:
        at = out.write(MAGIC + bytes([width]))
        at = len(MAGIC) + 1
        for doc_id, ids in records:
            record = framed(doc_id, narrowed(ids, width))
            out.write(record)
            offsets.append(at)
            at += len(record)
            n_ids += len(ids) // 4
    if sys.byteorder == "big":
        offsets.byteswap()
    with store.open_output_stream(f"{place}.idx") as out:
        out.write(offsets.tobytes())
    return len(offsets), n_ids


def read_file(path: str, order: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
    """Records in file order, or those at the given numbers in the given order."""
    store, place = fs.FileSystem.from_uri(path)
    if order is None:
        with store.open_input_stream(f"{place}.rec", buffer_size=1 << 20) as data:
            width = _width(data.read(len(MAGIC) + 1))
            while (record := unframed(data.read)) is not None:
                yield record[0], widened(record[1], width)
        return
    with store.open_input_file(f"{place}.idx") as index:
        offsets = np.frombuffer(index.read(), "<u8")
    with store.open_input_file(f"{place}.rec") as data:
        width = _width(data.read(len(MAGIC) + 1))
        for number in order:
            data.seek(int(offsets[number]))
            doc_id, ids = unframed(data.read)
            yield doc_id, widened(ids, width)


def _width(head: bytes) -> int:
    if head[:-1] != MAGIC or head[-1] not in (2, 4):
        raise ValueError("not a file of token ids")
    return head[-1]


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> list:
    """Write all documents in ascending ``doc_id`` order (nulls first), a file per partition.

    Returns one row per file, in order: the driver holds a line per file, never per document.
    A file's name has the attempt in it, so a task that runs again spoils nothing.
    """
    width = 2 if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    schema = arrow_schema(docs.sparkSession, WRITTEN)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:8]}"

        def records(first):
            batch = first
            while batch is not None:
                ids, texts = (column.to_pylist() for column in batch.columns)
                for doc_id, encoded in zip(ids, encode_ids(path, texts)):
                    yield doc_id, encoded + end
                batch = next(batches, None)

        first = next((b for b in batches if b.num_rows), None)
        if first is not None:
            n_records, n_ids = write_file(name, records(first), width)
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "path": [name], "n_records": [n_records], "n_ids": [n_ids]},
                schema=schema)

    ordered = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "text"))
    return sorted(ordered.mapInArrow(run, WRITTEN).collect())


def read_ids(spark: SparkSession, files: list) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every record in the files of ``write_ids``."""
    plan, start = [], 0
    for file in files:
        plan.append((file.path, start))
        start += file.n_ids
    schema = arrow_schema(spark, READ)

    def run(batches):
        for batch in batches:
            for path, at in zip(*(column.to_pylist() for column in batch.columns)):
                rows = []
                for doc_id, ids in read_file(path):
                    n = len(ids) // 4
                    rows.append((doc_id, at, n, zlib.crc32(ids)))
                    at += n
                    if len(rows) == 10_000:
                        yield _batch(rows, schema)
                        rows = []
                if rows:
                    yield _batch(rows, schema)

    listed = spark.createDataFrame(plan, "path string, start long")
    return listed.repartition(max(1, len(plan))).mapInArrow(run, READ)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)],
        schema=schema)


def token_records(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all documents and read the files back.

    Null text is an empty document: its end id alone. Null ids come first; repeated rows are
    repeated records, equal ids in order of text; extra columns are ignored; an empty table
    writes no file.
    """
    return read_ids(docs.sparkSession, write_ids(docs, path, folder, end_id))
