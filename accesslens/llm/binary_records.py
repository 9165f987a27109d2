"""Token ids as length-delimited binary records, with an index of their offsets.

A record is framed as length (8 bytes), masked checksum of the length (4), payload,
masked checksum of the payload (4), all little-endian; checksums are CRC-32C. So a
reader of such records in any language finds them. The payload is the document's id
(8 bytes), the width of its token ids (1), whether its id is null (1), and the ids.

A folder holds ``part-N.rec`` and ``part-N.idx``, where N follows the order of the
documents; the index has three 8-byte numbers for each record: where it starts, its
length with the frame, and the number of ids. ``manifest`` (Parquet) names the parts
that count: a part that a lost task left behind is in no manifest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accesslens.llm import tokens
from accesslens.llm.checksums import crc32c, masked

HEAD = np.dtype([("length", "<u8"), ("check", "<u4")])
TAIL = 4
PAYLOAD_HEAD = 10
READ = 8 << 20  # bytes read from a part at once

MANIFEST = (
    "part bigint, data string, offsets string, n_records bigint, n_tokens bigint, "
    "n_bytes bigint"
)
RECORDS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path: local, or any that Arrow reads by its scheme."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its length and checksums."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads = masked(crc32c(lengths)).astype("<u4")
    tails = masked(crc32c(payloads)).astype("<u4")
    return [
        length + head.tobytes() + payload + tail.tobytes()
        for length, head, payload, tail in zip(
            lengths, heads, payloads, tails, strict=True
        )
    ]


def unframe(data: bytes, starts: list[int]) -> list[bytes]:
    """Payloads of the records that start there; fails on a wrong checksum."""
    lengths, heads, payloads, tails = [], [], [], []
    for start in starts:
        length = int.from_bytes(data[start : start + 8], "little")
        body = start + HEAD.itemsize
        lengths.append(data[start : start + 8])
        heads.append(data[start + 8 : body])
        payloads.append(data[body : body + length])
        tails.append(data[body + length : body + length + TAIL])
    for checked, found in ((lengths, heads), (payloads, tails)):
        if masked(crc32c(checked)).astype("<u4").tobytes() != b"".join(found):
            raise ValueError("a record's checksum is wrong")
    return payloads


def _payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    known = doc_id is not None
    head = (doc_id if known else 0).to_bytes(8, "little", signed=True)
    return head + bytes((width, not known)) + ids


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    doc_id = int.from_bytes(payload[:8], "little", signed=True)
    ids = np.frombuffer(payload, f"<u{payload[8]}", offset=PAYLOAD_HEAD)
    return (None if payload[9] else doc_id), ids


def write_records(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    chunks: str = "spaced",
    end_id: int | None = None,
    width: int = 2,
) -> None:
    """Encodes every text and writes the records in ascending order of doc_id.

    ``width`` is the number of bytes of an id. A null text is empty and has only the
    end id; rows with a null doc_id come first; rows with equal ids are ordered by
    text, and equal rows give equal records. No row is left out. Extra columns are
    not read. An empty table gives an empty manifest.

    Documents are dealt out by ranges of their ids; a task encodes its range batch by
    batch and moves its files into place when they are whole, so that a repeated task
    replaces them by the same bytes.
    """
    end = b"" if end_id is None else end_id.to_bytes(width, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = _open(folder)
        name, attempt = f"{root}/part-{part:08d}", uuid.uuid4().hex
        encoder, index, n_tokens, written, out = None, [], 0, 0, None
        for batch in batches:
            if encoder is None:
                encoder = tokens.encoder(vocabulary, chunks, width)
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{name}.rec-{attempt}")
            doc_ids = batch.column(0).to_pylist()
            for first, group in tokens.groups(batch.column(1)):
                encoded = [ids + end for ids in encoder.encode(group)]
                at = zip(doc_ids[first : first + len(group)], encoded, strict=True)
                records = frame([_payload(d, ids, width) for d, ids in at])
                for ids, record in zip(encoded, records, strict=True):
                    index.append((written, len(record), len(ids) // width))
                    written += len(record)
                    n_tokens += len(ids) // width
                out.write(b"".join(records))
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{name}.idx-{attempt}") as offsets:
            offsets.write(np.array(index, "<i8").tobytes())
        for suffix in ("rec", "idx"):
            system.move(f"{name}.{suffix}-{attempt}", f"{name}.{suffix}")
        paths = [f"{folder}/part-{part:08d}.{suffix}" for suffix in ("rec", "idx")]
        row = [part, *paths, len(index), n_tokens, written]
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_pydict(
            {name: [value] for name, value in zip(names, row, strict=True)}
        )

    ordered = (
        documents.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of a folder, each with the number of ids before it as ``start``.

    A row for each part: the running sum is over files, not over records.
    """
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return parts.withColumn("start", start)


def _index(path: str) -> np.ndarray:
    system, name = _open(path)
    with system.open_input_stream(name) as file:
        return np.frombuffer(file.read(), "<i8").reshape(-1, 3)


def _dealt(parts: DataFrame, columns: list[str]) -> DataFrame:
    # the manifest is small: without a number, Spark would read all parts in one task
    n = max(1, min(parts.count(), 100_000))
    return parts.select(*columns).repartition(n)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: doc_id, start, n_tokens, ids_crc32; checks each record.

    ``start`` counts the ids of all records before it. The checksum is the plain CRC-32
    of the ids as unsigned 32-bit little-endian numbers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                yield from read_part(part["data"], part["offsets"], part["start"])

    def read_part(data: str, offsets: str, start: int) -> Iterator[pa.RecordBatch]:
        index = _index(offsets)
        system, name = _open(data)
        with system.open_input_file(name) as file:
            first = 0
            while first < len(index):
                base = int(index[first, 0])
                last = np.searchsorted(index[:, 0], base + READ, side="left")
                last = max(first + 1, int(last))
                size = int(index[last - 1, :2].sum()) - base
                file.seek(base)
                held = file.read(size)
                starts = (index[first:last, 0] - base).tolist()
                columns: dict[str, list] = {c.split()[0]: [] for c in RECORDS.split(", ")}
                for payload in unframe(held, starts):
                    doc_id, ids = parse(payload)
                    columns["doc_id"].append(doc_id)
                    columns["start"].append(start)
                    columns["n_tokens"].append(len(ids))
                    columns["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                yield pa.RecordBatch.from_pydict(
                    columns, schema=pa.schema([(c, pa.int64()) for c in columns])
                )
                first = last

    parts = _dealt(manifest(spark, folder), ["data", "offsets", "start"])
    return parts.mapInArrow(read, RECORDS)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """Documents' token ids (doc_id, ids) in a random order that the seed fixes.

    Only the index is shuffled; each task seeks the records it was dealt.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                index = _index(part["offsets"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "data": pa.array([part["data"]] * len(index), pa.string()),
                        "at": index[:, 0],
                        "size": index[:, 1],
                    }
                )

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, pa.NativeFile] = {}
        for batch in batches:
            doc_ids, ids = [], []
            for entry in batch.to_pylist():
                if entry["data"] not in files:
                    if len(files) >= 64:
                        files.popitem()[1].close()
                    system, name = _open(entry["data"])
                    files[entry["data"]] = system.open_input_file(name)
                file = files[entry["data"]]
                file.seek(entry["at"])
                doc_id, found = parse(unframe(file.read(entry["size"]), [0])[0])
                doc_ids.append(doc_id)
                ids.append(found.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "ids": pa.array(ids, pa.list_(pa.int32())),
                }
            )

    parts = _dealt(manifest(spark, folder), ["data", "offsets"])
    index = parts.mapInArrow(entries, "data string, at bigint, size bigint")
    place = F.xxhash64(F.lit(seed), F.regexp_extract("data", r"part-\d+", 0), "at")
    dealt = index.withColumn("place", place).repartitionByRange("place")
    dealt = dealt.sortWithinPartitions("place").select("data", "at", "size")
    return dealt.mapInArrow(seek, "doc_id bigint, ids array<int>")
