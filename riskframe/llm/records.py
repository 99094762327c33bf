"""Length-delimited binary records of token ids, with a separate offset index per file.

Data file: one record per document, back to back::

    uint64  n        length of the payload
    uint32  mask(n)  masked checksum of the eight length bytes
    n bytes payload  1 byte id-is-null, int64 document id, then the ids (uint16 or uint32)
    uint32  mask(payload)

Index file: one ``uint64 offset, uint64 first token`` pair per record (16 bytes), so a reader
can fetch records in any order. Numbers are little-endian. ``mask`` turns a CRC-32 to the right
by 15 bits and adds a constant, so that a checksum stored beside data is not a checksum itself.

Files are written by the tasks themselves into a folder that all executors share, under a name
of the attempt, and renamed when whole: a repeated or lost task leaves no half-written file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.tables import byte_blocks, map_arrow, shared_folder, text_or_empty, written
from riskframe.llm.word_tokens import chunk_encoder

MASK_DELTA = 0xA282EAD8  # fixed by the record format
_HEAD = struct.Struct("<QI")
_META = struct.Struct("<Bq")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked_crc(size)), payload,
                     struct.pack("<I", masked_crc(payload))))


def payload_of(doc: int | None, ids: np.ndarray, kind: str) -> bytes:
    return _META.pack(doc is None, doc or 0) + ids.astype(kind).tobytes()


def read_frame(data, at: int) -> tuple[memoryview, int]:
    """The payload of the record at ``at`` and the next record's offset; checks both sums."""
    size, check = _HEAD.unpack_from(data, at)
    if masked_crc(bytes(data[at:at + 8])) != check:
        raise ValueError(f"record at {at}: its length is damaged")
    start = at + _HEAD.size
    payload = memoryview(data)[start:start + size]
    if len(payload) < size or masked_crc(bytes(payload)) != struct.unpack_from(
            "<I", data, start + size)[0]:
        raise ValueError(f"record at {at}: its payload is damaged")
    return payload, start + size + 4


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:")
                                  else "file://" + uri)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = 1, wide: bool = False,
                  partitions: int | None = None) -> DataFrame:
    """Write ``docs`` as record files in ascending id order; returns the manifest.

    One row per file: ``part``, ``data``, ``index`` (paths), ``n_records``, ``n_tokens``. File
    order and order inside a file follow (id, text hash), null ids first. Null texts count as
    empty; every document, empty ones too, ends with ``end_id``. Repeated rows are all written;
    an id that holds many rows spreads over files, as the input position breaks ties. Extra
    columns are ignored. ``wide`` stores uint32 ids (needed from 65,536 ids on).
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_or_empty(text_col).alias("body"))
    rows = rows.withColumn("__h", F.xxhash64("body")).withColumn(
        "__pos", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "__h", "__pos")]
    ranged = (rows.repartitionByRange(partitions, *order) if partitions
              else rows.repartitionByRange(*order))
    manifest = map_arrow(ranged.sortWithinPartitions(*order).select("doc_id", "body"),
                         _writer(folder, tokenizer_path, end_id, wide),
                         "part int, data string, index string, n_records bigint, "
                         "n_tokens bigint")
    return written(manifest, "records-manifest")


def _writer(folder: str, tokenizer_path: str, end_id: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path)
        kind, end = ("<u4" if wide else "<u2"), struct.pack("<I", end_id)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name = f"{base}/part-{part:06d}"
        n, tokens, at = 0, 0, 0
        with files.open_output_stream(f"{name}.{attempt}.rec") as data, \
                files.open_output_stream(f"{name}.{attempt}.idx") as index:
            for b in batches:
                ids_col = b.column("doc_id").to_pylist()
                texts = b.column("body").to_pylist()
                for i, j in byte_blocks(texts):
                    for doc, raw in zip(ids_col[i:j], encoder.encode(texts[i:j])):
                        ids = np.frombuffer(raw + end, "<u4")
                        if not wide and len(ids) and int(ids.max()) > 0xFFFF:
                            raise ValueError("ids need wide records")
                        record = frame(payload_of(doc, ids, kind))
                        data.write(record)
                        index.write(struct.pack("<QQ", at, tokens))
                        at += len(record)
                        tokens += len(ids)
                        n += 1
        if not n:
            files.delete_file(f"{name}.{attempt}.rec")
            files.delete_file(f"{name}.{attempt}.idx")
            return
        # The content does not depend on the attempt: replacing a finished file is harmless.
        files.move(f"{name}.{attempt}.rec", f"{name}.rec")
        files.move(f"{name}.{attempt}.idx", f"{name}.idx")
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "data": f"{name}.rec", "index": f"{name}.idx", "n_records": n,
              "n_tokens": tokens}],
            pa.schema([("part", pa.int32()), ("data", pa.string()), ("index", pa.string()),
                       ("n_records", pa.int64()), ("n_tokens", pa.int64())]))

    return run


def read_records(manifest: DataFrame, folder: str, wide: bool = False,
                 with_ids: bool = False) -> DataFrame:
    """Read the files of a manifest through their indexes, checking every checksum.

    One row per record: ``doc_id``, ``start`` (ids of all earlier documents), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian uint32), and with ``with_ids`` the ids. Each file
    is one task's work; file starts are running sums over the manifest (a row per file).
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "data", "index", "n_records",
                            F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    # One file, one task: a range exchange on the file number, not a hash that may collide.
    n_files = max(1, manifest.count())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_arrow(files.repartitionByRange(n_files, "part"), _reader(folder, wide, with_ids),
                     schema + (", ids array<int>" if with_ids else ""))


def _reader(folder: str, wide: bool, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _filesystem(folder)
        kind = "<u4" if wide else "<u2"
        for b in batches:
            for f in b.to_pylist():
                with files.open_input_stream(f["index"]) as s:
                    index = np.frombuffer(s.read(), "<u8").reshape(-1, 2)
                if len(index) != f["n_records"]:
                    raise ValueError(f"{f['index']}: {len(index)} of {f['n_records']} entries")
                with files.open_input_file(f["data"]) as data:
                    size = data.size()
                    for i in range(0, len(index), 512):
                        part = index[i:i + 512]
                        lo = int(part[0, 0])
                        hi = int(index[i + 512, 0]) if i + 512 < len(index) else size
                        yield _records(data.read_at(hi - lo, lo), part, lo, f["first"], kind,
                                       with_ids)

    return run


def _records(block: bytes, part: np.ndarray, lo: int, first: int, kind: str, with_ids: bool):
    docs, starts, sizes, sums, all_ids = [], [], [], [], []
    for at, start in part.tolist():
        payload, _ = read_frame(block, at - lo)
        null, doc = _META.unpack_from(payload)
        ids = np.frombuffer(payload, kind, offset=_META.size)
        docs.append(None if null else doc)
        starts.append(first + start)
        sizes.append(len(ids))
        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
        if with_ids:
            all_ids.append(ids.astype(np.int32))
    cols = [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
            pa.array(sums, pa.int64())]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        cols.append(pa.array(all_ids, pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(cols, names)


def record_folder(docs: DataFrame) -> str:
    """A new folder for record files below the shared checkpoint folder."""
    return shared_folder(docs.sparkSession, "records")
