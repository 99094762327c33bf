"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are cut into pieces of at most ``piece`` tokens (whole windows first), and batches of
pieces are dealt into k windows by the largest differencing method: every piece starts as a
partial partition of k windows; the two partial partitions with the largest imbalance are merged
with opposing order, fullest window to emptiest, until one is left. Its windows are nearly
equal, so k begins at the least number that could hold the batch and rises whenever the fullest
window exceeds the capacity.

Batches are runs of the input inside a task: no shuffle, bounded memory, and a skewed key makes
no difference. A window's tokens stay below the capacity by far less than a percent on average.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import byte_blocks, map_arrow, text_or_empty
from riskframe.llm.word_tokens import chunk_encoder


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deal items of the given sizes into k windows by multiway differencing.

    Returns the item numbers of each window. Ties between imbalances fall to the partial
    partition made first, so the result is a function of the sizes alone.
    """
    if k <= 1:
        return [list(range(len(sizes)))]
    # A partial partition: window sums, largest first, less the smallest one (differences are
    # all that matters), and the window's node. Nodes form a tree of merged windows.
    left, right, heap = [-1] * len(sizes), [-1] * len(sizes), []
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    for rank, i in enumerate(order):
        heap.append((-sizes[i], rank, np.array([sizes[i]]), np.array([i])))
    heapq.heapify(heap)  # a single item holds one window; the others, empty, are implied
    made = len(heap)
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        if len(a) + len(b) <= k:  # opposing order lets no two filled windows meet
            sums, nodes = np.concatenate((a, b)), np.concatenate((an, bn))
        else:
            n = max(len(a), len(b), min(k, len(a) + len(b)))
            sums, nodes = np.zeros(n, a.dtype), np.full(n, -1)
            sums[:len(a)], nodes[:len(a)] = a, an
            met = nodes[n - len(b):]
            other = bn[::-1]
            sums[n - len(b):] += b[::-1]
            both = np.flatnonzero((met >= 0) & (other >= 0))
            fresh = len(left) + np.arange(len(both))
            left.extend(met[both].tolist())
            right.extend(other[both].tolist())
            joined = np.where(met >= 0, met, other)
            joined[both] = fresh
            nodes[n - len(b):] = joined
        by_size = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by_size], nodes[by_size]
        if len(sums) == k:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), made, sums, nodes))
        made += 1
    out: list[list[int]] = []
    for node in heap[0][3].tolist() if heap else []:
        items, todo = [], [node]
        while todo:
            x = todo.pop()
            if x < 0:
                continue
            if left[x] < 0:
                items.append(x)
            else:
                todo += (right[x], left[x])
        out.append(items)
    return out + [[] for _ in range(k - len(out))]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of item numbers, none above ``capacity``; the window count rises until all fit."""
    if any(s > capacity for s in sizes):
        raise ValueError("an item exceeds the capacity")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if max((sum(sizes[i] for i in w) for w in windows), default=0) <= capacity:
            return [w for w in windows if w]
        k += max(1, k // 200)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, piece: int = 512,
                   batch: int = 2048, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in it, window (``sequence_id``) and offset there.

    Null texts count as empty; every document, empty ones too, ends with ``end_id``, so each has
    at least one piece. Whole windows are cut off a long document first and fill a sequence each;
    the rest is cut into pieces of at most ``piece`` tokens, which are packed in batches of
    ``batch``. ``sequence_id`` is the task's number times 2**33 plus a running number. With
    ``with_ids`` the piece's ids follow. Repeated rows are packed each for itself; an empty
    table gives no pieces; extra columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint" + (", ids array<int>" if with_ids else ""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))
    return map_arrow(rows, _packer(tokenizer_path, capacity, piece, batch, end_id, with_ids),
                     schema)


def _packer(tokenizer_path: str, capacity: int, piece: int, batch: int, end_id: int,
            with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path)
        end = int(end_id).to_bytes(4, "little")
        base = TaskContext.get().partitionId() << 33
        loose: list[tuple] = []
        id_type = None

        def place(rows: list[tuple], windows: list[list[int]]) -> pa.RecordBatch:
            nonlocal base
            out = []
            for w in windows:
                offset = 0
                for i in w:
                    out.append((*rows[i][:5], base, offset, rows[i][5]))
                    offset += rows[i][2]
                base += 1
            cols = list(zip(*out))
            arrays = [pa.array(cols[0], id_type)] + [pa.array(c, pa.int64()) for c in cols[1:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                     "offset"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32)
                                        for x in cols[7]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            id_type = b.column("doc_id").type
            docs, texts = b.column("doc_id").to_pylist(), b.column("body").to_pylist()
            for i, j in byte_blocks(texts):
                whole = []
                for doc, raw in zip(docs[i:j], encoder.encode(texts[i:j])):
                    raw += end
                    n = len(raw) // 4
                    at = 0
                    while at < n:
                        size = capacity if n - at >= capacity else min(piece, n - at)
                        ids = raw[4 * at:4 * (at + size)]
                        row = (doc, at, size, zlib.crc32(ids), n, ids if with_ids else None)
                        (whole if size == capacity else loose).append(row)
                        at += size
                if whole:
                    yield place(whole, [[x] for x in range(len(whole))])
                while len(loose) >= batch:
                    part, loose = loose[:batch], loose[batch:]
                    yield place(part, pack_sizes([r[2] for r in part], capacity))
        if loose:
            yield place(loose, pack_sizes([r[2] for r in loose], capacity))

    return run
