"""Byte-level BPE by DuckDB recursive queries, one connection per Python worker.

Texts are cut by the tokenizer's pattern; each distinct match is encoded once. For a batch of
matches a recursive query holds one row per (word, position, token), with the next token's
position and the rank of the pair that they make. A step contracts each word's leftmost pair of
the least rank and joins the merge table for the two pairs beside the contraction alone, as no
other pair has changed; words without a mergeable pair are done: the fixpoint. Ordered
aggregation over the positions lists the ids of a word, which decode to their bytes in order.

The merge table lists, for every token, each way to cut it into two tokens; its rank is the
token's id. That is the published rule of rank files: a pair may merge when its bytes are in
the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import byte_blocks, map_arrow, text_or_empty

ENCODE = """
WITH RECURSIVE pairs AS (
    SELECT l.w, l.pos, l.next, l.tok, r.tok AS follow, (m.rank << 32) | l.pos AS pick
    FROM letters l LEFT JOIN letters r ON r.pos = l.next
    LEFT JOIN merges m ON m.pair = ((l.tok << 17) | r.tok)),
state(w, pos, next, tok, follow, pick, done) AS (
    SELECT *, false FROM pairs
    UNION ALL
    (WITH live AS (SELECT * FROM state WHERE NOT done),
          best AS (SELECT w, min(pick) AS pick, arg_min(next, pick) AS gone
                   FROM live GROUP BY w HAVING min(pick) IS NOT NULL),
          beside AS (
              SELECT b.w, b.gone, b.pick & 4294967295 AS at, b.pick >> 32 AS rank,
                     max(CASE WHEN l.pos <> b.gone THEN l.tok END) AS before,
                     max(CASE WHEN l.pos = b.gone THEN l.next END) AS after,
                     max(CASE WHEN l.pos = b.gone THEN l.follow END) AS follow
              FROM best b JOIN live l ON l.w = b.w
               AND (l.pos = b.gone OR l.next = (b.pick & 4294967295))
              GROUP BY b.w, b.gone, b.pick),
          cut AS (
              SELECT c.*, (m.rank << 32) | c.at AS pick, o.rank << 32 AS rank_before
              FROM beside c LEFT JOIN merges m ON m.pair = ((c.rank << 17) | c.follow)
              LEFT JOIN merges o ON o.pair = ((c.before << 17) | c.rank))
     SELECT l.w, l.pos, CASE WHEN l.pos = c.at THEN c.after ELSE l.next END,
            CASE WHEN l.pos = c.at THEN c.rank ELSE l.tok END,
            CASE WHEN l.pos = c.at THEN c.follow WHEN l.next = c.at THEN c.rank
                 ELSE l.follow END,
            CASE WHEN l.pos = c.at THEN c.pick WHEN l.next = c.at THEN c.rank_before | l.pos
                 ELSE l.pick END, c.w IS NULL
     FROM live l LEFT JOIN cut c ON c.w = l.w WHERE l.pos IS DISTINCT FROM c.gone)
)
SELECT w, list(tok ORDER BY pos) AS toks FROM state WHERE done GROUP BY w
"""

_ENCODERS: dict[tuple[str, str], "DuckBpe"] = {}


class DuckBpe:
    """Encoder of one rank file. ``max_words`` bounds the dictionary of a worker."""

    def __init__(self, path: str, pattern: str, max_words: int = 1_200_000, batch: int = 30_000):
        import duckdb
        import public_tokenizers
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.cuts = pattern == public_tokenizers.PATTERN  # of another one _cut knows nothing
        self.blank_run = regex.compile(r"\s\s")
        self.segment = regex.compile(r"\s*\S+|\s+")
        self.max_words, self.batch = max_words, batch
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        if len(self.ranks) > 1 << 17:
            raise ValueError("ids must be below 2**17: a pair is one number")
        a, b, rank = (np.array(c, np.int64) for c in zip(*merges))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB",
                                         "temp_directory": ""})
        self.db.execute("SET preserve_insertion_order = false")
        self.db.register("given_merges", pa.table({"pair": (a << 17) | b, "rank": rank}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given_merges")
        spelled = {r: t for t, r in self.ranks.items()}
        every = range(max(spelled) + 1)
        self.decimal = pa.array([str(r) for r in every], pa.string())
        self.spelled = pa.array([spelled.get(r, b"") for r in every], pa.binary())
        #: Of words and of segments: decimal ids and decoded bytes.
        self.known: dict[str, tuple[str, bytes]] = {}

    def _encode_words(self, words: list[str]) -> None:
        """Learn ids (as decimal text) and decoded bytes of new words."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        i = 0
        while i < len(raw):
            # A batch has a bounded number of words, and one long word is a batch of its own:
            # its states add up to the square of its length.
            j, load = i, 0
            while j < len(raw) and j - i < self.batch and (j == i or load < 40 * self.batch):
                load += len(raw[j]) * min(len(raw[j]), 64)
                j += 1
            sizes = np.array([len(r) for r in raw[i:j]])
            total, ends = int(sizes.sum()), np.cumsum(sizes) - 1
            after = np.arange(1, total + 1)
            after[ends] = -1
            letters = pa.table({
                "w": np.repeat(np.arange(i, j), sizes), "pos": np.arange(total), "next": after,
                "tok": self.first[np.frombuffer(b"".join(raw[i:j]), np.uint8)]})
            self.db.register("letters", letters)
            got = self.db.sql(ENCODE).to_arrow_table()
            self.db.unregister("letters")
            toks = got.column("toks").combine_chunks()
            flat = toks.flatten()
            ids, raws = (pc.binary_join(pa.ListArray.from_arrays(toks.offsets, table.take(flat)),
                                        glue).to_pylist()
                         for table, glue in ((self.decimal, " "), (self.spelled, b"")))
            for w, pair in zip(got.column("w").to_pylist(), zip(ids, raws)):
                self.known[words[w]] = pair
            i = j

    def _cut(self, text: str) -> list[str]:
        """Segments of a text that begin where white space follows other signs.

        No match of the public pattern reaches over such a place, so segments are encoded
        alone; with another pattern the text is one segment.
        """
        if not self.cuts:
            return [text] if text else []
        if self.blank_run.search(text):
            return self.segment.findall(text)
        parts = text.replace("\n", " \n").split(" ")
        first = parts[:1] if parts[0] else []
        return first + [p if p[:1] == "\n" else " " + p for p in parts[1:]]

    def _learn(self, segments: set[str]) -> None:
        """Encode new segments: each is one match of the pattern or several."""
        known = self.known
        found = {s: self.pattern.findall(s) for s in segments}
        self._encode_words(sorted({w for ws in found.values() for w in ws if w not in known}))
        for s, ws in found.items():
            if len(ws) > 1:
                parts = [known[w] for w in ws]
                known[s] = (" ".join([ids for ids, _ in parts]),
                            b"".join([raw for _, raw in parts]))

    def encode(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """Per text: decimal ids joined by a space, their number, the bytes decoded from them."""
        if len(self.known) > self.max_words:  # what came first are mostly the frequent ones
            for key in list(self.known)[self.max_words // 3:]:
                del self.known[key]
        cut = [self._cut(t) for t in texts]
        pairs = [list(map(self.known.get, segs)) for segs in cut]
        late = [i for i, got in enumerate(pairs) if None in got]
        new = {s for i in late for s, got in zip(cut[i], pairs[i]) if got is None}
        if new:
            self._learn(new)
        for i in late:
            pairs[i] = list(map(self.known.__getitem__, cut[i]))
        out = []
        for got in pairs:
            spelled = " ".join([ids for ids, _ in got])
            out.append((spelled, spelled.count(" ") + 1 if spelled else 0,
                        b"".join([raw for _, raw in got])))
        return out


def duck_bpe(path: str, pattern: str) -> DuckBpe:
    """The worker's encoder for a rank file, made once and kept between tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = DuckBpe(path, pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    ``ids_sha256`` is of the decimal ids joined by one space, ``decoded_sha256`` of the bytes
    that decoding the ids gives; with ``with_ids`` the ids and the decoded text follow. Null
    texts count as empty (no tokens). Repeated rows give repeated results, an empty table an
    empty one; extra columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = duck_bpe(path, pattern)
        for b in batches:
            bodies = b.column("body").to_pylist()
            for i, j in byte_blocks(bodies, 4 << 20):
                got = bpe.encode(bodies[i:j])
                cols = [b.column("doc_id").slice(i, j - i),
                        pa.array([n for _, n, _ in got], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x, _, _ in got],
                                 pa.string()),
                        pa.array([hashlib.sha256(r).hexdigest() for _, _, r in got],
                                 pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array([[int(t) for t in x.split()] for x, _, _ in got],
                                      pa.list_(pa.int32())),
                             pa.array([r.decode("utf-8", "replace") for _, _, r in got],
                                      pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(rows, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, "
                     "decoded_sha256 string" + (", ids array<int>, decoded string"
                                                if with_ids else ""))
