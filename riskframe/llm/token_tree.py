"""Edit-aware token counts: a segment tree of pre-token runs per document.

A text is cut into leaves where white space follows other signs. No pre-token of the tokenizer's
pattern reaches over such a place, so token counts of leaves add up to the text's. Inner nodes
hold the sums of characters and tokens below them. An edit finds its leaves by character sums,
rebuilds their text, takes in a neighbour while the border between them is no longer such a
place, encodes that region alone and updates the sums on the paths to the root.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import map_arrow, text_or_empty

LEAF_CHARS = 512
_PLACE = re.compile(r"(?<=\S)(?=\s)")
_COUNTERS: dict[tuple[str, str], Callable[[str], int]] = {}


def token_counter(path: str, pattern: str) -> Callable[[str], int]:
    """Counts tokens of a text by a rank file; made once per worker."""
    if (path, pattern) not in _COUNTERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks,
                                special_tokens={})
        _COUNTERS[path, pattern] = lambda text: len(enc.encode_ordinary(text))
    return _COUNTERS[path, pattern]


def cut_leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """Leaves of at least ``size`` characters (the last may be shorter); [''] for ''."""
    out, at = [], 0
    while len(text) - at > size:
        place = _PLACE.search(text, at + size)
        if not place:
            break
        out.append(text[at:place.start()])
        at = place.start()
    return [*out, text[at:]]


class TokenTree:
    """Token counts of one text that is edited again and again."""

    def __init__(self, text: str, count: Callable[[str], int], leaf_chars: int = LEAF_CHARS):
        self.count, self.leaf_chars = count, leaf_chars
        self.encoded_chars = 0
        self._set_leaves([(leaf, self._encode(leaf)) for leaf in cut_leaves(text, leaf_chars)])

    def _encode(self, text: str) -> int:
        self.encoded_chars += len(text)
        return self.count(text) if text else 0

    def _set_leaves(self, leaves: list[tuple[str, int]]) -> None:
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.text = [t for t, _ in leaves] + [""] * (self.width - len(leaves))
        pad = [0] * (self.width - len(leaves))
        self.chars = [0] * self.width + [len(t) for t, _ in leaves] + pad
        self.tokens = [0] * self.width + [n for _, n in leaves] + pad
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def whole(self) -> str:
        return "".join(self.text)

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds character ``at`` and the place in it (the end: the last leaf's end)."""
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        i = self.width + leaf
        dc, dt = len(text) - self.chars[i], tokens - self.tokens[i]
        self.text[leaf] = text
        while i:
            self.chars[i] += dc
            self.tokens[i] += dt
            i //= 2

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters ``[start, stop)`` by ``new``; both are cut to the text's length."""
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        lo, a = self._find(start)
        hi, b = self._find(stop)
        region = self.text[lo][:a] + new + self.text[hi][b:]
        while True:  # boundary context: the region's borders must be places to cut
            left = next((i for i in range(lo - 1, -1, -1) if self.text[i]), None)
            if left is not None and (not region[:1].isspace() or self.text[left][-1:].isspace()):
                region, lo = self.text[left] + region, left
                continue
            right = next((i for i in range(hi + 1, self.width) if self.text[i]), None)
            if right is not None and (not region or region[-1:].isspace()
                                      or not self.text[right][:1].isspace()):
                region, hi = region + self.text[right], right
                continue
            break
        if len(region) > 4 * self.leaf_chars:  # grown: new leaves, the others keep their counts
            fresh = [(t, self._encode(t)) for t in cut_leaves(region, self.leaf_chars)]
            old = [(self.text[i], self.tokens[self.width + i]) for i in range(self.width)]
            self._set_leaves([x for x in [*old[:lo], *fresh, *old[hi + 1:]] if x[0]] or [("", 0)])
            return
        for leaf in range(lo + 1, hi + 1):
            if self.text[leaf]:
                self._put(leaf, "", 0)
        self._put(lo, region, self._encode(region))


def count_edits(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """Token counts of every text before and after its edits.

    ``edits_col`` holds an array of (start, stop, new) in code points, applied in order to the
    text as edited so far; null means no edits, and fields of an edit that are null mean 0, 0
    and nothing. Returns ``doc_id``, ``n_tokens``, ``edited_chars``, ``edited_tokens``,
    ``leaves``, and ``encoded_chars``: what the edits made the tokenizer read again. Null texts
    count as empty; repeated rows give repeated results, an empty table an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    edits = F.col(edits_col) if edits_col else F.lit(None)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"),
                       edits.cast("array<struct<start:bigint,stop:bigint,new:string>>")
                       .alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(path, pattern)
        for b in batches:
            out = []
            for body, todo in zip(b.column("body").to_pylist(), b.column("edits").to_pylist()):
                tree = TokenTree(body, count)
                before, tree.encoded_chars = tree.n_tokens, 0
                for e in todo or []:
                    if e:
                        tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                out.append((before, tree.n_chars, tree.n_tokens, sum(map(bool, tree.text)),
                            tree.encoded_chars))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols]],
                ["doc_id", "n_tokens", "edited_chars", "edited_tokens", "leaves",
                 "encoded_chars"])

    return map_arrow(rows, run, f"doc_id {kind}, n_tokens bigint, edited_chars bigint, "
                                "edited_tokens bigint, leaves bigint, encoded_chars bigint")
