"""Ids of whole texts by a ``tokenizers`` file, encoded once per distinct white-space chunk.

For tokenizers that lower-case, drop white space and split letters from other signs (as the
public ``word_bpe`` file does): a text's ids are those of its white-space chunks in order. Each
Python worker keeps a bounded dictionary chunk -> ids for as long as it lives; only chunks that
it has not seen reach the library, and chunks of plain letters go straight to its BPE model.
"""

from __future__ import annotations

import os

import numpy as np

_ENCODERS: dict[tuple[str, int], "ChunkEncoder"] = {}


def _byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that byte-level tokenizers write for it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkEncoder:
    """Text -> ids as little-endian uint32 bytes. ``max_chunks`` bounds the dictionary."""

    def __init__(self, path: str, max_chunks: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_alphabet().items()})
        self.max_chunks = max_chunks
        self.known: dict[str, bytes] = {"": b""}

    @staticmethod
    def _chunks(text: str) -> list[str]:
        # Cutting at some of the white space never changes ids. Latin-1 texts may be
        # lower-cased as a whole (one character to one, no context); strings that look like
        # special tokens are matched before lower-casing, so such texts stay as they are.
        if "<|" not in text:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").replace("\t", " ").split(" ")

    def _word(self, word: str) -> bytes | None:
        """Ids of a chunk of lower-case Latin-1 letters; None for any other chunk."""
        if not word.isalpha() or word.lower() != word:
            return None
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            return None
        spelled = word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()

    def _learn(self, missing: list[str]) -> None:
        known, rest = self.known, []
        for chunk in missing:
            ids = self._word(chunk)
            if ids is None and chunk[-1] in ".," and chunk[:-1].isalpha():
                core = known.get(chunk[:-1]) or self._word(chunk[:-1])
                if core is not None:
                    ids = core + self._sign(chunk[-1])
            if ids is None:
                rest.append(chunk)
            else:
                known[chunk] = ids
        for i in range(0, len(rest), 20_000):
            part = rest[i:i + 20_000]
            for chunk, e in zip(part, self.tokenizer.encode_batch_fast(
                    part, add_special_tokens=False)):
                known[chunk] = np.array(e.ids, "<u4").tobytes()

    def _sign(self, sign: str) -> bytes:
        if sign not in self.known:
            e = self.tokenizer.encode(sign, add_special_tokens=False)
            self.known[sign] = np.array(e.ids, "<u4").tobytes()
        return self.known[sign]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text. Hand over blocks of about a million characters at a time."""
        if len(self.known) > self.max_chunks:  # what came first are mostly the frequent ones
            for chunk in list(self.known)[self.max_chunks // 3:]:
                del self.known[chunk]
        chunks = [self._chunks(t) for t in texts]
        known = self.known
        missing = {c for cs in chunks for c in cs if c not in known}
        if missing:
            self._learn(sorted(missing))
        return [b"".join([known[c] for c in cs]) for cs in chunks]


def chunk_encoder(path: str, max_chunks: int = 800_000) -> ChunkEncoder:
    """The worker's encoder for a file, made once and kept between tasks."""
    key = (path, max_chunks)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, max_chunks)
    return _ENCODERS[key]
