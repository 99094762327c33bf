import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from riskframe.llm import byte_bpe, packing, records, token_tree
from riskframe.llm.word_tokens import ChunkEncoder

from helpers import BYTE_BPE, LONG, ODD, WORD_BPE, empty_docs, odd_docs, prose


@pytest.fixture(scope="module")
def tik():
    with open(BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def hf():
    return Tokenizer.from_file(WORD_BPE)


TEXTS = [t or "" for t in ODD] + [LONG, prose(9, 50).upper(), "A.B, c.,d 'S it's", "x.", "É.", "Æ,"]


def test_chunk_encoder_equals_the_library(hf):
    for limit in (800_000, 3):  # with and without evictions
        enc = ChunkEncoder(WORD_BPE, limit)
        for t in TEXTS + TEXTS:
            assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == hf.encode(
                t, add_special_tokens=False).ids
        assert enc.encode([]) == []


def test_duck_bpe_equals_the_library_and_round_trips(tik):
    for limit in (500_000, 5):
        bpe = byte_bpe.DuckBpe(BYTE_BPE, public_tokenizers.PATTERN, limit, batch=50)
        for t, (ids, n, raw) in zip(TEXTS, bpe.encode(TEXTS)):
            want = tik.encode_ordinary(t)
            assert ids == " ".join(map(str, want)) and n == len(want)
            assert raw == t.encode()


def test_other_patterns_are_not_cut_at_white_space():
    pattern = r"\w+ \w+|\s|."
    bpe = byte_bpe.DuckBpe(BYTE_BPE, pattern)
    enc = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=bpe.ranks,
                            special_tokens={})
    for t, (ids, *_) in zip(TEXTS, bpe.encode(TEXTS)):
        assert ids == " ".join(map(str, enc.encode_ordinary(t)))


def test_encode_documents(spark, tik):
    df = odd_docs(spark, extra=True)
    src = collections.Counter((r.doc_id, r.text or "") for r in df.collect())
    got = byte_bpe.encode_documents(df, BYTE_BPE, public_tokenizers.PATTERN, with_ids=True)
    rows = got.collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in rows) == src
    for r in rows:
        assert r.ids == tik.encode_ordinary(r.decoded) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    assert byte_bpe.encode_documents(empty_docs(spark), BYTE_BPE,
                                     public_tokenizers.PATTERN).collect() == []


def test_token_tree_equals_full_counts_after_random_edits(tik):
    def count(t):
        return len(tik.encode_ordinary(t))

    rng = random.Random(5)
    junk = ["", " ", "x", "\n\n", "  a", "b  ", "'s", "é ü", "12 3", " word word", "a" * 90,
            " " * 90, "w " * 60]
    for t in [*(x or "" for x in ODD), prose(4, 600), "  \n ".join(prose(5, 80).split())]:
        tree, ref = token_tree.TokenTree(t, count, leaf_chars=rng.choice([4, 30, 512])), t
        for _ in range(10):
            a = rng.randint(0, len(ref))
            b = min(len(ref), a + rng.choice([0, 0, 1, 7, 60, 900]))
            new = rng.choice(junk)
            tree.edit(a, b, new)
            ref = ref[:a] + new + ref[b:]
            assert tree.whole() == ref and tree.n_chars == len(ref)
            assert tree.n_tokens == count(ref) == sum(tree.tokens[tree.width:])


def test_small_edit_of_a_long_text_encodes_little(tik):
    tree = token_tree.TokenTree(LONG, lambda t: len(tik.encode_ordinary(t)))
    tree.encoded_chars = 0
    tree.edit(len(LONG) // 2, len(LONG) // 2 + 3, "new words here")
    assert 0 < tree.encoded_chars < 4 * token_tree.LEAF_CHARS < len(LONG) / 100


def test_count_edits(spark, tik):
    from pyspark.sql import functions as F

    edits = "array(struct(2L as start, 4L as stop, ' new' as new), null, " \
            "struct(null as start, null as stop, null as new))"
    df = odd_docs(spark, extra=True).withColumn("edits", F.expr(edits))
    rows = token_tree.count_edits(df, BYTE_BPE, public_tokenizers.PATTERN,
                                  edits_col="edits").collect()
    want = collections.Counter()
    for r in df.collect():
        t = r.text or ""
        e = t[:2] + " new" + t[4:] if len(t) >= 2 else t + " new"
        want[r.doc_id, len(tik.encode_ordinary(t)), len(e), len(tik.encode_ordinary(e))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.edited_chars, r.edited_tokens)
                               for r in rows) == want
    assert token_tree.count_edits(empty_docs(spark), BYTE_BPE,
                                  public_tokenizers.PATTERN).collect() == []


def test_differencing_balances_and_loses_nothing():
    rng = random.Random(2)
    assert sorted(map(len, packing.difference([5, 5, 5], 5))) == [0, 0, 1, 1, 1]
    windows = packing.difference([8, 7, 6, 5, 4], 2)  # the classic example: 16 and 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in windows) == [14, 16]
    for n in (0, 1, 2, 50, 700):
        sizes = [rng.randint(1, 512) for _ in range(n)]
        windows = packing.pack_sizes(sizes, 2048)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert all(sum(sizes[i] for i in w) <= 2048 for w in windows)
        if n == 700:
            assert sum(sizes) / 2048 / len(windows) > 0.98
    with pytest.raises(ValueError):
        packing.pack_sizes([9], 8)


def test_window_count_rises_when_capacity_is_exceeded():
    assert len(packing.pack_sizes([6, 6, 6], 10)) == 3  # 18 would fit 2 windows by sum alone


def test_pack_documents(spark, hf):
    df = odd_docs(spark, extra=True)
    rows = packing.pack_documents(df, WORD_BPE, capacity=64, piece=16, batch=40,
                                  with_ids=True).collect()
    seqs, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id, r.doc_tokens].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert len(r.ids) == r.length
    for v in seqs.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 64
    want = collections.Counter()
    for r in df.collect():
        want[r.doc_id, tuple([*hf.encode(r.text or "", add_special_tokens=False).ids, 1])] += 1
    for (doc, ids), copies in want.items():
        mine = sorted(docs[doc, len(ids)], key=lambda r: r.start)
        assert sorted(x for r in mine for x in r.ids) == sorted(ids * copies)
        if copies == 1:
            assert [x for r in mine for x in r.ids] == list(ids)
    assert packing.pack_documents(empty_docs(spark), WORD_BPE).collect() == []


def test_frames_are_checked():
    data = records.frame(b"hello") + records.frame(b"")
    payload, nxt = records.read_frame(data, 0)
    assert bytes(payload) == b"hello"
    assert records.read_frame(data, nxt) == (b"", len(data))
    for i in (0, 9, 14, len(data) - 1):
        damaged = bytearray(data)
        damaged[i] ^= 1
        with pytest.raises(ValueError):
            at = 0
            while at < len(data):
                _, at = records.read_frame(bytes(damaged), at)


@pytest.mark.parametrize("wide", [False, True])
def test_record_files_round_trip(spark, hf, wide):
    df = odd_docs(spark, extra=True)
    folder = records.record_folder(df)
    manifest = records.write_records(df, folder, WORD_BPE, wide=wide, partitions=3)
    got = records.read_records(manifest, folder, wide=wide, with_ids=True).collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*hf.encode(
        r.text or "", add_special_tokens=False).ids, 1]) for r in df.collect())
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((w[1], w[2]) for w in want)


def test_record_files_of_nothing(spark):
    df = empty_docs(spark)
    folder = records.record_folder(df)
    assert records.read_records(records.write_records(df, folder, WORD_BPE), folder).collect() == []
