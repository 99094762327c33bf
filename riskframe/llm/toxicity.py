"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and their beginnings, hashed into ``2**bits`` buckets; a term's
value grows with the logarithm of its count, and a text's values have unit length. The machine
scores ``b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``: the factors ``v`` let two terms that
are harmless alone (an insult's word, the mention of a group) weigh when they meet, which a sum
of weights cannot express. Values of a text of hundreds of terms are some hundredths, so the
factors start at ``START`` and step and shrink faster than the weights; terms that the fit never
saw have none. A fifth of the sample is kept from the fit and calibrates the scores (Platt
scaling), so a score is a probability and a threshold means the same at any size.

The model is fitted on a bounded sample of labelled rows (``sample_rows``, those with the
smallest hash of the id) and sent to the executors; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskframe.llm.tables import byte_blocks, map_arrow, short_batches, text_or_empty
from riskframe.llm.words import Words, counted, mix

BITS = 18
PREFIXES = (4, 6)  # bytes of a word's beginning
BLOCK_CHARS = 1 << 18  # a block's numbers take some sixty bytes a character
START = 0.3  # standard deviation of the factors before the fit


def terms(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value) of every term, ascending; values of a text have length 1."""
    w = Words(texts)
    docs, hashes = [w.doc], [w.hash]
    for k, n in enumerate(PREFIXES):
        d, h = w.prefixes(n)
        docs.append(d)
        hashes.append(mix(h + np.uint64(k + 1)))
    doc, bucket = np.concatenate(docs), np.concatenate(hashes) >> np.uint64(64 - bits)
    key = np.sort((doc.astype(np.uint64) << np.uint64(bits)) | bucket)
    doc, bucket, n = counted((key >> np.uint64(bits)).astype(np.int64),
                             (key & np.uint64((1 << bits) - 1)).astype(np.int64))
    x = 1.0 + np.log(n)
    norm = np.sqrt(np.bincount(doc, x * x, minlength=len(texts)))
    return doc, bucket, (x / norm[doc]).astype(np.float32)


@dataclass
class FactorizationMachine:
    """Weights of the machine; ``score`` gives probabilities for rows of terms."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, doc: np.ndarray, bucket: np.ndarray, x: np.ndarray,
               n_docs: int) -> np.ndarray:
        out = self.bias + np.bincount(doc, self.weight[bucket] * x, minlength=n_docs)
        for f in range(self.factor.shape[1]):
            vx = self.factor[bucket, f] * x
            out += 0.5 * (np.bincount(doc, vx, minlength=n_docs) ** 2
                          - np.bincount(doc, vx * vx, minlength=n_docs))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 per text; a text without terms gets the bias alone."""
        bits = int(len(self.weight)).bit_length() - 1
        return _sigmoid(self.slope * self.margin(*terms(texts, bits), len(texts)) + self.shift)


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS,
        factors: int = 4, steps: int = 600, rate: float = 0.3, l2: float = 1e-4,
        batch: int = 64, seed: int = 7) -> FactorizationMachine:
    """Fit by AdaGrad on logistic loss in about ``steps`` batches; ``rows`` are (buckets, values).

    Without rows of both labels the machine is constant at the share of label 1 (0.5 if empty).
    """
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    rng = np.random.default_rng(seed)
    fold = rng.permutation(len(rows))
    held, used_rows = fold[:len(rows) // 5], fold[len(rows) // 5:]
    m = FactorizationMachine(float(np.log(share / (1 - share))),
                             np.zeros(1 << bits, np.float32),
                             np.zeros((1 << bits, factors), np.float32))
    if len(np.unique(labels)) < 2:
        return m
    texts = np.bincount(np.concatenate([rows[i][0] for i in used_rows]), minlength=1 << bits)
    m.factor = rng.normal(0, START, m.factor.shape).astype(np.float32)
    m.factor[texts == 0] = 0
    # A batch shrinks only the terms it holds: rare terms shrink as much more as they are rare,
    # else factors of terms of one text would learn that text by heart.
    shrink = 3 * l2 / np.maximum(1 - (1 - texts / len(used_rows)) ** batch, 1e-9)
    # A factor's gradient is a weight's times a factor.
    gw, gv, gb = (np.full_like(m.weight, 1e-6), np.full_like(m.factor, 1e-6 * START ** 2), 1.0)
    for _ in range(-(-steps * batch // max(1, len(used_rows)))):
        order = rng.permutation(used_rows)
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            size = np.array([len(rows[i][0]) for i in pick])
            doc = np.repeat(np.arange(len(pick)), size)
            bucket = np.concatenate([rows[i][0] for i in pick])
            x = np.concatenate([rows[i][1] for i in pick])
            used, at = np.unique(bucket, return_inverse=True)
            w, v = m.weight[used], m.factor[used]
            vx = v[at] * x[:, None]
            total = _sums(doc, vx, len(pick))
            margin = (m.bias + np.bincount(doc, w[at] * x, minlength=len(pick)) + 0.5 * (
                (total ** 2).sum(1) - np.bincount(doc, (vx * vx).sum(1), minlength=len(pick))))
            err = (_sigmoid(margin) - labels[pick]) / len(pick)
            e = (err[doc] * x).astype(np.float32)
            step_w = np.bincount(at, e, minlength=len(used)) + l2 * w
            step_v = (_sums(at, e[:, None] * (total[doc] - vx), len(used))
                      + shrink[used][:, None] * v)
            gw[used] += step_w ** 2
            gv[used] += step_v ** 2
            m.weight[used] = w - rate * step_w / np.sqrt(gw[used])
            m.factor[used] = v - 3 * rate * step_v / np.sqrt(gv[used])
            gb += float(err.sum()) ** 2
            m.bias -= rate * float(err.sum()) / gb ** 0.5
    if len(np.unique(labels[held])) == 2:
        doc = np.repeat(np.arange(len(held)), [len(rows[i][0]) for i in held])
        m.slope, m.shift = _platt(m.margin(
            doc, np.concatenate([rows[i][0] for i in held]),
            np.concatenate([rows[i][1] for i in held]), len(held)), labels[held])
    return m


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of every column of ``values`` by ``group`` (0 to n - 1)."""
    out = np.empty((n, values.shape[1]))
    for f in range(values.shape[1]):
        out[:, f] = np.bincount(group, values[:, f], minlength=n)
    return out


def _platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make ``sigmoid(slope * margin + shift)`` fit the labels (Newton)."""
    up, down = float((label == 1).sum()), float((label == 0).sum())
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    spread = margin.std() or 1.0
    x = np.stack([(margin - margin.mean()) / spread, np.ones(len(margin))], 1)
    t = np.array([1.0, 0.0])
    for _ in range(100):
        p = _sigmoid(x @ t)
        grad = x.T @ (p - target) + 1e-3 * t
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        t = t - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    slope = max(float(t[0]) / spread, 1e-6)
    return slope, float(t[1]) - slope * float(margin.mean())


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", sample_rows: int = 6000, **params) -> FactorizationMachine:
    """Fit on at most ``sample_rows`` labelled rows: those whose id has the smallest hash.

    Ids are chosen from ``labels`` alone (a narrow top-k), so only the sample's texts move, and
    the driver holds a bounded number of hashed rows. Rows without a label are left out.
    """
    bits = params.get("bits", BITS)
    ids = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
           .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
           .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    # The sample has at most sample_rows rows of two numbers: small whatever the corpus.
    texts = (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))
             .join(F.broadcast(ids), "doc_id").select("doc_id", "body", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for i, j in byte_blocks(bodies, BLOCK_CHARS):
                doc, bucket, x = terms(bodies[i:j], bits)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("label").slice(i, j - i),
                     pa.array([bucket[s:e].astype(np.int32) for s, e in zip(cut, cut[1:])],
                              pa.list_(pa.int32())),
                     pa.array([x[s:e] for s, e in zip(cut, cut[1:])], pa.list_(pa.float32()))],
                    ["doc_id", "label", "bucket", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    with short_batches(docs.sparkSession):
        got = map_arrow(texts, run, f"doc_id {kinds['doc_id']}, label {kinds['label']}, "
                                    "bucket array<int>, x array<float>").toArrow()
    bucket, x = got.column("bucket").combine_chunks(), got.column("x").combine_chunks()
    cut = bucket.offsets.to_numpy() if len(got) else np.zeros(1, int)
    flat_b, flat_x = bucket.values.to_numpy(), x.values.to_numpy()
    rows = [(flat_b[s:e], flat_x[s:e]) for s, e in zip(cut, cut[1:])]
    y = got.column("label").to_numpy().astype(np.float64)
    # Order as a function of the rows, not of the order in which tasks ended.
    order = np.lexsort((y, [len(r[0]) for r in rows], got.column("doc_id").to_numpy()))
    return fit([rows[i] for i in order], y[order], **params)


def score(docs: DataFrame, model: FactorizationMachine, columns: list[str],
          text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``columns`` of every row of ``docs`` and the probability of label 1 of its whole text.

    Null texts score as empty. The model (``2**bits`` weights and factors, some megabytes
    whatever the corpus) is broadcast. An empty table gives an empty result.
    """
    if score_col in columns:
        raise ValueError(f"{score_col} names an input column; give another score_col")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is among the columns goes to the workers once, inside its row.
    at = next((i for i, c in enumerate(columns) if c == text_col
               and docs.select(F.col(f"`{c}`")).schema[0].dataType == StringType()), None)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                       *([] if at is not None else [text_or_empty(text_col).alias("body")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("body") if at is None else b.column("row").field(at)
            bodies = texts.fill_null("").to_pylist()
            scores = [shared.value.score(bodies[i:j])
                      for i, j in byte_blocks(bodies, BLOCK_CHARS)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(np.concatenate(scores) if scores else [],
                                           pa.float64())], ["row", "score"])

    row = rows.schema["row"].dataType.simpleString()
    out = map_arrow(rows, run, f"row {row}, score double")
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns],
                      F.col("score").alias(score_col))


def held_out(id_col: str = "doc_id"):
    """True for ids whose labels are never learned: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1
