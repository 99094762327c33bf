"""Small tables with the awkward rows every operator must stand."""

import random

import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SMALL = "/root/testdata/sf0.001"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


LONG = prose(1, 60_000)
ODD = [None, "", " ", "\n\n", "a", "Ab. c", "x  y\t z\n", "é ü ß Ñandú", "naïve café", "日本語 テキスト",
       "don't we'll 12 3½", "<|endoftext|> <|x|>", "\U0001f600 ok\r\n", "a b", "İI ΑΣ",
       "w " * 300, "z" * 700, "?!., ,,", prose(2, 40), prose(2, 40), prose(3, 400)]


def odd_docs(spark, extra: bool = False):
    """Ids ascending with a null id, a repeated row and every odd text."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, ODD[3]), (100, LONG)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    if extra:
        from pyspark.sql import functions as F
        for name in ("kept", "h128", "row", "uid", "body", "shard", "score", "row_uid", "size"):
            df = df.withColumn(name, F.lit(name))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
