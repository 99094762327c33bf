"""Benchmark passages in documents: a prefix-filtered set join with exact verification.

A benchmark item is cut into windows of consecutive words; a window is the set of its word
shingles, each with its place. It occurs in a document only if *all* its shingles do, so for
this exact containment one shingle is prefix enough: the rarest one in the documents.

1. One scan of the documents keeps, per row, the places of shingles that some window may have
   (a bitmap of the windows' shingles, of bounded size, decides; false hits fall later) with the
   words around them. That narrow table is all that later steps read.
2. Its counts order the shingles by rarity. Windows of which a shingle is nowhere go; the others
   are joined by their rarest shingle.
3. Length and place bounds: the window must begin and end inside the document. What is left is
   compared word by word.
4. Per document: covered words from the sorted spans, and the set of item lists of the windows
   found. The digest of the items is made once per distinct set.

Everything is Spark SQL functions; no Python runs on the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import lookup, text_or_empty, written

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BITS_PER_SHINGLE = 64
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 22  # the bitmap: 512 bytes to 512 KB


def words(text: Column) -> Column:
    """Runs of digits, letters and signs beyond ASCII; only A to Z are lower-cased."""
    found = F.array_remove(F.split(text, SEPARATORS), "")
    return F.transform(found, lambda w: F.when(
        F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(
        F.translate(w, string.ascii_uppercase, string.ascii_lowercase)))


def _shingle(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(size)])


def _places(n: Column, size) -> Column:
    """0 .. n - size; empty where the text is shorter."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(
        F.array().cast("array<int>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = 10) -> DataFrame:
    """Distinct (item, win, len): every run of ``window`` words as text, or all of a shorter item.

    Items without words have no window. A null id counts as the empty text.
    """
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                     words(text_or_empty(text_col)).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(window)))
    return w.select("item", "len", "w", F.explode(_places(F.size("w"), F.col("len"))).alias("at")
                    ).select("item", "len", F.array_join(F.slice("w", F.col("at") + 1, F.col(
                        "len")), " ").alias("win")).distinct()


def _window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """(win, len, size, off, h) of distinct windows; a shorter window is one shingle."""
    hashed = (windows.select("win", "len").distinct()
              .withColumn("hs", F.transform(F.split("win", " "), lambda w: F.xxhash64(w)))
              .withColumn("size", F.least(F.col("len"), F.lit(size))))
    at = hashed.withColumn("off", F.explode(_places(F.col("len"), F.col("size"))))
    h = F.lit(None).cast("bigint")
    for n in range(1, size + 1):
        h = F.when(F.col("size") == n, _shingle(F.col("hs"), F.col("off"), n)).otherwise(h)
    return at.select("win", "len", "size", "off", h.alias("h"))


def _bitmap(shingles: DataFrame) -> tuple[Column, int]:
    """Two bits per shingle in an array of longs, as a constant; its size in bits is bounded."""
    distinct = shingles.select("h").distinct()
    bits = LEAST_BITS
    n = distinct.count()
    while bits < min(MOST_BITS, BITS_PER_SHINGLE * n):
        bits *= 2
    slot = F.explode(F.array(*_probes(F.col("h"), bits)))
    rows = (distinct.select(slot.alias("slot"))
            .groupBy(F.shiftright("slot", 6).cast("int").alias("i"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(
                "slot").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).collect())
    array = [0] * (bits // 64)
    for r in rows:  # at most bits / 64
        array[r["i"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, array))), ",").cast("array<bigint>"), bits


def _probes(h: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("bigint")
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def _may_be_in(bitmap: Column, bits: int, h: Column) -> Column:
    ok = F.lit(True)
    for p in _probes(h, bits):
        ok = ok & (F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")),
                            p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return ok


def _hits(sizes: list[int], bitmap: Column, bits: int, window: int, shingle: int) -> Column:
    """Array of (pos, h, at, near): shingles of the row's words that may be a window's.

    ``near`` are the words from ``at`` that any window with this shingle can cover.
    """
    n, back = F.size("w"), max(window - shingle, 0)
    out = F.array().cast("array<struct<pos:int,h:bigint,at:int,near:array<string>>>")
    for size in sizes:
        places = F.filter(_places(n, size), lambda i: _may_be_in(
            bitmap, bits, _shingle(F.col("hs"), i, size)))
        out = F.concat(out, F.transform(places, lambda i: F.struct(
            i.alias("pos"), _shingle(F.col("hs"), i, size).alias("h"),
            F.greatest(i - back, F.lit(0)).alias("at"),
            F.slice("w", F.greatest(i - back, F.lit(0)) + 1,
                    i - F.greatest(i - back, F.lit(0)) + window).alias("near"))))
    return out


def _set_key(ids: Column) -> Column:
    """Key of a group's set of distinct ids, without collecting them."""
    return F.md5(F.concat_ws(",", F.count(F.lit(1)).cast("string"),
                             F.bit_xor(F.xxhash64(ids)).cast("string"),
                             F.bit_xor(F.xxhash64(F.lit("second"), ids)).cast("string")))


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, shingle: int = 5,
                  broadcast_bytes: int = 8 << 20) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``, ``spans`` (covered ``start``/``stop`` word places of every window found).

    A word is hit if an occurrence of any window covers it; ``n_items`` counts the distinct ids
    of items with a window that occurs and ``items_sha256`` is of these ids, sorted as text and
    joined by commas (of the empty text if none). Null texts have no words, items without words
    no windows; an item of fewer than ``window`` words is one window. Null and repeated ids and
    repeated rows are rows like any other; items that share an id count once and null ids as
    the empty text. An empty ``docs`` gives no rows, empty ``items`` no hits. Extra columns are
    ignored. The window tables are broadcast up to ``broadcast_bytes``, else joined with salts.
    """
    if not 0 < shingle <= window:
        raise ValueError("shingle must be between 1 and window")
    windows = written(item_windows(items, item_id_col, item_text_col, window), "windows")
    shingles = written(_window_shingles(windows, shingle), "window-shingles")
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())
    bitmap, bits = _bitmap(shingles)

    read = docs.select(F.col(id_col).alias("doc_id"), words(text_or_empty(text_col)).alias("w"))
    hashed = read.withColumn("hs", F.transform("w", lambda w: F.xxhash64(w)))
    rows = written(hashed.select(
        "doc_id", F.monotonically_increasing_id().alias("uid"),
        F.size("w").cast("bigint").alias("n_words"),
        _hits(sizes, bitmap, bits, window, shingle).alias("hits")), "passage-hits")
    hits = rows.select("uid", "n_words", F.inline("hits"))

    # Rarity, and one shingle per window that may occur at all.
    seen = hits.groupBy("h").agg(F.count(F.lit(1)).alias("seen"))
    rarest = (shingles.join(seen, "h", "left").groupBy("win", "len")
              .agg(F.count("seen").alias("present"), F.count(F.lit(1)).alias("needed"),
                   F.min(F.struct("seen", "h", "off")).alias("rare"))
              .filter(F.col("present") == F.col("needed")).select("win", "len", "rare.h",
                                                                  "rare.off"))
    lists = windows.groupBy("win").agg(_set_key(F.col("item")).alias("list"))
    prefixes = rarest.join(lists, "win")
    start, stop = F.col("pos") - F.col("off"), F.col("pos") - F.col("off") + F.col("len")
    matches = (lookup(hits, prefixes, ["h"], F.struct("uid", "pos"), most_bytes=broadcast_bytes)
               .filter((start >= 0) & (stop <= F.col("n_words")))
               .filter(F.array_join(F.slice("near", start - F.col("at") + 1, F.col("len")), " ")
                       == F.col("win"))
               .select("uid", start.alias("start"), stop.alias("stop"), "list"))
    # At most `window` spans begin at one word of a document: both sets are bounded by its length.
    found = written(matches.groupBy("uid").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.collect_set("list")).alias("lists"))
        .withColumn("lists_key", F.md5(F.array_join("lists", ","))), "passages")

    of_list = (windows.join(windows.groupBy("win").agg(_set_key(F.col("item")).alias("list"))
                            .groupBy("list").agg(F.min("win").alias("win")), "win")
               .select("list", "item"))
    digests = (found.select("lists_key", "lists").distinct()
               .select("lists_key", F.explode("lists").alias("list"))
               .join(of_list, "list").select("lists_key", "item").distinct()
               .groupBy("lists_key").agg(
                   F.count(F.lit(1)).alias("n_items"),
                   F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256)
                   .alias("items_sha256")))
    covered = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["reach"], s["start"])))
            .alias("n"), F.greatest(a["reach"], s["stop"]).alias("reach")))["n"]
    found = lookup(found.select("uid", "spans", "lists_key"), digests, ["lists_key"],
                   F.col("uid"), most_bytes=broadcast_bytes)
    n_hit = F.coalesce(covered.cast("bigint"), F.lit(0).cast("bigint"))
    return (rows.select("uid", "doc_id", "n_words").join(found, "uid", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "spans"))


def drop_contaminated(docs: DataFrame, items: DataFrame, most_share: float = 0.0,
                      text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, of whose words at most ``most_share`` are hit.

    Rows are told apart by their place, so null and repeated ids are safe and column names free.
    """
    packed = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                 F.monotonically_increasing_id().alias("place")), "passage-docs")
    found = find_passages(packed.select("place", F.col("row").getField(text_col).alias("text")),
                          items, id_col="place", **settings)
    bad = found.filter(F.col("n_hit") > F.lit(float(most_share)) * F.col("n_words")).select(
        F.col("doc_id").alias("place"))
    return packed.join(bad, "place", "left_anti").select("row.*")
