"""Benchmark decontamination in DataFrame functions only: SimHash over item-sized windows.

1. Windows. A window as long as an item is laid over a document wherever a five-word shingle of the item occurs, so that
   the shingle's places in both agree. A window that shares no shingle with the item has weighted similarity 0, so this
   leaves out nothing that step 3 could accept. A bit map of the benchmark's shingles sorts out
   the other places inside the row; only what passes it is exploded and joined.
2. Multi-index Hamming blocks. 64-bit SimHashes over the words of windows and items are cut into BLOCKS blocks. Two that
   differ in at most RADIUS bits agree in some block up to RADIUS // BLOCKS bits, so items are listed under all block values
   that near, and every fingerprint within the radius is found by equality.
3. Verification: weighted Jaccard similarity of the five-word shingles, term frequency times inverse item frequency, at
   least `similarity`.

Defined results: a null text, or one without words, is no leak; items without words never match; an item of one to four
words is one shingle and matches only texts of just these words; equal texts are worked on once and reported for each of
their rows, null doc_ids included; an empty table gives no rows; item texts that repeat are reported under each item_id;
whole texts and items count, however long; a window at exactly `similarity` is a leak, and of windows tied for the best the
first is reported; columns besides doc_id and text pass through without_leaks() whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, save, small

SHINGLE_WORDS = 5
RADIUS = 17
WIDTHS = (11, 11, 11, 11, 10, 10)
#: A bit map has 32 bits for each shingle of the benchmark, within these bounds; a fuller one only lets more places through.
LEAST_BITS, MOST_BITS = 12, 22


def word_hashes(text: Column) -> Column:
    """One 64-bit hash for each lower-case word of a text."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def shingles(words: str) -> Column:
    """Hashes of the five-word windows of an array of word hashes; a shorter array is one shingle."""
    h = F.col(words)
    at = lambda i, j: F.get(h, i + F.lit(j))
    places = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE_WORDS, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[at(i, j) for j in range(SHINGLE_WORDS)]))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(words: str, width: int = 16) -> Column:
    """SimHash of an array of word hashes. Bit width * k + j of the hashes is counted in lane k of the j-th long.

    A lane of `width` bits counts up to 2^(width - 2) - 1 words.
    """
    zero = F.struct(*[F.lit(0).cast("long").alias(f"s{j}") for j in range(width)])
    ones = sum(1 << width * k for k in range(64 // width))
    lanes, tops = F.lit(signed(ones)).cast("long"), F.lit(signed(ones << (width - 2))).cast("long")

    def add(acc: Column, h: Column) -> Column:
        return F.struct(*[(acc[f"s{j}"] + F.shiftrightunsigned(h, j).bitwiseAND(lanes)).alias(f"s{j}") for j in range(width)])

    def bits(acc: Column) -> Column:
        # a lane reaches its last bit but one, which leaves the sign alone, if more than half of the words have the bit
        half = (F.lit((1 << (width - 2)) - 1) - F.shiftright(F.size(words), 1)).cast("long") * lanes
        full = [(acc[f"s{j}"] + half).bitwiseAND(tops) for j in range(width)]
        made = [F.shiftrightunsigned(x, width - 2 - j) if j < width - 1 else F.shiftleft(x, 1) for j, x in enumerate(full)]
        return reduce(lambda a, b: a.bitwiseOR(b), made)

    return F.aggregate(words, zero, add, bits)


def lane_width(most_words: int | None) -> int:
    """Bits of a lane that counts so many words: 16 up to 16,383, else 32."""
    return 16 if (most_words or 0) < 1 << 14 else 32


def blocks(fingerprint: str, near: int = 0) -> Column:
    """Array of (block number, value), with all values that differ in up to `near` bits."""
    def listed(k: int, value: Column, masks: list[int]) -> Column:
        return F.transform(F.lit(masks), lambda m: F.struct(F.lit(k).alias("block"), value.bitwiseXOR(m).alias("value")))

    out, shift = [], 0
    for k, width in enumerate(WIDTHS):
        value = F.shiftrightunsigned(fingerprint, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
        masks = [0] + [1 << a for a in range(width)] * (near > 0) + [1 << a | 1 << b for a in range(width) for b in range(a)] * (near > 1)
        out.append(listed(k, value, masks))
        shift += width
    return F.concat(*out)


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, words (hashes), n_words, fingerprint, entries (shingle, tf, idf) and total weight of each item with words."""
    hashed = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).where(F.size("words") > 0)
    width = lane_width(hashed.agg(F.max(F.size("words"))).first()[0])
    items = save(hashed.select("item_id", "words", F.size("words").alias("n_words"), simhash("words", width).alias("fingerprint"), shingles("words").alias("shingles")), "benchmark-items")
    n = items.count()
    tf = items.select("item_id", F.explode("shingles").alias("shingle")).groupBy("item_id", "shingle").agg(F.count("*").alias("tf"))
    df = tf.groupBy("shingle").agg((1 + F.log((1.0 + n) / (1.0 + F.count("*")))).alias("idf"))
    entries = tf.join(df, "shingle").groupBy("item_id").agg(F.collect_list(F.struct("shingle", "tf", "idf")).alias("entries"), F.sum(F.col("tf") * F.col("idf")).alias("weight"))
    return save(items.join(entries, "item_id").withColumn("idf_new", 1 + F.log(F.lit(1.0 + n))), "benchmark-entries")


def bit_map(items: DataFrame) -> tuple[list[int], int]:
    """Longs of a bit map over the shingles of all items, and how far a hash is shifted to give its bit."""
    n = items.agg(F.sum(F.size("shingles"))).first()[0] or 0
    bits = min(max((32 * n).bit_length(), LEAST_BITS), MOST_BITS)
    top = 64 - bits
    rows = items.select(F.explode("shingles").alias("s")).select(F.shiftrightunsigned("s", top + 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(s, {top}) AS INT) & 63)").alias("m"))
    out = [0] * (1 << (bits - 6))
    for r in rows.groupBy("at").agg(F.bit_or("m").alias("m")).collect():  # 65,536 longs at most
        out[r["at"]] = r["m"]
    return out, top


def windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """key, start, words of the item-sized windows of the texts (key, text) that share a shingle with the item."""
    spread = items.agg(F.max("n_words")).first()[0]
    if spread is None:
        return texts.select("key", F.lit(0).alias("start"), F.array().cast("array<bigint>").alias("words")).limit(0)
    hashed = texts.select("key", word_hashes(F.col("text")).alias("h"))
    hashed = hashed.select("key", "h", shingles("h").alias("s"))
    longs, top = bit_map(items)
    table = F.lit(longs).cast("array<bigint>")

    def listed(s: Column) -> Column:
        bit = F.shiftrightunsigned(s, top).cast("int")
        return F.call_function("getbit", F.get(table, F.shiftright(bit, 6)), bit.bitwiseAND(F.lit(63))) == 1

    places = F.when(F.size("s") > 0, F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: listed(F.get("s", i)))).otherwise(F.array().cast("array<int>"))
    hashed = hashed.select("key", "h", "s", places.alias("places"))
    around = lambda i: F.struct(
        i.alias("place"), F.get("s", i).alias("shingle"), F.greatest(i - spread, F.lit(0)).alias("from"),
        F.slice("h", F.greatest(i - spread, F.lit(0)) + 1, F.lit(2 * spread + SHINGLE_WORDS)).alias("near"),
    )
    # explode_outer: for explode Spark would filter by the array's size below, and compute the array anew for each element
    hits = hashed.select("key", F.size("h").alias("n"), F.explode_outer(F.transform("places", around)).alias("hit")).select("key", "n", "hit.*")
    listing = items.select("item_id", "n_words", F.posexplode("shingles").alias("at", "shingle"))
    # five-word texts fit items of five words or more only, shorter ones those of as many words
    laid = hits.join(small(listing), "shingle").where(F.col("n") >= F.least("n_words", F.lit(SHINGLE_WORDS)))
    start = F.greatest(F.col("place") - F.col("at"), F.lit(0))
    end = F.least(F.col("place") - F.col("at") + F.col("n_words"), F.col("n"))
    laid = laid.select("key", start.alias("start"), (end - start).alias("len"), "from", "near")
    cut = laid.select("key", "start", "len", F.slice("near", F.col("start") - F.col("from") + 1, F.col("len")).alias("words"))
    return cut.groupBy("key", "start", "len").agg(F.first("words").alias("words")).drop("len")


def similarity_to_item() -> Column:
    """Weighted Jaccard similarity of the column `seen` (a window's shingles) and an item's entries."""
    seen = F.col("seen")
    counted = F.transform("entries", lambda e: F.struct(e["tf"].alias("tf"), e["idf"].alias("idf"), F.size(F.filter(seen, lambda s: s == e["shingle"])).alias("here")))
    zero = F.struct(F.lit(0.0).alias("both"), F.lit(0.0).alias("window"), F.lit(0).alias("n"))
    step = lambda acc, e: F.struct(
        (acc["both"] + F.least(e["tf"], e["here"]) * e["idf"]).alias("both"), (acc["window"] + e["here"] * e["idf"]).alias("window"), (acc["n"] + e["here"]).alias("n"),
    )
    last = lambda acc: acc["both"] / (F.col("weight") + acc["window"] + (F.size(seen) - acc["n"]) * F.col("idf_new") - acc["both"])
    return F.aggregate(counted, zero, step, last)


def leaks(texts: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """key, item_id, start_word, similarity: the best window of each text (key, text) for each item that leaks into it."""
    items = items_of(benchmark)
    width = lane_width(items.agg(F.max("n_words")).first()[0])
    cut = windows(texts, items).withColumn("fingerprint", simhash("words", width))
    listed = items.select("item_id", F.col("fingerprint").alias("item_fingerprint"), F.explode(F.array_distinct(blocks("fingerprint", RADIUS // len(WIDTHS)))).alias("b"))
    probes = save(cut, "windows").select("key", "start", "fingerprint", "words", F.explode(blocks("fingerprint")).alias("b"))
    near = probes.join(small(listed), "b").where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS)
    near = near.groupBy("key", "start", "item_id", F.size("words").alias("len")).agg(F.first("words").alias("window"))
    checked = near.join(small(items.select("item_id", "entries", "weight", "idf_new"), F.size("entries")), "item_id").withColumn("seen", shingles("window"))
    scored = checked.select("key", "item_id", "start", similarity_to_item().alias("similarity")).where(F.col("similarity") >= similarity)
    best = scored.groupBy("key", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("at"))).alias("best"))
    return best.select("key", "item_id", (-F.col("best.at")).alias("start_word"), F.round("best.similarity", 6).alias("similarity"))


def keyed(docs: DataFrame) -> DataFrame:
    """key, text of the different texts that have words."""
    return docs.where(F.col("text").rlike(r"[\p{L}\p{N}_]")).select(F.unhex(F.md5("text")).alias("key"), "text")


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of docs into whose text no item leaks, with their columns."""
    name = free_name(docs.columns, "leak")
    found = save(leaks(keyed(docs), benchmark, similarity).select(F.col("key").alias(name)).distinct(), "leak-keys")
    return docs.join(found, F.unhex(F.md5(docs["text"])) == F.col(name), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that leaks into it."""
    docs = documents(spark, sf_dir)
    found = save(leaks(keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "leaks")
    return docs.select("doc_id", F.unhex(F.md5("text")).alias("key")).join(found, "key").select("doc_id", "item_id", F.col("start_word").cast("long").alias("start_word"), "similarity")
