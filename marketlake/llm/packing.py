"""Packing by optimal length buckets.

Lengths are token ids of a given tokenizer. The lengths of all documents are counted in one global histogram. Dynamic
programming over it chooses the bucket boundaries that minimise padding, given the number of buckets; each document is
padded to its bucket's boundary, and consecutive documents of a bucket form batches of at most `budget` padded tokens (one
document if it alone is longer).

The histogram is exact: it has a row for each different length, so its size is bounded by the longest text and not by the
number of documents. Batches need ranks in a bucket: rows are dealt into chunks by a hash, ranked in each chunk, and moved by
the counts of the chunks before, so that a bucket with a third of all rows is as many tasks' work as it has chunks.

Defined results: a null or empty text has length 0 and its boundary may be 0 (such documents fill a batch of `budget`
documents); whole texts count, however long; ties in length go by the chunk and text hash; repeated rows and null doc_ids
have a place each; other columns, with whatever names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, save, small_batches
from .token_ids import cuts_hold, default_tokenizer, encoder_of

BUCKETS, BUDGET = 16, 65_536
CHUNK_ROWS = 50_000


def lengths(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, tie (a hash of the text) of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path, 4, by_chunk)
        for batch in batches:
            n = [len(encoder.encode(t)) // 4 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(1)], names=["doc_id", "n_tokens", "tie"])

    small_batches(docs.sparkSession)
    by_chunk = cuts_hold(tokenizer_path)
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(count, "doc_id long, n_tokens long, tie long")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending boundaries, the last one the largest length, with the least total padding over the histogram.

    cost(i, j) of one bucket for lengths i..j is monotone in the sense of divide and conquer, so each bucket more costs
    O(n log n).
    """
    size = np.asarray(lengths, dtype=np.int64)
    n = len(size)
    c = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    t = np.concatenate([[0], np.cumsum(size * np.asarray(counts, dtype=np.int64))])
    best = np.array([int(size[j - 1] * c[j] - t[j]) if j else 0 for j in range(n + 1)], dtype=np.int64)
    choice = [np.zeros(n + 1, dtype=np.int64)]
    for _ in range(min(buckets, n) - 1):
        new, took = best.copy(), np.zeros(n + 1, dtype=np.int64)
        spans = [(1, n, 0, n - 1)]
        while spans:
            lo, hi, a, b = spans.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            total = best[i] + size[j - 1] * (c[j] - c[i]) - (t[j] - t[i])
            k = int(total.argmin())
            new[j], took[j] = total[k], i[k]
            spans += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        best = new
        choice.append(took)
    out, j = [], n
    for took in reversed(choice):
        if j <= 0:
            break
        out.append(int(size[j - 1]))
        j = int(took[j])
    return sorted(set(out))


def pack(rows: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Add bucket, boundary, batch, place and padding to rows (saved already) with n_tokens and tie."""
    # a row for each different length
    histogram = sorted((r["n_tokens"], r["n"]) for r in rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in histogram)
    ends = boundaries([s for s, _ in histogram], [n for _, n in histogram], buckets) if histogram else [0]
    edges = F.array(*[F.lit(e).cast("long") for e in ends])
    bucket = F.size(F.filter(edges, lambda e: e < F.col("n_tokens")))
    rows = rows.withColumn("bucket", bucket).withColumn("boundary", F.get(edges, F.col("bucket")))
    chunks = max(1, -(-total // CHUNK_ROWS))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("tie", "doc_id"), F.lit(chunks)).cast("int"))
    counts = rows.groupBy("bucket", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("bucket", "chunk", (F.sum("n").over(Window.partitionBy("bucket").orderBy("chunk")) - F.col("n")).alias("before"))
    order = Window.partitionBy("bucket", "chunk").orderBy("n_tokens", "tie", "doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1).join(before, ["bucket", "chunk"])
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("boundary", F.lit(1))), F.lit(1))
    at = F.col("before") + F.col("rank")
    return ranked.withColumns({"batch": F.floor(at / per_batch).cast("long"), "place": F.pmod(at, per_batch).cast("int"), "padding": F.col("boundary") - F.col("n_tokens")}).drop("chunk", "rank", "before", "tie")


def packed(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, boundary, batch (in the bucket), place (in the batch), padding of every row."""
    rows = save(lengths(docs, tokenizer_path or default_tokenizer()), "lengths")
    return pack(rows).select("doc_id", "n_tokens", "bucket", "boundary", "batch", "place", "padding")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a batch."""
    return packed(documents(spark, sf_dir))
