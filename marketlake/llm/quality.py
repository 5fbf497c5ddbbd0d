"""Quality rules by repetition coverage.

Words are runs of anything but ASCII white space. For several n-gram lengths a rolling polynomial hash (the hash of length
n + 1 comes from that of length n in one numpy pass) marks the n-grams found twice or more in the text; the verdict
compares the share of word characters inside marked n-grams, and inside repeated lines, with a bound for each length.

Defined results: a null text has no words and fails the base rule; an empty text likewise; whole texts count, however long; a
share at exactly its bound is kept; every row is judged by its own text, so repeated rows and null doc_ids are kept apart;
columns besides doc_id and text pass through keep_good() untouched, whatever their names; an empty table gives no rows.
Memory is that of one text's arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import documents, small_batches
from .features import MIX

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Most share of characters inside n-grams of each length that are found twice or more, and inside repeated lines: a little over
#: what documents labelled good show (0.28 up to length 8, 0.18 at length 10, 0.14 for lines).
GRAM_BOUNDS = {5: 0.32, 6: 0.32, 8: 0.32, 10: 0.22}
LINE_BOUND = 0.18
LEAST_WORDS = 50

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [f"share_{n}_grams" for n in GRAM_BOUNDS] + ["share_dup_lines"]
RESULT = ", ".join([f"{k} long" for k in MEASURES] + ["base_failed boolean", "kept boolean"] + [f"{k} double" for k in SHARES])


def hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def rolled(h: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all n-grams for each n of the ascending lengths that the text has."""
    rolling = np.zeros(len(h), dtype=np.uint64)
    for n in range(1, lengths[-1] + 1):
        if n > len(h):
            return
        rolling = rolling[: len(h) - n + 1] * MIX + h[n - 1 :]
        if n in lengths:
            yield n, rolling


def covered(keys: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie inside an n-gram that is found twice or more; keys: one for each n-gram."""
    ranked = np.sort(keys)
    if not (ranked[1:] == ranked[:-1]).any():
        return np.zeros(words, dtype=bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(words + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def triples(words: list[str]) -> np.ndarray:
    """One exact key for each 3-word window."""
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) < 1 << 20:
        return (a[:-2] * len(ids) + a[1:-1]) * len(ids) + a[2:]
    pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1].astype(np.int64)
    return pairs[:-1] * len(ids) + a[2:]


def measure(text: str | None) -> list:
    """The values of RESULT for one text."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += sum(map(len, WORD.findall(line)))
        elif WORD.search(line):
            seen.add(line)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    chars = int(sizes.sum())
    repeat = int(covered(triples(words), 3, n).sum()) if n >= 3 else 0
    shares = dict.fromkeys(GRAM_BOUNDS, 0.0)
    if repeat:  # a longer n-gram found twice holds a 3-word window found twice
        for k, keys in rolled(hashes(words), list(GRAM_BOUNDS)):
            shares[k] = float(sizes[covered(keys, k, n)].sum()) / chars
    line_share = dup_chars / chars if chars else 0.0
    failed = n < LEAST_WORDS or 100 * repeat > 50 * n
    kept = not failed and line_share <= LINE_BOUND and all(shares[k] <= most for k, most in GRAM_BOUNDS.items())
    return [n, chars, sum(map(text.count, SYMBOLS)), dup_lines, repeat, failed, kept, *shares.values(), line_share]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *MEASURES, "base_failed", "kept", *SHARES]
        for batch in batches:
            rows = [measure(t) for t in batch.column(1).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in zip(*rows, strict=True))], names=names)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {RESULT}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows whose text is kept, with the columns that came, whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(MEASURES) + 1
        for batch in batches:
            yield batch.filter(pa.array([measure(t)[at] for t in batch.column("text").to_pylist()], pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return measures(documents(spark, sf_dir))
