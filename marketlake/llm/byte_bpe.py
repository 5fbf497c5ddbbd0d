"""Byte-level BPE by a file of ranks: every distinct pre-token of the corpus is encoded once; decoding joins the table of token bytes.

Each task cuts its texts into pre-tokens, numbers the distinct ones of a chunk and keeps the documents' sequences of numbers, their
positions, in the chunk's file. The distinct pre-tokens of all chunks are shuffled by the word's hash, in blocks, so that equal ones meet;
each is encoded once and its ids go back to every chunk that has it, where documents are put together by position. A word is sent once
per chunk however often it occurs, so a frequent word is no hot key, and a bucket of words is bounded as buckets grow with the partitions.

A pre-token never reaches over the beginning of white space, so texts are cut there first and the pattern is applied to each distinct
piece only.

Defined results: a null text is an empty one, with no ids; whole texts are encoded, however long; strings of special tokens are
plain text; null doc_ids keep their rows; repeated rows are encoded alike; other columns, with whatever names, are ignored; an empty
table gives an empty table. ids of decoded() may be null or empty: no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .chunks import CHUNK_BYTES, PIECES, Numbers, arrow_keys, by_chunk, expand, key_arrays, read_arrays, sums, write_arrays
from .common import documents, run_dir, small_batches

Arrow = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: Pieces are numbered over texts of so many characters at once.
PIECES_OF = 8 << 20


def default_ranks() -> str:
    """Path of the ranks that are used where none are given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    """The pattern of pre-tokens that is used where none is given."""
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def token_bytes(ranks_path: str) -> dict[bytes, int]:
    """Bytes of each token and its id."""
    with open(ranks_path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f) if word}


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding(name="ranks", pat_str=pattern, mergeable_ranks=token_bytes(ranks_path), special_tokens={})


def _chunks(batches: Iterator[pa.RecordBatch], cut: Callable[[str], list[str]]) -> Iterator[tuple[list, np.ndarray, np.ndarray, Numbers]]:
    """doc_ids, the numbers of all pre-tokens, how many each document has, and the distinct ones of each chunk. Texts aren't kept."""
    keys, entries, lengths, words, size = [], [], [], Numbers(), 0

    def learn(texts: list[str]) -> None:
        pieces = Numbers()
        rows = [[pieces[p] for p in PIECES.findall(t)] for t in texts]
        parts = [[words[w] for w in cut(piece)] for piece in pieces]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter(chain.from_iterable(parts), np.int32, int(sizes.sum()))
        many = np.fromiter(map(len, rows), np.int64, len(rows))
        every = np.fromiter(chain.from_iterable(rows), np.int32, int(many.sum()))
        entries.append(flat[expand((np.cumsum(sizes) - sizes)[every], sizes[every])])
        lengths.append(sums(sizes[every], many).astype(np.int32))

    held, held_size = [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            held.append(text or "")
            held_size += len(held[-1])
            size += len(held[-1])
            if held_size >= PIECES_OF or size >= CHUNK_BYTES:
                learn(held)
                held, held_size = [], 0
            if size >= CHUNK_BYTES:
                yield keys, np.concatenate(entries), np.concatenate(lengths), words
                keys, entries, lengths, words, size = [], [], [], Numbers(), 0
    if keys:
        learn(held)
        yield keys, np.concatenate(entries), np.concatenate(lengths), words


def _blocks(docs: DataFrame, pattern: str, root: str, buckets: int) -> DataFrame:
    """bucket, file, start, words: the distinct pre-tokens of each chunk, a block for each bucket of words. file has the chunk's documents,
    start is the number of the block's first word.

    A chunk's file is named by what is in it, so a repeated attempt makes the same file and rows.
    """
    import regex

    cut = regex.compile(pattern).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (keys, entries, lengths, words) in enumerate(_chunks(batches, cut)):
            coded = [w.encode() for w in words]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in coded), np.int64, len(coded))
            order = np.argsort(bucket, kind="stable")  # in blocks words are numbered anew
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            # in the file frequent words have small numbers, which take less room
            common = np.argsort(-np.bincount(entries, minlength=len(words)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[common] = np.arange(len(order), dtype=np.int32)
            arrays = key_arrays(keys) | {"lengths": lengths, "entries": rank[entries], "places": place[common]}
            name = f"{task}-{k}-{zlib.crc32(b''.join(a.tobytes() for a in arrays.values())):08x}"
            write_arrays(root, name, arrays)
            starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts = [(b, starts[b], [coded[j] for j in order[starts[b] : starts[b + 1]].tolist()]) for b in np.flatnonzero(np.diff(starts)).tolist()] or [(0, 0, [])]
            for at in range(0, len(parts), 64):
                part = parts[at : at + 64]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _, _ in part], pa.int32()), "file": [name] * len(part), "start": pa.array([s for _, s, _ in part], pa.int32()), "words": pa.array([block_of(w) for _, _, w in part], pa.binary())})

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, file string, start int, words binary")


def block_of(values: list[bytes]) -> bytes:
    """Byte strings as one compressed block: how many, their lengths, then all of them."""
    lengths = np.fromiter(map(len, values), np.uint32, len(values))
    return zstandard.compress(b"".join([struct.pack("<I", len(values)), lengths.view(np.uint8).reshape(-1, 4).T.tobytes(), *values]), 3)


def lengths_and_bytes(block: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(block)
    (n,) = struct.unpack_from("<I", raw)
    return np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n).T.copy().view(np.uint32).ravel().astype(np.int64), raw[4 + 4 * n :]


def _ids_of_blocks(ranks_path: str, pattern: str) -> Arrow:
    """file, start, ids of blocks that come sorted by bucket: a bucket's words are encoded where they come first, and held until the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, open_bucket, known = encoding(ranks_path, pattern).encode_ordinary, None, {}
        for batch in batches:
            out = []
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if bucket != open_bucket:
                    open_bucket, known = bucket, {}
                lengths, raw = lengths_and_bytes(block)
                ends, at, ids = np.cumsum(lengths).tolist(), 0, []
                for end in ends:
                    word, at = raw[at:end], end
                    if word not in known:
                        known[word] = array("i", encode(word.decode())).tobytes()
                    ids.append(known[word])
                out.append(block_of(ids))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, pa.binary())], ["file", "start", "ids"])

    return run


def _documents_of_chunks(root: str) -> Arrow:
    """doc_id, ids of the documents of each chunk, from the blocks' ids, which come sorted by file and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in by_chunk(batches):
            chunk = read_arrays(root, name)
            blocks = [lengths_and_bytes(b) for b in rows.column("ids").to_pylist()]
            sizes = np.concatenate([lengths for lengths, _ in blocks]) // 4
            if len(sizes) != len(chunk["places"]):
                raise ValueError(f"chunk {name} has {len(sizes)} answers for {len(chunk['places'])} words")
            flat = np.frombuffer(b"".join([raw for _, raw in blocks]), np.int32)
            starts, sizes = (np.cumsum(sizes) - sizes)[chunk["places"]], sizes[chunk["places"]]
            ends = np.concatenate([[0], np.cumsum(chunk["lengths"], dtype=np.int64)])
            keys = arrow_keys(chunk)
            for at in range(0, len(keys), 64):
                stop = min(at + 64, len(keys))
                entries = chunk["entries"][ends[at] : ends[stop]]
                ids = flat[expand(starts[entries], sizes[entries])]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sums(sizes[entries], np.diff(ends[at : stop + 1])))]), pa.int32())
                yield pa.RecordBatch.from_arrays([keys.slice(at, stop - at), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, ranks_path: str, pattern: str, then: Arrow = lambda batches: batches, schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """doc_id, ids (array of int) of every document: the ids of each match of the pattern in its text.

    then goes on with the batches in the same Python worker, if the ids themselves aren't wanted; schema is of what it returns.
    """
    n, root = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), run_dir(docs.sparkSession, "pre-tokens")
    blocks = _blocks(docs, pattern, root, max(1024, 4 * n))
    answers = blocks.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_ids_of_blocks(ranks_path, pattern), "file string, start int, ids binary")
    assemble = _documents_of_chunks(root)
    return answers.repartition(n, "file").sortWithinPartitions("file", "start").mapInArrow(lambda batches: then(assemble(batches)), schema)


def _lists(column: pa.ListArray) -> list[list[int]]:
    """The lists of a list column; null ones are empty."""
    ends = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b].tolist() if there else [] for a, b, there in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True)]


class Decimals(dict):
    """Numbers as text, each made once."""

    def __missing__(self, k: int) -> str:
        self[k] = text = str(k)
        return text


def _bytes_of_ids(ranks_path: str, place: int) -> Arrow:
    """Adds a column of bytes: the table of token bytes has a row per id of the vocabulary, so each worker holds it and joins by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = token_bytes(ranks_path)
        table = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            table[rank] = word
        at = table.__getitem__
        for batch in batches:
            done = [b"".join(map(at, x)) for x in _lists(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.binary())], [*batch.schema.names, "bytes"])

    return run


def decoded(ids: DataFrame, ranks_path: str) -> DataFrame:
    """ids and its other columns with `bytes`: the bytes of its tokens, joined in order."""
    small_batches(ids.sparkSession)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema)
    return ids.mapInArrow(_bytes_of_ids(ranks_path, ids.columns.index("ids")), f"{columns}, bytes binary")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """DIGESTS of (doc_id, ids, bytes)."""
    decimal = Decimals()
    for batch in batches:
        ids = _lists(batch.column(1))
        joined = [hashlib.sha256(" ".join(map(decimal.__getitem__, x)).encode()).hexdigest() for x in ids]
        content = [hashlib.sha256(x or b"").hexdigest() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(joined, pa.string()), pa.array(content, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op12_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Encode all documents and decode their ids."""
    ranks_path = ranks_path or default_ranks()
    decode = _bytes_of_ids(ranks_path, 1)
    return encoded(documents(spark, sf_dir), ranks_path, default_pattern(), lambda batches: digests(decode(batches)), DIGESTS)
