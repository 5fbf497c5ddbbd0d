"""Token-ID / binary output: files of concatenated ids with Elias-Fano coded document boundaries.

A file holds the documents of one stretch of the doc_id order. Layout, little-endian:

    magic 8 bytes | header length u32 | header JSON | sections in the header's order

Sections: `ends` (Elias-Fano: id count after each document), `keys` (Elias-Fano: doc_id minus the file's least doc_id),
`ids` (the concatenated id array, u16 or u32). An Elias-Fano section has the low bits of each value packed together, the
high bits in unary as a bit vector, and a u32 directory with the place of every 64th set bit, by which select() finds any
boundary without a table of 64-bit offsets.

Defined results: a null text is empty and has the end id only; whole texts are encoded, however long; null doc_ids come before
all others; rows with equal doc_id follow each other in the order of the text's hash; other columns, with whatever names, are
ignored; an empty table gives no file and no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, file_system, run_dir, save, small_batches

MAGIC = b"MLTOKEF1"
DIRECTORY = 64
CHUNK = re.compile(r"[^ \t\r\n]+")
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: Fixed pattern: the tokenizer's own pre-tokens, over the characters of PLAIN in lower case.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
#: The tokenizer file's settings for which the cuts above hold. With any others whole texts are asked of the library.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}


class EliasFano:
    """A sorted sequence of non-negative integers in about 2 + log2(range / count) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if bits and n:
            flags = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(flags.astype(np.uint8).ravel(), bitorder="little")
        places = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        marks[places] = 1
        return cls(n, bits, low, np.packbits(marks, bitorder="little"), places[::DIRECTORY].astype("<u4"))

    def _low(self, i: int) -> int:
        value = 0
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            value |= ((int(self.low[at >> 3]) >> (at & 7)) & 1) << b
        return value

    def select(self, i: int) -> int:
        """The i-th value: jump to the directory's set bit, then count set bits from there, some bytes at once."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left, span = int(self.directory[i // DIRECTORY]), i % DIRECTORY, 16
        if left:
            byte = at >> 3
            while True:
                bits = np.unpackbits(self.high[byte : byte + span], bitorder="little")
                bits[: (at & 7) + 1] = 0
                places = np.flatnonzero(bits)
                if len(places) >= left:
                    at = 8 * byte + int(places[left - 1])
                    break
                span *= 2
        return ((at - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        """All values at once, for sequential reading."""
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        out = high.astype(np.int64) << self.low_bits
        if self.low_bits:
            flags = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, -1)
            out |= flags.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out

    def parts(self) -> tuple[dict, list[bytes]]:
        blobs = [self.low.tobytes(), self.high.tobytes(), self.directory.tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "sizes": [len(b) for b in blobs]}, blobs

    @classmethod
    def load(cls, head: dict, data: memoryview) -> EliasFano:
        a, b, c = head["sizes"]
        cut = [np.frombuffer(data[:a], np.uint8), np.frombuffer(data[a : a + b], np.uint8), np.frombuffer(data[a + b : a + b + c], "<u4")]
        return cls(head["n"], head["low_bits"], *cut)


def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    """A file of documents in ascending doc_id order; ids: their token ids, width bytes each."""
    known = [k for k in doc_ids if k is not None]
    base = known[0] if known else 0
    ends = EliasFano.encode(np.cumsum(np.asarray(lengths, dtype=np.int64)))
    keys = EliasFano.encode(np.array([k - base for k in known], dtype=np.uint64))
    (ends_head, ends_blobs), (keys_head, keys_blobs) = ends.parts(), keys.parts()
    head = json.dumps({"docs": len(lengths), "nulls": len(lengths) - len(known), "base": base, "width": width, "ends": ends_head, "keys": keys_head, "ids": len(ids)}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *ends_blobs, *keys_blobs, ids])


class TokenFile:
    """A file that pack() made."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token-id file")
        (n,) = struct.unpack("<I", view[8:12])
        head, at = json.loads(bytes(view[12 : 12 + n])), 12 + n
        sections = []
        for name in ("ends", "keys"):
            size = sum(head[name]["sizes"])
            sections.append(EliasFano.load(head[name], view[at : at + size]))
            at += size
        self.docs, self.nulls, self.base = head["docs"], head["nulls"], head["base"]
        self.ends, self.keys = sections
        if len(view) - at != head["ids"]:
            raise ValueError("the id array is cut short")
        self.ids = np.frombuffer(view[at:], "<u2" if head["width"] == 2 else "<u4")

    def tokens(self, i: int) -> np.ndarray:
        """The ids of the i-th document, found by select()."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + int(k) for k in self.keys.values()]


def cuts_hold(tokenizer_path: str) -> bool:
    """Whether a tokenizer (read once, on the driver) cuts as CHUNK and PIECE do: it lower-cases, drops white space, splits by the known pattern, ends words by a
    mark of their own and has no added tokens but those whose strings begin with <|."""
    with open(tokenizer_path, encoding="utf-8") as f:
        settings = json.load(f)
    first = ((settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    splits = first.get("type") == "Split" and first.get("pattern") == SPLIT and first.get("behavior") == "Removed" and first.get("invert") is True
    added = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in settings.get("added_tokens") or [])
    return splits and added and settings.get("normalizer") == NORMALIZER and bool(settings["model"].get("end_of_word_suffix"))


class ChunkEncoder:
    """Token ids of texts, each different piece asked of the library once and kept; a tokenizer for which the cuts don't hold (cuts_hold) is
    asked for whole texts.

    The dealt tokenizer joins nothing across white space, so a text is the sequence of its chunks. In chunks of ASCII and Latin-1
    letters its own pre-tokens are cut here too, by the same pattern (PIECE), as they repeat far more often than chunks;
    any other chunk, or one that may hold a special token's string, goes to the library whole. At most `most` pieces are
    kept: the older half goes when they are more.
    """

    def __init__(self, tokenizer_path: str, width: int, by_chunk: bool = True, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.most = Tokenizer.from_file(tokenizer_path), "<u2" if width == 2 else "<u4", most
        self.known: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.by_chunk = by_chunk

    def _room(self, known: dict[str, bytes]) -> None:
        if len(known) > self.most:
            for k in list(known)[: self.most // 2]:
                del known[k]

    def _learn(self, pieces: list[str]) -> None:
        """One call for many pieces: between blanks each is one pre-token, and word_ids says whose an id is."""
        self._room(self.known)
        e = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        ids, owners = np.array(e.ids, dtype=self.kind), np.array(e.word_ids, dtype=np.int64)
        if owners[-1] != len(pieces) - 1:
            raise ValueError("the tokenizer cuts words in another way than PIECE")
        at = np.searchsorted(owners, np.arange(len(pieces) + 1))
        for k, piece in enumerate(pieces):
            self.known[piece] = ids[at[k] : at[k + 1]].tobytes()

    def _plain(self, text: str) -> bytes:
        pieces = PIECE.findall(text.lower())
        known = self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            self._learn(list({p for p in pieces if p not in known}))
            missing = [p for p in set(pieces) if p not in known]
            if missing:
                self._learn(missing)
        return b"".join([known[p] for p in pieces])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_chunk:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()
        if PLAIN.fullmatch(text) and "<|" not in text:
            return self._plain(text)
        out = []
        for chunk in CHUNK.findall(text):
            if PLAIN.fullmatch(chunk) and "<|" not in chunk:
                out.append(self._plain(chunk))
                continue
            if chunk not in self.chunks:
                self._room(self.chunks)
                self.chunks[chunk] = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=self.kind).tobytes()
            out.append(self.chunks[chunk])
        return b"".join(out)


@lru_cache(maxsize=1)
def encoder_of(tokenizer_path: str, width: int, by_chunk: bool) -> ChunkEncoder:
    """The encoder of this Python worker; what it knows serves the worker's later tasks too."""
    return ChunkEncoder(tokenizer_path, width, by_chunk)


def default_tokenizer() -> str:
    """Path of the tokenizer that is used where none is given."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_width(tokenizer_path: str) -> int:
    """Bytes of an id: 2 for a vocabulary of up to 65,536, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4


def write_token_files(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int = 1, file_ids: int = 4_000_000) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the manifest (part, seq, path, n_docs, n_ids).

    Each task encodes one range of doc_ids and closes a file at file_ids ids, so memory doesn't grow with the range. A
    file is named by its task attempt and counts only when the manifest, which is written last, lists it: lost executors
    and repeated attempts leave unlisted files, never wrong rows.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = file_system(out_dir)
        encoder, end = encoder_of(tokenizer_path, width, by_chunk), end_id.to_bytes(width, "little")
        keys, lengths, blobs, size, seq = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{root}/part-{task.partitionId():06d}-{seq:05d}-{task.taskAttemptId()}.tok"
            with fs.open_output_stream(name) as f:
                f.write(pack(keys, lengths, b"".join(blobs), width))
            return pa.RecordBatch.from_pydict({"part": [task.partitionId()], "seq": [seq], "path": [name], "n_docs": [len(keys)], "n_ids": [size]})

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not seq and not keys:
                    fs.create_dir(root)
                data = encoder.encode(text) + end
                keys.append(key)
                lengths.append(len(data) // width)
                blobs.append(data)
                size += lengths[-1]
                if size >= file_ids:
                    yield close()
                    keys, lengths, blobs, size, seq = [], [], [], 0, seq + 1
        if keys:
            yield close()

    small_batches(docs.sparkSession)
    width, by_chunk = id_width(tokenizer_path), cuts_hold(tokenizer_path)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    return save(ordered.mapInArrow(write, "part long, seq long, path string, n_docs long, n_ids long"), "token-manifest")


def read_token_files(manifest: DataFrame, out_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the listed files."""
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq")
    files = manifest.withColumn("inside", F.sum("n_ids").over(within) - F.col("n_ids")).join(F.broadcast(before), "part")
    files = files.select("path", (F.col("part_start") + F.col("inside")).alias("start"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(out_dir)
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"], strict=True):
                with fs.open_input_stream(path) as f:
                    file = TokenFile(f.read())
                ends = file.ends.values()
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                sums = [zlib.crc32(file.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pd.DataFrame({"doc_id": pd.array(file.doc_ids(), dtype="Int64"), "start": starts + int(start), "n_tokens": ends - starts, "ids_crc32": np.array(sums, dtype=np.int64)})

    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n, "path").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_ids(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Encode all documents, write the files, read them back."""
    tokenizer_path = tokenizer_path or default_tokenizer()
    out_dir = run_dir(spark, "token-ids")
    manifest = write_token_files(documents(spark, sf_dir), tokenizer_path, out_dir)
    return read_token_files(manifest, out_dir)


