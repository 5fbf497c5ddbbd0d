"""Chunks of documents: stretches of a task's texts with a dictionary of their own, kept in files of the shared folder.

A dictionary's entries travel through Spark's shuffles as rows (chunk, entry); the documents' sequences of entries stay in the
chunk's file until the answers for its entries come back, so no text or sequence is shuffled. Files are complete as soon as they can be
seen; those of failed attempts are never read or equal the ones that are.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard

from .common import file_system

#: A chunk is closed by the text that brings it to so many bytes.
CHUNK_BYTES = 48 << 20
#: Fixed: the characters that Unicode calls white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A text's pieces: white space and what follows it. Each begins where white space follows something else, or with the text.
PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def write_arrays(root: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of named arrays of numbers: header length u32, header JSON, then all their bytes, like places of a number together, under zstd."""
    fs, path = file_system(root)
    fs.create_dir(path)
    head = json.dumps([(k, a.dtype.str, len(a)) for k, a in arrays.items()]).encode()
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays.values() if len(a))
    temporary = f"{path}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as f:
        f.write(struct.pack("<I", len(head)) + head + zstandard.compress(planes, 3))
    try:
        fs.move(temporary, f"{path}/{name}")
    except OSError:  # a store that doesn't move over what an earlier attempt made
        if fs.get_file_info(f"{path}/{name}").type == pa.fs.FileType.NotFound:
            raise
        fs.delete_file(temporary)


def read_arrays(root: str, name: str) -> dict[str, np.ndarray]:
    fs, path = file_system(root)
    with fs.open_input_stream(f"{path}/{name}") as f:
        data = f.read()
    (n,) = struct.unpack("<I", data[:4])
    raw, at, out = zstandard.decompress(data[4 + n :]), 0, {}
    for k, kind, length in json.loads(data[4 : 4 + n]):
        size = np.dtype(kind).itemsize
        out[k] = np.frombuffer(raw, np.uint8, length * size, at).reshape(size, length).T.copy().view(kind).ravel() if length else np.zeros(0, kind)
        at += length * size
    return out


class Numbers(dict):
    """Key: number, by first appearance."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of the runs that begin at starts and have these sizes, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of these sizes, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def chunks_of(batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts (null: empty) of each chunk."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= most:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | str, pa.Table]]:
    """The rows of each chunk, whose number or name is in the first column, of rows sorted by it; a chunk's dictionary is bounded by its text."""
    parts: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        names = batch.column(0)
        at = 0
        while at < len(batch):
            here = names[at].as_py()
            end = at + np.searchsorted(np.asarray(names.slice(at).to_numpy(zero_copy_only=False) != here, dtype=np.int8), 1)
            if here != name and parts:
                yield name, pa.Table.from_batches(parts)
                parts = []
            name = here
            parts.append(batch.slice(at, end - at))
            at = end
    if parts:
        yield name, pa.Table.from_batches(parts)


def key_arrays(keys: list) -> dict[str, np.ndarray]:
    """doc_ids and which of them are known."""
    return {"keys": np.array([k or 0 for k in keys], np.int64), "known": np.array([k is not None for k in keys], np.uint8)}


def arrow_keys(arrays: dict[str, np.ndarray]) -> pa.Array:
    return pa.array(arrays["keys"], mask=arrays["known"] == 0)
