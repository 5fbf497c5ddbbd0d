"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

The ends of a text's tokens, as byte offsets, are the keys of one dictionary per tokenizer (end -> index); the ends that both have, in
order, cut both id lists into groups, and each group links all its tokens of one tokenizer with all of the other. How often an id
pair is linked is counted in documents over the whole corpus.

A text is cut where no token of either side can go over (JOINTS), so that a cut is a common end, and every distinct piece of a chunk is
tokenized and aligned once (`Pieces`); where a vocabulary has a token with such a place in it, or a piece's bytes don't come back, the
text is taken whole. Pairs are counted per chunk before any shuffle; each chunk has one row per pair, sent to the
pair's count and back to the chunk, whose file keeps the documents (`chunks`). So no link is shuffled and a frequent pair is no hot key.

Defined results: documents whose text is null or empty, or whose tokens' bytes differ from a blank and the text in either tokenizer, have no
tokens: zeros and an empty column; whole texts count, however long; strings of special tokens are plain text; null doc_ids keep
their rows and count as documents; repeated rows count one by one; ties for the highest count all count; other columns, with
whatever names, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import WHITE, Numbers, arrow_keys, by_chunk, chunks_of, expand, key_arrays, read_arrays, sums, write_arrays
from .common import documents, run_dir, save, small_batches

SPACE, OTHER = f"[{WHITE}]", f"[^{WHITE}]"
#: Where tokens of both sides end if no vocabulary has such a place within a token: before a blank or line end that follows something
#: else, and before a full stop or comma that follows a plain letter.
JOINTS = re.compile(f"(?<={OTHER})(?=[ \n])|(?<=[A-Za-z])(?=[.,])")
#: The pieces between joints, in one pass.
CUT = re.compile(f"(?:{SPACE}+|(?=.))[.,]*(?:[^{WHITE}.,]+(?:(?<![A-Za-z])[.,]+)?|(?![ \n]){SPACE}+[.,]*)*", re.DOTALL)
#: So many links of documents are expanded at once.
LINKS_AT_ONCE = 2_000_000
#: So many texts are cut and their new pieces tokenized at once.
TEXTS_AT_ONCE = 256
#: A chunk is closed by the text that brings it to so many bytes; what is known of its pieces takes several times as much.
CHUNK_BYTES = 20 << 20


def byte_alphabet() -> dict[str, int]:
    """Character of byte-level vocabularies: byte. Printable bytes stand for themselves, the others follow from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokens:
    """A side's tokenizer: ids of texts with a blank before each, and the bytes of each id."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
            hexed = re.compile("<0x([0-9A-F]{2})>")
            self.table = [bytes([int(m[1], 16)]) if (m := hexed.fullmatch(n)) else n.replace("▁", " ").encode() for n in names]
            lead = model.encode("a", num_threads=1)

            def ids(texts: list[str]) -> list[list[int]]:
                """The model puts a blank before each text: those that begin otherwise follow a letter, whose token is taken off again."""
                out = model.encode([t[1:] if t[0] == " " else f"a{t}" for t in texts], num_threads=1)
                for k, t in enumerate(texts):
                    if t[0] != " ":
                        if out[k][: len(lead)] != lead:
                            raise ValueError("the model joins tokens where JOINTS cuts")
                        out[k] = out[k][len(lead) :]
                return out

            self.ids = ids
        else:
            from tokenizers import Tokenizer

            model, letters = Tokenizer.from_file(path), byte_alphabet()
            model.encode_special_tokens = True
            names = [model.id_to_token(k) for k in range(model.get_vocab_size())]
            self.table = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]
            self.ids = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.lengths = np.array([len(w) for w in self.table], np.int64)
        self.names = list(map(str, range(len(self.table))))
        self.hollow = bool((self.lengths == 0).any())  # a token of no bytes
        probe = " one two, three's 4.5\n six\t sev en \ufe0fx"
        inside = any(JOINTS.search(t.decode(errors="replace")) for t in self.table)
        self.by_piece = not inside and self.ids([probe])[0] == [k for ids in self.ids(pieces_of(probe)) for k in ids]

    def joined(self, ids: list[int]) -> bytes:
        return b"".join([self.table[k] for k in ids])


def pieces_of(text: str) -> list[str]:
    return [p for p in CUT.findall(text) if p]


@lru_cache(maxsize=1)
def tokenizers_of(a_path: str, b_path: str) -> tuple[Tokens, Tokens]:
    """Both sides' tokenizers, read once by each Python worker."""
    return Tokens(a_path), Tokens(b_path)


def groups(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int]]:
    """(end, tokens of a up to it, tokens of b up to it) of the common ends, in order. A token of no bytes goes with the one before it."""
    last_a, last_b = {e: k for k, e in enumerate(a_ends, 1)}, {e: k for k, e in enumerate(b_ends, 1)}
    return [(e, last_a[e], last_b[e]) for e in sorted(last_a.keys() & last_b.keys())]


class Pieces:
    """The distinct pieces of a chunk by number: n_a, n_b, n_groups, the groups as text, and links (a << 32 | b)."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a, b
        self.cut = pieces_of if a.by_piece and b.by_piece else lambda text: [text]
        self.number: dict[str, int] = {}  # -1 if a piece's bytes don't come back
        self.texts: list[str] = []
        self.shapes: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def rows(self, texts: list[str]) -> list[list[int]]:
        """For each text the numbers of the pieces of a blank and the text; none if the text has no tokens."""
        cut = [self.cut(f" {t}") if t else [] for t in texts]
        self._learn({p: None for row in cut for p in row})
        number = self.number
        out = [[number[p] for p in row] for row in cut]
        # where a piece's bytes don't come back, only the whole text tells
        broken = [k for k, row in enumerate(out) if row and min(row) < 0]
        self._learn({f" {texts[k]}": None for k in broken})
        for k in broken:
            out[k] = [n for n in (number[f" {texts[k]}"],) if n >= 0]
        return out

    def _learn(self, pieces: dict[str, None]) -> None:
        new = [p for p in pieces if p not in self.number]
        if not new:
            return
        a, b = self.a.ids(new), self.b.ids(new)
        coded = [p.encode() for p in new]
        if not (self._alike(self.a, a, coded) and self._alike(self.b, b, coded)):
            fine = [k for k, w in enumerate(coded) if w == self.a.joined(a[k]) == self.b.joined(b[k])]
            self.number |= dict.fromkeys(new, -1)
            new, a, b, coded = ([x[k] for k in fine] for x in (new, a, b, coded))
        self.number |= zip(new, range(len(self.texts), len(self.texts) + len(new)), strict=True)
        # a token of no bytes at a piece's beginning would go with the piece before it
        step = 1 if self.a.hollow or self.b.hollow else max(1, len(new))
        for at in range(0, len(new), step):
            self._align(*[list(chain.from_iterable(x[at : at + step])) for x in (a, b)], np.fromiter(map(len, coded[at : at + step]), np.int64))

    @staticmethod
    def _alike(side: Tokens, ids: list[list[int]], wanted: list[bytes]) -> bool:
        """Whether each piece's tokens have its bytes: all together they are the same, and each has its number."""
        flat = np.fromiter(chain.from_iterable(ids), np.int64)
        each = sums(side.lengths[flat], np.fromiter(map(len, ids), np.int64, len(ids)))
        return (each == np.fromiter(map(len, wanted), np.int64, len(wanted))).all() and side.joined(flat.tolist()) == b"".join(wanted)

    def _align(self, a: list[int], b: list[int], sizes: np.ndarray) -> None:
        """Align pieces of so many bytes laid one after the other: the end of each is an end in both tokenizers, so no group reaches over it."""
        flat_a, flat_b = np.array(a, np.int64), np.array(b, np.int64)
        found = groups(np.cumsum(self.a.lengths[flat_a]).tolist(), np.cumsum(self.b.lengths[flat_b]).tolist())
        ends, to_a, to_b = (np.array(c, np.int64) for c in zip(*found, strict=True))
        each = np.diff(np.searchsorted(ends, np.cumsum(sizes), "right"), prepend=0)
        words_a, words_b = [self.a.names[k] for k in a], [self.b.names[k] for k in b]
        i = j = 0
        texts = []
        for _, k, m in found:
            texts.append(f"{','.join(words_a[i:k])}|{','.join(words_b[j:m])}")
            i, j = k, m
        at = 0
        for n in each.tolist():
            self.texts.append(";".join(texts[at : at + n]))
            at += n
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        self.shapes.append(np.stack([sums(n_a, each), sums(n_b, each), each], axis=1))
        self.sizes.append(sums(n_a * n_b, each))
        # each token of a meets all of b's in its group
        many = np.repeat(n_b, n_a)
        met = flat_b[expand(np.repeat(to_b - n_b, n_a), many)]
        self.links.append(np.repeat(flat_a << 32, many) | met)


SHAPE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _pairs(docs: DataFrame, a_path: str, b_path: str, root: str) -> DataFrame:
    """chunk, entry, pair, n_docs: the distinct pairs of each chunk and in how many of its documents they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers_of(a_path, b_path)
        task = TaskContext.get()
        for k, (keys, texts) in enumerate(chunks_of(batches, CHUNK_BYTES)):
            chunk, name = (task.partitionId() << 16) + k, f"{task.partitionId()}-{k}-{task.taskAttemptId()}"
            pieces, sha, rows = Pieces(a, b), [], []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                for row in pieces.rows(texts[at : at + TEXTS_AT_ONCE]):
                    sha.append(hashlib.sha256(";".join([pieces.texts[k] for k in row]).encode()).hexdigest() if row else "")
                    rows.append(np.array(row, np.int32))
            n = np.concatenate([*pieces.shapes, np.zeros((0, 3), np.int64)])
            sizes = np.concatenate([*pieces.sizes, np.zeros(0, np.int64)])
            coded = np.concatenate([*pieces.links, np.zeros(0, np.int64)])
            del pieces, texts
            pairs, entries = np.unique(coded, return_inverse=True)
            starts, lengths = np.cumsum(sizes) - sizes, np.array([len(r) for r in rows], np.int64)
            sequence = np.concatenate(rows)
            of_doc = np.repeat(np.arange(len(rows)), lengths)
            # in how many documents each pair is, some documents at a time
            n_docs, weight, at = np.zeros(len(pairs), np.int64), sums(sizes[sequence], lengths), 0
            ends = np.cumsum(lengths)
            while at < len(rows):
                stop = max(at + 1, int(np.searchsorted(np.cumsum(weight[at:]), LINKS_AT_ONCE)) + at)
                part = slice(ends[at] - lengths[at], ends[stop - 1])
                each = entries[expand(starts[sequence[part]], sizes[sequence[part]])]
                once = np.unique(np.repeat(of_doc[part] - at, sizes[sequence[part]]) * len(pairs) + each)
                n_docs += np.bincount(once % max(1, len(pairs)), minlength=len(pairs))
                at = stop
            totals = {c: sums(n[sequence, k], lengths) for k, c in enumerate(("n_a", "n_b", "n_groups"))}
            digests = np.frombuffer("".join(s.ljust(64) for s in sha).encode(), np.uint8)
            write_arrays(root, name, key_arrays(keys) | totals | {"lengths": lengths, "sequence": sequence, "sizes": sizes.astype(np.int32), "entries": entries.astype(np.int32), "sha": digests, "pairs": np.array([len(pairs)])})
            # the entry without a number has the attempt that wrote the chunk's file
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "entry": pa.array([None], pa.int32()), "pair": pa.array([None], pa.int64()), "n_docs": pa.array([task.taskAttemptId()], pa.int64())})
            for at in range(0, len(pairs), 100_000):
                stop = min(at + 100_000, len(pairs))
                yield pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(stop - at, chunk, np.int64)), "entry": pa.array(np.arange(at, stop), pa.int32()), "pair": pa.array(pairs[at:stop]), "n_docs": pa.array(n_docs[at:stop])})

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "chunk long, entry int, pair long, n_docs long")


def link_counts(entries: DataFrame) -> DataFrame:
    """pair, count, best: in how many documents of the corpus a pair is linked, and whether that is its first id's highest count."""
    counts = save(entries.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n_docs").alias("count")), "pair-counts")
    left = F.shiftright("pair", 32).alias("a")
    highest = counts.groupBy(left).agg(F.max("count").alias("highest"))
    # `highest` has a row per id of the first tokenizer's vocabulary at most
    return counts.withColumn("a", left).join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    n, root = int(spark.conf.get("spark.sql.shuffle.partitions")), run_dir(spark, "aligned")
    entries = save(_pairs(docs, a_path, b_path, root), "aligned-pairs")
    files = entries.where("pair IS NULL").select("chunk", "entry", F.col("n_docs").alias("count"), F.lit(False).alias("best"))
    answers = entries.join(link_counts(entries), "pair").select("chunk", "entry", "count", "best").union(files)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in by_chunk(batches):
            attempt = rows.filter(pc.is_null(rows.column("entry"))).column("count").to_pylist()
            name = f"{number >> 16}-{number & 0xFFFF}-{attempt[0]}"
            chunk, rows = read_arrays(root, name), rows.filter(pc.is_valid(rows.column("entry")))
            n_pairs = int(chunk["pairs"][0])
            if rows.num_rows != n_pairs or len(attempt) != 1:
                raise ValueError(f"chunk {name} has {rows.num_rows} answers for {n_pairs} pairs")
            count, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
            entry = rows.column("entry").to_numpy()
            count[entry], best[entry] = rows.column("count").to_numpy(), rows.column("best").to_numpy()
            lengths, sequence, sizes, places = (chunk[k] for k in ("lengths", "sequence", "sizes", "entries"))
            per_piece = {"n_links": np.ones(len(places), np.int64), "n_best": best[places], "count_sum": count[places]}
            totals = {c: sums(sums(v, sizes)[sequence], lengths) for c, v in per_piece.items()}
            sha = chunk["sha"].tobytes().decode()
            digests = [sha[k : k + 64].strip() for k in range(0, len(sha), 64)]
            columns = [arrow_keys(chunk), *[pa.array(chunk[c]) for c in ("n_a", "n_b", "n_groups")], *[pa.array(v) for v in totals.values()], pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SHAPE.split(", ")])

    return answers.repartition(n, "chunk").sortWithinPartitions("chunk").mapInArrow(assemble, SHAPE)


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, position, a_ids, b_ids: the groups of every document, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers_of(a_path, b_path)
        for batch in batches:
            pieces = Pieces(a, b)
            for key, row in zip(batch.column(0).to_pylist(), pieces.rows([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                found = [[[int(k) for k in side.split(",")] for side in g.split("|")] for n in row for g in pieces.texts[n].split(";")]
                columns = [pa.array([key] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), *[pa.array([g[k] for g in found], pa.list_(pa.int32())) for k in (0, 1)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "position", "a_ids", "b_ids"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, position int, a_ids array<int>, b_ids array<int>")


def op13_alignment(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Align both tokenizers' tokens of all documents and count links over the corpus."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    return aligned(documents(spark, sf_dir), a_path, b_path)
