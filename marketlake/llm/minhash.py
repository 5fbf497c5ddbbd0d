"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF word shingles.

1. Weights. A five-word shingle weighs its count in the text times 1 + ln((1 + N) / (1 + df)) / ln(1 + N), with the exact df, for
   which every document counts. Chunks of texts send their different shingles, each once with its number of documents, in
   blocks by range of the hash; where a range's blocks meet the numbers are added, and each block gets its answer back. So
   a shingle that is in every text is one entry of each chunk, and no task holds more than a range or a chunk.
2. Signatures. Improved consistent weighted sampling draws for each hash the shingle and level (k, t) that two weighted sets
   share with a probability of their weighted Jaccard similarity; its gamma and uniform variates come from tables indexed by
   hash bits. Each band takes ROWS of the DRAWS draws, and bands share draws: a pair at exactly 0.8 misses all BANDS bands
   with a probability of 1e-3, one at 0.9 hardly ever, and texts that share a common passage only seldom meet.
3. Verification. The texts of a bucket are compared with its leader only (a star), by exact weighted Jaccard similarity. The
   leader is the text that meets most others in all its buckets, so the original of many copies leads them. What isn't
   linked with its leader elects another one, as long as such rounds link enough. Then all pairs in different components
   of a leader's buckets that can be similar are found by prefixes of their differences from the group's center
   (could_be_alike()) and compared: no link that a bucket holds is lost, and no large group is paired with itself.
4. Components of the links; equal texts are one vertex, so thousands of copies cost one comparison.

Defined results: null counts as an empty text; texts without words are alike only if equal; a text of one to four words is
one shingle; a pair at exactly 0.8 is linked; whole texts count, however long; every row gets a class, that of its text;
class_id is the least doc_id of the class (null if all are null); repeated rows share a class; of rows tied for the least
doc_id one stays; columns besides doc_id and text pass through one_of_each() whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import by_chunk, chunks_of, read_arrays, write_arrays
from .common import Workspace, documents, free_name, save, small, small_batches
from .components import components
from .features import MIX, shingles

DRAWS, ROWS, BANDS = 48, 5, 32
#: Stars go on while a round links this share of the pairs that it compares.
WORTH = 0.1
#: A chunk is closed by the text that brings it to so many characters; ranges of hashes are as many as there are such chunks.
CHUNK = 4 << 20
SIMILARITY = 0.8


class Idf:
    """Weights of shingles among `rows` documents: of given document frequencies, or of known shingles (sorted hashes, their
    frequencies; others have 1)."""

    def __init__(self, rows: int, hashes: np.ndarray | None = None, df: np.ndarray | None = None):
        self.rows, self.hashes, self.df = rows, hashes, df

    def weights(self, df: np.ndarray) -> np.ndarray:
        # divided by its greatest value, so that a text isn't less like its copies for being copied often
        return 1 + np.log((1 + self.rows) / (1 + df.astype(float))) / max(float(np.log(1 + self.rows)), 1e-9)

    def of(self, hashes: np.ndarray, df: bytes | None = None) -> np.ndarray:
        """Weights of a text's sorted different shingles; df has their frequencies as packed() has them."""
        if df is not None:
            return self.weights(unpacked(df, len(hashes)))
        if self.hashes is None or not len(self.hashes):
            return self.weights(np.ones(len(hashes)))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.weights(np.where(self.hashes[at] == hashes, self.df[at], 1))


def packed(df: np.ndarray) -> bytes:
    """Frequencies, most of which are 1: a bit for each that isn't, then these as u32."""
    more = df > 1
    return np.packbits(more).tobytes() + df[more].astype("<u4").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    bits = (n + 7) // 8
    more = np.unpackbits(np.frombuffer(data, np.uint8, bits), count=n).view(bool)
    out = np.ones(n, dtype=np.int64)
    out[more] = np.frombuffer(data, "<u4", offset=bits)
    return out


def counted(all_shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values and how often each is there."""
    s = np.sort(all_shingles)
    if not len(s):
        return s, s
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[at], np.diff(at, append=len(s))


def weighted(texts: pa.Array, idf: Idf, df: pa.Array | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingle hashes of each text and their weights; df has each text's frequencies, where idf doesn't know them."""
    pairs = [counted(s) for s in shingles(texts)]
    return [(h, n * idf.of(h, its)) for (h, n), its in zip(pairs, df.to_pylist() if df is not None else [None] * len(pairs), strict=True)]


def weighted_copies(texts: pa.Array, idf: Idf, df: pa.Array | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """weighted() with one element for each copy of a shingle, so that weighted sets become plain ones."""
    out = []
    for found, its in zip(shingles(texts), df.to_pylist() if df is not None else [None] * len(texts), strict=True):
        h, n = counted(found)
        w = idf.of(h, its)
        if len(h) and n.max() > 1:
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            h, w = np.repeat(h, n) + nth.astype(np.uint64) * MIX, np.repeat(w, n)
            order = np.argsort(h)
            h, w = h[order], w[order]
        out.append((h, w))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    both = float(np.minimum(a[1][same], b[1][at[same]]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


class Sampler:
    """Improved consistent weighted sampling: 12 hash bits choose r, 12 choose c, 8 choose beta, for each shingle and draw."""

    LEVELS = 1 << 12

    def __init__(self, draws: int = DRAWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(0, 1 << 32, size=(draws, 1), dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 31, size=(draws, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.members = np.array([rng.choice(draws, ROWS, replace=False) for _ in range(BANDS)])
        # quantiles of Gamma(2, 1): 1 - (1 + x) exp(-x) = q, solved on a grid
        q = (np.arange(self.LEVELS) + 0.5) / self.LEVELS
        x = np.concatenate([np.linspace(1e-6, 0.05, 50_000), np.linspace(0.05, 30, 200_000)[1:]])
        gamma = np.interp(q, 1 - (1 + x) * np.exp(-x), x)
        self.r, self.ln_c = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.inv_r = (1 / gamma).astype(np.float32)

    def draw(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One number for each draw; equal where the drawn shingle and level are."""
        ln_w = np.log(weights).astype(np.float32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        step = max(1, (1 << 15) // len(hashes))
        return np.concatenate([self._some(hashes, short, ln_w, slice(k, k + step)) for k in range(0, len(self.seeds), step)])

    def _some(self, hashes: np.ndarray, short: np.ndarray, ln_w: np.ndarray, which: slice) -> np.ndarray:
        x = short ^ self.seeds[which]
        x *= np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        x *= self.odd[which]
        x ^= x >> np.uint32(13)
        at_r = (x & np.uint32(0xFFF)).astype(np.intp)
        at_c = ((x >> np.uint32(12)) & np.uint32(0xFFF)).astype(np.intp)
        beta = (x >> np.uint32(24)).astype(np.float32)
        beta += np.float32(0.5)
        beta *= np.float32(1 / 256)
        t = self.inv_r.take(at_r)
        t *= ln_w
        t += beta
        np.floor(t, out=t)
        score = t - beta
        score += np.float32(1)
        score *= self.r.take(at_r)
        np.subtract(self.ln_c.take(at_c), score, out=score)
        best = score.argmin(axis=1)
        rows = np.arange(len(best))
        return (hashes[best] ^ t[rows, best].astype(np.int64).astype(np.uint64)) * MIX

    def bands(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """BANDS numbers, each of ROWS draws and the band's own number."""
        draws = self.draw(hashes, weights)[self.members]
        out = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
        for k in range(ROWS):
            out = (out ^ draws[:, k]) * MIX
            out ^= out >> np.uint64(31)
        return out.view(np.int64)


def over_texts(docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str) -> DataFrame:
    """mapInArrow with a fresh worker state; make() gives a function of a batch, or of None at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            yield from each(batch)
        yield from each(None)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def planes(values: np.ndarray) -> bytes:
    """Numbers by the places of their bytes: high bytes, mostly zeros, stand together and shrink in the shuffle."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


BLOCK = "range int, chunk string, hashes binary, n binary"


def blocks_of_chunks(docs: DataFrame, ranges: int, root: str | None) -> DataFrame:
    """The different shingles of each chunk of docs (key, text), with their numbers of documents, a block for each range of hashes.

    The chunk's texts are kept below root, named by place, so a repeated attempt makes the same file and rows.
    """
    bounds = np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (keys, texts) in enumerate(chunks_of(batches, CHUNK)):
            name = f"{task}-{k}"
            raw = [t.encode() for t in texts]
            if root is not None:
                sizes = np.array([len(t) for t in raw], np.int64)
                write_arrays(root, name, {"keys": np.frombuffer(b"".join(keys), np.uint8), "sizes": sizes, "text": np.frombuffer(b"".join(raw), np.uint8)})
            del raw
            h, n = counted(np.concatenate([counted(s)[0] for part in parts_of(pa.array(texts, pa.large_string())) for s in shingles(part)]))
            ends = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
            some = [(r, s, e) for r, (s, e) in enumerate(zip(ends, ends[1:], strict=False)) if e > s]
            for at in range(0, len(some), 256):
                rows = some[at : at + 256]
                columns = [[r for r, _, _ in rows], [name] * len(rows), [planes(np.diff(h[s:e], prepend=np.uint64(0))) for _, s, e in rows], [planes(n[s:e].astype("<u4")) for _, s, e in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.string(), pa.binary(), pa.binary()], strict=True)], names=["range", "chunk", "hashes", "n"])
            if not some:  # a chunk without words has an answer too
                yield pa.RecordBatch.from_pydict({"range": pa.array([0], pa.int32()), "chunk": [name], "hashes": pa.array([b""], pa.binary()), "n": pa.array([b""], pa.binary())})

    small_batches(docs.sparkSession)
    return docs.select("key", "text").mapInArrow(cut, BLOCK)


def parts_of(texts: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    for at in range(0, len(texts), rows):
        yield texts.slice(at, rows)


def added(blocks: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each block's hashes; all different ones of a range, sorted, and in how many documents each is."""
    each = [np.cumsum(from_planes(b, "<u8"), dtype=np.uint64) for b in blocks.column("hashes").to_pylist()]
    n = np.concatenate([from_planes(b, "<u4") for b in blocks.column("n").to_pylist()]).astype(np.int64)
    all_ = np.concatenate(each)
    order = np.argsort(all_, kind="stable")
    all_, n = all_[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], all_[1:] != all_[:-1]])) if len(all_) else np.zeros(0, np.int64)
    return each, all_[starts], np.add.reduceat(n, starts) if len(starts) else n


def ranges_of(docs: DataFrame) -> tuple[int, int]:
    """The number of docs, and of ranges of hashes: one for each CHUNK characters of text."""
    rows, size = docs.agg(F.count("*"), F.sum(F.length("text"))).first()
    return rows, 1 + (size or 0) // CHUNK


def by_range(blocks: DataFrame) -> DataFrame:
    """The blocks, those of a range together; ranges are dealt evenly."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, "range").sortWithinPartitions("range")


def shingle_weights(docs: DataFrame, tables: Workspace) -> Idf:
    """Weights by shingle over all rows of docs (text), to look into a collection that fits the driver; links() doesn't gather them."""
    rows, ranges = ranges_of(docs)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in by_chunk(batches):
            _, h, df = added(table)
            yield pa.RecordBatch.from_pydict({"shingle": h[df > 1].view(np.int64), "df": df[df > 1]})

    found = by_range(blocks_of_chunks(docs.select(F.lit(b"").alias("key"), "text"), ranges, None)).mapInArrow(frequencies, "shingle long, df long").toPandas()
    hashes = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Idf(rows, hashes[order], found["df"].to_numpy(np.int64)[order])


def signatures(docs: DataFrame, tables: Workspace) -> tuple[DataFrame, Idf]:
    """key, bands and df (the packed document frequencies of its sorted different shingles) of docs (key, text) with words; and weights."""
    rows, ranges = ranges_of(docs)
    idf, root = Idf(rows), tables.folder("chunks")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, table in by_chunk(batches):
            each, h, df = added(table)
            for at in range(0, len(each), 64):
                some = each[at : at + 64]
                yield pa.RecordBatch.from_pydict({"chunk": table.column("chunk").slice(at, 64).combine_chunks(), "range": pa.array([r] * len(some), pa.int32()), "df": pa.array([planes(df[np.searchsorted(h, x)].astype("<u4")) for x in some], pa.binary())})

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for name, table in by_chunk(batches):
            chunk = read_arrays(root, name)
            df = np.concatenate([from_planes(b, "<u4") for b in table.column("df").to_pylist()])
            ends = np.concatenate([[0], np.cumsum(chunk["sizes"])])
            texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(chunk["text"]))
            sets = [counted(s) for part in parts_of(texts) for s in shingles(part)]
            words = counted(np.concatenate([h for h, _ in sets]))[0]
            if len(words) != len(df):
                raise ValueError(f"chunk {name} has {len(df)} answers for {len(words)} shingles")
            keys = chunk["keys"].tobytes()
            for at in range(0, len(sets), 256):
                rows = []
                for k, (h, n) in enumerate(sets[at : at + 256], at):
                    if len(h):
                        its = df[np.searchsorted(words, h)]
                        rows.append((keys[16 * k : 16 * k + 16], sampler.bands(h, n * idf.weights(its)), packed(its)))
                if rows:
                    flat = pa.array(np.concatenate([bands for _, bands, _ in rows]))
                    bands = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * BANDS, flat)
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), bands, pa.array([r[2] for r in rows], pa.binary())], names=["key", "bands", "df"])

    answers = by_range(blocks_of_chunks(docs, ranges, root)).mapInArrow(answer, "chunk string, range int, df binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = answers.repartition(n, "chunk").sortWithinPartitions("chunk", "range").mapInArrow(sign, "key binary, bands array<long>, df binary")
    signed = tables.save(signed, "signatures")
    tables.drop("chunks")
    return signed, idf


def verified(pairs: DataFrame, texts: DataFrame, idf: Idf) -> DataFrame:
    """a, b, similarity of the pairs (a, b); texts has each key's text and df once."""

    def make():
        def each(batch):
            if batch is None:
                return
            # equal leaders stand together often: each is worked on once in a batch
            leaders = batch.column("b").to_pylist()
            where = {b: k for k, b in enumerate(leaders)}
            at = pa.array(list(where.values()), pa.int64())
            once = dict(zip(where, weighted(batch.column("text_b").take(at), idf, batch.column("df_b").take(at)), strict=True))
            found = [similarity(a, once[b]) for a, b in zip(weighted(batch.column("text_a"), idf, batch.column("df_a")), leaders, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

        return each

    return over_texts(with_texts(pairs, texts), make, "a binary, b binary, similarity double")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    of = lambda side: texts.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}"), F.col("df").alias(f"df_{side}"))
    return pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "df_a", "text_b", "df_b")


def with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def links(docs: DataFrame, tables: Workspace, least: float = SIMILARITY) -> DataFrame:
    """(key, label): the component of every text that is similar to another one; docs has doc_id, text."""
    rows = with_key(docs.select("doc_id", "text"))
    signed, idf = signatures(rows, tables)
    bands = tables.save(signed.select("key", "bands").dropDuplicates(["key"]).select("key", F.explode("bands").alias("band")), "bands")
    sizes = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = tables.save(bands.join(sizes, "band"), "members")
    tables.drop("bands")
    popular = members.groupBy("key").agg(F.sum("n").alias("meets"))
    members = tables.save(members.drop("n").join(popular, "key"), "members")
    leaders = members.groupBy("band").agg(F.max(F.struct("meets", "key"))["key"].alias("leader"))
    members = tables.save(members.join(leaders, "band"), "members")

    # each text that meets another, once: equal texts shrink to their least doc_id before any text moves
    needed = members.select("key").distinct()
    one = rows.select("key", "doc_id").join(needed, "key").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    one = small(tables.save(one, "text-keys"))
    found = rows.join(one, (rows["key"] == one["key"]) & rows["doc_id"].eqNullSafe(one["doc_id"]), "left_semi")
    texts = found.groupBy("key").agg(F.first("text").alias("text"))
    df = signed.join(needed, "key", "left_semi").groupBy("key").agg(F.min("df").alias("df"))  # equal texts have equal ones
    texts = tables.save(texts.join(df, "key"), "texts")
    tables.drop("text-keys", "signatures")

    seen = None
    rest = members.select("band", "key", "meets", "leader")
    while True:  # stars: each bucket's rest with its leader; who isn't linked with it is the rest of the next round
        pairs = rest.where("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
        pairs = tables.save(pairs if seen is None else unseen(pairs, seen), "pairs")
        new = tables.save(verified(pairs, texts, idf), "new")
        seen = tables.save(new if seen is None else seen.union(new), "seen")
        compared, linked = new.count(), new.where(F.col("similarity") >= least).count()
        labels = components(seen.where(F.col("similarity") >= least), tables)
        if linked < WORTH * compared or not compared:
            break
        own = labels.select("key", F.col("label").alias("own"))
        of_leader = labels.select(F.col("key").alias("leader"), F.col("label").alias("other"))
        apart = rest.join(own, "key", "left").join(of_leader, "leader", "left").where(F.coalesce("own", "key") != F.coalesce("other", "leader"))
        apart = tables.save(apart.select("band", "key", "meets"), "apart")
        leaders = apart.groupBy("band").agg(F.max(F.struct("meets", "key"))["key"].alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
        rest = tables.save(apart.join(leaders, "band"), "rest")
    tables.drop("apart", "rest", "new")

    near = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = near.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
    group = near.join(mixed, "band").select(F.col("key").alias("a"), F.col("leader").alias("b"), "label").distinct()
    group = tables.save(group, "group")
    tables.drop("members")
    pairs = tables.save(unseen(could_be_alike(group, texts, idf, least, tables), seen), "pairs")
    if not pairs.isEmpty():
        new = tables.save(verified(pairs, texts, idf).where(F.col("similarity") >= least).select("a", "b"), "new")
        labels = components(seen.where(F.col("similarity") >= least).select("a", "b").union(new), tables, "labels-all")
        tables.drop("labels")
    tables.drop_all_but("labels", "labels-all")
    return labels


def unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """The different pairs (a, b) that seen doesn't have, whichever way round."""
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    return pairs.select(*ordered).distinct().join(seen.select(*ordered), ["a", "b"], "left_anti")


def differences(group: DataFrame, texts: DataFrame, idf: Idf) -> DataFrame:
    """a, b and what text a has besides its leader b (e, w) and lacks of it (lack_e, lack_w), and what they share."""

    def make():
        def each(batch):
            if batch is None:
                return
            leaders = batch.column("b").to_pylist()
            where = {b: k for k, b in enumerate(leaders)}
            at = pa.array(list(where.values()), pa.int64())
            once = dict(zip(where, weighted_copies(batch.column("text_b").take(at), idf, batch.column("df_b").take(at)), strict=True))
            rows = []
            for b, (ha, wa) in zip(leaders, weighted_copies(batch.column("text_a"), idf, batch.column("df_a")), strict=True):
                hb, wb = once[b]
                extra, lacks = ~np.isin(ha, hb, assume_unique=True), ~np.isin(hb, ha, assume_unique=True)
                rows.append((float(wa[~extra].sum()), ha[extra].view(np.int64), wa[extra], hb[lacks].view(np.int64), wb[lacks]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.float64(), *[pa.list_(pa.int64()), pa.list_(pa.float64())] * 2], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], names=["a", "b", "same", "e", "w", "lack_e", "lack_w"])

        return each

    return over_texts(with_texts(group, texts), make, "a binary, b binary, same double, e array<long>, w array<double>, lack_e array<long>, lack_w array<double>")


def from_center(differ: DataFrame) -> DataFrame:
    """The differences (a, b, same, e, w, lack_e, lack_w, moves) from the group's center instead of its leader.

    moves (e, w, sign) says by what the center differs from the leader. Gives, for each text: weight, shared (weight that it
    has of the center), lacks (weight that it lacks of it), and its differences e in one order, what it has besides (the
    first n_extra) before what it lacks, heavier ones first, with the weight from each on (tail).
    """

    def make():
        def each(batch):
            if batch is None:
                return
            rows = []
            for row in batch.to_pylist():
                more = {e: w for e, w in zip(row["e"], row["w"], strict=True)}
                less = {e: w for e, w in zip(row["lack_e"], row["lack_w"], strict=True)}
                same = row["same"]
                for m in row["moves"] or []:  # into the center (+) or out of it (-)
                    e, w = m["e"], m["w"]
                    if m["sign"] > 0:
                        if e in more:
                            same += more.pop(e)
                        else:
                            less[e] = w
                    elif e in less:
                        del less[e]
                    else:
                        more[e] = w
                        same -= w
                order = sorted(more, key=lambda e: (-more[e], e)) + sorted(less, key=lambda e: (-less[e], e))
                w = np.array([more[e] if k < len(more) else less[e] for k, e in enumerate(order)])
                extra, lacks = float(w[: len(more)].sum()), float(w[len(more) :].sum())
                rows.append((same + extra, same, lacks, len(more), order, np.cumsum(w[::-1])[::-1]))
            types = [pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], names=["a", "b", "weight", "shared", "lacks", "n_extra", "e", "tail"])

        return each

    return over_texts(differ, make, "a binary, b binary, weight double, shared double, lacks double, n_extra int, e array<long>, tail array<double>")


def could_be_alike(group: DataFrame, texts: DataFrame, idf: Idf, least: float, tables: Workspace) -> DataFrame:
    """a, b: texts of one group (a, b: its leader, label) in different components that can be similar.

    Two texts are similar if their common weight is at least least / (1 + least) of their weights' sum. With the group's
    center C, the shingles that most of the group have, the common weight is at most what the poorer in C has of C, plus
    what both have besides C. So a text is similar to another one only if

    - they share what neither has from C, of at least `need`, the weight that its own part of C falls short of; or
    - it has enough of C alone (need <= 0). If it isn't similar to the group's best text z (the one with the least c =
      what it lacks of C + its share of its own weight), it shares with any similar text differences from C, extra or
      lacking, of c + c(z) - weight(C) at least.

    Either way the first difference that both have, in an order common to all texts, stands in both texts' prefixes: all
    but the last ones, which together weigh less than the need. Texts are joined on their prefixes only; rare differences
    come first, so that what a large group has in common isn't joined. At each difference the texts of the label that
    most have aren't joined with each other.
    """
    share = least / (1 + least)
    differ = tables.save(differences(group, texts, idf), "differ")
    of_group = differ.groupBy("b").agg(F.count("*").alias("n"))
    more = differ.select("b", F.explode(F.arrays_zip("e", "w")).alias("d"), F.lit(1).alias("sign"))
    less = differ.select("b", F.explode(F.arrays_zip(F.col("lack_e").alias("e"), F.col("lack_w").alias("w"))).alias("d"), F.lit(-1).alias("sign"))
    most = more.union(less).groupBy("b", F.col("d.e").alias("e"), "sign").agg(F.count("*").alias("k"), F.max("d.w").alias("w"))
    # what more than half of a group differ in: less than twice a text's differences
    moves = most.join(of_group, "b").where("2 * k > n").groupBy("b").agg(F.collect_list(F.struct("e", "w", "sign")).alias("moves"))
    moves = tables.save(moves, "moves")
    placed = tables.save(from_center(differ.join(moves, "b", "left")), "placed")
    tables.drop("differ", "moves")
    placed = placed.withColumn("c", F.col("lacks") + share * F.col("weight"))
    best = placed.groupBy("b").agg(F.min(F.struct("c", "a", "weight", "shared")).alias("z"), F.min("weight").alias("lightest"))
    best = tables.save(best, "best")
    need = F.greatest(least * F.col("weight"), share * (F.col("weight") + F.col("lightest"))) - F.col("shared")
    short = F.col("c") + F.col("z.c") - F.col("shared") - F.col("lacks")
    labels = group.select("a", "b", "label")
    placed = placed.join(best, "b").join(labels, ["a", "b"]).withColumns({"need": need, "short": short, "extra": F.col("weight") - F.col("shared")})

    of_z = labels.select("b", F.col("a").alias("z_a"), F.col("label").alias("z_label"))
    to_z = placed.join(of_z, (placed["b"] == of_z["b"]) & (placed["z.a"] == of_z["z_a"])).where("label <> z_label")
    room = F.least("shared", "z.shared") + F.least(F.col("extra"), F.col("z.weight") - F.col("z.shared"))
    to_z = tables.save(to_z.where(share * (F.col("weight") + F.col("z.weight")) <= room + 1e-6).select("a", F.col("z_a").alias("b")), "to-best")

    in_prefix = lambda x: F.when(F.col("need") > 1e-6, x["at"] < F.col("n_extra")).otherwise(True) & (
        F.when(F.col("need") > 1e-6, x["tail"] - F.col("lacks") >= F.col("need") - 1e-6).otherwise(x["tail"] >= F.col("short") - 1e-6)
    )
    entries = F.filter(F.transform("e", lambda e, k: F.struct(k.alias("at"), e.alias("e"), F.get("tail", k).alias("tail"))), in_prefix)
    rows = placed.select(F.col("b").alias("g"), "a", "label", "weight", "shared", "extra", "n_extra", F.explode(entries).alias("d"))
    rows = tables.save(rows.select("g", F.col("d.e").alias("e"), (F.col("d.at") < F.col("n_extra")).alias("besides"), "a", "label", "weight", "shared", "extra"), "prefixes")
    tables.drop("placed", "best")
    usual = rows.groupBy("g", "e", "label").agg(F.count("*").alias("n")).groupBy("g", "e").agg(F.max(F.struct("n", "label"))["label"].alias("usual"), F.count("*").alias("labels")).where("labels > 1")
    rows = tables.save(rows.join(usual.select("g", "e", "usual"), ["g", "e"]), "met")
    x = rows.where("label <> usual").alias("x")
    y = rows.alias("y")
    col = lambda name: (F.col(f"x.{name}"), F.col(f"y.{name}"))
    sum_of, least_of = lambda name: col(name)[0] + col(name)[1], lambda name: F.least(*col(name))
    apart = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("x.usual")) | (F.col("x.a") < F.col("y.a")))
    sized = F.least(*col("weight")) >= least * F.greatest(*col("weight")) - 1e-6
    fits = share * sum_of("weight") <= least_of("shared") + F.when(F.col("x.besides"), least_of("extra")).otherwise(0.0) + 1e-6
    met = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.e") == F.col("y.e")) & apart & sized & fits)
    return to_z.union(met.select(F.col("x.a").alias("a"), F.col("y.a").alias("b")))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, key, class (the key that stands for the class) of every row."""
    rows = with_key(docs.select("doc_id", "text")).select("doc_id", "key")
    tables = Workspace(docs.sparkSession, "minhash")
    return rows.join(links(docs, tables, least), "key", "left").select("doc_id", "key", F.coalesce("label", "key").alias("class"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of the least doc_id, with the columns that came, whatever their names."""
    found = save(classes(docs.select("doc_id", "text"), least), "classes")
    best = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best"))
    keep = best.select(F.col("best.doc_id").alias("id"), F.col("best.key").alias("key"))
    copies = found.groupBy(F.col("doc_id").alias("id"), "key").agg(F.count("*").alias("n"))
    keep = keep.alias("k").join(copies.alias("c"), F.col("k.id").eqNullSafe(F.col("c.id")) & (F.col("k.key") == F.col("c.key"))).select("k.id", "k.key", "n")
    keep = save(keep, "keep")
    name = free_name(docs.columns, "key")
    rows = docs.withColumn(name, F.unhex(F.md5(F.coalesce("text", F.lit("")))))

    def those(some: DataFrame) -> DataFrame:
        return rows.join(some, (rows[name] == some["key"]) & rows["doc_id"].eqNullSafe(some["id"]), "left_semi")

    once = those(keep.where("n = 1"))
    if keep.where("n > 1").isEmpty():
        return once.drop(name)
    return once.union(those(keep.where("n > 1")).dropDuplicates(["doc_id", name])).drop(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id and class size of every document."""
    found = save(classes(documents(spark, sf_dir)), "classes")
    sizes = found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(sizes, "class").select("doc_id", "class_id", "class_size")
