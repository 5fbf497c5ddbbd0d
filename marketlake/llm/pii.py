"""Personal data: exact base kinds, and bootstrapped contextual extraction of what they miss.

Base: leftmost non-overlapping matches per kind, checked (IP parts, Luhn, digit counts).

Bootstrap. The scan also notes every identifier-like token (a number of 7 digits or more, or a token with `@`) with its
lexical pattern, that is the two words before it, the kinds it could be, and the kind of the base span that covers it (a
seed). Spark scores the graph of patterns and instances in rounds: a pattern's confidence in a kind is the share of known
instances among its different instances that could be of the kind. Patterns with SUPPORT known instances and CONFIDENCE in a
kind make their other instances known as of that kind for the next round; a pattern or an instance can have several kinds. Rounds
go on until one adds nothing. In the end, occurrences of known instances under a trusted pattern are added as spans, each as of
the kind in which its pattern has the highest confidence; base spans stay, and an added span never overlaps one.

The graph has a row for each different (pattern, instance), combined in each task before the shuffle, and is scored by joins
and sums; no group is collected, so a phrase that stands in a third of all documents is a row.

Defined results: a null text is empty; whole texts count, however long, and so do the words before an identifier, however far
back; spans depend on the text alone, so repeated rows and null doc_ids each get those of their text; of kinds tied for an
added instance the later one listed counts; an empty table gives no rows; redact() returns the columns that came, with
whatever names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, save, small_batches

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# quantifiers are possessive where giving back can't help: long runs take linear time
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9A-Za-z@])\+?\(?[0-9](?:[ ().-]{0,2}[0-9])++(?![0-9A-Za-z@])")
AT = re.compile(r"[^\s@]++@[^\s@]++")
BEFORE = re.compile(r"[^\W\d_]+")
NOT_DIGIT = re.compile(r"[^0-9]+")
SUPPORT, CONFIDENCE = 10, 0.6


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Of each @ in turn: the run of local characters before it, from the last match on, and the domain after it."""
    end = 0
    at = text.find("@")
    while at >= 0:
        if at >= end and (domain := DOMAIN.match(text, at + 1)):
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                yield start, end
        at = text.find("@", at + 1)


def small_parts(ip: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in ip.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then by start."""
    out = [("email", s, e) for s, e in emails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if small_parts(m[0])]
    for m in CARD.finditer(text):
        d = NOT_DIGIT.sub("", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def could_be(token: str) -> int:
    """Bit set of the kinds (by number) that a token looks like."""
    if "@" in token:
        return 1
    n, dots = len(NOT_DIGIT.sub("", token)), token.count(".")
    return 2 * (dots == 3 and n <= 12) + 4 * (13 <= n <= 19 and not dots) + 8 * (7 <= n <= 15 and dots < 3)


def instances(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """The identifier-like tokens of a text: place, pattern, instance, kinds they could be, kind of a seed (else -1)."""
    seeds = sorted((s, e, KINDS.index(k)) for k, s, e in base)
    found = [(s, e, 1 << k, k) for s, e, k in seeds]
    matches = list(NUMBER.finditer(text)) + (list(AT.finditer(text)) if "@" in text else [])
    last = 0
    for m in sorted(matches, key=lambda m: m.start()):
        mask = could_be(m[0])
        if mask and m.start() >= last and not any(s < m.end() and m.start() < e for s, e, _ in seeds):
            found.append((m.start(), m.end(), mask, -1))
            last = m.end()
    out = []
    for start, end, mask, kind in found:
        words = words_before(text, start)
        if len(words) == 2:
            pattern = xxhash.xxh3_64_intdigest(f"{words[0]} {words[1]}".lower())
            out.append({"start": start, "end": end, "pattern": pattern - (1 << 63), "instance": xxhash.xxh3_64_intdigest(text[start:end]) - (1 << 63), "mask": mask, "kind": kind})
    return out


def words_before(text: str, end: int) -> list[str]:
    """The last two whole words before a place, however far back; fewer if there aren't two."""
    width = 64
    while True:
        begin = max(0, end - width)
        found = list(BEFORE.finditer(text, begin, end))
        # a word that the window's start may cut doesn't count yet
        if begin and found and found[0].start() == begin:
            found = found[1:]
        if len(found) >= 2 or not begin:
            return [m[0] for m in found[-2:]]
        width *= 4


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
FOUND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.int64()), ("instance", pa.int64()), ("mask", pa.int32()), ("kind", pa.int32())])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), base spans and identifier-like tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, found = [], []
            for text in batch.column(2).to_pylist():
                base = base_spans(text or "")
                spans.append([{"kind": KINDS.index(k), "start": s, "end": e} for k, s, e in base])
                found.append(instances(text or "", base))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(SPAN)), pa.array(found, pa.list_(FOUND))], names=["doc_id", "key", "base", "found"])

    small_batches(docs.sparkSession)
    spans = "base array<struct<kind:int,start:int,end:int>>, found array<struct<start:int,end:int,pattern:long,instance:long,mask:int,kind:int>>"
    return docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(run, f"doc_id long, key binary, {spans}")


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def trusted_patterns(graph: DataFrame, known: DataFrame) -> DataFrame:
    """pattern, trusted (kind), share and n of known instances among those that could be of the kind; a row for each kind trusted."""
    state = graph.join(known.groupBy("instance").agg(F.bit_or(F.expr("shiftleft(1, known)")).alias("known")), "instance", "left")
    n = len(KINDS)
    could = [F.count_if(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0).alias(f"could{k}") for k in range(n)]
    are = [F.count_if(F.col("mask").bitwiseAND(F.col("known")).bitwiseAND(F.lit(1 << k)) != 0).alias(f"are{k}") for k in range(n)]
    sums = state.groupBy("pattern").agg(*could, *are)
    kinds = F.array(*[F.struct((F.col(f"are{k}") / F.greatest(F.col(f"could{k}"), F.lit(1))).alias("share"), F.col(f"are{k}").alias("n"), F.lit(k).alias("trusted")) for k in range(n)])
    return sums.select("pattern", F.inline(F.filter(kinds, lambda x: (x["n"] >= SUPPORT) & (x["share"] >= CONFIDENCE))))


def discovered(scanned: DataFrame) -> DataFrame:
    """pattern, instance, added (kind) of what the bootstrap finds."""
    graph = scanned.select(F.explode("found").alias("f")).select("f.pattern", "f.instance", "f.mask", "f.kind")
    seeds = F.bit_or(F.expr("CASE WHEN kind >= 0 THEN shiftleft(1, kind) ELSE 0 END"))
    graph = save(graph.groupBy("pattern", "instance").agg(F.bit_or("mask").alias("mask"), seeds.alias("seeds")), "pii-graph")
    kinds = F.explode(F.filter(F.array(*[F.lit(k) for k in range(len(KINDS))]), lambda k: F.expr("seeds").bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(len(KINDS))]), k + 1)) != 0))
    known = save(graph.where("seeds <> 0").select("instance", kinds.alias("known")).distinct(), "pii-known")
    while True:
        fits = graph.join(trusted_patterns(graph, known), "pattern").where("mask & shiftleft(1, trusted) != 0")
        new = fits.select("instance", F.col("trusted").alias("known")).distinct().join(known, ["instance", "known"], "left_anti")
        new = save(new, "pii-new")
        if new.isEmpty():
            break
        known = save(known.union(new), "pii-known")
    fits = fits.where("seeds = 0").withColumnRenamed("trusted", "known").join(known, ["instance", "known"])
    return fits.groupBy("pattern", "instance").agg(F.max(F.struct("share", "n", "known"))["known"].alias("added"))


def spans_of(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The scan (doc_id, key, base, found), and key, extra: the added spans of the texts that have some; None if none has."""
    scanned = save(scan(docs), "pii-scan")
    new = save(discovered(scanned), "pii-added")
    if new.isEmpty():
        return scanned, None
    places = scanned.select("key", F.explode("found").alias("f")).where("f.kind < 0").select("key", "f.*").distinct()
    places = places.join(new, ["pattern", "instance"])
    extra = places.groupBy("key").agg(F.collect_list(F.struct(F.col("added").alias("kind"), "start", "end")).alias("extra"))
    return scanned, save(extra, "pii-extra")


def written(spans: Column) -> Column:
    """kind:start:end, by kind as listed and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span in `text` replaced by its kind in brackets, e.g. [email]."""
    _, extra = spans_of(docs)
    fields = docs.columns
    added, key = free_name(fields, "added"), free_name(fields, "key")
    rows = docs.withColumn(added, F.array().cast("array<struct<kind:int,start:int,end:int>>"))
    if extra is not None:
        # texts with added spans; one row for each different text
        rows = docs.withColumn(key, text_key()).join(extra.select(F.col("key").alias(key), F.col("extra").alias(added)), key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, extra in zip(batch.column("text").to_pylist(), batch.column(added).to_pylist(), strict=True):
                if text is not None:
                    spans = [(s, e, k) for k, s, e in base_spans(text)] + [(x["start"], x["end"], KINDS[x["kind"]]) for x in extra or []]
                    parts, at = [], 0
                    for s, e, kind in sorted(spans):
                        if s >= at:
                            parts += [text[at:s], f"[{kind}]"]
                        at = max(at, e)
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in fields], names=fields)

    return rows.mapInArrow(run, docs.schema)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of every document."""
    scanned, extra = spans_of(documents(spark, sf_dir))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    rows = scanned.drop("found").withColumn("extra", none) if extra is None else scanned.drop("found").join(extra, "key", "left").withColumn("extra", F.coalesce("extra", none))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "extra")).alias("spans"))
