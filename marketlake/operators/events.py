"""Near-duplicate and same-event notes: pairs by token overlap, greedy groups, repeats of earlier days.

Similarity is the number of shared title tokens over the larger title's number of tokens. A pair of at least `least` shares
one of the rarest tokens of both titles (all but least * n - 1 of n), so pairs are found by a join on these tokens, and where the
similarity counts only with a shared entity or amount, on both together; notes that are equal in all that the comparison sees are one
row of it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..sources.folders import Scratch

#: Notes of one token that a block of a join takes.
HEAVY = 5000
#: Longs of a note's bitmap of tokens.
MAP = 8


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens over those of the larger set; 0 if either is empty."""
    most = F.greatest(F.size(a), F.size(b))
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / most), F.lit(0.0))


def tokens(text: Column) -> Column:
    """The different blank-separated tokens of a lower-case text, sorted."""
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda t: F.when(t != "", t)))))


def same_event(a: str, b: str, title: float = 0.70, with_entity: float = 0.50, with_amount: float = 0.62) -> Column:
    """Whether the notes aliased a and b (tokens, entities, amounts) tell of one event: alike titles, or less alike ones that share
    an entity or an amount."""
    sim = overlap(F.col(f"{a}.tokens"), F.col(f"{b}.tokens"))
    shared = lambda c: F.coalesce(F.arrays_overlap(f"{a}.{c}", f"{b}.{c}"), F.lit(False))
    return (sim >= title) | ((sim >= with_entity) & shared("entities")) | ((sim >= with_amount) & shared("amounts"))


def ranked_tokens(notes: DataFrame, key: list[str]) -> DataFrame:
    """notes with ranked: the structs (n, token) of each note's tokens, by the number of notes that have them, ties by themselves."""
    each = notes.select(*key, F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("n_notes"))
    ranked = each.join(counts, "token").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("n_notes", "token"))).alias("ranked"))  # one title's tokens
    return notes.join(ranked, key).withColumn("bits", bitmap("tokens"))


def bitmap(tokens: str) -> Column:
    """A struct of MAP longs in which each token turns one bit round: two sets differ in as many tokens at least as these have bits that differ."""
    turn = f"aggregate({tokens}, 0L, (x, t) -> IF(pmod(xxhash64(t), {MAP}) = {{k}}, x ^ shiftleft(1L, CAST(pmod(xxhash64(t) DIV {MAP}, 64) AS INT)), x)) AS m{{k}}"
    return F.expr("struct(" + ", ".join(turn.format(k=k) for k in range(MAP)) + ")")


def _keys(notes: DataFrame, least: float, shared: str | None, keep: list[str]) -> DataFrame:
    """A row for each token that a note at similarity `least` must share one of, and each item of `shared` with it: number n, size, place,
    token, item, and in how many blocks the token's notes are dealt."""
    size = F.size("ranked")
    first = F.greatest(size - F.ceil(size * F.lit(least) - 1e-9).cast("int") + 1, F.lit(1))
    keep = [*keep, "bits"]
    rows = notes.select("n", *keep, size.alias("size"), *([F.explode(shared).alias("item")] if shared else []), F.slice("ranked", F.lit(1), first).alias("ranked"))
    rows = rows.select("n", *keep, "size", *(["item"] if shared else []), F.posexplode("ranked").alias("place", "r"))
    blocks = F.ceil(F.col("r.n_notes") / HEAVY).cast("int").alias("blocks")
    return rows.select("n", *keep, "size", "place", F.col("r.token").alias("token"), F.col("item") if shared else F.lit("").alias("item"), blocks)


def candidates(left: DataFrame, right: DataFrame, least: float, shared: str | None, keep: list[str], where: Column) -> DataFrame:
    """(a, b), with repeats: pairs of rows (aliased a and b, by number n) that can have similarity `least` and an item of `shared`.

    They have one of the rarest tokens of both in common, and with it an item, so a token that is in every title brings nothing together
    by itself. A pair counts at a common token only if as many tokens can follow in both as the similarity still needs. Notes of a
    frequent token are dealt into blocks on one side and sent to each block on the other. Rows carry numbers, sizes and bitmaps, so
    that most pairs of notes with little else in common go no further than the join; the others are compared afterwards.
    """
    a = _keys(left, least, shared, keep).withColumn("block", F.pmod(F.xxhash64("n"), F.col("blocks"))).alias("a")
    b = _keys(right, least, shared, keep).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("block", F.col("block").cast("long")).alias("b")
    most = F.greatest("a.size", "b.size")
    fits = (F.least("a.size", "b.size") >= least * most - 1e-9) & (1 + F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) - 1 >= F.ceil(least * most - 1e-9))
    differ = sum((F.bit_count(F.col(f"a.bits.m{k}").bitwiseXOR(F.col(f"b.bits.m{k}"))) for k in range(MAP)), F.lit(0))
    fits = fits & (F.col("a.size") + F.col("b.size") - differ >= 2 * F.ceil(least * most - 1e-9))
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.item") == F.col("b.item")) & (F.col("a.block") == F.col("b.block"))
    return a.join(b, same & fits & where).select(F.col("a.n").alias("a"), F.col("b.n").alias("b"))


def same_event_pairs(notes: DataFrame, keep: list[str], where: Column, title: float, with_entity: float, with_amount: float) -> DataFrame:
    """The different pairs (a, b) of rows that tell of one event and fulfil `where`, which speaks of the columns `keep` of both."""
    found = None
    for least, shared in ((title, None), (with_entity, "entities"), (with_amount, "amounts")):
        pairs = candidates(notes, notes, least, shared, keep, where)
        found = pairs if found is None else found.union(pairs)
    rows = lambda side: notes.select(F.col("n").alias(side), F.struct("tokens", "entities", "amounts").alias(f"{side}_row"))
    both = found.distinct().join(rows("a"), "a").join(rows("b"), "b")
    return both.where(same_event("a_row", "b_row", title, with_entity, with_amount)).select("a", "b")


def greedy_groups(notes: DataFrame, block: list[str], title: float = 0.70, with_entity: float = 0.50, with_amount: float = 0.62) -> DataFrame:
    """id, head: each note joins the first group whose head tells of the same event, or heads a new one.

    notes has id, score, tokens, entities, amounts and the block columns; the order in a block is score descending, then id.
    A note heads a group if no earlier head matches it. So heads are settled in rounds: a note all of whose earlier matches
    are settled as no heads is one, a note with an earlier head isn't. Every round settles the first open note of each
    cluster at least, and most notes in a few rounds.
    """
    scratch = Scratch(notes.sparkSession, "events")
    order = F.struct((-F.col("score")).alias("s"), "id")
    same = [*block, "tokens", "entities", "amounts"]
    # made from the texts once: five steps read them
    rows = scratch.save(notes.select("id", *block, "score", *[F.array_sort(F.coalesce(c, F.array().cast("array<string>"))).alias(c) for c in ("tokens", "entities", "amounts")]), "rows")
    alike = rows.groupBy(*same).agg(F.min(order).alias("first"))
    firsts = scratch.save(ranked_tokens(alike.select(F.col("first.id").alias("n"), "first", *same).where(F.size("tokens") > 0), ["n"]), "firsts")
    in_block = F.col("a.first") < F.col("b.first")
    for c in block:
        in_block = in_block & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    pairs = same_event_pairs(firsts, ["first", *block], in_block, title, with_entity, with_amount)
    ranks = firsts.select(F.col("n").alias("a"), "first")
    pairs = scratch.save(pairs.join(ranks, "a"), "pairs")  # a before b
    heads = scratch.save(firsts.select("n").join(pairs.select(F.col("b").alias("n")), "n", "left_anti"), "heads")
    open_ = scratch.save(pairs.select(F.col("b").alias("n")).distinct(), "open")
    while not open_.isEmpty():
        led = pairs.join(heads.select(F.col("n").alias("a")), "a", "left_semi").select(F.col("b").alias("n")).distinct()
        rest = open_.join(led, "n", "left_anti")
        waits = pairs.join(rest.select(F.col("n").alias("a")), "a", "left_semi").select(F.col("b").alias("n")).distinct()
        new = scratch.save(rest.join(waits, "n", "left_anti"), "new")
        open_ = scratch.save(rest.join(new, "n", "left_anti"), "open")
        heads = scratch.save(heads.union(new), "heads")
    of = pairs.join(heads.select(F.col("n").alias("a")), "a", "left_semi").groupBy(F.col("b").alias("n")).agg(F.min_by("a", "first").alias("head"))
    of = firsts.select("n").join(of, "n", "left").select("n", F.coalesce("head", "n").alias("head"))
    numbered = rows.join(alike, [rows[c].eqNullSafe(alike[c]) for c in same]).select(rows["id"], F.col("first.id").alias("n"))
    # a note without tokens is like no other
    bare = rows.where(F.size("tokens") == 0).select("id", F.col("id").alias("head"))
    return numbered.join(of, "n").select("id", "head").union(bare)


def repeated(notes: DataFrame, days: int = 7, title: float = 0.70, with_entity: float = 0.50, with_amount: float = 0.62) -> DataFrame:
    """id, repeated: whether a note of an earlier day, at most `days` before, tells of the same event.

    notes has id, fecha, tokens, entities (those that count as evidence) and amounts.
    """
    same = ["fecha", "tokens", "entities", "amounts"]
    scratch = Scratch(notes.sparkSession, "repeated")
    # made from the texts once: four steps read them
    rows = scratch.save(notes.select("id", "fecha", *[F.array_sort(F.coalesce(c, F.array().cast("array<string>"))).alias(c) for c in same[1:]]), "rows")
    alike = rows.groupBy(*same).agg(F.min("id").alias("n"))
    firsts = scratch.save(ranked_tokens(alike.where((F.size("tokens") > 0) & F.col("fecha").isNotNull()), ["n"]), "firsts")
    recent = F.datediff("b.fecha", "a.fecha").between(1, days)
    hit = same_event_pairs(firsts, ["fecha"], recent, title, with_entity, with_amount).select(F.col("b").alias("n"), F.lit(True).alias("hit")).distinct()
    numbered = rows.join(alike, [rows[c].eqNullSafe(alike[c]) for c in same]).select(rows["id"], "n")
    return numbered.join(hit, "n", "left").select("id", F.coalesce("hit", F.lit(False)).alias("repeated"))


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 and more characters a step: bit k of `row` is off where b's first letters end a
    common subsequence at a's k-th."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts' sorted tokens: twice the longest common subsequence over both lengths. For pairs, not for tables of
    texts with each other."""
    order = lambda t: " ".join(sorted((t or "").split()))
    return pd.Series([2 * common_length(x, y) / (len(x) + len(y)) if x or y else 1.0 for x, y in zip(map(order, a), map(order, b), strict=True)], dtype="float64")
