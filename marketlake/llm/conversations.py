"""Conversation structure repair: Wagner-Fischer alignment of turns with every feasible target of an alternating grammar.

A conversation should read system?, then user and assistant in turns, ended by the assistant: role initials `(s?(ua)+)?`. Edits keep
a turn (0), give it another role (3), delete it (4) or insert an empty one (3); blank and repeated turns must go and a truncated
turn that stays costs 3 more. Of all cheapest repairs the one with the ASCII-least audit (the edits' initials in order) is taken.

The grammar has one word, or with and without `s` two, of each length, so a block of turns is aligned with the word of each length
that the incumbent's cost still allows (`words`), in a band about the diagonal that the same cost gives (`aligned`); costs being
equal, the backtraced audits are compared. Conversations beyond BLOCK turns go block by block: for every state of the grammar the
cheapest way so far is carried over. Insertions belong to the turn after them, so no block's audit is the beginning of another's and
comparing block by block is comparing whole audits; the result is the one of a single alignment.

A conversation's turns go in order through one task, as the digest of its repaired text, SHA-256, can only be computed so; the task
holds a block of turns and three states, and Spark's sort and window spill, so its memory doesn't grow with the conversation but for the audit,
which is a cell of the result.

Defined results: a null conv_id is a conversation of its own; null roles and texts are one space, and null turns come before all
others; turns that tie are ordered by role, then text; repeated rows are duplicates of each other; whole texts count, however long;
conversations without turns have zeros, an empty audit and the digest of nothing; other columns are ignored, whatever their names;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches

#: Fixed costs of the edits, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 16
START, SYSTEM, USER, ASSISTANT = "-", "s", "u", "a"
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a turn; the first that holds counts.
FINE, BLANK, DUPLICATE, CUT = range(4)
NEVER = 1 << 60


def words(state: str, length: int) -> list[str]:
    """The grammar's words of this length, read on from a state; they need not end where a conversation may."""
    pair = "au" if state == USER else "ua"
    plain = (pair * (length // 2 + 1))[:length]
    if state == START and length:
        return [plain, f"s{plain[: length - 1]}"]
    return [plain]


def drift(n: int) -> int:
    """The least cost of ending n turns above (deletions) or below (insertions) the diagonal."""
    return DELETE * n if n > 0 else -INSERT * n


def aligned(turns: tuple[tuple[str, int], ...], word: str, last: bool, most: int) -> tuple[int, str] | None:
    """The least cost, at most `most`, of turning (initial, fault) turns into the word, and the ASCII-least audit at that cost.

    Costs of suffixes are filled from the end, in the diagonals that a repair within `most` can visit: one that leaves the straight
    way by k diagonals pays k deletions and k insertions. After the last turn insertions are left to the next block, if there is one.
    """
    n, m = len(turns), len(word)
    slack = most - drift(n - m)
    if slack < 0:
        return None
    wide = slack // (DELETE + INSERT)
    low, high = min(0, n - m) - wide, max(0, n - m) + wide
    cost = [[NEVER] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = cost[i], cost[i + 1]
        initial, fault = turns[i] if i < n else ("", FINE)
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            best = 0 if i == n and j == m else NEVER
            if i < n:
                best = DELETE + below[j]
                if j < m and fault in (FINE, CUT):
                    best = min(best, _stay(initial, fault, word[j]) + below[j + 1])
            if j < m and word[j] != SYSTEM and (i < n or last):
                best = min(best, INSERT + row[j + 1])
            row[j] = best
    if cost[0][0] > most:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        here = cost[i][j]
        initial, fault = turns[i] if i < n else ("", FINE)
        stay = _stay(initial, fault, word[j]) if i < n and j < m and fault in (FINE, CUT) else NEVER
        if i < n and here == DELETE + cost[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and word[j] != SYSTEM and (i < n or last) and here == INSERT + cost[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            assert here == stay + cost[i + 1][j + 1]
            audit.append("K" if initial == word[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _stay(initial: str, fault: int, wanted: str) -> int:
    if initial != wanted and wanted == SYSTEM:
        return NEVER
    return (KEEP if initial == wanted else REROLE) + (TRUNCATED if fault == CUT else 0)


@lru_cache(maxsize=200_000)
def repairs(turns: tuple[tuple[str, int], ...], state: str, last: bool) -> dict[str, tuple[int, str]]:
    """For each state that the grammar can be in after these turns: the least cost and, at that cost, the least audit.

    Lengths are tried from the likeliest on. The first incumbent is no repair but a bound: deleting all and inserting a pair.
    """
    n, gone = len(turns), sum(fault in (BLANK, DUPLICATE) for _, fault in turns)
    found: dict[str, tuple[int, str]] = {}
    top = DELETE * n + 2 * INSERT
    least = {m: DELETE * gone + drift(n - gone - m) for m in range(n + top // INSERT + 1)}
    for m in sorted(least, key=lambda m: (least[m], m)):
        for word in words(state, m):
            end = word[-1] if word else state
            if last and not (end == ASSISTANT or end == START):
                continue
            most = found[end][0] if end in found else top
            if least[m] <= most and (new := aligned(turns, word, last, most)) and (end not in found or new < found[end]):
                found[end] = new
    return found


class Repair:
    """A conversation's turns in order; result() ends it."""

    def __init__(self):
        self.turns, self.texts = [], []
        self.ways = {START: (0, "", 0, hashlib.sha256())}  # state: cost, audit, rank of the audit, digest
        self.counts, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.first = self.latest = None
        self.different = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        body = text.strip(" \t\n\v\f\r")
        fault = BLANK if not body else DUPLICATE if repeated else FINE if body[-1] in ".!?" else CUT
        self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None:
            self.illegal += f"{self.before}{initial}" not in ("su", "ua", "au")
        self.before = initial
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest = turn
            self.different += 1
        if len(self.turns) == BLOCK:
            self._advance(last=False)
        self.turns.append((initial if initial in ("s", "u", "a") else "", fault))
        self.texts.append((role, text))

    def _advance(self, last: bool) -> None:
        turns, best = tuple(self.turns), {}
        for state, (cost, audit, rank, digest) in self.ways.items():
            for end, (more, chunk) in repairs(turns, state, last).items():
                order = (cost + more, audit + chunk) if last else (cost + more, rank)
                if end not in best or order < best[end][0]:
                    best[end] = (order, state, audit, chunk, rank, digest)
        if last:  # of the states in which a conversation may end one is left
            end = min(best, key=lambda e: best[e][0])
            best = {end: best[end]}
        ranks = {end: k for k, end in enumerate(sorted(best, key=lambda e: (best[e][4], best[e][3])))}
        self.ways = {end: (order[0], audit + chunk, ranks[end], self._digest(digest.copy(), state, chunk)) for end, (order, state, audit, chunk, rank, digest) in best.items()}
        self.turns, self.texts = [], []

    def _digest(self, digest, state: str, chunk: str):
        for role, text, edit in applied(state, chunk, self.texts):
            if edit != "D":
                digest.update(f"{'' if state == START else '\n'}{role}:{text}".encode())
                state = "some"
        return digest

    def result(self) -> tuple:
        self._advance(last=True)
        ((cost, audit, _, digest),) = self.ways.values()
        gaps = self.latest - self.first + 1 - self.different if self.different else 0
        return gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, cost, audit, digest.hexdigest()


def applied(state: str, audit: str, texts: list[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """role, text and edit of every step of an audit, deletions included. What an R or I becomes follows from the grammar: a user's
    turn unless the turn before was one."""
    at = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else texts[at]
        at += edit != "I"
        if edit in "RI":
            state = ASSISTANT if state == USER else USER
            role = ROLES[state]
        elif edit == "K":
            state = role[:1]
        yield role, text, edit


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of rows as a lossy collection leaves them, by crc32(conv_id:turn) % 20.

    0 drops a row (copies 0), 1 empties its text, 2 takes its sentence ends, 3 repeats it (copies 2), 4 makes it the user's.
    """
    text_or = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text_or("conv_id"), F.lit(":"), text_or("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(text_or("text"), "[.!?]", "")).otherwise(text_or("text"))
    role = F.when(code == 4, "user").otherwise(text_or("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows of each conversation in order in one partition, with `earlier`: its role and text come in an earlier turn.

    One shuffle by conversation: the window's groups lie within it. Rows without copies aren't compared.
    """
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    alike = Window.partitionBy("conv_id", "role", F.md5("text"))
    earlier: Column = turn > F.min(F.when(F.col("copies") > 0, turn)).over(alike)
    filled = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")})
    return filled.repartition("conv_id").withColumn("earlier", F.coalesce(earlier, F.lit(False))).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """(is first of its conversation, row) for rows of ordered()."""
    before: object = batches
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield row[0] != before, row
            before = row[0]


def audited(rows: DataFrame) -> DataFrame:
    """A row per conversation of (conv_id, turn, role, text, copies): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired `role:text`, joined by line ends)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    shape = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in names[1:7]) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, key, same, out = None, None, None, []
        for new, (conv, turn, role, text, copies, earlier) in _by_conversation(batches):
            if new:
                if repair:
                    out.append((key, *repair.result()))
                repair, key, same = Repair(), conv, None
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, pa_type) for k, c in enumerate(zip(*out, strict=True))], names)
                    out = []
            for _ in range(copies):
                repair.add(turn, role, text, earlier or same == (turn, role, text))
                same = (turn, role, text)
        if repair:
            out.append((key, *repair.result()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, pa_type) for k, c in enumerate(zip(*out, strict=True))], names)

    pa_type = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]
    small_batches(rows.sparkSession, 2048)
    return ordered(rows).select("conv_id", "turn", "role", "text", "copies", "earlier").mapInArrow(run, shape)


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, role, text, edit of each turn that stands, by the audits of audited(rows)."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        audit, at, place, state, key = "", 0, 0, START, None

        def step(role: str | None, text: str | None) -> None:
            """Edits up to and with the one of this row; without a row, those that are left."""
            nonlocal at, place, state
            while at < len(audit):
                edit, at = audit[at], at + 1
                for r, t, e in applied(state, edit, [(role, text)]):
                    if e != "D":
                        out.append((key, place, r, t, e))
                        place, state = place + 1, r[:1]
                if edit != "I" and role is not None:
                    return

        def close() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["conv_id", "position", "role", "text", "edit"])
            out.clear()
            return batch

        for new, (conv, _turn, role, text, copies, _, row_audit) in _by_conversation(batches):
            if new:
                step(None, None)
                audit, at, place, state, key = row_audit, 0, 0, START, conv
            for _ in range(copies):
                step(role, text)
            if len(out) >= 2000:
                yield close()
        step(None, None)
        if out:
            yield close()

    types = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind], pa.int64(), pa.string(), pa.string(), pa.string()]
    small_batches(rows.sparkSession, 2048)
    keyed = audits.select(F.col("conv_id").alias("__conv"), "audit")
    both = ordered(rows.join(keyed, F.col("conv_id").eqNullSafe(F.col("__conv")))).select("conv_id", "turn", "role", "text", "copies", "earlier", "audit")
    return both.mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations, find their faults and repair them."""
    return audited(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def oracle() -> str:
    """The contract in DuckDB SQL: shortest paths over the grammar's states, turn by turn. An insertion comes right before a turn or at the end, where
    one or, after a system turn alone, two can pay."""
    crc_table = "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    codes = "list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    follows = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
    same = ", ".join(f"('{s}', '{s}', '', 0, '')" for s in follows)
    put = ", ".join(f"('{s}', '{q}', 'I', {INSERT}, '{ROLES[q]}:')" for s, after in follows.items() for q in after if q in ROLES)
    keeps = ", ".join(f"('{s}', '{q}', 'K', {KEEP})" for s, after in follows.items() for q in after)
    reroles = ", ".join(f"('{s}', '{q}', 'R', {REROLE})" for s, after in follows.items() for q in after if q in ROLES)
    deletes = ", ".join(f"('{s}', '{s}', 'D', {DELETE})" for s in follows)
    white = r"\x20\x09-\x0D"
    join = lambda a, b: f"CASE WHEN {a} = '' THEN {b} WHEN {b} = '' THEN {a} ELSE {a} || chr(10) || {b} END"
    line = "CASE m.letter WHEN 'K' THEN r.role || ':' || r.text WHEN 'R' THEN CASE m.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text ELSE '' END"
    return f"""WITH RECURSIVE crc AS (SELECT {crc_table} AS t), c AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM conversations, crc),
 d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE code <> 0),
 o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
 f AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair, CASE WHEN NOT regexp_matches(text, '[^{white}]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN regexp_extract(text, '([^{white}])[{white}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
 ins(p, q, letter, cost, line) AS (VALUES {same}, {put}), moves(p, q, letter, cost) AS (VALUES {keeps}, {reroles}, {deletes}),
 convs AS (SELECT DISTINCT conv_id FROM conversations),
 dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '{START}' AS st, 0 AS cost, '' AS audit, '' AS said FROM convs
  UNION ALL SELECT conv_id, i, st, cost, audit, said FROM (SELECT dp.conv_id, r.i, m.q AS st, dp.cost + ins.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.letter <> 'D' THEN {TRUNCATED} ELSE 0 END AS cost, dp.audit || ins.letter || m.letter AS audit, {join(join('dp.said', 'ins.line'), line)} AS said,
   row_number() OVER (PARTITION BY dp.conv_id, m.q ORDER BY dp.cost + ins.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.letter <> 'D' THEN {TRUNCATED} ELSE 0 END, dp.audit || ins.letter || m.letter) AS best
   FROM dp JOIN f r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1 JOIN ins ON ins.p = dp.st JOIN moves m ON m.p = ins.q WHERE (m.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (m.letter <> 'K' OR r.initial = m.q)) WHERE best = 1),
 n AS (SELECT convs.conv_id, coalesce(max(i), 0) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM convs LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM convs.conv_id GROUP BY 1),
 e AS (SELECT n.*, dp.cost + CASE dp.st WHEN 'u' THEN {INSERT} WHEN 's' THEN {2 * INSERT} ELSE 0 END AS cost, dp.audit || CASE dp.st WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END AS audit, dp.said || CASE dp.st WHEN 'u' THEN chr(10) || 'assistant:' WHEN 's' THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS said FROM n JOIN dp ON dp.conv_id IS NOT DISTINCT FROM n.conv_id AND dp.i = n.n)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(said) AS repaired_sha256 FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM e) WHERE best = 1"""
