"""Conversation repair, byte-level BPE and cross-tokenizer alignment against plain versions, with the edge cases of their docstrings."""

import base64
import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from marketlake.llm import alignment, byte_bpe, chunks, conversations, licenses, token_ids
from marketlake.llm.queries import QUERIES

RANKS, A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
WHITE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def cheapest(turns):
    """Least cost, least audit and digest of the repair of (role, text, fault) turns: shortest paths over all edits."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names, heap = {"u": "user", "a": "assistant"}, [(0, "", 0, "", ())]
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, sha("\n".join(out))
        if len(audit) > 3 * len(turns) + 3:
            continue
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(heap, (cost + 4, f"{audit}D", i + 1, state, out))
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if role[:1] and role[:1] in follows[state]:
                    heapq.heappush(heap, (cost + more, f"{audit}K", i + 1, role[:1], (*out, f"{role}:{text}")))
                for c in set(follows[state]) & set(names):
                    heapq.heappush(heap, (cost + more + 3, f"{audit}R", i + 1, c, (*out, f"{names[c]}:{text}")))
        for c in set(follows[state]) & set(names):
            heapq.heappush(heap, (cost + 3, f"{audit}I", i, c, (*out, f"{names[c]}:")))


def plain_op11(rows):
    """The contract over (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else x
        code = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        by[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen, known = [], set(), {t[0] for t in turns if t[0] is not None}
        for _, role, text in turns:
            body = text.strip(WHITE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        first = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *cheapest([(r, t, f) for (_, r, t), f in zip(turns, faults, strict=True)]))
    return out


def talk(rng, conv):
    turns = rng.sample(range(12), rng.randint(1, 6))
    texts = ["Fine.", "So?", "cut off", "", " \t", "More!", "x\n", "Ends. "]
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    return [(conv, None if rng.random() < 0.05 else t, rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice([*texts, None])) for t in turns]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    rows = [r for conv in range(150) for r in talk(rng, conv)] + [(None, 1, "user", "No key."), (None, 2, "assistant", "Nor here.")]
    rows += [(1000, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(2)] + [(1001, 5, "user", "Twice."), (1001, 5, "user", "Twice."), (1002, 5, "user", "Tie b."), (1002, 5, "assistant", "Tie a.")]
    dropped = next(k for k in range(2000, 9000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.")]


SHAPE = "conv_id long, turn long, role string, text string"


def test_conversations_equal_all_edits(spark, talks, tmp_path):
    wide = [(*r, "x", 1, 2) for r in talks]
    spark.createDataFrame(wide, f"{SHAPE}, audit string, copies int, earlier int").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op11_conversations"](spark, str(tmp_path)).collect()}
    assert found == plain_op11(talks)
    assert any(v == (0, 0, 0, 0, 0, 0, "", sha("")) for v in found.values())


def test_conversations_in_sql(spark, talks):
    import duckdb

    conversations_ = spark.createDataFrame(talks, SHAPE)
    frame = conversations_.toArrow()  # noqa: F841  DuckDB reads it
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM frame")
    said = con.sql(conversations.oracle())
    found = conversations.audited(conversations.damaged(conversations_)).select(*said.columns)
    assert sorted(map(str, said.fetchall())) == sorted(str(tuple(r)) for r in found.collect())


def test_long_conversations_go_in_blocks(spark, monkeypatch):
    """Blocks of any size give what one block gives; a long conversation equals plain shortest paths over its states."""
    rng = random.Random(9)
    for _ in range(150):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["x.", "y", "", "z!"]), rng.random() < 0.15) for _ in range(rng.randint(0, 9))]
        answers = set()
        for size in (1, 2, 3, 5, 16):
            monkeypatch.setattr(conversations, "BLOCK", size)
            repair = conversations.Repair()
            for k, (role, text, repeated) in enumerate(turns):
                repair.add(k, role, text, repeated)
            answers.add(repair.result())
        assert len(answers) == 1


def test_repaired_turns_are_what_the_digest_says(spark, talks):
    rows = conversations.damaged(spark.createDataFrame([*talks, *[(7000, k, ("user", "assistant")[k % 3 % 2], f"Turn {k}{'.' * (k % 5)}") for k in range(120)]], SHAPE))
    audits = conversations.audited(rows).persist()
    turns = defaultdict(list)
    for r in sorted(conversations.repaired_turns(rows, audits).collect(), key=lambda r: r.position):
        turns[r.conv_id].append(r)
    for r in audits.collect():
        said = turns[r.conv_id]
        assert sha("\n".join(f"{t.role}:{t.text}" for t in said)) == r.repaired_sha256
        assert "".join(t.edit for t in said) == r.audit.replace("D", "")
        word = "".join(t.role[:1] for t in said)
        assert len(word) == 0 or word.removeprefix("s") == "ua" * (len(word) // 2)
    audits.unpersist()


def test_conversations_of_an_empty_table_and_of_very_long_texts(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert conversations.audited(conversations.damaged(empty)).count() == 0
    rows = [(1, 1, "user", "long " * 200_000 + "."), (1, 2, "assistant", "Yes.")]
    assert conversations.audited(spark.createDataFrame([(*r, 1) for r in rows], f"{SHAPE}, copies int")).first().audit == "KK"


ALPHABET = list("ab'sdt  \n\t\r\x0b\x1c\x85\xa0 　é1²½!?.,中\U0001f600<|>{}();_")
EDGES = [None, "", " ", "word " * 4000, "x" * 50_000, "<|endoftext|> <s> </s>", " lead", "trail ", "two  blanks", "don't\n\n  stop", "same text.", "same text."]
TEXTS = ["".join(random.Random(k).choices(ALPHABET, k=k % 40)) for k in range(1200)] + ["".join(random.Random(k).choices([*ALPHABET, "▁", "﻿"], k=12)) for k in range(200)] + EDGES


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k else None, t, "c", 1, "p") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk string, entry int, ids string").repartition(3)


def test_byte_bpe_equals_the_library(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r[0] or 0: tuple(r)[1:] for r in QUERIES["op12_byte_bpe"](spark, str(tmp_path)).collect()}
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for k, text in enumerate(TEXTS):
        ids = library.encode_ordinary(text or "")
        assert found[k] == (len(ids), sha(" ".join(map(str, ids))), sha(text or ""))
    # words that meet from many chunks
    many = byte_bpe.decoded(byte_bpe.encoded(docs.repartition(7), RANKS, public_tokenizers.PATTERN), RANKS).mapInArrow(byte_bpe.digests, byte_bpe.DIGESTS).collect()
    assert {r[0] or 0: tuple(r)[1:] for r in many} == found


def test_byte_bpe_of_no_rows_and_of_given_ids(spark, docs):
    assert byte_bpe.encoded(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([(1, [39, 72]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, bytes(r.bytes)) for r in byte_bpe.decoded(ids, RANKS).collect()) == [(1, b"Hi"), (2, b""), (3, b"")]


def test_chunk_files_give_back_their_arrays(tmp_path):
    arrays = {"a": np.arange(1000, dtype=np.int32), "b": np.zeros(0, np.int64), "c": np.array([7, -1, 1 << 60])}
    chunks.write_arrays(f"file://{tmp_path}/x", "f", arrays)
    back = chunks.read_arrays(f"file://{tmp_path}/x", "f")
    assert all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in arrays.items())
    assert chunks.expand(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert chunks.sums(np.array([1, 2, 3]), np.array([0, 2, 0, 1])).tolist() == [0, 3, 0, 3]


def plain_op13(texts):
    """The contract, text by text with whole texts given to both libraries."""
    a_model, b_model = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(map(chr, [*visible, *range(256, 256 + 68)]), [*visible, *(b for b in range(256) if b not in visible)], strict=True))

    def b_bytes(k):
        piece = b_model.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(k) else piece.replace("▁", " ").encode()

    def ends(words):
        return [sum(map(len, words[: k + 1])) for k in range(len(words))] if len(words) < 300 else list(__import__("itertools").accumulate(map(len, words)))

    found, count = [], Counter()
    for text in texts:
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text, num_threads=1) if text else []
        a_words, b_words = [bytes(letters[c] for c in a_model.id_to_token(k)) for k in a], [b_bytes(k) for k in b]
        if not text or b"".join(a_words) != f" {text}".encode() or b"".join(b_words) != f" {text}".encode():
            found.append(None)
            continue
        a_ends, b_ends, cuts = ends(a_words), ends(b_words), []
        for e in sorted(set(a_ends) & set(b_ends)):
            low = cuts[-1][0] if cuts else 0
            cuts.append((e, [x for x, p in zip(a, a_ends, strict=True) if low < p <= e] if len(a) < 300 else None, [x for x, p in zip(b, b_ends, strict=True) if low < p <= e] if len(a) < 300 else None))
        if len(a) >= 300:
            i, j, wide = 0, 0, []
            for e, _, _ in cuts:
                left, right = [], []
                while i < len(a) and a_ends[i] <= e:
                    left.append(a[i])
                    i += 1
                while j < len(b) and b_ends[j] <= e:
                    right.append(b[j])
                    j += 1
                wide.append((e, left, right))
            cuts = wide
        found.append((a, b, [(left, right) for _, left, right in cuts]))
        count.update({(x, y) for _, left, right in cuts for x in left for y in right})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for row in found:
        if row is None:
            yield 0, 0, 0, 0, 0, 0, ""
            continue
        a, b, cut = row
        links = [(x, y) for left, right in cut for x in left for y in right]
        text = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in cut)
        yield len(a), len(b), len(cut), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha(text)


def test_alignment_equals_plain_groups(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r[0] or 0: tuple(r)[1:] for r in QUERIES["op13_alignment"](spark, str(tmp_path)).collect()}
    wanted = list(plain_op13(TEXTS))
    assert [found[k] for k in range(len(TEXTS))] == wanted
    many = alignment.aligned(docs.repartition(7), A_PATH, B_PATH).collect()
    assert {r[0] or 0: tuple(r)[1:] for r in many} == found
    assert any(w[0] == 0 for w in wanted[1200:1400]) and sum(w[0] > 0 for w in wanted) > 900


def test_alignment_of_whole_texts():
    """A vocabulary that can't be cut at blanks is asked for whole texts; one with tokens of no bytes piece by piece."""
    texts = [t or "" for t in TEXTS[:300]]
    sides = alignment.Tokens(A_PATH), alignment.Tokens(B_PATH)
    assert sides[0].by_piece and sides[1].by_piece
    by_piece, whole, single = (alignment.Pieces(*sides) for _ in range(3))
    whole.cut = lambda text: [text]
    said = []
    for pieces in (by_piece, whole, single):
        sides[0].hollow = pieces is single
        said.append([";".join(pieces.texts[n] for n in row) for row in pieces.rows(texts)])
    assert said[0] == said[1] == said[2]


def test_groups_by_name_and_empty_table(spark, docs):
    assert alignment.aligned(docs.limit(0), A_PATH, B_PATH).count() == 0
    rows = alignment.token_groups(docs.where("text = 'same text.' OR text = ''"), A_PATH, B_PATH).orderBy("doc_id", "position").collect()
    assert [(r.position, r.a_ids, r.b_ids) for r in rows] == [(0, [976], [1348]), (1, [2420], [2245]), (2, [13], [28723])] * 2


def test_token_ids_of_any_tokenizer_are_the_librarys(tmp_path):
    """The dealt one, one with other cuts, and the dealt one without its lower case, or with a mark that may stand in words."""
    import json

    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        dealt = json.load(f)
    cased = {**dealt, "normalizer": {"type": "NFC"}}
    marked = {**dealt, "added_tokens": [*dealt["added_tokens"], {"id": 49408, "content": "so", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}]}
    paths = [public_tokenizers.path("word_bpe_49k.json"), A_PATH]
    for name, settings in (("cased", cased), ("marked", marked)):
        paths.append(str(tmp_path / f"{name}.json"))
        (tmp_path / f"{name}.json").write_text(json.dumps(settings))
    texts = [t for t in TEXTS if t] + ["Some Words, some MORE words; and so on.", "don't STOP\n\nhere 12.5"]
    for path in paths:
        assert token_ids.cuts_hold(path) == (path == paths[0])
        encoder, library = token_ids.ChunkEncoder(path, 4, token_ids.cuts_hold(path)), Tokenizer.from_file(path)
        for text in texts:
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def wrapped(text, width=60):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


def test_licences_of_whole_files_and_the_same_in_sql(spark):
    import duckdb

    known = licenses.SENTENCES
    bsd = "BSD 3-Clause License\n\nCopyright (c) 2024, A. Holder\nAll rights reserved.\n\n" + "\n\n".join(wrapped(known[k]) for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
    texts = {
        bsd: "BSD-3-Clause",
        bsd.replace(wrapped(known["bsd-names"]), ""): "BSD-2-Clause,BSD-3-Clause",
        "MIT License\n\nCopyright (c) 2024\n\n" + wrapped(known["mit-grant"]) + "\n\n" + wrapped(known["mit-notice"]): "MIT",
        "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS": "Apache-2.0",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007": "GPL-3.0",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n": "GPL-2.0",
        "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n": "LGPL-3.0",
        "Mozilla Public License Version 2.0\n==================================\n": "MPL-2.0",
        "# SPDX-License-Identifier: MIT\nimport os": "MIT",
        "// SPDX-License-Identifier: GPL-2.0-or-later\n": "GPL-2.0",
        wrapped(known["gpl2-free"]): "GPL-2.0-or-later",
        wrapped(known["mpl-subject"], 40): "MPL-2.0",
        "Copyright 2024 A. Holder.\nAll rights reserved.": "proprietary",
        "Licensed under the MIT License. " * 3000: "MIT",
        "No licence here.": "",
        "": "",
    }
    rows = [(k, t, 1) for k, t in enumerate([*texts, None, "All rights reserved."])]
    docs = spark.createDataFrame([*rows, *rows[:2]], "doc_id long, text string, ids int")
    found = licenses.scan(docs)
    assert [{r.doc_id: r.licences for r in found.collect()}[k] for k in range(len(texts))] == list(texts.values())
    documents = docs.toPandas()  # noqa: F841  DuckDB reads it
    said = duckdb.sql(licenses.oracle())
    order = [said.columns.index(c) for c in found.columns]
    assert sorted(tuple(r[k] for k in order) for r in said.fetchall()) == sorted(tuple(r) for r in found.collect())


def test_op9_rows_are_the_librarys(spark, tmp_path):
    rows = [(k, t, "x") for k, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    library, want, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for k, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op9_token_ids"](spark, str(tmp_path)).collect()) == want



@pytest.mark.parametrize(("width", "seed"), [(25, 1), (30, 0), (40, 0), (40, 2), (45, 1)])
def test_passages_around_a_phrase_that_all_texts_share(spark, width, seed):
    """40 pairs share 50 words, `width` of which are in all 160 texts: every pair is found, and nothing else."""
    from pyspark.sql import functions as F

    from marketlake.llm.passages import passages

    words = ["".join(random.Random(k).choices("abcdefghijklmnop", k=2 + k % 7)) for k in range(5000)]
    rng = random.Random(97 * seed + width)
    some = lambda n: rng.choices(words, k=n)
    phrase, left = some(width), (50 - width) // 2
    texts = []
    for _ in range(40):
        a, b = some(left), some(50 - width - left)
        texts += [" ".join(some(80) + a + phrase + b + some(80)) for _ in range(2)]
    texts += [" ".join(some(90) + phrase + some(90)) for _ in range(80)]
    found = passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    number = {hashlib.md5(t.encode()).hexdigest(): k for k, t in enumerate(texts)}
    rows = found.select(F.lower(F.hex("key")).alias("a"), F.lower(F.hex("other_key")).alias("b")).distinct().collect()
    assert {tuple(sorted((number[r.a], number[r.b]))) for r in rows} == {(2 * k, 2 * k + 1) for k in range(40)}
