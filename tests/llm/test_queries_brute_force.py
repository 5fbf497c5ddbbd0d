"""The opN_ queries and the pipeline on small tables against plain versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import decontam, features, minhash, packing, passages, pii, quality, sharding, token_ids, warc
from marketlake.llm.common import Workspace

RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(4000)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def one_edit(text, rng, lo=0.25, hi=0.75):
    w = text.split()
    w[rng.randrange(int(len(w) * lo), int(len(w) * hi))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def tables(spark, path, texts, **more):
    """A folder with documents of these texts (ids from 1; columns that clash with inner names) and other tables."""
    rows = [(k, t, "en", "s", len(t or ""), "x", 1, 2) for k, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, __extra int, leak int").write.parquet(f"{path}/documents.parquet")
    for name, (rows, schema) in more.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def plain_base(text):
    """The contract's patterns as they stand."""
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and plain_luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (p, ok) in patterns.items() for m in re.finditer(p, text, re.ASCII) if ok(m[0])]


def plain_luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_bootstrap(texts):
    """Spans by text: the base ones, and those that patterns and instances find in rounds."""
    found = [(k, s, e, words, text[s:e], mask, kind) for k, text in enumerate(texts) for s, e, words, mask, kind in plain_instances(text)]
    edges = {}
    for _, _, _, words, instance, mask, kind in found:
        if len(words) == 2:
            edges.setdefault((tuple(words), instance), set()).update({(mask, kind)})
    known = {(i, kind) for (_, i), s in edges.items() for _, kind in s if kind >= 0}
    while True:
        trust = {}
        for p in {p for p, _ in edges}:
            mine = {i: np.bitwise_or.reduce([m for m, _ in s]) for (q, i), s in edges.items() if q == p}
            for kind in range(4):
                could = [i for i, m in mine.items() if m >> kind & 1]
                are = [i for i in could if (i, kind) in known]
                if len(are) >= pii.SUPPORT and len(are) / len(could) >= pii.CONFIDENCE:
                    trust[p, kind] = (len(are) / len(could), len(are))
        new = {(i, kind) for (p, i), s in edges.items() for kind in range(4) if (p, kind) in trust and any(m >> kind & 1 for m, _ in s)}
        if new <= known:
            break
        known |= new
    added = [[] for _ in texts]
    for k, s, e, words, instance, _, kind in found:
        p = tuple(words)
        if kind < 0 and len(words) == 2 and not any(x >= 0 for _, x in edges[p, instance]):
            best = max((trust[p, q], q) for q in range(4) if (p, q) in trust and any(m >> q & 1 for m, _ in edges[p, instance])) if any((p, q) in trust and any(m >> q & 1 for m, _ in edges[p, instance]) for q in range(4)) else None
            if best:
                added[k].append((pii.KINDS[best[1]], s, e))
    return added


def plain_instances(text):
    base = pii.base_spans(text)
    for x in pii.instances(text, base):
        words = re.findall(r"[^\W\d_]+", text[: x["start"]])[-2:]
        yield x["start"], x["end"], [w.lower() for w in words], x["mask"], x["kind"]


def pii_texts():
    rng = random.Random(8)
    out = ["".join(rng.choice("0123456789 -+()a.@") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    out += ["".join(rng.choice(["4111 1111 1111 1111", "+49 (30) 555-01", "5500-0000-0000-0004", "a@b.co", "10.0.0.1", " ", "x", "-", "7"]) for _ in range(rng.randint(1, 8))) for _ in range(300)]
    out += [f"please reach me: +4930{1000000 + k} thanks" for k in range(20)] + ["please reach me: 555-0199-22 thanks", f"please reach me {'- ' * 100}: 555-0199-33 thanks", "see room nine: 555-0199-22"]
    return [None, "", *out]


def test_op2_pii_equals_plain_patterns_and_rounds(spark, tmp_path):
    texts = pii_texts()
    rows = {r.doc_id: r for r in pii.op2_pii(spark, tables(spark, tmp_path, texts)).collect()}
    assert len(rows) == len(texts)
    added = plain_bootstrap([t or "" for t in texts])
    order = {k: n for n, k in enumerate(pii.KINDS)}
    for k, text in enumerate(texts, 1):
        base = plain_base(text or "")
        written = lambda spans: ",".join(f"{n}:{s}:{e}" for n, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1])))
        r, counts = rows[k], Counter(n for n, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[n] for n in pii.KINDS), text
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest(), text
        assert r.spans == written(base + added[k - 1]), text
    assert sum(map(bool, added)) == 2


def least_padding(lengths, buckets):
    """Quadratic dynamic programming over the sorted different lengths."""
    counts = sorted(Counter(lengths).items())
    n = len(counts)
    cost = [[0] * (n + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(i + 1, n + 1):
            cost[i][j] = sum((counts[j - 1][0] - s) * c for s, c in counts[i:j])
    best = [0] + [cost[0][j] for j in range(1, n + 1)]
    for _ in range(buckets - 1):
        best = [0] + [min(best[i] + cost[i][j] for i in range(j)) for j in range(1, n + 1)]
    return best[n]


def test_op3_packing_equals_quadratic_programming(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = [None, "", *[prose(rng.choice([3, 40, 41, 200, rng.randint(1, 900)]), k) for k in range(90)], prose(30_000, 7)]
    rows = packing.op3_packing(spark, tables(spark, tmp_path, texts)).collect()
    plain = Tokenizer.from_file(token_ids.default_tokenizer())
    want = {k: len(plain.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts, 1)}
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert sum(r.padding for r in rows) == least_padding(list(want.values()), packing.BUCKETS)
    batches = {}
    for r in rows:
        assert r.padding == r.boundary - r.n_tokens >= 0
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), members in batches.items():
        assert sorted(m.place for m in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].boundary <= packing.BUDGET
        if (bucket, batch + 1) in batches:  # full but the last
            assert (len(members) + 1) * max(members[0].boundary, 1) > packing.BUDGET


def test_op4_sharding_is_even_and_gapless(spark, tmp_path):
    texts = [None, "", *[prose(k % 50 + 1, k % 70) for k in range(400)]]
    rows = sharding.op4_sharding(spark, tables(spark, tmp_path, texts)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts, 1):
        data = (t or "").encode()
        assert (by[k].size, by[k].text_crc32, by[k].law, by[k].grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_sharding_splits_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 20)
    rows = spark.createDataFrame([(7 if k % 3 == 0 else k, k % 5) for k in range(600)], "doc_id long, size long")
    from pyspark.sql import functions as F

    out = sharding.assign(rows.withColumn("place", F.xxhash64("doc_id")), shards=6, vnodes=8).collect()
    counts = Counter(r.shard for r in out)
    assert len(out) == 600 and set(counts.values()) == {100}
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(100)) for s in counts)


def test_op5_warc_equals_plain_grouping(spark, tmp_path):
    rng = random.Random(4)
    pages = [(k, f"http://h/{k}", rng.choice([None, "", "same", f"<p>{k % 9}</p>", "é" * 5000])) for k in range(1, 120)]
    path = tables(spark, tmp_path, ["x"], pages=(pages, "page_id long, url string, html string"))
    rows = {r.page_id: r for r in warc.op5_warc(spark, path).collect()}
    assert len(rows) == len(pages)
    last = {}
    for k, _, html in pages:
        last[html or ""] = max(last.get(html or "", 0), k)
    for k, _, html in pages:
        data = (html or "").encode()
        want = ("response", None) if last[html or ""] == k else ("revisit", last[html or ""])
        assert (rows[k].payload_bytes, rows[k].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (rows[k].record_type, rows[k].refers_to) == want


def test_op6_quality_equals_plain_counts(spark, tmp_path):
    rng = random.Random(6)
    texts = [None, "", prose(300, 1), "\n".join([prose(30, 2)] * 9), *["\n".join(" ".join(rng.choice(["a", "b#", "é", "cc|", "%%", "\x0b", "zz"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 9))) for _ in range(150)]]
    rows = {r.doc_id: r for r in quality.op6_quality(spark, tables(spark, tmp_path, texts)).collect()}
    for k, text in enumerate(texts, 1):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeated = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
        seen, dups = set(), 0
        for line in text.split("\n"):
            dups += line in seen
            if re.search(r"[^\x20\x09-\x0D]", line):
                seen.add(line)
        r = rows[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(repeated)), text
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert r.base_failed == failed and r.kept == (not failed and plain_verdict(text, words))


def plain_verdict(text, words):
    chars = sum(map(len, words))
    for n, most in quality.GRAM_BOUNDS.items():
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        inside = {i + j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(n)}
        if sum(len(words[i]) for i in inside) / chars > most:
            return False
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        elif line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            seen.add(line)
    return dup / chars <= quality.LINE_BOUND


def plain_passages(texts, least=0.8):
    """Pairs of texts and their passages, from all common shingles."""
    sets = features.shingles(pa.array(texts))
    where = {}
    for k, found in enumerate(sets):
        for c, h in enumerate(found.tolist()):
            where.setdefault(h, []).append((k, c))
    anchors = {}
    for places in where.values():
        for a, c in places:
            for b, d in places:
                if a < b:
                    anchors.setdefault((a, b), []).append((c, d))
    return {pair: found for pair, at in anchors.items() if (found := passages.shared_passages(sets[pair[0]], sets[pair[1]], at, least))}


def families(words, n, seed):
    """n families of five texts: a passage as it is and four copies with one word changed, between other words."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        passage = prose(words, seed * 1000 + k)
        out += [f"{prose(60, rng.randrange(10**9))} {p} {prose(60, rng.randrange(10**9))}" for p in [passage, *[one_edit(passage, rng, 0, 1) for _ in range(4)]]]
    rng.shuffle(out)
    return out


def recall(rows, pairs, n):
    """(share of the documents, share of the true pairs in one class) that were found."""
    found = {r.doc_id - 1: r.class_id for r in rows}
    members = {k for pair in pairs for k in pair}
    together = sum(a in found and found.get(a) == found.get(b) for a, b in pairs)
    return len(members & set(found)) / len(members), together / len(pairs)


@pytest.mark.parametrize("words", [50, 60, 80])
def test_op10_passages_recall_against_brute_force(spark, tmp_path, words):
    texts = families(words, 60, words)
    path = tables(spark, tmp_path, texts)
    rows = passages.op10_passages(spark, path).collect()
    pairs = plain_passages(texts)
    docs, together = recall(rows, pairs, len(texts))
    print(f"{words} words: {docs:.3f} of documents, {together:.3f} of pairs")
    assert docs >= 0.97 and together >= 0.97
    assert {r.doc_id - 1 for r in rows} <= {k for pair in pairs for k in pair}


def test_op10_passages_with_a_common_phrase_and_a_chain_of_variants(spark, tmp_path):
    """A phrase of 25 words in every text, in a third of them within a passage that two texts share; and a chain of variants each
    like the next only."""
    rng = random.Random(12)
    phrase = prose(25, 77)
    texts = []
    for k in range(40):
        around = (prose(20, 5000 + k), prose(20, 6000 + k))
        texts += [f"{prose(50, rng.randrange(10**9))} {around[0]} {phrase} {around[1]} {prose(50, rng.randrange(10**9))}" for _ in range(2)]
    texts += [f"{prose(70, 7000 + k)} {phrase} {prose(70, 8000 + k)}" for k in range(80)]
    chain = prose(100, 99)
    for k in range(6):
        texts.append(f"{prose(40, 9000 + k)} {chain} {prose(40, 9100 + k)}")
        w = chain.split()
        w[12 * k + 15] = f"link{k}"
        chain = " ".join(w)
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[k] for k in order]
    rows = passages.op10_passages(spark, tables(spark, tmp_path, [None, "", *texts, texts[0]])).collect()
    pairs = plain_passages(texts)
    found = {r.doc_id - 3: r.class_id for r in rows}
    together = sum(a in found and found.get(a) == found.get(b) for a, b in pairs) / len(pairs)
    print(f"{together:.3f} of {len(pairs)} pairs")
    assert together >= 0.95
    assert found[0] == found[len(texts)]  # copies


def test_passage_runs_are_long_enough_for_the_windows():
    """Every passage of 46 shingles and more at 0.8 has an equal run of RUN shingles: one hash function finds it."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(50, 160)
        a = prose(n, rng.randrange(10**9)).split()
        b = list(a)
        for _ in range(rng.randint(1, 5)):
            k = rng.randrange(len(b))
            kind = rng.randrange(3)
            b[k : k + (kind != 1)] = [f"new{rng.randrange(10**6)}"] * (kind != 2)
        x, y = (features.shingles_of(" ".join(w)) for w in (a, b))
        if min(len(x), len(y)) >= passages.LENGTH and passages.jaccard(x, y) >= 0.8:
            run = max((passages.run_length(x[i:], y[j:]) for i in range(len(x)) for j in np.flatnonzero(y == x[i])), default=0)
            assert run >= passages.RUN
            assert set(passages.files(x)[0].tolist()) & set(passages.files(y)[0].tolist())


def plain_classes(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = minhash.shingle_weights(docs, Workspace(spark, "t"))
    sets = minhash.weighted(pa.array(texts), idf)
    top = list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or minhash.similarity(sets[i], sets[j]) >= 0.8:
                top[root(i)] = root(j)
    return [root(k) for k in range(len(texts))]


def plain_leaks(text, items, only=None):
    """Whether a window of an item's length has a weighted similarity of 0.8 and more with it; shingles weigh by how few items have them."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()
    each = [words(t) for t in items if words(t)]
    df = Counter(g for w in each for g in grams(w))
    weigh = lambda g: 1 + np.log((1 + len(each)) / (1 + df[g]))
    own = words(text)
    for item in each if only is None else [words(only)]:
        want = grams(item)
        if len(own) < min(len(item), 5) or len(item) < 5 and len(own) != len(item):
            continue
        for at in range(max(len(own) - len(item), 0) + 1):
            seen = grams(own[at : at + len(item)])
            both = sum(min(n, seen[g]) * weigh(g) for g, n in want.items())
            if both and both / (sum(n * weigh(g) for g, n in want.items()) + sum(n * weigh(g) for g, n in seen.items()) - both) >= 0.8:
                return True
    return False


def test_pipeline_equals_the_plain_version(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(21)
    base, item = prose(160, 1), prose(45, 2)
    texts = [None, "", "too short", base, base, *[one_edit(base, rng) for _ in range(4)], "\n".join([prose(60, 3)] * 5)]
    texts += [f"{prose(40, 50 + k)} {item if k % 2 else one_edit(item, rng)} {prose(40, 90 + k)}" for k in range(4)]
    texts += [f"{prose(70, 200 + k)} write to me{k}@mail.example.org or +49 30 {1000000 + k}" for k in range(15)]
    texts += [prose(rng.randint(50, 400), 300 + k) for k in range(30)]
    path = tables(spark, tmp_path, texts, benchmark=([(1, item), (2, None), (3, "")], "item_id long, text string"))
    rows = corpus_pipeline.run(spark, path).collect()

    at = len(quality.MEASURES) + 1
    kept = [k for k, t in enumerate(texts) if quality.measure(t)[at]]
    classes = plain_classes(spark, [texts[k] for k in kept])
    kept = [k for n, k in enumerate(kept) if classes.index(classes[n]) == n]
    kept = [k for k in kept if not plain_leaks(texts[k], [item, None, ""])]
    out = {}
    for k in kept:
        text = texts[k]
        for kind, s, e in sorted(plain_base(text), key=lambda x: -x[1]):
            text = text[:s] + f"[{kind}]" + text[e:]
        out[k + 1] = text
    assert sorted(r.doc_id for r in rows) == sorted(out)
    assert {r.doc_id: r.n_tokens for r in rows} == {k: len(token_ids.ChunkEncoder(token_ids.default_tokenizer(), 4).encode(t)) // 4 for k, t in out.items()}
    assert sum(r.padding for r in rows) == least_padding([r.n_tokens for r in rows], packing.BUCKETS)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_simhash_counts_items_of_more_than_sixteen_thousand_words(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-(1 << 63), 1 << 63, 20_001)
    rows = spark.createDataFrame([([int(x) for x in h],)], "words array<bigint>")
    (found,) = rows.select(decontam.simhash("words", decontam.lane_width(20_001)).alias("f")).first()
    bits = (h.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = sum(1 << k for k, n in enumerate(bits.sum(axis=0)) if 2 * int(n) > len(h))
    assert found & ((1 << 64) - 1) == want


def test_shared_folder_is_never_a_machines_own_on_a_cluster(spark):
    from marketlake.llm import common

    class Conf:
        def __init__(self, **settings):
            self.settings = {k.replace("_", "."): v for k, v in settings.items()}

        def get(self, name, default=None):
            return self.settings.get(name, default)

    class Session:
        def __init__(self, **settings):
            self.conf = Conf(**settings)

    assert common.shared_dir(Session(**{"spark_checkpoint_dir": "hdfs://x/y/"})) == "hdfs://x/y"
    with pytest.raises(ValueError):
        common.shared_dir(Session(spark_master="spark://a:1"))
    mine = common.shared_dir(Session(spark_master="local[2]", spark_app_id="none"))
    assert mine == common.shared_dir(Session(spark_master="local[2]", spark_app_id="none")) and mine.startswith("file:///tmp/spark-")


def test_op7_leaks_equal_plain_windows(spark, tmp_path):
    """Every document and item through the query; each item laid at every place of every text."""
    from marketlake.llm.decontam import op7_decontamination

    rng = random.Random(21)
    items = [prose(n, 900 + k) for k, n in enumerate((12, 30, 45, 3, 60))] + [None, ""]
    items.append(items[1])  # an item that repeats
    texts = [prose(120, 800 + k) for k in range(15)] + [None, "", items[3]]
    for k in (0, 1, 2, 4):
        for changes in (0, 1, 2, 4):
            w = items[k].split()
            for at in rng.sample(range(len(w)), min(changes, len(w))):
                w[at] = f"new{at}"
            texts.append(f"{prose(rng.randint(0, 60), 700 + 10 * k + changes)} {' '.join(w)} {prose(rng.randint(0, 60), 600 + 10 * k + changes)}")
    texts += texts[-3:]
    rows = [(k, t) for k, t in enumerate(items)]
    path = tables(spark, tmp_path, texts, benchmark=(rows, "item_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in op7_decontamination(spark, path).collect()}
    listed = [t for t in items if t]
    want = set()
    for k, text in enumerate(texts, 1):
        for item, content in rows:
            if content and plain_leaks(text, listed, only=content):
                want.add((k, item))
    assert found == want and len(want) >= 10


def test_op1_classes_equal_all_pairs(spark, tmp_path):
    """Class, size and representative of every row through the query."""
    from marketlake.llm.minhash import op1_minhash

    rng = random.Random(22)
    texts = [prose(rng.randint(60, 140), 500 + k) for k in range(12)]
    for k in range(8):
        copy = texts[k]
        for _ in range(3):
            copy = one_edit(copy, rng)
            texts.append(copy)
    texts += [texts[0], texts[12], None, None, "", "two words", "two words"]
    path = tables(spark, tmp_path, texts)
    found = {r.doc_id: (r.class_id, r.class_size) for r in op1_minhash(spark, path).collect()}
    labels = plain_classes(spark, texts)
    members = {}
    for k, label in enumerate(labels, 1):
        members.setdefault(label, []).append(k)
    assert found == {k: (min(members[label]), len(members[label])) for k, label in enumerate(labels, 1)}
