"""Same-event groups, repeats, rotation and rules against plain loops."""

import datetime
import random

from pyspark.sql import functions as F

from marketlake.operators import events, notes, rules

WORDS = "price bank river rate trade house port grain fuel gold law vote road tax loan".split()


def some_notes(n, seed, days=10):
    rng = random.Random(seed)
    pool = [rng.sample(WORDS, rng.randint(3, 8)) for _ in range(max(n // 6, 2))]
    rows = []
    for k in range(n):
        title = list(rng.choice(pool))
        for _ in range(rng.randint(0, 2)):
            title[rng.randrange(len(title))] = rng.choice(WORDS)
        entities = sorted(rng.sample(["X", "Y", "Z"], rng.randint(0, 2)))
        rows.append((k, datetime.date(2024, 1, 1 + rng.randrange(days)), rng.randint(0, 20), " ".join(title), entities, sorted(rng.sample(["1_mil", "2_mil"], rng.randint(0, 1)))))
    return rows + [(n, datetime.date(2024, 1, 1), 3, "", [], []), (n + 1, datetime.date(2024, 1, 1), 3, None, ["X"], None)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id long, fecha date, score int, title string, entities array<string>, amounts array<string>")
    return df.withColumn("tokens", events.tokens(F.col("title")))


def overlap(a, b):
    a, b = set((a or "").split()), set((b or "").split())
    return len(a & b) / max(len(a), len(b)) if a and b else 0.0


def same(a, b):
    sim = overlap(a[3], b[3])
    return sim >= 0.70 or sim >= 0.50 and bool(set(a[4] or []) & set(b[4] or [])) or sim >= 0.62 and bool(set(a[5] or []) & set(b[5] or []))


def test_greedy_groups_equal_the_loop(spark):
    for seed in (1, 2):
        rows = some_notes(150, seed)
        want, heads = {}, {}
        for r in sorted(rows, key=lambda r: (-r[2], r[0])):
            mine = heads.setdefault(r[1], [])
            head = next((h for h in mine if same(r, h)), None)
            if head is None:
                mine.append(r)
            want[r[0]] = (head or r)[0]
        found = {r.id: r.head for r in events.greedy_groups(frame(spark, rows), ["fecha"]).collect()}
        assert found == want


def test_repeated_equals_the_loop(spark):
    rows = some_notes(120, 3, 20)
    found = {r.id: r.repeated for r in events.repeated(frame(spark, rows)).collect()}
    assert found == {b[0]: any(1 <= (b[1] - a[1]).days <= 7 and same(a, b) for a in rows) for b in rows}


def test_token_sort_ratio_equals_dynamic_programming(spark):
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab c") for _ in range(rng.randint(0, 90))) for _ in range(2))
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
        assert events.common_length(a, b) == rows[-1][-1]
    df = spark.createDataFrame([("b a", "a b"), ("", None), ("abc", "abd")], "a string, b string")
    assert [round(r[0], 6) for r in df.select(events.token_sort_ratio("a", "b")).collect()] == [1.0, 1.0, round(4 / 6, 6)]


def test_rotation_equals_the_loop(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice(["a", "b", "none", None]), None if rng.random() < 0.1 else datetime.date(2024, 1, rng.randint(1, 9)), f"{rng.randint(0, 23):02}") for k in range(80)]
    sets, used, turn, want = {"a": 3, "b": 2}, {}, {}, {}
    for seq, (k, slug, day, _) in enumerate(sorted(rows, key=lambda r: (r[2] is not None, r[2] or datetime.date.min, r[3], r[0]))):
        n = sets.get(slug, 0)
        if not n:
            want[k] = None
            continue
        free = [p for p in range(1, n + 1) if day is None or (slug, p) not in used or (day - used[slug, p]).days >= 3] or range(1, n + 1)
        p = min(free, key=lambda p: (turn.get((slug, p), -1), p))
        want[k], turn[slug, p] = f"{slug}-{p}", seq
        if day is not None:
            used[slug, p] = day
    found = {r.id: r.picture for r in notes.rotated_pictures(spark.createDataFrame(rows, "id long, slug string, fecha date, hora string"), sets).collect()}
    assert found == want


def test_day_plans_equal_the_loop_on_busy_days():
    for seed in range(300):
        rng = random.Random(seed)
        n, days = rng.randint(1, 6), sorted({rng.randint(1, 12) for _ in range(6)})
        counts = [(None, rng.randint(0, 9))] * (seed % 2) + [(datetime.date(2024, 1, d), rng.randint(1, 15)) for d in days]
        used, turn, seq, want = {}, {}, 0, []
        for day, many in counts:
            for _ in range(many):
                free = [p for p in range(1, n + 1) if day is None or p not in used or (day - used[p]).days >= 3] or range(1, n + 1)
                p = min(free, key=lambda p: (turn.get(p, -1), p))
                want.append(p)
                turn[p], seq = seq, seq + 1
                if day is not None:
                    used[p] = day
        found = [free[k] if k < len(free) else turns[(k - len(free)) % n] for (_, many), (free, turns) in zip(counts, notes.day_plans(n, counts, 3), strict=True) for k in range(many)]
        assert found == want


def test_enriched_filings(spark):
    ladder = [rules.Step("coupons", text=("coupon",)), rules.Step("board", text=("director",)), rules.Step("staff", tags=("person",)), rules.Step("covenants", tags=("covenant",)), rules.Step("meetings", tags=("meeting",))]
    fields = {"coupons": {"n": "coupon +([0-9]+)", "bond": "of ([A-Z]+)"}, "board": {"who": "director ([A-Z][a-z]+)"}, "staff": {"who": "hires ([A-Z][a-z]+)"}}
    rows = [
        (1, "Pays coupon  12 of ABC", ["coupon"]), (2, "director Rojas leaves", []), (3, "the directors met", ["meeting"]), (4, "a note", ["person", "meeting"]), (5, "hires Paz", ["person", "meeting"]),
        (6, "ratio RCS >= 1,10 stands at 1,25; debt <= 3.0 is 4.5", ["covenant"]), (7, "will report later", ["covenant"]), (8, None, None), (9, "", []),
    ]
    items = spark.createDataFrame([(k, t, "s", "c", tags) for k, t, tags in rows], "id int, text string, section string, category string, tags array<string>")
    pattern = r"([A-Za-z]+) *(>=|<=|=>|=<) *([0-9.,]*[0-9])[^0-9]+([0-9.,]*[0-9])"
    out = {r.id: r for r in rules.enriched(items, ladder, fields, {"board": "who"}, {"staff": ("meeting", "who", "meetings")}, ("covenants", pattern, "reported", "announced"), 3).collect()}
    assert {k: r.grp for k, r in out.items()} == {1: "coupons", 2: "board", 3: "meetings", 4: "meetings", 5: "staff", 6: "reported", 7: "announced", 8: "other", 9: "other"}
    assert out[1].fields == {"n": "12", "bond": "ABC"} and out[2].fields == {"who": "Rojas"}
    assert [(x["name"], x["op"], x["required"], x["value"], x["ok"]) for x in out[6].indicators] == [("RCS", ">=", 1.1, 1.25, True), ("debt", "<=", 3.0, 4.5, False)]


def test_release_values(spark):
    texts = [("IPC de junio de 2026", "La variación mensual fue negativa de -0,35%, la acumulada de 4,2% y a doce meses 11.8%."), ("Nota", "Sin datos."), ("IPC mayo 2026", "variación mensual cayó 0,5 %")]
    df = spark.createDataFrame(texts, "t string, b string")
    found = [tuple(r.v) for r in df.select(rules.release_values(F.col("t"), F.col("b")).alias("v")).collect()]
    assert found == [("2026-06", -0.35, 4.2, 11.8), (None, None, None, None), ("2026-05", -0.5, None, None)]


def plain_same(a, b, title=0.70, entity=0.50, amount=0.62):
    if not a[0] or not b[0]:
        return False
    sim = len(a[0] & b[0]) / max(len(a[0]), len(b[0]))
    return sim >= title or (sim >= entity and bool(a[1] & b[1])) or (sim >= amount and bool(a[2] & b[2]))


def hot_titles(n, seed):
    """Titles of one to five words, of which one is in all of them and a few are frequent; few entities, one of them frequent."""
    rng = __import__("random").Random(seed)
    words = [f"w{k}" for k in range(12)]
    return [
        (k, k % 9, {"hot", *rng.sample(words, rng.randint(0, 4))}, set(rng.sample(["e1", "e2", "e3", "e4"], rng.choice([0, 0, 1, 2]))), {f"m{rng.randint(0, 6)}"} if rng.random() < 0.3 else set(), rng.randint(0, 9))
        for k in range(n)
    ]


def test_groups_and_repeats_with_a_token_in_every_title_equal_loops(spark, monkeypatch):
    import datetime as dt

    from marketlake.operators import events as ev

    monkeypatch.setattr(ev, "HEAVY", 20)  # so that tokens are dealt into blocks
    made = hot_titles(160, 3)
    rows = [(k, dt.date(2024, 1, 1 + d), sorted(t), sorted(e), sorted(m), s) for k, d, t, e, m, s in made]
    notes = spark.createDataFrame(rows, "id long, fecha date, tokens array<string>, entities array<string>, amounts array<string>, score int")
    heads, want = {}, {}
    for k, d, t, e, m, _ in sorted(made, key=lambda r: (-r[5], r[0])):
        mine = heads.setdefault(d, [])
        head = next((h for h, x in mine if plain_same(x, (t, e, m))), None)
        if head is None:
            mine.append((k, (t, e, m)))
        want[k] = k if head is None else head
    assert {r.id: r.head for r in ev.greedy_groups(notes, ["fecha"]).collect()} == want
    again = {k: any(1 <= d - x[1] <= 7 and plain_same(x[2:5], (t, e, m)) for x in made) for k, d, t, e, m, _ in made}
    assert {r.id: r.repeated for r in ev.repeated(notes).collect()} == again


def test_candidates_grow_with_the_rows_not_with_a_hot_token(spark):
    from marketlake.operators import events as ev

    def found(n):
        rows = [(k, ["hot", f"own{k}"], ["e1"] if k % 50 == 0 else [f"x{k}"], []) for k in range(n)]
        notes = ev.ranked_tokens(spark.createDataFrame(rows, "n long, tokens array<string>, entities array<string>, amounts array<string>"), ["n"])
        pairs = [ev.candidates(notes, notes, least, shared, [], F.col("a.n") < F.col("b.n")).count() for least, shared in ((0.7, None), (0.5, "entities"), (0.62, "amounts"))]
        return sum(pairs)

    assert found(400) <= 30 and found(800) <= 130  # pairs of the notes that share an entity besides, which are all alike
