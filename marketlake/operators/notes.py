"""News-note operators: rules as columns and small tables, ranked caps, funnel accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import fold, has_word


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """Sorted different keywords that the folded text holds as words; NULL if none."""
    hits = F.array_compact(F.array(*[F.when(has_word(text, k), F.lit(k)) for k in sorted(set(keywords))]))
    return F.when(F.size(hits) > 0, hits)


def topic_scores(text: Column, rules: dict[str, tuple[list[str], list[str]]]) -> Column:
    """Array of (score, -order, topic): ten for each strong keyword, and one for each weak one if there is a strong one."""
    count = lambda words: sum((has_word(text, w).cast("int") for w in words), F.lit(0))
    out = []
    for k, (topic, (strong, weak)) in enumerate(rules.items()):
        s = count(strong)
        out.append(F.struct((s * 10 + F.when(s > 0, count(weak)).otherwise(0)).alias("score"), F.lit(-k).alias("order"), F.lit(topic).alias("topic")))
    return F.array(*out)


def classify(notes: DataFrame, text: str, rules: dict[str, tuple[list[str], list[str]]], exclude: list[str]) -> DataFrame:
    """notes with topic and topic_score: the best topic, the earlier one on ties; none (NULL, 0) if a word of exclude is there."""
    rows = notes.withColumn("__folded", fold(F.col(text)))
    veto = F.lit(False)
    for w in exclude:
        veto = veto | has_word(F.col("__folded"), w)
    rows = rows.withColumn("__best", F.array_max(topic_scores(F.col("__folded"), rules)))
    good = (F.col("__best.score") > 0) & ~veto
    return rows.withColumns({"topic": F.when(good, F.col("__best.topic")), "topic_score": F.when(good, F.col("__best.score")).otherwise(0)}).drop("__folded", "__best")


def daily_cap(notes: DataFrame, cap: int, incumbent: str = "incumbent") -> DataFrame:
    """notes with kept: the best `cap` of each day; incumbents win ties, so that only a strictly better note replaces one."""
    order = Window.partitionBy("fecha").orderBy(F.desc("score10"), F.desc(incumbent), F.desc("id"))
    return notes.withColumn("kept", F.row_number().over(order) <= cap)


def representatives(notes: DataFrame, cluster: str, tier: str) -> DataFrame:
    """One note of each cluster: lowest tier, then highest score, then least id; with the other portals and the best score."""
    order = Window.partitionBy(cluster).orderBy(tier, F.desc("score10"), "id")
    first = notes.withColumn("__k", F.row_number().over(order)).where("__k = 1").select(cluster, "id", "portal")
    sums = notes.groupBy(cluster).agg(F.max("score10").alias("best"), F.array_sort(F.collect_set("portal")).alias("portals"))
    return first.join(sums, cluster).select(cluster, "id", "best", F.array_join(F.array_remove(F.col("portals"), F.col("portal")), ",").alias("also_in"))


def feed_places(notes: DataFrame) -> DataFrame:
    """notes with place: date descending, score descending, id. Ranks are counted within a (date, score); blocks by sums."""
    block = ["fecha", "score10"]
    sizes = notes.groupBy(*block).agg(F.count("*").alias("n"))
    # a row for each day and score
    order = Window.orderBy(F.desc("fecha"), F.desc("score10"))
    before = sizes.select(*block, (F.sum("n").over(order) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*block).orderBy("id"))
    ranked = notes.withColumn("rank", rank)
    same = ranked["fecha"].eqNullSafe(before["fecha"]) & ranked["score10"].eqNullSafe(before["score10"])
    return ranked.join(before, same).select(*[ranked[c] for c in notes.columns], (F.col("before") + F.col("rank")).alias("place"))


def seen_within(rows: DataFrame, keys: list[str], order: list[str], days: int) -> DataFrame:
    """rows with seen: whether the row before of the same key is at most `days` days older; order begins with the time."""
    before = F.lag(order[0]).over(Window.partitionBy(*keys).orderBy(*order))
    age = F.unix_micros(F.col(order[0]).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    return rows.withColumn("seen", F.coalesce(age <= days * 86_400_000_000, F.lit(False)))


def retry_candidates(notes: DataFrame, open_: str, cap: int, top: int) -> DataFrame:
    """The `top` best notes that are still open (a condition) and had fewer than `cap` attempts."""
    return notes.where(f"({open_}) AND attempts < {cap}").orderBy(F.desc("score10"), "id").limit(top)


def rotated_pictures(notes: DataFrame, sets: dict[str, int], cooldown_days: int = 3) -> DataFrame:
    """id, picture (slug-k) of notes (id, slug, fecha, hora): each note takes the picture of its slug's set that was used longest
    ago, among those not used for `cooldown_days`, or of all if none is.

    A day's choices follow from its number of notes and what the day before leaves: first the free pictures, longest unused first, then
    all of them in turn, those that weren't free before the others. So days are counted, a slug's few days gone through in order (day_plans), and each note
    takes its picture by its place in the day; no group is larger than a slug's day. Notes without a day come first and find all
    pictures free. Slugs without a set and notes without a slug have no picture.
    """
    import pandas as pd

    def plan(days: pd.DataFrame) -> pd.DataFrame:
        slug = days["slug"].iloc[0]
        rows = days.sort_values("fecha", na_position="first", kind="stable")
        plans = day_plans(sets[slug], [(None if pd.isna(d) else d, int(n)) for d, n in zip(rows["fecha"], rows["n"], strict=True)], cooldown_days)
        return pd.DataFrame({"slug": slug, "fecha": rows["fecha"].to_numpy(), "free": [p[0] for p in plans], "turns": [p[1] for p in plans]})

    good = F.coalesce(F.col("slug").isin(*[s for s, n in sets.items() if n > 0]), F.lit(False)) if sets else F.lit(False)
    rows = notes.where(good).select("id", "slug", "fecha", "hora")
    plans = rows.groupBy("slug", "fecha").agg(F.count("*").alias("n")).groupBy("slug").applyInPandas(plan, "slug string, fecha date, free array<int>, turns array<int>")  # a row per day
    order = Window.partitionBy("slug", "fecha").orderBy(F.asc_nulls_first("hora"), F.asc_nulls_first("id"))
    placed = rows.withColumn("place", F.row_number().over(order) - 1)
    both = placed.join(plans.withColumnsRenamed({"slug": "s", "fecha": "d"}), (F.col("slug") == F.col("s")) & F.col("fecha").eqNullSafe(F.col("d")))
    number = F.coalesce(F.get("free", F.col("place")), F.get("turns", F.pmod(F.col("place") - F.size("free"), F.size("turns"))))
    chosen = both.select("id", F.concat_ws("-", "slug", number.cast("string")).alias("picture"))
    return chosen.unionByName(notes.where(~good).select("id", F.lit(None).cast("string").alias("picture")))


def day_plans(n: int, days: list[tuple[object, int]], cooldown_days: int) -> list[tuple[list[int], list[int]]]:
    """For each (day, number of notes) in order: the pictures (1 to n) of its first notes, and those that the others take in turn."""
    waiting, used, out = list(range(1, n + 1)), {}, []  # waiting: longest unused first
    for day, notes in days:
        free = [k for k in waiting if day is None or k not in used or (day - used[k]).days >= cooldown_days]
        turns = [k for k in waiting if k not in set(free)] + free
        out.append((free, turns))
        more = notes - len(free)
        taken = free[:notes] if more <= 0 else free + turns[:more]
        waiting = [k for k in waiting if k not in set(taken)] + taken if more <= 0 else turns[more % n :] + turns[: more % n]
        if day is not None:
            used |= dict.fromkeys(taken, day)
    return out


def portal_order(notes: DataFrame, portals: list[str]) -> DataFrame:
    """notes in the order in which duplicates are looked for: by the portal's place in a list, others last, then score, then id."""
    place = F.nullif(F.array_position(F.array(*[F.lit(p) for p in portals]), F.col("portal")), F.lit(0))
    return notes.withColumn("portal_place", F.coalesce(place, F.lit(len(portals) + 1)).cast("int")).orderBy("portal_place", F.desc("score10"), "id")


def boosted(score: Column, portal: Column, institutions: list[str], cut: int, plus: int = 10, most: int = 100) -> Column:
    """The score of an institution's note that is over the cut, raised and capped; others as they are."""
    return F.when(portal.isin(institutions) & (score >= cut), F.least(score + plus, F.lit(most))).otherwise(score)


def impact(score: Column) -> Column:
    """high from 80, medium from 70, else low (scores of 0 to 100)."""
    return F.when(score >= 80, "high").when(score >= 70, "medium").otherwise("low")


def funnel(notes: DataFrame, stages: list[tuple[str, Column]], kept: str = "kept") -> DataFrame:
    """stage, n, total: each note under the first stage whose condition holds; a last row `unaccounted` is the total less all stages,
    0 if the books balance."""
    stage = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in stages], F.lit(kept))
    counts = notes.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))
    total = notes.agg(F.count("*").alias("total"))
    rows = counts.crossJoin(F.broadcast(total))  # one row
    rest = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sum")).crossJoin(F.broadcast(total)).select(F.lit("unaccounted").alias("stage"), (F.col("total") - F.col("sum")).alias("n"), "total")
    return rows.unionByName(rest)


def exit_log(populations: dict[str, DataFrame], today: str, keep_days: int = 30) -> DataFrame:
    """url, fecha, reason of all exits: populations are (url, fecha) by reason; of several reasons for one url and day the last
    population's counts, and what is older than keep_days is purged."""
    parts = [rows.select("url", "fecha", F.lit(name).alias("reason"), F.lit(k).alias("k")) for k, (name, rows) in enumerate(populations.items())]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    recent = log.where(F.col("fecha") > F.date_sub(F.lit(today).cast("date"), keep_days))
    return recent.groupBy("url", "fecha").agg(F.max_by("reason", "k").alias("reason"))


def note_rows(candidates: DataFrame, categories: dict[str, str], summary_chars: int = 200, detail_chars: int = 2000) -> DataFrame:
    """Candidates (url, published (UTC), portal, topic, title, body, score10) as notes: id, fecha, hora, source, category, title, summary,
    detail, impact, domain. Local time is UTC-4; a topic without a category is `other`."""
    from ..functions.text import cut_at_word, slug, summary, url_key

    local = F.col("published") - F.expr("INTERVAL 4 HOURS")
    category = F.create_map(*[F.lit(x) for pair in categories.items() for x in pair])[F.col("topic")]
    return candidates.select(
        F.substring(F.md5(url_key(F.col("url"))), 1, 16).alias("id"), F.to_date(local).alias("fecha"), F.date_format(local, "HH:mm").alias("hora"), slug(F.col("portal")).alias("source"),
        F.coalesce(category, F.lit("other")).alias("category"), "title", summary(F.col("body"), summary_chars).alias("summary"), cut_at_word(F.col("body"), detail_chars, "…").alias("detail"),
        impact(F.col("score10")).alias("impact"), F.regexp_extract(F.lower("url"), "^[a-z]+://([^/]+)", 1).alias("domain"),
    )


def without_picture(notes: DataFrame, today: str, days: int = 30) -> DataFrame:
    """The notes of the last days that have no picture: candidates for another look at their page."""
    return notes.where((F.col("fecha") > F.date_sub(F.lit(today).cast("date"), days)) & F.col("image").isNull())


def rotated_cap(notes: DataFrame, cap: int, incumbent: str = "incumbent", newest: str = "newest") -> DataFrame:
    """notes with fate: kept, evicted (an incumbent that isn't kept) or left out (a candidate that isn't).

    The best `cap` of a day stay. A candidate replaces the day's least incumbent only if strictly better, so incumbents win
    ties; of incumbents with one score the newest stays. The cut is found by counting scores, and only the notes at the cut's
    own score are ranked, so a day of very many notes isn't sorted in one task.
    """
    counts = notes.groupBy("fecha", "score10").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("fecha").orderBy(F.desc("score10"))) - F.col("n")
    # a row for each day and score
    edge = counts.withColumn("above", above).where((F.col("above") < cap) & (F.col("above") + F.col("n") > cap)).select(F.col("fecha").alias("__f"), F.col("score10").alias("__s"), (cap - F.col("above")).alias("__room"))
    least = counts.withColumn("above", above).where(F.col("above") < cap).groupBy("fecha").agg(F.min("score10").alias("__least"))
    rows = notes.join(least, "fecha", "left")
    tied = rows.join(edge, (F.col("fecha") == F.col("__f")) & (F.col("score10") == F.col("__s")), "left")
    at_edge = tied.where("__room IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("fecha").orderBy(F.desc(incumbent), F.desc(newest), "id"))
    ranked = at_edge.withColumn("__kept", rank <= F.col("__room"))
    clear = tied.where("__room IS NULL").withColumn("__kept", F.coalesce(F.col("score10") >= F.col("__least"), F.lit(False)))
    fate = F.when(F.col("__kept"), "kept").when(F.col(incumbent) == 1, "evicted").otherwise("left out")
    return ranked.unionByName(clear).select(*[F.col(c) for c in notes.columns], fate.alias("fate"))


def lane_budget(candidates: DataFrame, used: DataFrame, budget: int, lane: str, day: str, order: list[str]) -> DataFrame:
    """The first candidates of each lane and day, as many as the budget less what is used already (lane, day, used)."""
    left = used.select(F.col(lane).alias("__l"), F.col(day).alias("__d"), "used")
    rank = F.row_number().over(Window.partitionBy(lane, day).orderBy(*order))
    rows = candidates.withColumn("__k", rank).where(F.col("__k") <= budget)
    rows = rows.join(left, rows[lane].eqNullSafe(F.col("__l")) & rows[day].eqNullSafe(F.col("__d")), "left")
    return rows.where(F.col("__k") <= budget - F.coalesce("used", F.lit(0))).select(*candidates.columns)


def fresh_quotes(quotes: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """quotes (source, bid, ask, ts) with fresh: snapshots always, others with both sides and at most `minutes` old; a quote without
    a time isn't old."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    two_sided = F.col("bid").isNotNull() & F.col("ask").isNotNull()
    fresh = F.coalesce(F.contains("source", F.lit("snapshot")), F.lit(False)) | (two_sided & F.coalesce(age <= minutes * 60_000_000, F.lit(True)))
    return quotes.withColumn("fresh", fresh)


def source_cascade(quotes: DataFrame, priority: list[str], key: str = "key") -> DataFrame:
    """The fresh quote of each key from the first source of the list; other sources come last, then the newest."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("source")), F.lit(0)), F.lit(len(priority) + 1))
    best = F.struct(place.alias("p"), (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("t"))
    return quotes.where("fresh").groupBy(key).agg(F.min_by(F.struct("source", "bid", "ask", "ts"), best).alias("q")).select(key, "q.*")


def spend(ledger: DataFrame, cap: int) -> DataFrame:
    """ledger (month, ts, id, cost) with allowed: whether the month's cost before the call is under the cap.

    A month's calls are summed by day first, so that only a day's calls are ordered in one place.
    """
    days = ledger.withColumn("__day", F.to_date("ts"))
    sums = days.groupBy("month", "__day").agg(F.sum("cost").alias("c"))
    before = sums.select("month", "__day", (F.sum("c").over(Window.partitionBy("month").orderBy("__day")) - F.col("c")).alias("__before"))
    past = Window.partitionBy("month", "__day").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = days.join(before, ["month", "__day"]).withColumn("__spent", F.col("__before") + F.coalesce(F.sum("cost").over(past), F.lit(0)))
    return rows.withColumn("allowed", F.col("__spent") < cap).drop("__day", "__before", "__spent")


def log_levels(lines: DataFrame, now: Column, hours: int = 24, levels: tuple[str, ...] = ("ERROR", "WARN", "INFO")) -> DataFrame:
    """level, n of log lines (text that begins with a time and a level) of the last hours."""
    listed = "|".join(levels)
    parsed = lines.select(F.regexp_extract("line", r"^([0-9-]{10}[T ][0-9:]{8})", 1).try_cast("timestamp").alias("ts"), F.regexp_extract("line", rf"\b({listed})\b", 1).alias("level"))
    recent = (F.unix_micros(now.cast("timestamp")) - F.unix_micros("ts")).between(0, hours * 3_600_000_000)
    return parsed.where(recent & (F.col("level") != "")).groupBy("level").agg(F.count("*").alias("n"))
