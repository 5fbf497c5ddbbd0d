"""Rule packs: the tables of rules.py as JSON documents that users keep and change, wherever Spark can read them.

An entry names its words by how they stand in a text: `terms` anywhere, `words` alone, `ends` at the end of a word, and `patterns` as
regular expressions; letters are those of any alphabet, digits and signs end a word. An unknown field or an empty entry is an error, so
that a slip in a pack isn't a rule that never holds. The packs in the folder `packs` are those that the library brings.
"""

from __future__ import annotations

import json
from importlib.resources import files

from pyspark.sql import Column, SparkSession

from . import facts, rules

WAYS = ("terms", "words", "ends", "patterns")
LETTER = r"\p{L}"


def own_pack(name: str) -> dict:
    """A pack of the library."""
    return json.loads((files("marketlake") / "packs" / f"{name}.json").read_text(encoding="utf-8"))


def load_pack(spark: SparkSession, path: str) -> dict:
    """A pack from any store that Spark reads: one JSON document."""
    (row,) = spark.read.text(path, wholetext=True).collect()
    return json.loads(row.value)


def _quoted(term: str) -> str:
    return "".join(rf"\{c}" if not (c.isalnum() or c.isspace()) else c for c in term)


def pattern(entry: dict) -> str | None:
    """The entry's words as one pattern; None if it has none."""
    parts = [_quoted(t) for t in entry.get("terms", ())]
    parts += [rf"(?<!{LETTER}){_quoted(t)}(?!{LETTER})" for t in entry.get("words", ())]
    parts += [rf"{_quoted(t)}(?!{LETTER})" for t in entry.get("ends", ())]
    parts += [f"(?:{p})" for p in entry.get("patterns", ())]
    return "|".join(parts) if parts else None


def _checked(entry: dict, *more: str) -> dict:
    if unknown := set(entry) - {*WAYS, *more}:
        raise ValueError(f"a pack's entry has unknown fields: {', '.join(sorted(unknown))}")
    return entry


def scale(pack: dict) -> rules.Scale:
    """The editorial scale: a penalty without words stands for the flag."""
    _checked(pack, "comment", "version", "penalties", "institutions", "keywords", "portals")
    penalties = []
    for p in pack["penalties"]:
        _checked(p, "name", "factor", "title_only", "unless")
        unless = pattern(_checked(p["unless"])) if "unless" in p else None
        penalties.append(rules.Penalty(p["name"], float(p["factor"]), pattern(p), p.get("title_only", False), unless))
    if [p.name for p in penalties if p.pattern is None][1:]:
        raise ValueError("only one penalty can stand for the flag")
    bonus = {k: _checked(pack.get(k, {}), "factor") for k in ("institutions", "keywords")}
    more = {f"{k}_factor": float(b["factor"]) for k, b in bonus.items() if b} | {k: pattern(b) for k, b in bonus.items() if b}
    return rules.Scale(tuple(penalties), portals=pack.get("portals", {}), version=pack.get("version", 1), **more)


def tag_rules(pack: dict) -> tuple[list[tuple[str, str]], dict[str, str], int]:
    """What rules.tags() takes: (name, pattern) in order, tags of sections, and how many."""
    _checked(pack, "comment", "most", "tags", "sections")
    found = [(t["name"], pattern(_checked(t, "name"))) for t in pack["tags"]]
    if empty := [name for name, p in found if p is None]:
        raise ValueError(f"tags without words: {', '.join(empty)}")
    return found, pack.get("sections", {}), pack.get("most", 3)


def category(pack: dict, event: Column) -> Column:
    """The category of a folded event name; NULL for what is no incident."""
    _checked(pack, "comment", "rest", "filtered", "categories")
    of = {name: group for group, names in pack["categories"].items() for name in names}
    if len(of) != sum(map(len, pack["categories"].values())):
        raise ValueError("an event has two categories")
    return facts.categories(event, of, pack.get("filtered", []), pack.get("rest", "other"))
