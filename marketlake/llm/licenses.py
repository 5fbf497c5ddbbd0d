"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences (at blank lines and after . ! ?) that may be wrapped over lines; one that isn't known is cut at
line ends after a colon, then at all line ends, for notices without a stop. Each is normalised (lower case, runs of anything but a-z0-9
to one blank, the many ways to say "is released under the" to "licensed under") and mapped to the number of a known
licence sentence. The sequence of numbers, unknown sentences left out, is matched against ordered rules: the first rule
whose sequence occurs takes its sentences, then the next rule looks at what is left. Everything happens within the row, so
there is no shuffle and no skew.

Defined results: a null or empty text has no sentences and no licences; whole texts are scanned, however long; of rules that
claim the same sentences the earlier one has them; repeated rows and null doc_ids keep their own rows; other columns, with
whatever names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: SPDX identifier -> names that follow "licensed under the".
NAMES = {
    "MIT": ["mit license", "mit licence", "mit", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"],
    "GPL-2.0": ["gnu general public license version 2", "gnu gpl version 2", "gpl version 2", "gpl 2 0", "gpl v2", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu gpl version 3", "gpl version 3", "gpl 3 0", "gpl v3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "lgpl version 2 1", "lgpl 2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "lgpl version 3", "lgpl 3 0"],
    "AGPL-3.0": ["gnu affero general public license version 3", "agpl version 3", "agpl 3 0"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license"],
    "CC0-1.0": ["cc0 1 0", "cc0"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license", "creative commons attribution 4 0 license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"],
    "CC-BY-NC-ND-4.0": ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"],
    "CC-BY-3.0": ["cc by 3 0", "creative commons attribution 3 0 unported license"],
    "CC-BY-SA-3.0": ["cc by sa 3 0", "creative commons attribution sharealike 3 0 unported license"],
    "CC-BY-NC-3.0": ["cc by nc 3 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "Zlib": ["zlib license"],
    "Artistic-2.0": ["artistic license 2 0"],
    "OFL-1.1": ["sil open font license version 1 1", "sil open font license 1 1"],
    "EUPL-1.2": ["european union public licence version 1 2", "eupl 1 2"],
    "PostgreSQL": ["postgresql license"],
}
#: Sentences of the licence texts and notices.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-compliance": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-waive": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "reserved": "All rights reserved.",
}
#: The lines that licence texts begin with.
TITLES = {
    "Apache-2.0": ["Apache License", "Version 2.0, January 2004"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999"],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "MIT": ["MIT License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
}
SPLIT, STOP = r"([.!?])[ \t\r\f]+", r"\n"
WRAPPED, COLON = r"(?<=[.!?])[ \t\r\f]+|(?<=[.!?])\n|\n[ \t\r\f]*\n", r"(?<=:)[ \t\r\f]*\n"
OTHER = "[^a-z0-9]+"
VERB = "^(this (work|software|file|project|program|document|text|content|material|code) is )?(licensed|released|distributed|available|published|provided) under (the )?(terms of the )?"


def normalised(sentence: str) -> str:
    """What the column expressions make of a sentence."""
    return re.sub(VERB, "licensed under ", re.sub(OTHER, " ", sentence.lower()).strip())


TAG = "SPDX-License-Identifier: "
KNOWN = list(
    dict.fromkeys(
        [normalised(f"licensed under {n}") for names in NAMES.values() for n in names]
        + [normalised(p) for s in SENTENCES.values() for p in re.sub(SPLIT, r"\1\n", s).split("\n")]
        + [normalised(TAG + n) for name in NAMES for n in (name, f"{name}-only", f"{name}-or-later")]
        + [normalised(line) for lines in TITLES.values() for line in lines]
    )
)


def _numbers(sentence: str) -> list[int]:
    return [KNOWN.index(normalised(p)) + 1 for p in re.sub(SPLIT, r"\1\n", sentence).split("\n")]


def rules() -> list[tuple[str, list[int]]]:
    """(licence, sentence numbers) in order: longer sequences before those that they hold."""
    number = {k: _numbers(s) for k, s in SENTENCES.items()}
    short = {k: [[KNOWN.index(normalised(f"licensed under {n}")) + 1] for n in names] for k, names in NAMES.items()}
    out = [
        ("MIT", number["mit-grant"] + number["mit-notice"]),
        ("MIT", number["mit-grant"]),
        ("BSD-3-Clause", number["bsd-grant"] + number["bsd-source"] + number["bsd-binary"] + number["bsd-names"]),
        ("BSD-2-Clause", number["bsd-grant"] + number["bsd-source"] + number["bsd-binary"]),
        ("ISC", number["isc-grant"]),
        ("GPL-3.0-or-later", number["gpl-free"]),
        ("GPL-2.0-or-later", number["gpl2-free"]),
        ("AGPL-3.0-or-later", number["agpl-free"]),
        ("LGPL-2.1-or-later", number["lgpl-free"]),
        ("Zlib", number["zlib-grant"]),
        ("BSL-1.0", number["bsl-grant"]),
        ("MPL-2.0", number["mpl-subject"]),
        ("Unlicense", number["unlicense"]),
        ("CC0-1.0", number["cc0-waive"]),
    ]
    out += [("Apache-2.0", first + number["apache-compliance"]) for first in short["Apache-2.0"]]
    out += [(name, [KNOWN.index(normalised(TAG + n)) + 1]) for name in NAMES for n in (name, f"{name}-only", f"{name}-or-later")]
    out += [(name, [KNOWN.index(normalised(line)) + 1 for line in lines]) for name, lines in sorted(TITLES.items(), key=lambda t: -len(t[1]))]
    return out + [(k, seq) for k, seqs in short.items() for seq in seqs] + [("Apache-2.0", number["apache-compliance"] + number["apache-copy"])]


#: What is left of a text's numbers where rights are reserved after all licences that it names: before one, it is a copyright line.
RESERVED = f" {_numbers(SENTENCES['reserved'])[0]} [^|]*$"


def sentence_numbers(text: Column) -> Column:
    """Numbers of the known sentences of a text, in order."""
    known = F.lit(KNOWN)

    def number(s: Column) -> Column:
        return F.array_position(known, F.regexp_replace(F.trim(F.regexp_replace(s, OTHER, " ")), VERB, "licensed under "))

    def numbers(s: Column, *stops: str) -> Column:
        if not stops:
            return F.array(number(s))
        return F.when(number(s) > 0, F.array(number(s))).otherwise(F.flatten(F.transform(F.split(s, stops[0]), lambda part: numbers(part, *stops[1:]))))

    found = F.flatten(F.transform(F.split(F.lower(text), WRAPPED), lambda s: numbers(s, COLON, STOP)))
    return F.filter(found, lambda n: n > 0)


def licensed(acc: Column) -> Column:
    """The names that the rules gave, and "proprietary" where rights are reserved after them or alone."""
    names = F.array_distinct(acc["names"])
    return F.when(acc["rest"].rlike(RESERVED), F.array_append(names, "proprietary")).otherwise(names)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_known, sentence_ids and licences (both comma-joined, in order) of every row."""
    found = docs.select("doc_id", F.coalesce(sentence_numbers(F.col("text")), F.array().cast("array<bigint>")).alias("ids"))
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(" ".join(["", *map(str, seq), ""])).alias("seq")) for name, seq in rules()])
    rest = F.concat(F.lit(" "), F.array_join(F.transform("ids", lambda n: n.cast("string")), " "), F.lit(" "))
    start = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("names"))

    def step(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["rest"], rule["seq"])
        then = F.struct(F.replace(acc["rest"], rule["seq"], F.lit(" | ")).alias("rest"), F.array_append(acc["names"], rule["name"]).alias("names"))
        return F.when(hit, then).otherwise(acc)

    ordered = F.when(F.size("ids") > 0, F.aggregate(table, start, step, lambda acc: F.array_join(licensed(acc), ","))).otherwise(F.lit(""))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_known"), F.array_join(F.transform("ids", lambda n: n.cast("string")), ",").alias("sentence_ids"), ordered.alias("licences"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document names."""
    return scan(documents(spark, sf_dir))


def oracle() -> str:
    """The same in DuckDB SQL: sentences are cut by marks put where they end, and there is one common table expression for each rule."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = "[" + ", ".join(map(quote, KNOWN)) + "]"
    number = lambda s: f"coalesce(list_position({known}, regexp_replace(trim(regexp_replace({s}, {quote(OTHER)}, ' ', 'g')), {quote(VERB)}, 'licensed under ')), 0)"
    lines = f"list_transform(string_split(p, chr(10)), lambda q: {number('q')})"
    parts = f"flatten(list_transform(string_split(regexp_replace(s, ':[ \t\r\f]*\n', ':' || chr(2), 'g'), chr(2)), lambda p: CASE WHEN {number('p')} > 0 THEN [{number('p')}] ELSE {lines} END))"
    cut = "string_split(regexp_replace(lower(coalesce(text, '')), '([.!?])([ \t\r\f]+|\n)|\n[ \t\r\f]*\n', '\1' || chr(1), 'g'), chr(1))"
    sql = [f"WITH found AS (SELECT doc_id, list_filter(flatten(list_transform({cut}, lambda s: CASE WHEN {number('s')} > 0 THEN [{number('s')}] ELSE {parts} END)), lambda n: n > 0) AS ids FROM documents)"]
    sql.append("r0 AS (SELECT doc_id, ids, ' ' || array_to_string(ids, ' ') || ' ' AS rest, [] :: VARCHAR[] AS names FROM found)")
    for k, (name, seq) in enumerate(rules()):
        text = quote(" ".join(["", *map(str, seq), ""]))
        sql.append(f"r{k + 1} AS (SELECT doc_id, ids, replace(rest, {text}, ' | ') AS rest, CASE WHEN contains(rest, {text}) AND NOT list_contains(names, {quote(name)}) THEN list_append(names, {quote(name)}) ELSE names END AS names FROM r{k})")
    return ",\n".join(sql) + f"\nSELECT doc_id, CAST(len(ids) AS BIGINT) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(CASE WHEN regexp_matches(rest, '{RESERVED}') THEN list_append(names, 'proprietary') ELSE names END, ','), '') AS licences FROM r{len(rules())}"
