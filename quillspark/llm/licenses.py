"""License scans by sentence rules, with DataFrame functions alone.

A-Z are lowered; white space, ASCII marks and typographic ones fold to single
spaces.  A sentence ends after . ! ? ; before white space, at a blank line (or one of marks
alone) and before a list number; line ends and colons may end a known sentence
but need not, so wrapped and commented notices are found.  Each licence of an SPDX
expression is a sentence of its own.  n_sentences counts sentences with any other
character.

The catalogue is two tables, of the package or of the caller.  SENTENCES gives known sentences an id: places where
one may begin meet the sentences that begin with the same words in a hash join,
and of those that stand there, up to a place where one may end, the longest
counts.  "*" in a sentence stands for one to SLOT words, as a holder's name; at its
end, for whatever follows, and then only the words before it count as its length.
RULES give licences ordered lists of sentence ids: a text's ids, in order, meet the
rules that begin with one of them, and a rule matches if its ids stand in that
order, others between them or not, and none of the ids that speak against it stands
in the text.  A matched rule whose ids are all in a longer matched rule adds nothing.

Only rows with a word of the catalogue's stems are looked up.  Nulls and empty
texts have no sentences, an empty table gives no row, each row stands for itself
whatever its doc_id, and other columns are not read.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence wordings, by sentence id, normalised.
SENTENCES = {
    "mit-line": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-this": "this project is licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "apache2-line": "licensed under the apache license version 2 0",
    "apache2-the-license": "licensed under the apache license version 2 0 the license",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-you-can": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl2-or-later": "either version 2 of the license or at your option any later version",
    "gpl3-or-later": "either version 3 of the license or at your option any later version",
    "gpl2-comma": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-comma": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "lgpl-you-can": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl21-or-later": "either version 2 1 of the license or at your option any later version",
    "lgpl3-comma": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "agpl3-comma": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl2-obtain-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "cc0-waive": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "cc-by-nc-4-line": "licensed under cc by nc 4 0",
    "cc-by-sa-4-line": "licensed under cc by sa 4 0",
    "cc-by-4-line": "licensed under cc by 4 0",
    "cc-by-4-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd3-endorse": "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd3-author": "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-neither": "neither the name *",
    "bsd-name": "the name of *",
    "apache2-title": "apache license version 2 0 january 2004",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl2-title": "mozilla public license version 2 0",
    "bsl1-title": "boost software license version 1 0 17th august 2003",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "zlib-origin-part": "the origin of this software must not be misrepresented",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
}
#: (licence, ordered sentence ids), and where need be ids that speak against it.
RULES = [
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-this",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("Apache-2.0", ("apache2-line",)),
    ("Apache-2.0", ("apache2-the-license", "apache2-comply", "apache2-copy", "apache2-as-is")),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0-or-later", ("gpl-you-can", "gpl3-or-later", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl3-comma", "gpl-hope")),
    ("GPL-3.0-only", ("gpl3-only", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl-you-can", "gpl2-or-later", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-comma", "gpl-hope")),
    ("GPL-2.0-only", ("gpl2-only", "gpl-hope")),
    ("LGPL-2.1-or-later", ("lgpl-you-can", "lgpl21-or-later", "lgpl-hope")),
    ("LGPL-3.0-or-later", ("lgpl3-comma",)),
    ("AGPL-3.0-or-later", ("agpl3-comma", "gpl-hope")),
    ("MPL-2.0", ("mpl2-subject", "mpl2-obtain")),
    ("MPL-2.0", ("mpl2-subject", "mpl2-obtain-https")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("CC0-1.0", ("cc0-waive",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-line",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC-BY-4.0", ("cc-by-4-line",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary"), ("bsd-neither", "bsd-name", "bsd3-endorse", "bsd3-author")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd3-endorse")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd3-author")),
    ("Apache-2.0", ("apache2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("BSL-1.0", ("bsl1-title",)),
    ("Zlib", ("zlib-as-is", "zlib-grant", "zlib-origin")),
    ("Zlib", ("zlib-as-is", "zlib-grant", "zlib-origin-part")),
]
#: What licences are called in a line such as "released under the terms of the ...", and how such a line begins.
CALLED = {
    "MIT": ["mit license", "mit licence"],
    "ISC": ["isc license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache license v2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2 0", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3 0", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3"],
    "AGPL-3.0": ["gnu affero general public license version 3"],
    "MPL-2.0": ["mozilla public license 2 0", "mozilla public license version 2 0", "mozilla public license v2 0"],
    "BSL-1.0": ["boost software license 1 0", "boost software license version 1 0"],
    "Zlib": ["zlib license"],
}
BEGUN = [f"{who}{how} under {what}" for who in ("", "this project is ", "this software is ", "this program is ", "this library is ", "this package is ", "this file is ", "this code is ", "this work is ", "it is ") for how in ("released", "licensed", "distributed", "available") for what in ("the ", "the terms of the ")]
#: Licences that are also known by their SPDX tag; tags of older lists of SPDX, and what they mean.
OLD_TAGS = {"GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only", "AGPL-3.0": "AGPL-3.0-only"}
TAGGED = "LGPL-2.1-only LGPL-3.0-only AGPL-3.0-only Zlib BSL-1.0 0BSD MIT-0 EPL-2.0 Artistic-2.0 MIT ISC Apache-2.0 GPL-3.0-only GPL-3.0-or-later GPL-2.0-only GPL-2.0-or-later LGPL-2.1-or-later LGPL-3.0-or-later AGPL-3.0-or-later MPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 BSD-2-Clause BSD-3-Clause"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ|", "abcdefghijklmnopqrstuvwxyz "
#: Characters that fold to spaces, but for the bar: ASCII without letters and digits, some of Latin-1, dashes and quotes.
MARKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), 0x7B, 0x7D, 0x7E, 0x7F, 0xA0, 0xA7, 0xA9, 0xAB, 0xAE, 0xB6, 0xB7, 0xBB, *range(0x2010, 0x2028), *range(0x2030, 0x2040)]))
#: In lower case, line ends as "\n": where a sentence ends; where it may end.
MARK = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B\x7D-\x7F]"
END = rf"[.!?;][ \t]*\n|[.!?;][ \t]+|\n{MARK}*(?=\n)"
LIST_NUMBER = rf"\n{MARK}*[0-9a-z]{{1,2}}[.)][ \t]"
MAY_END = r":[ \t]+|\n"
#: Words that a place and a sentence are joined on.
KEY = 3
#: Words that "*" may stand for, and the characters that this may take.
SLOT, SLOT_SIZE = 12, 240
TAG = "spdx-license-identifier:"
#: A point in a holder's name that ends no sentence.
BEFORE_HOLDER, HOLDER = "neither the name", r"(neither the name[^.;]{0,200}\b(?:inc|ltd|co|corp|llc))\.([ \t\n])"


def catalogue(sentences: dict[str, str] | None = None, rules: list | None = None) -> tuple[dict[str, str], list]:
    """Sentences and rules, those of SPDX tags and of lines that name a licence among them unless others are given."""
    if sentences is not None:
        return sentences, rules or []
    fold = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    tags = {f"spdx-{x.lower()}": (x, "spdx license identifier " + fold(x)) for x in TAGGED.split()}
    tags |= {f"spdx-{x.lower()}-old": (name, "spdx license identifier " + fold(x)) for x, name in OLD_TAGS.items()}
    known = set(SENTENCES.values())
    lines = [(name, begun + called) for name, names in CALLED.items() for called in names for begun in BEGUN]
    tags |= {f"line-{name.lower()}-{k}": (name, words) for k, (name, words) in enumerate(lines) if words not in known}
    return SENTENCES | {k: s for k, (_, s) in tags.items()}, RULES + [(x, (k,)) for k, (x, _) in tags.items()]


def slotted(words: str, between: str, end: str) -> str | None:
    """The pattern of a sentence with "*"; None without."""
    if "*" not in words:
        return None
    if words.endswith(" *"):
        return "^" + words[:-2].replace(" ", between) + f"(?={between})"
    name = "(?:[^ |]+" + between + f"){{1,{SLOT}}}?"
    return "^" + (between.join(words.split(" ")) + end).replace("*" + between, name)


def sentence_table(spark: SparkSession, sentences: dict[str, str]) -> DataFrame:
    """id, words and pattern (of those with a "*") of the known sentences."""
    return spark.createDataFrame([(k, w, slotted(w, "[ |]", "(?=[|])")) for k, w in sentences.items()], "id string, words string, pattern string")


def rule_table(spark: SparkSession, rules: list) -> DataFrame:
    """license, ordered ids, and ids against it of the rules."""
    return spark.createDataFrame([(r[0], list(r[1]), list(r[2]) if len(r) > 2 else []) for r in rules], "license string, ids array<string>, against array<string>")


def bounded(table: DataFrame) -> DataFrame:
    """A catalogue's table with a hint to broadcast it, if it has at most CATALOGUE rows; a larger one is joined as Spark sees fit."""
    return F.broadcast(table) if table.limit(CATALOGUE + 1).count() <= CATALOGUE else table


#: Rows of a catalogue that are broadcast, some hundred bytes each.
CATALOGUE = 50_000


def stems(sentences: list[str]) -> list[str]:
    """Words of which each known sentence has one: few words, and long ones, as these stand in few texts."""
    left, out = [[w for w in s.split(" ") if w != "*"] for s in sentences], []
    while left:
        counts: dict[str, int] = {}
        for s in left:
            for w in {w for w in s if len(w) > 5} or {w for w in s if len(w) > 3} or set(s):
                counts[w] = counts.get(w, 0) + 1
        best = max(counts, key=lambda w: (counts[w], len(w), w))
        out.append(best)
        left = [s for s in left if not any(best in w for w in s)]
    return out


def prepared(text: Column) -> Column:
    """The text in lower case with line ends of one kind; "||" at list numbers and between the licences of an SPDX expression."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    low = F.when(low.contains("\r"), F.regexp_replace(low, r"\r\n?", "\n")).otherwise(low)
    low = F.when(low.contains(BEFORE_HOLDER), F.regexp_replace(low, HOLDER, "$1$2")).otherwise(low)

    def expression(x: Column) -> Column:
        line = F.substring_index(x, "\n", 1)
        each = F.regexp_replace(F.regexp_replace(line, r"[ \t()]+(?:or|and)[ \t()]+", "||spdx license identifier "), r"[ \t()]+with[ \t]+", "||with ")
        return F.concat(F.regexp_replace(each, r"([0-9])\+", "$1 or later"), F.substring(x, F.length(line) + 1, F.length(x)))

    tagged = F.array_join(F.transform(F.split(low, TAG), lambda x, k: F.when(k == 0, x).otherwise(expression(x))), TAG)
    return F.regexp_replace(F.when(low.contains(TAG), tagged).otherwise(low), LIST_NUMBER, "||")


def lined(ready: Column) -> Column:
    """A prepared text folded: "|" where a sentence may end, "||" where it ends; one of them at both ends."""
    cut = F.regexp_replace(F.regexp_replace(ready, END, "||"), MAY_END, "|")
    # a regex for marks would match at each word: one table and a regex for the few wider gaps take a twentieth of its time
    plain = F.regexp_replace(F.translate(F.concat(F.lit("|"), cut, F.lit("|")), MARKS, " " * len(MARKS)), " {2,}", " ")
    bars = F.regexp_replace(plain, r" *\| *", "|")
    return F.regexp_replace(bars, r"\|{2,}", "||")


_FOLDED = "".join(f"\\x{{{ord(c):X}}}" for c in MARKS)
#: From a sentence's first character that stays to its end; two places where one may end, with marks between, are an end.
SENTENCE = rf"(?s)[^|\n{_FOLDED}].*?(?:\|\||{END}|(?:{MAY_END})[{_FOLDED}]*(?:{MAY_END})|\z)"


def count_sentences(ready: Column) -> Column:
    """Sentences of a prepared text, which need not be folded for it."""
    return F.regexp_count(ready, F.lit(SENTENCE)).cast("long")


def holds(text: Column, words: list[str]) -> Column:
    """Whether one of the words stands in a text, alone or in a longer word."""
    return reduce(operator.or_, (text.contains(w) for w in words), F.lit(False))


def places(folded: Column, words: list[str], first: list[str], longest: int) -> Column:
    """Of each sentence with one of the words: where a known one may begin (with one of the first words), and what follows there, "|" at its end."""
    kept = F.filter(F.transform(F.split(folded, r"\|\|"), lambda s, k: F.struct(k.alias("sentence"), F.filter(F.split(s, r"\|"), lambda x: x != "").alias("pieces"), s.alias("s"))), lambda x: holds(x["s"], words))
    # a piece has a letter or digit, and a bar follows it
    ahead = lambda x, i: F.concat(F.substring(F.array_join(F.slice(x["pieces"], i, F.lit(longest // 2 + 2)), "|"), 1, longest + 1), F.lit("|"))
    begins = lambda x, i: F.substring_index(F.get(x["pieces"], i - 1), " ", 1).isin(first)
    starts = F.transform(kept, lambda x: F.transform(F.filter(F.sequence(F.lit(1), F.size(x["pieces"])), lambda i: begins(x, i)), lambda i: F.struct(x["sentence"], i.alias("at"), ahead(x, i).alias("ahead"))))
    return F.flatten(starts)


def ordered_in(ids: Column, rule: Column) -> Column:
    """Whether the rule's ids stand in ids in their order."""
    met = F.aggregate(ids, F.lit(0), lambda n, x: n + F.when((n < F.size(rule)) & (x == F.get(rule, n)), 1).otherwise(0))
    return met == F.size(rule)


def scan_licenses(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """doc_id, n_sentences, sentence_ids (in text order) and licenses (sorted) of each row, as comma-joined strings.

    sentences: id to normalised words, "*" for a name or an open end; rules:
    (licence, ordered ids) or (licence, ordered ids, ids against it).
    """
    spark = docs.sparkSession
    sentences, rules = catalogue(sentences, rules)
    longest = max((len(x) + SLOT_SIZE * x.count("*") for x in sentences.values()), default=0)
    hints, first = stems(list(sentences.values())), sorted({x.split(" ")[0] for x in sentences.values()})
    first_words = lambda c: F.substring_index(F.trim(F.translate(c, "|", " ")), " ", KEY)
    known = sentence_table(spark, sentences).withColumn("key", first_words(F.col("words")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", prepared(F.col("text")).alias("ready"))
    # only texts with a word of the catalogue are folded
    folded = F.when(holds(F.col("ready"), hints), lined(F.col("ready")))
    rows = rows.select("row", "doc_id", count_sentences(F.col("ready")).alias("n_sentences"), folded.alias("folded"))
    rows = rows.select("row", "doc_id", "n_sentences", F.when(F.col("folded").isNotNull(), places(F.col("folded"), hints, first, longest)).alias("places"))
    spread = rows.select("row", "doc_id", "n_sentences", F.explode_outer("places").alias("place")).withColumn("key", first_words(F.col("place.ahead")))
    met = spread.join(bounded(known), "key", "left")
    same = (F.substring(F.translate("place.ahead", "|", " "), F.lit(1), F.length("words")) == F.col("words")) & (F.substring(F.col("place.ahead"), F.length("words") + 1, F.lit(1)) == "|")
    size = F.when(F.col("pattern").isNull(), F.when(same, F.length("words"))).otherwise(F.length(F.regexp_substr("place.ahead", F.col("pattern"))))
    hit = F.when(size.isNotNull(), F.struct("place.sentence", "place.at", size.alias("size"), "id"))
    found = met.select("row", "doc_id", "n_sentences", hit.alias("hit")).groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_sentences").alias("n_sentences"), F.array_sort(F.collect_list("hit")).alias("hits"))
    # of those at one place the last is the longest
    last = F.filter("hits", lambda x, k: (k == F.size("hits") - 1) | (F.get("hits", k + 1)["sentence"] != x["sentence"]) | (F.get("hits", k + 1)["at"] != x["at"]))
    found = found.select("row", "doc_id", "n_sentences", F.transform(last, lambda x: x["id"]).alias("ids"))
    table = bounded(rule_table(spark, rules).select("license", "against", F.col("ids").alias("rule"), F.get("ids", F.lit(0)).alias("first")))
    tried = found.select("row", "doc_id", "n_sentences", "ids", F.explode_outer(F.array_distinct("ids")).alias("first")).join(table, "first", "left")
    matched = F.when(ordered_in(F.col("ids"), F.col("rule")) & ~F.arrays_overlap("ids", "against"), F.struct("license", "rule"))
    by_row = tried.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_sentences").alias("n_sentences"), F.first("ids").alias("ids"), F.collect_list(matched).alias("rules"))
    own = F.filter("rules", lambda r: ~F.exists("rules", lambda q: (F.size(q["rule"]) > F.size(r["rule"])) & (F.size(F.array_except(r["rule"], q["rule"])) == 0)))
    names = F.array_sort(F.array_distinct(F.transform(own, lambda r: r["license"])))
    return by_row.select("doc_id", "n_sentences", F.array_join("ids", ",").alias("sentence_ids"), F.array_join(names, ",").alias("licenses"))


def oracle() -> str:
    """The same by looking up all runs of lines, and rules by the least places of their ids."""
    sentences, rules = catalogue()
    known = ", ".join(f"('{v}', '{k}')" for k, v in sentences.items() if "*" not in v)
    slots = ", ".join(f"('{slotted(v, ' ', '$')}', '{k}', '{v[:-2] if v.endswith(' *') else ''}')".replace("(?= )", " ") for k, v in sentences.items() if "*" in v)
    wanted = ", ".join(f"({n}, '{r[0]}', {k}, '{x}', {len(r[1])})" for n, r in enumerate(rules) for k, x in enumerate(r[1], 1))
    against = ", ".join(f"({n}, '{x}')" for n, r in enumerate(rules) for x in (r[2] if len(r) > 2 else ()))
    marks = " || ".join(f"chr({ord(c)})" for c in MARKS)
    most = max(len(s) + SLOT_SIZE * s.count("*") for s in sentences.values())
    return rf"""
WITH RECURSIVE known(words, id) AS (VALUES {known}),
slot(pattern, id, begun) AS (VALUES {slots}),
rule(n, license, k, id, size) AS (VALUES {wanted}),
against(n, id) AS (VALUES {against}),
d0 AS (SELECT row_number() OVER () AS rid, doc_id, string_split(regexp_replace(translate(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '{UPPER}', '{LOWER}'), '{HOLDER}', '\1\2', 'g'), '{TAG}') AS b FROM documents),
d AS (SELECT rid, doc_id, array_to_string(list_transform(b, lambda x, i: CASE WHEN i = 1 THEN x ELSE
        regexp_replace(regexp_replace(regexp_replace(split_part(x, chr(10), 1), '[ \t()]+(?:or|and)[ \t()]+', '||spdx license identifier ', 'g'), '[ \t()]+with[ \t]+', '||with ', 'g'), '([0-9])\+', '\1 or later', 'g')
        || substring(x, length(split_part(x, chr(10), 1)) + 1) END), '{TAG}') AS t FROM d0),
l AS (SELECT rid, doc_id, regexp_replace(translate('|' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
        '\n{MARK}*[0-9a-z]{{1,2}}[.)][ \t]', '||', 'g'), '[.!?;]([ \t]*\n|[ \t]+)', '||', 'g'), '\n({MARK}*\n)+', '||', 'g'), ':[ \t]+|\n', '|', 'g') || '|', {marks}, repeat(' ', {len(MARKS)})), ' +', ' ', 'g') AS low FROM d),
s AS (SELECT rid, unnest(parts) AS s, generate_subscripts(parts, 1) AS sn FROM (SELECT rid, string_split_regex(low, '[|] ?(?:[|] ?)+') AS parts FROM l)),
p AS (SELECT rid, sn, list_filter(list_transform(string_split(s, '|'), lambda x: trim(x)), lambda x: x <> '') AS pieces FROM s WHERE regexp_matches(s, '[^ |]')),
c AS (SELECT rid, count(*) AS n FROM p GROUP BY rid),
v AS (SELECT rid, sn, pieces, a FROM p, unnest(generate_series(1, len(pieces))) AS t(a)
      WHERE split_part(pieces[a], ' ', 1) IN (SELECT split_part(words, ' ', 1) FROM known UNION ALL SELECT split_part(substring(pattern, 2), ' ', 1) FROM slot)),
r AS (SELECT rid, sn, a, a AS z, pieces, pieces[a] AS words FROM v
      UNION ALL SELECT rid, sn, a, z + 1, pieces, words || ' ' || pieces[z + 1] FROM r WHERE z < len(pieces) AND length(words) < {most}),
hs AS (SELECT rid, sn, a, id, length(words) AS size FROM r JOIN known USING (words)
      UNION ALL SELECT rid, sn, a, id, CASE WHEN begun = '' THEN length(words) ELSE length(begun) END FROM r JOIN slot ON regexp_matches(words, pattern)
      WHERE words LIKE 'neither the %' OR words LIKE 'the name of %'),
h AS (SELECT rid, sn, a, arg_max(id, (size, id)) AS id FROM hs GROUP BY rid, sn, a),
o AS (SELECT rid, id, row_number() OVER (PARTITION BY rid ORDER BY sn, a) AS pl FROM h),
m AS (SELECT o.rid, n, license, k, size, min(pl) AS pl FROM o JOIN rule ON rule.id = o.id AND k = 1 GROUP BY ALL
      UNION ALL SELECT m.rid, m.n, m.license, rule.k, m.size, nx.pl FROM m JOIN rule ON rule.n = m.n AND rule.k = m.k + 1,
        LATERAL (SELECT min(o.pl) AS pl FROM o WHERE o.rid = m.rid AND o.id = rule.id AND o.pl > m.pl) nx WHERE nx.pl IS NOT NULL),
w AS (SELECT rid, n, license, size FROM m WHERE k = size AND NOT EXISTS (SELECT 1 FROM against g JOIN o ON o.id = g.id WHERE g.n = m.n AND o.rid = m.rid)),
u AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM w q WHERE q.rid = w.rid AND q.size > w.size
        AND NOT EXISTS (SELECT 1 FROM rule x WHERE x.n = w.n AND x.id NOT IN (SELECT id FROM rule y WHERE y.n = q.n)))),
g AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM u GROUP BY rid),
i AS (SELECT rid, string_agg(id, ',' ORDER BY pl) AS ids FROM o GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN c USING (rid) LEFT JOIN i USING (rid) LEFT JOIN g USING (rid)
"""
