"""Operator 8: license scans by diagonal voting.

Every rolling word 3-gram of every text is hashed and joined to the
3-grams of the license templates (a fixed list, broadcast).  A match at word
p of a text and word t of a template votes for the offset diagonal p - t;
votes are aggregated per text, template and diagonal, neighbouring diagonals
that follow each other in the text (words put in or left out) are merged,
and the merged spans are verified by the share of the template's 3-grams
that they cover:

* a ``phrase`` template must stand there word by word (all its grams, on one
  diagonal), which is exact since grams are compared by their words as well;
* so must a ``statement`` (short lines that name a license or reserve all
  rights); of statements that begin at the same word the longest counts;
* a ``notice`` or a ``sentence`` of a license's body needs ``COVER`` of its
  grams, and all that name the license (``NAMES``).

Sentences are templates of their own, so a body is found without its opening.
Only phrases count as base labels.

A text is read once for its grams and once for its number of words; only
matches are shuffled, and votes are summed before they move.

Defined results: null and empty texts have no words; texts under three words
match nothing; repeated rows get equal results; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, read, text_key

GRAM = 3
COVER = 0.6
DRIFT = 3  # diagonals and words apart that still belong together
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that name a license (label, words).
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Opening words of well-known license notices (label, words).
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
]

#: Further sentences of notices and license bodies (label, words).
SENTENCES = [
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("bsd", "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ("isc", "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work"),
    ("gnu", "is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gnu", "of the license or at your option any later version"),
    ("gnu", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
]
#: Grams that tell licenses of the same wording apart.
NAMES = ["gnu general public", "gnu lesser general", "gnu affero general", "mozilla public license", "the mpl was", "person or organization"]


def statements() -> list:
    """Short lines that state a license (label, words)."""
    out = [
        ("all-rights-reserved", "all rights reserved"), ("proprietary", "proprietary and confidential"),
        ("public-domain", "in the public domain"), ("public-domain", "into the public domain"),
        ("mit", "the mit license"), ("mit", "the mit licence"), ("mit", "licensed under mit"), ("mit", "spdx license identifier mit"),
        ("mit-0", "spdx license identifier mit 0"),
        ("apache-1", "apache license version 1"), ("apache-2", "apache license 2 0"), ("apache-2", "apache license v2"), ("apache-2", "apache license v 2"), ("apache-2", "apache 2 0"),
        ("bsd", "the bsd license"), ("bsd", "under bsd license"), ("bsd", "new bsd license"), ("bsd", "modified bsd license"), ("bsd", "simplified bsd license"),
        ("isc", "the isc license"), ("isc", "spdx license identifier isc"), ("unlicense", "under the unlicense"), ("unlicense", "spdx license identifier unlicense"),
        ("mpl", "mozilla public license"), ("boost", "boost software license"), ("epl", "eclipse public license"), ("eupl", "european union public licence"),
        ("odbl", "open database license"), ("zlib", "the zlib license"), ("zlib", "spdx license identifier zlib"), ("artistic", "the artistic license"),
        ("boost", "spdx license identifier bsl 1 0"), ("epl", "spdx license identifier epl"), ("eupl", "spdx license identifier eupl"),
        ("cc0", "cc0 1 0"), ("cc0", "under cc0 license"), ("cc0", "licensed under cc0"), ("cc0", "creative commons zero"), ("cc0", "creative commons cc0"), ("cc0", "creativecommons org publicdomain zero"), ("cc0", "spdx license identifier cc0"),
    ]
    for v in "1", "2":
        out += [(f"mpl-{v}", f"mozilla public license {x}") for x in (f"version {v}", f"v {v}", f"v{v}", v)]
        out += [(f"mpl-{v}", f"mpl version {v}"), (f"mpl-{v}", f"mpl {v} 0"), (f"mpl-{v}", f"mpl {v} 1")]
    for n in "2", "3":
        out += [(f"bsd-{n}", x) for x in (f"bsd {n} clause", f"{n} clause bsd")]
    for family, name, versions in (
        ("gpl", "general", ["1", "2", "3"]), ("lgpl", "lesser general", ["2", "2 1", "3"]), ("lgpl", "library general", ["2"]), ("agpl", "affero general", ["1", "3"]),
    ):
        out += [(family, f"gnu {name} public license"), (family, f"gnu {name} public licence"), (family, f"the gnu {family}"), (family, f"under the {family}")]
        for v in versions:
            label, tight = f"{family}-{v.replace(' ', '.')}", f"{family}v{v}"
            forms = [f"gnu {name} public {x} {y}" for x in ("license", "licence") for y in (f"version {v}", f"v{v}", f"v {v}", v)]
            forms += [f"{x}{family} {y}" for x in ("gnu ", "the gnu ", "under the ") for y in (f"version {v}", f"v{v}", f"v {v}", v)]
            forms += [f"{family} version {v}", f"{family} {v} 0", f"{family} {v} only", f"{family} {v} or later", f"spdx license identifier {family} {v}"]
            forms += [f"{x} {tight}" for x in ("licensed under", "released under", "distributed under", "under the", "the gnu", "under gnu")]
            out += [(label, x) for x in forms if len(x.split()) >= GRAM]
    long = {"nc": ["noncommercial", "non commercial"], "sa": ["sharealike", "share alike"], "nd": ["noderivs", "noderivatives", "no derivs", "no derivatives"]}
    for parts in ((), ("sa",), ("nd",), ("nc",), ("nc", "sa"), ("nc", "nd")):
        label, short = "-".join(["cc", "by", *parts]), " ".join(["by", *parts])
        # with the words before it, so that the longest at that word is the whole license
        forms = [f"{x} cc {short}" for x in ("under", "under a", "under the", "license", "licence")]
        forms += [f"cc {short} {v}" for v in ("1 0", "2 0", "2 5", "3 0", "4 0")] + [f"cc {short}"] * bool(parts)
        forms += [f"creativecommons org licenses {short}", f"spdx license identifier cc {short}"]
        names = ["creative commons attribution"]
        for part in parts:
            names = [f"{x} {y}" for x in names for y in long[part]]
        out += [(label, x) for x in forms + names]
    return sorted(set(out))


def words_of(text):
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def template_grams(spark: SparkSession) -> DataFrame:
    """``(template, label, exact, base, grams, named, tpos, name, words, h)``: some thousand fixed rows."""
    rows = []
    kinds = [(PHRASES, True, True), (statements(), True, False), (NOTICES + SENTENCES, False, False)]
    for k, (label, text, exact, base) in enumerate((*x, exact, base) for some, exact, base in kinds for x in some):
        w = text.split()
        n = len(w) - GRAM + 1
        g = [" ".join(w[i : i + GRAM]) for i in range(n)]
        rows += [(k, label, exact, base, n, sum(x in NAMES for x in g), i, x in NAMES, x) for i, x in enumerate(g)]
    t = spark.createDataFrame(rows, "template int, label string, exact boolean, base boolean, grams int, named int, tpos int, name boolean, words string")
    return t.withColumn("h", F.xxhash64("words"))


def votes(docs: DataFrame) -> DataFrame:
    """Distinct matches of template grams: ``(doc_id, tk, template, ..., tpos, pos)``."""
    spark = docs.sparkSession
    d = docs.select("doc_id", text_key(F.col("text")).alias("tk"), words_of(F.col("text")).alias("w"))
    # a gram takes its words along, not its text's list of them: rows stay short in long texts
    # (no filter on the number of words: Spark would split every text once more for it)
    rolling = F.transform(
        F.when(F.size("w") >= GRAM, F.sequence(F.lit(0), F.size("w") - GRAM)),
        lambda i: F.concat(F.get("w", i), F.lit(" "), F.get("w", i + 1), F.lit(" "), F.get("w", i + 2)),
    )
    grams = d.select("doc_id", "tk", F.posexplode(rolling).alias("pos", "gram")).withColumn("h", F.xxhash64("gram"))
    hit = grams.join(F.broadcast(template_grams(spark)), "h").filter(F.col("gram") == F.col("words"))
    return hit.select("doc_id", "tk", "template", "label", "exact", "base", "grams", "named", "tpos", "name", "pos")


def spans(docs: DataFrame) -> DataFrame:
    """Verified places: ``(doc_id, tk, template, label, exact, base, first_word, end_word, cover)``."""
    v = votes(docs).withColumn("diagonal", F.col("pos") - F.col("tpos"))
    key = ["doc_id", "tk", "template", "label", "exact", "base", "grams", "named"]
    # copies of a row cast the same votes: count template positions once
    diagonals = v.groupBy(*key, "diagonal").agg(
        F.collect_set("tpos").alias("seen"), F.collect_set(F.when(F.col("name"), F.col("tpos"))).alias("names"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    order = Window.partitionBy(*key).orderBy("diagonal")
    # phrases stay on their diagonal; notices merge neighbours that follow in the text
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT) | (F.col("lo") - F.lag("hi").over(order) > GRAM + DRIFT)
    merged = diagonals.withColumn("new", F.when(F.col("exact") | F.coalesce(apart, F.lit(True)), 1).otherwise(0)).withColumn(
        "run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    places = merged.groupBy(*key, "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("names")))).alias("n_names"), F.min("lo").alias("first_word"), (F.max("hi") + GRAM).alias("end_word")
    )
    cover = F.col("n") / F.col("grams")
    whole = F.when(F.col("exact"), F.col("n") == F.col("grams")).otherwise((F.col("cover") >= COVER) & (F.col("n_names") == F.col("named")))
    found = places.withColumn("cover", cover).filter(whole)
    # of statements that begin at the same word the longest counts
    same = Window.partitionBy("doc_id", "tk", "exact", "base", "first_word")
    longest = F.max(F.when(F.col("exact") & ~F.col("base"), F.col("grams"))).over(same)
    return found.withColumn("longest", longest).filter("longest is null or grams = longest").select(
        "doc_id", "tk", "template", "label", "exact", "base", "first_word", "end_word", "cover"
    )


def scan(docs: DataFrame) -> DataFrame:
    found = spans(docs).groupBy(F.col("doc_id").alias("fid"), F.col("tk").alias("ftk")).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    d = docs.select(
        "doc_id", text_key(F.col("text")).alias("tk"),
        F.regexp_count(ascii_lower(F.col("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
    )
    return d.join(found, F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("tk") == F.col("ftk")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
