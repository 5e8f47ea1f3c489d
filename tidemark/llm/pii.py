"""Operator 10: information-theoretic sanitisation (DataFrame functions only).

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers found in the whole texts, and what several of them share: a domain, a
network (three parts of an address), the first six digits of a number.  A term
is a run of letters (two at least) outside e-mail addresses, anywhere in a
text that holds an entity.  Over the whole corpus, with texts as the unit of
co-occurrence (equal texts count once),

    P(entity | term) = (co + P(entity)) / (df(term) + 1),
    bits left = log2(1 / P(entity | term)),

that is, the entity's information content less the PMI, with one text more in
which the entity stands at its own rate.  A term discloses an entity when at
most ``GENERALISE`` bits are left and its co-occurrence is evidence: by chance
``mean = df(term) * df(entity) / n`` texts would hold both, and the Chernoff
bound of ``co`` texts, exp(co - mean - co * log(co / mean)), is at most
``ALPHA`` over all pairs of a term and an entity that the corpus offers.  So a
corpus whose words are dealt to its texts at random has about ``ALPHA`` such
pairs in all, and one shared text never is evidence, whatever the corpus.

An e-mail address also names its owner: words of three letters or more in it
(the last label apart) are entities of their own, and the term that is the
same word needs no evidence, only the bits.  This decides on addresses of a
single text.

Every place of a disclosing term is generalised to ``[TERM]`` in the texts that
hold the entity, and removed where at most ``REMOVE`` bits are left.  Entities
are replaced by their kind; a place that overlaps one is not a term's.

Places are code points, end exclusive.  A kind's matches are leftmost and do
not overlap; a match that fails its kind's test (parts of an address, Luhn,
number of digits) is dropped without another try.  The regular expressions
are the contract's, with possessive repeats and look-behinds that give the
same matches in linear time and constant stack.

How the work is spread: document frequencies are map-side sums over the
words of each text, and only texts that are repeated are told apart by a
shuffle.  Terms of one text, and terms too common to disclose any entity, fall away
before pairs are made.  Entities that stand in the same texts disclose alike
and are counted as one group; those of one text make no pairs.  Sanitising
joins texts to their places by row key.

Defined results: null text counts as empty; repeated rows get equal
results; rows with a null doc_id take part; an empty table gives no rows;
columns of the input stay when texts are sanitised.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, broadcast_if_small, materialise, read, text_key

GENERALISE = 1.0  # bits left of an entity
REMOVE = 0.25
ALPHA = 0.05
NAME = 3  # letters of a word that names an address's owner
PREFIX = 6  # digits that numbers share
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
HOT = 1000  # a term in one of so many texts is a hot key
LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = [
    rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
NO_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def valid(kind, m):
    digits = F.regexp_replace(m, "[^0-9]", "")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, m.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == 2, F.length(digits).between(13, 19) & F.call_function("luhn_check", digits))
        .otherwise(F.length(digits).between(9, 15))
    )


def matches(docs: DataFrame) -> DataFrame:
    """Valid matches in whole texts: ``(doc_id, tk, kind, start, end, value)``."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_key(F.col("text")).alias("tk"), text.alias("text"))
    d = d.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m{k}") for k, p in enumerate(PATTERNS)])
    per = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"m{k}").alias("m"), F.when(F.size(f"m{k}") > 0, F.split("text", p)).alias("gaps"))
        for k, p in enumerate(PATTERNS)
    ])
    d = d.filter(" or ".join(f"size(m{k}) > 0" for k in range(len(PATTERNS))))
    one = d.select("rid", "doc_id", "tk", F.explode(F.filter(per, lambda x: F.size(x["m"]) > 0)).alias("k"))
    rows = one.select("rid", "doc_id", "tk", "k.kind", F.col("k.gaps").alias("gaps"), F.posexplode("k.m").alias("i", "value"))
    rows = rows.select("rid", "doc_id", "tk", "kind", "i", "value", F.length(F.get("gaps", F.col("i"))).alias("gap"), F.length("value").alias("len"))
    order = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order).cast("long")).filter(valid(F.col("kind"), F.col("value")))
    return rows.select(
        "doc_id", "tk", "kind", (F.col("end") - F.col("len")).alias("start"), "end",
        F.concat_ws(":", F.col("kind").cast("string"), F.translate("value", UPPER, LOWER)).alias("value"),
    ).distinct()


def words(docs: DataFrame) -> DataFrame:
    """Each row's distinct terms outside e-mail addresses: ``(tk, term)``."""
    text = F.coalesce("text", F.lit(""))
    bare = F.when(F.instr(text, "@") > 0, F.regexp_replace(text, F.lit(PATTERNS[0]), F.lit(" "))).otherwise(text)
    split = F.split(F.translate(bare, UPPER, LOWER), NO_LETTERS)
    w = docs.select("tk", F.explode(F.array_distinct(split)).alias("term"))
    return w.filter(F.length("term") > 1)


def entities(found: DataFrame) -> DataFrame:
    """``(tk, value)``: each text's entities and what they share with others."""
    digits = F.regexp_replace("value", "[^0-9]", "")  # the kind is the first one
    shared = (
        F.when(F.col("kind") == 0, F.concat(F.lit("domain:"), F.substring_index("value", "@", -1)))
        .when(F.col("kind") == 1, F.concat(F.lit("network:"), F.substring_index("value", ".", 3)))
        .otherwise(F.concat(F.lit("digits:"), F.substring(digits, 1, 1 + PREFIX)))
    )
    return found.select("tk", F.explode(F.array(F.col("value"), shared)).alias("value")).distinct()


def names(found: DataFrame) -> DataFrame:
    """``(tk, term)``: the words of each text's e-mail addresses."""
    address = F.regexp_replace(F.expr("substring(value, 3)"), r"\.[^.]*$", "")
    w = found.filter("kind = 0").select("tk", F.explode(F.split(address, NO_LETTERS)).alias("term"))
    return w.filter(F.length("term") >= NAME).distinct()


def small(terms: DataFrame) -> DataFrame:
    """``terms`` with a broadcast hint, if their rows and bytes are few."""
    size = terms.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("term")).alias("bytes")).first()
    return broadcast_if_small(terms, size["rows"], BROADCAST_ROWS) if (size["bytes"] or 0) <= BROADCAST_BYTES else terms


def frequencies(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``(term, df_term)`` over distinct texts; ``copies`` has each text's rows."""
    again = materialise(copies.filter("rows > 1").select("tk"), "again")
    again = broadcast_if_small(again, again.count(), BROADCAST_ROWS)
    once = words(docs.join(again, "tk", "left_anti"))
    more = words(docs.join(again, "tk", "left_semi")).distinct()
    return once.unionByName(more).groupBy("term").agg(F.count(F.lit(1)).alias("df_term"))


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(tk, term, left)``: terms that leave at most ``GENERALISE`` bits of an
    entity of the text, with the fewest that they leave."""
    docs = docs.select(text_key(F.col("text")).alias("tk"), "text")
    copies = materialise(docs.groupBy("tk").agg(F.count(F.lit(1)).alias("rows")), "copies")
    n = max(copies.count(), 1)
    share = lambda texts: F.col(texts) / F.lit(float(n))
    # co is at most the entity's own texts: no term in more texts than this can disclose it
    most = lambda texts: 2**GENERALISE * (F.col(texts) + share(texts)) - 1 + 1e-6
    left = lambda texts: -F.log2((F.col("co") + share(texts)) / (F.col("df_term") + 1))
    # entities of the same texts are one group, named by two hashes of the set of texts
    at = materialise(entities(found), "entities")
    sets = at.groupBy("value").agg(
        F.count(F.lit(1)).alias("df_group"), F.bit_xor(F.xxhash64("tk", F.lit(1))).alias("g"), F.bit_xor(F.xxhash64("tk", F.lit(2))).alias("h")
    )
    # an entity of all texts has no information content, one of a single text no evidence
    sets = sets.filter(F.col("df_group").between(2, n - 1))
    groups = materialise(at.join(sets, "value").select("tk", "g", "h", "df_group").distinct().withColumn("most", most("df_group")), "groups")
    named = names(found)
    named = named.join(named.groupBy("term").agg(F.count(F.lit(1)).alias("df_name")), "term").withColumn("most", most("df_name"))
    named = materialise(named, "names")
    bounds = groups.select("most").unionByName(named.select("most")).agg(F.max("most")).first()[0] or 0.0
    holds = groups.select("tk").unionByName(named.select("tk")).distinct()
    holds = broadcast_if_small(holds, holds.count(), BROADCAST_ROWS)
    mine = words(docs.join(holds, "tk", "left_semi")).distinct()
    # terms of many texts are few and go to every task; no other is a hot key
    df = materialise(frequencies(docs, copies), "df")
    often = small(df.filter(F.col("df_term") * HOT >= n))
    rest = df.filter((F.col("df_term") * HOT < n) & (F.col("df_term") <= bounds))
    mine = mine.join(often, "term", "left").filter(F.col("df_term").isNull() | (F.col("df_term") <= bounds))
    known = mine.filter("df_term is not null")
    mine = materialise(known.unionByName(mine.filter("df_term is null").drop("df_term").join(rest, "term")), "mine")
    # every pair of a term and an entity of two texts or more is a trial
    trials = df.filter("df_term > 1").count() * groups.select("g", "h").distinct().count()
    needed = math.log(max(trials, n) / ALPHA)
    pairs = materialise(mine.filter("df_term > 1").join(groups, "tk").filter(F.col("df_term") <= F.col("most")).drop("most"), "pairs")
    scored = pairs.groupBy("term", "g", "h", "df_group", "df_term").agg(F.count(F.lit(1)).alias("co"))
    mean = F.col("df_term") * share("df_group")
    evidence = F.col("co") * F.log(F.col("co") / mean) - F.col("co") + mean
    scored = scored.withColumn("left", left("df_group")).filter((F.col("co") > mean) & (evidence >= needed) & (F.col("left") <= GENERALISE))
    scored = small(materialise(scored.select("term", "g", "h", "left"), "scored"))
    same = mine.join(named, ["tk", "term"]).filter(F.col("df_term") <= F.col("most"))
    owners = same.groupBy("term", "df_name", "df_term").agg(F.count(F.lit(1)).alias("co")).withColumn("left", left("df_name"))
    owners = owners.filter(F.col("left") <= GENERALISE).select("term", "left")
    both = pairs.join(scored, ["term", "g", "h"]).select("tk", "term", "left").unionByName(same.select("tk", "term").join(owners, "term").select("tk", "term", "left"))
    return both.groupBy("tk", "term").agg(F.min("left").alias("left"))


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Every place of the ``terms(tk, term, left)`` in their texts."""
    holds = terms.select("tk").distinct()
    holds = broadcast_if_small(holds, holds.count(), BROADCAST_ROWS)
    d = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_key(F.col("text")).alias("tk"), "text").join(holds, "tk", "left_semi")
    d = d.select("rid", "doc_id", "tk", F.regexp_extract_all("text", F.lit(f"{LETTERS}++"), F.lit(0)).alias("m"), F.split("text", f"{LETTERS}++").alias("gaps"))
    parts = F.zip_with("m", "gaps", lambda w, gap: F.struct(w.alias("w"), F.length(gap).alias("gap")))
    rows = d.select("rid", "doc_id", "tk", F.posexplode(F.slice(parts, F.lit(1), F.size("m"))).alias("i", "p")).select("rid", "doc_id", "tk", "i", "p.*")
    order = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("w")).over(order).cast("long"))
    rows = rows.withColumn("term", F.translate("w", UPPER, LOWER)).join(terms, ["tk", "term"])
    act = F.when(F.col("left") <= REMOVE, F.lit("")).otherwise(F.lit("[TERM]"))
    return rows.select(
        "doc_id", "tk", F.lit(4).alias("kind"), (F.col("end") - F.length("w")).alias("start"), "end", act.alias("action")
    ).distinct()


def places(docs: DataFrame) -> DataFrame:
    """All spans to sanitise: ``(doc_id, tk, kind, start, end, action)``."""
    found = materialise(matches(docs), "found")
    terms = materialise(disclosing(docs, found), "disclosing")
    label = F.concat(F.lit("["), F.upper(F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)), F.lit("]"))
    base = found.select("doc_id", "tk", "kind", "start", "end", label.alias("action"))
    both = base.unionByName(term_places(docs, terms))
    # terms that overlap an entity go with it
    by_start = Window.partitionBy("doc_id", "tk").orderBy("start")
    before = F.max(F.when(F.col("kind") < 4, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    behind = F.min(F.when(F.col("kind") < 4, F.col("start"))).over(by_start.rangeBetween(1, Window.unboundedFollowing))
    apart = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(behind, F.col("end")) >= F.col("end"))
    return both.withColumn("apart", apart).filter((F.col("kind") < 4) | F.col("apart")).drop("apart")


def by_text(spans: DataFrame) -> DataFrame:
    s = F.struct(*[c for c in spans.columns if c not in ("doc_id", "tk")])
    return spans.groupBy(F.col("doc_id").alias("sid"), F.col("tk").alias("stk")).agg(F.array_sort(F.collect_set(s)).alias("spans"))


def attach(docs: DataFrame, spans: DataFrame) -> DataFrame:
    key = F.col("doc_id").eqNullSafe(F.col("sid")) & (F.col("tk") == F.col("stk"))
    lists = by_text(spans)
    empty = F.array().cast(lists.schema["spans"].dataType)
    return docs.join(lists, key, "left").withColumn("spans", F.coalesce("spans", empty)).drop("sid", "stk")


def replaced(text, spans):
    """``text`` with its spans replaced: the pieces between them and their
    actions, joined once.  A span that starts before ``at``, the end reached by
    those ahead of it, goes with them."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "kind", "action", "at")])))
    piece = lambda a, n: F.substring(text, (a + 1).cast("int"), F.greatest(F.lit(0), n).cast("int"))
    parts = F.transform(
        ordered, lambda s: F.when(s["start"] >= s["at"], F.concat(piece(s["at"], s["start"] - s["at"]), s["action"])).otherwise(F.lit(""))
    )
    last = F.array_max(F.transform(ordered, lambda s: s["end"]))
    return F.concat(F.array_join(parts, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with sanitised texts; same columns."""
    ahead = Window.partitionBy("doc_id", "tk").orderBy("start", "end", "kind", "action").rowsBetween(Window.unboundedPreceding, -1)
    spans = places(docs.select("doc_id", "text")).withColumn("at", F.coalesce(F.max("end").over(ahead), F.lit(0).cast("long")))
    # the input goes through as one struct, so that none of its names can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = attach(docs.select(row.alias("row"), "doc_id", F.col("text").alias("text"), text_key(F.col("text")).alias("tk")), spans)
    text = F.when(F.size("spans") > 0, replaced(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return rows.select("row", text.alias("clean")).select(
        *[F.col("clean").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )


def digest(docs: DataFrame) -> DataFrame:
    spans = places(docs)
    rows = attach(docs.select("doc_id", text_key(F.col("text")).alias("tk")), spans)
    named = lambda s: F.concat(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")
    )
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] < 4), named), ",")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", named), ",").alias("spans"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read(spark, sf_dir, "documents").select("doc_id", "text"))
