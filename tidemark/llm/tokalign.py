"""Operator 11: alignment of two tokenizers, divide and conquer at shared cuts.

A text is encoded by a byte-level BPE (A, given a space before the text) and
by a sentence piece model (B, which adds that space).  Both give the same
bytes, so the ends of A's and of B's tokens are offsets into one string.  An
interval of both token lists is cut at an end that both share, the one
nearest to the middle of A's tokens: A's ends near the middle are looked up
among B's by bisection, the middle first, then in windows that grow fourfold.
Both halves are cut again; an interval without a shared end inside is a leaf,
and the leaves are the groups.  All intervals of a batch of texts are cut at
once, level by level, by numpy.

All pairs of an A and a B token of one group are linked.  ``align`` counts,
for every pair of ids, the texts that hold it linked, and gives every text
its links, how many of them go to their A id's commonest partner, and the sum
of their counts.

How the work is spread: texts are encoded and cut in one pass, which writes
each text's distinct pairs with their number of links to the shared folder.
Tasks add up pairs before the shuffle that counts them.  Pairs that make up
more than 1/``FREQUENT`` of all (so at most ``FREQUENT`` pairs) and each A
id's best count (at most the vocabulary) go to every task; the other pairs
are joined by a shuffle, and none of them can be a hot key.  In a group too
large to list, equal ids are counted together first.

The tokenizers' files are read by the driver and sent to the tasks.  A's file
holds its ranks as ids; the same pieces are encoded through them by a faster
library, whose ids equal those of the file's own (tested on every character).

Defined results: texts that are null or empty, or whose joined bytes differ
from space + text in either tokenizer, have no tokens: zeros and the empty
digest string; repeated rows count as a text each; a null doc_id takes part;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, read, ship

ship(__name__)

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# how the byte-level BPE splits a text before merging (fixed value)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FREQUENT = 1 << 20
TEXT_BYTES = 1 << 20  # texts that are cut together
LISTED = 1 << 12  # links of a group that are listed one by one
FLUSH = 1 << 21  # pairs that a task adds up at a time


def byte_alphabet() -> dict:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoders:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, file_a: bytes, file_b: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(file_a)
        special = {x["content"] for x in spec["added_tokens"] if x["special"]}
        of_char = byte_alphabet()
        ranks = {bytes(of_char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = max(ranks.values()) + 1, n
        self.bytes_a = [b""] * self.size_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        names = [f"{i}{end}" for size, ends in ((self.size_a, ",|"), (n, ",;")) for end in ends for i in range(size)]
        self.names = np.array(names, dtype=f"S{max(map(len, names))}")
        self.name_at = (0, self.size_a, 2 * self.size_a, 2 * self.size_a + n)

    def encode(self, text: str):
        """Ids of both, or None where the bytes differ or there is no text."""
        if not text:
            return None
        whole = (" " + text).encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def bisect(ends: np.ndarray, wanted: np.ndarray):
    """Index of each wanted offset among sorted ends, and whether it is there."""
    j = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
    return j, ends[j] == wanted


def cut(end_a: np.ndarray, end_b: np.ndarray, start: np.ndarray):
    """First tokens of all leaf groups, ``(a, b)`` in order.

    ``end_a``, ``end_b``: ascending end offsets of all tokens of some texts;
    ``start``: rows (al, ah, bl, bh), the texts' token ranges.
    """
    leaves, todo = [], start
    while len(todo):
        al, ah, bl, bh = todo.T
        leaf = (ah - al == 1) | (bh - bl == 1)
        leaves.append(todo[leaf][:, [0, 2]])
        todo = todo[~leaf]
        halves, reach, open_ = [], 0, todo
        while len(open_):
            al, ah, bl, bh = open_.T
            mid = (al + ah - 2) // 2
            lo, hi = np.maximum(mid - reach, al), np.minimum(mid + reach, ah - 2)
            n = hi - lo + 1
            begin = np.cumsum(n) - n
            at = np.arange(n.sum()) - np.repeat(begin - lo, n)
            j, same = bisect(end_b, end_a[at])
            far = np.where(same, 2 * np.abs(at - np.repeat(mid, n)) + (at < np.repeat(mid, n)), np.iinfo(np.int64).max)
            best = np.minimum.reduceat(far, begin)
            found = best < np.iinfo(np.int64).max
            pos = mid[found] + np.where(best[found] % 2, -(best[found] // 2), best[found] // 2)
            k = bisect(end_b, end_a[pos])[0]
            got = open_[found]
            halves += [np.stack([got[:, 0], pos + 1, got[:, 2], k + 1], 1), np.stack([pos + 1, got[:, 1], k + 1, got[:, 3]], 1)]
            whole = ~found & (lo == al) & (hi == ah - 2)
            leaves.append(open_[whole][:, [0, 2]])
            open_ = open_[~found & ~whole]
            reach = 4 * reach if reach else 1
        todo = np.concatenate(halves) if halves else todo[:0]
    leaves = np.concatenate(leaves)
    order = np.argsort(leaves[:, 0], kind="stable")
    return leaves[order, 0], leaves[order, 1]


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indices first, first + 1, ... (n of them) of every row, one after another."""
    begin = np.cumsum(n) - n
    return np.arange(n.sum()) - np.repeat(begin - first, n)


def link(a: np.ndarray, b: np.ndarray, ga, gb, na, nb, group_doc: np.ndarray, size_b: int):
    """Distinct (text, pair) of the groups and their numbers of links.

    Groups of many links count their equal ids together first.
    """
    small = na * nb <= LISTED
    keys, times = [], []
    x, y, n, m, doc = ga[small], gb[small], na[small], nb[small], group_doc[small]
    left = spread(x, n)  # every A token of the group, beside all its B tokens
    per = np.repeat(m, n)
    right = spread(np.repeat(y, n), per)
    keys.append(np.repeat(np.repeat(doc, n), per) << 32 | (np.repeat(a[left], per) * size_b + b[right]))
    times.append(np.ones(len(right), np.int64))
    for g in np.flatnonzero(~small):
        ua, ca = np.unique(a[ga[g] : ga[g] + na[g]], return_counts=True)
        ub, cb = np.unique(b[gb[g] : gb[g] + nb[g]], return_counts=True)
        keys.append(int(group_doc[g]) << 32 | (ua[:, None] * size_b + ub).ravel())
        times.append((ca[:, None] * cb).ravel())
    if len(keys) == 1:  # all links are single
        return np.unique(keys[0], return_counts=True)
    keys, times = np.concatenate(keys), np.concatenate(times)
    got, where = np.unique(keys, return_inverse=True)
    total = np.zeros(len(got), np.int64)
    np.add.at(total, where, times)
    return got, total


class Aligned:
    """The groups and links of some encoded texts (all with tokens)."""

    def __init__(self, docs: list, enc: Encoders):
        a, b = (np.concatenate([d[i] for d in docs]) for i in (0, 1))
        self.n_a, self.n_b = (np.array([len(d[i]) for d in docs], np.int64) for i in (0, 1))
        end_a, end_b = np.cumsum(enc.len_a[a]), np.cumsum(enc.len_b[b])
        last_a, last_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        first_a, first_b = last_a - self.n_a, last_b - self.n_b
        ga, gb = cut(end_a, end_b, np.stack([first_a, last_a, first_b, last_b], 1))
        na, nb = np.diff(ga, append=len(a)), np.diff(gb, append=len(b))
        doc = np.searchsorted(first_a, ga, side="right") - 1
        at = np.searchsorted(ga, first_a)
        self.n_groups = np.diff(at, append=len(ga))
        self.n_links = np.add.reduceat(na * nb, at)
        pair, self.times = link(a, b, ga, gb, na, nb, doc, enc.size_b)
        self.pairs = (pair & 0xFFFFFFFF).astype(np.int32)
        self.pair_at = np.searchsorted(pair, np.arange(len(docs) + 1) << 32)
        # every token's id and the sign behind it, group by group
        name_a, name_b = a + enc.name_at[0], b + enc.name_at[2]
        name_a[ga + na - 1] += enc.name_at[1] - enc.name_at[0]
        name_b[gb + nb - 1] += enc.name_at[3] - enc.name_at[2]
        row = np.empty(len(a) + len(b), np.int64)
        group_a, group_b = np.repeat(np.arange(len(ga)), na), np.repeat(np.arange(len(ga)), nb)
        row[np.arange(len(a)) + gb[group_a]] = name_a
        row[np.arange(len(b)) + (ga + na)[group_b]] = name_b
        text = enc.names[row]
        size = self.n_a + self.n_b
        self.digests = [
            hashlib.sha256(text[k : k + n].tobytes().replace(b"\0", b"")[:-1]).hexdigest()
            for k, n in zip((np.cumsum(size) - size).tolist(), size.tolist())
        ]


def lists(values: np.ndarray, at: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def aligned(docs: DataFrame, files: tuple) -> DataFrame:
    """One row per text: its figures, ``groups_sha256``, its distinct ``pairs``
    (A id * size of B + B id) and the ``times`` each is linked."""
    sent = docs.sparkSession.sparkContext.broadcast(files)
    kind = docs.schema["doc_id"].dataType.simpleString()
    figures = ["n_a", "n_b", "n_groups", "n_links"]

    def chunks(batches, enc):
        """(first row, rows, encoded texts) of about ``TEXT_BYTES`` each."""
        for batch in batches:
            begin, got, size = 0, [], 0
            for i, text in enumerate(batch.column("text")):
                got.append(enc.encode(text.as_py()))
                size += 0 if got[-1] is None else 4 * (len(got[-1][0]) + len(got[-1][1]))
                if size >= TEXT_BYTES:
                    yield batch.slice(begin, len(got)), got
                    begin, got, size = i + 1, [], 0
            if got:
                yield batch.slice(begin, len(got)), got

    def run(batches):
        enc = Encoders(*sent.value)
        for batch, got in chunks(batches, enc):
            n = batch.num_rows
            some = np.array([x is not None for x in got], bool)
            cols = {c: np.zeros(n, np.int64) for c in figures}
            digests, length = np.full(n, "", object), np.zeros(n, np.int64)
            pairs, times = np.zeros(0, np.int32), np.zeros(0, np.int64)
            if some.any():
                x = Aligned([d for d in got if d is not None], enc)
                for c in figures:
                    cols[c][some] = getattr(x, c)
                digests[some], length[some] = x.digests, np.diff(x.pair_at)
                pairs, times = x.pairs, x.times
            at = np.concatenate([[0], np.cumsum(length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), *(pa.array(cols[c]) for c in figures), pa.array(digests, pa.string()),
                 lists(pairs, at, pa.int32()), lists(times, at, pa.int64())],
                names=["rid", "doc_id", *figures, "groups_sha256", "pairs", "times"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"rid long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<long>"
    return rows.mapInArrow(run, schema)


def pair_counts(done: DataFrame) -> DataFrame:
    """``(pair, count)``: how many texts hold each pair linked."""

    def run(batches):
        got, n = [], 0

        def out():
            pair, count = np.unique(np.concatenate(got), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(count, pa.int64())], names=["pair", "count"])

        for batch in batches:
            got.append(batch.column("pairs").flatten().to_numpy(zero_copy_only=False))
            n += len(got[-1])
            if n >= FLUSH:
                yield out()
                got, n = [], 0
        if n:
            yield out()

    return done.select("pairs").mapInArrow(run, "pair int, count long").groupBy("pair").agg(F.sum("count").alias("count"))


def align(docs: DataFrame, file_a: bytes, file_b: bytes, frequent: int = FREQUENT) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per text with the columns of the query."""
    sc = docs.sparkSession.sparkContext
    size_b = Encoders(file_a, file_b).size_b
    done = materialise(aligned(docs, (file_a, file_b)), "aligned")
    counts = materialise(pair_counts(done), "pairs")
    whole = counts.agg(F.sum("count")).first()[0] or 0
    top = counts.groupBy((F.col("pair") / size_b).cast("int").alias("a")).agg(F.max("count").alias("top")).toArrow()
    best = np.zeros((1 << 31) // size_b + 1, np.int64)
    best[top.column("a").to_numpy()] = top.column("top").to_numpy()
    hot = counts.filter(F.col("count") * frequent >= whole).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    sent = sc.broadcast((hot.column("pair").to_numpy()[order], hot.column("count").to_numpy()[order], best))

    def run(batches):
        pair, count, top = sent.value
        for batch in batches:
            mine, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            size = pa.compute.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), size)
            k = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
            known = pair[k] == mine if len(pair) else np.zeros(len(mine), bool)
            c = np.where(known, count[k], 0) if len(pair) else np.zeros(len(mine), np.int64)
            total, to_best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, c * times)
            np.add.at(to_best, row, np.where(known & (c == top[mine // size_b]), times, 0))
            rare = ~known
            at = np.concatenate([[0], np.cumsum(np.bincount(row[rare], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(total), pa.array(to_best), lists(mine[rare], at, pa.int32()), lists(times[rare], at, pa.int64())],
                names=["rid", "total", "to_best", "rare", "times"],
            )

    first = done.select("rid", "pairs", "times").mapInArrow(run, "rid long, total long, to_best long, rare array<int>, times array<long>")
    first = materialise(first, "frequent")

    def marked(batches):
        top = sent.value[2]
        for batch in batches:
            a = batch.column("pair").to_numpy() // size_b
            yield pa.RecordBatch.from_arrays(
                [batch.column("pair"), batch.column("count"), pa.array(top[a] == batch.column("count").to_numpy())], names=["pair", "count", "best"]
            )

    others = counts.filter(F.col("count") * frequent < whole).mapInArrow(marked, "pair int, count long, best boolean")
    rare = first.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("rid", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
    sums = rare.join(others, "pair").groupBy("rid").agg(
        F.sum(F.col("times") * F.col("count")).alias("rare_total"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best")
    )
    zero = F.lit(0).cast("long")
    return done.drop("pairs", "times").join(first.select("rid", "total", "to_best"), "rid").join(sums, "rid", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        (F.col("to_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("total") + F.coalesce("rare_total", zero)).alias("count_sum"), "groups_sha256",
    )


def op11_align(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    with open(f"{tokenizers}/{FILE_A}", "rb") as a, open(f"{tokenizers}/{FILE_B}", "rb") as b:
        files = a.read(), b.read()
    return align(read(spark, sf_dir, "documents").select("doc_id", "text"), *files)
