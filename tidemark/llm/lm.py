"""Operator 1: scoring with a log-bilinear neural language model.

The model predicts the next token from the ``CONTEXT`` tokens before it: the
predicted vector is the sum of the context tokens' vectors, each scaled by
the position's own diagonal; its dot product with an output's vector plus a
bias is that output's score.  Outputs have two levels: the upper ones are
word classes, the text end and groups of words, the lower ones the words of
a group.  Training is noise-contrastive estimation in numpy at both levels
(noise: unigram shares; ``NOISE`` samples shared by a batch, ``GROUP_NOISE``
in each group).  Scoring multiplies batches of predicted vectors with the
upper matrix and with their group's, and normalises every row of both, so
each token gets a true log-probability.

Every word that holds at least 1/``FREQUENT`` of all tokens, and occurs
``LEAST`` times in training, has vectors of its own, as context and as
output; the other words share those of their class (by length and kind of
letters).  A word in a class has probability P(class | context) * (c + 0.1)
/ (N_class + 0.1 * (V_class + 1)), so probabilities of all words sum to one,
with one unseen word in each class.

How the work is spread: word counts are a shuffle of map-side sums.  Texts
are then encoded once and written as ids, from which training and scoring
read.  Every partition trains on its own texts; each row of parameters is
averaged over the partitions by how often they learned from it, in blocks
that a shuffle brings together (``ROUNDS`` rounds, each over its own share of
the texts, starting from the average before it): every training text is
learned from once.  The frequent words, at most ``FREQUENT`` whatever the
corpus, and their parameters go to every task; all others are joined by a
shuffle, and none of them can be a hot key.

Defined results: null or empty texts have one token, the end; a null doc_id
is held out; repeated rows are scored (and learned from) each; an empty table
gives no rows; extra columns are ignored.  With no training text the base is
uniform over one unseen word and the model stays at its start.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, materialise, read, ship

ship(__name__)

CONTEXT = 4
DIM = 16
LEAST = 2  # words learnt once stand for the unseen ones, in their classes
NOISE = 32
GROUP_NOISE = 4
BATCH = 2048
RUN = 32  # tokens in a row that a batch takes together
ROUNDS = 2
RATE = 0.1
BLOCK = 512  # rows of parameters that partitions hand on together
FREQUENT = 500_000
ADD = 0.1
END = b""  # no word is empty
FLUSH = 3_000_000  # words that a task gathers before it counts them and hands the counts on
LENGTHS = (5, 9, 14)
CLASSES = 3 * (len(LENGTHS) + 1)
ROWS = 1024  # predicted vectors in one matrix product: it stays in the cache


def word_class(w: bytes) -> int:
    n = len(w)
    k = 0 if n <= LENGTHS[0] else 1 if n <= LENGTHS[1] else 2 if n <= LENGTHS[2] else 3
    return k + 4 * (0 if w.isalpha() else 1 if w.isascii() else 2)


def word_classes(words: pa.StringArray) -> np.ndarray:
    """:func:`word_class` of every word of an array."""
    n = pc.binary_length(words).to_numpy(zero_copy_only=False)
    alpha, ascii_ = (f(words).to_numpy(zero_copy_only=False) for f in (pc.ascii_is_alpha, pc.string_is_ascii))
    return (np.searchsorted(LENGTHS, n) + 4 * np.where(alpha, 0, np.where(ascii_, 1, 2))).astype(np.int16)


def split_words(texts) -> tuple:
    """Lower-cased words of a text column, one after another, and each text's number of words."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lists = pc.ascii_split_whitespace(texts)
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0  # one word, the empty one
    if empty.any():
        words, n = words.filter(pc.not_equal(words, "")), np.where(empty, 0, n)
    return words, n


def count_words(rows: DataFrame) -> DataFrame:
    """``rows(held_out, text)`` -> ``(w, k, c, n)``: class, training count, whole count."""

    def counted(words: pa.StringArray, learnt: int):
        got = words.value_counts()
        w, n = got.field("values"), got.field("counts").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays(
            [w.cast(pa.binary()), pa.array(word_classes(w), pa.int32()), pa.array(n * learnt), pa.array(n)], names=["w", "k", "c", "n"]
        )

    def run(batches):
        parts, texts, size = {0: [], 1: []}, [0, 0], 0
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for learnt, mask in ((1, ~held), (0, held)):
                if mask.any():
                    words, _ = split_words(batch.column("text").filter(pa.array(mask)))
                    parts[learnt].append(words)
                    texts[learnt] += int(mask.sum())
                    size += len(words)
            if size > FLUSH:
                for learnt, got in parts.items():
                    if got:
                        yield counted(pa.concat_arrays(got), learnt)
                parts, size = {0: [], 1: []}, 0
        for learnt, got in parts.items():
            if got:
                yield counted(pa.concat_arrays(got), learnt)
        ends = [pa.array([END], pa.binary()), pa.array([-1], pa.int32()), pa.array([texts[1]], pa.int64()), pa.array([sum(texts)], pa.int64())]
        if sum(texts):
            yield pa.RecordBatch.from_arrays(ends, names=["w", "k", "c", "n"])

    parts = rows.select("held_out", "text").mapInArrow(run, "w binary, k int, c long, n long")
    return parts.groupBy("w", "k").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words and the figures of all others."""

    def __init__(self, counts: DataFrame, output_words: int | None, frequent: int):
        whole = counts.agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
        self.total, self.types, everything = whole["c"] or 0, whole["v"] or 0, whole["n"] or 0
        hot = counts.filter((F.col("n") * frequent >= everything) | (F.col("k") < 0)).orderBy(F.desc("c"), "w").toArrow().to_pylist()
        self.everything = everything
        self.words = [bytes(r["w"]) for r in hot]
        self.counts = np.array([r["c"] for r in hot], np.int64)
        chosen = [i for i, r in enumerate(hot) if r["w"] and r["c"] >= LEAST][:output_words]
        # output ids: classes first, the end, then words
        self.output = np.array([CLASSES if not w else word_class(w) for w in self.words], np.int32)
        for j, i in enumerate(chosen):
            self.output[i] = CLASSES + 1 + j
        self.size = CLASSES + 1 + len(chosen)
        per = {r["k"]: (r["c"], r["v"]) for r in counts.filter("k >= 0").groupBy("k").agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).collect()}
        mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
        for k, (c, v) in per.items():
            mass[k], types[k] = c, v
        share = np.zeros(self.size)
        for i in chosen:
            k = word_class(self.words[i])
            mass[k] -= self.counts[i]
            types[k] -= 1
            share[self.output[i]] = self.counts[i]
        share[:CLASSES] = mass
        share[CLASSES] = sum(int(c) for w, c in zip(self.words, self.counts) if not w)
        self.share = (share + 1) / (share + 1).sum()
        self.class_log = np.zeros(self.size)
        self.class_log[:CLASSES] = -np.log10(mass + ADD * (types + 1))
        # a frequent word's own part of its probability: nothing if it is an output
        self.log = np.log10(self.counts + ADD)
        self.own = np.where(self.output >= CLASSES, 0.0, self.log)


def group_bounds(v: int) -> np.ndarray:
    """First ids of the groups of words among ``v`` outputs, and ``v``.  Words
    come by falling count: a group's size grows with the root of its rank, so
    that the frequent words, which most tokens are, stand in small groups."""
    words = max(0, v - CLASSES - 1)
    n = math.ceil(math.sqrt(words) / 1.5)
    ranks = np.ceil(words * (np.arange(n + 1) / max(n, 1)) ** 2).astype(np.int64)
    return min(v, CLASSES + 1) + np.unique(ranks)


def group_of(v: int) -> np.ndarray:
    """Upper output of every id: its own for a class and the end, its group's for a word."""
    single = min(v, CLASSES + 1)
    return np.concatenate([np.arange(single), single + np.repeat(np.arange(len(group_bounds(v)) - 1), np.diff(group_bounds(v)))])


def upper_share(share: np.ndarray) -> np.ndarray:
    return np.bincount(group_of(len(share)), weights=share)


def shapes(v: int) -> list:
    """Of the context vectors (the last row pads a text's beginning), the
    position diagonals, and the words' and the upper outputs' vectors, whose
    last column is the bias."""
    return [(v + 1, DIM), (CONTEXT, DIM), (v, DIM + 1), (min(v, CLASSES + 1) + len(group_bounds(v)) - 1, DIM + 1)]


def start_parameters(share: np.ndarray, seed: int = 11) -> np.ndarray:
    """All parameters in one array; biases start at the unigram shares."""
    rng, upper = np.random.default_rng(seed), upper_share(share)
    r, c, q, g = (rng.normal(0, 0.1, x) for x in shapes(len(share)))
    c[:] = 1
    q[:, DIM] = np.log(share / upper[group_of(len(share))])
    g[:, DIM] = np.log(upper)
    return np.concatenate([x.ravel() for x in (r, c, q, g)]).astype(np.float32)


def unpack(p: np.ndarray, v: int) -> list:
    """The four parts of :func:`shapes`, as views."""
    out, at = [], 0
    for rows, columns in shapes(v):
        out.append(p[at : at + rows * columns].reshape(rows, columns))
        at += rows * columns
    return out


def predicted(rows: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Predicted vectors of all but the first ``CONTEXT`` positions of runs of
    context vectors, and a last column of ones, which the biases meet."""
    n = rows.shape[-2] - CONTEXT
    out = np.ones((*rows.shape[:-2], n, DIM + 1), np.float32)
    total = rows[..., CONTEXT - 1 : CONTEXT - 1 + n, :] * c[0]
    for i in range(1, CONTEXT):
        total += rows[..., CONTEXT - 1 - i : CONTEXT - 1 - i + n, :] * c[i]
    out[..., :DIM] = total
    return out


def lay_out(docs: list):
    """``(tokens before, ids)`` of texts or runs in one array; positions of their tokens; where each begins among them."""
    flat = np.concatenate([x for d in docs for x in d])
    n = np.array([len(d) for _, d in docs])
    begin = np.concatenate([[0], np.cumsum(n)[:-1]])
    at = np.arange(n.sum()) + np.repeat((np.arange(len(docs)) + 1) * CONTEXT, n)
    return flat, at, begin


class Trainer:
    """Stochastic gradient steps of noise-contrastive estimation (Adagrad).

    Upper outputs share ``NOISE`` noise samples a batch, the words of a group
    ``GROUP_NOISE``.  Only the rows that a batch touches are changed.
    """

    def __init__(self, start: np.ndarray, share: np.ndarray, seed: int):
        self.v, self.p = len(share), start.astype(np.float32)
        self.parts = unpack(self.p, self.v)
        self.seen = unpack(np.full(len(start), 1e-2, np.float32), self.v)
        self.rng, upper, self.group = np.random.default_rng(seed), upper_share(share), group_of(self.v)
        self.upper, self.upper_cum = upper, np.cumsum(upper)
        self.upper_log = np.log(NOISE * upper).astype(np.float32)
        self.bounds, self.cum = group_bounds(self.v), np.concatenate([[0.0], np.cumsum(share)])
        self.noise_log = np.log(GROUP_NOISE * share / upper[self.group]).astype(np.float32)
        self.times = [np.zeros(rows) for rows, _ in shapes(self.v)]  # how often a row was learned from
        self.flag, self.place = np.zeros(self.v + 1, bool), np.zeros(self.v + 1, np.int64)
        self.tokens = 0

    def sums(self, ids: np.ndarray, rows: np.ndarray):
        """Distinct ids, how often each occurs and the sums of its rows."""
        self.flag[ids] = True
        found = np.flatnonzero(self.flag)
        self.flag[found] = False
        self.place[found] = np.arange(len(found))
        at, d = self.place.take(ids), rows.shape[1]
        total = np.zeros(len(found) * d, np.float32)
        np.add.at(total, (at[:, None] * d + np.arange(d)).ravel(), rows.ravel())
        return found, np.bincount(at, minlength=len(found)), total.reshape(-1, d)

    def climb(self, part: int, at: np.ndarray, g: np.ndarray) -> None:
        seen = self.seen[part].take(at, axis=0) + g * g
        self.seen[part][at] = seen
        self.parts[part][at] = self.parts[part].take(at, axis=0) + RATE * g / np.sqrt(seen)

    def words(self, pred: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Learns the words inside their groups; the gradient of the predicted vectors."""
        q, first = self.parts[2], min(self.v, CLASSES + 1)
        lo, hi = self.cum[self.bounds[:-1], None], self.cum[self.bounds[1:], None]
        drawn = np.searchsorted(self.cum, lo + (hi - lo) * self.rng.random((len(lo), GROUP_NOISE)), "right") - 1
        drawn = np.clip(drawn, self.bounds[:-1, None], self.bounds[1:, None] - 1)
        group = self.group.take(target) - first
        noise, wanted = q[drawn].take(group, axis=0), q.take(target, axis=0)
        s_t = np.einsum("ij,ij->i", pred, wanted) - self.noise_log.take(target)
        s_n = np.einsum("ij,ikj->ik", pred, noise) - self.noise_log[drawn].take(group, axis=0)
        g_t = 1 / (1 + np.exp(np.clip(s_t, -30, 30)))
        g_n = -1 / (1 + np.exp(-np.clip(s_n, -30, 30)))
        out = (wanted * g_t[:, None] + np.einsum("ik,ikj->ij", g_n, noise))[:, :DIM]
        hit, _, dn = self.sums(group, (g_n[:, :, None] * pred[:, None]).reshape(len(pred), -1))
        ids = np.concatenate([target, drawn[hit].ravel()])
        found, n, dq = self.sums(ids, np.concatenate([pred * g_t[:, None], dn.reshape(-1, DIM + 1)]))
        self.climb(2, found, dq / n[:, None].astype(np.float32))
        self.times[2][found] += n
        return out

    def step(self, ids: np.ndarray, learnt: np.ndarray) -> None:
        """One batch of runs of ``CONTEXT`` tokens and those to be predicted, if ``learnt``."""
        r, c, _, upper = self.parts
        rows = r.take(ids, axis=0)
        pred, target = predicted(rows, c)[learnt], ids[:, CONTEXT:][learnt]
        n, group = len(target), self.group.take(target)
        noise = np.minimum(np.searchsorted(self.upper_cum, self.rng.random(NOISE)), len(upper) - 1)
        wanted = upper.take(group, axis=0)
        s_t = np.einsum("ij,ij->i", pred, wanted) - self.upper_log.take(group)
        s_n = pred @ upper[noise].T - self.upper_log[noise]
        g_t = 1 / (1 + np.exp(np.clip(s_t, -30, 30)))
        g_n = -1 / (1 + np.exp(-np.clip(s_n, -30, 30)))
        wanted = (wanted * g_t[:, None] + g_n @ upper[noise])[:, :DIM]  # the gradient of the predicted vectors
        found, _, dg = self.sums(np.concatenate([group, noise]), np.concatenate([pred * g_t[:, None], g_n.T @ pred]))
        self.climb(3, found, dg / np.maximum(1, n * self.upper[found, None]).astype(np.float32))
        if len(inner := np.flatnonzero(target > CLASSES)):
            wanted[inner] += self.words(pred.take(inner, axis=0), target.take(inner))
        whole = np.zeros((*learnt.shape, DIM), np.float32)
        whole[learnt] = wanted
        dr, dc = np.zeros_like(rows), np.empty_like(c)
        for i in range(CONTEXT):
            part = slice(CONTEXT - 1 - i, CONTEXT - 1 - i + learnt.shape[1])
            dr[:, part] += whole * c[i]
            dc[i] = np.einsum("ijk,ijk->k", whole, rows[:, part]) / n
        found, times, dr = self.sums(ids.ravel(), dr.reshape(-1, DIM))
        self.climb(0, found, dr / times[:, None].astype(np.float32))
        self.climb(1, np.arange(CONTEXT), dc)
        self.times[0][found] += times
        self.tokens += n

    def learn(self, docs: list) -> None:
        flat, at, _ = lay_out(docs)
        learnt = np.zeros(-(-len(flat) // RUN) * RUN, bool)
        learnt[at - CONTEXT] = True
        flat = np.concatenate([flat, np.full(len(learnt) + CONTEXT - len(flat), self.v, flat.dtype)])
        runs = self.rng.permutation(len(learnt) // RUN)
        for k in range(0, len(runs), BATCH // RUN):
            some = runs[k : k + BATCH // RUN, None] * RUN
            mask = learnt[some + np.arange(RUN)]
            if mask.any():
                self.step(flat[some + np.arange(RUN + CONTEXT)], mask)

    def blocks(self):
        """The rows learned from, weighted by how often: ``(part, block, i, n,
        x)``, ``BLOCK`` rows at most in one."""
        self.times[1][:] = self.times[3][:] = self.tokens
        for part, (x, n) in enumerate(zip(self.parts, self.times)):
            for k in range(0, len(x), BLOCK):
                i = np.flatnonzero(n[k : k + BLOCK])
                if len(i):
                    w = n[k : k + BLOCK][i].astype(np.float32)
                    yield part, k // BLOCK, i.astype(np.int32).tobytes(), w.tobytes(), (x[k : k + BLOCK][i] * w[:, None]).tobytes()


def averaged(t: pa.Table) -> pa.Table:
    """The rows of one block over all partitions: ``(part, block, i, x)``."""
    n, x = np.zeros(BLOCK), None
    for i, w, rows in zip(*(t.column(c).to_pylist() for c in ("i", "n", "x"))):
        i, w = np.frombuffer(i, np.int32), np.frombuffer(w, np.float32)
        rows = np.frombuffer(rows, np.float32).reshape(len(i), -1)
        x = np.zeros((BLOCK, rows.shape[1])) if x is None else x
        n[i] += w
        x[i] += rows
    i = np.flatnonzero(n)
    one = t.slice(0, 1).select(["part", "block"])
    mean = (x[i] / n[i, None]).astype(np.float32)
    return one.append_column("i", pa.array([i.astype(np.int32).tobytes()])).append_column("x", pa.array([mean.tobytes()]))


def batches_of(docs, pad: int, limit: int = 1 << 18):
    """Lists of ``(tokens before, ids)`` of about ``limit`` tokens.  A longer
    text is cut into runs, each with the tokens before it as its context."""
    got, n, gap = [], 0, np.full(CONTEXT, pad, np.int32)
    for d in docs:
        for k in range(0, len(d), limit):
            before = np.concatenate([gap, d[max(0, k - CONTEXT) : k]])[-CONTEXT:]
            got.append((before, d[k : k + limit]))
            n += len(got[-1][1])
            if n >= limit:
                yield got
                got, n = [], 0
    if got:
        yield got


def id_lists(column) -> list:
    """A column of id lists as arrays."""
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return [flat[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


def train(rows: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Averaged parameters after ``rounds`` rounds over ``rows(doc_id, ids)``."""
    sc = rows.sparkSession.sparkContext
    share, p = vocab.share, start_parameters(vocab.share)
    for r in range(rounds):
        mine = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(rounds)) == r) if rounds > 1 else rows
        start = sc.broadcast((p, share))

        def run(batches, start=start, seed=r):
            t = Trainer(*start.value, seed)
            for group in batches_of((d for batch in batches for d in id_lists(batch.column("ids"))), t.v):
                t.learn(group)
            if t.tokens:
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*t.blocks()), kinds)], names=["part", "block", "i", "n", "x"])

        parts = mine.select("ids").mapInArrow(run, "part int, block int, i binary, n binary, x binary")
        got = parts.groupBy("part", "block").applyInArrow(averaged, "part int, block int, i binary, x binary").toArrow().to_pylist()
        start.destroy()
        p = p.copy()
        for row in got:
            i = np.frombuffer(row["i"], np.int32) + row["block"] * BLOCK
            unpack(p, len(share))[row["part"]][i] = np.frombuffer(row["x"], np.float32).reshape(len(i), -1)
    return p


def normalised(pred: np.ndarray, outputs: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Natural log-probability of output ``own`` at each predicted vector."""
    z = pred @ outputs.T
    out = z[np.arange(len(own)), own].astype(np.float64)
    if max(z.max(), -z.min()) > 60:  # beyond what exp holds
        top = z.max(1)
        z -= top[:, None]
        out -= top
    np.exp(z, out=z)
    return out - np.log(z @ np.ones(z.shape[1], np.float32))


def log_probabilities(p: np.ndarray, v: int, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of the output at each position: its upper
    output's, and the word's among its group."""
    r, c, q, upper = unpack(p, v)
    out, target, single = np.empty(len(at)), flat[at], min(v, CLASSES + 1)
    group, at = group_of(v).take(target), at - CONTEXT
    pred = np.empty((len(flat) - CONTEXT, DIM + 1), np.float32)
    for k in range(0, len(pred), ROWS):
        pred[k : k + ROWS] = predicted(r.take(flat[k : k + ROWS + CONTEXT], axis=0), c)
    for k in range(0, len(at), ROWS):
        out[k : k + ROWS] = normalised(pred.take(at[k : k + ROWS], axis=0), upper, group[k : k + ROWS])
    order, bounds = np.argsort(group.astype(np.int16), kind="stable"), group_bounds(v)
    ends = np.cumsum(np.bincount(group, minlength=len(upper))).tolist()
    for j, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), single):
        begin, end = ends[j - 1], ends[j]
        rows = max(1, ROWS * 128 // (hi - lo))
        for k in range(begin if hi - lo > 1 else end, end, rows):
            some = order[k : min(k + rows, end)]
            out[some] += normalised(pred.take(at.take(some), axis=0), q[lo:hi], target.take(some) - lo)
    return out / math.log(10)


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Every text's output ids, the sums over its frequent words, and its
    other words with their number: ``(rid, doc_id, held_out, n_tokens, known,
    base, own, ids, rare, times)``.  Training and scoring need no text."""
    sc = rows.sparkSession.sparkContext
    table = sc.broadcast(({w: i for i, w in enumerate(vocab.words)}, vocab.output, vocab.log, vocab.own, vocab.counts > 0))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"rid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, own double, "
        "ids array<int>, rare array<binary>, times array<int>"
    )

    def run(batches):
        index, output, log, own, known = table.value
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                end = index[END]  # wherever there is a text, there is an end
                batch = whole.slice(k, 500)
                flat, n = split_words(batch.column("text"))
                coded = flat.dictionary_encode()
                words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
                # figures of the distinct words, then of the tokens; each text ends with END
                place = np.fromiter((index.get(w, -1) for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))
                often = place >= 0
                at_end = np.cumsum(n + 1) - 1
                token = np.full(int((n + 1).sum()), len(words))
                inner = np.ones(len(token), bool)
                inner[at_end] = False
                token[inner] = code
                begin = at_end - n

                def per_text(of, rest=0.0):
                    value = np.append(np.where(often, of[place], rest), of[end])
                    return np.add.reduceat(value[token], begin)

                ids = np.append(np.where(often, output[place], word_classes(words)), output[end]).astype(np.int32)[token]
                # each text's other words, once with their number
                doc = np.repeat(np.arange(batch.num_rows), n)
                rare = ~often[code]
                pair, times = np.unique(doc[rare] * max(len(words), 1) + code[rare], return_counts=True)
                per = np.concatenate([[0], np.cumsum(np.bincount(pair // max(len(words), 1), minlength=batch.num_rows))])
                lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("rid", "doc_id", "held_out")]
                    + [pa.array(n + 1), pa.array(per_text(known.astype(np.int64), 0).astype(np.int64)), pa.array(per_text(log)), pa.array(per_text(own)),
                       lists(np.append(begin, len(token)), pa.array(ids)), lists(per, words.take(pa.array(pair % max(len(words), 1))).cast(pa.binary())),
                       lists(per, pa.array(times, pa.int32()))],
                    names=["rid", "doc_id", "held_out", "n_tokens", "known", "base", "own", "ids", "rare", "times"],
                )

    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(run, schema)


def score_ids(encoded: DataFrame, vocab: Vocabulary, p: np.ndarray) -> DataFrame:
    """``(rid, doc_id, held_out, n_tokens, known, base, score)``: all but what only the shuffle knows."""
    size, class_log = vocab.size, vocab.class_log
    keep = ["rid", "doc_id", "held_out", "n_tokens", "known", "base"]
    schema = ", ".join(f"{c} {encoded.schema[c].dataType.simpleString()}" for c in keep) + ", score double"
    pad = np.full(CONTEXT, size, np.int32)

    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                batch = whole.slice(k, 200)
                flat, at, begin = lay_out([(pad, d) for d in id_lists(batch.column("ids"))])
                logs = log_probabilities(p, size, flat, at) + class_log[flat[at]]
                model = np.add.reduceat(logs, begin) + batch.column("own").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(model, pa.float64())], names=[*keep, "score"])

    return encoded.select(*keep, "own", "ids").mapInArrow(run, schema)


def score_corpus(rows: DataFrame, output_words: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """``rows(doc_id, held_out, text)`` -> one row per input row with the
    columns of the query; learns from the rows that are not held out."""
    counts = materialise(count_words(rows), "words")
    vocab = Vocabulary(counts, output_words, frequent)
    encoded = materialise(encode(rows, vocab), "encoded")
    p = train(encoded.filter("not held_out"), vocab)
    others = counts.filter((F.col("n") * frequent < vocab.everything) & (F.col("k") >= 0)).select(F.col("w").alias("vw"), F.col("c").alias("vc"))
    rare = encoded.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("rid", "x.rare", "x.times")
    sums = rare.join(others, F.col("rare") == F.col("vw"), "left").groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("vc", F.lit(0)) + F.lit(ADD))).alias("rare_log"),
        F.sum(F.when(F.col("vc") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    space = math.log10(vocab.total + ADD * (vocab.types + 1))
    extra = F.coalesce("rare_log", F.lit(0.0))
    return score_ids(encoded, vocab, p).join(sums, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(space)).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_corpus(docs.withColumn("held_out", fold(F.col("doc_id"), 10) == 0))
