"""Operator 6: quality classifier on supervised subword embeddings.

Every word and every character 3- and 5-gram of a text (bytes; a gram may
begin or end with the blank beside its word) is hashed into one of
``BUCKETS`` learned vectors; a word equal to the one before it also counts as
the extra word ``<again>``.  A text's vector is the mean of its feature
vectors, a softmax layer gives the probability of label 1, and everything is
trained by numpy stochastic gradient descent.

The classifier is fitted on a bounded sample: the ``SAMPLE_ROWS`` labelled
rows of the learning folds (crc32(doc_id) mod 5 is not 0) with the smallest
hash of doc_id, as far as their counts stay below ``SAMPLE_BYTES``.  Executors
reduce these texts to feature counts, one task trains on them, and the driver
gets the weights alone.
Scoring covers every whole text in one pass without a shuffle.

Defined results: null text counts as empty; a text without features scores
by the bias alone; without labelled rows every score is 0.5; rows with a
null label or doc_id are not learned from (a null doc_id counts as held
out); repeated rows score alike; an empty table gives no rows; labels, lang,
source and doc_id are never inputs.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fold, read, ship, text_key

ship(__name__)

BUCKETS = 1 << 16
DIM = 8
SAMPLE_ROWS = 4000
EPOCHS = 5
RATE = 0.5
THRESHOLD = 0.3
SAMPLE_BYTES = 256 << 20
PIECE = 1 << 18  # bytes handled at a time; features do not depend on it
BLANK = re.compile(rb"[\x20\x09-\x0D]")
GRAMS = (3, 5)
BASE = np.uint64(0x100000001B3)
AGAIN = 1  # bucket of the extra word <again>


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(48)).astype(np.int64)


def pieces(text: bytes, size: int = PIECE):
    """A text in parts of about ``size`` bytes, cut behind blanks only: a word is never cut."""
    at = 0
    while len(text) - at > size:
        blank = BLANK.search(text, at + size)
        if not blank or blank.end() == len(text):
            break
        yield text[at : blank.end()]
        at = blank.end()
    yield text[at:] if at else text


def groups(texts: list, size: int = PIECE):
    """(document number, bytes) parts gathered to about ``size`` bytes, and
    whether the first of them goes on with the last one's text."""
    got, n, goes_on = [], 0, False
    for i, t in enumerate(texts):
        for k, part in enumerate(pieces(t or b"", size)):
            if not got:
                goes_on = k > 0
            got.append((i, part))
            n += len(part)
            if n >= size:
                yield got, goes_on
                got, n = [], 0
    if got:
        yield got, goes_on


def all_features(texts: list, size: int = PIECE):
    """(owner, bucket) arrays of all features of some texts, a few parts at a time."""
    last = None
    for parts, goes_on in groups(texts, size):
        owner, got, last = features(parts, last if goes_on else None)
        yield owner, got


def features(parts: list, before=None):
    """(owner, bucket) of every feature of some ``(owner, bytes)`` parts, and
    the hash of the last part's last word.  ``before``: that of the word that
    stands before the first part in the same text."""
    joined = b" " + b" ".join(p for _, p in parts) + b" " * max(GRAMS)
    buf = np.frombuffer(joined, np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    lengths = np.array([len(p) + 1 for _, p in parts])
    owner_of_part = np.array([i for i, _ in parts])
    part_ends = np.cumsum(lengths) + 1
    c = np.where(blank, np.uint8(32), buf).astype(np.uint64)
    solid = ~blank
    n = len(buf)
    at, got = [], []
    for size in GRAMS:
        m = n - size + 1
        ok = solid[1 : m + 1].copy()
        for k in range(2, size - 1):
            ok &= solid[k : m + k]
        pos = np.flatnonzero(ok)
        h = np.zeros(len(pos), np.uint64)
        for k in range(size):
            h = h * BASE + c[pos + k]
        at.append(pos + 1)
        got.append(bucket(h, size))
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    if len(start):
        pw = powers(int(BASE), n)
        total = np.concatenate([[np.uint64(0)], np.cumsum(c * pw, dtype=np.uint64)])
        h = (total[end] - total[start]) * powers(inverse(int(BASE)), n)[start]
        at.append(start)
        got.append(bucket(h, 1))
        part = np.searchsorted(part_ends, start, side="right")
        same = np.concatenate([[part[0] == 0 and h[0] == before], (h[1:] == h[:-1]) & (part[1:] == part[:-1])])
        again = np.flatnonzero(same)
        at.append(start[again])
        got.append(np.full(len(again), AGAIN, np.int64))
        before = before if part[-1] == 0 else None
        before = h[-1] if part[-1] == len(parts) - 1 else before
    before = before if len(parts) == 1 or len(start) and part[-1] == len(parts) - 1 else None
    at, got = np.concatenate(at), np.concatenate(got)
    return owner_of_part[np.searchsorted(part_ends, at, side="right")], got, before


def text_bytes(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def counts(text: bytes):
    """Distinct buckets of a whole text and how often each occurs."""
    total: dict = {}
    one = None
    for _, found in all_features([text]):
        got = np.unique(found, return_counts=True)
        if one is None:
            one = got
            continue
        total = total or dict(zip(*(x.tolist() for x in one)))
        for k, v in zip(*(x.tolist() for x in got)):
            total[k] = total.get(k, 0) + v
    if total:
        keys = np.array(sorted(total), np.int64)
        return keys, np.array([total[k] for k in keys.tolist()])
    return one


def sample(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> DataFrame:
    """Feature counts of labelled rows of the learning folds, in one order:
    at most ``rows`` of them, and at most ``size`` bytes of counts."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null")
        .select("doc_id", F.col("quality").cast("int").alias("y"))
        .filter(fold(F.col("doc_id"), 5) != 0)
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    keyed = texts.select(F.xxhash64("doc_id").alias("k"), text_key(F.col("text")).alias("k2"), "y", "text")
    # a text has three features a byte at most, and a count of six bytes for each bucket
    most = F.least(F.octet_length("text").cast("long") * 3, F.lit(BUCKETS)) * 6
    few = keyed.select("k", "k2", "y", most.alias("most")).orderBy("k", "k2", "y").limit(rows)
    before = F.sum("most").over(Window.orderBy("k", "k2", "y").rowsBetween(Window.unboundedPreceding, 0))
    few = few.withColumn("before", before).filter(F.col("before") <= size).select("k", "k2", "y").distinct()
    schema = "k long, k2 long, y int, f binary, n binary"

    def run(batches):
        for batch in batches:
            for i, t in enumerate(text_bytes(batch.column("text"))):
                f, n = counts(t)
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [row.column("k"), row.column("k2"), row.column("y"),
                     pa.array([f.astype(np.uint16).tobytes()], pa.binary()), pa.array([n.astype(np.uint32).tobytes()], pa.binary())],
                    names=["k", "k2", "y", "f", "n"],
                )

    return keyed.join(F.broadcast(few), ["k", "k2", "y"], "left_semi").mapInArrow(run, schema).orderBy("k", "k2", "y").limit(rows)


def train(rows, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7):
    """``(label, buckets, counts)`` rows -> (logit difference of each bucket's
    vector, bias difference); plain SGD, one text at a time."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out = rng.uniform(-1 / DIM, 1 / DIM, (2, DIM))
    bias = np.zeros(2)
    data = [(y, f, (n / n.sum()).astype(np.float32)) for y, f, n in rows if len(f)]
    steps, done = epochs * len(data), 0
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            y, f, w = data[i]
            lr = rate * (1 - done / steps)
            done += 1
            h = w @ emb[f]
            z = out @ h + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y] -= 1
            dh = out.T @ g
            out -= lr * np.outer(g, h)
            bias -= lr * 0.1 * g
            # features share the step by their weight, at least the mean feature's part
            emb[f] -= lr * (w / w.max())[:, None] * dh
    return (emb @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES):
    """The model, trained by one task on the bounded sample; the driver gets
    one weight a bucket."""

    def run(batches):
        data = []
        for batch in batches:
            for y, f, n in zip(*(batch.column(c).to_pylist() for c in ("y", "f", "n"))):
                data.append((min(1, max(0, y)), np.frombuffer(f, np.uint16), np.frombuffer(n, np.uint32)))
        if data:
            weight, bias = train(data)
            yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()], pa.binary()), pa.array([bias])], names=["weight", "bias"])

    got = sample(docs, labels, rows, size).mapInArrow(run, "weight binary, bias double").collect()
    if not got:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(got[0]["weight"], np.float32), got[0]["bias"]


def scores(texts: list, weight: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for owner, got in all_features(texts):
        total += np.bincount(owner, weights=weight[got], minlength=len(texts))
        n += np.bincount(owner, minlength=len(texts))
    z = np.clip(total / np.maximum(n, 1) + bias, -60, 60)
    return 1 / (1 + np.exp(-z))


def score_texts(rows: DataFrame, model) -> DataFrame:
    """Adds ``score`` to ``rows(doc_id, held_out, text)``, which loses its text."""
    weight, bias = rows.sparkSession.sparkContext.broadcast(model[0]), model[1]
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            s = scores(text_bytes(batch.column("text")), weight.value, bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double")


def keep_good(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; same columns."""
    weight, bias = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            s = scores(text_bytes(batch.column(at)), weight.value, bias)
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    return score_texts(rows, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
