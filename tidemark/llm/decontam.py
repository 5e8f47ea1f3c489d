"""Operator 3: benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are reduced to lower-cased words (ASCII
punctuation and blanks count as one blank).  A place in a text matches an
item when it can be edited into the whole item with at most
``ERROR * length`` character edits.  An alignment with e edits shares at
least ``m - q + 1 - q e`` q-grams with an item of m characters and stays
within e + 1 neighbouring diagonals, so:

1. every q-gram of a text (q = 8 bytes) that an item has is counted in the
   two overlapping diagonal bands, each twice e + 1 wide, that hold it;
2. bands that reach the bound are kept as regions;
3. each region is verified by banded alignment: edit distance of the whole
   item against any part of the text on the region's diagonals alone, given
   up at the first row that is beyond the budget.

Items too short for that bound to ask for a shared q-gram are cut into e + 1
pieces, one of which every alignment leaves whole; the places of the pieces'
first bytes are the regions.  Items shorter than a q-gram are matched
exactly, between blanks, at all places that do not overlap.  The texts
are read in one pass per block of items; a block holds ``BLOCK_BYTES`` of
item text at most (or one item), is the only thing that is broadcast, and
usually holds the whole benchmark.  No shuffle.

Defined results: null or empty texts and items match nothing; repeated rows
give their matches each; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, ship

ship(__name__)

Q = 8
ERROR = 0.08
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 19
BITS = 22
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normal(text) -> bytes:
    return b" ".join((text or b"").translate(PLAIN).split())


def grams(buf: bytes) -> np.ndarray:
    """The 8 bytes at every position as one integer."""
    n = len(buf) - Q + 1
    out = np.empty(max(n, 0), np.uint64)
    for k in range(min(Q, max(n, 0))):
        view = np.frombuffer(buf, "<u8", offset=k, count=(len(buf) - k) // 8)
        out[k::8] = view[: len(out[k::8])]
    return out


def slot(g: np.ndarray) -> np.ndarray:
    return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


class Items:
    """An index of the q-grams of some benchmark items."""

    def __init__(self, rows: list, error: float):
        self.ids = [i for i, _ in rows]
        self.text = [t for _, t in rows]
        m = np.array([len(t) for t in self.text])
        self.edits = (error * m).astype(int)
        self.least = m - Q + 1 - Q * self.edits
        self.short = [k for k, t in enumerate(self.text) if len(t) < Q]
        self.pieces = self.cut([k for k, t in enumerate(self.text) if len(t) >= Q and self.least[k] < 1])
        parts = [(grams(t), k) for k, t in enumerate(self.text) if len(t) >= Q and self.least[k] >= 1]
        g = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(p), k) for p, k in parts]) if parts else np.zeros(0, np.int64)
        at = np.concatenate([np.arange(len(p)) for p, _ in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(g, kind="stable")
        g, self.item, self.at = g[order], item[order].astype(np.int64), at[order].astype(np.int64)
        self.gram, self.first, self.count = np.unique(g, return_index=True, return_counts=True)
        self.flag = np.zeros(1 << BITS, bool)
        self.flag[slot(self.gram)] = True

    def cut(self, some: list) -> dict:
        """Length -> first bytes of pieces -> (item, offset)s, for items that may share no q-gram."""
        out = {}
        for k in some:
            t, n = self.text[k], int(self.edits[k]) + 1
            for i in range(n):
                a, b = len(t) * i // n, len(t) * (i + 1) // n
                size = min(b - a, Q)
                key = int.from_bytes(t[a : a + size], "little")
                out.setdefault(size, {}).setdefault(key, []).append((k, a))
        return out

    def piece_regions(self, g: np.ndarray):
        """Regions around the places of pieces."""
        found = set()
        for size, keys in self.pieces.items():
            low = g & np.uint64((1 << 8 * size) - 1)
            known = np.array(sorted(keys), np.uint64)
            at = np.minimum(np.searchsorted(known, low), len(known) - 1)
            for pos in np.flatnonzero(known[at] == low).tolist():
                for k, offset in keys[int(low[pos])]:
                    found.add((k, pos - offset))
        return [(k, d - int(self.edits[k]), 2 * int(self.edits[k]) + 1) for k, d in sorted(found)]

    def regions(self, buf: bytes):
        """(item, lowest diagonal, width of the band) of the bands that reach the bound."""
        g = grams(buf)
        return (self.piece_regions(g) if self.pieces and len(g) else []) + self.gram_regions(buf, g)

    def gram_regions(self, buf: bytes, g: np.ndarray) -> list:
        if not len(g) or not len(self.gram):
            return []
        pos = np.flatnonzero(self.flag[slot(g)])
        if not len(pos):
            return []
        g = g[pos]
        k = np.minimum(np.searchsorted(self.gram, g), len(self.gram) - 1)
        hit = self.gram[k] == g
        pos, k = pos[hit], k[hit]
        n = self.count[k]
        start = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        occ = start + np.arange(n.sum())
        item = self.item[occ]
        diag = np.repeat(pos, n) - self.at[occ]
        wide = self.edits[item] + 1
        band = diag // wide
        big = len(buf) + 2  # bands are numbered from -1 - length of an item
        base = band + big
        key = np.concatenate([item * (4 * big) + base, item * (4 * big) + base - 1])
        key, votes = np.unique(key, return_counts=True)
        item, band = key // (4 * big), key % (4 * big) - big
        ok = votes >= self.least[item]
        item, band = item[ok], band[ok]
        return list(zip(item.tolist(), (band * (self.edits[item] + 1)).tolist(), (2 * (self.edits[item] + 1)).tolist()))


def align(item: bytes, text: bytes, low: int, width: int, most: int):
    """Fewest edits, ``most`` at the most, that turn a part of ``text`` into
    ``item`` on the diagonals ``low`` to ``low + width - 1`` (place in the text
    less place in the item): (edits, start, end), or None.  Only the band is
    filled, row by row, up to the first row that is beyond ``most`` throughout."""
    m = len(item)
    at = text.find(item, max(low, 0), max(low + width - 1 + m, 0))
    if at >= 0:
        return 0, at, at + m
    # the characters that the band meets; None of them, and no place, beyond the text's ends
    far = m + width + 1
    first, last = max(low, 0), min(max(low + m + width, 0), len(text))
    near = np.full(m + width, 256, np.int16)
    if first < last:
        near[first - low : last - low] = np.frombuffer(text, np.uint8, last - first, first)
    chars = np.frombuffer(item, np.uint8)
    step = np.arange(width)
    bound = np.full(m + width + 1, far)
    bound[max(0, -low) : max(0, len(text) - low + 1)] = 0

    def below(row, i):
        """Row i + 1 from row i: a character each, or one of the item alone, then of the text alone."""
        new = row + (near[i : i + width] != chars[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        return np.maximum(np.minimum.accumulate(new - step) + step, bound[i + 1 : i + 1 + width])

    def above(row, i):
        """Row i from row i + 1, for the way back."""
        new = row + (near[i : i + width] != chars[i])
        new[1:] = np.minimum(new[1:], row[:-1] + 1)
        return np.maximum(np.minimum.accumulate((new + step)[::-1])[::-1] - step, bound[i : i + width])

    row = bound[:width].copy()
    for i in range(m):
        row = below(row, i)
        if row.min() > most:
            return None
    end = int(row.argmin())
    edits = int(row[end])
    row = np.where(step <= end, end - step, far)
    for i in range(m - 1, -1, -1):
        row = above(row, i)
    start = int(np.flatnonzero(row == edits)[-1])
    return edits, low + start, low + m + end


def matches(items: Items, docs: list):
    """(doc number, item number, start, end, edits) over normalised texts."""
    gap = b"\x00" * Q
    buf, begin = bytearray(gap), []
    for t in docs:
        begin.append(len(buf))
        buf += t + gap
    buf = bytes(buf)
    begin, best = np.array(begin), {}
    for item, low, width in items.regions(buf):
        m, e = len(items.text[item]), int(items.edits[item])
        # the band fixes where the item's first characters can be
        d = int(np.searchsorted(begin, low + (width + m) // 2, side="right")) - 1
        if d < 0:
            continue
        place = align(items.text[item], docs[d], int(low - begin[d]), width, e)
        if place:
            edits, s, t = place
            here = best.setdefault((d, item), [])
            for x in here:  # overlapping bands find the same place
                if s < x[1] and x[0] < t:
                    if edits < x[2]:
                        x[:] = [s, t, edits]
                    break
            else:
                here.append([s, t, edits])
    for k in items.short:
        needle = b" " + items.text[k] + b" "
        for d, t in enumerate(docs):
            padded = b" " + t + b" "
            at = padded.find(needle)
            while at >= 0:
                best.setdefault((d, k), []).append([at, at + len(items.text[k]), 0])
                at = padded.find(needle, at + len(items.text[k]) + 1)
    for (d, item), places in sorted(best.items()):
        for s, t, e in places:
            yield d, item, s, t, e


def batches_of(texts: list):
    """Normalised texts, about ``CHUNK`` bytes at a time, with their row numbers."""
    rows, got, n = [], [], 0
    for i, t in enumerate(texts):
        t = normal(t)
        if t:
            rows.append(i)
            got.append(t)
            n += len(t)
        if n >= CHUNK:
            yield rows, got
            rows, got, n = [], [], 0
    if got:
        yield rows, got


def text_bytes(column) -> list:
    return column.cast(pa.binary()).to_pylist()


def item_blocks(benchmark: DataFrame):
    """Normalised benchmark items, at most ``BLOCK_BYTES`` of text each."""
    items = benchmark.filter("text is not null").select("item_id", F.col("text").cast("binary").alias("t"))
    total = items.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-2 * total // BLOCK_BYTES))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = [(r["item_id"], t) for r in part.orderBy("item_id", "t").toLocalIterator() if (t := normal(bytes(r["t"])))]
        if rows:
            yield rows


def find_matches(docs: DataFrame, benchmark: DataFrame, error: float = ERROR) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: places in the normalised
    texts (bytes, end exclusive) that match a whole benchmark item."""
    spark = docs.sparkSession
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type}, start int, end int, edits int"
    out = spark.createDataFrame([], schema)
    texts = docs.select("doc_id", "text")
    from pyspark.sql.pandas.types import to_arrow_type

    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = Items(shared.value, error)
            for batch in batches:
                for rows, got in batches_of(text_bytes(batch.column("text"))):
                    hits = list(matches(items, got))
                    if hits:
                        d, k, s, t, e = zip(*hits)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("doc_id").take(pa.array([rows[x] for x in d])), pa.array([items.ids[x] for x in k], item_arrow),
                                pa.array(s, pa.int32()), pa.array(t, pa.int32()), pa.array(e, pa.int32()),
                            ],
                            names=["doc_id", "item_id", "start", "end", "edits"],
                        )

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` without any match; same columns."""
    at = docs.columns.index("text")
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = Items(shared.value, error)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for rows, got in batches_of(text_bytes(batch.column(at))):
                    for d, *_ in matches(items, got):
                        clean[rows[d]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
