"""Operator 4: n-gram Jaccard join with signature trees.

Two documents link when their sets of distinct 5-word shingles have a
Jaccard similarity of at least 0.75; the result is the connected components
of all links, exactly.  Equal sets are one node from the start.

Inside a block of sets, :func:`candidates` joins by signature trees: a
node holds the OR of its sets' token bitmaps, their range of sizes and the
largest number of tokens that share a bit with another of the same set.  A
pair of nodes is dropped when its sizes are too far apart, or when the bits
that both hold, plus the tokens hidden behind shared bits, cannot reach the
overlap that 0.75 asks for; the pairs left at the leaves are counted exactly.

Blocks are chosen so that no link is lost:

1. sets with the same minimum of a hash (four hashes) are joined first, which
   unites nearly all groups of copies; blocks of one smallest node are one, a
   block of many sets is divided, and its smallest node goes to every part;
2. every set then shows its prefix: the first ``n - ceil(0.75 n) + 1`` tokens
   in one order of all tokens.  Linked sets share a token of their prefixes,
   whatever the order, so a token whose sets all lie in one component
   settles nothing and is dropped.  The first token that two linked sets share
   has all others behind it in both, so its place in a set bounds the size of
   the sets that may link there (:func:`reach`): a set stays at a token only if
   one of another component may link with it, else the sets that meet by chance,
   which are more than in proportion to the input, would all be sent.  Those that stay are
   joined by their bitmaps, large blocks in pairs of parts, and whole sets are
   read only for the pairs that the trees leave.

The order puts tokens that are frequent, counted in all texts by their leading
bits, last, which only saves work.  Texts move only for the sets that share a block with another.

Defined results: null and empty texts have an empty set, link with nothing
and are their own component; under five words the whole sequence is one
shingle; repeated rows get the same component; a null doc_id takes part, and
a component's id is its smallest non-null doc_id; an empty table gives no
rows; extra columns are ignored.  Sets are compared by 64-bit token hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, components, materialise, read, ship, text_key

ship(__name__)

SHINGLE = 5
NUM, DEN = 75, 100
SAMPLE_DOCS = 20_000  # a frequent token stands in SAMPLE_SEEN of so many texts; all texts are counted
SAMPLE_SEEN = 2
FREQUENT_BITS = 24
COUNT_ROWS = 1 << 14
PART = 400  # sets in a part of a large block
BROADCAST_ROWS = 400_000
FANOUT = 8
SET_ROWS = 500  # rows that a task joins at a time, with whole sets
BITMAP_ROWS = 500  # and with bitmaps
WIDE, NARROW = 8, 2  # bits of a bitmap for a token; narrow ones suffice where no tree has many sets
NARROW_BLOCK = 32  # sets
BANDS = 8  # bands of set sizes in a doubling, where a token's sets look for others
MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
SEEDS = [np.uint64(x) for x in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles (bytes)."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    word = xxhash.xxh3_64_intdigest
    w = np.fromiter((word(x) for x in words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    if n < 1:
        return mix((w * np.array(MULT[: len(w)])).sum(keepdims=True) + np.uint64(len(w)))
    h = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        h += w[i : i + n] * MULT[i]
    return np.unique(mix(h))


def fingerprint(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def prefix(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    n = len(tokens)
    late = frequent[(tokens >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64)]
    return np.concatenate([tokens[~late], tokens[late]])[: n - -(-NUM * n // DEN) + 1]


def enough(common: int, a: int, b: int) -> bool:
    return DEN * common >= NUM * (a + b - common)


def needed(a: int, b: int) -> int:
    """Smallest overlap of sets of these sizes that makes a link."""
    return -(-NUM * (a + b) // (NUM + DEN))


class Node:
    """A signature tree node; ``row`` at a leaf, ``group`` where all rows below have one."""

    __slots__ = ("bits", "lo", "hi", "hidden", "group", "children", "row")

    def __init__(self, bits, lo, hi, hidden, group, children=None, row=-1):
        self.bits, self.lo, self.hi, self.hidden = bits, lo, hi, hidden
        self.group, self.children, self.row = group, children, row


def width_of(n: int, per: int = WIDE) -> int:
    """Bits in the token bitmap of a set: a power of two, ``per`` times its size or more."""
    return 1 << max(6, min(18, (per * n - 1).bit_length()))


def bitmap(tokens: np.ndarray, per: int = WIDE) -> bytes:
    got = np.zeros(width_of(len(tokens), per), np.uint8)
    got[(tokens % np.uint64(len(got))).astype(np.int64)] = 1
    return np.packbits(got).tobytes()


def folded(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


def signature_tree(rows: list, size: list, bits: list, group: list, width: int, per: int = WIDE) -> Node:
    """Tree over ``rows``, whose bitmaps are folded to ``width``."""
    level = []
    for r in sorted(rows, key=lambda r: (size[r], group[r])):
        b = folded(bits[r], width_of(size[r], per), width)
        level.append(Node(b, size[r], size[r], size[r] - b.bit_count(), group[r], None, r))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FANOUT):
            part, b = level[i : i + FANOUT], 0
            for x in part:
                b |= x.bits
            one = part[0].group if all(x.group == part[0].group for x in part) else None
            above.append(Node(b, part[0].lo, max(x.hi for x in part), max(x.hidden for x in part), one, part))
        level = above
    return level[0]


def may_link(a: Node, b: Node) -> bool:
    if a.group is not None and a.group == b.group:
        return False  # one component already
    if DEN * a.hi < NUM * b.lo or DEN * b.hi < NUM * a.lo:
        return False
    most = min((a.bits & b.bits).bit_count() + min(a.hidden, b.hidden), a.hi, b.hi)
    return most >= needed(a.lo, b.lo)


def traverse(a: Node, b: Node):
    """Pairs of leaf rows below two nodes (or one, twice) that may link."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if a is b:
            if a.children is not None and a.group is None:
                kids = a.children
                todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif may_link(a, b):
            if a.children is None and b.children is None:
                yield a.row, b.row
            elif b.children is None or (a.children is not None and a.hi - a.lo >= b.hi - b.lo):
                todo += [(x, b) for x in a.children]
            else:
                todo += [(a, x) for x in b.children]


def candidates(size: list, bits: list, group: list, per: int = WIDE):
    """Pairs of rows of different groups that the signature trees cannot rule
    out.  Sets of one bitmap width share a tree; linked sets are of the same
    or of neighbouring widths, and the wider one's tree is folded."""
    by_width: dict = {}
    for r, n in enumerate(size):
        by_width.setdefault(width_of(n, per), []).append(r)
    for w, rows in by_width.items():
        tree = signature_tree(rows, size, bits, group, w, per)
        yield from traverse(tree, tree)
        if 2 * w in by_width:
            yield from traverse(tree, signature_tree(by_width[2 * w], size, bits, group, w, per))


def as_int(bits: bytes) -> int:
    return int.from_bytes(bits, "big")


def tree_links(sets: list, group: list) -> list:
    """Pairs of rows that link, enough of them to unite what links unite.

    ``group``: rows with equal values are known to be in one component.
    """
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    links = []
    for i, j in candidates([len(s) for s in sets], [as_int(bitmap(s)) for s in sets], group):
        a, b = find(group[i]), find(group[j])
        if a != b and enough(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), len(sets[i]), len(sets[j])):
            parent[max(a, b)] = min(a, b)
            links.append((i, j))
    return links


def text_bytes(column) -> list:
    return column.cast(pa.binary()).to_pylist()


def frequent_tokens(docs: DataFrame, rows: int) -> np.ndarray:
    """Flags by a token's leading bits: in ``SAMPLE_SEEN`` of ``SAMPLE_DOCS``
    texts (two at least) more than leading bits are on average.  Tokens of all
    texts are counted, in every task by itself; the counts meet by chunks of
    ``COUNT_ROWS`` leading bits, so no task holds more than one chunk of each
    other, and only flags reach the driver."""
    least = max(2, SAMPLE_SEEN * rows // SAMPLE_DOCS)

    def count(batches):
        seen = None
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                if len(t := shingles(text)):
                    seen = np.zeros(1 << FREQUENT_BITS, np.uint32) if seen is None else seen
                    np.add.at(seen, (t >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64), np.uint32(1))
        if seen is None:
            return
        for k in range(0, len(seen), COUNT_ROWS):  # chunk by chunk: no copy of all counts
            part = seen[k : k + COUNT_ROWS]
            at = np.flatnonzero(part)
            if len(at):
                x = part[at]
                i, n = at.astype(np.uint16).tobytes(), (x.astype(np.uint8) if x.max() < 256 else x).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k // COUNT_ROWS], pa.int32()), pa.array([i], pa.binary()), pa.array([n], pa.binary())], names=["chunk", "i", "n"])

    def often(t: pa.Table) -> pa.Table:
        total = np.zeros(COUNT_ROWS, np.int64)
        for i, n in zip(t.column("i").to_pylist(), t.column("n").to_pylist()):
            i = np.frombuffer(i, np.uint16)
            total[i] += np.frombuffer(n, np.uint8 if len(n) == len(i) else np.uint32)
        bits = np.packbits(total - int(total.mean()) >= least).tobytes()
        return pa.table({"chunk": t.column("chunk").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    counts = docs.select("text").mapInArrow(count, "chunk int, i binary, n binary")
    got = counts.groupBy("chunk").applyInArrow(often, "chunk int, bits binary").toArrow().to_pylist()
    flags = np.zeros((-(-(1 << FREQUENT_BITS) // COUNT_ROWS), COUNT_ROWS), bool)
    for row in got:
        flags[row["chunk"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).view(bool)
    return flags.ravel()


def describe(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``(rid, doc_id, tk, n, fp, low, prefix, bits, few)`` for every row; ``few`` is the narrow bitmap."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        late = np.unpackbits(flags.value).view(bool)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                n, fp, low, pre, bits, few = [], [], [], [], [], []
                for text in text_bytes(batch.column("text")):
                    t = shingles(text)
                    n.append(len(t))
                    if not len(t):
                        for x in (fp, low, pre, bits, few):
                            x.append(None)
                        continue
                    fp.append(fingerprint(t))
                    low.append([int(mix(t ^ s).min().astype(np.int64)) for s in SEEDS])
                    pre.append(prefix(t, late).view(np.int64))
                    bits.append(bitmap(t))
                    few.append(bitmap(t, NARROW))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid"), batch.column("doc_id"), batch.column("tk"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                        pa.array(low, pa.list_(pa.int64())), pa.array(pre, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                        pa.array(few, pa.binary()),
                    ],
                    names=["rid", "doc_id", "tk", "n", "fp", "low", "prefix", "bits", "few"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", text_key(F.col("text")).alias("tk"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, f"rid long, doc_id {kind}, tk long, n long, fp binary, low array<long>, prefix array<long>, bits binary, few binary")


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The whole sets of ``wanted(doc_id, fp, node, ...)``: ``(node, ..., tokens)``."""
    wanted = materialise(wanted, "wanted")
    w = broadcast_if_small(wanted.withColumnRenamed("doc_id", "wd"), wanted.count(), BROADCAST_ROWS)
    kept = [f for f in wanted.schema.fields if f.name not in ("doc_id", "fp")]
    names = [f.name for f in kept]
    texts = docs.select("doc_id", "text").join(w, F.col("doc_id").eqNullSafe(F.col("wd"))).select(*names, "fp", "text")

    def run(batches):
        for batch in batches:
            for i, (fp, text) in enumerate(zip(batch.column("fp").to_pylist(), text_bytes(batch.column("text")))):
                t = shingles(text)
                if len(t) and fingerprint(t) == fp:  # a doc_id may have other texts
                    row = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays([*(row.column(x) for x in names), pa.array([t.tobytes()], pa.binary())], names=[*names, "tokens"])

    return texts.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", tokens binary")


def buckets(blocks: DataFrame, rows: int) -> DataFrame:
    """Blocks, a few at a time: adds ``bucket``, about ``rows`` rows each."""
    n = max(1, -(-blocks.count() // rows))
    return blocks.withColumn("bucket", F.pmod(F.xxhash64("block", "part"), F.lit(n)).cast("int"))


def block_groups(f: pd.DataFrame):
    """The blocks of a bucket, each row's node once."""
    for _, g in f.drop_duplicates(["block", "part", "node"]).sort_values(["block", "part", "node"]).groupby(["block", "part"], sort=False):
        if len(g) > 1:
            yield g


def join_sets(docs: DataFrame, blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` inside blocks ``(block, part, node)``, which get their
    whole sets: each from its text to the buckets of its blocks."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for g in block_groups(f):
            nodes = g["node"].tolist()
            out += [(nodes[i], nodes[j]) for i, j in tree_links([np.frombuffer(x, np.uint64) for x in g["tokens"]], nodes)]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    places = buckets(blocks, SET_ROWS).groupBy("node").agg(F.collect_list(F.struct("bucket", "block", "part")).alias("places"))
    sets = fetch(docs, places.join(nodes.select("node", "doc_id", "fp"), "node").select("doc_id", "fp", "node", "places"))
    rows = sets.select("node", "tokens", F.explode("places").alias("p")).select("p.bucket", "p.block", "p.part", "node", "tokens")
    return rows.groupBy("bucket").applyInPandas(run, "a long, b long")


def join_bitmaps(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components inside blocks ``(block, part,
    node, comp, size)`` that the signature trees cannot rule out; blocks of up
    to ``NARROW_BLOCK`` sets get narrow bitmaps."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        out = set()
        for g in block_groups(f):
            nodes = g["node"].tolist()
            per = NARROW if g["size"].iloc[0] <= NARROW_BLOCK else WIDE
            for i, j in candidates(g["n"].tolist(), [as_int(x) for x in g["bits"]], g["comp"].tolist(), per):
                out.add((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
        pairs = np.array(sorted(out), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    blocks = broadcast_if_small(buckets(blocks, BITMAP_ROWS), blocks.count(), BROADCAST_ROWS)
    bits = F.when(F.col("size") <= NARROW_BLOCK, F.col("few")).otherwise(F.col("bits"))
    rows = nodes.select("node", "n", "bits", "few").join(blocks, "node").select("bucket", "block", "part", "node", "comp", "size", "n", bits.alias("bits"))
    return rows.groupBy("bucket").applyInPandas(run, "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def reach(n: Column, place: Column) -> Column:
    """Size of the largest set that may link with one of ``n`` tokens if the
    first token that both hold has this place (from 0) in it: at most ``n -
    place`` tokens are common then.  Two sets may link where each one's size is
    within the other's reach.  Places are rounded down, to 16 or so in a prefix."""
    place = place - place % (F.lit(1) + F.floor(n / 64))
    return F.floor((NUM + DEN) * (n - place) / NUM) - n


def meetings(rows: DataFrame) -> DataFrame:
    """Blocks ``(block, node, comp)`` of the sets that may link at a token,
    from ``(node, root, t, shape)``, dealt by the token; ``shape`` holds size and reach."""
    c = F.coalesce("root", "node")
    size = lambda x: F.shiftright(x, 32)
    far = lambda x: F.col(x).bitwiseAND(F.lit((1 << 32) - 1))
    groups = rows.groupBy("t").agg(
        F.count(F.lit(1)).alias("size"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.min("shape").alias("x"), F.max("shape").alias("y")
    ).filter("lo < hi").filter((F.col("size") > 2) | ((size("x") <= far("y")) & (size("y") <= far("x"))))
    met = materialise(rows.join(groups.select("t"), "t").select("t", "node", c.alias("comp"), size("shape").alias("n"), far("shape").alias("far")), "met").repartition("t")
    # a token's sets are seen by bands of sizes, so no row holds all of them
    bands = met.groupBy("t", F.floor(BANDS * F.log2("n")).alias("band")).agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("n"), F.max("far").alias("far")
    ).groupBy("t").agg(F.collect_list(F.struct("lo", "hi", "n", "far")).alias("bands"))
    others = F.exists("bands", lambda b: ((b["lo"] != F.col("comp")) | (b["hi"] != F.col("comp"))) & (b["n"] <= F.col("far")) & (F.col("n") <= b["far"]))
    stay = materialise(met.join(bands, "t").filter(others).select("t", "node", "comp"), "stay")
    # tokens whose sets have the same smallest node are one block
    firsts = stay.groupBy("t").agg(F.min("node").alias("block"))
    return stay.join(firsts, "t").select("block", "node", "comp").distinct()


def links(docs: DataFrame, nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Component roots ``(node, root)`` of all nodes that link with another."""
    # 1. blocks by minimum hash
    keys = nodes.select("node", F.posexplode("low").alias("h", "m")).select("node", F.xxhash64("h", "m").alias("block"))
    firsts = keys.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first")).filter("size > 1")
    # blocks of the same smallest node are one
    inside = materialise(keys.join(firsts, "block").select(F.col("first").alias("block"), "node").distinct(), "inside")
    parts = F.ceil(F.col("size") / PART).cast("int")
    sizes = materialise(inside.groupBy("block").agg(F.count(F.lit(1)).alias("size")), "sizes")
    inside = inside.join(sizes, "block").select("block", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), "node")
    firsts = sizes.select("block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("block").alias("node"))
    blocks = materialise(inside.unionByName(firsts).distinct(), "blocks")
    first_links = materialise(join_sets(docs, blocks, nodes), "links")
    known = materialise(components(first_links), "known")

    # 2. tokens of prefixes that meet in more than one component
    comp = broadcast_if_small(known, known.count(), BROADCAST_ROWS)
    shape = F.col("n") * F.lit(1 << 32) + reach(F.col("n"), F.col("i"))
    rows = (
        prefixes.join(comp, "node", "left").select("node", "root", "n", F.posexplode("prefix").alias("i", "t"))
        .select("node", "root", "t", shape.alias("shape")).repartition("t")
    )
    meeting = materialise(meetings(rows), "meeting")
    sizes = materialise(meeting.groupBy("block").agg(F.count(F.lit(1)).alias("size")), "sizes")
    blocks = meeting.join(sizes, "block")
    # a block of many sets is joined in pairs of its parts, one group each
    p = F.greatest(F.lit(1), F.ceil(F.col("size") / PART)).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("p")).cast("int")
    pair = lambda x: F.least(x, F.col("mine")) * F.col("p") + F.greatest(x, F.col("mine"))
    blocks = blocks.withColumn("p", p).withColumn("mine", mine).select(
        "block", F.explode(F.transform(F.sequence(F.lit(0), F.col("p") - 1), pair)).alias("part"), "node", "comp", "size"
    )
    pairs = materialise(join_bitmaps(materialise(blocks, "blocks"), nodes), "pairs")
    some = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("doc_id", "fp", "node")
    sets = materialise(fetch(docs, some).dropDuplicates(["node"]), "tokens")
    second = verify(pairs, sets)
    return components(second.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, tk, n_shingles, root, component_id)`` for every row."""
    docs = docs.select("doc_id", "text")
    seen = materialise(describe(docs, frequent_tokens(docs, docs.count())), "sets")
    full = seen.filter("n > 0")
    same = materialise(full.groupBy("fp").agg(F.min("rid").alias("node"), F.count(F.lit(1)).alias("rows")), "same")
    copies = same.filter("rows > 1").select(F.col("fp").alias("cfp"), "node")
    # rows of a set that occurs once are their own node
    small = full.select("rid", "doc_id", "tk", "n", "fp").join(copies, F.col("fp") == F.col("cfp"), "left").select(
        "rid", "doc_id", "tk", "n", F.coalesce("node", "rid").alias("node")
    )
    small = materialise(small, "rows")
    others = small.filter("rid <> node").select("rid")
    firsts = full.join(broadcast_if_small(others, others.count(), BROADCAST_ROWS), "rid", "left_anti").withColumnRenamed("rid", "node")
    nodes = materialise(firsts.drop("prefix", "tk"), "nodes")
    roots = materialise(links(docs, nodes, firsts.select("node", "n", "prefix")), "roots")
    placed = materialise(
        small.join(roots, "node", "left").select("doc_id", "tk", "n", F.coalesce("root", "node").alias("root")), "placed"
    )
    first = materialise(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "first")
    out = placed.join(first, "root").select("doc_id", "tk", F.col("n").alias("n_shingles"), "root", "component_id")
    empty = seen.filter("n = 0").select(
        "doc_id", "tk", F.col("n").alias("n_shingles"), F.col("rid").alias("root"), F.col("doc_id").alias("component_id")
    )
    return out.unionByName(empty)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that with its smallest doc_id (nulls last,
    ties to the smaller text hash, then one of the equal rows); rows without
    words all stay.  Same columns."""
    rows = classes(docs).filter("n_shingles > 0").select(
        "root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk").alias("key")
    )
    rows = materialise(rows, "classes")
    best = rows.groupBy("root").agg(F.min("key").alias("best"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    marked = materialise(rows.join(materialise(best, "best"), "root").select(
        F.col("key.doc_id").alias("gid"), F.col("key.tk").alias("gtk"), (F.col("key") == F.col("best")).alias("stays")
    ), "marked")
    gone = materialise(marked.filter("not stays").select("gid", "gtk").distinct(), "gone")
    again = materialise(marked.filter("stays").groupBy("gid", "gtk").count().filter("count > 1").select("gid", "gtk"), "again")

    # the input goes through as one struct, so that none of its names can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = docs.select(row.alias("row"), "doc_id", "text")

    def match(keys):
        keys = broadcast_if_small(keys, keys.count(), BROADCAST_ROWS)
        return keys, F.col("doc_id").eqNullSafe(F.col("gid")) & (text_key(F.col("text")) == F.col("gtk"))

    kept = kept.join(*match(gone), "left_anti")
    if again.limit(1).count():  # rows that repeat the one that stays
        one = kept.join(*match(again), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(*match(again), "left_anti").unionByName(one)
    return kept.select("row.*")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: The links by brute force over shared shingles, for small tables.
OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
    ELSE list_transform(generate_series(1, len(a) - 4), lambda i: array_to_string(a[i:i + 4], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, len(g) AS n FROM s),
t AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.doc_id WHERE r.m < l.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2
"""
