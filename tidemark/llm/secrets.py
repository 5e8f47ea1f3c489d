"""Operator 13: secret scans with corpus-wide ownership frequency.

Every whole text is searched for candidates: the base kinds (assignments to
secret-sounding names, access keys, long hexadecimal runs), and the
method's own ones: tokens of known issuers, private key blocks, passwords in
addresses, and long runs that mix letters and digits (``bare``).  A candidate
is known by two hashes of its value.  Over the whole corpus the values are counted by
*distinct owners and distinct repositories* that hold them:

- a value of at least ``COPIED`` owners is widely copied, as examples and
  fixtures are: its places get the kind ``example``;
- a value of fewer owners that looks like a real credential (length, entropy,
  digits, no placeholder) is owner-specific: its places get the kind ``live``,
  wherever in the corpus it stands, also where nothing beside it names it.

A bare run counts only if the same value is also some other kind's candidate,
or if it mixes cases and digits and its entropy reaches ``BARE_BITS``.  Base spans always stay as they are.

Places are code points, end exclusive.  A kind's matches are leftmost and do
not overlap; failing matches are dropped without another try.  An
assignment's span is its whole match, its ``live`` or ``example`` span is the value.

How the work is spread: one pass finds the candidates, guarded by byte
searches over whole Arrow buffers, so only texts that hold something meet a
regular expression.  Counting shuffles (value, owner) and (value, repository)
pairs, made distinct map-side, so a value that a third of all rows hold is no
hot key; verdicts on values of many places (more than 1/``HOT`` of all, so at
most ``HOT`` values) go to every task, the others are joined by a shuffle.

Defined results: null text counts as empty; a null owner or repository is one
of its own; repeated rows get the same result each; rows with a null doc_id
take part; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, materialise, read, ship

ship(__name__)

COPIED = 3  # owners that make a value widely copied
LENGTH = 8  # of an assigned value
ACCESS, HEX, BARE = 16, 32, 20
BITS = 2.5  # entropy a character of a live-looking value
BARE_BITS = 4.0  # and of a run that nothing names
HOT = 1000
KINDS = ["assign", "access", "hex", "issuer", "key", "address", "bare", "live", "example"]
BASE = 3
NAMES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(rf"[0-9a-f]{{{HEX},}}")
# issuers' published token formats (fixed values)
ISSUERS = [b"ghp_", b"gho_", b"ghs_", b"github_pat_", b"glpat-", b"xoxb-", b"xoxp-", b"sk_live_", b"rk_live_", b"AIza", b"eyJ"]
ISSUER = re.compile(
    r"(?<![A-Za-z0-9_-])(?:gh[pos]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{20,}|xox[bp]-[A-Za-z0-9-]{20,}"
    r"|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
)
KEY_HEAD = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
ADDRESS = re.compile(r"://[^\s:/@]{1,200}:([^\s:/@]{8,200})@")
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{BARE},}}")
PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|dummy|your[_-]|xxxx|test|\.\.\.", re.I | re.A)
RUN_BYTES = np.zeros(256, bool)
RUN_BYTES[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", np.uint8)] = True
HEX_BYTES = np.zeros(256, bool)
HEX_BYTES[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def random_run(value: str) -> bool:
    """A run that is a credential although nothing names it."""
    mixed = any(c.islower() for c in value) and any(c.isupper() for c in value) and sum(c.isdigit() for c in value) >= 3
    return mixed and entropy(value) >= BARE_BITS


def looks_live(value: str) -> bool:
    return len(value) >= LENGTH and any(c.isdigit() for c in value) and entropy(value) >= BITS and not PLACEHOLDER.search(value)


def candidates(text: str) -> list:
    """``(kind, start, end, start of value, value)`` of every candidate of a text."""
    out = [(0, m.start(), m.end(), m.start(2), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LENGTH]
    out += [(1, m.start(), m.end(), m.start(), m[0]) for m in ACCESS_KEY.finditer(text) if len(m[0]) >= ACCESS]
    out += [(2, m.start(), m.end(), m.start(), m[0]) for m in HEX_RUN.finditer(text)]
    out += [(3, m.start(), m.end(), m.start(), m[0]) for m in ISSUER.finditer(text)]
    end = 0
    for m in KEY_HEAD.finditer(text):
        if m.start() < end:
            continue
        foot = text.find("-----END", m.end())
        if foot < 0:
            break
        close = text.find("-----", foot + 8)
        end = close + 5 if close > 0 else len(text)
        out.append((4, m.start(), end, m.start(), text[m.start() : end]))
    out += [(5, m.start(1), m.end(1), m.start(1), m[1]) for m in ADDRESS.finditer(text)]
    # a bare run overlaps no other candidate
    taken = sorted((a, b) for _, a, b, _, _ in out)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for m in RUN.finditer(text):
        x, k = m[0], bisect_left(starts, m.end())
        if (k == 0 or ends[k - 1] <= m.start()) and any(c.isdigit() for c in x) and any(c.isalpha() for c in x):
            out.append((6, m.start(), m.end(), m.start(), x))
    return out


def suspects(column) -> np.ndarray:
    """Rows of a text column (no nulls) that may hold a candidate: byte
    searches over the whole buffer."""
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    if raw is None or at[-1] == at[0]:
        return np.zeros(len(column), bool)
    raw = raw.to_pybytes()[at[0] : at[-1]]
    at = at - at[0]
    hit = np.zeros(len(column), bool)

    def mark(buffer: bytes, word: bytes) -> None:
        k = buffer.find(word)
        while k >= 0:
            row = int(np.searchsorted(at, k, side="right")) - 1
            hit[row] = True
            k = buffer.find(word, int(at[row + 1]))

    low = raw.lower()
    for w in NAMES:
        mark(low, w)
    for w in (b"AKIA", b"PRIVATE KEY", b"://", *ISSUERS):
        mark(raw, w)
    buf = np.frombuffer(raw, np.uint8)
    # of a run of HEX bytes every STEP-th is looked at, and all between two neighbours that fit
    step = HEX // 2
    some = HEX_BYTES[buf[::step]]
    near = np.flatnonzero(some[1:] & some[:-1]) * step
    if len(near):
        near = near[HEX_BYTES[buf[near[:, None] + np.arange(step)]].all(axis=1)]
        hit[np.searchsorted(at, near, side="right") - 1] = True
    # a bare run holds a digit: only the runs around digits are measured
    digit = np.flatnonzero((buf >= 48) & (buf <= 57))
    if len(digit):
        gap = np.concatenate([[-1], np.flatnonzero(~RUN_BYTES[buf]), [len(buf)]])
        k = np.searchsorted(gap, digit)
        digit = digit[gap[k] - gap[k - 1] > BARE]
        hit[np.searchsorted(at, digit, side="right") - 1] = True
    return hit


def scan(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """One row per text: base counts and digest, and its candidates
    (kind, start, end, at, h1, h2, looks, strong), h1 and h2 the value's hashes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    cand = "struct<kind:int,start:bigint,end:bigint,at:bigint,to:bigint,h1:bigint,h2:bigint,looks:boolean,strong:boolean>"
    cand_type = pa.struct([
        ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("at", pa.int64()), ("to", pa.int64()),
        ("h1", pa.int64()), ("h2", pa.int64()), ("looks", pa.bool_()), ("strong", pa.bool_()),
    ])
    none = hashlib.sha256(b"").hexdigest()

    def row(text: str):
        got, count, spans = [], [0] * BASE, []
        for k, a, b, at, value in candidates(text):
            digest = hashlib.blake2b(value.encode(), digest_size=16).digest()
            got.append({
                "kind": k, "start": a, "end": b, "at": at, "to": at + len(value),
                "h1": int.from_bytes(digest[:8], "big", signed=True), "h2": int.from_bytes(digest[8:], "big", signed=True),
                "looks": k == 4 or looks_live(value), "strong": k < 6 or random_run(value),
            })
            if k < BASE:
                count[k] += 1
                spans.append((a, k, b))
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        return count, hashlib.sha256(text.encode()).hexdigest(), got

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            hit = suspects(texts)
            rows = [row(texts[i].as_py()) if h else ([0] * BASE, none, []) for i, h in enumerate(hit.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("rid", "doc_id", "owner", "repo")]
                + [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(BASE)]
                + [pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(cand_type))],
                names=["rid", "doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "found"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", owner.cast("string").alias("owner"), repo.cast("string").alias("repo"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        run, f"rid long, doc_id {kind}, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, found array<{cand}>"
    )


def ownership(places: DataFrame) -> DataFrame:
    """``(h1, h2, owners, repos, places, live, copied)`` of every value of ``places``."""
    value = ["h1", "h2"]
    whole = places.groupBy(*value).agg(F.count(F.lit(1)).alias("places"), F.bool_or("strong").alias("strong"), F.bool_or("looks").alias("looks"))

    def distinct(column: str, name: str) -> DataFrame:
        each = places.groupBy(*value, column).agg(F.lit(1).alias("one"))
        return each.groupBy(*value).agg(F.count(F.lit(1)).alias(name))

    both = whole.join(distinct("owner", "owners"), value).join(distinct("repo", "repos"), value)
    copied = F.col("strong") & (F.col("owners") >= COPIED)
    live = F.col("strong") & F.col("looks") & (F.col("owners") < COPIED)
    return both.select(*value, "owners", "repos", "places", live.alias("live"), copied.alias("copied"))


def find(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """Base counts and digest of every text, and ``places``: all spans
    (start, kind, end) in order, ``live`` and ``example`` with them."""
    seen = materialise(scan(docs, owner, repo), "secrets")
    places = seen.filter(F.size("found") > 0).select("rid", "owner", "repo", F.explode("found").alias("x")).select("rid", "owner", "repo", "x.*")
    places = materialise(places, "places")
    n = places.count()
    verdict = materialise(ownership(places).filter("live or copied"), "verdicts")
    # values of many places are fewer than HOT, and no other value is a hot key
    hot = F.broadcast(verdict.filter(F.col("places") * HOT > n).select("h1", "h2", "live"))
    rest = verdict.filter(F.col("places") * HOT <= n).select("h1", "h2", "live")
    where = places.select("rid", "h1", "h2", "at", "to").join(hot, ["h1", "h2"], "left")
    judged = where.filter("live is not null").unionByName(where.filter("live is null").drop("live").join(rest, ["h1", "h2"]))
    kind = F.when(F.col("live"), KINDS.index("live")).otherwise(KINDS.index("example"))
    judged = judged.select("rid", F.struct(F.col("at").alias("start"), kind.alias("kind"), F.col("to").alias("end")).alias("s"))
    named = places.filter(F.col("kind") < KINDS.index("bare")).select("rid", F.struct("start", "kind", "end").alias("s"))
    by_text = judged.unionByName(named).groupBy("rid").agg(F.array_sort(F.collect_set("s")).alias("places"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return seen.drop("found").join(by_text, "rid", "left").withColumn("places", F.coalesce("places", empty))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its owner and its repository: the table names no other."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = find(docs, F.col("source"), F.col("source"))
    named = lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(F.transform("places", named), ",").alias("spans"),
        F.size(F.filter("places", lambda s: s["kind"] == KINDS.index("live"))).cast("long").alias("n_live"),
        F.size(F.filter("places", lambda s: s["kind"] == KINDS.index("example"))).cast("long").alias("n_example"),
    )
