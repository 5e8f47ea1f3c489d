"""Operator 9: WARC derivative builder.

``derive`` turns response records into two linked records each:

* ``metadata``: ``application/warc-fields`` with the source's HTTP headers,
  the page title, language and outgoing links (whole, in order);
* ``conversion``: the page's plain text, ``text/plain``.

Both carry ``WARC-Refers-To`` (the response's record id),
``WARC-Refers-To-Target-URI`` / ``-Date``, a block digest of their own and
the payload digest of the source.  Record ids are name-based, so a re-run
after a lost executor writes the same records.  Work is one pass over the
responses, a record at a time: no shuffle and no state.

Defined results: null html counts as an empty page, null url as an empty
target; each input row gives its records, repeated rows the same records
again; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
import uuid
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, ship

ship(__name__)

DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122 name space for URLs

HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|svg)\b", re.I)
CLOSE = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template", "svg")}
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    r"h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>",
    re.I,
)
TAG = re.compile(r"<[A-Za-z/!?][^>]*>")
OPEN = re.compile(r"<([A-Za-z][^\s/>]*)([^>]*)>")  # tags do not overlap, so a scan is linear
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
TITLE_END = re.compile(r"</title\s*>", re.I)
BLANKS = re.compile(r"[ \t\r\f\v ]+")
LINES = re.compile(r" ?\n[ \n]*")

RECORD_SCHEMA = (
    "warc_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, payload_digest string, "
    "source_headers string, header string, block string"
)


def sha1(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(parts))}>"


def one_line(s: str) -> str:
    return " ".join(s.split())


def shown(page: str) -> str:
    """The page without comments and elements that are not shown.  What is
    not closed goes to the page's end if it is a comment, script or style;
    of others only the tag is left to be removed."""
    out, at, look, unclosed, last = [], 0, 0, set(), page.rfind(">")
    while m := HIDDEN.search(page, look):
        name, end = (m.group(1) or "").lower(), -1
        if not name:
            k = page.find("-->", m.end())
            end = k + 3 if k >= 0 else len(page)
        elif name == "svg" and m.end() <= last and page[(k := page.find(">", m.end())) - 1] == "/":
            end = k + 1
        elif name not in unclosed and (c := CLOSE[name].search(page, m.end())):
            end = c.end()
        elif name in ("script", "style"):
            end = len(page)
        if end < 0:
            unclosed.add(name)  # nor is any after it
            look = m.end()
            continue
        out += [page[at : m.start()], " "]
        at = look = end
    return "".join(out) + page[at:]


def plain_text(page: str) -> str:
    page = shown(page)
    # behind the last > there is no tag, and looking for one would never end early
    cut = page.rfind(">") + 1
    page = TAG.sub("", BLOCK.sub("\n", page[:cut])) + page[cut:]
    page = BLANKS.sub(" ", html_lib.unescape(page))
    return LINES.sub("\n", page).strip()


def fields(pairs) -> str:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs)


def record(kind, uri, date, ctype, block, refers_to, payload_digest, http):
    body = block.encode("utf-8", "replace")
    rid, digest = record_id(kind, refers_to, sha1(body)), sha1(body)
    head = "WARC/1.1\r\n" + fields(
        [
            ("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", one_line(uri)),
            ("WARC-Refers-To", refers_to), ("WARC-Refers-To-Target-URI", one_line(uri)), ("WARC-Refers-To-Date", date),
            ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest),
            ("Content-Type", ctype), ("Content-Length", str(len(body))),
        ]
    )
    return (kind, rid, refers_to, uri, date, ctype, len(body), digest, payload_digest, http, head, block)


def attribute(text: str, name: str):
    """The value of a tag's first attribute of this name, or None."""
    for m in ATTRIBUTE.finditer(text):
        if m[1].lower() == name:
            return html_lib.unescape(m[2] or m[3] or m[4] or "")
    return None


def described(page: str):
    """Title, language and links of a page without its hidden parts."""
    title, lang, links = None, "", []
    end = page.rfind(">") + 1
    for m in OPEN.finditer(page, 0, end):
        name = m[1].lower()
        if name == "a" and (href := attribute(m[2], "href")) is not None:
            links.append(one_line(href))
        elif name == "html" and not lang:
            lang = (attribute(m[2], "lang") or "").strip()
        elif name == "title" and title is None:
            close = TITLE_END.search(page, m.end())
            title = one_line(html_lib.unescape(page[m.end() : close.start()])) if close else ""
    return title or "", lang, links


def derivatives(rid, uri, date, http, payload):
    """The metadata and the conversion record of one response."""
    digest = sha1(payload.encode("utf-8", "replace"))
    title, lang, links = described(shown(payload))
    meta = fields(
        [("source-header", h) for h in http.split("\r\n") if h]
        + [("title", title), ("language", lang)]
        + [("outlink", x) for x in links]
    )
    return [
        record("metadata", uri, date, "application/warc-fields", meta, rid, digest, http),
        record("conversion", uri, date, "text/plain; charset=utf-8", plain_text(payload), rid, digest, http),
    ]


def derive(responses: DataFrame) -> DataFrame:
    """``responses(key, record_id, target_uri, date, http_headers, payload)``
    -> two rows per response: ``key`` and the columns of ``RECORD_SCHEMA``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    responses = responses.select("key", "record_id", "target_uri", "date", "http_headers", "payload")
    key_type = responses.schema["key"].dataType.simpleString()
    schema = f"key {key_type}, {RECORD_SCHEMA}"
    arrow = to_arrow_schema(responses.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                args = (r["record_id"] or "", r["target_uri"] or "", r["date"] or "", r["http_headers"] or "", r["payload"] or "")
                rows += [(r["key"], *x) for x in derivatives(*args)]
                if len(rows) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    return responses.mapInArrow(run, schema)


def page_responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages as response records: the page's bytes under plain HTTP headers."""
    body = F.coalesce("html", F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n"),
    )
    uri = F.coalesce("url", F.lit(""))
    # name-based id of the response: a hash of its address, page and content
    h = F.sha2(F.concat_ws("\u0000", F.col("page_id").cast("string"), uri, body), 256)
    rid = F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3),
        F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )
    return pages.select(
        F.col("page_id").alias("key"), rid.alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("date"),
        http.alias("http_headers"), body.alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as ``.warc`` files: each is header, blank line, block and
    two line ends, which the text writer adds as its line separator."""
    whole = F.concat("header", F.lit("\r\n"), "block")
    records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(page_responses(read(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")
