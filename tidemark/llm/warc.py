"""WARC derivatives: response records become linked metadata and plain-text conversion records.

Both refer to their response by its record id, repeat its target, date and payload digest, and carry a digest of their
own block. The metadata block is JSON: the response's HTTP headers, the title and the links. The conversion block is the
page's text.

Rules for odd input: a null or empty page gives both records with empty text; a null URL is an empty target; a null id
is kept; pages repeated under one id and URL give equal records with equal ids; broken HTML is read as far as it goes: an
open comment, script or tag reaches to the end.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import uuid
from base64 import b32encode
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import arrow_schema, col, pieces, struct_with

# Elements that hold no text of the page; tags that end a line.
_HIDDEN = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript")}
_BREAKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr "
    "li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"<(/?)([a-zA-Z]\w*)")
_TITLE_END = re.compile(r"</title\s*>", re.I)
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACE = re.compile(r"\s+")

RESPONSE = "record_id string, target_uri string, warc_date string, http_headers string, payload string, payload_digest string"
RECORD = (
    "record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_digest string, block string"
)
DATE = "2024-01-01T00:00:00Z"
HTTP_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A name-based id, so that a record made again has the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def read_page(page: str) -> tuple[str, str, list[str]]:
    """Text, title and links of a page, in one pass over its tags; what is open at the end reaches to the end.

    The text has a line per block, blanks joined, no empty lines.
    """
    at, size, out, links, title, in_title = 0, len(page), [], [], None, False
    while at < size:
        found = _OPEN.search(page, at)
        start = found.start() if found else size
        out.append(page[at:start])
        if in_title:
            title.append(page[at:start])
        if not found:
            break
        stands_for, after = "", size
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            stands_for, after = " ", size if end < 0 else end + 3
        else:
            end = page.find(">", start)
            named = _NAME.match(page, start)
            name = named.group(2).lower() if named else ""
            opens = bool(named) and not named.group(1)
            after = size if end < 0 else end + 1
            if opens and end >= 0 and name in _HIDDEN:
                close = _HIDDEN[name].search(page, after)
                stands_for, after = " ", close.end() if close else size
            elif name in _BREAKS:
                stands_for = "\n"
            if opens and name == "a":
                link = _LINK.match(page, start)
                if link:
                    links.append(html.unescape(link.group(1) or link.group(2) or link.group(3) or "").strip())
            elif name == "title":
                if opens and end >= 0 and title is None:
                    title, in_title = [], True
                elif not opens and _TITLE_END.match(page, start):
                    in_title = False
        out.append(stands_for)
        if in_title and stands_for == " ":
            title.append(" ")
        at = after
    lines = (_BLANKS.sub(" ", line).strip() for line in html.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line), _SPACE.sub(" ", html.unescape("".join(title or ()))).strip(), links


def page_text(page: str) -> str:
    return read_page(page)[0]


def page_title(page: str) -> str:
    return read_page(page)[1]


def page_links(page: str) -> list[str]:
    return read_page(page)[2]


def headers_of(http_headers: str) -> dict:
    """Status line and fields of an HTTP header block; a field given twice is joined by a comma."""
    lines = re.split(r"\r?\n", http_headers.strip())
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            name = name.strip()
            fields[name] = f"{fields[name]}, {value.strip()}" if name in fields else value.strip()
    return {"status": lines[0], "fields": fields}


def as_responses(
    pages: DataFrame, payload: str = "html", url: str = "url", keep: Sequence[str] = ("page_id",),
    http_headers: Column | None = None, date: Column | None = None,
) -> DataFrame:
    """Pages as response records: the kept columns, then those of RESPONSE. Ids come from URL, date and payload digest."""
    schema, n = struct_with(pages, keep, RESPONSE), len(keep)
    out = arrow_schema(schema)

    def run(batches):
        for batch in pieces(batches, rows=256):
            cols = [batch.column(n + i).to_pylist() for i in range(4)]
            rows = []
            for target, day, headers, body in zip(*cols):
                own = digest(body.encode())
                rows.append((record_id("response", target, day, own), target, day, headers, body, own))
            yield _batch(batch, n, out, rows)

    light = pages.select(
        *[col(pages, c).alias(f"c{i}") for i, c in enumerate(keep)], F.coalesce(col(pages, url).cast("string"), F.lit("")).alias("_u"),
        (F.lit(DATE) if date is None else date).alias("_d"), (F.lit(HTTP_HEADERS) if http_headers is None else http_headers).alias("_h"),
        F.coalesce(col(pages, payload).cast("string"), F.lit("")).alias("_p"),
    )
    return light.mapInArrow(run, schema)


def derive(responses: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Two records for each response, metadata and conversion: the kept columns, then those of RECORD."""
    schema, n = struct_with(responses, keep, RECORD), len(keep)
    out = arrow_schema(schema)

    def run(batches):
        for batch in pieces(batches, rows=256):
            cols = [batch.column(n + i).to_pylist() for i in range(6)]
            places, rows = [], []
            for i, (source, target, day, headers, body, source_digest) in enumerate(zip(*cols)):
                body = body or ""
                page, title, links = read_page(body)
                about = {
                    "refers-to": source, "source-digest": source_digest, "http": headers_of(headers or ""),
                    "title": title, "links": links,
                }
                for kind, mime, block in (
                    ("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True)),
                    ("conversion", "text/plain; charset=utf-8", page),
                ):
                    data = block.encode("utf-8", "replace")
                    places.append(i)
                    rows.append((
                        kind, record_id(kind, source or ""), source, target, day, mime, len(data), digest(data), source_digest,
                        data.decode(),
                    ))
            yield _batch(batch.take(pa.array(places, pa.int64())), n, out, rows)

    names = [f.split()[0] for f in RESPONSE.split(", ")]
    return responses.select(*[col(responses, c).alias(f"c{i}") for i, c in enumerate(keep)], *[col(responses, c).alias(f"_{c}") for c in names]).mapInArrow(run, schema)


def _batch(batch: pa.RecordBatch, keep: int, schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    kept = [batch.column(i).cast(schema.field(i).type) for i in range(keep)]
    columns = list(zip(*rows)) or [[]] * (len(schema) - keep)
    return pa.RecordBatch.from_arrays([*kept, *[pa.array(c, schema.field(keep + i).type) for i, c in enumerate(columns)]], schema=schema)


def record_text(records: DataFrame) -> Column:
    """A record as it stands in a WARC file, without the two line breaks that end it."""
    fields = [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("Content-Type", "content_type"),
        ("Content-Length", "content_length"), ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_digest"),
    ]
    lines = [F.concat(F.lit(f"{name}: "), records[c].cast("string"), F.lit("\r\n")) for name, c in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.coalesce(line, F.lit("")) for line in lines], F.lit("\r\n"), records["block"])


def write_records(records: DataFrame, path: str) -> None:
    """A folder of WARC files, one per task; Spark's text writer puts the ending line breaks."""
    records.select(record_text(records).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)
