"""WARC derivatives: linked metadata and plain-text conversion records of response records."""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import blocks

_CRLF = "\r\n"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace
# Elements that begin a line of their own; those whose content is no text.
_BLOCKS = "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table td th title tr ul"
_HIDDEN = re.compile(r"<(script|style|template|noscript|svg)\b", re.IGNORECASE)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.IGNORECASE)
_SPECIAL = re.compile(r"[>\"']")
# A name is read from its beginning only, and once.
_ATTRIBUTE = re.compile(
    r"(?<![-\w:.])([a-zA-Z_:][-\w:.]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))"
)
# Codecs of Python that no page is written in.
_NO_CHARSETS = ("idna", "punycode", "raw-unicode-escape", "unicode-escape", "undefined")
_BREAKING = frozenset(_BLOCKS.split())


def digest(data: bytes) -> str:
    """A digest as WARC headers have it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    """A whole record, without the two line ends that follow it in a file."""
    lines = ["WARC/1.0", *(f"{name}: {value}" for name, value in headers.items())]
    return _CRLF.join(lines).encode() + b"\r\n\r\n" + block


def _split_headers(data: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """First line, headers in order and repeated as they come, and what follows the blank line."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("headers do not end")
    first, *lines = head.decode("utf-8", "replace").split(_CRLF)
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and headers:  # a folded line
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("a header has no colon")
        headers.append((name.strip(), value.strip()))
    return first, headers, rest


def _value(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def _codings(headers: list[tuple[str, str]], name: str) -> list[str]:
    """Codings in the order they were applied, from all headers of this name."""
    listed = ",".join(v for n, v in headers if n.lower() == name.lower()).lower()
    return [x for part in listed.split(",") if (x := part.split(";")[0].strip()) and x != "identity"]


def _dechunked(data: bytes) -> tuple[bytes, str | None]:
    parts, at = [], 0
    while True:
        line = re.compile(rb"[ \t]*([0-9a-fA-F]+)[ \t]*(?:;[^\r\n]*)?\r?\n").match(data, at)
        if not line:
            # Some writers keep the header over a body that they have already put together.
            return (b"".join(parts), "chunks end early") if parts else (data, None)
        size = int(line[1], 16)
        if not size:
            return b"".join(parts), None
        parts.append(data[line.end() : line.end() + size])
        at = line.end() + size
        if len(parts[-1]) < size:
            return b"".join(parts), "chunks end early"
        at += 2 if data[at : at + 2] == b"\r\n" else 1 if data[at : at + 1] == b"\n" else 0


def _inflated(data: bytes, coding: str) -> tuple[bytes, str | None]:
    """Content of all members, or as much as can be read. What isn't compressed stays, as some
    writers keep the header over a body that they have already unpacked."""
    if coding == "gzip":
        if data[:2] != b"\x1f\x8b":
            return data, None
        ways = [31]
    else:
        ways = [15, -15]  # with the frame that HTTP asks for, or bare
    for bits in ways:
        parts, left = [], data
        try:
            while left:
                one = zlib.decompressobj(bits)
                start = 0
                while not one.eof and start < len(left):
                    parts.append(one.decompress(left[start : start + 65536]))
                    start += 65536
                if not one.eof:
                    parts.append(one.flush())
                    return b"".join(parts), f"{coding} ends early"
                left = one.unused_data + left[start:]
                if coding != "gzip" or left[:2] != b"\x1f\x8b":
                    break
            return b"".join(parts), None
        except zlib.error:
            if any(parts) or coding == "gzip":
                return b"".join(parts), f"{coding} is damaged"
    return data, None


def _content(headers: list[tuple[str, str]], payload: bytes) -> tuple[bytes | None, str | None]:
    """The payload without its transfer and content codings, and what is wrong with them. None
    where a coding is unknown."""
    error = None
    for coding in reversed(_codings(headers, "Content-Encoding") + _codings(headers, "Transfer-Encoding")):
        if coding == "chunked":
            payload, wrong = _dechunked(payload)
        elif coding in ("gzip", "x-gzip", "deflate"):
            payload, wrong = _inflated(payload, coding.removeprefix("x-"))
        else:
            return None, f"unknown coding {coding}"
        error = error or wrong
    return payload, error


def _charset(content_type: str | None, payload: bytes) -> str:
    named = re.search(r"charset=[\"']?([\w.:-]+)", content_type or "", re.I)
    if not named:
        start = payload[:2048].decode("ascii", "replace")
        named = re.search(r"<meta[^>]+charset=[\"']?([\w.:-]+)", start, re.I)
    try:
        if not named or codecs.lookup(named[1]).name in _NO_CHARSETS:
            return "utf-8"
        return b"a".decode(named[1], "replace") and named[1]
    except (LookupError, ValueError):  # unknown, or no charset that can stand in for broken text
        return "utf-8"


class _Tags:
    """Comments, hidden elements, tags and declarations of a page, in order, in time that grows with its length.

    A tag ends at the first > outside quotes. Where there is none, what looked like a tag is text; the quotes passed on
    the way are remembered, as no other tag that comes by one of them has an end either.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.last = {mark: source.rfind(mark) for mark in "\"'>"}
        self.endless: set[int] = set()
        self.searched = self.special = -1

    def _next_special(self, at: int) -> int:
        """The first quote or > from `at` on; the last answer is kept, as many tags may have the same."""
        if not self.searched <= at <= self.special:
            found = _SPECIAL.search(self.source, at)
            self.searched, self.special = at, found.start() if found else len(self.source)
        return self.special

    def _end(self, at: int) -> int:
        """The end of a tag that is read outside quotes from `at` on, or -1."""
        passed = []
        special = self._next_special(at)
        while special < len(self.source) and special not in self.endless:
            mark = self.source[special]
            if mark == ">":
                return special + 1
            passed.append(special)
            if special >= self.last[mark]:
                break
            found = _SPECIAL.search(self.source, self.source.find(mark, special + 1) + 1)
            special = found.start() if found else len(self.source)
        self.endless.update(passed)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(start, end, tag in lower case or '', whether it closes, what follows its name)."""
        source, at = self.source, self.source.find("<")
        while at >= 0:
            end, tag, close, rest = -1, "", False, ""
            if source.startswith("<!--", at):
                found = source.find("-->", at + 4)
                end = found + 3 if found >= 0 else len(source)
            elif (hidden := _HIDDEN.match(source, at)) and (begin := self._end(hidden.end())) >= 0:
                closing = re.compile(rf"</{hidden[1]}\s*+>", re.IGNORECASE).search(source, begin)
                end = closing.end() if closing else len(source)
            elif (named := _TAG.match(source, at)) and (found := self._end(named.end())) >= 0:
                end, tag, close, rest = found, named[2].lower(), bool(named[1]), source[named.end() : found - 1]
            elif source[at + 1 : at + 2] in ("!", "?") and at < self.last[">"]:
                end = source.find(">", at) + 1
            if end >= 0:
                yield at, end, tag, close, rest
            at = source.find("<", max(end, at + 1))


def _unescaped(text: str) -> str:
    """Without character references. The library reads their numbers as they are, of any length."""
    if "&#" in text:
        text = re.sub(r"&#0++(?=[0-9])", "&#", text)
        text = re.sub(r"&#([1-9][0-9]{7})[0-9]++", r"&#\1", text)
    return html.unescape(text)


def html_text(source: str) -> tuple[str, str | None, list[str]]:
    """Text, title and links of a page.

    Comments, scripts, styles and the head but for its title are no text. Elements that
    begin a line of their own do so; white space is one space, and empty lines go.
    """
    parts: list[str] = []
    links: list[str] = []
    title: list[str] | None = None
    at, in_title = 0, False

    def add(text: str) -> None:
        if in_title:
            title.append(text)
        parts.append(re.sub(r"\s+", " ", text))

    for start, end, tag, close, rest in _Tags(source):
        if start > at:
            add(_unescaped(source[at:start]))
        at = end
        if tag in _BREAKING:
            parts.append("\n")
        if tag == "title":
            in_title = not close and title is None
            if in_title:
                title = []
        elif tag in ("a", "area", "link", "img", "iframe") and not close:
            for name, *value in _ATTRIBUTE.findall(rest):
                if name.lower() in ("href", "src"):
                    links.append(_unescaped("".join(value)).strip())
    if at < len(source):
        add(_unescaped(source[at:]))
    lines = (re.sub(r"[ \t]+", " ", line).strip() for line in "".join(parts).split("\n"))
    named = None if title is None else re.sub(r"\s+", " ", "".join(title)).strip()
    return "\n".join(line for line in lines if line), named, links


def derivatives(source: bytes) -> list[tuple[str, dict[str, str], bytes]]:
    """(type, headers, block) of the records that a response record gives.

    The metadata record holds all headers of the source and of its response, digests as stated and
    as computed, title and links; the conversion record holds the plain text and is there only for
    pages, that is for HTML or text, without chunks and gzip or deflate coding; digests are of the bytes as
    stored. Both refer to the source by its identifier. A source that is no well-formed response
    gives a metadata record that says so, and so does a page in another coding, which gives no
    conversion record. A page whose coding ends early or is damaged is converted as far as it goes, with an error.
    """
    error, headers, status, answered, block, payload = None, [], None, [], b"", b""
    try:
        version, headers, block = _split_headers(source)
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        if (_value(headers, "WARC-Type") or "").lower() != "response":
            raise ValueError("not a response")
        length = _value(headers, "Content-Length")
        if length is not None:
            if not length.isdigit() or int(length) > len(block):
                raise ValueError("shorter than its Content-Length")
            block = block[: int(length)]
        status, answered, payload = _split_headers(block)
    except ValueError as found:
        error = str(found)
    source_id = _value(headers, "WARC-Record-ID") or f"<urn:uuid:{uuid.uuid5(_NAMES, digest(source))}>"
    kept = {
        name: value
        for name in ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID")
        if (value := _value(headers, name)) is not None
    }
    content_type = _value(answered, "Content-Type")
    is_page = error is None and re.match(r"text/|application/xhtml", content_type or "text/html", re.I)
    text, title, links = "", None, []
    if is_page:
        content, error = _content(answered, payload)
        is_page = content is not None
    if is_page:
        decoded = content.decode(_charset(content_type, content), "replace")
        if re.match(r"text/plain", content_type or "", re.I):
            text = decoded
        else:
            text, title, links = html_text(decoded)
    stated = {n: _value(headers, f"WARC-{n}-Digest") for n in ("Block", "Payload")}
    computed = {"Block": digest(block), "Payload": digest(payload)}
    described = {
        "source": {"record-id": source_id, "headers": headers},
        "response": {"status": status, "headers": answered, "length": len(payload)},
        "digests": {
            n.lower(): {
                "stated": stated[n],
                "computed": computed[n],
                "agrees": None if stated[n] is None else stated[n] == computed[n],
            }
            for n in stated
        },
        "page": {"title": title, "links": links} if is_page else None,
        "error": error,
    }
    made = [("metadata", "application/json", json.dumps(described, ensure_ascii=False).encode())]
    if is_page:
        made.append(("conversion", "text/plain; charset=utf-8", text.encode()))
    records = []
    for kind, block_type, content in made:
        own = f"<urn:uuid:{uuid.uuid5(_NAMES, source_id + ' ' + kind)}>"
        records.append(
            (
                kind,
                {
                    "WARC-Type": kind,
                    "WARC-Record-ID": own,
                    "WARC-Refers-To": source_id,
                    **kept,
                    "WARC-Block-Digest": digest(content),
                    "Content-Type": block_type,
                    "Content-Length": str(len(content)),
                },
                content,
            )
        )
    return records


def _as_responses(date: str):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in blocks(batches, "html"):
            records = []
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            for page_id, url, page in zip(ids, urls, pages.to_pylist()):
                payload = page.encode()
                answer = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {len(payload)}\r\n\r\n"
                ).encode() + payload
                uri = {} if url is None else {"WARC-Target-URI": re.sub(r"\s", "%20", url)}
                name = f"{page_id} {url} {digest(payload)}"
                headers = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>",
                    **uri,
                    "WARC-Date": date,
                    "WARC-Block-Digest": digest(answer),
                    "WARC-Payload-Digest": digest(payload),
                    "Content-Type": "application/http; msgtype=response",
                    "Content-Length": str(len(answer)),
                }
                records.append(record(headers, answer))
            yield pa.record_batch(
                {"page_id": batch.column("page_id"), "record": pa.array(records, pa.binary())}
            )

    return build


def as_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): a response record for each of `pages` (page_id, url, html).

    NULL html is an empty page; a NULL url gives no target URI. Equal rows give equal records.
    """
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(_as_responses(date), "page_id long, record binary")


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("page_id").to_pylist()
        rows, held = [], 0
        for page_id, source in zip(ids, batch.column("record")):
            for kind, headers, block in derivatives(source.as_py() or b""):
                rows.append((page_id, kind, headers, block))
                held += len(block)
            if held > 8 << 20:
                yield _rows(rows)
                rows, held = [], 0
        if rows:
            yield _rows(rows)


def _rows(rows: list) -> pa.RecordBatch:
    headers = [h for _, _, h, _ in rows]
    return pa.record_batch(
        {
            "page_id": pa.array([p for p, _, _, _ in rows], pa.int64()),
            "record_type": pa.array([k for _, k, _, _ in rows], pa.string()),
            "record_id": pa.array([h["WARC-Record-ID"] for h in headers], pa.string()),
            "refers_to": pa.array([h["WARC-Refers-To"] for h in headers], pa.string()),
            "target_uri": pa.array([h.get("WARC-Target-URI") for h in headers], pa.string()),
            "block_digest": pa.array([h["WARC-Block-Digest"] for h in headers], pa.string()),
            "record": pa.array([record(h, b).decode() for _, _, h, b in rows], pa.string()),
        }
    )


def derive(responses: DataFrame) -> DataFrame:
    """Derivative records of `responses` (page_id, record): page_id, record_type, record_id,
    refers_to, target_uri, block_digest, and the whole record as text.

    A metadata record for every row, and a conversion record for every page (`derivatives`).
    Identifiers follow from the source's, so a rerun gives the same records. A NULL or empty
    record is a malformed source. No shuffle; a task holds a few records at a time.
    """
    return responses.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("record").cast("binary").alias("record")
    ).mapInArrow(
        _derived,
        "page_id long, record_type string, record_id string, refers_to string,"
        " target_uri string, block_digest string, record string",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records to WARC files, compressed, one a task. Overwrites `path`."""
    records.select("record").write.mode("overwrite").option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).text(path)
