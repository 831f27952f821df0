"""Reading of pages: against a plain pattern, against the standard parser, and in time that grows with the page."""

from __future__ import annotations

import json
import random
import re
import time
from html import unescape
from html.parser import HTMLParser

import pytest
from oracle import MEDIUM

from starflow.llm import warc

# The same tokens as one pattern, which looks for the end of each tag anew.
PLAIN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<hidden>script|style|template|noscript|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)


def plain_tokens(source):
    return [(t.start(), t.end(), (t["tag"] or "").lower(), bool(t["close"]), t["rest"] or "") for t in PLAIN.finditer(source)]


@pytest.mark.parametrize("seed", range(4))
def test_tokens_equal_those_of_the_pattern(seed):
    draw = random.Random(seed)
    parts = ["<", ">", "'", '"', "a", " ", "/", "<a ", "<script", "</script", "<!--", "-->", "<!", "<?", "=", "<svg:x", "</SCRIPT >", "<style-x>", "<br/>", "é"]
    for _ in range(4000):
        source = "".join(draw.choices(parts, k=draw.randint(0, 24)))
        assert list(warc._Tags(source)) == plain_tokens(source), source


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links, self.title, self.in_title = [], None, False

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "area", "link", "img", "iframe"):
            self.links += [(value or "").strip() for name, value in attrs if name in ("href", "src")]
        if tag == "title" and self.title is None:
            self.title, self.in_title = "", True

    def handle_endtag(self, tag):
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.in_title:
            self.title += data


def test_titles_and_links_of_the_table_equal_the_standard_parser(spark):
    pages = [r.html for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").select("html").collect()]
    assert any(len(warc.html_text(p)[2]) for p in pages)
    for page in pages:
        assert list(warc._Tags(page)) == plain_tokens(page)
        reader = Reader()
        reader.feed(page)
        reader.close()
        _, title, links = warc.html_text(page)
        assert links == reader.links
        assert title == (None if reader.title is None else re.sub(r"\s+", " ", reader.title).strip())


LONG = 4 << 20


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<script ", "<!--", "<a '", '<a "', "<a '\"", "<", "<!", "</script", "<a x", "&#1", "<a b=", "<a href='x'>", "<script></script ", "<a \"'>"],
)
def test_pages_of_one_piece_take_time_that_grows_with_them(piece):
    began = time.process_time()
    warc.html_text(piece * (LONG // 4 // len(piece)))
    short = time.process_time() - began
    warc.html_text(piece * (LONG // len(piece)))
    whole = time.process_time() - began - short
    assert whole < max(8 * short, 0.5) and whole < 20  # four times the page


def test_long_names_numbers_and_endless_quotes():
    began = time.process_time()
    _, _, links = warc.html_text("<a " + "x" * LONG + " href=y>")
    assert links == ["y"]
    assert warc.html_text("&#" + "9" * LONG + ";")[0] == "\ufffd"
    assert warc.html_text("&#" + "0" * LONG + "65;&#x" + "0" * 9000 + "42;&#65")[0] == "ABA"
    text = "<a '" * 200_000 + "'>" + "<b>x</b>"
    assert warc.html_text(text)[0].endswith("x")
    assert time.process_time() - began < 20
    assert warc._unescaped("&#8364;&euro;&#0065;&amp;#12") == unescape("&#8364;&euro;&#0065;&amp;#12")


@pytest.mark.parametrize("charset", ["idna", "undefined", "hex", "no-such", "utf-8", "punycode", "utf-7"])
def test_charsets_that_cannot_stand_in_for_broken_text(charset):
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\n\r\n<p>caf".encode() + b"\xc3\xa9 \xff</p>"
    kinds = warc.derivatives(warc.record({"WARC-Type": "response"}, answer))
    assert [k for k, _, _ in kinds] == ["metadata", "conversion"]
    assert json.loads(kinds[0][2])["error"] is None and kinds[1][2].decode().startswith("caf")
