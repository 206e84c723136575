"""Queries without SQL against plain versions on the driver's small tables."""

import hashlib
import html.parser
import os
import re
import unicodedata

import pytest

from boutlens.plans import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")


def test_words_and_name_keys(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        plain = unicodedata.normalize("NFKD", r.text).encode("ascii", "ignore").decode().casefold()
        key = " ".join(unicodedata.normalize("NFKC", r.text).casefold().split())
        expected[r.doc_id] = sha(" ".join(re.findall(r"[a-z0-9]+", plain))), sha(key)
    assert {r.doc_id: (r.words_sha256, r.key_sha256) for r in QUERIES["words"](spark, SMALL).collect()} == expected


class Cells(html.parser.HTMLParser):
    """Counts of table cells and list items of a page."""

    def __init__(self):
        super().__init__()
        self.found = {"cell": 0, "item": 0}

    def handle_starttag(self, tag, attrs):
        if tag in ("td", "li"):
            self.found["cell" if tag == "td" else "item"] += 1


def test_pages_have_all_their_items(spark):
    got = {}
    for r in QUERIES["extract_pages"](spark, SMALL).collect():
        got.setdefault(r.page_id, []).append(r.kind)
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect():
        plain = Cells()
        plain.feed(r.html)
        kinds = got.get(r.page_id, [])
        assert (kinds.count("cell"), kinds.count("item")) == (plain.found["cell"], plain.found["item"])
