"""COVERAGE.md names queries that exist, and every query."""

import os
import re

import catalogue

PAGE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md")


def test_page_matches_registry():
    with open(PAGE, encoding="utf-8") as page:
        rows = [line.split("|") for line in page if line.startswith("| ") and not line.startswith("| id")]
    named = {name for row in rows for name in re.findall(r"`(\w+)`", row[3])}
    assert named == set(catalogue.QUERIES)
