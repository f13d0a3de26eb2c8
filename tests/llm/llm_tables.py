"""Helpers of the tests."""

from __future__ import annotations


def texts_of(table) -> list[tuple]:
    return [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]


def ordered(rows) -> list:
    return sorted(rows, key=repr)
