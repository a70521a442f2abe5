"""Tables that grow by parts: each publish writes a small one, and parts of like size are merged now and then."""

from __future__ import annotations

from typing import NamedTuple


class Part(NamedTuple):
    """One written part: its folder name and how many rows it has."""

    version: str
    rows: int


def to_merge(parts: list[Part], rows: int) -> tuple[list[Part], list[Part]]:
    """(parts that stay, parts to be merged with ``rows`` new ones), both oldest first.

    A part is merged when what follows it has grown to half its size. So there are about as many parts as the table has
    binary digits of rows, and a row is rewritten as often.
    """
    kept, merged = list(parts), []
    while kept and kept[-1].rows <= 2 * (rows + sum(p.rows for p in merged)):
        merged.insert(0, kept.pop())
    return kept, merged
