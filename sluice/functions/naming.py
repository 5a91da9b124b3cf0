"""Column names: snake case, detection of a table's convention, and shortening."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

LOADED_AT = "_loaded_at"
#: Columns that loads keep for themselves.
BOOKKEEPING = {
    LOADED_AT, "_cdc_lsn", "_cdc_deleted", "_cdc_synced_at", "_cdc_unchanged_cols",
    "_scd_valid_from", "_scd_valid_to", "_scd_is_current",
}


def _tail(name: str) -> str:
    kept = name.rstrip("_")
    return kept + "x" * (len(name) - len(kept))


def _segment(part: str) -> str:
    symbols = {"+": "x", "*": "x", "-": "_", "@": "a", "|": "l"}
    text = "".join(symbols.get(c, c if c.isalnum() else "_") for c in part)
    text = re.sub(r"(?<=[A-Z])(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])", "_", text)
    return _tail(re.sub(r"_+", "_", text.lower()))


def snake_case(name: str) -> str:
    """``name`` in snake case; double underscores separate segments, a trailing one becomes x."""
    joined = "__".join(_segment(p) for p in _tail(name).split("__") if p)
    return "_" + joined if joined[:1].isdigit() else joined


def convention(source: Iterable[str], target: Iterable[str]) -> str:
    """``direct`` if the target holds more of the source's names as they are than in snake case, else ``snake_case``.

    Names that are alike in both say nothing, nor do bookkeeping columns.
    """
    names = {n for n in target if n.lower() not in BOOKKEEPING}
    lowered = {n.lower() for n in names}
    telling = [n for n in source if snake_case(n) != n]
    direct = sum(n in names for n in telling)
    snake = sum(snake_case(n).lower() in lowered for n in telling)
    return "direct" if direct > snake else "snake_case"


def _fit(text: str, size: int, from_end: bool) -> str:
    """The longest prefix or suffix of whole characters within ``size`` bytes."""
    raw = text.encode()
    part = raw[len(raw) - size :] if from_end and size else b"" if not size else raw[:size]
    return part.decode("utf-8", "ignore")


def shorten(name: str, limit: int, original: str | None = None) -> str:
    """``name`` within ``limit`` bytes: head, a tag from the original name's hash, tail."""
    if limit <= 0 or len(name.encode()) <= limit:
        return name
    tag = hashlib.sha256((original or name).encode()).hexdigest()[:10]
    if len(tag) >= limit:
        return tag[:limit]
    room = limit - len(tag)
    return _fit(name, room - room // 2, False) + tag + _fit(name, room // 2, True)


def mapping(names: list[str], style: str = "snake_case", limit: int = 0) -> dict[str, str]:
    """New name of each column; names that meet are left to the caller to merge."""
    out = {}
    for name in names:
        new = name if style == "direct" or name.lower() in BOOKKEEPING else snake_case(name)
        out[name] = shorten(new, limit, name)
    return out
