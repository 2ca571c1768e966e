"""Pre-tokens of the byte-level vocabulary, as columns of work inside Python tasks.

A text is first cut at the tokenizer's special strings (the library's default treats them as single
tokens), then by the published split pattern. `re` has no \\p{L} and \\p{N}, so their character classes
are built from unicodedata.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

# Unicode White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"
# Fixed value: the vocabulary's published split pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranges(kind: str) -> str:
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


@functools.cache
def exact_splitter() -> re.Pattern:
    """The split pattern with the classes spelled out."""
    L, N = _ranges("L"), _ranges("N")
    return re.compile(
        f" ?[{L}]++|'(?:[stmd]|re|ve|ll)| ?[{N}]++| ?[^{SPACE}{L}{N}]++|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


@functools.cache
def odd() -> frozenset[str]:
    """Characters for which \\w, \\d and \\s do not stand for letters, digits and white space as the pattern means them."""
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if _kind(c) != _kind_of_re(c))


def _kind(c: str) -> str:
    return "S" if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else k if (k := unicodedata.category(c)[0]) in "LN" else "O"


def _kind_of_re(c: str) -> str:
    if c.isspace():
        return "S"
    return "N" if c.isdecimal() else "L" if c.isalnum() else "O"


FAST = re.compile(r" ?[^\W\d_]++|'(?:[stmd]|re|ve|ll)| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text without special strings, by a quicker pattern where that means the same."""
    if odd().isdisjoint(text):
        return FAST.findall(text)
    return exact_splitter().findall(text)


@functools.cache
def special_ids(tokenizer_path: str) -> dict[str, int]:
    with open(tokenizer_path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def special_cutter(specials: dict[str, int]):
    """A function that cuts a text into (segment, is_special) parts; plain texts come back whole."""
    if not specials:
        return lambda text: [(text, False)]
    cut = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")

    def parts(text: str):
        if not any(s in text for s in specials):
            return [(text, False)]
        return [(p, i % 2 == 1) for i, p in enumerate(cut.split(text)) if p]

    return parts
