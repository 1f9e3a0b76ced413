"""Byte-level pre-tokenisation of many texts at once with numpy.

Finds the spans of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
by character classes: within it, where a token starts depends only on a
character and its neighbours, so all starts of a block of texts come from a few
array operations.  Strings of special tokens are cut out before, as the
tokenizers library does by default.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from tokenizers import pre_tokenizers

from cropcube.llm.common import prefix_sums, span_hash

LETTER, NUMBER, OTHER, SPACE, END, SPECIAL = range(6)

# The white space of Unicode.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005,
               0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Lone surrogates cannot occur in valid UTF-8, so they mark ends and special tokens.
END_MARK, SPECIAL_MARK = "\ud800", "\ud801"
BLOCK_CHARS = 400_000
#: Letters and numbers of the newest Unicode, some of which Python does not know yet.
_MAYBE = regex.compile(r"[\p{L}\p{N}]")


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point, from the Unicode general category.

    The tokenizers library may know a newer Unicode than Python does, so it is asked
    about the code points that are unassigned here.
    """
    kinds = {"L": LETTER, "N": NUMBER, "Cn": 255}
    known = [unicodedata.category(chr(c)) for c in range(0x110000)]
    out = np.array([kinds.get(k if k == "Cn" else k[0], OTHER) for k in known], np.uint8)
    unknown = np.flatnonzero(out == 255)
    out[unknown] = OTHER
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    unknown = unknown[[bool(_MAYBE.match(chr(c))) for c in unknown.tolist()]]
    for mark, kind in (("a", LETTER), ("1", NUMBER)):
        ends = {end for _, (_, end) in split("".join(f"{mark}{chr(c)}\n" for c in unknown.tolist()))}
        starts = 3 * np.arange(len(unknown))
        out[unknown[[int(s) + 1 not in ends for s in starts]]] = kind
    out[WHITE_SPACE] = SPACE
    out[ord(END_MARK)], out[ord(SPECIAL_MARK)] = END, SPECIAL
    return out


def pieces(text: str, limit: int = BLOCK_CHARS) -> Iterator[str]:
    """Cut a long text where a non-space character meets a space: a token always ends there."""
    start = 0
    while len(text) - start > limit:
        cut = start + limit
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
            cut = len(text) if cut < 0 else cut
        yield text[start:cut]
        start = cut
    yield text[start:]


def blocks(texts: list[str], special: str | None) -> Iterator[tuple[np.ndarray, str]]:
    """Yield (row of each piece, pieces joined with END_MARK after each) of about BLOCK_CHARS."""
    rows: list[int] = []
    found: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        for piece in pieces(text) if len(text) > BLOCK_CHARS else (text,):
            if special and special in piece:
                piece = piece.replace(special, SPECIAL_MARK)
            if found and size + len(piece) > BLOCK_CHARS:
                yield np.array(rows), END_MARK.join(found) + END_MARK
                rows, found, size = [], [], 0
            rows.append(row)
            found.append(piece)
            size += len(piece) + 1
    if found:
        yield np.array(rows), END_MARK.join(found) + END_MARK


def spans(joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, piece number) of every pre-token; a special token's hash is 0."""
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    k = classes()[c]
    n = len(c)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = END, k[:-1]
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = END, k[1:]
    run = k != before
    blank = c == 0x20
    follows_blank = np.zeros(n, bool)
    follows_blank[1:] = blank[:-1]
    start = np.where(k == SPACE, run | (after < SPACE), (run & ~follows_blank) | (k >= END))
    p = np.flatnonzero(start & (c == 0x27))
    if len(p):  # contractions: the mark is at a token's start, its letters follow
        one = c[np.minimum(p + 1, n - 1)]
        two = c[np.minimum(p + 2, n - 1)]
        short = p[np.isin(one, [ord(x) for x in "stmd"])]
        long = p[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]
        start[np.concatenate([short + 1, long + 1])] = False
        start[np.concatenate([short + 2, long + 3])] = True
    s = np.flatnonzero(start)
    e = np.append(s[1:], n)
    kind = k[s]
    ends = kind == END
    piece = np.cumsum(ends) - ends
    keep = ~ends
    s, e, kind, piece = s[keep], e[keep], kind[keep], piece[keep]
    values = (c.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0xD6E8FEB86659FD93)
    h = span_hash(prefix_sums(values ^ (values >> np.uint64(29))), s, e)
    h[kind == SPECIAL] = 0
    return s, e, h, piece
