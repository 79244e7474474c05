"""Unicode character classes spelled so that Java (Spark) and RE2 agree.

Python's ``\\s``, ``\\w`` and ``isalpha`` are Unicode-aware; Java's and RE2's
shorthand classes are ASCII-only by default.  The classes below list the
same code points explicitly; ``\\x{...}`` and ``\\p{..}`` are understood by
both engines.
"""

from __future__ import annotations

# Code points Python's ``str.isspace`` / ``re`` ``\s`` treat as whitespace.
WHITESPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
]


def _ranges(ranges) -> str:
    out = []
    for lo, hi in ranges:
        out.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "".join(out)


WS = "[" + _ranges(WHITESPACE_RANGES) + "]"          # Python \s
# a run of whitespace that is not already one space
WS_RUN = f" {WS}+|[{_ranges([(lo, min(hi, 0x1F) if lo < 0x20 else hi) for lo, hi in WHITESPACE_RANGES])}]{WS}*"
NON_WS = "[^" + _ranges(WHITESPACE_RANGES) + "]"     # Python \S
WORD = r"[\p{L}\p{N}_]"                               # Python \w
NON_WORD = r"[^\p{L}\p{N}_]"                          # Python \W
NON_WORD_NO_NL = r"[^\p{L}\p{N}_\n]"                  # \W that '.' can also match
LETTERS_ONLY = r"\p{L}+"                              # Python isalpha (non-empty)


def alternation(words) -> str:
    return "(" + "|".join(words) + ")"
