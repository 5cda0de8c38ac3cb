"""Secret scans: an Aho-Corasick keyword prefilter, regular expressions anchored at
its hits, and the checksums that some tokens carry.

One automaton pass over the text (ASCII letters in lower case, so that places stay)
finds all keywords. Expressions are matched only where their keyword stands; scanned
from left to right and past the last match's end, that is the same as searching the
whole text. Runs of hexadecimal digits have no keyword; one linear search finds them.

Base kinds: assign, access, hex. The method adds ``github`` and ``npm``: tokens
whose last six base-62 digits are the CRC-32 of the part before; a token of the
right form with another checksum is dropped.

Defined results: null and empty texts have no spans; spans of different kinds may
overlap, spans of one kind don't; repeated rows are scanned alike; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from tallyflow.llm.spans import Span, scan

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm")
# fixed values: the kinds' patterns and least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: str) -> str:
    """CRC-32 of the body in six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS[digit] + out
    return out


RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_LEAST),
    "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_LEAST),
    "github": (GITHUB, lambda m: checksum(m[1]) == m[2]),
    "npm": (NPM, lambda m: checksum(m[1]) == m[2]),
}


def scanner():
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()

    def find(text: str) -> tuple[list[Span], list[Span]]:
        lower = text.encode("utf-8", "replace").lower().decode("utf-8")  # ASCII letters only: places stay
        base, more, past = [], [], dict.fromkeys(KEYWORDS, 0)
        hits = sorted((last - size + 1, kind) for last, (kind, size) in automaton.iter(lower))
        for start, kind in hits:
            if start < past[kind]:
                continue
            pattern, passes = RULES[kind]
            if m := pattern.match(text, start):
                past[kind] = m.end()  # also if it fails: no retries inside
                if passes(m):
                    (base if kind in BASE else more).append((start, m.end(), kind))
        base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        return base, more

    return find


def secrets(docs: DataFrame) -> DataFrame:
    return scan(docs, scanner, KINDS, BASE)
