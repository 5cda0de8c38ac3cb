"""Periodic runs against a plain version that tries every period at every place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tallyflow.llm import periodic
from tallyflow.llm.queries import op12_periodic_runs


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            smaller = any(all(stretch[k] == stretch[k + p] for k in range(len(stretch) - p)) for p in range(1, q))
            if len(stretch) >= max(24, 3 * q) and not smaller:
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    shown = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def found(docs, **kw):
    return sorted((tuple(r) for r in periodic.describe(docs, **kw).collect()), key=str)


def fibonacci(n):
    a, b = "a", "a b"
    while len(b.split()) < n:
        a, b = b, f"{b} {a}"
    return " ".join(b.split()[:n])


def texts():
    r = random.Random(3)
    word = lambda k: "".join(r.choice("abcdefghij") for _ in range(k))
    out = [None, "", " \t\n ", "one", "w " * 23, "w " * 24, "x " * 25 + "y", "a b " * 12, "a b c d e f g h i " * 3 + "a", fibonacci(700)]
    out.append(" ".join(f"{bin(i).count('1') % 2}" for i in range(600)))  # no cube at all
    out.append(("a " * 30 + "X ") * 12)  # runs inside a run
    out.append(("a b " * 20 + "c ") * 7 + "a b a")
    out.append("é ü é ü " * 14 + "  " * 30)  # other blanks belong to words
    for size in (1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 50, 64, 65):
        for times in (2.9, 3, 3.1, 5.7):
            part = [word(3) for _ in range(size)]
            head, tail = [word(4) for _ in range(r.randint(0, 40))], [word(4) for _ in range(r.randint(0, 40))]
            out.append(" ".join(head + [part[i % size] for i in range(int(size * times + 0.5))] + tail))
    for letters, n in (("ab", 300), ("ab", 301), ("abc", 400), ("a" * 15 + "b", 500)):
        out += [" ".join(r.choice(letters) for _ in range(n)) for _ in range(3)]
    return out


@pytest.mark.parametrize("tile_words", [periodic.TILE_WORDS, 64, 200])
def test_every_run_of_every_text(docs_of, tile_words):
    """With small tiles, most of these texts are cut into rows and stitched again."""
    want = sorted((plain_row(i, t, False) for i, t in enumerate(texts())), key=str)
    assert found(docs_of(texts()), tile_words=tile_words) == want


def test_whole_small_table(spark, sf_small, small_texts):
    short = {i: t for i, t in small_texts.items() if len(t.split()) < 1200}  # the plain version is slow
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, sf_small).collect()}
    assert set(got) == set(small_texts) and len(short) > 150
    assert {i: got[i] for i in short} == {i: plain_row(i, t, True) for i, t in short.items()}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_repeated_rows_null_ids_and_no_rows(docs_of):
    rows = [(1, "p q " * 20), (1, "p q " * 20), (1, "p " * 50), (None, "p q " * 20), (None, "z " * 30), (None, None)]
    want = sorted((plain_row(i, t, False) for i, t in rows), key=str)
    assert found(docs_of(rows)) == want
    assert found(docs_of([])) == []


def test_very_long_texts(docs_of):
    """Cut into rows: one long run across all of them, and one inside."""
    r = random.Random(1)
    part = [str(r.random()) for _ in range(40_000)]
    text = " ".join(part * 4) + " end"
    inner = " ".join([str(i) for i in range(90_000)] + ["u", "v", "w"] * 50 + [str(i) for i in range(60_000)])
    got = {row[0]: row[1:5] for row in found(docs_of([text, inner, "same " * 150_000]))}
    assert got == {0: (1, 0, 160_000, 40_000), 1: (1, 90_000, 150, 3), 2: (1, 0, 150_000, 1)}


def test_tiles_hold_every_block_of_every_octave():
    for words, tile in ((700, 64), (5_000, 200), (100_000, 1 << 16), (1_000_000, 1 << 16)):
        plan, rows = periodic.octaves(words), periodic.tile_rows(words, tile)
        for i, (_, last, block) in enumerate(plan):
            spans = [(a, b) for low, high, a, b in rows if low <= i <= high]
            assert spans[0][0] == 0 and spans[-1][1] == words
            # neighbours overlap by more than a period and both of its partial blocks
            assert all(b0 - a1 >= min(words - a1, 5 * block) for (_, b0), (a1, _) in zip(spans, spans[1:]))


def test_factors_and_primitive_words():
    factors = periodic.smallest_factors(1000)
    for n in range(2, 1000):
        assert factors[n] == next(p for p in range(2, n + 1) if n % p == 0)
    ids = np.array([1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 5] * 3, np.uint64)
    levels = [ids]
    for t in range(4):
        levels.append(periodic.doubled(levels[-1], 1 << t))
    b = np.zeros(6, np.int64)
    assert periodic.primitive(levels, b, np.array([2, 4, 6, 12, 13, 11])).tolist() == [True, False, False, False, True, True]
