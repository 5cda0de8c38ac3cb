"""Winnowing against a plain version: all windows of all texts, one by one."""

import hashlib
import random

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tallyflow.llm import winnow
from tallyflow.llm.queries import op11_winnowing

TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]{1,8}")


def plain(text, gram=winnow.GRAM, window=winnow.WINDOW):
    """(place, hash) of the rightmost minimum of every window."""
    words = TOKEN.findall("".join(c.lower() for c in text)) or [text] * bool(text)
    hashes = []
    for i in range(max(1, len(words) - gram + 1) if words else 0):
        h = 42
        for word in words[i : i + gram]:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
        hashes.append((h - (1 << 64) if h >> 63 else h) >> 24)  # the signed upper 40 bits order the hashes
    out = {}
    for i in range(max(1, len(hashes) - window + 1) if hashes else 0):
        least = min(hashes[i : i + window])
        at = max(j for j in range(i, min(i + window, len(hashes))) if hashes[j] == least)
        out[at] = least % (1 << 40)
    return sorted(out.items())


def expected(rows):
    """The contract's columns for (id, text) rows with distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    texts = [t or "" for _, t in rows]
    out = {}

    def like(a, b):
        a, b = {h for _, h in a}, {h for _, h in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    def shown(found):
        return " ".join(f"{p}:{h:x}" for p, h in found)

    for i, (doc_id, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, other = plain(text), plain(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out[doc_id] = (len(text), digest, shown(own), shown(other), pytest.approx(like(own, other)), pytest.approx(like(own, plain(after))))
    return out


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé𝄞ß") for _ in range(r.randint(1, 12))) for _ in range(n))


def found(docs, **kw):
    rows = winnow.fingerprints(docs, **kw).collect()
    assert winnow.fingerprints(docs).columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return {r.doc_id: tuple(r)[1:] for r in rows}


def test_every_window_of_every_text(docs_of):
    """Short, blankless, wordless, repetitive and long texts; ids far apart and negative."""
    texts = [None, "", "a", "...", "one two three", "the same " * 40, "x" * 300, "中文字符" * 30, "ΟΔΟΣ ΣΑΣ İI", "𝄞" * 50]
    texts += [prose(n, n) for n in (4, 5, 11, 12, 13, 40, 300, 2_500)]
    texts += [texts[-1], texts[-2] + " tail"]
    r = random.Random(5)
    ids = r.sample(range(-1000, 1000), len(texts) - 2) + [-(1 << 62), 1 << 62]
    rows = list(zip(ids, texts))
    assert found(docs_of(rows)) == expected(rows)


def test_whole_small_table(spark, sf_small, small_texts):
    got = {r.doc_id: tuple(r)[1:] for r in op11_winnowing(spark, sf_small).collect()}
    assert got == expected(list(small_texts.items()))


def test_ties_null_ids_and_tables_of_no_or_one_row(spark, docs_of):
    lone = found(docs_of([(9, "aa bb cc dd ee ff")]))
    assert lone == expected([(9, "aa bb cc dd ee ff")]) and lone[9][-1] == 1.0
    assert found(docs_of([])) == {}
    # equal ids by their text, null ids last; the row after the last is the first
    rows = winnow.fingerprints(docs_of([(3, "b b b"), (3, "a a a"), (None, "n n n"), (8, "z z z"), (8, "z z z")])).collect()
    order = [(8, "z z z"), (8, "z z z"), (3, "a a a"), (3, "b b b"), (None, "n n n")]
    want = []
    for i, (doc_id, text) in enumerate(order):
        edited = text[:4] + order[(i + 1) % len(order)][1][:1]
        want.append((doc_id, hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.edited_sha256) for r in rows), key=str) == sorted(want, key=str)


def test_hot_id_and_many_ranges(spark):
    """A third of the rows under one id: all rows come back, each with a next one."""
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, 77).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = winnow.fingerprints(docs).collect()
    assert len(rows) == 3000 and all(r.near_next == 0.0 for r in rows)
    assert sum(r.doc_id == 77 for r in rows) == 1000


def test_match_guarantee(spark):
    """A shared run of GRAM + WINDOW - 1 tokens always leaves a shared entry."""
    size = winnow.GRAM + winnow.WINDOW - 1
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    pairs = []
    for _ in range(60):
        run = [word() for _ in range(size)]
        pairs.append(tuple(" ".join([word() for _ in range(r.randint(0, 30))] + run + [word() for _ in range(r.randint(0, 30))]) for _ in "ab"))
    both = spark.createDataFrame(pairs, "a string, b string").select(
        F.size(F.array_intersect(winnow.hashes_of(winnow.entries(F.col("a"))), winnow.hashes_of(winnow.entries(F.col("b"))))).alias("n")
    )
    assert all(row.n > 0 for row in both.collect())


def test_no_python_on_the_executors(spark, sf_small):
    plan = op11_winnowing(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2
