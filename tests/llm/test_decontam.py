import itertools
import random
import re

from pyspark.sql import functions as F

from tallyflow.llm import decontam


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklm") for _ in range(6)) for _ in range(n)]


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items, percent=80, stretch=16):
    """(doc, item) of all alignments with a good stretch."""
    found = set()
    for d, text in docs:
        t = tokens(text)
        for i, item in items:
            w = tokens(item)
            for at in range(-len(w) + 1, len(t)):
                lo, hi = max(0, -at), min(len(w), len(t) - at)
                same = [t[at + p] == w[p] for p in range(lo, hi)]
                size = min(len(w), stretch)
                if any(100 * sum(same[s : s + size]) >= percent * size for s in range(len(same) - size + 1)):
                    found.add((d, i))
    return found


def pairs(frame):
    return {(r.doc_id, r.item_id) for r in frame.collect()}


def cases():
    random.seed(4)
    items = [(i, " ".join(words(n, i))) for i, n in enumerate([14, 20, 35, 59, 9, 8, 5, 40])]
    docs = []
    for d in range(60):
        body = words(60, 1000 + d)
        item = items[d % len(items)][1].split()
        copy = [w if random.random() > (d // 8) * 0.06 else "changed" for w in item]
        if d % 5 == 1:
            copy = copy[len(copy) // 2 :]
        at = random.randrange(60)
        docs.append((d, " ".join(body[:at] + copy + body[at:]).capitalize() + "."))
    docs += [(100 + d, " ".join(words(80, 5000 + d))) for d in range(20)]
    return docs, items


def test_equals_all_alignments_and_clean_documents_stay_out(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert pairs(decontam.contaminated(docs_of(docs), bench)) == want
    assert want and all(d < 100 for d, _ in want)
    # the shuffled join gives the same rows as the broadcast one
    assert pairs(decontam.contaminated(docs_of(docs), bench, broadcast_seeds=0)) == want


def test_exact_copies_are_all_found(spark, docs_of):
    items = [(i, " ".join(words(20 + i, i))) for i in range(20)]
    docs = [(i, f"Before it. {t.upper()}! After it.") for i, t in items]
    out = decontam.contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.at, r.matched, r.item_tokens) for r in out} == {(i, i, 2, 20 + i, 20 + i) for i, _ in items}


def test_nulls_empty_ties_and_repeated_rows(spark, docs_of):
    text = " ".join(words(20, 1))
    bench = spark.createDataFrame([(5, text), (3, text), (None, text), (8, None), (9, ""), (10, "too short")], "item_id long, text string")
    docs = docs_of([(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "too short")])
    assert pairs(decontam.contaminated(docs, bench)) == {(1, 3), (4, 10)}
    for few in (decontam.BROADCAST_SEEDS, 0):
        kept = decontam.without_contaminated(docs, bench, broadcast_seeds=few)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontam.contaminated(docs_of([]), bench).count() == 0
    assert decontam.contaminated(docs, bench.where(F.lit(False))).count() == 0


def test_rows_with_equal_or_null_ids_are_judged_by_their_own_text(spark, docs_of):
    leak, clean = " ".join(words(20, 1)), " ".join(words(20, 2))
    bench = spark.createDataFrame([(3, leak)], "item_id long, text string")
    docs = docs_of([(1, leak), (1, clean), (1, clean), (None, f"x {leak}"), (None, clean), (2, clean)])
    for few in (decontam.BROADCAST_SEEDS, 0):
        rows = decontam.without_contaminated(docs, bench, broadcast_seeds=few).collect()
        assert sorted((r.doc_id is None, r.doc_id, r.text) for r in rows) == [(False, 1, clean), (False, 1, clean), (False, 2, clean), (True, None, clean)]
        found = decontam.contaminated(docs, bench, broadcast_seeds=few).collect()
        assert [(r.doc_id, r.item_id, r.at, r.matched) for r in found] == [(1, 3, 0, 20)]


def test_windows_are_shuffled_without_their_text(spark, docs_of):
    """What a window carries through the shuffle does not grow with its text."""
    bench = spark.createDataFrame([(1, " ".join(words(20, 1)))], "item_id long, text string")
    long = " ".join(words(3000, 5)) + " " + " ".join(words(20, 1))
    out = decontam.contaminated(docs_of([long, "a b"]), bench, broadcast_seeds=0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "seed" in line and "Join" in line]
    below = plan[plan.index(joins[0]) :]
    assert "ids" not in below[: below.index("Generate")]
    assert pairs(out) == {(0, 1)}
    assert pairs(decontam.contaminated(docs_of([long, "a b"]), bench)) == {(0, 1)}


def accepted(size, percent=80):
    """All ways in which ``size`` places agree often enough (fewer differences lie inside these)."""
    free = size - -(-size * percent // 100)
    return [[i not in left for i in range(size)] for left in itertools.combinations(range(size), free)]


def test_masks_meet_whatever_the_verification_accepts():
    for size in range(1, decontam.STRETCH + 1):
        masks = decontam.MASKS if size >= 8 else decontam.short_masks(size, 80)
        span = max(map(len, masks))
        for same in accepted(size):
            assert any(all(same[p + q] for q, c in enumerate(m) if c == "1") for m in masks for p in range(size - span + 1)), (size, same)


def test_equals_all_alignments_without_any_seed(spark, docs_of):
    r = random.Random(9)
    items = [(size, " ".join(words(size, 300 + size))) for size in (*range(1, 17), 25)]
    docs = []
    for size, text in items:
        patterns = accepted(min(size, 16))
        for same in r.sample(patterns, min(len(patterns), 30)) + [[False] * 4 + [True] * (size - 4)]:
            copy = [w if s else "changed" for w, s in zip(text.split(), same)]
            docs.append((len(docs), " ".join(words(9, len(docs)) + copy + words(7, 7000 + len(docs)))))
    want = set()
    for d, text in docs:
        t = text.split()
        for i, item in items:
            w = item.split()
            size = min(len(w), 16)
            for at in range(-len(w) + 1, len(t)):
                same = [t[at + p] == w[p] for p in range(max(0, -at), min(len(w), len(t) - at))]
                if any(100 * sum(same[s : s + size]) >= 80 * size for s in range(len(same) - size + 1)):
                    want.add((d, i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert pairs(decontam.contaminated(docs_of(docs), bench)) == want
    assert {i for _, i in want} == {i for i, _ in items}
    gone = {d for d, _ in want}
    assert {x.doc_id for x in decontam.without_contaminated(docs_of(docs), bench).collect()} == {d for d, _ in docs} - gone


def test_plan_has_no_python(spark, docs_of):
    bench = spark.createDataFrame([(1, " ".join(words(20, 1)))], "item_id long, text string")
    plan = decontam.contaminated(docs_of(["a b"]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
