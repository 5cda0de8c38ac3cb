import random
import re

import pytest

from tallyflow.llm import neardup
from tallyflow.llm.components import connected_components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent):
    """doc_id -> (set size, component), every pair compared."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies():
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    rows, base = [], [word() for _ in range(80)]
    for _ in range(60):  # one group around the limit of similarity
        copy = list(base)
        for _ in range(random.randint(0, 4)):
            copy[random.randrange(80)] = word()
        rows.append(" ".join(copy))
    passage = " ".join(word() for _ in range(12))
    rows += [f"{passage} {word()}" for _ in range(25)] + [f"{passage} {word()} {word()} {word()}" for _ in range(25)]
    rows += ["One two", "one TWO", "one\ttwo three", "", None, "  \n", "x", "X"]
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k", [4, 5])
def test_equals_all_pairs(docs_of, k):
    rows = near_copies()
    out = neardup.near_duplicates(docs_of(rows), k=k, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows, k, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(rows)


def test_equals_all_pairs_on_documents(docs_of, small_texts):
    out = neardup.near_duplicates(docs_of(list(small_texts.items())), k=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(small_texts.items(), 4, 80)


def test_null_ids_empty_tables_and_repeated_rows(docs_of):
    assert neardup.near_duplicates(docs_of([])).collect() == []
    out = neardup.near_duplicates(docs_of([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (5, "A b c d e")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(3, 3), (3, 3), (5, 3)]


def test_one_row_of_each_group_stays_whatever_the_ids(docs_of):
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(6)) for _ in range(n))
    a, b, c = text(40), text(40), text(40)
    near = a + " tail"
    rows = [(1, a), (1, a), (None, a), (None, a), (None, near)]  # one group, two texts
    rows += [(2, near), (2, b), (7, c), (7, c), (None, c), (8, ""), (8, ""), (None, None), (9, text(40))]
    kept = sorted(((x.doc_id, x.text) for x in neardup.without_copies(docs_of(rows)).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (7, c), (8, ""), (8, ""), (None, None), rows[-1]], key=str)
    only_null = neardup.without_copies(docs_of([(None, a), (None, b), (None, a)])).collect()
    assert sorted(x.text for x in only_null) == sorted([a, b])
    sound = neardup.without_copies(docs_of([(4, near), (3, a), (5, b), (6, None)]))
    assert sorted(x.doc_id for x in sound.collect()) == [3, 5, 6] and sound.columns == docs_of([]).columns


def test_components_of_paths_cycles_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(60, 50), (50, 60), (70, 70), (100, 90), (101, 90), (90, 102)]
    out = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {50: 50, 60: 50} | {90: 90, 100: 90, 101: 90, 102: 90}
    assert {r.node: r.component for r in out} == want and len(out) == len(want)
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
