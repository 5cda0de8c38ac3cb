import random

from tallyflow.llm import linededup


def line(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def run(docs_of, rows, **limits):
    return {r.doc_id: r for r in linededup.drop_repeated_lines(docs_of(rows), **limits).collect()}


def brute_kept(rows, out, gram, window):
    """Checks both thresholds of every document against all earlier lines."""
    seen, places = {}, []
    for doc, text in sorted(rows):
        lines = text.split("\n")
        kept = out[doc].text.split("\n") if out[doc].n_removed < len(lines) else []
        # what is left is a subsequence
        it = iter(lines)
        assert all(x in it for x in kept)
        places.append((doc, lines))
    for n, (doc, lines) in enumerate(places):
        for early_doc, early in places[: n + 1]:
            for i in range(len(lines)):
                for j in range(len(early)):
                    if early_doc == doc and j >= i:
                        continue
                    size = 0
                    while i + size < len(lines) and j + size < len(early) and lines[i + size] == early[j + size]:
                        size += 1
                    run_lines = lines[i : i + size]
                    if sum(len(x.split()) for x in run_lines) >= window:
                        seen.setdefault(doc, set()).update(range(i, i + size))
    for doc, lines in places:
        assert out[doc].n_removed >= len(seen.get(doc, ())), (doc, seen.get(doc), out[doc])
    return seen


def test_every_long_run_goes_and_the_first_copy_stays(docs_of):
    random.seed(2)
    pool = [line(n, s) for s, n in enumerate([1, 2, 3, 5, 8, 12, 25, 60] * 4)]
    rows = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(1, 14)))) for i in range(40)]
    out = run(docs_of, rows, gram_words=10, window_words=20)
    seen = brute_kept(rows, out, 10, 20)
    assert any(seen.values())
    everything = "\n".join(r.text for r in out.values()).split("\n")
    assert {x for _, t in rows for x in t.split("\n")} <= set(everything)
    first = min(rows)
    assert out[first[0]].n_removed == 0 or len(set(first[1].split("\n"))) < len(first[1].split("\n"))


def test_a_passage_of_fifty_words_goes_from_later_documents_only(docs_of):
    passage = line(55, 1)
    rows = [(i, f"{line(30, 100 + i)}\n{passage}\n{line(30, 200 + i)}") for i in range(30)]
    out = run(docs_of, rows)
    assert out[0].text == rows[0][1] and out[0].n_removed == 0
    assert all(out[i].text == f"{line(30, 100 + i)}\n{line(30, 200 + i)}" and out[i].n_removed == 1 for i in range(1, 30))


def test_short_repeats_stay(docs_of):
    rows = [(i, f"The.\n{line(30, i)}\nOf it.") for i in range(10)]
    assert all(r.n_removed == 0 for r in run(docs_of, rows).values())


def test_repeats_inside_one_text_and_whole_copies(docs_of):
    a, b = line(30, 1), line(30, 2)
    out = run(docs_of, [(4, f"{a}\n{b}\n{a}\n{b}\n{a}"), (9, f"{a}\n{b}")])
    assert out[4].text == f"{a}\n{b}" and out[4].n_removed == 3
    assert out[9].text == "" and out[9].n_removed == 2


def test_nulls_empty_ties_and_extra_columns(docs_of):
    a = line(30, 1)
    rows = [(None, a), (1, None), (2, ""), (3, a), (3, a), (7, "\n\n"), (8, a)]
    out = linededup.drop_repeated_lines(docs_of(rows)).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.text, r.n_lines, r.n_removed) for r in out if r.text is not None) == [
        (-1, a, 1, 0), (2, "", 1, 0), (3, a, 1, 0), (3, a, 1, 0), (7, "\n\n", 3, 0), (8, "", 1, 1)
    ]
    assert [(r.n_lines, r.n_removed) for r in out if r.text is None] == [(0, 0)]
    assert {r.key for r in out} == {"k"}
    assert linededup.drop_repeated_lines(docs_of([])).collect() == []
