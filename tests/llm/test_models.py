"""Language ID, toxicity and search against held-out labels and plain scoring."""

import math
import zlib

import numpy as np
import pytest
import regex

from tallyflow.llm import langid, search, toxicity
from tallyflow.llm.common import table
from tallyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    out = {r.doc_id: r for r in QUERIES["op8_lang_zstd"](spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "lang").collect()
    assert len(out) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [(out[r.doc_id].lang_pred, r.lang) for r in rows if out[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())
    assert np.mean([r.rejected for r in out.values()]) < 0.02


def test_language_edge_cases(docs_of):
    dictionaries = {"xx": b"alpha beta gamma delta " * 30, "yy": b"uno dos tres cuatro cinco " * 30}
    texts = ["alpha beta gamma alpha delta gamma", "uno dos tres cinco uno cuatro", None, "", "12 34 !!", "UNO Dos TRES cuatro " * 9000]
    out = {r.doc_id: r for r in langid.identify(docs_of(texts), dictionaries).collect()}
    assert [out[i].lang_pred for i in range(6)] == ["xx", "yy", "und", "und", "und", "yy"]
    assert [out[i].rejected for i in range(6)] == [False, False, True, True, True, False]
    assert langid.identify(docs_of(texts), {}).select("lang_pred").distinct().collect()[0][0] == "und"
    assert {r.lang_pred for r in langid.identify(docs_of(texts[:2]), {"zz": b"any"}).collect()} == {"zz"}
    assert langid.learn(docs_of(["a b c"])) == {}  # no labels
    assert langid.identify(docs_of([]), dictionaries).collect() == []


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in QUERIES["op4_kneser_ney"](spark, sf).collect()}
    assert len(out) == table(spark, sf, "documents").count()
    labels = [(out[r.doc_id], r.toxic) for r in table(spark, sf, "labels").collect() if out[r.doc_id].held_out]
    toxic = np.array([r.score for r, t in labels if t == 1])
    clean = np.array([r.score for r, t in labels if t == 0])
    auc = (toxic[:, None] > clean).mean() + 0.5 * (toxic[:, None] == clean).mean()
    assert auc > 0.88  # 2,000 documents to learn from
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out.values())


def test_toxicity_without_labels_and_of_odd_texts(spark, docs_of):
    docs = docs_of([None, "", "word " * 30000, "word", "😀 é"])
    labels = spark.createDataFrame([(0, None), (1, 5)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert [r.score for r in out] == [0.5] * 5 and all(r.predicted == 1 for r in out)
    assert toxicity.score(docs_of([]), toxicity.learn(docs, labels)).collect() == []


def test_kneser_ney_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(0)
    grams = np.unique(toxicity.grams_of(rng.integers(0, 4, 400)))
    frame = spark.createDataFrame([(int(g),) for g in grams], "gram long")
    low = {r.gram: r.p for r in toxicity.shared_lower(frame).collect()}
    # after each context of the highest shared order: seen symbols' mass stays below one
    totals = {}
    for g, p in low.items():
        totals[g >> toxicity.BITS] = totals.get(g >> toxicity.BITS, 0) + p
    assert all(0 < p < 1 for p in low.values()) and max(totals.values()) < 1 and len(low) > 100


def test_toxicity_tables_are_exact(spark, docs_of):
    """Unseen n-grams leave the back-off alone, also where a hash of 22 bits meets that of a seen one."""
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 in toxicity.COUNT_FOLDS][:2]
    docs = docs_of(list(zip(ids, ["aaaa bbbb abab", "cccc dddd cdcd"])))
    model = toxicity.language_models(spark, docs, spark.createDataFrame([(ids[0], 0), (ids[1], 1)], "doc_id long, toxic int"))
    codes = toxicity._symbols()
    seen = np.concatenate([toxicity.grams_of(toxicity.symbols_of([t], codes)[0]) for t in ("aaaa bbbb abab", "cccc dddd cdcd")])
    letters = np.random.default_rng(0).integers(5, 27, (2_000_000, toxicity.ORDER))
    grams = sum(letters[:, j] << toxicity.BITS * (toxicity.ORDER - 1 - j) for j in range(toxicity.ORDER))
    meets = np.isin(toxicity.bucket(grams, 22), toxicity.bucket(seen, 22))
    texts = ["".join(chr(96 + x) for x in row) for row in letters[meets]]
    assert len(texts) > 3
    # both classes have seen the empty context equally often, so nothing speaks for either
    assert abs(model.features(texts, codes)[:, :4]).max() == 0
    assert model.features(["aaaa", "cccc"], codes)[0, 0] < 0 < model.features(["aaaa", "cccc"], codes)[1, 0]


def test_lowest_order_needs_no_join(spark):
    import inspect

    source = inspect.getsource(toxicity)
    assert source.count("def shared_lower(") == source.count("def count_grams(") == 1
    frame = spark.createDataFrame([(int(g),) for g in (0, 1, 65, 4097)], "gram long")
    assert "NestedLoop" not in toxicity.shared_lower(frame)._jdf.queryExecution().toString()


def plain_bm25(texts, k):
    words = {i: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower()) for i, t in texts.items()}
    n, mean = len(words), sum(map(len, words.values())) / max(1, len(words))
    df = {}
    for w in words.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = {}
    for q in words:
        scores = []
        for d, w in words.items():
            s = 0.0
            for x in set(words[q]) & set(w):
                tf = w.count(x)
                idf = math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5))
                s += words[q].count(x) * idf * tf * (search.K1 + 1) / (tf + search.K1 * (1 - search.B + search.B * len(w) / mean))
            if round(s, search.DIGITS) > 0:
                scores.append((-round(s, search.DIGITS), d))
        out[q] = [d for _, d in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("shard_docs", [7, 1000])
def test_search_equals_scoring_everything(docs_of, shard_docs):
    rng = np.random.default_rng(1)
    weights = 1 / np.arange(1, 60)
    texts = {i: " ".join(f"w{j}" for j in rng.choice(59, rng.integers(1, 40), p=weights / weights.sum())) for i in range(60)}
    texts |= {60: None, 61: "", 62: "w1 w1 w1", 63: "w1 w1 w1", 64: "unique"}
    docs = docs_of(list(texts.items()))
    out = search.search(docs, docs.selectExpr("doc_id as query_id", "text"), k=5, shard_docs=shard_docs).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.doc_id)
    want = {q: d for q, d in plain_bm25(texts, 5).items() if d}
    assert got == want


def test_search_of_empty_tables(docs_of):
    docs, none = docs_of(["a b", "b c"]), docs_of([])
    ask = lambda d: d.selectExpr("doc_id as query_id", "text")
    assert search.search(none, ask(docs)).collect() == []
    assert search.search(docs, ask(none)).collect() == []


def test_search_queries_are_not_sent_to_ever_more_shards():
    assert search.shard_count(5) == 1
    assert search.shard_count(51_282) == search.shard_count(256_410) == search.MIN_SHARDS
    assert search.shard_count(15_000_000) == -(-15_000_000 // search.SHARD_DOCS)
    assert search.shard_count(65, 7) == 10


def test_search_packs_queries():
    rng = np.random.default_rng(2)
    terms = [np.unique(rng.integers(0, 500, 200)) * 2**50 for _ in range(300)]
    counts, df = [rng.integers(1, 400, len(t)) for t in terms], [t // 2**50 + 1 for t in terms]
    packed = search.pack(list(range(300)), terms, counts, df)
    assert len(packed) < sum(len(t) for t in terms) * 16 / 4  # pairs of term and weight took 16 bytes
    asked = search.QueryBlock(packed, 1000)
    found = {(int(q), int(asked.terms[t])): w for t in range(len(asked.terms)) for q, w in zip(asked.query[asked.start[t] : asked.start[t + 1]], asked.weight[asked.start[t] : asked.start[t + 1]])}
    want = {(q, int(t)): c * math.log(1 + (1000 - d + 0.5) / (d + 0.5)) for q in range(300) for t, c, d in zip(terms[q], counts[q], df[q])}
    assert found.keys() == want.keys() and all(math.isclose(found[x], want[x], rel_tol=1e-12) for x in want)


@pytest.mark.parametrize(("frequent", "block"), [(1, 256), (1, 4), (10**9, 4), (4, 16)])
def test_search_in_blocks_equals_scoring_everything(monkeypatch, frequent, block):
    """Terms on either side of the line between rare and frequent, copies, ties and pruned blocks."""
    monkeypatch.setattr(search, "FREQUENT", frequent)
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "PIECE_DOCS", 50)
    rng = np.random.default_rng(3)
    texts = {}
    for i in range(160):  # three vocabularies
        words = [f"{'abc'[i % 3]}{j}" for j in np.minimum(rng.zipf(1.4, rng.integers(1, 60)), 90)]
        texts[i] = " ".join(words)
    texts |= {200 + i: texts[i % 4] for i in range(40)} | {300: "", 301: None, 302: "É-é x_1", 303: "é 1"}
    vectors = dict(zip(texts, search.terms_of(list(texts.values()))))
    mean = sum(v[2] for v in vectors.values()) / len(vectors)
    df = {}
    for v in vectors.values():
        for t in v[0].tolist():
            df[t] = df.get(t, 0) + 1
    shard = search.Shard(mean, len(texts), 7)
    for i, v in vectors.items():
        shard.add(i, v)
    asked = [(i, v[0], v[1], np.array([df[t] for t in v[0].tolist()])) for i, v in vectors.items() if len(v[0])]
    got = {}
    for q, d, _ in zip(*(x.tolist() for x in shard.top(search.pack(*zip(*asked))))):
        got.setdefault(q, []).append(d)
    assert got == {q: d for q, d in plain_bm25(texts, 7).items() if d}


def test_search_skips_blocks_that_cannot_reach(monkeypatch):
    """One block of documents that share all words with the query, others only a frequent one."""
    monkeypatch.setattr(search, "BLOCK", 8)
    texts = ["all q r s " + "q " * i for i in range(8)] + [f"all x{i % 9} y{i % 9} z" for i in range(56)]
    vectors = search.terms_of(texts)
    shard = search.Shard(5.0, 64, 3)
    for i, v in enumerate(vectors):
        shard.add(i, v)
    shard.close()
    df = {t: sum(t in v[0] for v in vectors) for t in vectors[0][0].tolist()}
    asked = search.QueryBlock(search.pack([9], [vectors[0][0]], [vectors[0][1]], [np.array([df[t] for t in vectors[0][0].tolist()])]), 64)
    row_of = np.full(len(shard.vocabulary.terms), -1, np.int32)
    row_of[shard.vocabulary.find(asked.terms)] = np.arange(len(asked.terms))
    best = search.Best(1, 3)
    for piece in shard.pieces:
        piece.search(asked, row_of, best)
    assert len(set(best.ids[0].tolist()) & set(range(8))) == 3
    assert best.scored < 64


def test_search_words_are_runs_of_letters_and_digits():
    texts = ["A_b-c d\x00e\tf 1.2", "x²ⅷ½ İstanbul ΑΣ ǅ", "日本語 テスト。123", "".join(map(chr, range(0x80, 0x3000))), "é", "…"]
    for text in texts:
        words = [w if isinstance(w, str) else w.decode() for w in search.words_of(text) if w]
        assert words == regex.findall(r"[\p{L}\p{N}]+", text.lower())
    # the same words hash alike in ASCII texts and others
    (plain, *_), (other, *_) = search.terms_of(["ab c", "ab c é"])
    assert set(plain.tolist()) < set(other.tolist())


def test_search_in_a_shard_without_words():
    words, empty = search.terms_of(["a b", ""])
    packed = search.pack([1], [words[0]], [words[1]], [np.array([1, 1])])
    for vectors in ([], [empty], [empty, empty]):
        shard = search.Shard(1.0, 3, 10)
        for i, v in enumerate(vectors):
            shard.add(i, v)
        assert [x.tolist() for x in shard.top(packed)] == [[], [], []]
    shard = search.Shard(1.0, 3, 10)
    for i, v in enumerate([empty, words]):
        shard.add(i, v)
    assert shard.top(packed)[1].tolist() == [1]
