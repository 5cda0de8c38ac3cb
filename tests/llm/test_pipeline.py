"""The corpus pipeline on a small corpus whose right result is known, stage by stage."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyflow.llm.queries import TOKENIZER
from test_bpe import expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(n, seed, letters="abcdefghij"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, texts by id): clean texts of two languages, and one case of each kind."""
    texts = {i: prose(60, i) for i in range(20)} | {i: prose(60, i, "uvwxyzklmn") for i in range(20, 40)}
    texts[50] = None
    texts[51] = "1234 !!! 5678"
    passage = prose(55, 900)
    texts[60] = f"{prose(40, 60)}\n{passage}\n{prose(40, 61)}"
    texts[61] = f"{prose(40, 62)}\n{passage}\n{prose(40, 63)}"
    texts[62] = texts[3]  # a whole copy
    words = texts[5].split()
    texts[63] = " ".join([*words[:30], "changed", *words[31:]])  # a near copy on one line
    item = prose(30, 800)
    leak = item.split()
    leak[10] = leak[20] = "other"
    texts[64] = f"{prose(40, 64)} {' '.join(leak)} {prose(40, 65)}"
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "vw" if 20 <= i < 40 else "ab", "s", len(t) if t else 0) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(25, 801))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts


def test_every_stage_and_the_whole(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == COLUMNS
        rows = docs.collect()
        kept[name] = {r.doc_id: r for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
    everything = set(texts)
    assert set(kept["language_id"]) == everything - {50, 51}
    cleaned = kept["line_dedup"]
    assert set(cleaned) == everything - {50, 51, 62}
    assert cleaned[61].text == f"{prose(40, 62)}\n{prose(40, 63)}" and cleaned[61].n_chars == len(cleaned[61].text)
    assert all(cleaned[i].text == texts[i] for i in cleaned if i != 61)
    assert set(kept["near_dedup"]) == everything - {50, 51, 62, 63}
    assert set(kept["benchmark_decontamination"]) == everything - {50, 51, 62, 63, 64}
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    want = {i: expected(library, r.text) for i, r in kept["benchmark_decontamination"].items()}
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, folder).collect()} == want


def test_stages_keep_extra_columns_and_take_empty_tables(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS id", "'k' AS key", "0.5 AS score", "true AS rejected")
    for rows in (docs.where("doc_id < 3"), docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, folder)
            assert out.columns == docs.columns and out.count() == rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, folder).count() == rows.count()
