import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyflow.llm import bpe
from tallyflow.llm.queries import TOKENIZER, tokenizer_source


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_equals_the_library_on_whole_texts_and_odd_ones(docs_of, library, small_texts):
    random.seed(5)
    odd = "aAbteh 's!#1\n\x1c\x85 　ΣÉÉ́ß漢字😀<|endoftext|>"
    texts = list(small_texts.values())
    texts += ["".join(random.choice(odd) for _ in range(random.randint(0, 30))) for _ in range(400)]
    texts += [None, "", " \n ", "<|endoftext|>", "a<|startoftext|>B", "<|ENDOFTEXT|>", "x" * 20000, "ab" * 9000, "same", "same"]
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode_documents(docs_of(texts), tokenizer_source()).collect()}
    assert got == {i: expected(library, t) for i, t in enumerate(texts)}


def test_round_trip_of_token_columns(docs_of, library):
    texts = ["The cat's Hat, 42!", "", None, "it's"]
    rows = bpe.with_tokens(docs_of(texts), tokenizer_source())
    assert rows.columns[-1] == "token_ids" and "key" in rows.columns
    ids = {r.doc_id: r.token_ids for r in rows.collect()}
    assert ids == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    decoded = {r.doc_id: r.decoded for r in bpe.decode_tokens(rows, tokenizer_source()).collect()}
    assert decoded == {i: library.decode(x, skip_special_tokens=False) for i, x in ids.items()}


def test_empty_table(docs_of):
    assert bpe.encode_documents(docs_of([]), tokenizer_source()).collect() == []


def test_cache_and_chunk_limits_change_nothing():
    import pyarrow as pa

    class Held:
        value = bpe.WordBpe(tokenizer_source())

    texts = pa.record_batch({"text": pa.array(["alpha beta gamma", "beta alphabet", None, "gamma rays"] * 3)})
    wide = [ids for _, ids, _ in bpe.encoder(Held)([texts])]
    narrow = [ids for _, ids, _ in bpe.encoder(Held, chunk_bytes=5, cache_bytes=1_000)([texts])]
    assert sum(wide, []) == sum(narrow, []) and len(narrow) > len(wide)
