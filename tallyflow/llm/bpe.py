"""BPE encoding and decoding by prefix-sharing trie traversal.

A BPE encoding has this property: the encoding of a prefix that ends at a token
border is the prefix of the encoding, and a token list is the encoding of its
text exactly when each two neighbours are the encoding of their own text. So
the *last token* of the encoding of every prefix determines the whole: the
last token of ``p`` is the one vocabulary suffix ``t`` of ``p`` that is
compatible with the last token of ``p`` without ``t``.

The distinct words of a chunk of texts form a trie. Visiting its leaves in
sorted order is the depth-first walk; a stack keeps the last token of each
prefix on the current path, so what two words share is computed once.
A word's final character carries the word-end suffix, which makes it another
symbol: it is the leaf edge and never shared with an inner node.

Words are encoded inside the tasks that read the texts: no shuffle. A task's memory is
bounded by the chunk size, a cache of runs that is bounded in bytes and dropped when
full and at the task's end, and a cache of token pairs that is bounded in number.

Defined results: null and empty texts have no tokens (hashes of nothing);
repeated rows are encoded alike; extra columns of the input are ignored by
``encode_documents`` and kept by ``with_tokens``.
"""

from __future__ import annotations

import gc
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyflow.llm.common import arrow_map, text_chunks

#: white space of the normaliser and of the split pattern (fixed values)
WHITE = r"\t-\r\x20\x85\xa0  -     　"
#: the tokenizer file's split pattern is read from the file; its characters' bytes
#: are written with this printable alphabet (byte-level rule: printable bytes stand
#: for themselves, the others follow from 256 on)
CACHE_BYTES = 128_000_000
#: about what an entry of the cache of runs takes besides its texts
ENTRY_BYTES = 300
CACHE_PAIRS = 500_000
CHUNK_BYTES = 4_000_000
NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(spare)
            spare += 1
    return [names[b] for b in range(256)]


class WordBpe:
    """A byte-level BPE with a word-end suffix, from a tokenizers JSON file's text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", WHITE))
        self.blank = regex.compile(f"[{WHITE}]+")
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        alphabet = byte_alphabet()
        self.table = {b: alphabet[b] for b in range(256)}
        # tokens that are the encoding of their own text, by that text: inner ones and those with the word end
        self.inner: dict[str, str] = {}
        self.final: dict[str, str] = {}
        for token in self.vocab:
            if self.merged(self._symbols(token)) == [token]:
                ends = token.endswith(self.suffix) and len(token) > len(self.suffix)
                (self.final if ends else self.inner)[token[: -len(self.suffix)] if ends else token] = token
        self.longest = max(map(len, self.vocab))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})

    # normalising and splitting

    def runs(self, text: str) -> list[str]:
        """Runs of the text without white space; no word and no normalisation crosses their borders."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space for str.split only
            return [r for r in self.blank.split(text) if r]
        return text.split()

    def words(self, run: str) -> list[str]:
        """Words of a run in order; a special token's string stands for itself."""
        out: list[str] = []
        for part in self.split_special.split(run) if "<|" in run else (run,):
            if part in self.special:
                out.append(part)
            else:
                # lower case by character, so a final sigma is an ordinary one
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += self.pieces.findall(part)
        return out

    # merges, for short strings only

    def merge_once(self, symbols: list[str]) -> tuple[list[str], int]:
        """Join the leftmost pair of the lowest rank; NEVER if none can be joined."""
        ranks = [self.ranks.get(pair, NEVER) for pair in zip(symbols, symbols[1:])]
        at = ranks.index(rank := min(ranks))
        return (symbols if rank == NEVER else [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]), rank

    def merged(self, symbols: list[str]) -> list[str]:
        rank = 0
        while len(symbols) > 1 and rank < NEVER:
            symbols, rank = self.merge_once(symbols)
        return symbols

    def _symbols(self, token: str) -> list[str]:
        end = self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix)
        body = token[: -len(self.suffix)] if end else token
        symbols = list(body)
        if end:
            symbols[-1] += self.suffix
        return symbols

    def spine(self, token: str, side: int) -> tuple[list[str], list[int]]:
        """The pieces that stand at one end (0 left, 1 right) of the token while
        its own merges run, in that order, and the rank at which each one goes."""
        found = self.spines[side].get(token)
        if found is None:
            symbols = self._symbols(token)
            pieces, gone = [symbols[-side]], []
            while len(symbols) > 1:
                symbols, rank = self.merge_once(symbols)
                if symbols[-side] != pieces[-1]:
                    pieces.append(symbols[-side])
                    gone.append(rank)
            found = self.spines[side][token] = (pieces, [*gone, NEVER])
        return found

    def fit(self, left: str, right: str) -> bool:
        """Whether the two whole tokens are the encoding of their joined text:
        no merge across the border comes up before the merges on either side
        (the left side goes first when the same merge applies to both)."""
        found = self.pairs.get((left, right))
        if found is None:
            (x, x_gone), (y, y_gone) = self.spine(left, 1), self.spine(right, 0)
            i = j = 0
            found = True
            while True:
                rank = self.ranks.get((x[i], y[j]), NEVER)
                if rank < x_gone[i] and rank <= y_gone[j] and rank < NEVER:
                    found = False
                    break
                if x_gone[i] == y_gone[j] == NEVER:
                    break
                if x_gone[i] <= y_gone[j]:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    # the trie walk

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Token lists of distinct words, walking their trie depth first."""
        table, fit, pairs, out = self.table, self.fit, self.pairs, {}
        inner, final, longest = self.inner, self.final, self.longest
        leaves = sorted(("".join(map(table.__getitem__, w.encode("utf-8", "replace"))), w) for w in words if w not in self.special)
        last = [""]  # last[i]: last token of the encoding of the path's first i symbols
        path = ""
        for leaf, word in leaves:
            size = len(leaf)
            shared, top = 0, min(size, len(last)) - 1
            while shared < top and leaf[shared] == path[shared]:
                shared += 1
            del last[shared + 1 :]
            path = leaf
            for end in range(shared + 1, size + 1):
                # the one suffix that is a token and fits what stands before it
                known = inner if end < size else final
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    token = known.get(leaf[start:end])
                    if token is not None:
                        if start == 0:
                            break
                        fits = pairs.get((last[start], token))
                        if fits is None:
                            fits = fit(last[start], token)
                        if fits:
                            break
                else:
                    raise ValueError(f"no encoding of {leaf[:end]!r}")
                last.append(token)
            tokens, at = [last.pop()], start
            while at > 0:
                tokens.append(last[at])
                at -= len(last[at])
            out[word] = tokens[::-1]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by blanks, as the file names no decoder; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


def encoder(model, chunk_bytes: int = CHUNK_BYTES, cache_bytes: int = CACHE_BYTES):
    """``model.value``: a :class:`WordBpe` (a broadcast; as large as its vocabulary).
    A function from Arrow batches with a ``text`` column to, chunk by chunk, (batch, ids of each text as little-endian bytes, decoded text as bytes)."""

    def run(batches):
        bpe = model.value
        known: dict[str, tuple[bytes, bytes]] = {}  # (ids, decoded text) of a run without white space
        held = 0
        gc.disable()  # millions of small objects and no cycles: collections would only cost time
        try:
            for batch in text_chunks(batches, chunk_bytes):
                if held > cache_bytes:
                    known.clear()
                    held = 0
                texts = [bpe.runs(t) if t else [] for t in batch.column("text").to_pylist()]
                new = {run: bpe.words(run) for run in set().union(*texts).difference(known)}
                words = bpe.encode_words(set().union(*new.values()))
                for run, parts in new.items():
                    tokens = [bpe.special[p] if p in bpe.special else bpe.vocab[t] for p in parts for t in words.get(p, (p,))]
                    known[run] = found = (struct.pack(f"<{len(tokens)}I", *tokens), (bpe.decode(tokens) + " ").encode("utf-8") if tokens else b"")
                    held += len(run) + len(found[0]) + len(found[1]) + ENTRY_BYTES
                found = [[known[run] for run in runs] for runs in texts]
                yield batch, [b"".join([f[0] for f in runs]) for runs in found], [b"".join([f[1] for f in runs])[:-1] for runs in found]
                del texts, new, words, found
        finally:
            known.clear()
            gc.enable()

    return run


def encode_documents(docs: DataFrame, source: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of the ids (little-endian
    unsigned 32-bit) and of the decoded text (UTF-8)."""
    run = encoder(docs.sparkSession.sparkContext.broadcast(WordBpe(source)))

    def digests(batches):
        for batch, ids, decoded in run(batches):
            yield {
                "doc_id": batch.column("doc_id").to_pylist(),
                "n_tokens": [len(b) // 4 for b in ids],
                "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids],
                "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in decoded],
            }

    return arrow_map(docs.select("doc_id", "text"), digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_tokens(docs: DataFrame, source: str, column: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array column; a column of
    that name in the input is replaced."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    run = encoder(docs.sparkSession.sparkContext.broadcast(WordBpe(source)))
    kept = docs.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def tokens(batches):
        import numpy as np

        for batch, ids, _ in run(batches):
            sizes = np.cumsum([0, *(len(b) // 4 for b in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(sizes), values)
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, arrow)), lists.cast(arrow.field(column).type)], schema=arrow)

    return kept.mapInArrow(tokens, schema)


def decode_tokens(docs: DataFrame, source: str, column: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Per row of ``docs``: doc_id and the text that its ids decode to (null ids: null)."""
    model = docs.sparkSession.sparkContext.broadcast(WordBpe(source))

    def decode(batches):
        bpe = model.value
        for batch in batches:
            yield {
                "doc_id": batch.column("doc_id").to_pylist(),
                out: [None if ids is None else bpe.decode(ids) for ids in batch.column(column).to_pylist()],
            }

    return arrow_map(docs.select("doc_id", column), decode, f"doc_id long, {out} string")
