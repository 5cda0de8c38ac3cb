"""Language ID by compression: a text belongs to the language whose zstandard
raw-content dictionary makes it smallest.

Learning: of the labelled documents that are not held out, the ``DICT_TEXTS``
texts of each language with the smallest text hash give their first
``EXCERPT_BYTES`` bytes (after folding) to its dictionary. That bound is the
classifier's documented sample; every document is predicted from its whole text.

Predicting: the folded text is cut into blocks, each is compressed with every
language's dictionary, and the sizes are summed over the text. Blocks keep a long
text from becoming its own dictionary. The margin between the two smallest sums,
as a share of the second, is the score. A text whose margin is below
``narrow`` is rejected: no language explains it better than another.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and
rejected; equal sizes go to the language with more labelled texts, then the first in name
order (score 0); with no
labelled text at all every document is ``und``; with one language everything with
a letter is that language (score 1). Repeated rows are predicted alike.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm.common import held_out, text_chunks

DICT_TEXTS = 48
EXCERPT_BYTES = 2048
BLOCK_BYTES = 4096
#: stands before every block: it shrinks so well that even a text of a few words is
#: compressed rather than stored, and its matches with a dictionary count
CARRIER = bytes(128) + b" "
#: matches of four bytes count; hash tables as large as the dictionaries
PARAMETERS = dict(strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=18, hash_log=17, chain_log=17, search_log=4, target_length=0)
NARROW = 0.004
CHUNK_BYTES = 4_000_000
UND = "und"

#: lower-case ASCII letters and all other letters stay; other ASCII bytes become blanks
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def folded(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split())


def learn(docs: DataFrame, texts: int = DICT_TEXTS, excerpt_bytes: int = EXCERPT_BYTES) -> dict[str, bytes]:
    """Dictionary bytes per language, from a bounded sample of labelled texts."""
    rows = docs.where("text is not null and lang is not null").where(~held_out())
    rank = Window.partitionBy("lang").orderBy("h")
    hashes = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    chosen = hashes.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= texts).drop("n")
    picked = [(r.lang, r.h) for r in chosen.collect()]  # texts * languages rows
    if not picked:
        return {}
    sample = rows.where(F.xxhash64("text").isin([h for _, h in picked])).select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, excerpt_bytes).alias("text")).distinct()
    found = sorted({(r.lang, r.h, r.text) for r in sample.collect()})
    wanted, parts = set(picked), {}
    for lang, h, text in found:
        if (lang, h) in wanted:
            parts.setdefault(lang, []).append(folded(text)[:excerpt_bytes])
    often = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    return {lang: b" ".join(parts[lang]) for lang in sorted(parts, key=lambda x: (-often[x], x))}


def classifier(dictionaries: dict[str, bytes], block_bytes: int = BLOCK_BYTES):
    """A function from a text to (language, score); the first of the dictionaries wins a tie."""
    names = list(dictionaries)
    parameters = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **PARAMETERS)
    packers = []
    for name in names:
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=parameters)
        packers.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=content))

    def predict(text: str | None) -> tuple[str, float]:
        if not names or not text or not _LETTER.search(text):
            return UND, 0.0
        if len(names) == 1:
            return names[0], 1.0
        data = folded(text)
        blocks = [CARRIER + data[i : i + block_bytes] for i in range(0, len(data), block_bytes)]
        sizes = [sum(len(p.compress(b)) for b in blocks) for p in packers]
        best, second = sorted(sizes)[:2]
        return names[sizes.index(best)], (second - best) / second

    return predict


def identify(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW, prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (names after ``prefix``;
    columns of these names in the input are replaced)."""
    added = [prefix + n for n in ("lang_pred", "score", "rejected")]
    docs = docs.drop(*added)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(added, kinds))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        predict = classifier(dictionaries)
        for batch in text_chunks(batches, CHUNK_BYTES):
            found = [predict(t) for t in batch.column("text").to_pylist()]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            values = ([f[0] for f in found], [f[1] for f in found], [f[0] == UND or f[1] < narrow for f in found])
            columns += [pa.array(v, arrow.field(n).type) for v, n in zip(values, added)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)
