"""Document fingerprints by winnowing, in DataFrame functions only.

A text's tokens are runs of letters, marks and digits in lower case, cut after every
``TOKEN_CHARS`` code points (so text without blanks has tokens, too). Every ``GRAM``
tokens in a row are hashed; of each ``WINDOW`` hashes in a row the smallest is chosen,
the rightmost of equal ones, with its place. Two texts that share ``GRAM + WINDOW - 1``
tokens in a row share a fingerprint entry; no shorter run than ``GRAM`` can match.
Characters in place of tokens were tried: five times the CPU time (README).

Window minima come from doubling: minima of 1, 2, 4 ... neighbours. Windows are taken
``SPAN`` at a time: the arrays of one step stay small however long the text is. A hash
and its place travel in one long: the upper 40 bits of the hash, then the place (the
token's number) counted down from 2**24 - 1, so the smaller long is the one further
right. Places are known modulo 2**24, and a text of more tokens may choose another one
of two equal hashes beside such a border.

``fingerprints`` also compares each document with the next one in descending order of
doc_id, and with an edited copy of itself. For the order, quantiles of the ids (real
ids, hence no empty range) cut the documents into ranges; the first row of each range
is handed to the range before it as an extra last row. Texts are shuffled once and no
range depends on another. What a text and its edited copy begin with is worked out once.

Defined results: null and empty texts have no entries, an empty fingerprint, and are
like each other (1.0) and like nothing else (0.0); a text without any token, or with
fewer than ``GRAM``, has one entry for the whole; equal texts have equal fingerprints; rows with a null doc_id come
last in the order; rows with equal ids are ordered by their text; a lone row is its own
next; repeated rows each have a row; other columns are ignored; no rows: no rows. A very
long text costs time in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 4, 8
TOKEN_CHARS = 8
SPAN = 1_024
PLACE_BITS = 24
#: ranges of ids for each shuffle partition, so that the partitions come out even
RANGES = 8
MAX_RANGES = 50_000
_PLACES = (1 << PLACE_BITS) - 1
_FIRST_ID = -(1 << 63)
_LETTER = r"\p{L}\p{M}\p{N}"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """The text's tokens; lower case by character, so a final sigma is an ordinary one."""
    lower = F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))
    return F.regexp_extract_all(lower, F.lit(f"[{_LETTER}]{{1,{TOKEN_CHARS}}}"), 0)


def or_whole(found: Column, text: Column) -> Column:
    """Tokens; the text itself if it is not empty and has none."""
    return F.when((F.size(found) == 0) & (text != ""), F.array(text)).otherwise(found)


def n_windows(n: Column, gram: int, window: int) -> Column:
    """Windows over ``n`` tokens: one for a short text, none for an empty one."""
    return F.when(n == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), n - (gram + window - 2)))


def chosen(words: Column, first: Column, last: Column, gram: int, window: int, span: int = SPAN) -> Column:
    """Distinct entries that windows ``first`` to ``last`` (exclusive) of an array of
    tokens choose, by place; ``window`` is a power of two."""

    def entry(data: Column, at: Column) -> Column:
        hashed = F.xxhash64(*(F.get(data, at + i) for i in range(gram)))
        return hashed.bitwiseAND(F.lit(-1 - _PLACES)).bitwiseOR((F.lit(_PLACES) - at % (_PLACES + 1)).cast("long"))

    def halved(minima: Column, shift: int) -> Column:
        if shift == window:
            return minima
        pairs = F.zip_with(minima, F.slice(minima, F.lit(shift + 1), F.size(minima)), lambda x, y: F.least(x, y))
        return let(pairs, lambda m: halved(m, 2 * shift))

    def of_span(data: Column, hashes: Column, start: Column, end: Column) -> Column:
        places = F.sequence(start, F.least(end + (window - 2), hashes - 1))
        minima = let(F.transform(places, lambda at: entry(data, at)), lambda h: halved(h, 1))
        return F.array_distinct(F.slice(minima, F.lit(1), end - start))

    def of_text(data: Column, start: Column, end: Column) -> Column:
        hashes = F.greatest(F.lit(1), F.size(data) - (gram - 1))
        starts = F.sequence(start, end - 1, F.lit(span))
        parts = let(hashes, lambda h: F.transform(starts, lambda s: let(F.least(s + span, end), lambda e: of_span(data, h, s, e))))
        return F.array_distinct(F.flatten(parts))

    whole = let(words, lambda d: let(first, lambda f: let(last, lambda t: of_text(d, f, t))))
    return F.when(first < last, whole).otherwise(F.array().cast("array<long>"))


def entries(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The text's fingerprint as an array of longs (hash and place), by place."""
    whole = F.coalesce(text, F.lit(""))
    return let(or_whole(tokens(whole), whole), lambda d: chosen(d, F.lit(0), n_windows(F.size(d), gram, window), gram, window))


def hashes_of(found: Column) -> Column:
    """The distinct hashes (40 bits) of entries."""
    return F.array_distinct(F.transform(found, lambda e: F.shiftrightunsigned(e, PLACE_BITS)))


def place_of(entry: Column) -> Column:
    return F.lit(_PLACES) - entry.bitwiseAND(F.lit(_PLACES))


def as_text(found: Column) -> Column:
    """``place:hash`` of every entry, joined by blanks."""
    shown = F.transform(found, lambda e: F.concat(place_of(e).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftrightunsigned(e, PLACE_BITS)))))
    return F.array_join(shown, " ")


def likeness(x: Column, y: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(x, y))
    return let(both, lambda n: F.when(F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(n / F.greatest(F.size(x) + F.size(y) - n, F.lit(1))))


def in_ranges(rows: DataFrame, key: str, ranges: int) -> DataFrame:
    """``rows`` with ``range`` (0 for the smallest keys) and ``extra``: false for the rows
    themselves, true for copies of each range's last key, which stand before the keys of
    the range above (those of the largest key: before all). Keys are longs, not null."""
    fractions = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts = F.percentile_approx(key, fractions, 4 * ranges) if fractions else F.array().cast("array<long>")
    found = rows.agg(F.array_sort(F.array_distinct(F.concat(cuts, F.array(F.max(key))))).alias("cuts")).first()["cuts"]
    found = [c for c in found or () if c is not None] or [0]
    cuts, count = F.lit(found), len(found)

    def below(at: Column, step: Column) -> Column:  # binary search: how many cuts are smaller than the key
        return F.when(F.get(cuts, at + step - 1) < F.col(key), at + step).otherwise(at)

    steps = F.lit([1 << b for b in reversed(range(count.bit_length()))])
    own = rows.withColumn("range", F.aggregate(steps, F.lit(0), below))
    is_cut = F.get(cuts, F.col("range")) == F.col(key)
    both = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("extra")), F.struct(((F.col("range") + 1) % count).alias("range"), F.lit(True).alias("extra")))
    return own.withColumn("at", F.explode(F.when(is_cut, both).otherwise(F.slice(both, 1, 1)))).withColumn("range", F.col("at.range")).withColumn("extra", F.col("at.extra")).drop("at")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last third replaced by as much of the start of
    the next document's text, as far as that goes."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(_FIRST_ID).cast("long")))
    ranges = min(MAX_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = in_ranges(rows, "key", ranges)
    # descending; the extra rows of a range stand last, although the next range's ids are smaller anyway but for the wrap
    order = Window.partitionBy("range").orderBy(F.col("extra"), F.desc("key"), F.col("doc_id").isNull(), "text")
    rows = rows.withColumn("next", F.lead("text").over(order))

    n = F.length("text")
    kept = n - F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), kept), F.substring(F.coalesce("next", F.lit("")), F.lit(1), n - kept))
    rows = rows.select("doc_id", "key", "range", "extra", "text", n.alias("n"), kept.alias("kept"), edited.alias("edited"))
    # both texts begin alike as far as ``kept``; tokens before its last border are the same ones
    start = F.regexp_extract(F.substring(F.col("text"), F.lit(1), F.col("kept")), f"(?s)^(.*[^{_LETTER}])", 1)
    rows = rows.withColumn("start", start)
    rows = rows.select(
        "doc_id", "key", "range", "extra", "text", "n", "edited",
        tokens(F.col("start")).alias("words"),
        tokens(F.substring(F.col("text"), F.length("start") + 1, F.col("n"))).alias("rest"),
        tokens(F.substring(F.col("edited"), F.length("start") + 1, F.col("n"))).alias("edited_rest"),
    )
    rows = rows.select(
        "doc_id", "key", "range", "extra", "text", "n",
        F.lower(F.sha2("edited", 256)).alias("edited_sha256"),
        (F.size("words") - (gram + window - 2)).alias("same"),
        or_whole(F.concat("words", "rest"), F.col("text")).alias("words"),
        or_whole(F.concat("words", "edited_rest"), F.col("edited")).alias("edited_words"),
    )
    last, edited_last = n_windows(F.size("words"), gram, window), n_windows(F.size("edited_words"), gram, window)
    rows = rows.select("*", last.alias("last"), edited_last.alias("edited_last"))
    rows = rows.select("*", F.greatest(F.lit(0), F.least("same", "last", "edited_last")).alias("shared"))
    rows = rows.select(
        "doc_id", "key", "range", "extra", "text", "n", "edited_sha256",
        chosen(F.col("words"), F.lit(0), F.col("shared"), gram, window).alias("head"),
        chosen(F.col("words"), F.col("shared"), F.col("last"), gram, window).alias("tail"),
        chosen(F.col("edited_words"), F.col("shared"), F.col("edited_last"), gram, window).alias("edited_tail"),
    )
    rows = rows.select("*", F.array_distinct(F.concat("head", "tail")).alias("own"), F.array_distinct(F.concat("head", "edited_tail")).alias("other"))
    rows = rows.select("*", hashes_of(F.col("own")).alias("own_hashes"), hashes_of(F.col("other")).alias("other_hashes")).drop("head", "tail", "edited_tail")
    rows = rows.withColumn("next_hashes", F.lead("own_hashes").over(order))
    return rows.where("not extra").select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("other_hashes")).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
    )
