"""Column functions on text: normal forms, tokens, fingerprints and estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[ \\t\\r\\n]+"


def normal_space(text: Column) -> Column:
    """Lower case, white space collapsed and trimmed; the exact-match key."""
    return F.trim(F.regexp_replace(F.lower(text), SPACE, " "))


def fingerprint(text: Column) -> Column:
    return F.sha2(normal_space(text).cast("binary"), 256)


def public_id(text: Column) -> Column:
    return F.concat(F.lit("pretrain_"), F.substring(F.sha2(F.trim(text).cast("binary"), 256), 1, 24))


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, rounded up, 1 at least."""
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4.0)).cast("long")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")).cast("long")


def shingles(words: Column, k: int) -> Column:
    """The distinct k-grams of words as 64-bit hashes; of fewer words, but not none, their whole sequence."""
    grams = F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.array_join(F.slice(words, i, k), " ")))).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(grams)


def hashed_shingles(hashes: Column, k: int) -> Column:
    """shingles() by the words' 64-bit hashes, a column of its own: no text is made for a shingle."""
    n = F.size(hashes)
    grams = F.transform(F.slice(hashes, F.lit(1), F.greatest(n - (k - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, k)]))
    return F.array_distinct(F.when(n >= k, grams).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>")))


def masked_numbers(text: Column) -> Column:
    return F.regexp_replace(normal_space(text), "[0-9]+(?:[.,][0-9]+)*", "<num>")


def template(text: Column) -> Column:
    """Quotes and numbers replaced by slots, then the exact-match key."""
    return normal_space(F.regexp_replace(F.regexp_replace(text, '"[^"]*"', "<quoted>"), "[0-9]+(?:[.,][0-9]+)*", "<num>"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; of two empty ones 1."""
    both = F.size(F.array_intersect(a, b))
    all_ = F.size(F.array_union(a, b))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)
