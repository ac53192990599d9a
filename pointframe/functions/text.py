"""Tokenizers as Spark expressions (I4-I7), shared by text filters, text indexes
and sparse vectors so that every path tokenizes the same way.

Fixed rules (our decision, documented in the README):
  multilingual: split the lower-cased text on runs of anything that is not a letter or digit
  word:         the same, but the underscore also counts as part of a token
  whitespace:   split on runs of white space, case kept unless lowercase=True
  prefix:       word tokens expanded to their leading n-grams, min_len..max_len characters
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: split patterns per tokenizer
SPLIT_PATTERNS = {
    "multilingual": r"[^\p{L}\p{N}]+",
    "word": r"[^\p{L}\p{N}_]+",
    "whitespace": r"\s+",
    "prefix": r"[^\p{L}\p{N}_]+",
}


def tokens(text, tokenizer: str = "word", lowercase: bool = True,
           min_len: int | None = None, max_len: int | None = None) -> Column:
    """``array<string>`` of tokens in text order (duplicates kept, empties dropped)."""
    if tokenizer not in SPLIT_PATTERNS:
        raise ValueError(f"unknown tokenizer {tokenizer!r}; expected one of {sorted(SPLIT_PATTERNS)}")
    t = F.col(text) if isinstance(text, str) else text
    if lowercase:
        t = F.lower(t)
    # array_remove (generated code) rather than a lambda filter: same result, no per-element interpretation
    arr = F.array_remove(F.split(t, SPLIT_PATTERNS[tokenizer]), "")
    if tokenizer == "prefix":
        lo = max(1, min_len or 1)
        # each token becomes its prefixes of length lo to max_len (its own length without one);
        # shorter tokens vanish
        upto = (lambda w: F.least(F.lit(max_len), F.length(w))) if max_len else F.length
        arr = F.flatten(F.transform(arr, lambda w: F.transform(
            F.sequence(F.lit(lo), F.greatest(F.lit(lo), upto(w))),
            lambda n: F.substring(w, 1, n))))
        arr = F.filter(arr, lambda x: F.length(x) >= lo)
        return arr
    if min_len is not None:
        arr = F.filter(arr, lambda x: F.length(x) >= min_len)
    if max_len is not None:
        arr = F.filter(arr, lambda x: F.length(x) <= max_len)
    return arr


def sparse_index(token: Column) -> Column:
    """Hashed dimension of a token: the first 7 hex digits of md5, as an int."""
    return F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("int")
