"""Column expressions over review text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from opinara.functions.stopwords import ENGLISH

# One blank, as the ML tokenizer sees it; spelled out because engines disagree on \s.
BLANK = r"[ \t\n\x0B\f\r]"
BLANKS = " \t\n\x0b\f\r"
NON_BLANK_RUN = r"[^ \t\n\x0B\f\r]+"
# A word of two or more word characters in any script.
WORD = r"[\p{L}\p{N}_]{2,}"

# Upper bounds and names of the length buckets, in display order.
LENGTH_BUCKETS = ((100, "0-100"), (300, "100-300"), (500, "300-500"), (1000, "500-1000"))
LAST_BUCKET = "1000+"

PREVIEW_CHARS = 300
MODEL_INPUT_CHARS = 512


def word_count(text: Column) -> Column:
    """Number of non-empty pieces between blanks."""
    return F.regexp_count(text, F.lit(NON_BLANK_RUN))


def clip(value: Column, upper: int) -> Column:
    return F.least(value, F.lit(upper))


def length_bucket_no(length: Column) -> Column:
    """Position of the left-closed length bucket: 0 for the shortest."""
    chosen = F.when(length < LENGTH_BUCKETS[0][0], 0)
    for number, (upper, _) in enumerate(LENGTH_BUCKETS[1:], start=1):
        chosen = chosen.when(length < upper, number)
    return chosen.otherwise(len(LENGTH_BUCKETS))


def length_bucket(length: Column) -> Column:
    """Name of the length bucket; sort by :func:`length_bucket_no`, not by this."""
    names = F.array(*[F.lit(name) for _, name in LENGTH_BUCKETS], F.lit(LAST_BUCKET))
    return F.element_at(names, length_bucket_no(length) + 1)


def preview(text: Column) -> Column:
    return F.substring(text, 1, PREVIEW_CHARS)


def model_input(text: Column) -> Column:
    return F.substring(text, 1, MODEL_INPUT_CHARS)


def is_blank(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NON_BLANK_RUN)) == 0


def tokens(text: Column) -> Column:
    """What the ML ``Tokenizer`` yields: lower-cased pieces between single blanks."""
    return pieces(F.lower(text))


def pieces(lowered: Column) -> Column:
    """Pieces of a lower-cased text; inner and leading empty ones stay, trailing ones go.

    The empty string gives one empty piece, an all-blank one gives none.
    """
    body = F.rtrim(lowered, F.lit(BLANKS))
    return F.when(
        (body == "") & (lowered != ""), F.array().cast("array<string>")
    ).otherwise(F.split(body, BLANK))


def without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(*ENGLISH))


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Runs of ``n`` neighbours joined by one blank; none if there are fewer tokens.

    Built from ``n`` shifted copies: a lambda that looked up ``tokens`` by position would compute
    an inlined expression anew for every element.
    """
    runs = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    shifted = [F.slice(tokens, i + 1, runs).alias(f"w{i}") for i in range(n)]
    return F.transform(
        F.arrays_zip(*shifted), lambda run: F.concat_ws(" ", *[run[f"w{i}"] for i in range(n)])
    )


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
