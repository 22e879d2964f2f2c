"""Tokenisers and n-gram builders as native column expressions.

Nothing here starts a Python worker: every builder returns a ``Column`` made of
Spark functions, so it stays inside the scan's stage and partitions like the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions import stopwords

# Escape sequences left behind by exported text, and token patterns.
CONTROL_ESCAPES = r"\\[nrtfvba0]+"
CONTROL_ESCAPE_STRICT = r"\\[nrtfvba0]"
UNICODE_ESCAPE = r"\\u[0-9a-fA-F]{4}"
LETTERS = r"([a-z']+)"
WORD = r"([\p{L}\p{N}_]{2,})"
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``.

    A column captured inside a lambda would be evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_escapes(text: Column, strict: bool = False) -> Column:
    """Replace literal escape sequences and left-over backslashes by blanks.

    The default also removes escape letters that follow each other, so a literal
    ``\\nthe`` leaves ``he``; ``strict`` removes one letter only. Texts without a
    backslash skip the regular expressions.
    """
    control = CONTROL_ESCAPE_STRICT if strict else CONTROL_ESCAPES
    cleaned = F.regexp_replace(text, control, " ")
    cleaned = F.regexp_replace(cleaned, UNICODE_ESCAPE, " ")
    cleaned = F.translate(cleaned, "\\", " ")
    return F.when(F.contains(text, F.lit("\\")), cleaned).otherwise(text)


def _keep(tokens: Column, min_length: int, stop_words: Iterable[str]) -> Column:
    stop = list(stop_words)

    def wanted(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(stop) if stop else long_enough

    return F.filter(tokens, wanted)


def tokens(
    text: Column,
    escapes: bool = True,
    strict_escapes: bool = False,
    strip_quotes: bool = True,
    min_length: int = 2,
    stop_words: Iterable[str] = (),
) -> Column:
    """Lower-case letter tokens of a text as ``array<string>``; null gives ``[]``."""
    source = F.coalesce(text.cast("string"), F.lit(""))
    if escapes:
        source = clean_escapes(source, strict_escapes)
    found = F.regexp_extract_all(F.lower(source), F.lit(LETTERS), F.lit(1))
    if strip_quotes:
        found = F.transform(found, lambda token: F.btrim(token, F.lit("'")))
    return _keep(found, min_length, stop_words)


def report_tokens(text: Column, strict_escapes: bool = False) -> Column:
    """Tokeniser of the term reports: escapes cleaned, all stop words removed."""
    return tokens(text, strict_escapes=strict_escapes, stop_words=stopwords.report_words())


def check_tokens(text: Column) -> Column:
    """Tokeniser of the term-frequency check: base stop words, no cleaning."""
    return tokens(
        text, escapes=False, strip_quotes=False, stop_words=stopwords.base_words()
    )


def plain_tokens(text: Column) -> Column:
    """Tokeniser of the per-group reports: letters only, no stop words."""
    return tokens(text, escapes=False, strip_quotes=False)


def model_words(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Words for model features: runs of two or more letters, digits or ``_``."""
    stop = stopwords.base_words() if stop_words is None else stop_words
    source = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return _keep(F.regexp_extract_all(source, F.lit(WORD), F.lit(1)), 2, stop)


def word_ngrams(words: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams of ``low``..``high`` consecutive words, joined by a blank."""

    def of_size(found: Column, n: int) -> Column:
        if n == 1:
            return found
        starts = F.slice(found, F.lit(1), F.greatest(F.size(found) - (n - 1), F.lit(0)))
        return F.transform(
            starts,
            lambda word, i: F.concat_ws(
                " ", word, *[F.get(found, i + step) for step in range(1, n)]
            ),
        )

    if low == high == 1:
        return words
    sizes = range(low, high + 1)
    return bind(words, lambda found: F.concat(*[of_size(found, n) for n in sizes]))


def blank_separated(text: Column) -> Column:
    """Lower-case words between blanks, without empty ones."""
    source = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.filter(F.split(source, BLANKS), lambda word: word != "")


def char_ngrams(word: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside one word, with a blank on either side of it.

    A word shorter than the smallest size gives itself, once.
    """

    def of_size(padded: Column, n: int) -> Column:
        starts = _places(F.length(padded) - (n - 1))
        return F.transform(starts, lambda start: F.substring(padded, start, F.lit(n)))

    def grams(padded: Column) -> Column:
        sizes = [of_size(padded, n) for n in range(low, high + 1)]
        return F.when(F.length(padded) < low, F.array(padded)).otherwise(F.concat(*sizes))

    return bind(F.concat(F.lit(" "), word, F.lit(" ")), grams)


def _places(count: Column) -> Column:
    """1..count, empty for a count below 1."""
    return F.coalesce(
        F.when(count > 0, F.sequence(F.lit(1), count)), F.array().cast("array<int>")
    )


def sorted_runs(terms: Column) -> Column:
    """Distinct terms with their number, ``array<struct<term, tf>>``, in term order.

    Sorting inside the row replaces a shuffle on (document, term).
    """

    def starts_of(ordered: Column) -> Column:
        return F.filter(
            _places(F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )

    def runs(ordered: Column, first: Column) -> Column:
        after_last = F.size(ordered) + 1
        return F.transform(
            first,
            lambda start, i: F.struct(
                F.get(ordered, start - 1).alias("term"),
                (F.coalesce(F.get(first, i + 1), after_last) - start)
                .cast("long")
                .alias("tf"),
            ),
        )

    return bind(
        F.sort_array(terms),
        lambda ordered: bind(starts_of(ordered), lambda first: runs(ordered, first)),
    )
