"""Filter rules over a (diff, message) pair, as boolean Columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import has_words, normalize_newlines, strip, text_or_empty


def in_stoplist(message: Column | str, bad_exact: Iterable[str] | None = None) -> Column:
    """Lower-cased message is on the list; an empty list means the built-in one."""
    words = sorted(set(bad_exact or ())) or C.STOPLIST
    return F.lower(text_or_empty(message)).isin(*words)


def too_few_chars(message: Column | str, min_chars: int = C.MIN_MESSAGE_CHARS) -> Column:
    return F.length(text_or_empty(message)) < min_chars


def too_few_words(message: Column | str, min_words: int = C.MIN_MESSAGE_WORDS) -> Column:
    return ~has_words(message, min_words)


def is_reference_only(message: Column | str) -> Column:
    return text_or_empty(message).rlike(C.REFERENCE_ONLY)


def has_placeholder(message: Column | str) -> Column:
    return text_or_empty(message).rlike(C.PLACEHOLDER)


def is_bad_message(
    message: Column | str,
    min_chars: int = C.MIN_MESSAGE_CHARS,
    min_words: int = C.MIN_MESSAGE_WORDS,
    bad_exact: Iterable[str] | None = None,
    normalized: bool = False,
) -> Column:
    """True when the stripped message breaks any rule; the cheap rules come first."""
    m = text_or_empty(message)
    if not normalized:
        m = strip(m)
    return (
        (m == "")
        | in_stoplist(m, bad_exact)
        | too_few_chars(m, min_chars)
        | too_few_words(m, min_words)
        | is_reference_only(m)
        | has_placeholder(m)
    )


def diff_length_ok(
    diff: Column | str,
    min_chars: int = C.MIN_DIFF_CHARS,
    max_chars: int = C.MAX_DIFF_CHARS,
) -> Column:
    return F.length(text_or_empty(diff)).between(min_chars, max_chars)


def keep_pair(
    diff: Column | str,
    message: Column | str,
    min_diff_chars: int = C.MIN_DIFF_CHARS,
    max_diff_chars: int = C.MAX_DIFF_CHARS,
    min_msg_chars: int = C.MIN_MESSAGE_CHARS,
    min_msg_words: int = C.MIN_MESSAGE_WORDS,
    bad_exact: Iterable[str] | None = None,
    normalized: bool = False,
) -> Column:
    """The whole filter. Pass normalized=True when both columns already are."""
    d = text_or_empty(diff)
    m = text_or_empty(message)
    if not normalized:
        d, m = normalize_newlines(d), normalize_newlines(m)
    return diff_length_ok(d, min_diff_chars, max_diff_chars) & ~is_bad_message(
        m, min_msg_chars, min_msg_words, bad_exact, normalized=True
    )


def reject_reason(
    diff: Column | str,
    message: Column | str,
    min_diff_chars: int = C.MIN_DIFF_CHARS,
    max_diff_chars: int = C.MAX_DIFF_CHARS,
    min_msg_chars: int = C.MIN_MESSAGE_CHARS,
    min_msg_words: int = C.MIN_MESSAGE_WORDS,
    bad_exact: Iterable[str] | None = None,
    normalized: bool = False,
) -> Column:
    """Name of the first rule that fails, in filter order; null when the pair is kept."""
    d = text_or_empty(diff)
    m = text_or_empty(message)
    if not normalized:
        d, m = normalize_newlines(d), normalize_newlines(m)
    return (
        F.when(F.length(d) < min_diff_chars, "diff_short")
        .when(F.length(d) > max_diff_chars, "diff_long")
        .when(m == "", "empty")
        .when(in_stoplist(m, bad_exact), "stoplist")
        .when(too_few_chars(m, min_msg_chars), "few_chars")
        .when(too_few_words(m, min_msg_words), "few_words")
        .when(is_reference_only(m), "reference")
        .when(has_placeholder(m), "placeholder")
    )


def has_input(diff: Column | str) -> Column:
    """A diff that is there and not empty; blanks count as input."""
    d = F.col(diff) if isinstance(diff, str) else diff
    return d.isNotNull() & (d != "")
