"""Text scalars. Every function takes and returns Columns; names are used as column names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairprep import constants as C

_SPACES = r"[" + C.WS + r"]"
_WORD_CHAR = r"[^" + C.WS + r"]"
_TOKEN = r"\p{L}+|\p{N}|" + _SPACES + r"+|[^\p{L}\p{N}" + C.WS + r"]+"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(as_column(col), F.lit(""))


def strip(col: Column | str) -> Column:
    """Drop Unicode whitespace at both ends (Spark's own trim knows only U+0020)."""
    return F.btrim(as_column(col), F.lit(C.WHITESPACE))


def normalize_newlines(col: Column | str) -> Column:
    """CRLF and CR become LF, then both ends are stripped. Byte-level, no regex."""
    unix = F.replace(as_column(col), F.lit("\r\n"), F.lit("\n"))
    return strip(F.replace(unix, F.lit("\r"), F.lit("\n")))


def looks_like_diff(col: Column | str) -> Column:
    return text_or_empty(col).rlike(C.ANY_DIFF_LINE)


def diff_signals(col: Column | str) -> Column:
    """One boolean per diff line pattern, as a struct."""
    text = text_or_empty(col)
    return F.struct(*[text.rlike(p).alias(name) for name, p in C.DIFF_LINE_STARTS.items()])


def word_count(col: Column | str) -> Column:
    """Number of maximal runs of non-whitespace."""
    text = strip(text_or_empty(col))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, _SPACES + "+")))


def has_words(col: Column | str, n: int) -> Column:
    """At least n words. Stops at the n-th word instead of cutting the whole text up."""
    if n <= 0:
        return F.lit(True)
    if n > 1000:
        return word_count(col) >= n
    spaced = _WORD_CHAR + "++" + _SPACES + "++"
    return text_or_empty(col).rlike(rf"\A{_SPACES}*+(?:{spaced}){{{n - 1}}}{_WORD_CHAR}")


def looks_like_message(col: Column | str) -> Column:
    text = text_or_empty(col)
    return (text != "") & ~looks_like_diff(text) & ~has_words(text, C.MAX_MESSAGE_LIKE_WORDS + 1)


def preview(col: Column | str, n: int = C.PREVIEW_CHARS) -> Column:
    """The text, or its first n characters and an ellipsis when it is longer."""
    text = as_column(col)
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def build_prompt(diff: Column | str, separator: str = C.SEPARATOR) -> Column:
    return F.concat(as_column(diff), F.lit(separator))


def build_training_text(
    diff: Column | str,
    message: Column | str,
    separator: str = C.SEPARATOR,
    eos: str = C.EOS_TOKEN,
) -> Column:
    return F.concat(build_prompt(diff, separator), as_column(message), F.lit(eos))


def extract_completion(generated: Column | str, prompt: Column | str) -> Column:
    """Cut as many characters as the prompt has, whatever they are, and strip the rest."""
    text = as_column(generated)
    start = F.length(as_column(prompt)) + 1
    return strip(F.substring(text, start, F.length(text)))


def strip_special_tokens(col: Column | str, specials: Iterable[str] | None = None) -> Column:
    """Remove the tokens that decoding drops; the unflagged added tokens stay."""
    if specials is None:
        specials = [token for token, _, special in C.SPECIAL_TOKENS if special]
    pattern = "|".join(re.escape(token) for token in specials)
    return F.regexp_replace(as_column(col), pattern, "") if pattern else as_column(col)


def split_tokens(col: Column | str) -> Column:
    """Text to tokens; joining the tokens gives the text back."""
    return F.regexp_extract_all(as_column(col), F.lit(_TOKEN), F.lit(0))


def starts_with_space(col: Column | str) -> Column:
    return as_column(col).rlike(r"\A" + _SPACES)
