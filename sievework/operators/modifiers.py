"""Document modifiers: Column functions of a text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators.filters import FILLER, _policy


def remove_boilerplate(only_at_ends: bool = True) -> Callable[[Column], Column]:
    """Without policy paragraphs where they are one run at the top or bottom; elsewhere, or if all are such, unchanged.
    Filler text empties a document; so does any policy paragraph where ``only_at_ends`` is false."""

    def run(t: Column) -> Column:
        parts = T.paragraphs(t)
        marks = F.transform(T.paragraphs(F.lower(t)), _policy)
        n, hits = F.size(marks), F.size(F.filter(marks, lambda m: m))
        first, last = F.array_position(marks, True), F.size(marks) + 1 - F.array_position(F.reverse(marks), True)
        run_at_end = (last - first + 1 == hits) & ((first == 1) | (last == n)) & (hits < n)
        clean = F.array_join(F.filter(parts, lambda p, i: (i + 1 < first) | (i + 1 > last)), "\n\n")
        some = F.when(run_at_end, clean).otherwise(t) if only_at_ends else F.lit("")
        return F.when(F.lower(t).contains(FILLER), F.lit("")).when(hits == 0, t).otherwise(some)

    return run


def remove_lines(patterns: list[str]) -> Callable[[Column], Column]:
    """Without the lines that equal one of ``patterns``."""
    return lambda t: F.array_join(F.filter(F.split(t, "\n", -1), lambda s: ~s.isin(*patterns)), "\n")


def remove_markdown(t: Column) -> Column:
    """Bold, italic and underlined text without its marks, links as their addresses; marks don't span lines."""
    for pattern in (r"\*\*([^\n]*?)\*\*", r"\*([^\n]*?)\*", r"_([^\n]*?)_", r"\[[^\n]*?\]\(([^\n]*?)\)"):
        t = F.regexp_replace(t, pattern, "$1")
    return t


def normalise_newlines(t: Column) -> Column:
    """Three or more line ends become two."""
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"(\r\n){3,}", "\r\n\r\n")


def remove_quotation(t: Column) -> Column:
    """Without the quotation marks around a whole text, unless its first line of several ends in one."""
    stripped = T.strip(t)
    quoted = (F.length(stripped) > 2) & t.startswith('"') & t.endswith('"')
    one = ~stripped.contains("\n") | ~F.substring_index(t, "\n", 1).endswith('"')
    return F.when(quoted & one, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def slice_text(left: int | str | None = 0, right: int | str | None = None, include_left: bool = True, include_right: bool = True, strip: bool = True) -> Callable[[Column], Column]:
    """From a position or the first ``left`` to a position or the last ``right``; empty where one isn't found. Positions
    below 0 count from the end."""

    def place(p: int, n: Column) -> Column:
        return F.least(F.lit(p), n) if p >= 0 else F.greatest(n + p, F.lit(0))

    def run(t: Column) -> Column:
        n, found = F.length(t), F.lit(True)
        a, b = F.lit(0), n
        if isinstance(left, int):
            a = place(left, n)
        elif left is not None:
            at = F.locate(left, t)
            found &= at > 0
            a = at - 1 + (0 if include_left else len(left))
        if isinstance(right, int):
            b = place(right, n)
        elif right is not None:
            at = F.locate(right[::-1], F.reverse(t))
            found &= at > 0
            b = n - at + 1 - (0 if include_right else len(right))
        out = F.substring(t, a + 1, F.greatest(b - a, F.lit(0)))
        return F.when(t.isNotNull(), F.when(found, T.strip(out) if strip else out).otherwise(F.lit("")))

    return run


def remove_urls(t: Column) -> Column:
    return F.regexp_replace(t, rf"(?i)https?://[^{T.BLANK}]+|www\.[^{T.BLANK}]+", "")


def label_line(label: str) -> Callable[[Column], Column]:
    """A training line of a text classifier: the label, then the text on one line without label marks."""
    return lambda t: F.concat(F.lit(f"{label} "), F.replace(F.replace(t, F.lit("\n"), F.lit(" ")), F.lit("__label__"), F.lit(" ")))


def reformat_unicode(form: str = "NFC", unescape_html: bool = True, remove_control_chars: bool = True, fix_latin_ligatures: bool = False, fix_character_width: bool = False, uncurl_quotes: bool = False, fix_line_breaks: bool = False, fix_encoding: bool = True) -> Callable[[Column], Column]:
    """Repair of common text damage: HTML entities, UTF-8 read as Windows-1252, control characters, and the forms named.
    An adapter takes another repairer by passing its own Column function to ``modify``."""
    import pandas as pd

    def one(text: str) -> str:
        import html
        import re
        import unicodedata

        if unescape_html and "<" not in text:
            text = html.unescape(text)
        if fix_encoding and re.search("[Ââà-ï][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]", text):
            try:
                text = text.encode("cp1252").decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
        if fix_latin_ligatures:
            for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "ſt"), ("ﬆ", "st")):
                text = text.replace(a, b)
        if fix_character_width:
            text = "".join(unicodedata.normalize("NFKC", c) if unicodedata.east_asian_width(c) in "FH" or c == "　" else c for c in text)
        if uncurl_quotes:
            text = text.translate({0x2018: "'", 0x2019: "'", 0x201A: "'", 0x201B: "'", 0x201C: '"', 0x201D: '"', 0x201E: '"', 0x201F: '"'})
        if fix_line_breaks:
            text = re.sub("\r\n|[\r  \x85]", "\n", text)
        if remove_control_chars:
            text = re.sub("[\x00-\x08\x0b\x0e-\x1f\x7f⁪-⁯﻿￹-￼]", "", text)
        return unicodedata.normalize(form, text) if form else text

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one, na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")
