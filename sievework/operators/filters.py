"""Document filters: a score Column of a text and a test of it.

A rule never fails: where its formula would divide by zero (no words, no lines, no characters) the score is null, and
a null score isn't kept. Rules that define such a case say so with a number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T

# Fixed values.
END_MARKS = (".", "?", "!", '"', "'")
ELLIPSES = ["...", "[...]", "…", "(...)", "[…]", "-»", "read more..", "read more"]
BULLETS = "•‣⁃⁌⁍∙○●◘◦⦾⦿"
COMMON_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with"]
POLICIES = [
    "terms of use",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "privacy overview",
    "use of cookies",
    "use cookies",
    "privacy & cookies policy",
    "privacy and cookies policy",
    "this website uses cookies to improve your experience while you navigate through the website. out of these cookies, the cookies that are categorized as necessary are stored on your browser as they are essential for the working of basic functionalities of the website. we also use third-party cookies that help us analyze and understand how you use this website. these cookies will be stored in your browser only with your consent. you also have the option to opt-out of these cookies. but opting out of some of these cookies may have an effect on your browsing experience.",
    "necessary cookies are absolutely essential for the website to function properly. this category only includes cookies that ensures basic functionalities and security features of the website. these cookies do not store any personal information.",
    "any cookies that may not be particularly necessary for the website to function and is used specifically to collect user personal data via analytics, ads, other embedded contents are termed as non-necessary cookies. it is mandatory to procure user consent prior to running these cookies on your website.",
    "this site uses cookies, including for analytics, personalization, and advertising purposes. for more information or to change your cookie settings, click here.",
    "if you continue to browse this site without changing your cookie settings, you agree to this use. acceptread more",
]
FILLER = "lorem ipsum"


@dataclass(frozen=True)
class Rule:
    """``score(text)`` and ``keep(score)``; ``name`` is the default score column."""

    name: str
    score: Callable[[Column], Column]
    keep: Callable[[Column], Column]


def at_most(limit: float) -> Callable[[Column], Column]:
    return lambda s: s <= limit


def at_least(limit: float) -> Callable[[Column], Column]:
    return lambda s: s >= limit


def within(low: float, high: float) -> Callable[[Column], Column]:
    return lambda s: s.between(low, high)


def _flag(test: Column) -> Column:
    return test.cast("int")


def non_alphanumeric(max_ratio: float = 0.25) -> Rule:
    return Rule("alpha_numeric", lambda t: T.share(F.length(t) - F.regexp_count(t, F.lit(T.ALPHANUMERIC)), F.length(t), 1.0), at_most(max_ratio))


def symbols_to_words(max_ratio: float = 0.1, lang: str = "en") -> Rule:
    test = lambda w: w.isin(ELLIPSES) | (F.regexp_count(w, F.lit("#+")) * 2 > F.length(w))
    return Rule("symbol_to_word", lambda t: T.share_of(T.words(t, lang), test), at_most(max_ratio))


def numbers(max_ratio: float = 0.15) -> Rule:
    return Rule("numbers_ratio", lambda t: T.share(F.regexp_count(t, F.lit("[0-9]")), F.length(t), 1.0), at_most(max_ratio))


def url_share(max_ratio: float = 0.2, pattern: str = T.URL) -> Rule:
    return Rule("urls_ratio", lambda t: T.share(T.total_length(T.urls(t, pattern)), F.length(t), 1.0), at_most(max_ratio))


def bullets(max_ratio: float = 0.9) -> Rule:
    return Rule("bullet_ratio", lambda t: T.share_of(T.lines(t), lambda s: s.rlike(f"^[{T.BLANK}]*[{BULLETS}]")), at_most(max_ratio))


def white_space(max_ratio: float = 0.25) -> Rule:
    return Rule("white_space", lambda t: T.share(F.regexp_count(t, F.lit(r"[\t\n\r\x08 ]")), F.length(t), 1.0), at_most(max_ratio))


def parentheses(max_ratio: float = 0.1) -> Rule:
    return Rule("parentheses_ratio", lambda t: T.share(F.regexp_count(t, F.lit(T.PARENTHESES)), F.length(t), 1.0), at_most(max_ratio))


def long_words(max_length: int = 1000, lang: str = "en") -> Rule:
    return Rule("max_word_length", lambda t: F.array_max(F.transform(T.words(t, lang), F.length)), at_most(max_length))


def word_count(min_words: int = 50, max_words: int = 100_000, lang: str = "en") -> Rule:
    return Rule("word_count", lambda t: F.when(t.isNotNull(), F.size(T.words(t, lang))), within(min_words, max_words))


def _policy(p: Column) -> Column:
    out = F.lit(False)
    for s in POLICIES:
        out = out | p.contains(s)
    return out


def boilerplate(max_ratio: float = 0.4) -> Rule:
    def score(t: Column) -> Column:
        return F.when(F.lower(t).contains(FILLER), F.lit(1.0)).otherwise(T.share_of(T.paragraphs(F.lower(t)), _policy))

    return Rule("boilerplate_string_ratio", score, at_most(max_ratio))


def mean_word_length(low: float = 3, high: float = 10, lang: str = "en") -> Rule:
    return Rule("mean_word_length", lambda t: T.share(T.total_length(T.words(t, lang)), F.size(T.words(t, lang))), within(low, high))


def punctuation(max_ratio: float = 0.85) -> Rule:
    return Rule("punctuation", lambda t: T.share_of(T.lines(t), lambda s: ~F.substring(T.strip(s), -1, 1).isin(*END_MARKS)), at_most(max_ratio))


def ellipsis(max_ratio: float = 0.3) -> Rule:
    def ends(s: Column) -> Column:
        s, out = F.lower(T.strip(s)), F.lit(False)
        for mark in ELLIPSES:
            out = out | s.endswith(mark)
        return out

    return Rule("ellipsis", lambda t: T.share_of(T.lines(t), ends), at_most(max_ratio))


def common_words(least: int = 2, stop_at_least: bool = True) -> Rule:
    """The count stops at ``least`` unless ``stop_at_least`` is false."""

    def score(t: Column) -> Column:
        n = F.size(F.filter(T.words(t), lambda w: w.isin(COMMON_WORDS)))
        return F.when(t.isNotNull(), F.least(n, F.lit(least)) if stop_at_least else n)

    return Rule("common_english_words", score, at_least(least))


def words_with_letters(min_ratio: float = 0.8, lang: str = "en") -> Rule:
    return Rule("words_without_alphabets", lambda t: T.share_of(T.words(t, lang), lambda w: w.rlike(T.ALPHABETIC)), at_least(min_ratio))


def pornographic_urls(pattern: str = T.URL) -> Rule:
    return Rule("porn_urls", lambda t: _flag(F.exists(T.urls(t, pattern), lambda u: u.contains("porn"))), lambda s: s != 1)


def substring(part: str, position: str) -> Rule:
    tests = {"prefix": lambda t: t.startswith(part), "suffix": lambda t: t.endswith(part), "any": lambda t: t.contains(part)}
    if position not in tests:
        raise ValueError(f"position {position!r} is none of prefix, suffix, any")
    return Rule("substring", lambda t: _flag(tests[position](t)), lambda s: s == 1)


def _distinct(split: Callable[[Column], Column], by_length: bool) -> Callable[[Column], Column]:
    size = T.total_length if by_length else F.size
    return lambda t: T.share(size(F.array_distinct(split(t))), size(split(t)))


def repeated_lines(min_ratio: float = 0.7) -> Rule:
    return Rule("repeated_lines", _distinct(T.lines, False), at_least(min_ratio))


def repeated_paragraphs(min_ratio: float = 0.7) -> Rule:
    return Rule("repeated_paragraphs", _distinct(T.paragraphs, False), at_least(min_ratio))


def repeated_lines_by_char(min_ratio: float = 0.8) -> Rule:
    return Rule("repeated_lines_char", _distinct(T.lines, True), at_least(min_ratio))


def repeated_paragraphs_by_char(min_ratio: float = 0.8) -> Rule:
    return Rule("repeated_paragraphs_char", _distinct(T.paragraphs, True), at_least(min_ratio))


def histogram(characters: str, min_ratio: float = 0.8) -> Rule:
    """1 if more than ``min_ratio`` of a text's characters, blanks around it counted in its length alone, are in a
    language's set of ``characters``, else 0."""
    members = "".join(f"\\x{{{ord(c):x}}}" for c in sorted(set(characters)))

    def score(t: Column) -> Column:
        return _flag(T.share(F.regexp_count(T.strip(t), F.lit(f"[{members}]")), F.length(t)) > min_ratio)

    return Rule("histogram", score, lambda s: s == 1)


def lines_of_code(low: int = 10, high: int = 20_000) -> Rule:
    return Rule("num_lines", lambda t: F.regexp_count(t, F.lit("\n")) + 1, within(low, high))


def xml_header(characters: int = 100) -> Rule:
    return Rule("xml_header", lambda t: _flag(F.substring(t, 1, characters).contains("<?xml version=")), lambda s: s != 1)


def alphabetic(min_ratio: float = 0.25) -> Rule:
    return Rule("alpha_filter", lambda t: T.share(F.regexp_count(t, F.lit(T.ALPHABETIC)), F.length(t)), at_least(min_ratio))


@dataclass(frozen=True)
class ExtensionLimits:
    """What a language's file extension allows; a limit of None isn't tested."""

    include: bool
    longest_line: int | None = None
    alphanumeric: float | None = None
    alphabetic: float | None = None

    @classmethod
    def from_row(cls, row: dict[str, str]) -> ExtensionLimits:
        def number(key: str, kind):
            try:
                return kind(row[key])
            except ValueError:
                return None

        return cls(row["Include"] == "1", number("Long_line_threshold", int), number("Alphanum_threshold", float), number("Alpha filter", float))


def extension_limits(path: str, lang: str, extension: str | None) -> ExtensionLimits:
    """The row of a CSV of limits for a language and extension; one that isn't listed is excluded."""
    import csv

    lang = {"C#": "c-sharp", "F#": "f-sharp"}.get(lang, lang.lower().replace(" ", "-"))
    with open(path, newline="") as f:
        rows = {(r["language"], r["extension"]): r for r in csv.DictReader(f)}
    if not any(k[0] == lang for k in rows):
        raise ValueError(f"{path} has no limits for {lang!r}")
    row = rows.get((lang, extension or ""))
    return ExtensionLimits.from_row(row) if row else ExtensionLimits(False)


def per_extension(limits: ExtensionLimits) -> Rule:
    def score(t: Column) -> Column:
        if not limits.include:
            return F.when(t.isNotNull(), F.lit(0))
        split, ok = F.split(t, "\n", -1), F.lit(True)
        if limits.longest_line:
            ok &= F.array_max(F.transform(split, F.length)) <= limits.longest_line
            ok &= (F.length(t) + 1) / F.size(split) - 1 <= 100  # the mean line: fixed value
        if limits.alphanumeric:
            ok &= T.share(F.regexp_count(t, F.lit(T.ALPHANUMERIC)), F.length(t)) >= limits.alphanumeric
        if limits.alphabetic:
            ok &= F.regexp_count(t, F.lit(T.ALPHABETIC)) >= limits.alphabetic * F.length(t)
        return _flag(ok)

    return Rule("per_extension_filter", score, lambda s: F.coalesce(s != 0, F.lit(False)))
