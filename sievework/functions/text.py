"""Text as Columns: words, lines, paragraphs, n-grams, shares of characters. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() and str.strip() have it: fixed value.
BLANK = r"\x09-\x0d\x1c-\x20\x85\xa0  -     　"
#: URLs, and characters that count as alphanumeric or as parentheses: fixed values.
URL = r"https?://(?:[A-Za-z0-9$\-_@.&+/:=?#~]|[!*\(\),]|(?:%[0-9A-Fa-f]{2}))+"
ALPHANUMERIC = r"[a-zA-Z0-9\n?!,.]"
PARENTHESES = r"[{}⟨⟩\[\]()]"
ALPHABETIC = r"\p{IsAlphabetic}"

#: Splitters for languages whose words aren't divided by blanks, by language code: text -> array of strings.
WORD_SPLITTERS: dict[str, Callable[[Column], Column]] = {}


def register_word_splitter(lang: str, splitter: Callable[[Column], Column]) -> None:
    WORD_SPLITTERS[lang] = splitter


class Splits:
    """Splits of one text (words, lines, paragraphs) that several formulas need: while :meth:`shared` is active, they are
    fields of a struct column that is computed once, instead of expressions of their own."""

    def __init__(self, text: Column, name: str):
        self.text, self.name, self.fields = text, name, {}

    @contextmanager
    def shared(self) -> Iterator[None]:
        token = _ACTIVE.set(self)
        try:
            yield
        finally:
            _ACTIVE.reset(token)

    def column(self) -> Column:
        return F.struct(*[made.alias(field) for field, made in self.fields.items()]).alias(self.name)


_ACTIVE: ContextVar[Splits | None] = ContextVar("splits", default=None)


def _split(text: Column, field: str, made: Column) -> Column:
    active = _ACTIVE.get()
    if active is None or active.text is not text:
        return made
    active.fields.setdefault(field, made)
    return F.col(active.name)[field]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+\z", "")


def words(text: Column, lang: str = "en") -> Column:
    """Non-empty words between blanks. Chinese and Japanese need a registered splitter."""
    if lang in WORD_SPLITTERS:
        return _split(text, f"words_{lang}", WORD_SPLITTERS[lang](text))
    if lang in ("zh", "ja"):
        raise ValueError(f"words of {lang!r} need a splitter: register_word_splitter")
    return _split(text, "words", F.array_remove(F.split(text, f"[{BLANK}]+", -1), ""))


def paragraphs(text: Column) -> Column:
    return _split(text, "paragraphs", F.split(text, "\n\n", -1))


def lines(text: Column) -> Column:
    """Lines that hold more than blanks, as they stand."""
    return _split(text, "lines", F.filter(F.split(text, "\n", -1), lambda s: s.rlike(f"[^{BLANK}]")))


def ngrams(items: Column, n: int) -> Column:
    """Runs of n neighbouring items; none where there are fewer."""
    many = F.size(items) - n + 1
    return F.when(many > 0, F.transform(F.sequence(F.lit(1), F.greatest(many, F.lit(1))), lambda i: F.slice(items, i, F.lit(n)))).otherwise(F.array().cast("array<array<string>>"))


def share(part: Column, whole: Column, empty: float | None = None) -> Column:
    """part / whole as double; ``empty`` where whole is 0 (null if not given)."""
    out = F.try_divide(part.cast("double"), whole.cast("double"))
    return out if empty is None else F.when(whole == 0, F.lit(empty)).otherwise(out)


def total_length(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda s, x: s + F.length(x))


def share_of(items: Column, test: Callable[[Column], Column]) -> Column:
    """Share of items that pass a test; null without items."""
    return share(F.size(F.filter(items, test)), F.size(items))


def urls(text: Column, pattern: str = URL) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def normalised(text: Column) -> Column:
    """Lower case, blanks collapsed to one space, stripped: the form in which exact duplicates may be compared."""
    return F.trim(F.regexp_replace(F.lower(text), f"[{BLANK}]+", " "))
