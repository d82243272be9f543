"""Filters whose formulas need a running state or a parser: Arrow UDFs, one call for a batch of texts."""

from __future__ import annotations

import ast
import io
import tokenize
from collections import Counter
from collections.abc import Callable
from functools import cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from sievework.operators.filters import Rule, at_least, at_most, within


def per_text(function: Callable[[str], float | None], kind=DoubleType) -> Callable[[Column], Column]:
    """A Column function of a Python function of one text; null stays null."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else function(t) for t in texts], dtype="object")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind())


def top_ngram_share(text: str, n: int) -> float:
    """Share of characters gone when the most frequent n-gram, joined by single spaces, is removed; of equally frequent
    ones, the first. 1.0 for fewer than n words."""
    words = text.split()
    if len(words) < n:
        return 1.0
    counts = Counter(zip(*(words[i:] for i in range(n)), strict=False))
    top = " ".join(max(counts, key=counts.__getitem__))
    return (len(text) - len(text.replace(top, ""))) / len(text)


def duplicate_ngram_share(text: str, n: int) -> float:
    """Share of characters in n-grams met before; words that the n-gram before has counted aren't counted again."""
    words = text.split()
    if len(words) < n:
        return 1.0
    sizes, seen, total, fresh_from = [len(w) for w in words], set(), 0, 0
    for at, gram in enumerate(zip(*(words[i:] for i in range(n)), strict=False)):
        if gram in seen:
            first = max(fresh_from, at)  # words of the gram before this one are counted
            total += sum(sizes[first : at + n]) + min(n - (first - at), n - 1)
            fresh_from = at + n
        seen.add(gram)
    return total / len(text)


def repeating_top_ngrams(n: int = 2, max_ratio: float = 0.2) -> Rule:
    return Rule(f"repeating_top_{n}grams", per_text(lambda t: top_ngram_share(t, n)), at_most(max_ratio))


def repeating_duplicate_ngrams(n: int = 2, max_ratio: float = 0.2) -> Rule:
    return Rule(f"repeating_dup_{n}gram", per_text(lambda t: duplicate_ngram_share(t, n)), at_most(max_ratio))


def python_comment_share(source: str) -> float | None:
    """Characters of comments and docstrings to all; 0 for source that can't be parsed."""
    if not source:
        return None
    try:
        tree = ast.parse(source)
        comments = [t.string for t in tokenize.generate_tokens(io.StringIO(source).readline) if t.type == tokenize.COMMENT]
    except (SyntaxError, ValueError, tokenize.TokenError, RecursionError, MemoryError):
        return 0.0
    docs = []
    for node in ast.walk(tree):
        if isinstance(node, ast.Module | ast.ClassDef | ast.FunctionDef | ast.AsyncFunctionDef):
            doc = ast.get_docstring(node)
            if doc:
                docs.append(doc)
    return (len("\n".join(comments)) + len("\n".join(docs))) / len(source)


def python_comments(low: float = 0.01, high: float = 0.85) -> Rule:
    return Rule("python_comment_ratio", per_text(python_comment_share), within(low, high))


#: Comment syntax of languages: (line marks, block marks), and the marks of strings in which neither counts.
COMMENTS: dict[str, tuple[tuple[str, ...], tuple[tuple[str, str], ...]]] = {
    **dict.fromkeys(("c", "c++", "cpp", "java", "javascript", "typescript", "go", "rust", "scala", "kotlin", "swift", "c-sharp", "php"), (("//",), (("/*", "*/"),))),
    **dict.fromkeys(("shell", "bash", "ruby", "perl", "r", "yaml", "makefile"), (("#",), ())),
    **dict.fromkeys(("html", "xml"), ((), (("<!--", "-->"),))),
    "sql": (("--",), (("/*", "*/"),)),
    "lua": (("--",), (("--[[", "]]"),)),
    "haskell": (("--",), (("{-", "-}"),)),
    "css": ((), (("/*", "*/"),)),
}
#: Score of source whose comments can't be told: above every limit.
UNREADABLE = 9999.0


def comment_share(source: str, language: str) -> float | None:
    """Characters in comments to all, by a lexer of line comments, block comments and quoted strings."""
    if not source:
        return None
    if language.lower() not in COMMENTS:
        return UNREADABLE
    line_marks, blocks = COMMENTS[language.lower()]
    at = total = 0
    quotes = "" if language.lower() in ("html", "xml") else "\"'`"
    while at < len(source):
        block = next((b for b in blocks if source.startswith(b[0], at)), None)
        if block:
            end = source.find(block[1], at + len(block[0]))
            if end < 0:
                return UNREADABLE
            total += end - at - len(block[0])
            at = end + len(block[1])
        elif mark := next((m for m in line_marks if source.startswith(m, at)), None):
            end = source.find("\n", at)
            end = len(source) if end < 0 else end
            total += end - at - len(mark)
            at = end
        elif source[at] in quotes:
            end = at + 1
            while end < len(source) and source[end] != source[at] and (source[at] == "`" or source[end] != "\n"):
                end += 2 if source[end] == "\\" else 1
            at = end + 1
        else:
            at += 1
    return total / len(source)


def comments(language: str, low: float = 0.01, high: float = 0.85) -> Rule:
    return Rule("comment_ratio", per_text(lambda s: comment_share(s, language)), within(low, high))


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def visible_text(html: str) -> str:
    parser = _Visible()
    parser.feed(html)
    parser.close()
    return "".join(parser.parts)


def html_boilerplate(min_ratio: float = 0.2, min_chars: int = 100) -> Rule:
    def score(html: str) -> float | None:
        text = visible_text(html)
        return None if not html else 0.0 if len(text) < min_chars else len(text) / len(html)

    return Rule("html_boilerplate", per_text(score), at_least(min_ratio))


@cache
def sentence_piece(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def tokenizer_fertility(path: str, least: float = 2.5) -> Rule:
    """Characters a token; -1 without tokens."""

    def score(text: str) -> float:
        n = len(sentence_piece(path).encode(text))
        return len(text) / n if n else -1.0

    return Rule("tokenizer_fertility", per_text(score), at_least(least))


@cache
def tokenizer_file(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_count(tokenizer: str | Callable[[list[str]], list[int]], low: float = 0, high: float = float("inf")) -> Rule:
    """Tokens of each text, by a tokenizer file or a function of a batch that gives counts."""

    def run(texts: pd.Series) -> pd.Series:
        batch = [t or "" for t in texts]
        counts = tokenizer(batch) if callable(tokenizer) else [len(e.ids) for e in tokenizer_file(tokenizer).encode_batch(batch)]
        return pd.Series([None if t is None else n for t, n in zip(texts, counts, strict=True)], dtype="Int64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return Rule("token_count", F.pandas_udf(run, LongType()), within(low, high))
