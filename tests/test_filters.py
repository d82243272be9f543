"""Filters against plain Python formulas, on edge cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.operators import filters as R
from sievework.operators import harness
from sievework.operators import python_filters as P

TEXTS = [
    None,
    "",
    "   ",
    "\x1c\x85\xa0 　",
    "plain words and the rest, to be sure.",
    "• one\n‣ two\nthree...\n\n [...]\n",
    "## ### ###a #\n… (...)",
    "see https://porn.example.com/x and http://a.b/<c> 12345",
    "same line\nsame line\nother\n\nsame line\nsame line",
    "Terms of use\n\nkept\n\nPrivacy Policy",
    "a Lorem Ipsum b",
    "😀 é ß 中文 {x} [y] (z) ⟨q⟩",
    "x" * 1200,
    "a b a b a b a b c d",
    '"quoted"',
]


def words(t):
    return t.split()


def lines(t):
    return [s for s in t.split("\n") if s.strip()]


def share(part, whole, empty=None):
    return empty if whole == 0 else part / whole


PLAIN = {
    R.non_alphanumeric(): lambda t: share(len(t) - len(re.findall("[a-zA-Z0-9\n?!,.]", t)), len(t), 1.0),
    R.symbols_to_words(): lambda t: share(sum(w in R.ELLIPSES or len(re.findall("#+", w)) / len(w) > 0.5 for w in words(t)), len(words(t))),
    R.numbers(): lambda t: share(len(re.findall("[0-9]", t)), len(t), 1.0),
    R.url_share(): lambda t: share(sum(len(u) for u in re.findall(r"https?://(?:[A-Za-z0-9$\-_@.&+/:=?#~]|[!*\(\),]|(?:%[0-9A-Fa-f]{2}))+", t)), len(t), 1.0),
    R.bullets(): lambda t: share(sum(s.strip()[0] in R.BULLETS for s in lines(t)), len(lines(t))),
    R.white_space(): lambda t: share(sum(c in "\t\n\r\b " for c in t), len(t), 1.0),
    R.parentheses(): lambda t: share(sum(c in "{}⟨⟩[]()" for c in t), len(t), 1.0),
    R.long_words(): lambda t: max(map(len, words(t)), default=None),
    R.word_count(): lambda t: len(words(t)),
    R.mean_word_length(): lambda t: share(sum(map(len, words(t))), len(words(t))),
    R.punctuation(): lambda t: share(sum(not s.strip().endswith(R.END_MARKS) for s in lines(t)), len(lines(t))),
    R.ellipsis(): lambda t: share(sum(s.strip().lower().endswith(tuple(R.ELLIPSES)) for s in lines(t)), len(lines(t))),
    R.common_words(): lambda t: min(2, sum(w in R.COMMON_WORDS for w in words(t))),
    R.words_with_letters(): lambda t: share(sum(any(c.isalpha() for c in w) for w in words(t)), len(words(t))),
    R.repeated_lines(): lambda t: share(len(set(lines(t))), len(lines(t))),
    R.repeated_paragraphs(): lambda t: len(set(t.split("\n\n"))) / len(t.split("\n\n")),
    R.repeated_lines_by_char(): lambda t: share(sum(map(len, set(lines(t)))), sum(map(len, lines(t)))),
    R.repeated_paragraphs_by_char(): lambda t: share(sum(map(len, set(t.split("\n\n")))), sum(map(len, t.split("\n\n")))),
    R.lines_of_code(): lambda t: t.count("\n") + 1,
}


def test_scores_are_the_plain_formulas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    rules = list(PLAIN)
    rows = df.select("id", *[r.score(F.col("text")).alias(f"s{k}") for k, r in enumerate(rules)]).collect()
    for row in rows:
        for k, rule in enumerate(rules):
            text = TEXTS[row.id]
            want = None if text is None else PLAIN[rule](text)
            assert row[f"s{k}"] == (want if want is None else pytest.approx(want)), (rule.name, text)


def test_flags(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = lambda rule: [r[0] for r in df.select(rule.score(F.col("text"))).collect()]
    assert got(R.pornographic_urls())[7] == 1 and got(R.pornographic_urls())[4] == 0
    assert got(R.boilerplate())[9:11] == [pytest.approx(2 / 3), 1.0]
    assert got(R.substring("plain", "prefix"))[4] == 1 and got(R.substring("plain", "suffix"))[4] == 0
    with pytest.raises(ValueError):
        R.substring("x", "middle")


def test_ngram_filters():
    assert P.top_ngram_share("one", 2) == 1.0
    text = "a b a b a b a b c d"
    assert P.top_ngram_share(text, 2) == pytest.approx(4 * 3 / len(text))

    def plain(t, n):
        grams, seen, total, over = list(zip(*(t.split()[i:] for i in range(n)), strict=False)), Counter(), 0, 0
        for g in grams:
            seen[g] += 1
            if seen[g] > 1:
                total += sum(len(w) for w in g[over:]) + min(n - over, n - 1)
                over = n
            over = max(over - 1, 0)
        return total / len(t)

    for t in (text, "x y z x y z x y", "a a a a a a", "the cat the cat sat the cat sat on"):
        for n in (2, 3, 5):
            if len(t.split()) >= n:
                assert P.duplicate_ngram_share(t, n) == pytest.approx(plain(t, n)), (t, n)


def test_parsers():
    assert P.python_comment_share("x = (") == 0.0
    assert P.python_comment_share('"""doc"""\nx = 1  # note\n') == pytest.approx((3 + 6) / 25, abs=0.02)
    assert P.comment_share('a = "// no"; // yes\n/* b */', "java") == pytest.approx((4 + 3) / 27)
    assert P.comment_share("x", "nothing-known") == P.UNREADABLE
    assert P.visible_text("<p>a<script>b</script>c</p>") == "ac"


def test_harness(spark):
    df = spark.createDataFrame([("banana",), ("aaaaa e e",), ("none",), (None,)], "documents string")
    count = lambda letter, least: R.Rule(letter, lambda t: F.regexp_count(t, F.lit(letter)), R.at_least(least))
    kept = harness.score_filter(df, [count("a", 3), count("e", 2)], "documents", ["a", "e"]).collect()
    assert [tuple(r) for r in kept] == [("aaaaa e e", 5, 2)]
    assert harness.score_filter(df, count("a", 3), "documents", invert=True).count() == 1
    scored = harness.score(df, [count("a", 3)], "n", "documents")
    assert harness.select(scored, count("a", 3), "n").count() == 2
    with pytest.raises(ValueError):
        harness.score(df, [count("a", 1), count("e", 1)], "n", "documents")
    with pytest.raises(ValueError):
        harness.score(df, count("a", 1), "n", "missing")
    both = harness.modify(df, lambda a, b: F.concat(a, b), [["documents", "documents"]], "twice")
    assert both.first().twice == "bananabanana"
    assert harness.preserve_by_value(scored, "n", 3, "ge").count() == 2
