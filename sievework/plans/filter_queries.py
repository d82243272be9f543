"""A query for each document filter over ``documents``: doc_id, score, kept; with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import filters as R
from sievework.operators import python_filters as P
from sievework.operators.harness import score_filter
from sievework.plans.tables import table

#: White space for DuckDB's regular expressions.
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORDS = f"list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


LINES = f"list_filter(string_split(text, chr(10)), lambda s: {strip('s')} <> '')"
PARAGRAPHS = "string_split(text, chr(10) || chr(10))"
N = "length(text)"


def quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def many(pattern: str, of: str = "text") -> str:
    return f"len(regexp_extract_all({of}, '{pattern}'))"


def share(part: str, whole: str, empty: str = "NULL") -> str:
    return f"CASE WHEN {whole} = 0 THEN {empty} ELSE ({part})::DOUBLE / ({whole}) END"


def share_of(items: str, test: str) -> str:
    return share(f"len(list_filter({items}, lambda x: {test}))", f"len({items})")


def length_of(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: length(x))), 0)"


URL = r"https?://(?:[A-Za-z0-9$\-_@.&+/:=?#~]|[!*\(\),]|(?:%[0-9A-Fa-f]{2}))+"
POLICY = f"len(list_filter({quoted(R.POLICIES)}, lambda p: contains(lower(x), p))) > 0"

#: name: (rule, SQL of its score, SQL of its test of score)
FILTERS: dict[str, tuple[R.Rule, str, str]] = {
    "non_alphanumeric": (R.non_alphanumeric(), share(f"{N} - {many('[a-zA-Z0-9' + chr(92) + 'n?!,.]')}", N, "1.0"), "score <= 0.25"),
    "symbols_to_words": (R.symbols_to_words(), share_of(WORDS, f"list_contains({quoted(R.ELLIPSES)}, x) OR len(regexp_extract_all(x, '#+')) * 2 > length(x)"), "score <= 0.1"),
    "numbers": (R.numbers(), share(many("[0-9]"), N, "1.0"), "score <= 0.15"),
    "urls": (R.url_share(), share(length_of(f"regexp_extract_all(text, '{URL}')"), N, "1.0"), "score <= 0.2"),
    "bullets": (R.bullets(), share_of(LINES, f"regexp_matches(x, '^{WS}*[{R.BULLETS}]')"), "score <= 0.9"),
    "white_space": (R.white_space(), share(many(r"[\t\n\r\x08 ]"), N, "1.0"), "score <= 0.25"),
    "parentheses": (R.parentheses(), share(many(r"[{}⟨⟩\[\]()]"), N, "1.0"), "score <= 0.1"),
    "long_words": (R.long_words(), f"list_max(list_transform({WORDS}, lambda w: length(w)))::INTEGER", "score <= 1000"),
    "word_count": (R.word_count(), f"len({WORDS})::INTEGER", "score BETWEEN 50 AND 100000"),
    "boilerplate": (R.boilerplate(), f"CASE WHEN contains(lower(text), 'lorem ipsum') THEN 1.0 ELSE {share_of(PARAGRAPHS, POLICY)} END", "score <= 0.4"),
    "mean_word_length": (R.mean_word_length(), share(length_of(WORDS), f"len({WORDS})"), "score BETWEEN 3 AND 10"),
    "punctuation": (R.punctuation(), share_of(LINES, f"right({strip('x')}, 1) NOT IN ('.', '?', '!', '\"', '''')"), "score <= 0.85"),
    "ellipsis": (R.ellipsis(), share_of(LINES, f"len(list_filter({quoted(R.ELLIPSES)}, lambda m: ends_with(lower({strip('x')}), m))) > 0"), "score <= 0.3"),
    "common_words": (R.common_words(), f"least(len(list_filter({WORDS}, lambda w: list_contains({quoted(R.COMMON_WORDS)}, w))), 2)::INTEGER", "score >= 2"),
    "words_with_letters": (R.words_with_letters(), share_of(WORDS, r"regexp_matches(x, '\p{L}')"), "score >= 0.8"),
    "pornographic_urls": (R.pornographic_urls(), f"(len(list_filter(regexp_extract_all(text, '{URL}'), lambda u: contains(u, 'porn'))) > 0)::INTEGER", "score <> 1"),
    "substring": (R.substring("the", "any"), "contains(text, 'the')::INTEGER", "score = 1"),
    "repeated_lines": (R.repeated_lines(), share(f"len(list_distinct({LINES}))", f"len({LINES})"), "score >= 0.7"),
    "repeated_paragraphs": (R.repeated_paragraphs(), share(f"len(list_distinct({PARAGRAPHS}))", f"len({PARAGRAPHS})"), "score >= 0.7"),
    "repeated_lines_by_char": (R.repeated_lines_by_char(), share(length_of(f"list_distinct({LINES})"), length_of(LINES)), "score >= 0.8"),
    "repeated_paragraphs_by_char": (R.repeated_paragraphs_by_char(), share(length_of(f"list_distinct({PARAGRAPHS})"), length_of(PARAGRAPHS)), "score >= 0.8"),
    "histogram": (R.histogram("abcdefghijklmnopqrstuvwxyz ,.'\n"), f"({share(many(r'[a-z ,.' + chr(39) * 2 + chr(92) + 'n]', strip('text')), N)} > 0.8)::INTEGER", "score = 1"),
    "lines_of_code": (R.lines_of_code(), f"({many(chr(92) + 'n')} + 1)::INTEGER", "score BETWEEN 10 AND 20000"),
    "xml_header": (R.xml_header(), "contains(substring(text, 1, 100), '<?xml version=')::INTEGER", "score <> 1"),
    "alphabetic": (R.alphabetic(), share(many(r"\p{L}"), N), "score >= 0.25"),
    "per_extension": (R.per_extension(R.ExtensionLimits(True, 1500, 0.6, 0.4)), f"(list_max(list_transform(string_split(text, chr(10)), lambda s: length(s))) <= 1500 AND ({N} + 1)::DOUBLE / len(string_split(text, chr(10))) - 1 <= 100 AND {share(many('[a-zA-Z0-9' + chr(92) + 'n?!,.]'), N)} >= 0.6 AND {many(chr(92) + 'p{L}')} >= 0.4 * {N})::INTEGER", "score <> 0"),
}

#: Filters that SQL can't express: a running state or a parser.
PYTHON_FILTERS: dict[str, R.Rule] = {
    **{f"repeating_top_{n}grams": P.repeating_top_ngrams(n) for n in (2, 3, 4)},
    **{f"repeating_duplicate_{n}grams": P.repeating_duplicate_ngrams(n) for n in (5, 10)},
    "python_comments": P.python_comments(),
    "general_comments": P.comments("java"),
    "html_boilerplate": P.html_boilerplate(),
    "token_count": P.token_count(lambda texts: [len(t.split()) for t in texts], 50, 100_000),
}


def _scored(rule: R.Rule):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents").select("doc_id", rule.score(F.col("text")).alias("score"))
        return docs.withColumn("kept", F.coalesce(rule.keep(F.col("score")), F.lit(False)))

    return query


#: The flagship: a chain that drops as it goes, scores kept.
CHAIN = ["non_alphanumeric", "word_count", "mean_word_length", "punctuation", "repeated_lines", "common_words"]


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_filter(docs, [FILTERS[n][0] for n in CHAIN], score_field=CHAIN).drop("text")


QUERIES = {f"filter_{n}": _scored(r) for n, (r, _, _) in FILTERS.items()} | {f"filter_{n}": _scored(r) for n, r in PYTHON_FILTERS.items()} | {"filter_chain": chain}
ORACLE_SQL = {f"filter_{n}": f"SELECT doc_id, score, coalesce({keep}, false) AS kept FROM (SELECT doc_id, {score} AS score FROM documents)" for n, (_, score, keep) in FILTERS.items()}
ORACLE_SQL["filter_chain"] = "SELECT * FROM (SELECT doc_id, " + ", ".join(f"{FILTERS[n][1]} AS {n}" for n in CHAIN) + " FROM documents) WHERE " + " AND ".join(FILTERS[n][2].replace("score", n) for n in CHAIN)
ORACLE_SQL["filter_token_count"] = f"SELECT doc_id, score, coalesce(score BETWEEN 50 AND 100000, false) AS kept FROM (SELECT doc_id, len({WORDS})::BIGINT AS score FROM documents)"
