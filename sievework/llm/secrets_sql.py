"""The secret scan as DuckDB SQL, with the Markov model counted here from the same labelled samples."""

from __future__ import annotations

import math
import string
from collections import Counter

from sievework.llm.secrets import LEAST, labelled_samples


def _model() -> dict[str, float]:
    counts: Counter = Counter()
    for text, kind in labelled_samples():
        counts.update((kind, pair) for pair in zip(text, text[1:], strict=False))
    alphabet = string.ascii_letters + string.digits + "+/_=-"
    total = {(k, a): sum(counts[k, (a, b)] for b in alphabet) + len(alphabet) for k in (0, 1) for a in alphabet}
    share = lambda k, a, b: (counts[k, (a, b)] + 1) / total[k, a]
    return {a + b: round(math.log(share(1, a, b) / share(0, a, b)), 4) for a in alphabet for b in alphabet}


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_KEYS = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")), f"{_any_case('api')}_?{_any_case('key')}"])
_ASSIGN = rf"""({_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans(pattern: str, kind: str, rank: int, group: int = 0, least: int = 0) -> str:
    hits = f"regexp_extract_all(text, '{pattern}')"
    return f"""SELECT id, '{kind}' AS kind, {rank} AS rank, s AS a, s + length(hit) AS b, hit FROM (
  SELECT id, hit, part, sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit) AS s FROM (
    SELECT id, unnest(string_split_regex(text, '{pattern}')[:len({hits})]) AS gap, unnest({hits}) AS hit,
           unnest(regexp_extract_all(text, '{pattern}', {group})) AS part, generate_subscripts({hits}, 1) AS n
    FROM t WHERE regexp_matches(text, '{pattern}')) WINDOW w AS (PARTITION BY id ORDER BY n)) WHERE length(part) >= {least}"""


def oracle() -> str:
    model = ", ".join(f"('{pair}', {ratio})" for pair, ratio in _model().items())
    count = lambda kind: f"(SELECT count(*) FROM base b WHERE b.id = t.id AND b.kind = '{kind}') AS n_{kind}"
    listed = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS s"
    return f"""WITH t AS (SELECT doc_id AS id, coalesce(text, '') AS text FROM documents), model(pair, ratio) AS (VALUES {model}),
base AS ({_spans(_ASSIGN, "assign", 0, 2, 8)} UNION ALL {_spans("AKIA[A-Z0-9]{12,}", "access", 1)} UNION ALL {_spans("[0-9a-f]{32,}", "hex", 2)}),
cand AS ({_spans("[A-Za-z0-9+/_=-]{20,}", "markov", 3)}),
pairs AS (SELECT id, a, unnest(list_transform(range(1, length(hit)), lambda i: substr(hit, i, 2))) AS pair FROM cand
          WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')),
rated AS (SELECT id, a FROM pairs JOIN model USING (pair) GROUP BY id, a HAVING round(sum(ratio), 4) >= {LEAST}),
extra AS (SELECT c.* FROM cand c JOIN rated r ON r.id = c.id AND r.a = c.a
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.id = c.id AND b.a < c.b AND c.a < b.b)),
fixed AS (SELECT id, {listed} FROM base GROUP BY id),
found AS (SELECT id, {listed} FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY id)
SELECT id AS doc_id, {count("assign")}, {count("access")}, {count("hex")}, sha256(coalesce(l.s, '')) AS base_sha256, coalesce(e.s, '') AS spans
FROM t LEFT JOIN fixed l USING (id) LEFT JOIN found e USING (id)"""
