"""Acquisition and extraction: URL lists, downloads, archives, HTML, wiki markup, TeX, notebooks.

An extractor is a Python function of a record; :func:`sievework.sources.readers.read_records` runs it over files.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A few frequent words of each language, from which stop-word densities are counted.
STOP_WORDS: dict[str, frozenset[str]] = {
    "en": frozenset("a about after all also an and any are as at be because been but by can could did do for from had has have he her his how i if in into is it its more my no not of on one or other our out she so some such than that the their them then there these they this to up was we were what when which who will with would you your".split()),
    "de": frozenset("aber als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sein sich sie sind so und um unter uns von vor war was werden wie wir wird zu zum zur über".split()),
    "fr": frozenset("au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous à été".split()),
    "es": frozenset("a al como con de del el ella en es esta este fue ha la las lo los más no o para pero por que se sin sobre su sus también un una y ya".split()),
}
#: Languages written without blanks, whose stop-word density isn't tested: fixed values.
UNSPACED = frozenset({"zh", "ja", "th", "ko"})


def urls_frame(spark: SparkSession, urls: list[str], limit: int | None = None) -> DataFrame:
    return spark.createDataFrame([(u,) for u in urls[:limit]], "url string")


def weekly_snapshots(start: str, end: str) -> list[str]:
    """``YYYY-WW`` weeks from start to end, both included."""
    at, last = (date.fromisocalendar(int(w[:4]), int(w[5:]), 1) for w in (start, end))
    if last < at:
        raise ValueError(f"{end} is before {start}")
    out = []
    while at <= last:
        year, week, _ = at.isocalendar()
        out.append(f"{year}-{week:02d}")
        at += timedelta(days=7)
    return out


def monthly_snapshots(start: str, end: str) -> list[str]:
    """``YYYY-MM`` months from start to end, both included."""
    (y, m), last = map(int, start.split("-")), tuple(map(int, end.split("-")))
    if last < (y, m):
        raise ValueError(f"{end} is before {start}")
    out = []
    while (y, m) <= last:
        out.append(f"{y}-{m:02d}")
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


def crawl_path_lists(start: str, end: str, news: bool = False, prefix: str = "https://data.commoncrawl.org", known: list[str] | None = None) -> list[str]:
    """Addresses of the lists of a public web crawl's archive files, for weeks or, of news, months. Crawls exist for some
    weeks alone: ``known`` has the names that the crawl's published index lists (CC-MAIN-YYYY-WW), which others are
    left out by."""
    if news:
        return [f"{prefix}/crawl-data/CC-NEWS/{s[:4]}/{s[5:]}/warc.paths.gz" for s in monthly_snapshots(start, end)]
    names = [f"CC-MAIN-{s}" for s in weekly_snapshots(start, end)]
    return [f"{prefix}/crawl-data/{n}/warc.paths.gz" for n in names if known is None or n in set(known)]


def download(df: DataFrame, fetch: Callable[[str], bytes], url_field: str = "url", out: str = "content", drop_failed: bool = True) -> DataFrame:
    """Bytes of each address by an adapter; unreachable ones are null or dropped."""

    def run(urls: pd.Series) -> pd.Series:
        def one(u):
            try:
                return fetch(u)
            except Exception:  # an address that fails is a null
                return None

        return pd.Series([one(u) for u in urls], dtype="object")

    run.__annotations__ = {"urls": pd.Series, "return": pd.Series}
    got = df.withColumn(out, F.pandas_udf(run, "binary")(url_field))
    return got.where(F.col(out).isNotNull()) if drop_failed else got


WARC_SCHEMA = "url string, warc_id string, source_id string, content binary"


def iterate_warc(path: str, raw: bytes) -> Iterator[dict]:
    """Responses of a WARC file, plain or in gzip members: url, id, file, body after the HTTP header."""
    import gzip
    import io

    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline().strip()):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        block = stream.read(int(head.get("content-length", 0)))
        if head.get("warc-type") == "response":
            body = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
            yield {"url": head.get("warc-target-uri"), "warc_id": head.get("warc-record-id", "").strip("<>").removeprefix("urn:uuid:"), "source_id": path.rpartition("/")[2], "content": body}


def decode(raw: bytes) -> str | None:
    """Text of bytes as UTF-8, else in the encoding that the page names, else Windows-1252; None for binary data."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        named = re.search(rb"charset=[\"']?([\w-]+)", raw[:2048])
        for name in (named[1].decode() if named else None, "cp1252"):
            try:
                if name:
                    return raw.decode(name)
            except (UnicodeDecodeError, LookupError):
                continue
    return None


def without_control_characters(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{C}", "")


_BLOCKS = frozenset("address article aside blockquote body br caption center col colgroup dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section table tbody td textarea tfoot th thead tr ul".split())
_HIDDEN = frozenset("script style noscript template head svg iframe".split())


class _Blocks(HTMLParser):
    """Blocks of visible text: (text, characters in links, is a heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = 0
        self.heading = False
        self.title = ""
        self.in_title = False

    def _close(self):
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((text, self.linked, self.heading))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.in_title = tag == "title" or (self.in_title and tag not in _BLOCKS)
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag == "body":
            self.hidden = 0
        if tag in _BLOCKS:
            self._close()
            self.heading = bool(re.fullmatch("h[1-6]", tag))
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in _HIDDEN and self.hidden:
            self.hidden -= 1
        if tag in _BLOCKS:
            self._close()
            self.heading = False
        if tag == "a" and self.links:
            self.links -= 1

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.hidden:
            self.parts.append(data)
            self.linked += len(data.strip()) * bool(self.links)


def blocks(html: str) -> list[tuple[str, int, bool]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser._close()
    return parser.blocks


def title(html: str) -> str:
    parser = _Blocks()
    parser.feed(html)
    return re.sub(r"\s+", " ", parser.title).strip()


def stop_word_share(text: str, stop_words: frozenset[str]) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in stop_words for w in words) / len(words) if words else 0.0


def classify_blocks(found: list[tuple[str, int, bool]], stop_words: frozenset[str], short: int = 70, long: int = 200, low: float = 0.3, high: float = 0.32, most_links: float = 0.2, heading_distance: int = 200, headings: bool = True) -> list[bool]:
    """Which blocks are main text, by the published stop-word method: first each by its length, links and stop words, then
    short and doubtful ones by their neighbours, and headings by the text that follows."""
    kinds = []
    for text, linked, _ in found:
        share = stop_word_share(text, stop_words)
        if linked / len(text) > most_links or "©" in text or "&copy" in text:
            kinds.append("bad")
        elif len(text) < short:
            kinds.append("bad" if linked else "short")
        elif share >= high:
            kinds.append("good" if len(text) > long else "near")
        else:
            kinds.append("near" if share >= low else "bad")
    first = list(kinds)

    def neighbour(i: int, step: int, skip: tuple[str, ...]) -> str:
        i += step
        while 0 <= i < len(kinds):
            if kinds[i] not in skip:
                return kinds[i]
            i += step
        return "bad"

    def lift_headings(source: list[str], new: str, on: str) -> None:
        for i, (_, _, heading) in enumerate(found):
            if not (headings and heading and kinds[i] == on):
                continue
            distance = 0
            for j in range(i + 1, len(found)):
                if distance > heading_distance:
                    break
                if source[j] == "good":
                    kinds[i] = new
                    break
                distance += len(found[j][0])

    lift_headings(kinds, "near", "short")
    settled = list(kinds)
    for i, kind in enumerate(kinds):
        if kind == "short":
            around = {neighbour(i, -1, ("short", "near")), neighbour(i, 1, ("short", "near"))}
            beside = {neighbour(i, -1, ("short",)), neighbour(i, 1, ("short",))}
            settled[i] = "good" if around == {"good"} else "bad" if around == {"bad"} else ("good" if "near" in beside else "bad")
    kinds[:] = settled
    for i, kind in enumerate(kinds):
        if kind == "near":
            kinds[i] = "bad" if {neighbour(i, -1, ("near",)), neighbour(i, 1, ("near",))} == {"bad"} else "good"
    for i in range(len(kinds)):
        if first[i] != "bad" and found[i][2] and headings and kinds[i] == "bad":
            kinds[i] = "short"
    lift_headings(list(kinds), "good", "short")
    return [k == "good" for k in kinds]


def main_text(html: str, lang: str = "en", **limits) -> str | None:
    """Main text of a page, its paragraphs apart by an empty line; None where there is none."""
    found = blocks(html)
    good = classify_blocks(found, STOP_WORDS.get(lang, STOP_WORDS["en"]), **limits)
    return "\n\n".join(b[0] for b, g in zip(found, good, strict=True) if g) or None


def dense_text(html: str, lang: str = "en", least: float = 0.32) -> str | None:
    """Blocks of a page in which stop words are frequent; all, in languages without blanks."""
    stop = STOP_WORDS.get(lang, STOP_WORDS["en"])
    return "\n\n".join(t for t, _, _ in blocks(html) if lang in UNSPACED or stop_word_share(t, stop) >= least) or None


#: Extraction algorithms by name; others are registered as adapters.
ALGORITHMS: dict[str, Callable[..., str | None]] = {"blocks": main_text, "density": dense_text}


def guess_language(text: str) -> str:
    """The language whose stop words are most frequent; en where none is."""
    return max(STOP_WORDS, key=lambda k: (stop_word_share(text, STOP_WORDS[k]), k == "en"))


def extract_html(df: DataFrame, html_field: str = "html", algorithm: str = "blocks", language_field: str | None = None, **options) -> DataFrame:
    """``df`` with ``language`` and ``text`` of each page; pages without text are dropped. Bytes are decoded first."""
    function = ALGORITHMS[algorithm]

    def run(pages: pd.Series, languages: pd.Series) -> pd.DataFrame:
        rows = []
        for page, lang in zip(pages, languages, strict=True):
            html = decode(page) if isinstance(page, bytes) else page
            if not html:
                rows.append((None, None))
                continue
            lang = lang or guess_language(" ".join(b[0] for b in blocks(html)))
            rows.append((lang, function(html, lang, **options)))
        return pd.DataFrame(rows, columns=["language", "text"])

    run.__annotations__ = {"pages": pd.Series, "languages": pd.Series, "return": pd.DataFrame}
    language = F.col(language_field) if language_field else F.lit(None).cast("string")
    out = df.withColumn("_x", F.pandas_udf(run, "language string, text string")(html_field, language))
    return out.withColumn("language", F.col("_x.language")).withColumn("text", F.col("_x.text")).drop("_x").where("text IS NOT NULL")


#: Elements whose text isn't shown, and those that begin a line of their own: fixed values.
_HIDDEN = {"script", "style", "head", "template", "noscript"}
_BLOCKS = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"}


def visible_text(page: str) -> str:
    """All text that a page shows, as a text browser has it: a line for each block, blanks collapsed, list items marked."""
    lines, hidden = [[]], [0]

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attributes):
            hidden[0] += tag in _HIDDEN
            if tag in _BLOCKS:
                lines.append(["* "] if tag == "li" else [])

        def handle_endtag(self, tag):
            hidden[0] = max(0, hidden[0] - (tag in _HIDDEN))
            if tag in _BLOCKS:
                lines.append([])

        def handle_data(self, data):
            if not hidden[0]:
                lines[-1].append(data)

    reader = Reader(convert_charrefs=True)
    reader.feed(page)
    reader.close()
    shown = (" ".join("".join(x).split()) for x in lines)
    return "\n".join(x for x in shown if x not in ("", "*"))


def shown_text(html: Column) -> Column:
    """:func:`visible_text` of a column; null stays null."""

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else visible_text(p) for p in pages], dtype="object")

    run.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(html)


def read_wiki_dump(spark: SparkSession, path: str, language: str = "en") -> DataFrame:
    """``(title, id, url, text)`` of a dump's articles in a language's wiki: pages of namespace 0 that aren't redirects.
    Read as XML, bz2 too."""
    schema = "title string, ns int, id long, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.where("ns = 0 AND redirect IS NULL AND revision.text._VALUE IS NOT NULL").select("title", "id", F.concat(F.lit(f"https://{language}.wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_"))).alias("url"), F.col("revision.text._VALUE").alias("text"))


def _balanced(text: str, opening: str, closing: str, keep: Callable[[str], str]) -> str:
    """``text`` with each outermost bracketed part replaced by ``keep`` of its inside."""
    out, depth, start, at = [], 0, 0, 0
    while at < len(text):
        if text.startswith(opening, at):
            if depth == 0:
                out.append(text[start:at])
                start = at + len(opening)
            depth, at = depth + 1, at + len(opening)
        elif depth and text.startswith(closing, at):
            depth, at = depth - 1, at + len(closing)
            if depth == 0:
                out.append(keep(text[start : at - len(closing)]))
                start = at
        else:
            at += 1
    return "".join(out) + (text[start:] if depth == 0 else "")


#: Prefixes of links to media and categories, in the four languages at hand: fixed values.
_MEDIA = ("file:", "image:", "category:", "datei:", "bild:", "kategorie:", "fichier:", "catégorie:", "archivo:", "imagen:", "categoría:")


def wiki_text(markup: str) -> str:
    """Plain text of wiki markup: without templates, tables, references, tags, media and categories; links as their labels."""
    text = re.sub(r"<!--.*?-->", "", markup, flags=re.S)
    text = re.sub(r"<ref[^>/]*/>|<ref.*?</ref>", "", text, flags=re.S | re.I)
    text = re.sub(r"<(math|code|syntaxhighlight|gallery|table|timeline).*?</\1>", "", text, flags=re.S | re.I)
    text = _balanced(text, "{{", "}}", lambda _: "")
    text = _balanced(text, "{|", "|}", lambda _: "")
    for _ in range(2):  # labels of media hold links of their own
        text = _balanced(text, "[[", "]]", lambda x: "" if x.lower().startswith(_MEDIA) else x.rpartition("|")[2])
    text = re.sub(r"\[https?://\S+ ?([^\]]*)\]", r"\1", text)
    text = re.sub(r"</?\w[^>]*>", "", text)
    text = re.sub(r"'{2,5}", "", text)
    parts = re.split(r"^=+\s*(.*?)\s*=+\s*$", text, flags=re.M)
    return "\n\n".join(p for p in (re.sub(r"\n{2,}", "\n", x).strip() for x in parts) if p)


def tex_text(files: list[str]) -> str | None:
    """Body of TeX sources: from the first section on, without comments, appendix and bibliography, own macros without
    arguments written out."""
    macros: dict[str, str] = {}
    for f in files:
        for name, body in re.findall(r"\\(?:newcommand|renewcommand)\*?\s*\{?\\([A-Za-z]+)\}?\s*\{((?:[^{}]|\{[^{}]*\})*)\}", f):
            macros[name] = body
        for name, body in re.findall(r"\\def\s*\\([A-Za-z]+)\s*\{((?:[^{}]|\{[^{}]*\})*)\}", f):
            macros[name] = body
    out = []
    for f in files:
        start = re.search(r"^\s*\\(?:chapter|section|subsection|part)\b", f, re.M)
        if not start:
            continue
        body = f[start.start() :]
        body = re.split(r"\\appendix\b|\\begin\{thebibliography\}|\\bibliography\{|\\begin\{references\}", body)[0]
        body = re.sub(r"(?m)^%.*\n?", "", body)
        body = re.sub(r"(?m)(?<!\\)%.*$", "", body)
        body = re.sub(r"\\([A-Za-z]+)(?![A-Za-z])", lambda m: macros.get(m[1], m[0]), body)
        out.append(body.strip())
    return "\n".join(out).strip() or None


def iterate_tex(path: str, raw: bytes) -> Iterator[dict]:
    """Papers of a tar of gzipped sources, each a TeX file or a tar of them."""
    import gzip
    import io
    import tarfile

    with tarfile.open(fileobj=io.BytesIO(raw)) as outer:
        for m in outer:
            if not m.isfile() or not m.name.endswith(".gz"):
                continue
            inside = gzip.decompress(outer.extractfile(m).read())
            try:
                with tarfile.open(fileobj=io.BytesIO(inside)) as tar:
                    sources = [tar.extractfile(x).read() for x in tar if x.isfile() and x.name.endswith(".tex")]
            except tarfile.ReadError:
                sources = [inside]
            yield {"id": m.name.rpartition("/")[2].removesuffix(".gz"), "source_id": path.rpartition("/")[2], "content": [s.decode("utf-8", "replace") for s in sources]}


def math_kind(url: Column, mime: Column, head: Column) -> Column:
    """notebook, html or text, from an address, a media type and the first characters."""
    return (
        F.when(url.endswith(".ipynb") | (head.contains('"nbformat"') & head.contains('"cells"')), "notebook")
        .when(mime.contains("html") | F.lower(head).rlike(r"<!doctype html|<html|<body"), "html")
        .otherwise("text")
    )


def notebook_text(raw: str) -> str | None:
    """Markdown and code cells of a notebook, in order."""
    import json

    try:
        cells = json.loads(raw).get("cells", [])
    except (ValueError, AttributeError):
        return None
    parts = ["".join(c["source"]) if isinstance(c.get("source"), list) else c.get("source", "") for c in cells]
    return "\n\n".join(p for p in parts if p.strip()) or None


def wiki_dump_urls(language: str, dump_date: str, status: dict, prefix: str = "https://dumps.wikimedia.org") -> list[str]:
    """Addresses of a dump's article files, from its status report, once they are done."""
    job = status["jobs"]["articlesmultistreamdump"]
    if job["status"] != "done":
        raise ValueError(f"the dump of {dump_date} isn't done")
    names = sorted(n for n in job["files"] if n.endswith(".bz2") and "-index" not in n)
    return [f"{prefix}/{language}wiki/{dump_date}/{n}" for n in names]


def tar_names(listing: str) -> list[str]:
    """Names of the tars in a store's listing, whose lines end in a name."""
    return sorted(line.split()[-1] for line in listing.splitlines() if line.strip().endswith(".tar"))


def fresh_downloads(urls: list[str], there: list[str]) -> list[str]:
    """Addresses whose file isn't there yet."""
    names = set(there)
    return [u for u in urls if u.rpartition("/")[2] not in names]
