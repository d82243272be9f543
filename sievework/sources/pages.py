"""Document pages: PDF bytes from archives, and the markup that a page parser gives as interleaved rows."""

from __future__ import annotations

import base64
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from sievework.sources.readers import INTERLEAVED

#: An element of the markup: corner, content, other corner, class.
_ELEMENT = re.compile(r"<x_([\d.]+)><y_([\d.]+)>(.*?)<x_([\d.]+)><y_([\d.]+)><class_([^>]+)>", re.S)


def zip_member(file_name: str, folder: str) -> tuple[str, str]:
    """Archive and member of a PDF numbered like 0001234.pdf: a thousand to an archive, a thousand archives to a folder."""
    archive = int(file_name.removesuffix(".pdf")) // 1000
    first = archive // 1000 * 1000
    return f"{folder.rstrip('/')}/{first:04d}-{first + 999:04d}/{archive:04d}.zip", file_name


def pdf_from_zip(raw: bytes, member: str) -> bytes | None:
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            return z.read(member)
    except (KeyError, zipfile.BadZipFile):
        return None


def pdf_from_line(line: bytes | str, field: str = "content") -> bytes | None:
    """Bytes of a JSON line that has them in base64."""
    try:
        return base64.b64decode(json.loads(line)[field])
    except (ValueError, KeyError, TypeError):
        return None


def page_elements(markup: str) -> list[dict]:
    """(class, text, box) of a page's elements; empty ones are left out unless they are pictures. Markup without elements
    is one text."""
    plain = lambda s: re.sub(r"<[^>]+>", "", s).strip()
    out = [{"class": m[6], "text": plain(m[3]), "box": [float(m[i]) for i in (1, 2, 4, 5)]} for m in _ELEMENT.finditer(markup)]
    out = [e for e in out if e["text"] or e["class"] == "Picture"]
    return out or ([{"class": "Text", "text": plain(markup), "box": None}] if plain(markup) else [])


def _height(e: dict) -> float:
    return (e["box"][1] + e["box"][3]) / 2 if e["box"] else 0.0


def place_pictures(elements: list[dict]) -> list[dict]:
    """Reading order for parsers that list pictures and captions last: each caption joins the free picture nearest in height,
    and each such group follows the element nearest to it."""
    fixed = [e for e in elements if e["class"] not in ("Picture", "Caption")]
    groups = [[e] for e in elements if e["class"] == "Picture"]
    for caption in (e for e in elements if e["class"] == "Caption"):
        free = [g for g in groups if len(g) == 1 and g[0]["class"] == "Picture"]
        if free:
            min(free, key=lambda g: abs(_height(g[0]) - _height(caption))).append(caption)
        else:
            groups.append([caption])
    groups.sort(key=lambda g: _height(g[0]))
    after: dict[int, list[dict]] = {}
    for g in groups:
        nearest = min(range(len(fixed)), key=lambda i: abs(_height(fixed[i]) - _height(g[0])), default=-1)
        after.setdefault(nearest, []).extend(g)
    out = list(after.get(-1, []))
    for i, e in enumerate(fixed):
        out += [e, *after.get(i, [])]
    return out


def page_rows(df: DataFrame, sample_field: str = "sample_id", pages_field: str = "pages", crop: Callable[[bytes, list[float]], bytes | None] | None = None, images_field: str | None = None, reorder: bool = False) -> DataFrame:
    """Interleaved rows of documents whose pages are an array of markup: a metadata row, then texts and pictures in order.
    ``crop`` cuts a picture out of its page's image, an array beside the markup."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["sample_id", "position", "modality", "content_type", "text_content", "binary_content", "source_ref", "materialize_error"]
        for frame in frames:
            rows = []
            for at in range(len(frame)):
                record = frame.iloc[at]
                key, pages = str(record[sample_field]), record[pages_field]
                pages = [] if pages is None else list(pages)
                rows.append([key, -1, "metadata", "application/json", json.dumps({"num_pages": len(pages)}), None, None, None])
                place = 0
                for number, markup in enumerate(pages):
                    elements = page_elements(markup or "")
                    for e in place_pictures(elements) if reorder else elements:
                        if e["class"] == "Picture":
                            image = crop(record[images_field][number], e["box"]) if crop and images_field else None
                            ref = json.dumps({"page": number, "box": e["box"]})
                            rows.append([key, place, "image", "image/png", None, image, ref, None if image or not crop else "no picture"])
                        else:
                            rows.append([key, place, "text", "text/markdown", e["text"], None, None, None])
                        place += 1
            yield pd.DataFrame(rows, columns=names)

    return df.mapInPandas(run, INTERLEAVED.replace(" NOT NULL", ""))
