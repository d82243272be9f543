"""Token ids by the tokenizers library, each distinct pre-token encoded once.

The library encodes about 2 MB of text a second and core, most of it spent on words it has met before. For texts of
plain characters (ASCII and the Latin-1 letters, whose classes no Unicode version changes) the pre-tokens are found
here by the tokenizer's own pattern; the library encodes those not met yet, many in one call, and their ids are kept.
Other texts, and tokenizers of another kind, are encoded whole. Ids are the library's in every case.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Characters of the texts whose pre-tokens are found here: fixed values.
_PLAIN = re.compile(rf"[\t\n\r\x20-~¡-§©«-®°±´¶-¸»¿{_LETTER}×÷]*")
_BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")
_WORD_END = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s0-9{_LETTER}]+")
#: The pattern text in the tokenizer file that _WORD_END stands for.
_WORD_END_FILE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """``encode(texts)`` yields an int64 array of ids for each text. Keeps the pre-tokens met last, ``most`` to twice as many."""

    def __init__(self, path: str, most: int = 120_000):
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        about = json.loads(self.library.to_str())
        pre, added = about.get("pre_tokenizer") or {}, [t["content"] for t in about.get("added_tokens", [])]
        steps, norm = pre.get("pretokenizers", []), about.get("normalizer")
        self.find = None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None and self._raw("\n") == [198]:
            self.find, self.ends = _BYTE_LEVEL, None
        elif len(steps) == 2 and steps[0].get("pattern") == {"Regex": _WORD_END_FILE} and about["model"].get("end_of_word_suffix") == "</w>" and [s["type"] for s in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"]:
            self.find = _WORD_END
            self.ends = np.zeros(self.library.get_vocab_size(), bool)
            self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True
        if not all("<|" in t for t in added):
            self.find = None
        self._clear()
        self._age()

    def _clear(self) -> None:
        self.at = Numbered()
        self.size, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _age(self) -> None:
        """Start anew, with the present pre-tokens at hand: those met again are taken from there."""
        self.old = (dict(self.at), self.size, self.first, self.ids)
        self._clear()

    def _raw(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _learn(self) -> None:
        """Ids of the pre-tokens numbered since the last call."""
        words = self.at.new
        if not words:
            return
        self.at.new = []
        known, size, first, ids = self.old
        again = [known.get(w, -1) for w in words]
        if max(again) >= 0:  # in the order of their numbers, so that known ones and new ones are put in by turns
            fresh = [w for w, k in zip(words, again, strict=True) if k < 0]
            got = self._encode(fresh) if fresh else (ids[:0], size[:0])
            k = np.array(again)
            sizes = np.where(k >= 0, size[k], 0) if len(size) else np.zeros(len(k), np.int64)
            sizes[k < 0] = got[1]
            pool = np.concatenate([got[0].astype(np.int32), ids])
            start = np.zeros(len(k), np.int64)
            start[k < 0] = np.cumsum(got[1]) - got[1]
            start[k >= 0] = first[k[k >= 0]] + len(got[0])
            before = np.cumsum(sizes) - sizes
            self._put(pool[np.repeat(start - before, sizes) + np.arange(int(sizes.sum()))], sizes)
        else:
            self._put(*self._encode(words))

    def _put(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.first = np.concatenate([self.first, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.used + len(ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, and how many each has; 200 to a text, one by one where a text can't be told apart."""
        parts = [words[i : i + 200] for i in range(0, len(words), 200)]
        sep = " " if self.ends is not None else "\n"
        whole = [p for p in parts if self.ends is not None or all(map(str.strip, p))]
        got = iter(self.library.encode_batch_fast([sep.join(p) + sep for p in whole], add_special_tokens=False) if whole else [])
        found, sizes = [], []
        for part in parts:
            if self.ends is not None or all(map(str.strip, part)):
                ids = np.array(next(got).ids, np.int64)
                if self.ends is not None:
                    size = np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)
                else:  # a line feed is a pre-token of its own between others that hold no white space but a leading space
                    size = np.diff(np.flatnonzero(ids == 198), prepend=-1) - 1
                    ids = ids[ids != 198]
                if len(size) == len(part) and size.sum() == len(ids):
                    found.append(ids)
                    sizes.append(size)
                    continue
            each = [self._raw(w) for w in part]
            found += [np.array(x, np.int64) for x in each]
            sizes.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(found), np.concatenate(sizes)

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.at) > self.most:
            self._age()
        which: list[np.ndarray | str] = []
        for text in texts:
            if self.find is None or "<|" in text or not _PLAIN.fullmatch(text):
                which.append(text)
            else:
                words = self.find.findall(text if self.ends is None else text.lower())
                which.append(np.fromiter(map(self.at.__getitem__, words), np.int64, len(words)))
        self._learn()
        out = []
        for w in which:
            if isinstance(w, str):
                out.append(np.array(self._raw(w), np.int64))
            else:
                size = self.size[w]
                before = np.cumsum(size) - size
                out.append(self.ids[np.repeat(self.first[w] - before, size) + np.arange(int(size.sum()))])
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order; some 2 MB of text are in work at a time."""
        group, held = [], 0
        for text in texts:
            group.append(text or "")
            held += len(text or "")
            if held > 2_000_000:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)


class Numbered(dict):
    """Numbers words in the order they are met; ``new`` lists those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def public_tokenizer(name: str) -> str:
    """Path of a vocabulary file of the public_tokenizers package; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)
