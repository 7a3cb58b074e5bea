"""Token ids of whole texts by a public tokenizer file, as little-endian bytes.

A text is cut at places where no token can span and its units are looked up in a
memo of bounded size. A unit not met before is a word, perhaps with marks behind
it: both are pieces that the file's pattern would cut, and go to the file's BPE
model; any other unit goes through the whole tokenizer. A word with marks behind
it takes the word from the memo, so a word needs one place there however it is
punctuated. Ids are those of encode(text, add_special_tokens=False): a string of an
added token, such as <|endoftext|>, in a text is that token, and what stands beside
it is encoded by itself. With special=False such strings are ordinary text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker's memo holds before it is put aside for a new one; what is
#: met again comes over from the older one.
MEMO = 300_000
#: ASCII marks, the apostrophe apart: it may begin a piece of its own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: White space besides the space and the line end.
_BLANKS = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


class _Memo(dict):
    """Bytes of units; a unit that is missing is looked up by `find` and kept."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, unit: str) -> bytes:
        raw = self[unit] = self.find(unit)
        return raw


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level files have for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def units(text: str, drops: bool) -> list[str]:
    """A text cut where no token can span; drops: of a file that drops white space.
    Of a file that keeps it, every unit but the first has a space before it, unless
    it begins with a line end."""
    if drops:
        return text.replace("\n", " ").split(" ")
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1] in " \n" or text[-1:] in " \n" or any(c in text for c in _BLANKS):
        return _SINGLE.split(text)
    # a line end between two other characters is a token of its own
    return text.replace("\n", " \n").split(" ")


def picked(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start : start + size] of each start and size, one behind the other."""
    ends = np.cumsum(size, dtype=np.int64)
    return values[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class _Words:
    """Ids of words, in arrays: a batch's words are looked up at once. Holds `size` words
    at most; when there are more, those not met again since the last time are put aside."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.words, self.ids, self.first, self.met = pa.array([], pa.string()), np.empty(0, "<u4"), np.zeros(1, np.int64), np.empty(0, bool)

    def look_up(self, words: pa.StringArray, find) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct words; find: bytes of the ids of one."""
        if len(self.words) > self.size:
            keep = np.flatnonzero(self.met)[-(self.size // 2) :]
            size = np.diff(self.first)[keep]
            self.ids, self.words = picked(self.ids, self.first[keep], size), self.words.take(pa.array(keep))
            self.first, self.met = np.concatenate(([0], np.cumsum(size))), np.zeros(len(keep), bool)
        at = pc.index_in(words, value_set=self.words)
        known, place = at.is_valid().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy().astype(np.int64)
        self.met[place[known]] = True
        new = words.filter(pa.array(~known))
        place[~known] = len(self.words) + np.arange(len(new))
        raw = [find(w) for w in new.to_pylist()]
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(raw), "<u4")))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(size)))
        self.words, self.met = pa.concat_arrays([self.words, new]), np.concatenate((self.met, np.zeros(len(new), bool)))
        return self.ids, self.first[place], self.first[place + 1] - self.first[place]


class Encoder:
    """Bytes of the ids of texts, 4 a token.

    Byte-level files keep white space: a text is cut before a single space
    between two other characters, which always begins a token. Files that drop
    white space and fold case are cut at every space and line end.
    """

    def __init__(self, path: str, memo: int = MEMO, special: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()} if special else {}
        self.added = {k: i.to_bytes(4, "little") for k, i in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.tokenizer.encode_special_tokens = True  # the parts beside added tokens hold none
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.drops = not self._ids(" ")
        self.letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            top = max(json.load(f)["model"]["vocab"].values())
        self.four = [i.to_bytes(4, "little") for i in range(top + 1)]
        self.memo, self.older, self.pieces, self.size = _Memo(self._find), {}, _Memo(self._bpe), memo
        self.words = _Words(memo)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bpe(self, piece: str) -> bytes:
        """Of one piece of the file's pattern."""
        return self._ranked(piece.encode().decode("latin-1").translate(self.letters))

    def _ranked(self, mapped: str) -> bytes:
        four = self.four
        return b"".join([four[t.id] for t in self.model.tokenize(mapped)])

    def _word(self, word: str, space: str) -> bytes:
        """Of a word, of letters only: in ASCII those are their own byte letters."""
        return self._ranked(("\u0120" if space else "") + word) if word.isascii() else self._bpe(space + word)

    def _find(self, unit: str) -> bytes:
        if (known := self.older.get(unit)) is not None:
            return known
        if self.drops:
            return self._raw(unit, "", self.memo)
        if unit[:1] == "\n" and unit[1:2].strip():
            return self.pieces["\n"] + self._raw(unit[1:], "")
        return self._raw(unit, " ", self.memo)

    def _raw(self, unit: str, space: str, known: _Memo | None = None) -> bytes:
        """A word and marks behind it by the model, else the whole tokenizer. known:
        where the word is looked up if there are marks."""
        if self.drops:
            if not unit.isascii() and (max(unit) >= "\u0250" or "\u0130" in unit or not unicodedata.is_normalized("NFC", unit)):
                return b"".join([self.four[i] for i in self._ids(unit)])
            unit = unit.lower()
        if unit.isalpha():
            return self._word(unit, space)
        word = unit.rstrip(_MARKS)
        if word.isalpha():
            return (self._word(word, space) if known is None else known[word]) + self.pieces[unit[len(word) :]]
        return b"".join([self.four[i] for i in self._ids(space + unit)])

    def _one(self, text: str) -> bytes:
        parts = units(text, self.drops)
        if self.drops:
            return b"".join(map(self.memo.__getitem__, parts))
        return self._raw(parts[0], "") + b"".join(map(self.memo.__getitem__, parts[1:]))

    def _make_room(self) -> None:
        if len(self.memo) > self.size:
            self.older, self.memo = self.memo, _Memo(self._find)
        if len(self.pieces) > self.size:
            self.pieces.clear()

    def encode_arrays(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, size) of texts without nulls: the ids of all, each text's with an end id
        behind them, and how many they are. Of a file that drops white space, each
        distinct unit of the texts is looked at once, and its word by arrays."""
        last = np.array([end], "<u4")
        texts = texts.cast(pa.string())
        whole = np.full(len(texts), not self.drops)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if whole.any():
            parts = [np.append(np.frombuffer(raw, "<u4"), last) for raw in self.encode(texts.filter(pa.array(whole)).to_pylist())]
            size = np.empty(len(texts), np.int64)
            size[whole] = [len(x) for x in parts]
            if whole.all():
                return np.concatenate(parts), size
            # the texts of both kinds in their order
            ids, size[~whole] = self.encode_arrays(texts.filter(pa.array(~whole)), end)
            values, start = np.concatenate((ids, *parts)), np.empty(len(texts), np.int64)
            for own, behind in ((~whole, 0), (whole, len(ids))):
                start[own] = behind + np.cumsum(size[own]) - size[own]
            return picked(values, start, size), size
        self._make_room()
        units = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        encoded = units.flatten().dictionary_encode()
        ids, start, size = self._of_units(encoded.dictionary)
        each, ends = encoded.indices.to_numpy(), np.cumsum(units.value_lengths().to_numpy(), dtype=np.int64)
        each = np.insert(each, ends, len(start))
        ids, start, size = np.append(ids, last), np.append(start, len(ids)), np.append(size, 1)
        before = np.append(0, np.cumsum(size[each]))
        ends += np.arange(1, len(ends) + 1)
        return picked(ids, start[each], size[each]), np.diff(before[ends], prepend=0)

    def _of_units(self, units: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct units of a file that drops white space."""
        word = pc.utf8_rtrim(units, _MARKS)
        # characters up to U+023F but for U+0130 are composed and have a lower case of their own
        odd = pc.match_substring_regex(units, r"[^\x00-\x{023F}]|\x{0130}")
        plain = pc.and_not(pc.utf8_is_alpha(word), odd).to_numpy(zero_copy_only=False)
        rest = [self.memo[u] for u in units.filter(pa.array(~plain)).to_pylist()]
        units, word = units.filter(pa.array(plain)), word.filter(pa.array(plain))
        begin, left = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1].astype(np.int64), pc.binary_length(word).to_numpy().astype(np.int64)
        size = np.diff(begin) - left
        marks = picked(np.frombuffer(units.buffers()[2] or b"", np.uint8), begin[:-1] + left, size)
        ends = np.append(0, np.cumsum(size)).astype(np.int32)
        marks = pa.StringArray.from_buffers(len(units), pa.py_buffer(ends), pa.py_buffer(marks)).dictionary_encode()
        word = pc.utf8_lower(word).dictionary_encode()
        ids, first, size = self.words.look_up(word.dictionary, lambda w: self._word(w, ""))
        tails = [self.pieces[m] if m else b"" for m in marks.dictionary.to_pylist()]
        tail_size = np.array([len(t) // 4 for t in tails], np.int64)
        tail_first = len(ids) + np.cumsum(tail_size) - tail_size
        values = np.concatenate((ids, np.frombuffer(b"".join(tails), "<u4")))
        w, m = word.indices.to_numpy(), marks.indices.to_numpy()
        two = np.stack((size[w], tail_size[m]), 1)
        own = picked(values, np.stack((first[w], tail_first[m]), 1).ravel(), two.ravel())
        out = np.empty(len(plain), np.int64)
        out[plain], out[~plain] = two.sum(1), [len(x) // 4 for x in rest]
        start = np.empty(len(plain), np.int64)
        start[plain] = np.cumsum(out[plain]) - out[plain]
        start[~plain] = len(own) + np.cumsum(out[~plain]) - out[~plain]
        return np.concatenate((own, np.frombuffer(b"".join(rest), "<u4"))), start, out

    def encode(self, texts: list[str]) -> list[bytes]:
        self._make_room()
        found = []
        for text in texts:
            if self.cuts is None or not self.cuts.search(text):
                found.append(self._one(text))
            else:
                parts = self.cuts.split(text)
                found.append(b"".join([self.added[x] if k % 2 else self._one(x) for k, x in enumerate(parts)]))
        return found


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = True, memo: int = MEMO) -> Encoder:
    """One for each file and worker process."""
    return Encoder(path, memo, special)


def release() -> None:
    """Lets go of a worker's memos: Spark uses it for other work now."""
    encoder.cache_clear()
