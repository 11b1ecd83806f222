"""Token ids of whole texts from the files of public tokenizers, encoded unit by unit.

Neither of the two byte-level vocabularies joins text across certain white space. Texts are cut there,
distinct units are encoded by the library once, and a text's ids are gathered from its units' ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: White space that is doubled or at an end: there a cut would change ids.
_UNEVEN = rf"{_SPACE}{_SPACE}|\A{_SPACE}|{_SPACE}\z"


class _Units(dict):
    """Unit -> number; a unit that is not there gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.fresh.append(unit)
        return number


class Encoder:
    """Encodes batches of texts. `most` bounds the units held; beyond it those met least are forgotten."""

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        #: A vocabulary that drops white space and lower-cases cuts at any blank; one that keeps it, before single ones.
        self.drops_space = not self.tokenizer.encode("  ", add_special_tokens=False).ids
        #: A sign that is one id and stands alone between blanks: units joined by it are encoded independently.
        signs = [(x, self.tokenizer.encode(f" {x}", add_special_tokens=False).ids) for x in "^~`|#*"]
        self.sign, self.sign_id = next(((x, ids[0]) for x, ids in signs if len(ids) == 1), (None, None))
        self.units = _Units()
        self.starts = np.zeros(1 << 16, np.int64)
        self.counts = np.zeros(1 << 16, np.int64)
        self.met = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _forget(self) -> None:
        """Keep the units met most often, half of the bound at most, of those met more than once."""
        met = self.met[: len(self.units)]
        old = np.argpartition(met, len(met) - self.most // 2)[len(met) - self.most // 2 :]
        old = np.sort(old[met[old] > 1])
        units = list(self.units)  # in the order of their numbers
        kept = [units[number] for number in old]
        self.units = _Units()
        self.units.update(zip(kept, range(len(kept)), strict=True))
        counts = self.counts[old]
        ends = np.cumsum(counts)
        flat = self.ids[np.repeat(self.starts[old] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        self.ids[: len(flat)] = flat
        self.used = len(flat)
        self.counts[: len(kept)], self.starts[: len(kept)] = counts, ends - counts
        met = self.met[old] // 2
        self.met[:] = 0
        self.met[: len(kept)] = met

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _encoded(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units, one after the other, and their counts."""
        if self.sign is None or any(self.sign in u for u in asked):
            encoded = self._plain(asked)
            return np.concatenate(encoded), np.fromiter(map(len, encoded), np.int64, len(encoded))
        after = f" {self.sign} " if self.drops_space else f" {self.sign}"
        joined = [after.join([*asked[i : i + 256], ""]) for i in range(0, len(asked), 256)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        marks = np.flatnonzero(ids == self.sign_id)
        return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks])) - 1

    def _learn(self) -> None:
        fresh, self.units.fresh = self.units.fresh, []
        if not fresh:
            return
        asked = fresh if self.drops_space else [u if u[:1] == "\n" else " " + u for u in fresh]
        signed = [self.sign is not None and self.sign in u for u in asked]
        if any(signed):  # apart, so that they cost the others nothing
            order = sorted(range(len(asked)), key=signed.__getitem__)
            (a, m), (b, n) = self._encoded([asked[i] for i in order if not signed[i]] or ["a"]), self._encoded([asked[i] for i in order if signed[i]])
            parts = np.split(np.concatenate([a, b]), np.cumsum(np.concatenate([m, n]))[:-1])[-len(asked) :]
            back = np.argsort(order)
            flat, counts = np.concatenate([parts[i] for i in back]), np.array([len(parts[i]) for i in back])
        else:
            flat, counts = self._encoded(asked)
        first, last = len(self.units) - len(fresh), len(self.units)
        while last > len(self.starts):
            more = np.zeros_like(self.starts)
            self.starts, self.counts = np.concatenate([self.starts, more]), np.concatenate([self.counts, more])
            self.met = np.concatenate([self.met, more.astype(np.int32)])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(flat)] = flat
        self.counts[first:last] = counts
        self.starts[first:last] = self.used + np.cumsum(counts) - counts
        self.used += len(flat)

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """The number of each unit; a batch's distinct units are looked up once."""
        coded = units.dictionary_encode()
        own = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.units.__getitem__, own), np.int64, len(own))
        self._learn()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.met[numbers] += np.bincount(codes, minlength=len(own)).astype(np.int32)
        return numbers[codes]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, one text after the other, and where each text's begin, with the end as the last.

        They are those of encode_batch(texts, add_special_tokens=False). Null is an empty text.
        """
        if len(self.units) > self.most:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.drops_space:
            odd = np.zeros(len(texts), bool)
            cut = pc.replace_substring(texts, "\n", " ")
        else:
            odd = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
            # A line's first unit carries its newline, which is an id of its own. The text's first unit gets one too.
            even = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
            blank = pa.scalar("", pa.large_string())
            cut = pc.replace_substring(even.cast(pa.large_string()), "\n", " \n")
            cut = pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), cut, blank)
        lists = pc.split_pattern(cut, " ")
        numbers = self._numbers(lists.flatten())
        counts = self.counts[numbers]
        ends = np.concatenate([[0], np.cumsum(counts)])
        flat = self.ids[np.repeat(self.starts[numbers] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        if self.drops_space:
            return flat, bounds
        # The newline put before each text goes again; texts with uneven white space are encoded as they are.
        flat = np.delete(flat, bounds[:-1])
        bounds = bounds - np.arange(len(bounds))
        if not odd.any():
            return flat, bounds
        parts = [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        where = np.flatnonzero(odd)
        for i, ids in zip(where, self._plain(texts.take(pa.array(where)).to_pylist()), strict=True):
            parts[i] = ids
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


_encoders: dict[str, Encoder] = {}


def encoder(path: str, most: int = 400_000) -> Encoder:
    """This worker's encoder of a file, with room for so many units."""
    pa.default_memory_pool().release_unused()
    if path not in _encoders:
        _encoders[path] = Encoder(path, most)
    return _encoders[path]


def release() -> None:
    """Forget this worker's encoders: workers are reused, and other operators' tasks need the memory."""
    _encoders.clear()
    pa.default_memory_pool().release_unused()


def in_slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(first, last) of slices of texts of about so many bytes, or of one longer text: bounds what is encoded at once."""
    sums = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = sums[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sums, before + size)))
        yield first, min(last, len(texts))
        first = last
