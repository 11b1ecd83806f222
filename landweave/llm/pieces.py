"""SentencePiece BPE encoding and decoding of whole texts by vectorised merge rounds.

A batch's distinct words are flat arrays of symbols. In each round every word finds the least rank among its neighbouring pairs
(a segmented minimum), all its pairs of that rank are merged at once, leftmost first where they overlap, and the arrays are
compacted, until no pair is left. The library reads the vocabulary; the merging is done here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .encoding import Encoder, _Units, in_slices

_BLANK = "▁"


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices starts[i] ... starts[i] + counts[i] - 1 of all i in turn."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """A BPE vocabulary with byte fallback: ids, the pieces that pairs of symbols make and their ranks, and the bytes of ids.

    A symbol is the id of a piece, or a number from the count of ids on for a character that is no piece itself.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        plain = {p: i for i, p in enumerate(names) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))}
        if sp.normalize(" a  b ") != f"{_BLANK * 2}a{_BLANK * 2}b " or any(sp.is_unused(i) for i in plain.values()):
            raise ValueError(f"{path} is not of the kind that keeps texts as they are and puts a blank before them")
        others = sorted({c for p in plain for c in p if c not in plain})
        symbol = plain | {c: size + k for k, c in enumerate(others)}
        #: The symbol of a character that is in no piece.
        self.other = size + len(others)
        self.symbols = np.full(0x110000, self.other, np.int32)
        for c, s in symbol.items():
            if len(c) == 1:
                self.symbols[ord(c)] = s
        order = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in plain.values()}, reverse=True))}
        self.last = len(order)
        self.rank = np.full(size + 1, self.last, np.int32)  # also of -1, no piece
        for i in plain.values():
            self.rank[i] = order[sp.get_score(i)]
        splits = [(symbol[p[:k]], symbol[p[k:]], i) for p, i in plain.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        left, right, made = np.array(splits, np.int64).reshape(-1, 3).T
        keys = left * (self.other + 1) + right
        by_key = np.argsort(keys)
        self.keys, self.made = keys[by_key], made[by_key].astype(np.int32)
        #: Ranks at which a merge can bring about a pair that is due no later: of these a word merges one pair a round.
        self.alone = np.zeros(self.last + 1, bool)
        for part in (left, right):
            known = part < size
            early = self.rank[made[known]] <= self.rank[part[known]]
            self.alone[self.rank[part[known][early]]] = True
        self.bytes_of = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.is_byte = np.array([sp.is_byte(i) for i in range(size)])
        #: No piece goes on with a blank after another character: texts may be cut before blanks.
        self.cuts = not any(_BLANK in p.lstrip(_BLANK) for p in plain)
        #: Pieces of so many blanks are made from a longer run's left end, after all else.
        blanks = [p for p in plain if set(p) == {_BLANK} and len(p) > 1]
        only = all(p.count(_BLANK) < 2 or p in blanks for p in plain) and all(self.rank[plain[p]] == self.last - 1 for p in blanks)
        self.run = max(map(len, blanks), default=0) if only else 0
        #: ASCII characters that are in no piece stand alone (a space is a blank there).
        self.stands_alone = np.array([b < 128 and b != 32 and self.symbols[b] == self.other for b in range(256)])
        raw = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.decode([i]).encode() if sp.is_unknown(i) else n.replace(_BLANK, " ").encode() for i, n in enumerate(names)]
        self.lengths = np.array([len(b) for b in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.leads = np.array([n.startswith(_BLANK) for n in names])
        self.shown = np.array([not sp.is_control(i) for i in range(size)])

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, -1 if none."""
        key = left.astype(np.int64) * (self.other + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols after all merges, their words (both in order), and the first character each began with. `word` is ascending."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        first = np.arange(len(symbols))
        made = np.append(self.pairs(symbols[:-1], symbols[1:]), -1)
        made[:-1][word[1:] != word[:-1]] = -1
        rank = self.rank[made]
        while len(symbols):
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(begins, len(word)))
            best = np.minimum.reduceat(rank, begins)
            due = np.repeat(best, counts)
            ended = due == self.last
            if ended.any():
                out.append((symbols[ended], word[ended], first[ended]))
                if ended.all():
                    break
            hits = np.flatnonzero((rank == due) & ~ended)
            # Of pairs that overlap every second one is merged, from the left; of some ranks only a word's first.
            runs = np.append(True, hits[1:] != hits[:-1] + 1)
            place = np.arange(len(hits))
            taken = (place - np.maximum.accumulate(np.where(runs, place, 0))) % 2 == 0
            taken &= ~self.alone[due[hits]] | np.append(True, word[hits[1:]] != word[hits[:-1]])
            hits = hits[taken]
            symbols[hits] = made[hits]
            kept = ~ended
            kept[hits + 1] = False
            now = (np.cumsum(kept) - 1)[hits]
            symbols, word, first, made = symbols[kept], word[kept], first[kept], made[kept]
            for at in (now, now[now > 0] - 1):  # pairs that have changed
                after = np.minimum(at + 1, len(symbols) - 1)
                new = self.pairs(symbols[at], symbols[after])
                made[at] = np.where((after > at) & (word[at] == word[after]), new, -1)
            rank = self.rank[made]
        symbols, word, first = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (symbols, word, first)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order], first[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (with blanks as U+2581), one word after the other, and their counts."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols, word, first = self.merge(self.symbols[points], np.repeat(np.arange(len(words)), lengths))
        strange = symbols >= len(self.lengths)
        if not strange.any():
            return symbols.astype(np.uint32), np.bincount(word, minlength=len(words))
        # A character that is no piece becomes the ids of its bytes.
        point = points[first[strange]]
        sizes = 1 + (point > 0x7F).astype(np.int64) + (point > 0x7FF) + (point > 0xFFFF)
        counts = np.ones(len(symbols), np.int64)
        counts[strange] = sizes
        ids = np.repeat(symbols, counts).astype(np.uint32)
        ids[np.repeat(strange, counts)] = self.bytes_of[np.frombuffer(point.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        return ids, np.bincount(word, weights=counts, minlength=len(words)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of one document's ids: without the blank put before it; bytes that are no UTF-8 become U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        counts = self.lengths[ids]
        raw = self.raw[ragged(self.starts[ids], counts)].tobytes()
        shown = ids[self.shown[ids]]
        cut = 1 if len(shown) and self.leads[shown[0]] else 0
        try:
            return raw[cut:].decode()
        except UnicodeDecodeError:
            pass
        out, at = [], 0
        runs = np.flatnonzero(np.append(True, self.is_byte[ids[1:]] != self.is_byte[ids[:-1]]))
        sums = np.append(np.cumsum(counts) - counts, len(raw))
        for a, b in zip(runs, np.append(runs[1:], len(ids)), strict=True):
            part, byte_run = raw[max(sums[a], cut) : sums[b]], self.is_byte[ids[a]]
            at = 0
            while byte_run and at < len(part):  # each character, else one byte
                size = next((n for n in (1, 2, 3, 4) if _is_utf8(part[at : at + n])), 0)
                out.append(part[at : at + size].decode() if size else "�")
                at += max(size, 1)
            if not byte_run:
                out.append(part.decode())
        return "".join(out)


def _is_utf8(part: bytes) -> bool:
    try:
        return len(part.decode()) == 1
    except UnicodeDecodeError:
        return False


class PieceEncoder(Encoder):
    """Encodes batches of texts word by word; `most` bounds the words held, as for the other tokenizers."""

    def __init__(self, path: str, most: int = 400_000):
        self.vocabulary = Vocabulary(path)
        self.most = most
        self.drops_space, self.sign, self.sign_id = True, None, None  # words are asked for as they are
        self.units = _Units()
        self.starts, self.counts, self.met = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def _encoded(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary.encode_words([u.replace(" ", _BLANK) for u in asked])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, one text after the other, and where each text's begin, with the end as the last. Null is an empty text."""
        if len(self.units) > self.most or self.used > 16 * self.most:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, _BLANK, " ")
        blank = pa.scalar("", pa.large_string())
        texts = pc.binary_join_element_wise(pc.if_else(pc.equal(texts, blank), blank, pa.scalar(" ", pa.large_string())), texts, blank)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        begins = np.zeros(len(data) + 1, bool)
        if self.vocabulary.cuts and len(data):
            space = data == 32
            begins[:-1] = space
            begins[1:-1] &= ~space[:-1]
            lone = self.vocabulary.stands_alone[data]
            begins[:-1] |= lone
            begins[1:] |= lone
            if self.vocabulary.run:
                self._cut_runs(space, offsets, begins)
        begins[offsets] = True
        cuts = np.flatnonzero(begins[:-1])
        units = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(data))
        numbers = self._numbers(units)
        counts = self.counts[numbers]
        ends = np.append(0, np.cumsum(counts))
        return self.ids[ragged(self.starts[numbers], counts)], ends[np.searchsorted(cuts, offsets)]

    def _cut_runs(self, space: np.ndarray, offsets: np.ndarray, begins: np.ndarray) -> None:
        """Cut long runs of blanks where full pieces of blanks end, as they are made from the left."""
        edges = space.copy()
        edges[1:] &= ~space[:-1]
        inner = offsets[:-1][offsets[:-1] < len(space)]
        edges[inner] = space[inner]  # a run ends with its text
        first = np.flatnonzero(edges)
        stops = ~space
        stops[inner] = True
        stop = np.append(np.flatnonzero(stops), len(space))
        last = stop[np.searchsorted(stop, first + 1)]
        more = (last - first - 1) // self.vocabulary.run
        long = more > 0
        if long.any():
            at = ragged(np.ones(long.sum(), np.int64), more[long])
            begins[np.repeat(first[long], more[long]) + at * self.vocabulary.run] = True


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder of a vocabulary."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode(docs: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, ids (array of int, of the whole text, no begin or end id), and with `decoded` their text again.

    A null text is an empty one, which has no ids; so has its decoded text no characters. Rows that repeat count each, null ids stay.
    An empty table gives no rows. Other columns are not read. A blank (U+2581) in a text is a space, as in the library.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in in_slices(texts):
                ids, bounds = enc.encode(texts.slice(a, b - a))
                columns = {"doc_id": doc_ids.slice(a, b - a), "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))}
                if decoded:
                    columns["decoded"] = pa.array([enc.vocabulary.decode(ids[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string" if decoded else ""))


def decode(rows: DataFrame, model: str) -> DataFrame:
    """One row for each row of rows (doc_id, ids): doc_id and the text of its ids. Null ids are none; an id that isn't in the model is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(model).vocabulary
        for batch in batches:
            ids = batch.column("ids")
            flat, bounds = ids.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)))
            if len(flat) and not 0 <= flat.min() <= flat.max() < len(vocabulary.lengths):
                raise ValueError("an id is not in the model")
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array([vocabulary.decode(flat[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())})

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
