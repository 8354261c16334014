"""SentencePiece encoding and decoding by suffix-array matching.

The distinct stretches of a batch are laid end to end and indexed by a sorted
array of their suffixes. Every piece of the vocabulary is looked up in it by
binary search, which gives the range of its occurrences; each occurrence is an
edge from its start to its end. Edges, sorted into a table by position, are relaxed in the
order of the model: of the edges that join two neighbouring symbols of a stretch
the best scored is taken first, the leftmost of equals, until none is left.

Texts are cut into stretches before each blank that follows something else, if
no piece of the vocabulary reaches over such a place; equal stretches of a task
are encoded once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLANK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of texts taken together, characters indexed together, stretches remembered.
TEXTS, BLOCK, KNOWN = 1 << 20, 1 << 17, 250_000
#: A separator or a character that no piece has.
OTHER = 0
FAR = np.iinfo(np.int32).max
#: Characters from which a stretch is merged by a heap instead of in step with the others.
LONG = 256


@dataclass(frozen=True)
class Model:
    pieces: list[str]  # normal pieces, by id; others are empty
    rank: np.ndarray  # by id: 0 is merged first
    raw: list[bytes]  # what each id stands for
    byte_ids: list[int]  # of the 256 byte pieces, or empty
    unknown: int
    prefix: bool
    cut: bool  # no piece goes on after its text with a blank


def load(path: str = MODEL_PATH) -> Model:
    """Reads a model file on the driver. Only BPE models with the identity normalizer are known."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    read = proto.ModelProto()
    with open(path, "rb") as file:
        read.ParseFromString(file.read())
    rules = read.normalizer_spec
    if read.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("only a BPE model that leaves texts as they are can be used")
    normal = [p.piece if p.type == 1 else "" for p in read.pieces]
    known = [i for i, p in enumerate(read.pieces) if p.type == 6]
    raw = [
        bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(BLANK, " ").encode() if p.type == 1 else b""
        for p in read.pieces
    ]
    rank = np.empty(len(read.pieces), np.int32)
    rank[np.argsort([-p.score for p in read.pieces], kind="stable")] = np.arange(len(rank))  # equal scores: by id
    byte_ids = sorted(known, key=lambda i: raw[i]) if read.trainer_spec.byte_fallback and len(known) == 256 else []
    cut = not any(BLANK in p.lstrip(BLANK) for p in normal)
    unknown = next((i for i, p in enumerate(read.pieces) if p.type == 2), 0)
    raw[unknown] = " ⁇ ".encode() if not raw[unknown] else raw[unknown]
    return Model(normal, rank, raw, byte_ids, unknown, rules.add_dummy_prefix, cut)


def _sorted(words: np.ndarray) -> np.ndarray:
    """The order of rows of words: by the first word, and where that is equal by the rest."""
    order = np.argsort(words[:, 0])
    first, rest = words[order, 0], words[order, 1:]
    run = np.cumsum(np.concatenate([[True], first[1:] != first[:-1]])[: len(order)]) - 1
    mixed = np.bincount(run, weights=rest.any(axis=1)) > 0
    tied = np.flatnonzero(mixed[run])
    order[tied] = order[tied][np.lexsort((*rest[tied].T[::-1], run[tied]))]
    return order


class Index:
    """The vocabulary as codes of characters, and the encoding of blocks of stretches."""

    def __init__(self, model: Model):
        self.model = model
        ids = [i for i, p in enumerate(model.pieces) if p]
        chars = sorted({c for i in ids for c in model.pieces[i]})
        self.chars = len(chars) + 1
        self.longest = max(len(model.pieces[i]) for i in ids)
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in chars]] = np.arange(1, self.chars)
        ids.sort(key=lambda i: model.pieces[i])
        self.piece_ids = np.array(ids)
        self.piece_len = np.array([len(model.pieces[i]) for i in ids])
        self.piece_codes = np.zeros((len(ids), self.longest), np.uint16)
        for row, i in enumerate(ids):
            self.piece_codes[row, : self.piece_len[row]] = self._codes(model.pieces[i])

    def _codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every occurrence of a piece.

        Keys are the next `longest` characters, each as one byte, or two if the
        block has many different ones; the separator is the lowest.
        """
        present = np.flatnonzero(np.bincount(codes, minlength=self.chars))
        lut = np.zeros(self.chars, np.uint16)
        lut[present[present > 0]] = np.arange(1, (present > 0).sum() + 1)
        kind = np.dtype(">u1") if len(present) < 255 else np.dtype(">u2")
        top = np.iinfo(kind).max
        width = self.longest * kind.itemsize
        width += -width % 8
        places = width // kind.itemsize
        n = len(codes)
        padded = np.concatenate([lut[codes], np.zeros(places, np.uint16)]).astype(kind)
        windows = np.lib.stride_tricks.sliding_window_view(padded, places)[:n]
        # Nothing counts behind the end of a stretch.
        ends = np.append(np.flatnonzero(codes == OTHER), n)
        room = np.minimum(ends[np.searchsorted(ends, np.arange(n))] - np.arange(n), places)
        suffixes = np.where(np.arange(places) < room[:, None], windows, np.zeros(1, kind))
        order = _sorted(suffixes.view(">u8").astype(np.uint64))
        ordered = suffixes[order].view(f"V{width}").ravel()
        # Only pieces whose characters all occur can match.
        own = lut[self.piece_codes]
        whole = ((own > 0) | (self.piece_codes == 0)).all(axis=1)
        low = np.zeros((int(whole.sum()), places), kind)
        low[:, : self.longest] = own[whole]
        high = low.copy()
        high[np.arange(places) >= self.piece_len[whole][:, None]] = top
        first = np.searchsorted(ordered, low.view(f"V{width}").ravel(), "left")
        last = np.searchsorted(ordered, high.view(f"V{width}").ravel(), "right")
        times = last - first
        which = np.repeat(np.arange(len(times)), times)
        at = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + first[which]
        return order[at], self.piece_len[whole][which], self.piece_ids[whole][which]

    def relax(self, codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols left after all merges: their starts, their pieces (-1: none) and their stretches.

        codes holds stretches that begin at `begins`, each with a separator after it.
        """
        starts, lengths, pieces = self.edges(codes)
        at = np.full((len(codes), self.longest + 1), -1, np.int32)
        at[starts, lengths] = pieces  # edges by position
        lone = np.concatenate([begins[1:], [len(codes)]]) - 1  # separators
        symbols = np.delete(np.arange(len(codes)), lone)
        ends = symbols + 1
        unit = np.searchsorted(begins, symbols, "right") - 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        long = np.flatnonzero(lone - begins >= LONG)
        for i in long.tolist():
            done.append((*self._by_heap(at, int(begins[i]), int(lone[i])), i))
        if len(long):
            done = [(s, e, np.full(len(s), i)) for s, e, i in done]
            short = ~np.isin(unit, long)
            symbols, ends, unit = symbols[short], ends[short], unit[short]
        rank = np.append(self.model.rank, FAR)  # the last stands for no piece
        while len(symbols):
            joined = ends[1:] - symbols[:-1]
            fits = (unit[1:] == unit[:-1]) & (joined <= self.longest)
            cost = np.full(len(symbols), FAR, np.int64)
            where = np.flatnonzero(fits)
            cost[where] = rank[at[symbols[where], joined[where]]]
            cost = cost << 31 | np.arange(len(symbols))
            heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            lowest = np.minimum.reduceat(cost, heads)
            more = lowest >> 31 < FAR
            active = np.repeat(more, np.diff(np.append(heads, len(symbols))))
            done.append((symbols[~active], ends[~active], unit[~active]))
            left = lowest[more] & ((1 << 31) - 1)
            ends[left] = ends[left + 1]
            active[left + 1] = False
            symbols, ends, unit = symbols[active], ends[active], unit[active]
        symbols, ends, unit = (np.concatenate([d[i] for d in done]) for i in range(3)) if done else (symbols, ends, unit)
        order = np.argsort(symbols, kind="stable")
        symbols, ends, unit = symbols[order], ends[order], unit[order]
        return symbols, at[symbols, ends - symbols], unit

    def _by_heap(self, at: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the symbols left of one stretch: the same merges in n log n steps."""
        size, longest, rank = last - first, self.longest, self.model.rank
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        edge, heap, here = at.item, [], (1 << 40) - 1

        def cost(i: int) -> int:
            """The rank of the symbol at i joined with the next one, -1 if they make no piece."""
            j = after[i]
            if j >= size or after[j] - i > longest:
                return -1
            piece = edge(first + i, after[j] - i)
            return int(rank[piece]) if piece >= 0 else -1

        for i in range(size):
            if (lowest := cost(i)) >= 0:
                heap.append(lowest << 40 | i)
        heapify(heap)
        gone = bytearray(size)
        while heap:
            lowest = heappop(heap)
            i = lowest & here
            if gone[i] or cost(i) != lowest >> 40:
                continue
            j = after[i]
            k, h = after[j], before[i]
            after[i], gone[j] = k, 1
            if k < size:
                before[k] = i
            for x in (i, h):
                if x >= 0 and (new := cost(x)) >= 0:
                    heappush(heap, new << 40 | x)
        starts = np.flatnonzero(np.frombuffer(gone, np.uint8) == 0)
        return first + starts, first + np.array(after)[starts]

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches, number of ids of each)."""
        text = "\0".join([*stretches, ""])
        codes = self._codes(text)
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches)) + 1
        begins = np.cumsum(sizes) - sizes
        codes[begins + sizes - 1] = OTHER
        symbols, pieces, unit = self.relax(codes, begins)
        missing = np.flatnonzero(pieces < 0)
        if len(missing):
            spelled = [self.spell(text[i]) for i in symbols[missing]]
            grown = np.ones(len(pieces), np.int64)
            grown[missing] = [len(s) for s in spelled]
            pieces, unit = np.repeat(pieces, grown), np.repeat(unit, grown)
            pieces[pieces < 0] = [i for s in spelled for i in s]
        return pieces.astype(np.int32), np.bincount(unit, minlength=len(stretches))

    def spell(self, char: str) -> list[int]:
        if not self.model.byte_ids:
            return [self.model.unknown]
        return [self.model.byte_ids[b] for b in char.encode("utf-8", "replace")]


class Encoder:
    """Encodes texts; remembers stretches it has met."""

    def __init__(self, model: Model):
        self.model, self.index = model, Index(model)
        self.pattern = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+") if model.cut else re.compile(r"(?s).+")
        self.forget()

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); null and empty texts have none."""
        if len(self.number) > KNOWN:
            self.forget()
        before, met = len(self.count), []
        for text in texts:
            if text:
                own = self.pattern.findall((BLANK if self.model.prefix else "") + text.replace(" ", BLANK))
                met.append(np.fromiter(map(self.number.__getitem__, own), np.int64, len(own)))
            else:
                met.append(np.zeros(0, np.int64))
        new = list(self.number)[before:] if len(self.number) > before else []
        parts, block, size = [], [], 0
        for stretch in new:
            block.append(stretch)
            size += len(stretch) + 1
            if size >= BLOCK:
                parts.append(self.index.encode(block))
                block, size = [], 0
        if block:
            parts.append(self.index.encode(block))
        self.ids = np.concatenate([self.ids, *(p[0] for p in parts)])
        self.count = np.concatenate([self.count, *(p[1] for p in parts)])
        first = np.cumsum(self.count) - self.count
        flat, sizes = [], []
        for own in met:
            n = self.count[own]
            total = int(n.sum())
            step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            flat.append(self.ids[np.repeat(first[own], n) + step])
            sizes.append(total)
        return np.concatenate(flat) if flat else self.ids[:0], np.array(sizes, np.int64)


class Decoder:
    """The bytes of all pieces end to end, gathered by ids."""

    def __init__(self, model: Model):
        self.model = model
        self.raw = np.frombuffer(b"".join(model.raw), np.uint8)
        self.size = np.array([len(r) for r in model.raw])
        self.begin = np.cumsum(self.size) - self.size

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of rows of ids that lie end to end; broken UTF-8 gives replacement characters."""
        size = self.size[ids]
        ends = np.cumsum(size)
        whole = self.raw[np.arange(int(size.sum())) + np.repeat(self.begin[ids] - (ends - size), size)].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        own = [whole[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
        return [t[1:] if t.startswith(" ") else t for t in own] if self.model.prefix else own


def decode_ids(ids, model: Model) -> str:
    """The text of ids; a run of byte pieces that is no UTF-8 gives replacement characters."""
    raw = model.raw
    text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if model.prefix and text.startswith(" ") else text


def _groups(lengths) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about TEXTS characters, or ids, together."""
    at = size = 0
    for i, length in enumerate(lengths):
        size += int(length)
        if size >= TEXTS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths)


def _schema(frame: DataFrame, name: str, kind: str, without: str = "") -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name not in (name, without)]
    return ", ".join([*kept, f"`{name}` {kind}"])


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    names = [batch.schema.names[i] for i in kept]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), column], [*names, name])


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `ids`, the piece ids of the whole text, added.

    A stretch without blanks may have any length; it takes some 100 bytes a character for a while.

    The ids are those of the model's own library. A null text has null ids, an
    empty one none. Every row is kept; an existing column `ids` is replaced.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for whole in parts:
            sizes = pc.fill_null(pc.utf8_length(whole.column("text")), 0).to_numpy()
            for a, b in _groups(sizes):
                texts = whole.column("text").slice(a, b - a).to_pylist()
                flat, counts = encoder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                empty = pa.array([t is None for t in texts] + [False])
                places = pa.array(offsets, mask=empty.to_numpy(zero_copy_only=False))
                yield _with(whole.slice(a, b - a), "ids", pa.ListArray.from_arrays(places, pa.array(flat, pa.int32())))

    return docs.mapInArrow(batches, _schema(docs, "ids", "array<int>"))


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """rows with `decoded`, the text of the column ids, added; null for null ids."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for whole in parts:
            sizes = pc.fill_null(pc.list_value_length(whole.column("ids")), 0).to_numpy()
            for a, b in _groups(sizes):
                batch = whole.slice(a, b - a)
                ids = batch.column("ids")
                texts = decoder.texts(ids.flatten().to_numpy(), sizes[a:b])
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                yield _with(batch, "decoded", pa.array(texts, pa.string(), mask=missing))

    return rows.mapInArrow(batches, _schema(rows, "decoded", "string"))
