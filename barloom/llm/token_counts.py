"""Token counts of texts by heap-and-linked-list byte-pair merging.

A word begins as its bytes. Adjacent pairs lie in a heap by rank, then place; the
lowest is popped again and again, its two symbols become one, and the pairs with
the new neighbours, which a doubly linked list gives, are pushed. A popped pair
that is no longer there is passed over. The count is the number of initial symbols
less the number of merges; no identifiers are put out.

Normalising and cutting into words go by Python's Unicode tables where these and
the library's surely agree, which is on characters of Unicode 3.2 that have kept
their category. A text with any other character is normalised and cut by the
library's own components; its words are merged here all the same.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import by_text

#: Words remembered by a task, the longest remembered, characters cut into words at once.
KNOWN, WORD, SLICE = 400_000, 48, 1 << 18
#: The steps of the models that can be used, as their file names them.
STEPS = ["NFC", "Replace", "Lowercase"]
CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: CUT, for texts without characters of RARE; separators 1C to 1F are no white space there.
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|[_\x1c-\x1f])+")


def path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizers keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Model:
    source: str  # the model's file, for the library's components
    special: list[str]
    vocab: dict[str, int]
    end: str
    ranks: dict[int, int]  # of a pair, as left << 20 | right
    made: list[int]  # by rank, the symbol that a merge makes
    rare: str  # a pattern of characters that only the library cuts


def rare_characters() -> str:
    """A character class of what Python and the library might see differently."""
    old = unicodedata.ucd_3_2_0.category

    def odd(c: int) -> bool:
        now = unicodedata.category(chr(c))
        return now == "Cn" or now != old(chr(c)) or now in ("No", "Nl")

    parts, begin = [], None
    for c in range(0x80, sys.maxunicode + 2):
        if c <= sys.maxunicode and odd(c):
            begin = c if begin is None else begin
        elif begin is not None:
            parts.append(f"\\U{begin:08x}-\\U{c - 1:08x}")
            begin = None
    return f"[{''.join(parts)}]"


def load(file: str | None = None) -> Model:
    """Reads a model's file on the driver.

    Only byte-level BPE with a mark at the end of words, NFC and lower case is known;
    anything else is an error.
    """
    with open(file or path(), encoding="utf-8") as opened:
        source = opened.read()
    parts = json.loads(source)
    bpe, steps, cuts = parts["model"], parts["normalizer"]["normalizers"], parts["pre_tokenizer"]["pretokenizers"]
    fits = (
        bpe["type"] == "BPE"
        and not any(bpe.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
        and [s["type"] for s in steps] == STEPS
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": CUT}
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    )
    if not fits:
        raise ValueError("only byte-level BPE with ends of words, NFC and lower case can be counted")
    vocab = bpe["vocab"]
    ranks, made = {}, []
    for rank, pair in enumerate(bpe["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        ranks[vocab[left] << 20 | vocab[right]] = rank
        made.append(vocab[left + right])
    special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
    return Model(source, special, vocab, bpe["end_of_word_suffix"] or "", ranks, made, rare_characters())


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def merged(symbols: list[int], ranks: dict[int, int], made: list[int]) -> int:
    """How many symbols are left of a word after all merges; the list is used up."""
    size = left = len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    none = len(made)
    heap = []
    for i in range(size - 1):
        rank = ranks.get(symbols[i] << 20 | symbols[i + 1], none)
        if rank < none:
            heap.append(rank << 40 | i)
    heapify(heap)
    here = (1 << 40) - 1
    while heap:
        lowest = heappop(heap)
        i, rank = lowest & here, lowest >> 40
        j = after[i]
        if symbols[i] < 0 or j >= size or ranks.get(symbols[i] << 20 | symbols[j]) != rank:
            continue
        symbols[i], symbols[j] = made[rank], -1
        left -= 1
        k, h = after[j], before[i]
        after[i] = k
        if k < size:
            before[k] = i
            rank = ranks.get(symbols[i] << 20 | symbols[k], none)
            if rank < none:
                heappush(heap, rank << 40 | i)
        if h >= 0:
            rank = ranks.get(symbols[h] << 20 | symbols[i], none)
            if rank < none:
                heappush(heap, rank << 40 | h)
    return left


class RareCharacter(Exception):
    """A word has a character that the library must cut."""


class Counter(dict):
    """Token counts of words; a new word is counted when it is first asked for."""

    def __init__(self, model: Model):
        letters = byte_letters()
        self.model = model
        self.inner = [model.vocab[c] for c in letters]
        self.last = [model.vocab[c + model.end] for c in letters]
        self.letter = {c: b for b, c in enumerate(letters)}
        self.rare = re.compile(model.rare)
        self.special = re.compile("|".join(map(re.escape, model.special)) or r"(?!)")
        self.library = None

    def __missing__(self, word: str) -> int:
        if not word.isascii() and self.rare.search(word):
            raise RareCharacter
        number = self.of_bytes(word.encode())
        if len(word) <= WORD:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = number
        return number

    def of_bytes(self, raw: bytes) -> int:
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return merged(symbols, self.model.ranks, self.model.made) if len(symbols) > 1 else 1

    def by_library(self, text: str) -> int:
        """The count of a text that the library normalises and cuts."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.model.source)
        normal = self.library.normalizer.normalize_str(text)
        words = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return sum(self.of_bytes(bytes(map(self.letter.__getitem__, word))) for word, _ in words)

    def of_part(self, text: str) -> int:
        """The count of a text without special strings.

        Taken in slices that end before white space, where no word goes on and no
        character is composed with the one before.
        """
        total = at = 0
        while at < len(text):
            end = at + SLICE
            while end < len(text) and text[end] not in " \n":
                end += 1
            part, at = text[at:end], end
            try:
                same = part.isascii() or unicodedata.is_normalized("NFC", part)
                normal = part if same else unicodedata.normalize("NFC", part)
                # A final sigma is no letter of its own there.
                normal = normal.replace("Σ", "σ").lower()
                total += sum(map(self.__getitem__, WORDS.findall(normal)))
            except RareCharacter:
                total += self.by_library(part)
        return total

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.of_part, parts))


def token_count(text: Column, model: Model) -> Column:
    """The number of tokens of a whole text, 0 for null, as a long."""
    counter: list[Counter] = []

    def make(texts: list[str | None]) -> pa.Array:
        if not counter:
            counter.append(Counter(model))
        return pa.array([counter[0].of_text(t) for t in texts], pa.int64())

    return by_text(make, "long")(text)


def with_counts(docs: DataFrame, model: Model, limit: int = 2048) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (more than `limit` tokens) of the column text.

    Counts are those of the model's own library without added begin or end; special strings
    inside a text count one token each. A null text counts as empty, which has no bytes and no tokens.
    Every row is kept, repeated ones too; columns of these names are replaced, others stay.
    No text is cut off; a word of any length is merged in n log n steps.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = docs.drop(*added)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = kept.select("*", size.alias("n_bytes"), token_count(F.col("text"), model).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
