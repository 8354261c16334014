"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over
hashed byte trigrams tells languages with a 1 from those with a 0. A text gets
the language whose codeword loses least, each bit weighted by how well its
classifier did on the training texts; a small lead flags ambiguity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import by_text, inner, spread

TABLE = 1 << 15
#: Bytes looked at together; a longer text takes several turns.
TURN = 1 << 16
#: ASCII other than letters becomes a blank; bytes of other characters stay.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: A lead below this over the second language flags a text as ambiguous.
LEAD = 0.05


@dataclass(frozen=True)
class Model:
    names: list[str]
    codes: np.ndarray  # language x bit, 1 or -1
    weights: np.ndarray  # trigram x bit, log-odds
    scale: np.ndarray  # of each bit's mean log-odds
    trust: np.ndarray  # weight of each bit's loss


def lettered(text: str) -> bool:
    """Whether any character is a letter."""
    return any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n different rows of 1 and -1: every split of the languages, or random ones if they are many."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        bits = np.arange(1, 1 << (n - 1))
        return np.where((bits >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    size, draw = int(np.ceil(10 * np.log2(n))), np.random.default_rng(11)
    best, far = None, -1
    for _ in range(200):
        codes = draw.choice([-1.0, 1.0], (n, size))
        codes = codes[:, np.abs(codes.sum(axis=0)) < n]  # a bit must split the languages
        gaps = (codes[:, None] != codes[None]).sum(axis=2) + codes.shape[1] * np.eye(n, dtype=int)
        if gaps.min() > far:
            best, far = codes, gaps.min()
    return best


def _grams(text: str) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of the lower-cased letters, in turns."""
    data = b" ".join((" " + text.lower() + " ").encode("utf-8", "replace").translate(PLAIN).split())
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    for at in range(0, max(1, len(raw) - 2), TURN):
        x = raw[at : at + TURN + 2].astype(np.uint32)
        mixed = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B)) ^ (x[2:] * np.uint32(0xC2B2AE35))
        yield (mixed ^ (mixed >> np.uint32(15))) & np.uint32(TABLE - 1)


def train(docs: DataFrame, held_out: Column, per_language: int = 1_000, most: int = 256) -> Model:
    """Learns from about `per_language` documents of each lang that are not held out.

    The bound holds in expectation: rows are drawn by a hash of their doc_id, at
    the same rate for a whole language. A language with fewer rows gives all. At most
    `most` languages are learned, those with the most rows (of equals the first by name), so
    that a column of dirty names makes neither the model nor the plan grow.
    """
    rows = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most)
    sizes = {r["lang"]: r["count"] for r in counts.collect()}
    names = sorted(sizes)
    if not names:
        return Model([], np.ones((0, 1)), np.zeros((TABLE, 1)), np.ones(1), np.ones(1))
    rate = F.lit(0.0)
    for name in names:
        rate = F.when(F.col("lang") == name, per_language / sizes[name]).otherwise(rate)
    picked = rows.where(spread(F.col("doc_id"), "language") < rate)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lettered(text.as_py()):
                    of = sum(np.bincount(g, minlength=TABLE) for g in _grams(text.as_py()))
                    # A long text counts as much as a short one.
                    counts[lang] = counts.get(lang, 0.0) + of / of.sum()
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                columns = [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    tallies = picked.mapInArrow(counted, "lang string, gram int, n double").groupBy("lang", "gram")
    share = np.full((len(names), TABLE), 1e-7)
    place = {name: i for i, name in enumerate(names)}
    for row in tallies.agg(F.sum("n").alias("n")).collect():
        share[place[row["lang"]], row["gram"]] += row["n"]
    share /= share.sum(axis=1, keepdims=True)
    codes = codewords(len(names))
    weights = np.stack(
        [np.log(share[codes[:, b] > 0].mean(axis=0)) - np.log(share[codes[:, b] < 0].mean(axis=0)) for b in range(codes.shape[1])]
        if len(names) > 1
        else [np.zeros(TABLE)],
        axis=1,
    )
    typical = share @ weights  # each language's own mean log-odds
    scale = np.maximum(np.abs(typical).mean(axis=0), 1e-9)
    trust = np.maximum(np.minimum.reduce(typical * codes / scale, axis=0), 0.05)
    return Model(names, codes, weights.astype(np.float32), scale, trust / trust.sum())


def judge(text: str | None, model: Model) -> tuple[str, float, bool]:
    """(language, score, ambiguous)."""
    if text is None or not lettered(text):
        return "und", 0.0, True
    if not model.names:
        return "und", 0.0, False
    total, n = 0.0, 0
    for grams in _grams(text):
        total, n = total + model.weights[grams].sum(axis=0, dtype=np.float64), n + len(grams)
    margin = model.codes * (total / max(n, 1) / model.scale)
    loss = np.logaddexp(0, -4 * margin) @ model.trust
    chance = np.exp(-4 * (loss - loss.min()))
    chance /= chance.sum()
    order = np.argsort(-chance, kind="stable")
    lead = chance[order[0]] - (chance[order[1]] if len(order) > 1 else 0.0)
    return model.names[order[0]], float(chance[order[0]]), bool(lead < LEAD)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and ambiguous added, from the whole text alone.

    A text that is null or has no letter is `und` with score 0 and ambiguous. If
    nothing was learned every other text is `und` too, but not called ambiguous.
    Existing columns of these names are replaced.
    """
    names = ["lang_pred", "score", "ambiguous"]
    shape = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def make(texts: list[str | None]) -> pa.Array:
        return pa.array([dict(zip(names, judge(t, model))) for t in texts], shape)

    found = by_text(make, "lang_pred string, score double, ambiguous boolean")("text")
    rest = [c for c in docs.columns if c not in names]
    own = inner(docs, "_found")
    return docs.select(*rest, found.alias(own)).select(*rest, *(F.col(f"{own}.{n}") for n in names))


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id divides by five."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """docs without those that have no letters or no language that leads."""
    return identify(docs, model).where(~F.col("ambiguous")).select(*docs.columns)
