"""Secret scan: fixed patterns, and Markov models of random strings and identifiers.

Two first-order character models are counted from labelled tokens: random
strings, and words and identifiers as people write them. A token of the text is
reported where the random model explains it better by `log_odds`, the natural
logarithm of the prior odds against a secret.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import by_text, inner, sampled

#: The patterns of the base scan and the least length of what they find.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
VALUE = 8

KINDS = ("assign", "access", "hex", "random")
#: Runs that the models compare, and the longer ones of the fixed patterns' finds that they learn from.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
LEARNT = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{5,}")
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
#: Characters by class: their place in ORDER, 0 for the edge of a token.
ORDER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-"
STATES = len(ORDER) + 1
CODE = np.zeros(128, np.int64)
for _at, _char in enumerate(ORDER):
    CODE[ord(_char)] = _at + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    low, found = text.lower(), []
    if any(word in low for word in ("passw", "secret", "token", "api")):  # else the pattern finds nothing
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _steps(*tokens: str) -> np.ndarray:
    """Transitions of tokens, each from its edge through its characters and out again."""
    path = CODE[np.frombuffer("\n".join(["", *tokens, ""]).encode("ascii"), np.uint8)]
    return path[:-1] * STATES + path[1:]


def random_strings(spark: SparkSession, n: int = 20_000, seed: int = 7) -> DataFrame:
    """(token, secret): n random strings over the usual alphabets of keys."""
    draw = random.Random(seed)
    made = [("".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(20, 64))), True) for _ in range(n)]
    return spark.createDataFrame(made, "token string, secret boolean")


def _joined(words: list[str]) -> list[str]:
    """Pairs of words as identifiers are written; and a rule, a date and a number for every 100 words, as prose has them."""
    made = []
    for i, (a, b) in enumerate(zip(words, words[1:])):
        forms = f"{a}_{b}", f"{a}-{b}", a + b.capitalize(), f"{a}_{b}".upper(), a.capitalize() + b.capitalize(), a.upper()
        made.append(forms[i % len(forms)])
        if i % 100 == 0:
            k = i // 100 + len(a) * 7 + len(b)
            made += ["-=_+/"[k % 5] * 24, f"{1990 + k % 40}-{1 + k % 12:02}-{1 + k % 28:02}T{k % 24:02}"]
            made.append(str((k + 1) * 6364136223846793005 % 10**16))
    return made


def identifiers(docs: DataFrame, rows: int = 500) -> DataFrame:
    """(token, secret): words of about `rows` documents, alone and joined as identifiers are.

    What the fixed patterns find is a secret and counts for the other side.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for text in part.column("text"):
                text, tokens, secret, plain, at = text.as_py() or "", [], [], [], 0
                for start, _, end in base_spans(text):
                    plain.append(text[at:start])
                    tokens += [m.group() for m in LEARNT.finditer(text[start:end])]
                    at = max(at, end)
                secret += [True] * len(tokens)
                words = [w for x in [*plain, text[at:]] for w in WORD.findall(x)]
                joined = _joined(words)
                tokens += words + joined
                secret += [False] * (len(tokens) - len(secret))
                columns = [pa.array(tokens, pa.string()), pa.array(secret, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["token", "secret"])

    return sampled(docs.select("doc_id", "text"), "doc_id", rows, "secret").mapInArrow(
        batches, "token string, secret boolean"
    )


def train(samples: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition, from samples (token, secret).

    Counting is a grouped sum of at most 2 * STATES^2 rows. Every transition has
    one more count than seen; a model without samples is uniform.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            told = list(zip(batch.column("token").to_pylist(), batch.column("secret").to_pylist()))
            for label in (False, True):
                usable = [t for t, secret in told if secret == label and t is not None and t.isascii()]
                if usable:
                    total[label] = total.get(label, 0) + np.bincount(_steps(*usable), minlength=STATES**2)
        for label, n in total.items():
            at = np.flatnonzero(n)
            columns = [pa.array([label] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["secret", "step", "n"])

    rows = (
        samples.select("token", "secret")
        .where("secret is not null")
        .mapInArrow(counted, "secret boolean, step int, n long")
        .groupBy("secret", "step")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.ones((2, STATES**2))
    for row in rows:
        counts[int(row["secret"]), row["step"]] += row["n"]
    share = np.log(counts.reshape(2, STATES, STATES))
    share -= np.log(counts.reshape(2, STATES, STATES).sum(axis=2, keepdims=True))
    return (share[1] - share[0]).reshape(-1)


def spans(text: str | None, ratio: np.ndarray, log_odds: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything found; what the models add overlaps no base span."""
    text = text or ""
    base = base_spans(text)
    places = [m.span() for m in TOKEN.finditer(text)]
    if not places:
        return base
    # All tokens lie end to end; each has a transition more than characters.
    gains = ratio[_steps(*(text[a:b] for a, b in places))]
    sizes = np.array([b - a + 1 for a, b in places])
    likely = np.flatnonzero(np.add.reduceat(gains, np.cumsum(sizes) - sizes) >= log_odds)
    if not len(likely):
        return base
    starts, reach = [s for s, _, _ in base], list(accumulate((end for _, _, end in base), max))
    extra = []
    for i in likely.tolist():
        a, b = places[i]
        before = bisect_left(starts, b)
        if not before or reach[before - 1] <= a:
            extra.append((a, 3, b))
    return sorted(base + extra)


def told(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame, ratio: np.ndarray, log_odds: float = 14.0) -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256, spans and n_random added.

    Offsets count code points, ends exclusive. A null text counts as empty: no
    counts, the digest of the empty string, empty spans. Every row is kept, and
    existing columns of these names are replaced.
    """

    shape = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    names = [x.split()[0] for x in shape.split(", ")]
    kind = pa.struct([(name, pa.int64() if name.startswith("n_") else pa.string()) for name in names])

    def make(texts: list[str | None]) -> pa.Array:
        rows = []
        for text in texts:
            found = spans(text, ratio, log_odds)
            kinds = [kind for _, kind, _ in found]
            base = told([x for x in found if x[1] < 3])
            digest = hashlib.sha256(base.encode()).hexdigest()
            counts = [kinds.count(k) for k in range(4)]
            rows.append(dict(zip(names, (*counts[:3], digest, told(found), counts[3]))))
        return pa.array(rows, kind)

    found = by_text(make, shape)("text")
    rest = [c for c in docs.columns if c not in names]
    own = inner(docs, "_found")
    return docs.select(*rest, found.alias(own)).select(*rest, *(F.col(f"{own}.{n}") for n in names))


def redacted(docs: DataFrame, ratio: np.ndarray, log_odds: float = 14.0, mark: str = "[SECRET]") -> DataFrame:
    """docs with each found span of the text replaced by a mark, and n_chars set anew.

    Overlapping spans are replaced together. Texts without a secret, null ones
    too, stay as they are.
    """

    def make(texts: list[str | None]) -> pa.Array:
        out = []
        for text in texts:
            found = spans(text, ratio, log_odds)
            pieces, at = [], 0
            for start, _, end in found:
                if start >= at:
                    pieces += [text[at:start], mark]
                at = max(at, end)
            out.append("".join([*pieces, text[at:]]) if found else text)
        return pa.array(out, pa.string())

    clean = docs.withColumn("text", by_text(make, "string")("text"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
