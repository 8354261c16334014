"""Sums and extremes over the last n bars of a chunk.

Spark re-reads every row of a sliding frame, so a frame of n bars costs n steps
per row. A long frame is therefore put together from equal short ones: one short
sliding frame, then ``lag`` reads of it. A read costs about a step, but brings
generated code of its own, so the pieces are chosen a little longer than their
number. Each function returns phases: dicts of SQL by output name, where a later
phase uses the columns of the one before.
"""

from __future__ import annotations

from barloom.operators.chunks import bars_ago, over_last, over_so_far

Phases = list[dict[str, str]]

# What a lag read weighs against a step of a sliding frame.
_SUM_READ = 1.5
_EXTREME_READ = 3.0


def _sum_piece(n: int) -> int:
    """Piece length for a sum: n = pieces * length + rest, the rest a frame of its own."""

    def cost(length: int) -> float:
        pieces, rest = divmod(n, length)
        return length + rest + _SUM_READ * (pieces - 1 + (rest > 0))

    return min(range(1, n + 1), key=cost)


def _extreme_piece(n: int) -> int:
    """Piece length for an extreme, whose pieces may overlap."""
    return min(range(1, n + 1), key=lambda k: k + _EXTREME_READ * (-(-n // k) - 1))


def rolling_sum(source: str, n: int, out: str) -> Phases:
    """Sum of the last n values; only meaningful where none of them is missing."""
    length = _sum_piece(n)
    if length == n:
        return [{out: over_last(f"sum({source})", n)}]
    pieces, rest = divmod(n, length)
    piece, tail = f"_{out}_piece", f"_{out}_tail"
    short = {piece: over_last(f"sum({source})", length)}
    reads = [bars_ago(piece, i * length) for i in range(pieces)]
    if rest:
        short[tail] = over_last(f"sum({source})", rest)
        reads.append(bars_ago(tail, pieces * length))
    return [short, {out: " + ".join(reads)}]


def _rolling_extreme(pick: str, merge: str, source: str, n: int, out: str) -> Phases:
    length = _extreme_piece(n)
    if length == n:
        return [{out: over_last(f"{pick}({source})", n)}]
    piece = f"_{out}_piece"
    offsets = [*range(0, n - length, length), n - length]
    reads = ", ".join(bars_ago(piece, k) for k in offsets)
    return [{piece: over_last(f"{pick}({source})", length)}, {out: f"{merge}({reads})"}]


def rolling_min(source: str, n: int, out: str) -> Phases:
    """Smallest of the last n values (fewer at the start), nulls skipped."""
    return _rolling_extreme("min", "least", source, n, out)


def rolling_max(source: str, n: int, out: str) -> Phases:
    """Largest of the last n values (fewer at the start), nulls skipped."""
    return _rolling_extreme("max", "greatest", source, n, out)


def last_gap(missing: str) -> str:
    """Position of the latest bar, up to this one, where ``missing`` holds."""
    return over_so_far(f"max(if({missing}, _pos, null))")


def complete(gap: str, n: int) -> str:
    """True where the last n bars exist and none of them is a gap."""
    return f"_pos - coalesce({gap}, -1L) >= {n}"


def side_by_side(*many: Phases) -> Phases:
    """Run several computations in the same phases."""
    merged: Phases = []
    for phases in many:
        for i, phase in enumerate(phases):
            if i == len(merged):
                merged.append({})
            merged[i].update(phase)
    return merged
