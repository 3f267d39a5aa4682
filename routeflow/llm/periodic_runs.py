"""Periodic runs of words: maximal stretches in which the words repeat with a period, found and collapsed to one period.

Method (Baier grouping): the first phase of Baier's suffix sorter groups suffixes by their longest Lyndon prefix. The groups are taken
from the highest down; the positions just before the members of a group move, by how many members follow them, into new groups whose
prefix is longer by that many copies. The prefix lengths of the final groups are the Lyndon array. It is taken under an order of the
words and under its reverse: by the runs theorem every run holds, under one of the two, a Lyndon root that is the longest Lyndon word
at its start. Roots that are followed by their own copy are extended to both sides through longest common extensions, which gives the run.

Stretches without a repeated window of words hold no run that counts (``_window``), so the grouping works on the
others only; nothing is lost by that. Hashes only choose where to look: roots and extensions compare the words themselves.

Distribution: one narrow pass, no shuffle; a document is the unit of work. Linear space in its words, and time linear but for the sorting of
window hashes. Results: NULL text counts as no words; a document without runs has an empty list and keeps all words. Repeated
rows give repeated results, an empty table none. Other columns of the input are not read; result columns are lengthened by ``_`` where
the id column has their name.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.llm.common import fresh_name
from routeflow.llm.shingles import WordHashes, split_words, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

#: A run counts from this many words and this many periods on.
MIN_WORDS = 6
MIN_PERIODS = 4

#: Rows of one output batch.
BATCH_ROWS = 512

Rewrite = Callable[[object, list[str]], list[str]]


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position, by the grouping phase (``codes``: 0..k-1, all present).

    Positions of groups not yet taken form a linked list, so the position before a member is one look away.
    """
    n = len(codes)
    k = max(codes) + 1 if n else 0
    group = list(codes)
    members: list[list[int]] = [[] for _ in range(k)]
    for i, c in enumerate(codes):
        members[c].append(i)
    length = [1] * k
    below, above = list(range(-1, k - 1)), list(range(1, k + 1))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    g = k - 1
    while g >= 0:
        unit = length[g]
        mine = [s for s in members[g] if group[s] == g]
        members[g] = []
        pointed: dict[tuple[int, int], list[int]] = {}
        i = 0
        while i < len(mine):
            end, before, count = mine[i], left[mine[i]], 1
            out[end] = unit
            i += 1
            while i < len(mine) and right[end] == mine[i]:
                end = mine[i]
                out[end] = unit
                count += 1
                i += 1
            after = right[end]
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                pointed.setdefault((count, group[before]), []).append(before)
        for (count, old), moved in sorted(pointed.items(), key=lambda x: -x[0][0]):  # more copies of the prefix are higher
            new = len(length)
            length.append(length[old] + count * unit)
            members.append(moved)
            for p in moved:
                group[p] = new
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
        g = below[g]
    return out


def _same_ahead(words: np.ndarray, i: int, j: int) -> int:
    """Longest common extension to the right of positions ``i`` < ``j``."""
    n, found, step = len(words), 0, 32
    while j + found < n:
        take = min(step, n - j - found)
        diff = np.flatnonzero(words[i + found : i + found + take] != words[j + found : j + found + take])
        if len(diff):
            return found + int(diff[0])
        found += take
        step *= 2
    return found


def _same_behind(words: np.ndarray, i: int, j: int) -> int:
    """Longest common extension to the left of positions ``i`` < ``j``, both excluded."""
    found, step = 0, 32
    while found < i:
        take = min(step, i - found)
        diff = np.flatnonzero(words[i - found - take : i - found] != words[j - found - take : j - found])
        if len(diff):
            return found + take - 1 - int(diff[-1])
        found += take
        step *= 2
    return found


def _squares(codes: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the Lyndon roots that seem (by hash) to be followed by a copy, by length, then start."""
    n = len(codes)
    at = np.flatnonzero(np.arange(n) + 2 * root <= n)
    size = root[at]
    power = np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64, out=prefix[1:])
    one, two = prefix[at + size] - prefix[at], prefix[at + 2 * size] - prefix[at + size]
    same = one * power[size] == two
    at, size = at[same], size[same]
    order = np.lexsort((at, size))
    return at[order], size[order]


def _runs_of(codes: np.ndarray, min_words: int, min_periods: int) -> set[tuple[int, int, int]]:
    found = set()
    for order in (codes, codes.max() - codes):
        last, end = 0, 0  # period and end of the run found last; its later roots are passed over
        at, size = _squares(codes, np.array(lyndon_lengths(order.tolist()), np.int64))
        for i, p in zip(at.tolist(), size.tolist(), strict=True):
            if p == last and i + p <= end:
                continue
            ahead = _same_ahead(codes, i, i + p)
            if ahead < p:  # no copy
                continue
            start = i - _same_behind(codes, i, i + p)
            last, end = p, i + p + ahead
            if end - start >= max(min_words, min_periods * p):
                found.add((start, end - start, p))
    return found


def _window(min_words: int, min_periods: int) -> int:
    """The longest window so that any window of a run that counts starts again one period before or after, inside the run."""
    return max(1, min(max(min_words, min_periods * q) - 2 * q + 1 for q in range(1, min_words + 2)))


def find_runs(words: list[str], hashes: WordHashes, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    k = _window(min_words, min_periods)
    if len(words) < max(min_words, k + 1):
        return []
    grams = window_hashes(hashes.of(words), k)
    ordered = np.sort(grams)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return []
    marked = np.concatenate(([False], np.isin(grams, again), [False]))
    edges = np.flatnonzero(marked[1:] != marked[:-1])
    out = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        end = b + k - 1  # windows start at a..b-1
        if end - a < min_words:
            continue
        codes: dict[str, int] = {}
        part = np.array([codes.setdefault(w, len(codes)) for w in words[a:end]], np.int64)
        out += [(a + s, n, p) for s, n, p in _runs_of(part, min_words, min_periods)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mapper(rewrite: Rewrite | None, min_words: int, min_periods: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                counts, found, kept = [], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = split_words(text or "")
                    if rewrite is not None:
                        words = rewrite(key, words)
                    runs = find_runs(words, hashes, min_words, min_periods)
                    counts.append(len(words))
                    found.append(runs)
                    kept.append(" ".join(collapse(words, runs)))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def collapse_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Rewrite | None = None,
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """(id, n_words, runs, collapsed_text): the runs of every document and its words without the repetitions.

    ``runs`` is an array of (start, length, period) in words, by start, then period. ``rewrite(id, words)`` may change the words
    before they are searched. ``min_periods`` is at least 3: from there on the first Lyndon root of a run is followed by its copy.
    """
    if min_periods < 3:
        raise ValueError("min_periods is at least 3")
    names = [id_col, *(fresh_name(x, [id_col]) for x in ("n_words", "runs", "collapsed_text"))]
    run = T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")])
    kinds = [docs.schema[id_col].dataType, T.LongType(), T.ArrayType(run), T.StringType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(_mapper(rewrite, min_words, min_periods, names), schema)


def strongest(runs: Column) -> Column:
    """The run with the most periods (exact; ties to the smallest start, then period); NULL without runs."""
    better = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(better(best, r), r).otherwise(best))


def digest(runs: Column) -> Column:
    """SHA-256 of the runs as ``start,length,period`` lines."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return F.sha2(F.concat_ws("", F.transform(runs, line)), 256)
