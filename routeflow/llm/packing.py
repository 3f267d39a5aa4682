"""Best-fit packing by linear grouping.

Documents are tokenized and cut into pieces of at most ``CAPACITY`` ids. Lengths are whole numbers up to the
capacity, so what the plan is made of is bounded whatever the corpus: a histogram of lengths and one of
free space, ``CAPACITY`` rows each. On the driver:

1. Large pieces (over ``CAPACITY`` / ``LARGE``) are ranked by length and cut into ``GROUPS`` groups of equal cardinality; each
   length is rounded up to the longest of its group.
2. Configurations (multisets of few rounded sizes that fit one sequence) are optimised as a linear program by column
   generation; the fractional rest is packed first-fit.
3. Best-fit, longest first, places the small pieces into the free space that the actual documents leave.

Spark ranks the pieces of each length in parallel (``common.ranked``), substitutes them for the slots of the plan by
their rank, measures the free space of each sequence, ranks sequences of equal free space and joins the small pieces to
them. No step needs the pieces of a length, group or source in one task.

Defined results: a NULL or empty text is the closing id alone; texts of any length are cut, never dropped; rows that
repeat an id are packed as documents of their own; an empty table gives an empty result; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import bisect
import os
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import category, is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.llm.common import ranked, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

CAPACITY = 4096
LARGE = 4
GROUPS = 96
CLOSING_ID = 1
BLOCK_ROWS = 20_000
#: Units and odd words kept per Python worker with their ids, half of either at most, each in two generations; forgotten after each task.
CACHE_WORDS = 500_000
#: Documents sent to a Python worker at once: texts are long, and a batch of them is held on both sides.
BATCH_DOCS = 1_000
#: Units given to the tokenizer's model at once.
BATCH_UNITS = 4_000
#: Bytes of text that are cut into words at once, or one text that is longer.
CUT_BYTES = 1 << 23

PIECE_FIELDS = "piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- tokenizing -------------------------------------------------------------------------------------------------------

#: White space to the tokenizer or to Python, but not to both in the same way.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A letter they lower-case in different ways, and how the tokenizer's added tokens begin, which are found before anything else.
_ODD = ("Σ", "<|")
#: The tokenizer's units of lower-cased words that each end with a line feed, which no word contains.
_UNIT = re.compile(r"[^\W\d_]+|\n|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]+|_+)+")


def _is_odd(c: str) -> bool:
    """Whether Python might cut a word with this character in another way than the tokenizer."""
    if c.isascii():
        return bool(_ODD_SPACE.match(c))
    return not c.isalpha() and (c.isalnum() or category(c) == "Cn" or bool(_ODD_SPACE.match(c)))


class _Recent(dict):
    """key -> what ``make`` returns for it (a list for a list of keys), kept for the keys met last in two generations of at most ``limit`` keys."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def of(self, keys: list[str]) -> list[bytes]:
        """``keys`` do not repeat."""
        out = []
        for k in range(0, len(keys), self.limit):
            out += self._some(keys[k : k + self.limit])
        return out

    def _some(self, keys: list[str]) -> list[bytes]:
        out = list(map(self.get, keys))
        missing = [k for k, x in zip(keys, out) if x is None]
        if not missing:
            return out
        values = list(map(self.older.get, missing))
        made = iter(self.make([k for k, x in zip(missing, values) if x is None]))
        values = [next(made) if x is None else x for x in values]
        if len(self) + len(missing) > self.limit:
            self.older = dict(self)
            self.clear()
        self.update((k, x) for k, x in zip(missing, values) if len(k) < 64)
        found = iter(values)
        return [next(found) if x is None else x for x in out]


def _starts(lengths: pa.Array) -> np.ndarray:
    """Where parts of these lengths begin, one after the other, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)])


class WordIds:
    """Ids of texts as little-endian uint32 bytes; those of the units met last are kept.

    The tokenizer lower-cases a text, drops white space, cuts words into units (runs of letters, single digits, runs of others) and gives
    each unit to its BPE model, so a text's ids are those of its words, and a word's those of its units. Texts are taken many at once:
    Arrow finds their different words, one search cuts these into units, and each different unit is looked up or given to the model. A word
    that Python might lower-case or cut in another way goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        self.units_only = Tokenizer(self.whole.model)
        self.units_only.pre_tokenizer = WhitespaceSplit()
        self.known = _Recent(self._odd_words, CACHE_WORDS // 4)
        self.units = _Recent(self._units, CACHE_WORDS // 4)
        # The byte alphabet of byte-level BPE: printable bytes stand for themselves, the others follow from 256 on; the space between units stays.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = np.arange(256, dtype="<u4")
        self.alphabet[others] = 256 + np.arange(len(others))
        self.alphabet[32] = 32
        # A unit's last id is one of those whose names have the model's suffix.
        vocab, suffix = self.whole.get_vocab(with_added_tokens=False), self.whole.model.end_of_word_suffix
        self.is_last = np.zeros(max(vocab.values()) + 1, bool)
        self.is_last[[i for x, i in vocab.items() if suffix and x.endswith(suffix)]] = True

    @property
    def older(self) -> dict[str, bytes]:
        return self.known.older

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of units, none of which is empty or has a space."""
        if len(units) > BATCH_UNITS:
            return [x for k in range(0, len(units), BATCH_UNITS) for x in self._units(units[k : k + BATCH_UNITS])]
        text = self.alphabet[np.frombuffer(" ".join(units).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.units_only.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.is_last[ids]) + 1
        if len(ends) != len(units) or (units and ends[-1] != len(ids)):
            return [np.array([x.id for x in self.whole.model.tokenize(unit)], "<u4").tobytes() for unit in text.split(" ")]
        at, data = [0, *(4 * ends).tolist()], ids.tobytes()
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _odd_words(self, words: list[str]) -> list[bytes]:
        return [np.array(self.whole.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in words]

    def forget(self) -> None:
        for kept in (self.known, self.units):
            kept.clear()
            kept.older = {}
        pa.default_memory_pool().release_unused()

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of words that do not repeat."""
        words = words.to_numpy(zero_copy_only=False).tolist()
        joined = "\n".join([*words, ""])
        low, odd = joined.lower(), []
        odd_parts = [c for c in set(low) if _is_odd(c)] + [x for x in _ODD if x in joined]
        if odd_parts or not (joined.isascii() or is_normalized("NFC", joined)):
            find = re.compile("|".join(map(re.escape, odd_parts)) or "(?!)").search
            odd = [k for k, w in enumerate(words) if find(f"{w}\n{w.lower()}") or not (w.isascii() or is_normalized("NFC", w))]
            plain = [*words, ""]
            for k in odd:
                plain[k] = ""
            low = "\n".join(plain).lower()
        if not words:
            return pa.array([], pa.large_binary())
        cut = pa.array(_UNIT.findall(low), pa.string()).dictionary_encode()
        units = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        line_feed = units.index("\n")
        ids = self.units.of(units[:line_feed] + units[line_feed + 1 :])
        ids.insert(line_feed, b"")
        ids = pa.array(ids, pa.large_binary()).take(cut.indices)
        starts = np.concatenate([[0], _starts(pc.binary_length(ids))[1:][cut.indices.to_numpy() == line_feed]])
        out = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(starts), ids.buffers()[2] or pa.py_buffer(b"")])
        if odd:
            out = out.to_numpy(zero_copy_only=False).tolist()
            for k, x in zip(odd, self.known.of([words[k] for k in odd])):
                out[k] = x
            out = pa.array(out, pa.large_binary())
        return out

    def of_texts(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """The ids of all texts one after the other, and where those of each begin (in bytes) and the last ones end."""
        parts = pc.ascii_split_whitespace(texts)
        words = parts.flatten().dictionary_encode()
        ids = self._of_words(words.dictionary).take(words.indices)
        at = _starts(pc.binary_length(ids))[_starts(pc.list_value_length(parts))]
        return memoryview(ids.buffers()[2] or b""), at.tolist()

    def of(self, text: str) -> bytes:
        return self.of_texts(pa.array([text], pa.string()))[0].tobytes()


def _word_ids(path: str) -> WordIds:
    """One ``WordIds`` per worker process and file, as reading the file takes time. A worker outlives its job: it forgets the words after each task."""
    import tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    kept = tokenizers.__dict__.setdefault("_word_ids_by_path", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32."""
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        ids_of = _word_ids(path)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        try:
            for batch in batches:
                texts = batch.column("text")
                group = _starts(pc.binary_length(texts))[1:] // CUT_BYTES
                cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(texts)]
                at, piece, start, length, crc = [], [], [], [], []
                for first, last in zip(cuts, cuts[1:]):
                    ids, ends = ids_of.of_texts(texts.slice(first, last - first))
                    for row, (begin, end) in enumerate(zip(ends, ends[1:]), first):
                        n = (end - begin) // 4 + 1  # with the closing id
                        for k, before in enumerate(range(0, n, capacity)):
                            here = min(capacity, n - before)
                            sum_of_ids = crc32(ids[begin + 4 * before : min(begin + 4 * (before + here), end)])
                            at.append(row)
                            piece.append(k)
                            start.append(before)
                            length.append(here)
                            crc.append(crc32(closing, sum_of_ids) if before + here == n else sum_of_ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["key", "piece", "start", "length", "ids_crc32"],
                )
        finally:
            ids_of.forget()

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"key {kind}, {PIECE_FIELDS}")


# --- the plan: driver-side, on histograms of at most `capacity` rows -----------------------------------------------------


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Fewest sequences for ``demand[g]`` items of ``sizes[g]``, as a linear program by column generation.

    Keeps a square basis of configurations with B x = demand. A configuration worth more than one sequence at the
    current prices (a knapsack over the capacity) enters, the one that first reaches zero leaves.
    """
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(40 * n):
        price = np.linalg.solve(basis.T, np.ones(n))
        best = np.zeros(capacity + 1)
        pick = np.full(capacity + 1, -1)
        for g in np.argsort(sizes):
            s, p = sizes[g], price[g]
            if p <= 1e-12:
                continue
            # unbounded knapsack: each stretch of s entries builds on the one before
            for used in range(1, capacity // s + 1):
                lo = used * s
                hi = min(lo + s, capacity + 1)
                gain = best[lo - s : hi - s] + p
                better = gain > best[lo:hi] + 1e-12
                best[lo:hi] = np.where(better, gain, best[lo:hi])
                pick[lo:hi] = np.where(better, g, pick[lo:hi])
        top = int(np.argmax(best))
        if best[top] <= 1 + 1e-7:
            break
        column, left = np.zeros(n), top
        while left > 0 and pick[left] >= 0:
            column[pick[left]] += 1
            left -= sizes[pick[left]]
        x, step = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.linalg.solve(basis, need)
    return [([int(a) for a in basis[:, k]], float(x[k])) for k in range(n)]


def plan_large(counts: dict[int, int], capacity: int, groups: int) -> tuple[int, list[tuple[int, int, int, int]], int]:
    """Group cardinality, slots (group, first slot, sequence base, sequences) and number of sequences."""
    total = sum(counts.values())
    if not total:
        return 1, [], 0
    size = -(-total // groups)
    lengths = sorted(counts, reverse=True)
    ends = np.cumsum([counts[x] for x in lengths])
    firsts = range(0, total, size)
    sizes = [lengths[int(np.searchsorted(ends, r, side="right"))] for r in firsts]
    demand = [min(size, total - r) for r in firsts]
    chosen = [(a, int(x + 1e-9)) for a, x in _configurations(sizes, demand, capacity) if x >= 1]
    left = list(demand)
    for a, m in chosen:
        left = [d - k * m for d, k in zip(left, a)]
    while any(d > 0 for d in left):  # sizes descend: first fit of the rest, as many equal sequences at once as possible
        a, free = [], capacity
        for s, d in zip(sizes, left):
            a.append(min(max(d, 0), free // s))
            free -= a[-1] * s
        m = min(d // k for d, k in zip(left, a) if k)
        chosen.append((a, m))
        left = [d - k * m for d, k in zip(left, a)]
    slots, base, filled = [], 0, [0] * len(sizes)
    for a, m in chosen:
        for g, k in enumerate(a):
            if k:
                slots.append((g, filled[g], base, m))
                filled[g] += k * m
        base += m
    return size, sorted(slots), base


def plan_small(counts: dict[int, int], free: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit, longest first, on histograms: rows (length, first rank, free space or -1, first bin, pieces per bin) and new sequences.

    Bins of equal free space are handled as ranges. Filling one bin with as many pieces of a length as fit, before the next,
    is what best fit does one piece at a time.
    """
    ranges: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for space, n in free.items():
        if space and n:
            ranges[space].append((space, 0, n))
    spaces, rows, new = sorted(ranges), [], 0

    def put(space: int, found: tuple[int, int, int]) -> None:
        if space and found[1] < found[2]:
            if not ranges[space]:
                bisect.insort(spaces, space)
            ranges[space].append(found)

    for s in sorted(counts, reverse=True):
        rank, left = 0, counts[s]
        while left:
            k = bisect.bisect_left(spaces, s)
            if k == len(spaces):
                bins = -(-left // (capacity // s))
                put(capacity, (-1, new, new + bins))
                new += bins
                continue
            space = spaces[k]
            origin, lo, hi = ranges[space].pop()
            if not ranges[space]:
                spaces.pop(k)
            each = space // s
            full = min(hi - lo, left // each)
            if full:
                rows.append((s, rank, origin, lo, each))
                put(space - each * s, (origin, lo, lo + full))
                rank, left, lo = rank + full * each, left - full * each, lo + full
            if lo < hi and left and left < each:
                rows.append((s, rank, origin, lo, left))
                put(space - left * s, (origin, lo, lo + 1))
                rank, left, lo = rank + left, 0, lo + 1
            put(space, (origin, lo, hi))
    return rows, new


# --- packing ---------------------------------------------------------------------------------------------------------


def _histogram(df: DataFrame, column: str) -> dict[int, int]:
    """At most ``capacity`` + 1 rows, whatever the input."""
    return {r[0]: r[1] for r in df.groupBy(column).agg(F.count(F.lit(1))).collect()}


def _ranked_by(df: DataFrame, column: str, order: list, rank: str) -> DataFrame:
    """0-based rank among the rows of equal ``column`` (at most ``capacity`` values: their counts are broadcast)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    joined = df.join(F.broadcast(counts), column)
    spread = F.xxhash64(*order)
    out = ranked(joined, [column], [spread, *order], spread, "__n", BLOCK_ROWS, rank)
    return out.drop("__n").withColumn(rank, F.col(rank) - 1)


def _place(rows: DataFrame, place, names: list[str]) -> DataFrame:
    """``rows`` with the long columns ``names`` that ``place`` makes of the numpy arrays of length and rank."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = place(*(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in made)], names=[*batch.schema.names, *names])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return rows.mapInArrow(over, schema)


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32) with sequence_id and offset."""
    order = [F.col(c) for c in ("key", "piece", "ids_crc32", "start")]
    cut = staged(cut, "pieces", batch_rows=BATCH_DOCS)
    counts = _histogram(cut, "length")
    rows = staged(_ranked_by(cut, "length", order, "rank"), "ranked-pieces")

    small_up_to = capacity // large
    n_full = counts.get(capacity, 0)
    big = {x: n for x, n in counts.items() if small_up_to < x < capacity}
    size, slots, n_large = plan_large(big, capacity, groups)
    longer = np.zeros(capacity + 2, np.int64)  # large pieces longer than a length
    for x in range(capacity - 1, 0, -1):
        longer[x] = longer[x + 1] + big.get(x + 1, 0)
    span = np.int64(size + 1)
    slot_at = np.array([g * span + k for g, k, _, _ in slots] or [0], np.int64)
    slot_base = np.array([b for *_, b, _ in slots] or [0], np.int64)
    slot_m = np.array([m for *_, m in slots] or [1], np.int64)
    slot_first = np.array([k for _, k, _, _ in slots] or [0], np.int64)

    def place_large(length: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
        place = longer[length] + rank
        group, slot = place // size, place % size
        at = np.searchsorted(slot_at, group * span + slot, side="right") - 1
        sequence = n_full + slot_base[at] + (slot - slot_first[at]) % slot_m[at]
        return [np.where(length == capacity, rank, sequence)]

    first = staged(_place(rows.where(F.col("length") > small_up_to), place_large, ["sequence_id"]), "large-placed")
    used = first.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("space"))
    used = staged(used.where("space > 0"), "free-space")
    plan, n_new = plan_small({x: n for x, n in counts.items() if x <= small_up_to}, _histogram(used, "space"), capacity)
    plan = sorted(plan) or [(0, 0, -1, 0, 1)]
    keys = np.array([(r[0] << 40) + r[1] for r in plan], np.int64)  # a length is below 2**23, a rank below 2**40
    table = np.array([r[1:] for r in plan], np.int64)

    def place_small(length: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(keys, (length << 40) + rank, side="right") - 1
        began, space, lo, each = table[at].T
        return [space, lo + (rank - began) // each]

    bins = _ranked_by(used, "space", [F.col("sequence_id")], "bin")
    placed = _place(rows.where(F.col("length") <= small_up_to), place_small, ["space", "bin"])
    fields = ["key", "piece", "start", "length", "ids_crc32", "sequence_id"]
    into_new = placed.where("space = -1").withColumn("sequence_id", F.lit(n_full + n_large) + F.col("bin"))
    into_old = placed.where("space >= 0").join(bins, ["space", "bin"])
    everything = first.select(*fields).unionByName(into_new.select(*fields)).unionByName(into_old.select(*fields))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "key", "piece", "ids_crc32")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return everything.withColumn("offset", F.coalesce(before, F.lit(0)).cast("long"))


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs``: ``key``, piece, start, length, ids_crc32, sequence_id, offset."""
    packed = pack_pieces(pieces(docs, text, key, tokenizer, capacity), capacity)
    return packed.withColumnRenamed("key", key)
