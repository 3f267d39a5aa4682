"""Substring deduplication with suffix automata of reference shards.

Every word covered by a window of ``WINDOW`` consecutive words whose word sequence also starts anywhere else, in the same or another
document, is removed; windows are judged on the input.

The corpus is its own reference. Broadcasting an automaton of every reference shard to every document would cost shards times documents,
so shards are cut such that a document meets only the few that can match it, and travel by shuffle:

1. A window belongs to the smallest hash of the 8-word groups inside it, its owner. Equal windows have equal owners, so all occurrences of
   a window lie in the shard of its owner. Neighbouring windows of one owner form a segment (some 50 words).
2. Owners that occur once cannot repeat and are left out; no text has been shuffled yet. For the others the segments are cut from
   the documents that hold them.
3. Per shard one suffix automaton of its distinct segments, with occurrence counts, is built; the segments are streamed through it. The matching
   statistic at a word is the longest suffix that occurs at least twice; maximal spans of ``WINDOW`` words or more are removed.
4. An owner of more than ``SHARD_SEGMENTS`` segments (a passage that very many documents share) or ``SHARD_WORDS`` words (a line
   repeated over and over is one segment) would be an unbounded shard. Its windows are counted by a 128-bit hash instead, with map-side aggregation: an exact way for what does not fit an automaton.
5. Spans are merged into maximal ones before they are gathered per document, and joined to the texts; they are broadcast only if
   rows and spans together are few (``common.small_side``).

Defined results: words are runs of characters other than the six white-space ones, unchanged; a NULL text has no words; a text of any
length is treated whole; rows that repeat an id are documents of their own unless the text repeats too, in which case each copy counts
as an occurrence and all lose the same words; an empty table gives an empty result; other columns are carried (one
called clean_text, n_words or n_removed is replaced).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.llm.common import fresh_name, small_side, staged
from routeflow.llm.shingles import WordHashes, split_words, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

WINDOW = 35
GROUP = 8
SHARD_SEGMENTS = 1000
#: A segment of periodic text is as long as the text, so the words of a shard are bounded too.
SHARD_WORDS = 200_000
#: Windows of hot owners that one batch holds, or those of one segment.
BATCH_WINDOWS = 200_000


def segments(words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """First windows, last windows, owners and numbers of owner places of the segments of a list of word hashes."""
    if len(words) < window:
        return (np.empty(0, np.int64),) * 4
    groups = window_hashes(words, GROUP)
    place = np.lib.stride_tricks.sliding_window_view(groups, window - GROUP + 1).argmin(axis=1)
    place = place + np.arange(len(place))
    owner = groups[place]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(owner)] - 1
    moved = np.cumsum(np.r_[0, place[1:] != place[:-1]])
    return first, last, owner[first].view(np.int64), moved[last] - moved[first] + 1


class Automaton:
    """Suffix automaton of several word sequences, with the number of places where each state's strings end."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, following: dict[str, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word: str, q: int) -> int:
        """A copy of ``q`` for its strings of up to length(p) + 1 words."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[str], times: int) -> None:
        at, step, link, length = 0, self.next, self.link, self.length
        for word in words:
            q = step[at].get(word)
            if q is not None:
                at = q if length[q] == length[at] + 1 else self._split(at, word, q)
            else:
                new, p = self._state(length[at] + 1, 0, {}), at
                while p >= 0 and word not in step[p]:
                    step[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = step[p][word]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                at = new
            self.count[at] += times

    def close(self) -> None:
        """Sum the counts over suffix links and keep, per state, the longest suffix that occurs twice."""
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for s in reversed(order):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]
        self.twice = [0] * len(self.link)
        for s in order:
            self.twice[s] = self.length[s] if self.count[s] > 1 else self.twice[self.link[s]]

    def spans(self, words: list[str], window: int) -> list[tuple[int, int]]:
        """Maximal spans of at least ``window`` words that occur twice; their union, as (first, end)."""
        out: list[tuple[int, int]] = []
        at = 0
        for j, word in enumerate(words):
            at = self.next[at][word]
            best = min(self.twice[at], j + 1)
            if best >= window:
                first = j + 1 - best
                if out and first <= out[-1][1]:
                    out[-1] = (min(first, out[-1][0]), j + 1)
                else:
                    out.append((first, j + 1))
        return out


def shard_spans(texts: dict[str, int], window: int) -> dict[str, list[tuple[int, int]]]:
    """Spans per distinct segment of one shard; ``texts`` counts its segments."""
    split = {t: t.split(" ") for t in texts}
    if len(texts) == 1 and min(texts.values()) > 1:
        return {t: [(0, len(w))] for t, w in split.items()}
    automaton = Automaton()
    for t, w in split.items():
        automaton.add(w, texts[t])
    automaton.close()
    return {t: automaton.spans(w, window) for t, w in split.items()}


def _owners(docs: DataFrame, text: str, key: str, window: int) -> DataFrame:
    """key, text_hash and the segments' owners, place counts and lengths in words, per document of at least ``window`` words."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            at, owners, places, lengths = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                first, last, owner, n = segments(known.of(split_words(value.as_py() or "")), window)
                if len(owner):
                    at.append(row)
                    owners.append(owner)
                    places.append(n.astype(np.int32))
                    lengths.append((last - first + window).astype(np.int32))
            taken = pa.array(at, pa.int64())
            offsets = pa.array(np.cumsum([0, *map(len, owners)]), pa.int32())
            flat = [pa.array(np.concatenate(x) if x else np.empty(0, kind)) for x, kind in ((owners, np.int64), (places, np.int32), (lengths, np.int32))]
            lists = [pa.ListArray.from_arrays(offsets, x) for x in flat]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(taken), batch.column("text_hash").take(taken), *lists], names=["key", "text_hash", "owners", "places", "lengths"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(over, f"key {kind}, text_hash long, owners array<long>, places array<int>, lengths array<int>")


def _cut(docs: DataFrame, hits: DataFrame, text: str, key: str, window: int) -> DataFrame:
    """Segments of repeated owners: owner, hot, key, text_hash, first (word number), body (words joined by a space)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    ids = small_side(staged(hits.select(F.col("key").alias("k"), F.col("text_hash").alias("h")), "repeating-ids"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h"))
    rows = rows.join(ids, same, "left_semi")
    marked = hits.select(F.col("key").alias("k"), F.col("text_hash").alias("h"), "owners", "hot_owners")
    rows = rows.join(marked, same).select("key", "text_hash", "text", "owners", "hot_owners")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            at, owners, hots, firsts, bodies = [], [], [], [], []
            for row, (value, normal, hot) in enumerate(zip(batch.column("text"), batch.column("owners"), batch.column("hot_owners"))):
                words = split_words(value.as_py())
                first, last, owner, _ = segments(known.of(words), window)
                normal, hot = (x.values.to_numpy(zero_copy_only=False) for x in (normal, hot))
                is_hot = np.isin(owner, hot)
                for k in np.flatnonzero(is_hot | np.isin(owner, normal)):
                    at.append(row)
                    owners.append(int(owner[k]))
                    hots.append(bool(is_hot[k]))
                    firsts.append(int(first[k]))
                    bodies.append(" ".join(words[first[k] : last[k] + window]))
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.int64()), pa.array(hots, pa.bool_()), batch.column("key").take(taken), batch.column("text_hash").take(taken), pa.array(firsts, pa.int32()), pa.array(bodies, pa.string())],
                names=["owner", "hot", "key", "text_hash", "first", "body"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(over, f"owner long, hot boolean, key {kind}, text_hash long, first int, body string")


def _spans_schema(cut: DataFrame) -> str:
    return f"key {cut.schema['key'].dataType.simpleString()}, text_hash long, lo int, hi int"


def _by_automaton(cut: DataFrame, window: int) -> DataFrame:
    """Spans (key, text_hash, lo, hi) of segments whose shard fits an automaton (at most ``SHARD_SEGMENTS`` segments)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(shard: list[tuple]) -> None:
            texts: dict[str, int] = {}
            for *_, body in shard:
                texts[body] = texts.get(body, 0) + 1
            found = shard_spans(texts, window)
            for key, text_hash, first, body in shard:
                out.extend((key, text_hash, first + a, first + b) for a, b in found[body])

        out: list[tuple] = []
        owner, shard, kinds = None, [], None
        for batch in batches:
            kinds = batch.schema
            for o, *rest in zip(*(batch.column(c).to_pylist() for c in ("owner", "key", "text_hash", "first", "body"))):
                if o != owner and shard:
                    finish(shard)
                    shard = []
                owner = o
                shard.append(tuple(rest))
            if len(out) > 20_000:
                yield batch_of(out, kinds)
                out = []
        if shard:
            finish(shard)
        if out:
            yield batch_of(out, kinds)

    def batch_of(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
        types = [kinds.field("key").type, pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "text_hash", "lo", "hi"])

    shards = cut.where("not hot").drop("hot").repartition("owner").sortWithinPartitions("owner")
    return shards.mapInArrow(over, _spans_schema(cut))


def _by_counting(cut: DataFrame, window: int) -> DataFrame:
    """Spans of the segments of hot owners: windows counted by two 64-bit hashes over word hashes of different seeds.

    Windows that differ are taken for equal only if both hashes collide; words that collide in one do not in the other.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(), WordHashes(seed=1)
        for batch in batches:
            at, held = 0, 0
            for row, body in enumerate(batch.column("body")):
                held += body.as_py().count(" ") + 2 - window
                if held >= BATCH_WINDOWS or row == batch.num_rows - 1:
                    yield windows_of(batch.slice(at, row + 1 - at), known)
                    at, held = row + 1, 0

    def windows_of(batch: pa.RecordBatch, known: tuple[WordHashes, WordHashes]) -> pa.RecordBatch:
        split = [b.as_py().split(" ") for b in batch.column("body")]
        columns = [[hashes.of(words) for words in split] for hashes in known]
        sizes = np.array([len(words) - window + 1 for words in split], np.int64)
        taken = pa.array(np.repeat(np.arange(len(split)), sizes))
        one, two = (np.concatenate([window_hashes(c, window, seed) for c in hashed]).view(np.int64) for seed, hashed in ((1, columns[0]), (2, columns[1])))
        within = np.concatenate([np.arange(n) for n in sizes])
        first = batch.column("first").to_numpy(zero_copy_only=False).astype(np.int64)
        lo = np.repeat(first, sizes) + within
        return pa.RecordBatch.from_arrays([batch.column("key").take(taken), batch.column("text_hash").take(taken), pa.array(lo.astype(np.int32)), pa.array(one), pa.array(two)], names=["key", "text_hash", "lo", "w1", "w2"])

    kind = cut.schema["key"].dataType.simpleString()
    windows = staged(cut.where("hot").select("key", "text_hash", "first", "body").mapInArrow(over, f"key {kind}, text_hash long, lo int, w1 long, w2 long"), "hot-windows")
    twice = staged(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2"), "hot-repeats")
    found = windows.join(small_side(twice), ["w1", "w2"], "left_semi")
    return found.select("key", "text_hash", "lo", (F.col("lo") + window).alias("hi"))


def _merged(spans: DataFrame) -> DataFrame:
    """Maximal spans of each document: overlapping and touching ones as one, so a row's array does not hold a span per window."""
    once = spans.groupBy("key", "text_hash", "lo").agg(F.max("hi").alias("hi"))  # rows that repeat id and text have the same spans
    by_doc = Window.partitionBy("key", "text_hash").orderBy("lo")
    reached = F.max("hi").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    opens = once.withColumn("opens", F.when(F.col("lo") <= reached, 0).otherwise(1))
    joined = opens.withColumn("run", F.sum("opens").over(by_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return joined.groupBy("key", "text_hash", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """key, text_hash and ``spans`` (array of (lo, hi), word numbers) of the documents that lose words."""
    owned = staged(_owners(docs, text, key, window), "owners")
    each = owned.select("key", "text_hash", F.explode(F.arrays_zip("owners", "places", "lengths")).alias("x"))
    each = each.select("key", "text_hash", F.col("x.owners").alias("owner"), F.col("x.places").alias("places"), F.col("x.lengths").alias("length"))
    totals = each.groupBy("owner").agg(F.sum("places").alias("n"), F.count(F.lit(1)).alias("segments"), F.sum("length").alias("words")).where("n > 1")
    hot = (F.col("segments") > SHARD_SEGMENTS) | (F.col("words") > SHARD_WORDS)
    totals = staged(totals.select("owner", hot.alias("hot")), "repeated-owners")
    marked = each.select("key", "text_hash", "owner").join(small_side(totals), "owner")
    hits = marked.groupBy("key", "text_hash").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("owner"))).alias("owners"), F.collect_set(F.when(F.col("hot"), F.col("owner"))).alias("hot_owners")
    )
    cut = staged(_cut(docs, staged(hits, "repeating"), text, key, window), "segments", "zstd")
    spans = _merged(_by_automaton(cut, window).unionByName(_by_counting(cut, window)))
    return staged(spans.groupBy("key", "text_hash").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` with clean_text (the words that stay, joined by one space), n_words and n_removed."""
    spans = repeated_spans(docs, text, key, window)
    mark, of_key, of_hash, carried, body = (fresh_name(x, docs.columns) for x in ("__text_hash", "__k", "__h", "__spans", "__text"))
    rows = docs.withColumn(mark, F.xxhash64(text)).withColumn(body, F.col(text))
    short = spans.select(F.col("key").alias(of_key), F.col("text_hash").alias(of_hash), F.col("spans").alias(carried))
    rows = rows.join(small_side(short), F.col(key).eqNullSafe(F.col(of_key)) & (F.col(mark) == F.col(of_hash)), "left")
    kept = [c for c in docs.columns if c.lower() not in ("clean_text", "n_words", "n_removed")]
    rows = rows.select(*(F.col(f"`{c}`") for c in kept), body, carried)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, total, removed = [], [], []
            for value, found in zip(batch.column(body), batch.column(carried)):
                words = split_words(value.as_py() or "")
                total.append(len(words))
                if found.is_valid:
                    stay, at = [], 0
                    for span in found.as_py():
                        if span["hi"] > at:
                            stay += words[at : max(span["lo"], at)]
                            at = span["hi"]
                    words = stay + words[at:]
                removed.append(total[-1] - len(words))
                clean.append(" ".join(words))
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(clean, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=[*kept, "clean_text", "n_words", "n_removed"])

    made = [T.StructField("clean_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    return rows.mapInArrow(over, T.StructType([*(docs.schema[c] for c in kept), *made]))
