"""Near-duplicate detection with BagMinHash signatures.

A document is the multiset of its five-word windows. Similarity is weighted Jaccard, the sum of smaller counts over the
sum of larger counts; documents of similarity ``SIMILARITY`` or more are linked, and a class is a connected component of links.

1. Signature (inside a task): the weight axis of every element is cut at powers of two, and each piece carries a Poisson process
   seeded by element and piece, with the piece's width as its rate. A point has a time, a register and a place on the weight
   axis; it counts for a document if the place lies below the element's count. A register holds the earliest point that counts.
   Two documents agree in a register with probability equal to their similarity. Only points before a time limit by which all
   registers are filled are made, so a document costs about n + m log m points.
2. Documents with equal multisets collapse into one node, hot groups of copies first of all (map-side aggregation).
3. Banding: ``BANDS`` bands of ``ROWS`` registers. Each bucket links its members to one centre, another one in every band, so a bucket
   costs its size. Pairs are verified on the multisets; verified links give components.
4. What a star cannot see, a link between two members of a bucket that both miss its centre, is looked for only in buckets whose other
   members still lie in different components. What a document shares with no other member of such buckets bounds its similarity to all
   of them, which leaves out most; the others get a second signature of ``FINE`` registers, blocks of about ``BLOCK`` of them are compared
   register by register inside a task, and pairs that may reach the threshold are verified.

Distribution: shuffles carry node ids, band keys and, for candidate pairs, the multisets; the texts never. Every
iteration writes its labels to the shared folder. Nothing is collected but counts.

Defined results: words are runs of characters other than the six white-space ones, unchanged; a text of one to four words is one
element; a NULL text or one without words is a class of its own; rows that repeat an id and text share their class; the class id is
the smallest id in it (NULL only if all are); an empty table gives an empty result; other columns are carried by
``deduplicate`` and ignored by ``classes`` whatever their names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeflow.llm.common import fresh_name, small_side, staged
from routeflow.llm.shingles import WordHashes, mix64, split_words, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
REGISTERS = BANDS * ROWS
BLOCK = 256
#: Words kept with their hashes by a task (about 200 bytes each); a word met again after that is hashed again.
KNOWN_WORDS = 100_000
#: Texts or pairs of multisets sent to a Python worker at once.
BATCH_TEXTS = 1_000
#: Registers of the second signature, one byte each (marks that agree by chance only raise the agreement).
FINE = 1024
#: Register agreement of a pair at the threshold varies by this; pairs within four of it below are verified.
DEVIATION = math.sqrt(SIMILARITY * (1 - SIMILARITY) / FINE)
AGREEMENT = SIMILARITY - 4 * DEVIATION


# --- signatures ---------------------------------------------------------------------------------------------------------


def bag_of(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows (sorted hashes) and their counts; fewer than ``size`` words are one window."""
    hashes = window_hashes(words, min(size, len(words)), seed=min(size, len(words))) if len(words) else words
    return np.unique(hashes, return_counts=True)


_STEP = np.uint64(0xD1342543DE82EF95)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _points(seeds: np.ndarray, tops: np.ndarray, low: int, width: int, until: float, registers: int) -> tuple[np.ndarray, ...]:
    """Times, registers and marks of the points before ``until`` of Poisson processes on [low, low + width) of the weight
    axis that lie below ``tops``. Point number i of a process depends on its seed and i alone."""
    found = []
    clock, number, at, top = np.zeros(len(seeds)), 0, seeds, tops
    while len(at):
        expected = (until - clock.min()) * width
        take = 1 if not number else int(min(64, expected + 3 * math.sqrt(expected) + 2))
        state = mix64(at[:, None] + np.arange(number + 1, number + take + 1, dtype=np.uint64)[None, :] * _STEP)
        times = clock[:, None] + np.cumsum(-np.log(_uniform(state)) / width, axis=1)
        second = mix64(state + _STEP)
        ok = times <= until
        if width > 1:
            ok = ok & (low + (_uniform(mix64(second + _STEP)) * width).astype(np.int64) < top[:, None])
        found.append((times[ok], (second[ok] % np.uint64(registers)).astype(np.int64), (second[ok] >> np.uint64(16)).astype(np.uint32)))
        alive = times[:, -1] <= until
        clock, at, top, number = times[alive, -1], at[alive], top[alive], number + take
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0), np.empty(0, np.int64), np.empty(0, np.uint32))


def signature(elements: np.ndarray, counts: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """BagMinHash signature: ``size`` marks."""
    until = size * (math.log(size) + 4) / float(counts.sum())
    most = int(counts.max())
    while True:
        parts, low, width, level = [], 0, 1, 0
        while low < most:
            holds = counts > low
            seeds = mix64(elements[holds] ^ mix64(np.array([level + 1], np.uint64)))
            parts.append(_points(seeds, counts[holds], low, width, until, size))
            low, width, level = low + width, max(1, low + width), level + 1
        times, registers, marks = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((times, registers))
        filled, first = np.unique(registers[order], return_index=True)
        if len(filled) == size:
            return marks[order][first]
        until *= 2


def sketch(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per document with words: key, text_hash, digest, weight, bands (long keys)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        known = WordHashes(limit=KNOWN_WORDS)
        band = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            at, digests, weights, bands = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                words = split_words(value.as_py() or "")
                if not words:
                    continue
                elements, counts = bag_of(known.of(words))
                got = signature(elements, counts)
                keys = mix64(band + np.uint64(1))
                for column in got.reshape(BANDS, ROWS).T:
                    keys = mix64(keys * _STEP + column.astype(np.uint64))
                at.append(row)
                digests.append(blake2b(elements.tobytes() + counts.tobytes(), digest_size=16).digest())
                weights.append(int(counts.sum()))
                bands.append(keys.view(np.int64))
            taken = pa.array(at, pa.int64())
            offsets = pa.array(np.arange(len(at) + 1) * BANDS, pa.int32())
            flat = pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(taken), batch.column("text_hash").take(taken), pa.array(digests, pa.binary()), pa.array(weights, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                names=["key", "text_hash", "digest", "weight", "bands"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(over, f"key {kind}, text_hash long, digest binary, weight long, bands array<long>")


# --- verification -----------------------------------------------------------------------------------------------------------


def _bags(docs: DataFrame, nodes: DataFrame, text: str, key: str) -> DataFrame:
    """(node, elements, counts) of ``nodes`` (node, key, text_hash): the multisets, from the texts."""
    wanted = small_side(nodes.select("node", F.col("key").alias("of"), F.col("text_hash").alias("of_hash")))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    rows = rows.join(wanted, F.col("key").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))).select("node", "text")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes(limit=KNOWN_WORDS)
        for batch in batches:
            bags = [bag_of(known.of(split_words(v.as_py()))) for v in batch.column("text")]
            counts = [c.astype("<u4").tobytes() if c.max() > 1 else b"" for _, c in bags]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([e.tobytes() for e, _ in bags], pa.binary()), pa.array(counts, pa.binary())], names=["node", "elements", "counts"])

    return rows.mapInArrow(over, "node long, elements binary, counts binary").dropDuplicates(["node"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets given as sorted elements and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def _multiset(elements: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    e = np.frombuffer(elements, np.uint64)
    return e, np.frombuffer(counts, "<u4").astype(np.int64) if counts else np.ones(len(e), np.int64)


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets reach the threshold."""
    one = bags.select(F.col("node").alias("a"), F.col("elements").alias("ea"), F.col("counts").alias("ca"))
    two = bags.select(F.col("node").alias("b"), F.col("elements").alias("eb"), F.col("counts").alias("cb"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("ea", "ca", "eb", "cb")]
            ok = [similarity(_multiset(ea.as_py(), ca.as_py()), _multiset(eb.as_py(), cb.as_py())) >= SIMILARITY for ea, ca, eb, cb in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "ea", "ca", "eb", "cb").mapInArrow(over, "a long, b long")


# --- components ---------------------------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b): the smallest node of the component, by hooking and pointer jumping."""
    both = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hooked = staged(hooked, "hooked")
        jump = hooked.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jumped = hooked.join(jump, hooked["label"] == jump["at"]).select("node", "old", F.least("label", "further").alias("label"))
        jumped = staged(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("old <> label").limit(1).count():
            return labels


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b): only links between different components are walked."""
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = staged(labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))), "known-labels")
    one, two = (known.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")) for c in ("a", "b"))
    between = links.join(one, "a").join(two, "b").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()
    roots = components(staged(between, "between")).select(F.col("node").alias("root"), F.col("label").alias("now"))
    merged = known.join(roots, known["label"] == roots["root"], "left").select("node", F.coalesce("now", "label").alias("label"))
    return staged(merged, "merged-labels")


# --- candidates ---------------------------------------------------------------------------------------------------------


def _plausible(x: str, y: str):
    """Sizes alone allow the threshold."""
    return F.least(x, y) >= SIMILARITY * F.greatest(x, y)


def _shared_weight(multisets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, private): the weight of the elements that occur in no other of ``nodes``; nodes without any are left out."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, e, c in zip(batch.column("node"), batch.column("elements"), batch.column("counts")):
                elements, counts = _multiset(e.as_py(), c.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(elements.view(np.int64)), pa.array(counts), pa.array(np.full(len(elements), node.as_py(), np.int64))], names=["element", "n", "node"])

    each = multisets.join(small_side(nodes), "node", "left_semi").mapInArrow(over, "element long, n long, node long")
    alone = each.groupBy("element").agg(F.count(F.lit(1)).alias("nodes"), F.min("node").alias("node"), F.min("n").alias("n")).where("nodes = 1")
    return alone.groupBy("node").agg(F.sum("n").alias("private"))


def _fine_marks(multisets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, marks): the second signature of ``nodes``, independent of the first."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for e, c in zip(batch.column("elements"), batch.column("counts")):
                elements, counts = _multiset(e.as_py(), c.as_py())
                marks.append(signature(mix64(elements ^ _STEP), counts, FINE).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(marks, pa.binary())], names=["node", "marks"])

    return multisets.join(small_side(nodes), "node", "left_semi").mapInArrow(over, "node long, marks binary")


def _missed_pairs(members: DataFrame, best: bool) -> DataFrame:
    """Pairs of ``members`` (band, node, label, weight, shared, marks, slots) of one band and different labels that may reach the threshold.

    A band's members are dealt into blocks, and every two blocks meet under a key of their own, so that the work of a large band is dealt
    over all tasks. ``shared`` bounds what a
    member can have in common with any other, so a pair that cannot reach the threshold is left out without loss. ``slots`` holds, by
    position of the band, the keys of all bands a member is in: a pair that meets in several is compared in the first of them.
    ``best`` keeps, of every two components, the pair that agrees most.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.repartition("band", "block")  # else a band's blocks are made where its size was found
    packed = staged(dealt.groupBy("band", "block", "blocks").agg(F.collect_list(F.struct("node", "label", "weight", "shared", "marks", "slots")).alias("m")), "blocks")
    left = packed.select("band", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.col("m").alias("left"))
    right = packed.select("band", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), F.col("m").alias("right"))
    meeting = left.join(right, ["band", "i", "j"]).select("band", (F.col("i") == F.col("j")).alias("own"), "left", "right")

    def block(rows: list[dict]) -> tuple[np.ndarray, ...]:
        marks = np.frombuffer(b"".join(r["marks"] for r in rows), np.uint8).reshape(len(rows), FINE)
        return (*(np.array([r[c] for r in rows], np.int64) for c in ("node", "label", "weight", "shared")), marks, np.array([r["slots"] for r in rows], np.int64))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, low, high, score = [], [], [], [], []
            for band, own, left, right in zip(*(batch.column(c) for c in ("band", "own", "left", "right"))):
                here, own = band.as_py(), own.as_py()
                n1, l1, w1, s1, m1, at1 = block(left.as_py())
                n2, l2, w2, s2, m2, at2 = block(right.as_py())
                for k in range(len(n1)):
                    common = np.minimum(s1[k], s2)
                    others = np.flatnonzero((l2 != l1[k]) & (common >= SIMILARITY * (w1[k] + w2 - common)))
                    others = others[others > k] if own else others
                    first = ((at2[others] == at1[k]) & (at1[k] != 0)).argmax(axis=1) if len(others) else others
                    others = others[at1[k][first] == here]
                    agree = (m2[others] == m1[k]).mean(axis=1) if len(others) else np.empty(0)
                    others, agree = others[agree >= AGREEMENT], agree[agree >= AGREEMENT]
                    a.append(np.full(len(others), n1[k]))
                    b.append(n2[others])
                    low.append(np.minimum(l2[others], l1[k]))
                    high.append(np.maximum(l2[others], l1[k]))
                    score.append(agree)
            a, b, low, high = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b, low, high))
            score = np.concatenate(score) if score else np.empty(0)
            order = np.lexsort((-score, high, low))
            if best and len(order):
                new = np.r_[True, (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)]
                order = order[new]
            yield pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (a, b, low, high, score)], names=["a", "b", "low", "high", "score"])

    pairs = meeting.mapInArrow(over, "a long, b long, low long, high long, score double")
    if best:
        pairs = pairs.groupBy("low", "high").agg(F.max(F.struct("score", "a", "b")).alias("top")).select("top.a", "top.b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def node_labels(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches, nodes (digest, node) and (node, label) of the nodes that have a link."""
    sketches = staged(sketch(docs, text, key), "sketches", batch_rows=BATCH_TEXTS)
    bags = sketches.groupBy("digest").agg(
        F.min(F.struct("text_hash", "key")).alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
    )
    nodes = staged(bags.select("digest", "rep.*", "weight", "bands", F.monotonically_increasing_id().alias("node")), "nodes")
    banded = nodes.select("node", "weight", F.explode("bands").alias("band"))
    # The centre of a bucket is its smallest node in an order of the band's own: node ids xor a hash of the band.
    turn = F.xxhash64("band")
    centred = banded.groupBy("band").agg(F.min(F.col("node").bitwiseXOR(turn)).alias("least"), F.count(F.lit(1)).alias("n"))
    centred = centred.where("n > 1").select("band", F.col("least").bitwiseXOR(turn).alias("centre"), "n")
    centres = staged(centred, "centres")
    members = staged(banded.join(small_side(centres), "band"), "members")
    centre_weight = nodes.select(F.col("node").alias("centre"), F.col("weight").alias("centre_weight"))
    spokes = members.where("node <> centre").groupBy("node", "centre").agg(F.first("weight").alias("weight")).join(centre_weight, "centre")
    spokes = spokes.where(_plausible("weight", "centre_weight")).select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    spokes = staged(spokes, "spokes")
    touched = members.select("node").distinct()
    wanted = nodes.select("node", "key", "text_hash").join(touched, "node", "left_semi")
    multisets = staged(_bags(docs, staged(wanted, "wanted"), text, key), "multisets", batch_rows=BATCH_TEXTS)
    links = staged(_verified(spokes, multisets), "verified", batch_rows=BATCH_TEXTS)
    labels = components(links)
    # Buckets whose members other than the centre lie in different components.
    others = members.where("node <> centre and n > 2").join(labels, "node", "left")
    others = staged(others.select("band", "node", "weight", F.coalesce("label", "node").alias("label")), "others")
    open_bands = others.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
    still = staged(others.join(small_side(staged(open_bands, "open-bands")), "band", "left_semi"), "open-members")
    if not still.limit(1).count():  # every bucket lies in one component
        return sketches, nodes.select("digest", "node"), labels
    private = staged(_shared_weight(multisets, staged(still.select("node").distinct(), "open-nodes")), "private")
    shared = (F.col("weight") - F.coalesce("private", F.lit(0))).alias("shared")
    still = still.join(private, "node", "left").select("band", "node", "label", "weight", shared)
    still = staged(still.where(F.col("shared") >= SIMILARITY * F.col("weight")), "may-link")
    marks = staged(_fine_marks(multisets, staged(still.select("node").distinct(), "may-link-nodes")), "fine-marks")
    found_in = still.groupBy("node").agg(F.collect_set("band").alias("open"))
    slot = F.transform("bands", lambda b: F.when(F.array_contains("open", b), b).otherwise(F.lit(0)))
    still = still.join(marks, "node").join(staged(nodes.join(found_in, "node").select("node", slot.alias("slots")), "slots"), "node")
    # First the pair that agrees most of every two components: those it links need not be compared in full.
    top = staged(_missed_pairs(still, best=True), "missed-best")
    labels = merge(labels, staged(_verified(top, multisets), "verified-best", batch_rows=BATCH_TEXTS))
    merged = labels.select(F.col("node").alias("of"), F.col("label").alias("now"))
    moved = still.join(merged, still["node"] == merged["of"], "left").withColumn("label", F.coalesce("now", "label")).drop("of", "now")
    missed = staged(_missed_pairs(moved, best=False), "missed")
    found = staged(_verified(missed, multisets), "verified-more", batch_rows=BATCH_TEXTS)
    return sketches, nodes.select("digest", "node"), merge(labels, found)


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, class_id (smallest id of its class), class_size, text_hash."""
    sketches, nodes, labels = node_labels(docs, text, key)
    placed = sketches.select("key", "text_hash", "digest").join(nodes, "digest").join(labels, "node", "left")
    placed = staged(placed.select("key", "text_hash", F.coalesce("label", "node").alias("label")), "placed")
    firsts = staged(placed.groupBy("label").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "class-ids")
    with_words = placed.join(firsts, "label").select("key", "class_id", "class_size", "text_hash")
    wordless = docs.where(~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    alone = wordless.select(F.col(key).alias("key"), F.col(key).alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.xxhash64(text).alias("text_hash"))
    return with_words.unionByName(alone).withColumnRenamed("key", key)


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged: of each class the document with the smallest id.

    Rows that agree in id and text stay or go together; of rows that share the smallest id but not the text one text stays.
    """
    found = staged(classes(docs, text, key).select(F.col(key).alias("key"), "class_id", "text_hash"), "classes")
    led = found.where(F.col("key").eqNullSafe(F.col("class_id"))).groupBy("class_id").agg(F.min("text_hash").alias("stays"))
    led = led.withColumnRenamed("class_id", "of_class")
    leads = F.col("key").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("stays"))
    gone = found.join(led, F.col("class_id").eqNullSafe(F.col("of_class")), "left").where(~leads)
    gone = small_side(staged(gone.select(F.col("key").alias("__gone"), F.col("text_hash").alias("__hash")).distinct(), "near-copies"))
    mark = fresh_name("__text_hash", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(text))
    matched = marked[key].eqNullSafe(gone["__gone"]) & (marked[mark] == gone["__hash"])
    return marked.join(gone, matched, "left_anti").drop(mark)
