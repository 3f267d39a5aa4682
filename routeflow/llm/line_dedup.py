"""Line deduplication by a deletion-neighbourhood join.

Two lines match when their Levenshtein distance is at most one (white space at both ends does not count; lines without a word are left
alone), whatever their length (but see ``scaled``). Of matching lines the earliest, by (document id, line number), stays: a line is removed if
an equal or matching line comes earlier anywhere in the table. Matching is not made transitive.

1. Equal lines meet under a 128-bit digest; each distinct line has its first place.
2. Two lines at distance one agree in their first or in their second half once the longer length is known, so a
   line that shares no half with another is left out here, losslessly. Most lines of a corpus end here; no line text
   has been shuffled yet.
3. For the others all variants that lack one character are emitted as hashed keys (of the half that did not match the edit
   may lie anywhere, so all positions are). Lines of equal length that share (variant, position) differ in that position
   alone; a line that equals a variant of another is one character shorter. Each variant key takes the earliest line under it, so a
   group costs its size, not its square. Variants are hashed by blocks: n characters cost n times the block length, which
   is the root of n for very long lines.
4. The earliest match is verified with ``levenshtein`` on what the texts do not share at both ends, and the later line removed.

``scaled=True`` lets the bound grow with the line. Lines under ``SHORT_CHARS`` characters match only if equal. Lines of ten words or more
also match if they have as many words and agree outside one of ten (from 20 words on: two of twenty) blocks of consecutive words, that
is, outside a tenth of their words; any one (from 20 words on: any two) replaced words are found, whatever their
length. Such lines agree in one of two (three) parts, and in the hash that leaves those blocks out; all under that hash match, so the earliest one is
taken as in step 3. A word more or less is not a match by blocks. The default stays at one edit.

Distribution: shuffles carry digests and texts of candidates, and the documents once, to meet their removed line numbers, whose number
grows with the corpus (candidates are broadcast while small, see ``common.small_side``, and joined beyond, which shuffles the lines once
more); hot lines collapse in the partial aggregation of step 1. A variant group holds distinct lines that differ in one character
only, so its size is bounded by alphabet and line length.

Defined results: a NULL text has no lines; an empty text stays empty; a line of any length is treated whole;
rows that repeat id and text count as one document and get the same result; a NULL id comes last; an empty table gives an
empty result; other columns are carried unchanged whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeflow.llm.common import SPACE, fresh_name, let, small_side, staged

MAX_EDITS = 1
#: With a scaled bound: below this length only equal lines match.
SHORT_CHARS = 10
#: Least characters of a block of ``_variants``.
BLOCK = 64
#: Variants that a task is to emit.
TASK_VARIANTS = 200_000


#: The six white-space characters.
BLANKS = " \t\n\x0b\x0c\r"


def _places(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per line with a word: doc, text_hash, n, digest and the line without white space at its ends."""
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    lines = F.transform(split, lambda x, i: F.struct(i.alias("n"), F.btrim(x, F.lit(BLANKS)).alias("line")))
    lined = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("text_hash"), F.explode(F.filter(lines, lambda x: x["line"] != "")).alias("x"))
    return lined.select("doc", "text_hash", "x.n", "x.line", F.unhex(F.md5("x.line")).alias("digest"))


def _place() -> Column:
    """Comparable place of a line; a NULL id comes after all others."""
    return F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "n", "text_hash")


def _halves(line: Column, length: Column) -> Column:
    """Keys of the first and second half, for each length that the longer line of a match may have."""

    def of(longer: Column) -> Column:
        head = F.floor((longer - 1) / 2).cast("int")
        tail = longer - 1 - head
        return F.array(
            F.xxhash64(F.lit("head"), longer, F.substring(line, F.lit(1), head)),
            F.xxhash64(F.lit("tail"), longer, F.substring(line, length - tail + 1, tail)),
        )

    return F.concat(of(length), of(length + F.lit(1)))


def _variants(line: Column, length: Column) -> Column:
    """All variants of the line that lack one character, and the keys (position -1) under which it is one for a line one longer.

    A variant is hashed by blocks of the longer line: what precedes the block of the missing character, that block without it, and what
    follows. Blocks have ``BLOCK`` characters, the root of the length beyond its square, so that a line of n characters costs n times that.
    """

    def width(longer: Column) -> Column:
        return F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(longer)).cast("int"))

    def around(longer: Column, size: Column, lack: int) -> Column:
        """A block's number, first position and characters, and the hash of the rest; ``lack`` characters are missing in the block."""

        def of(k: Column) -> Column:
            start = k * size
            wide = F.least(size, longer - start) - lack
            rest = F.xxhash64(longer, k, F.substring(line, F.lit(1), start), F.substring(line, start + wide + 1, length))
            return F.struct(start.alias("start"), F.substring(line, start + 1, wide).alias("block"), rest.alias("rest"))

        return F.transform(F.sequence(F.lit(0), F.ceil(longer / size).cast("int") - 1), of)

    def cut(x: Column) -> Column:
        n = F.length(x["block"])
        return F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.struct(
                F.xxhash64(x["rest"], F.concat(F.substring(x["block"], F.lit(1), i - 1), F.substring(x["block"], i + 1, n))).alias("variant"),
                length.alias("longer"),
                (x["start"] + i).alias("position"),
            ),
        )

    def own(x: Column, i: Column) -> Column:
        return F.struct(x.alias("variant"), (length + 1).alias("longer"), (-1 - i).alias("position"))

    lacking = F.flatten(F.transform(let(width(length), lambda w: around(length, w, 0)), cut))
    whole = F.transform(let(width(length + 1), lambda w: around(length + 1, w, 1)), lambda x: F.xxhash64(x["rest"], x["block"]))
    return F.concat(F.transform(whole, own), lacking)


def _near(one: Column, other: Column) -> Column:
    """Whether the Levenshtein distance is within ``MAX_EDITS``, in n times the root of n steps for n characters.

    Whole blocks that the lines share at their start and end do not count for the distance. With one edit less than two blocks and a
    character remain, to which ``levenshtein`` is applied.
    """
    longest = F.greatest(F.length(one), F.length(other))
    shortest = F.least(F.length(one), F.length(other))
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(longest)).cast("int"))
    pair = F.struct(one.alias("a"), other.alias("b"), F.length(one).alias("na"), F.length(other).alias("nb"), shortest.alias("n"), size.alias("w"))

    def shared(n: Column, differ) -> Column:
        """How many of blocks 0 to n - 1 are equal before the first that is not."""
        return (F.array_position(F.transform(F.sequence(F.lit(0), n), lambda k: (k >= n) | differ(k)), True) - 1).cast("int")

    def head(x: Column) -> Column:
        def differ(k: Column) -> Column:
            return F.substring(x["a"], k * x["w"] + 1, x["w"]) != F.substring(x["b"], k * x["w"] + 1, x["w"])

        return F.struct(x.alias("x"), (x["w"] * shared(F.floor(x["n"] / x["w"]).cast("int"), differ)).alias("head"))

    def tail(y: Column) -> Column:
        x, w = y["x"], y["x"]["w"]

        def differ(k: Column) -> Column:
            return F.substring(x["a"], x["na"] - (k + 1) * w + 1, w) != F.substring(x["b"], x["nb"] - (k + 1) * w + 1, w)

        return F.struct(x.alias("x"), y["head"].alias("head"), (w * shared(F.floor((x["n"] - y["head"]) / w).cast("int"), differ)).alias("tail"))

    def judge(z: Column) -> Column:
        x = z["x"]
        left = [F.substring(x[c], z["head"] + 1, x[n] - z["head"] - z["tail"]) for c, n in (("a", "na"), ("b", "nb"))]
        return F.when(F.greatest(x["na"], x["nb"]) - z["head"] - z["tail"] > 2 * x["w"] + 1, F.lit(False)).otherwise(F.levenshtein(*left, MAX_EDITS) >= 0)

    return let(let(let(pair, head), tail), judge)


def _blocks(line: Column) -> Column:
    """Hashes of the blocks of a line of ten words or more: ten, or twenty from 20 words on; of other lines none."""

    def of(ws: Column) -> Column:
        n = F.size(ws)
        count = F.when(n >= 20, F.lit(20)).otherwise(F.lit(10))

        def block(i: Column) -> Column:
            start, end = (F.floor(k * n / count).cast("int") for k in (i, i + 1))
            return F.xxhash64(n, i, F.concat_ws(" ", F.slice(ws, start + 1, end - start)))

        return F.when(n >= 10, F.transform(F.sequence(F.lit(0), count - 1), block)).otherwise(F.array().cast("array<bigint>"))

    return let(F.split(line, SPACE + "+"), of)


def _parts(blocks: Column) -> Column:
    """Keys of the halves (ten blocks) or thirds (twenty), one of which agrees if no more than one (two) blocks differ."""

    def cut(*bounds: int) -> Column:
        return F.array(*(F.xxhash64(F.lit(k), F.slice(blocks, a + 1, b - a)) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))))

    return F.when(F.size(blocks) == 20, cut(0, 7, 13, 20)).when(F.size(blocks) == 10, cut(0, 5, 10)).otherwise(F.array().cast("array<bigint>"))


def _without_blocks(blocks: Column) -> Column:
    """Hashes of the line without one (of twenty: two) of its blocks, for all choices."""

    def of(every: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            return F.xxhash64(every.bitwiseXOR(h), i)

        def two(h: Column, i: Column) -> Column:
            after = F.slice(blocks, i + 2, F.lit(20))
            return F.transform(after, lambda g, j: F.xxhash64(every.bitwiseXOR(h).bitwiseXOR(g), i, j))

        return F.when(F.size(blocks) == 20, F.flatten(F.transform(blocks, two))).otherwise(F.transform(blocks, one))

    return let(F.aggregate(blocks, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h)), of)


def near_by_blocks(found: DataFrame) -> DataFrame:
    """(digest, keeper) for distinct lines (digest, blocks, first) that have an earlier line which agrees outside a tenth of the words."""
    emitted = found.select("digest", "first", F.explode(_without_blocks(F.col("blocks"))).alias("rest"))
    shared = staged(emitted.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rest"), "shared-rests")
    members = emitted.join(small_side(shared), "rest", "left_semi")
    best = F.min(F.struct("first", "digest")).over(Window.partitionBy("rest"))
    linked = members.select("digest", "first", best.alias("best")).where(F.col("best.first") < F.col("first"))
    pairs = linked.select("digest", F.col("best.digest").alias("keeper")).distinct()
    blocks = found.select("digest", "blocks")
    both = pairs.join(blocks, "digest").join(blocks.select(F.col("digest").alias("keeper"), F.col("blocks").alias("kept")), "keeper")
    differ = F.size(F.filter(F.zip_with("blocks", "kept", lambda a, b: a.eqNullSafe(b)), lambda x: ~x))
    return both.where((differ * 10 <= F.size("blocks")) & (F.size("blocks") == F.size("kept"))).select("digest", "keeper")


def candidate_digests(lines: DataFrame, halves: str = "halves") -> DataFrame:
    """Digests of distinct lines (digest, halves) that share a half with another distinct line."""
    halves = lines.select("digest", F.explode(halves).alias("half"))
    shared = staged(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half"), "shared-halves")
    return halves.join(small_side(shared), "half", "left_semi").select("digest").distinct()


def near_lines(found: DataFrame) -> DataFrame:
    """(digest, keeper) for distinct lines (digest, line, first) that have an earlier line within the edit bound.

    ``first`` is any orderable column; ``keeper`` is the digest of the earliest match. Lines are dealt out by what they will emit
    before any variant is.
    """
    amount = found.agg(F.sum(F.length("line"))).head()[0] or 0
    found = found.repartition(amount // TASK_VARIANTS + 1, "digest")
    emitted = found.select("digest", "first", F.explode(let(F.struct("line", F.length("line").alias("length")), lambda x: _variants(x["line"], x["length"]))).alias("v")).select("digest", "first", "v.*")
    place = F.struct("first", "digest")
    under = Window.partitionBy("variant", "longer")
    shorter = F.min(F.when(F.col("position") < 0, place)).over(under)
    longer = F.min(F.when(F.col("position") >= 0, place)).over(under)
    same = F.min(place).over(Window.partitionBy("variant", "longer", "position"))
    best = F.when(F.col("position") < 0, longer).otherwise(F.least(shorter, same))
    linked = emitted.select("digest", "first", best.alias("best")).where(F.col("best.first") < F.col("first"))
    pairs = linked.groupBy("digest").agg(F.min("best").alias("best")).select("digest", F.col("best.digest").alias("keeper"))
    text = found.select("digest", "line")
    both = pairs.join(text, "digest").join(text.select(F.col("digest").alias("keeper"), F.col("line").alias("kept_line")), "keeper")
    return both.where(_near(F.col("line"), F.col("kept_line"))).select("digest", "keeper")


def removed_places(docs: DataFrame, text: str = "text", key: str = "doc_id", scaled: bool = False) -> DataFrame:
    """(doc, text_hash, gone): numbers, from 0, of the lines to remove of each document that loses any."""
    scanned = _places(docs, text, key)
    halves = let(F.col("line"), lambda x: _halves(x, F.length(x)))
    if scaled:
        halves = F.when(F.length("line") >= SHORT_CHARS, halves).otherwise(F.array().cast("array<bigint>"))
    keys = {"halves": halves}
    if scaled:
        keys["parts"] = let(_blocks(F.col("line")), _parts)
    places = staged(scanned.select("doc", "text_hash", "n", "digest", *(v.alias(k) for k, v in keys.items())), "line-places")
    lines = staged(places.groupBy("digest").agg(F.min(_place()).alias("first"), *(F.first(k).alias(k) for k in keys)), "distinct-lines")
    candidates = staged(candidate_digests(lines), "line-candidates")
    texts = scanned.select("digest", "line").join(small_side(candidates), "digest", "left_semi").groupBy("digest").agg(F.first("line").alias("line"))
    found = staged(texts.join(lines.select("digest", "first"), "digest"), "candidate-lines")
    near = near_lines(found).select("digest")
    if scaled:
        alike = staged(candidate_digests(lines, "parts"), "block-candidates")
        blocks = scanned.select("digest", "line").join(small_side(alike), "digest", "left_semi").groupBy("digest").agg(F.first(_blocks(F.col("line"))).alias("blocks"))
        cut = staged(blocks.join(lines.select("digest", "first"), "digest"), "line-blocks")
        near = near.unionByName(near_by_blocks(cut).select("digest")).distinct()
    near = staged(near, "near-lines")
    # every place but the first of its line, and the first ones of lines with an earlier match
    rest = places.select("digest", _place().alias("place")).join(lines.select("digest", "first"), "digest").where(~F.col("place").eqNullSafe(F.col("first")))
    also = lines.join(small_side(near), "digest", "left_semi").select(F.col("first").alias("place"))
    gone = rest.select("place").unionByName(also).select("place.doc", "place.text_hash", "place.n")
    return gone.groupBy("doc", "text_hash").agg(F.collect_set("n").alias("gone"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", scaled: bool = False) -> DataFrame:
    """``docs`` with ``clean_text`` (the lines that stay), ``n_lines`` and ``n_removed`` (lines with a word)."""
    gone = staged(removed_places(docs, text, key, scaled), "removed-lines")  # grows with the corpus: joined alike at every size
    mark = fresh_name("__hash", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(text))
    joined = marked.join(gone, marked[key].eqNullSafe(gone["doc"]) & (marked[mark] == gone["text_hash"]), "left")
    whole = F.coalesce(marked[text], F.lit(""))
    lines = F.split(whole, "\n", -1)

    def without(raw: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(raw) - 1), gone["gone"])
        return F.concat_ws("\n", F.transform(stay, lambda i: F.get(raw, i)))

    made = {
        "clean_text": F.when(gone["gone"].isNull(), whole).otherwise(let(lines, without)),
        "n_lines": F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long"),
        "n_removed": F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("long"),
    }
    return joined.select(*(marked[c] for c in docs.columns if c.lower() not in made), *(v.alias(k) for k, v in made.items()))
