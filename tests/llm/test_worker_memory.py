"""What Python workers hold at once is bounded: batches of texts and kept words."""

from __future__ import annotations

import pyarrow as pa

from routeflow.llm import packing
from routeflow.llm.common import BATCH_ROWS, staged
from routeflow.llm.shingles import WordHashes


def test_staged_bounds_the_batches_of_its_job(spark):
    before = spark.conf.get(BATCH_ROWS)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    counted = staged(spark.range(0, 1000, 1, 2).mapInArrow(sizes, "n long"), "batches", batch_rows=100).collect()
    assert sum(r["n"] for r in counted) == 1000 and max(r["n"] for r in counted) <= 100
    assert spark.conf.get(BATCH_ROWS) == before


def test_kept_ids_are_bounded_and_unchanged_by_it(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    few = packing.WordIds(packing.default_tokenizer())
    texts = [" ".join(["often", *(f"word{k}x{j}" for j in range(10))]) for k in range(30)]
    for text in [*texts, *texts]:
        ids = few.whole.encode(text, add_special_tokens=False).ids
        assert few.of(text) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert len(few.known) + len(few.older) <= 40 + 2 * 11


def test_kept_hashes_are_bounded():
    known, all_words = WordHashes(limit=5), [f"w{k}" for k in range(50)]
    assert known.of(all_words).tolist() == WordHashes().of(all_words).tolist()
    assert len(known) <= 5


def test_words_are_forgotten_after_a_task(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k}x") for k in range(50)], "doc_id long, text string").coalesce(1)
    assert packing.pieces(docs).count() == 50

    def sizes(batches):
        import pyarrow as pa
        import tokenizers

        kept = tokenizers.__dict__.get("_word_ids_by_path", {}).values()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(w.known) + len(w.older) for w in kept)] * batch.num_rows, pa.int64())], names=["n"])

    assert {r["n"] for r in spark.range(0, 64, 1, 8).mapInArrow(sizes, "n long").collect()} == {0}


def test_words_are_cut_into_the_units_of_the_tokenizer():
    ids = packing.WordIds(packing.default_tokenizer())
    whole, calls = ids.whole, []

    class Counted:
        def encode(self, *args, **names):
            calls.append(args)
            return whole.encode(*args, **names)

    def same(text):
        want = whole.encode(text, add_special_tokens=False).ids
        return ids.of(text) == b"".join(i.to_bytes(4, "little") for i in want)

    ids.whole = Counted()
    plain = ["Tiea. with, (a|b) x_y __ 'Tis don't we've O'CLOCK's ''s .'s", "l'été&&& mailto:hab.03@mail8.example.com 2026-12-03", "ciónestarr ñ's Ñ\"' …été… 漢字。\x7f \x1b[0m", ""]
    assert all(same(t) for t in plain) and not calls  # each unit went straight to the model
    odd = ["<|startoftext|> a<|endoftext|>b", "ΟΔΟΣ x", "été ½ Ⅳ² ٣", "a\xa0b \x85 c\x1cd", "\u0378x y\u0378", "İx"]
    assert all(same(t) for t in odd)


def test_texts_are_tokenized_many_at_once(spark, monkeypatch):
    """Each different unit goes to the model once, in few calls; neither the bounds on kept units nor on calls and texts change an id."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    monkeypatch.setattr(packing, "BATCH_UNITS", 7)
    ids = packing.WordIds(packing.default_tokenizer())
    whole, calls = ids.whole, []
    model = ids.units_only

    class Counted:
        def encode_batch_fast(self, texts, **names):
            calls.append(len(texts[0].split(" ")))
            return model.encode_batch_fast(texts, **names)

    ids.units_only = Counted()
    texts = ["", " \n", "Plain words, plain WORDS!", "été d'été \x7f", *(" ".join(f"unit{'abcdefgh'[j]}{chr(97 + k)}s" for j in range(8)) for k in range(20))]
    odd = ["a\xa0b plain \u0378x", "e\u0301 ½ <|endoftext|> ΟΔΟΣ", "x" * 100 + " \x1c " + "é" * 90]
    for chosen in (texts, [*texts, *odd], odd, texts[:2]):
        calls.clear()
        data, at = ids.of_texts(pa.array(chosen, pa.string()))
        assert [data[a:b].tobytes() for a, b in zip(at, at[1:])] == [b"".join(i.to_bytes(4, "little") for i in whole.encode(t, add_special_tokens=False).ids) for t in chosen]
        assert max(calls, default=0) <= 7 and sum(calls) <= 200
        assert max(map(len, (ids.units, ids.units.older, ids.known, ids.known.older))) <= 15

    docs = spark.createDataFrame(list(enumerate([*texts, *odd, "long " * 3000])), "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, packing.pieces(docs, capacity=50).collect()))
    monkeypatch.setattr(packing, "CUT_BYTES", 40)
    assert sorted(map(tuple, packing.pieces(docs, capacity=50).collect())) == want and len(want) > len(texts) + 60
