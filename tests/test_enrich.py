from conftest import route_row, routes_df

from routeflow import fixed_values as FV
from routeflow.operators import enrich as E
from routeflow.operators.curate import curate


def rule_on_prompts():
    """A stand-in for a model: the route rule on what the prompt says."""

    def labels_of(prompts):
        import pandas as pd

        parts = prompts.str.extract(r"^Route from (.*), (.*) to (.*), (.*)\. Distance: (-?[0-9.]+) km\.$")
        intl, dist = parts[1].str.strip() != parts[3].str.strip(), pd.to_numeric(parts[4], errors="coerce")
        label = pd.Series("INTERNATIONAL_LONG_HAUL", index=prompts.index, dtype=object)
        label[intl & (dist < 4000)] = "INTERNATIONAL_REGIONAL"
        label[~intl] = "DOMESTIC_LONG"
        label[~intl & (dist < 1500)] = "DOMESTIC_SHORT"
        label[parts[4].isna()] = None
        return label

    return labels_of


def _cur(spark, rows):
    return curate(routes_df(spark, rows))


def test_prompt_text(spark):
    r = _cur(spark, [route_row()]).select(E.classify_prompt().alias("p"), E.summary_prompt().alias("s")).first()
    assert r["p"] == "Route from New York, USA to London, United Kingdom. Distance: 5541 km."
    assert r["s"] == ("In one sentence, describe this flight route: American Airlines flight AA100 from New York (USA)"
                      " to London (United Kingdom), distance 5541 km, 220 seats on B77W.")


def test_rule_labels_and_null_prompt(spark):
    rows = [route_row(destination_country="USA", distance_km=1000.0), route_row(destination_country="USA"),
            route_row(distance_km=3000.0), route_row(), route_row(distance_km=None)]
    got = [r["route_classification"] for r in E.classify(_cur(spark, rows)).collect()]
    assert got == ["DOMESTIC_SHORT", "DOMESTIC_LONG", "INTERNATIONAL_REGIONAL", "INTERNATIONAL_LONG_HAUL", None]


def test_batch_provider_matches_rule_provider(spark):
    rows = [route_row(destination_country="USA", distance_km=1000.0), route_row(destination_country="USA"),
            route_row(distance_km=3000.0), route_row(), route_row(distance_km=None), route_row()]
    cur = _cur(spark, rows)
    a = sorted(map(tuple, E.classify(cur).select("distance_km", "route_classification").collect()), key=str)
    b = sorted(map(tuple, E.classify(cur, provider=E.BatchProvider(rule_on_prompts(), batch_size=2))
                   .select("distance_km", "route_classification").collect()), key=str)
    assert a == b
    assert E.classify(cur, provider=E.BatchProvider(rule_on_prompts())).count() == 6


def test_batch_provider_sees_each_prompt_once(spark):
    """The provider receives de-duplicated prompts: no batch holds a repeated prompt, and every
    distinct prompt is scored exactly once across batches."""
    import pandas as pd

    def dup_flags(prompts):
        return pd.Series(["dup" if d else "first" for d in prompts.duplicated()])

    cur = _cur(spark, [route_row()] * 7 + [route_row(distance_km=100.0)] * 3)
    out = E.apply_batch_provider(cur, E.classify_prompt(), E.BatchProvider(dup_flags, batch_size=1000), "seen")
    rows = out.select("seen").collect()
    assert len(rows) == 10
    assert {r["seen"] for r in rows} == {"first"}


def test_labels_outside_set_become_null(spark):
    cur = _cur(spark, [route_row()])
    out = E.classify(cur, provider=E.BatchProvider(lambda s: s.map(lambda _: "SOMETHING_ELSE"))).first()
    assert out["route_classification"] is None


def test_enrich_sample_is_ordered_and_bounded(spark):
    rows = [route_row(flight_number=f"AA{i:03d}") for i in range(30)]
    assert E.enrich(_cur(spark, rows)).count() == 30  # all rows unless a limit is given
    enriched = E.enrich(_cur(spark, rows), limit=FV.ENRICH_SAMPLE_ROWS)
    got = [r["flight_number"] for r in enriched.collect()]
    assert len(got) == FV.ENRICH_SAMPLE_ROWS
    assert sorted(got) == [f"AA{i:03d}" for i in range(20)]
    assert enriched.columns[-3:] == ["route_classification", "route_summary", "enriched_at"]
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # no global sort of the curated table for 20 rows
    base = _cur(spark, rows).select(*E.ENRICH_BASE_COLUMNS)
    top = base.orderBy(*E.ENRICH_BASE_COLUMNS).limit(20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top


def test_any_label_list_has_a_default_classifier(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a long haul flight"), (2, "short hop"), (3, "nothing"), (4, None)], "id int, p string")
    out = E.classify(df, F.col("p"), labels=["SHORT", "LONG_HAUL"], output="label").select("id", "label").collect()
    assert dict(map(tuple, out)) == {1: "LONG_HAUL", 2: "SHORT", 3: None, 4: None}


def test_provider_runs_in_several_tasks_with_its_model_and_without_null_prompts(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    def where(prompts, model):
        from pyspark import TaskContext

        return pd.Series([f"{model}:{TaskContext.get().partitionId()}"] * len(prompts))

    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("p"), F.col("id"))).alias("p"))
    out = E.complete(df, F.col("p"), E.BatchProvider(where, model="m", partitions=4), output="o")
    rows = out.groupBy("o").count().collect()
    assert sum(r["count"] for r in rows) == 400 and {r["o"] for r in rows if r["o"]} >= {"m:0", "m:1"}
    assert {r["o"]: r["count"] for r in rows}[None] == 200


def test_memo_scores_only_unseen_prompts_and_retries_failures(spark, fresh):
    from pyspark.sql import functions as F

    from routeflow.sources import ledger
    from routeflow.sources.tables import read_layer

    memo = f"{fresh.root}/ai/answers"

    def upper(prompts):
        if prompts.str.contains("bad").any():
            raise ValueError("refused")
        return prompts.str.upper()

    def ask(words, fn=upper, model=None):
        df = spark.createDataFrame([(w,) for w in words], "p string")
        out = E.complete(df, F.col("p"), E.BatchProvider(fn, memo=memo, name="upper", partitions=2), output="o")
        return sorted(((r["p"], r["o"]) for r in out.collect()), key=str)

    assert ask(["a", "b", "a", None]) == [("a", "A"), ("a", "A"), ("b", "B"), (None, None)]
    assert read_layer(spark, memo, E.MEMO_SCHEMA).count() == 2

    def never(prompts):
        raise AssertionError("called")

    assert ask(["a", "b", "b"], never) == [("a", "A"), ("b", "B"), ("b", "B")]
    assert len(ledger.entries(spark, memo)) == 1  # a run without new prompts commits nothing
    assert ask(["a", "bad one", "c"]) == [("a", "A"), ("bad one", None), ("c", "C")]
    failed = read_layer(spark, memo, E.MEMO_SCHEMA).where("error is not null").collect()
    assert [r["error"] for r in failed] == ["ValueError: refused"]
    assert ask(["bad one", "c"], lambda s: s.str.title()) == [("bad one", "Bad One"), ("c", "C")]
    other = E.BatchProvider(upper, memo=memo, name="other")
    prompts = spark.createDataFrame([("a",)], "prompt string")
    assert E.score_unseen(prompts.select(other.digest(F.col("prompt")).alias("digest"), "prompt"), other) == 1  # another provider's answers do not count


def test_errors_without_a_memo_stop_the_job(spark):
    import pytest
    from pyspark.sql import functions as F

    def fail(prompts):
        raise ValueError("refused")

    with pytest.raises(Exception, match="refused"):
        E.complete(spark.createDataFrame([("a",)], "p string"), F.col("p"), E.BatchProvider(fail), output="o").collect()


def test_fact_lister_uses_its_model(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("Flight AA100 from New York to Paris, 5541 km",)], "p string")
    for model, want in (("numbers", "100; 5541"), ("names", "Flight AA; New York; Paris")):
        assert E.complete(df, F.col("p"), E.BatchProvider(E.fact_lister(), model=model), output="o").first()["o"] == want


def test_answers_are_not_broadcast_on_a_guessed_size(spark):
    from pyspark.sql import functions as F

    df = spark.range(50).select(F.concat(F.lit("Row "), F.col("id")).alias("p"))
    out = E.complete(df, F.col("p"), E.BatchProvider(E.fact_lister(), model="names"), output="o")
    assert out.where("o = 'Row'").count() == 50
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_few_answers_for_many_rows_are_broadcast(spark):
    """No row moves to meet an answer that many rows share; rows without a prompt, or without an answer, stay."""
    from pyspark.sql import functions as F

    p = F.when(F.col("id") % 10 != 9, F.concat(F.lit("Row "), F.col("id") % 5))
    df = spark.range(60).select("id", p.alias("p"))
    out = E.complete(df, F.col("p"), E.BatchProvider(lambda s: s.map(lambda t: None if t == "Row 3" else t.upper())), output="o")
    got = {r["id"]: r["o"] for r in out.collect()}
    assert got == {i: None if i % 10 == 9 or i % 5 == 3 else f"ROW {i % 5}" for i in range(60)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def _noting(folder):
    """A provider function that notes each prompt it is asked for, by task."""
    import os

    def upper(prompts):
        from pyspark import TaskContext

        with open(os.path.join(folder, f"{TaskContext.get().taskAttemptId()}"), "a") as f:
            f.writelines(f"{p}\n" for p in prompts)
        assert len(prompts) <= 3
        return prompts.str.upper().where(prompts != "p7")

    return upper


def _noted(folder):
    return [sorted(p.read_text().split()) for p in folder.iterdir()]


def test_many_prompts_are_scored_in_place_once_each(spark, tmp_path):
    """Rows move once to their prompt's task: no digest, no answer and no second shuffle; several rows of a prompt ask once."""
    from pyspark.sql import functions as F

    df = spark.range(90, numPartitions=6).select("id", F.when(F.col("id") % 9 != 0, F.concat(F.lit("p"), F.col("id") % 31)).alias("p"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # runs of equal prompts go on over several batches
    try:
        out = E.complete(df, F.col("p"), E.BatchProvider(_noting(str(tmp_path)), batch_size=3, partitions=3), output="o")
        want = {i: None if i % 9 == 0 or i % 31 == 7 else f"P{i % 31}" for i in range(90)}
        for _ in range(2):  # answers are stored: a second use asks nobody
            got = [(r["id"], r["o"]) for r in out.collect()]
            assert len(got) == 90 and dict(got) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(p for ps in _noted(tmp_path) for p in ps) == sorted({f"p{i % 31}" for i in range(90) if i % 9})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert out.columns == ["id", "p", "o"]


def test_a_prompt_of_many_rows_does_not_meet_in_one_task(spark, tmp_path):
    from pyspark.sql import functions as F

    common = F.when(F.col("id") % 2 == 0, F.lit("common")).otherwise(F.concat(F.lit("p"), F.col("id")))
    df = spark.range(6000, numPartitions=6).select("id", common.alias("p"))
    assert E._asking(df, F.col("p"))[2] == [df.where("id = 0").select(F.xxhash64("p")).first()[0]]
    out = E.complete(df, F.col("p"), E.BatchProvider(_noting(str(tmp_path)), batch_size=3, partitions=3), output="o")
    assert out.count() == 6000 and out.where("o <=> nullif(upper(p), 'P7')").count() == 6000
    noted = _noted(tmp_path)
    assert sorted(p for ps in noted for p in ps) == sorted(["common", *(f"p{i}" for i in range(1, 6000, 2))])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_that_no_file_holds_are_joined_back(spark):
    from pyspark.sql import functions as F

    df = spark.range(20).select(F.concat(F.lit("Row "), F.col("id")).alias("p"), F.make_interval(F.lit(1)).alias("span"), F.lit(None).alias("none"))
    out = E.complete(df, F.col("p"), E.BatchProvider(E.fact_lister(), model="numbers"), output="o")
    assert out.where("p = 'Row ' || o AND span IS NOT NULL").count() == 20


def test_in_place_answers_are_read_like_joined_ones(spark):
    """JSON fields, answers left out at the end, whole numbers as prompts."""
    import pandas as pd
    from pyspark.sql import functions as F

    df = spark.range(2**60, 2**60 + 12).select(F.col("id").alias("p"))

    def ask(fn, **options):
        return {r["p"] - 2**60: r["o"] for r in E.complete(df, F.col("p"), E.BatchProvider(fn, partitions=1, **options), output="o").collect()}

    assert ask(lambda s: s.map(lambda p: f'{{"a": "{p - 2**60}"}}'), field="a") == {i: str(i) for i in range(12)}
    assert sorted(ask(lambda s: pd.Series(["x"] * (len(s) - 1)), batch_size=6).values(), key=str) == [None] * 2 + ["x"] * 10
