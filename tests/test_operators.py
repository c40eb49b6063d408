"""Golden cases and properties of the operators."""

import pytest
from pyspark.sql import functions as F

from foliospark.operators import figures, lanes, ledger, normalize, pricing
from foliospark.operators.validate import is_ordinal, is_share, repair_instruction
from foliospark.plans import workflow
from foliospark.session import materialize


def cost(spark, provider, model, tokens_in, tokens_out, batch=True):
    rows = spark.createDataFrame([(provider, model, tokens_in, tokens_out)], "provider string, model string, input_tokens long, output_tokens long")
    r = pricing.with_cost(rows, F.lit(batch)).first()
    return r.standard_cost_usd, r.batch_cost_usd, r.saving_usd


def test_costs(spark):
    assert cost(spark, "claude", "claude-opus-4-8", 10**6, 10**6) == (30, 15, 15)
    assert cost(spark, "openai", "gpt-5.4-mini", 12345, 678) == (0.0123, 0.0062, 0.0062)
    assert cost(spark, "openai", "unknown", 5, 5) == (0, 0, 0)
    standard, effective, saving = cost(spark, "openai", "gpt-5.5", 777, 99, False)
    assert standard == effective and saving == 0


def test_bucket_rows_keeps_the_kept_row_as_anchor(spark):
    rows = spark.createDataFrame([([10.0, 1.0, 3.0, 5.0, 6.5],), ([],)], "y array<double>").select(figures.bucket_rows(F.col("y")).alias("r")).collect()
    assert [r.r for r in rows] == [[1.0, 5.0, 10.0], []]


def test_gaps(spark):
    data = [([100.0, 112.0, 300.0], 320.0), ([], 50.0), ([10.0, 12.0], 200.0), ([10.0, 20.0, 30.0], 45.0)]
    rows = spark.createDataFrame(data, "r array<double>, c double")
    assert [r.x for r in rows.select(figures.gap_above(F.col("r"), F.col("c")).alias("x")).collect()] == [124.0, 0.0, 24.0, None]
    below = [([110.0, 120.0, 130.0, 140.0, 150.0, 190.0], 100.0), ([110.0, 150.0], 100.0), ([], 100.0)]
    rows = spark.createDataFrame(below, "r array<double>, c double")
    assert [r.x for r in rows.select(figures.gap_below(F.col("r"), F.col("c"), F.lit(792.0)).alias("x")).collect()] == [178.0, None, 792.0]


def test_crop_pixels(spark):
    box = F.struct(F.lit(0.0).alias("x_min"), F.lit(60.0).alias("y_min"), F.lit(612.0).alias("x_max"), F.lit(400.0).alias("y_max"))
    assert tuple(spark.range(1).select(figures.crop_pixels(box, F.lit(612.0)).alias("x")).first().x) == (0, 125, 1275, 709)


@pytest.mark.parametrize(("data", "ordinal", "share"), [([1, 2, 3], True, False), ([3, 2, 1], True, False), ([0, 1, 2], True, False), ([5, 6, 7], False, False), ([1, 2], False, False), ([1.6, 98.4], False, True), ([0.3, 0.7], False, True), ([], False, None)])
def test_chart_data(spark, data, ordinal, share):
    row = spark.createDataFrame([([float(x) for x in data],)], "d array<double>").select(is_ordinal(F.col("d")).alias("o"), is_share(F.col("d")).alias("s")).first()
    assert bool(row.o) is ordinal and bool(row.s) is bool(share)


def test_lane_round_trip(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "custom_id string")
    out = lanes.fan_out(docs)
    assert out.count() == 8
    answers = out.filter("custom_id = 'a' and lane in ('methods', 'results')").select("lane_id", F.when(F.col("lane") == "methods", "").otherwise("r").alias("text"), F.lit(1).alias("seq"))
    row = lanes.fan_in(answers, "seq").first()
    assert row.base == "a" and row.missing == "limitations,implications"
    assert row.body == "## methods\n\n\n## results\nr\n\n## limitations\n(missing)\n\n## implications\n(missing)"


def test_ledger_changes(spark):
    old = spark.createDataFrame([("b", "1", "pending"), ("b", "2", "pending")], "batch_id string, custom_id string, result string")
    new = ledger.apply_results(old.select("batch_id", "custom_id"), spark.createDataFrame([("1", "succeeded", None), ("9", "errored", "x")], "custom_id string, outcome string, message string"))
    merged = ledger.upsert(old, new.filter("result <> 'pending'").select(*old.columns), "batch_id", "custom_id")
    assert sorted(map(tuple, merged.collect())) == [("b", "1", "succeeded"), ("b", "2", "pending")]
    twice = ledger.upsert(merged, new.filter("result <> 'pending'").select(*old.columns), "batch_id", "custom_id")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, merged.collect()))


def test_repair_stops_after_two(spark):
    from foliospark.plans.record_queries import DATE, GOOD

    import json

    calls = spark.sparkContext.accumulator(0)

    def never(frame):
        calls.add(len(frame))
        return workflow.echo_model(frame)

    bad = json.dumps(GOOD | {"version": 3})
    rows = spark.createDataFrame([(1, bad), (2, json.dumps(GOOD)), (3, "no json")], "id long, text string")
    got = {r.id: r for r in workflow.repair(rows, DATE, never, lambda df: materialize(df, "test")).collect()}
    assert got[1].repairs == 2 and not got[1].ok and got[1].text == bad
    assert got[2].repairs == 0 and got[2].ok and not got[3].parsed
    assert calls.value == 2


def test_failures_of_a_model_are_rows(spark):
    def broken(frame):
        raise RuntimeError("down")

    rows = spark.createDataFrame([(1, "s", "p")], "id long, system string, prompt string")
    assert workflow.call_model(rows, broken, ["id"]).first().error == "down"


def test_repair_instruction_lists_issues(spark):
    text = spark.range(1).select(repair_instruction(F.array(F.lit("a"), F.lit("b")), "2026-01-01").alias("x")).first().x
    assert "\n- a\n- b\n" in text and text.count("2026-01-01") == 1


def test_normalise_is_idempotent(spark):
    end = F.parse_json(F.lit('{"heading": "h", "body_html": "<b>x</b> &amp; y"}'))
    once = normalize.takeaway(end)
    row = spark.range(1).select(once.alias("a"), normalize.takeaway(F.parse_json(F.to_json(once))).alias("b")).first()
    assert tuple(row.a) == tuple(row.b) == ("h", "x & y")


def test_image_blocks_and_charts(spark):
    none = F.lit(None).cast("string")
    override = lambda figure, caption=none: {"source_figure": figure, "caption": caption, "alt_text": none}
    old = {"caption": F.lit("old"), "alt_text": none}
    row = spark.range(1).select(
        normalize.image_block(override(F.lit("Figure 2")), old).alias("a"),
        normalize.image_block(override(F.lit("Figure 2"), F.lit("new")), old).alias("b"),
        normalize.image_block(override(none), old).alias("c"),
        normalize.chart_raw(F.parse_json(F.lit('{"a": 1}')), none).alias("d"),
        normalize.chart_raw(F.parse_json(F.lit('{"a": 1}')), F.lit("own")).alias("e"),
    ).first()
    assert tuple(row.a) == ("Figure 2", "old", "Figure 2 from the source paper.") and row.b.caption == "new" and row.c is None
    assert row.d == '{"a":1}' and row.e == "own"


def test_instruction_with_emphasis(spark):
    from foliospark.operators.prompts import user_instruction

    row = spark.range(1).select(user_instruction(F.lit("2026-01-01"), F.lit(" look \n")).alias("a"), user_instruction(F.lit("2026-01-01"), F.lit(" ")).alias("b"), user_instruction(F.lit("2026-01-01"), F.lit(None).cast("string")).alias("c")).first()
    assert row.b == row.c and row.a.startswith(row.b) and "\nlook\n" in row.a and row.b.count("2026-01-01") == 1


def test_blocks_in_order(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "id long, k int, text string")
    assert {r.id: r.text for r in normalize.joined_blocks(rows, ["id"], "k", "text").collect()} == {1: "a\nb", 2: "c"}


def test_status_and_latest(spark):
    rows = spark.createDataFrame([("b", "explainer", "succeeded", 5, 1, 2.0, 1.0, 1.0), ("b", "lane", "errored", None, None, None, None, None), ("c", "explainer", "pending", None, None, None, None, None)], "batch_id string, type string, result string, input_tokens long, output_tokens long, standard_cost_usd double, batch_cost_usd double, saving_usd double")
    status = ledger.batch_status(rows, "batch_id")
    got = {r.batch_id: r for r in status.collect()}
    assert (got["b"].n_total, got["b"].n_lanes, got["b"].tokens_in, got["c"].effective_usd) == (1, 1, 5, 0)
    assert ledger.grand_total(status).first().saving_usd == 1 and ledger.grand_total(status.filter("batch_id = 'c'")).collect() == []
    assert [r.batch_id for r in ledger.cost_summary(rows, "batch_id").collect()] == ["b"]
    batches = spark.createDataFrame([("x", "p", 1, "processing"), ("y", "p", 2, "processing"), ("z", "p", 3, "ended")], "id string, provider string, seq int, status string")
    assert [r.id for r in ledger.latest_pending(batches, "seq", "provider").collect()] == ["y"]
