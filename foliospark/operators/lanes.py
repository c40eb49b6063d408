"""Fan-out of documents into lanes and fan-in of lane texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import lane_base, lane_id, lane_name

#: Lanes in order, and what stands for a lane without result.
LANES = ("methods", "results", "limitations", "implications")
MISSING = "(missing)"
NO_LANES = "No lane outputs available for synthesis"


def fan_out(docs: DataFrame, id_col: str = "custom_id") -> DataFrame:
    """A request per document and lane; an array explodes, nothing is joined."""
    return docs.withColumn("lane", F.explode(F.array(*(F.lit(x) for x in LANES)))).withColumn("lane_id", lane_id(F.col(id_col), F.col("lane")))


def enabled(setting: Column) -> Column:
    """Whether lanes are on: not set, or set to anything but 0, false, no."""
    return ~F.lower(F.coalesce(setting, F.lit("1"))).isin("0", "false", "no")


def lane_body(texts: dict[str, Column]) -> Column:
    return F.concat_ws("\n\n", *(F.concat(F.lit(f"## {x}\n"), F.coalesce(texts[x], F.lit(MISSING))) for x in LANES))


def fan_in(results: DataFrame, seq: str, id_col: str = "lane_id", text_col: str = "text") -> DataFrame:
    """``base, body, missing`` per document; the last text of a lane wins and
    an empty one is kept. One aggregation, combined on the map side."""
    rows = results.select(lane_base(F.col(id_col)).alias("base"), lane_name(F.col(id_col)).alias("lane"), F.coalesce(text_col, F.lit("")).alias("t"), F.col(seq).alias("seq")).filter(F.col("lane").isin(*LANES))
    last = rows.groupBy("base").agg(*(F.max_by(F.when(F.col("lane") == x, F.col("t")), F.when(F.col("lane") == x, F.col("seq"))).alias(x) for x in LANES))
    missing = F.array_compact(F.array(*(F.when(F.col(x).isNull(), F.lit(x)) for x in LANES)))
    return last.select("base", lane_body({x: F.col(x) for x in LANES}).alias("body"), F.array_join(missing, ",").alias("missing"))


def without_lanes(explainers: DataFrame, lanes: DataFrame, key: str) -> DataFrame:
    """Documents for which no lane came back, marked errored."""
    return explainers.join(lanes.select(key).distinct(), key, "left_anti").withColumns({"result": F.lit("errored"), "error": F.lit(NO_LANES)})
