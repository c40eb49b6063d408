"""The document workflow: request, extract, validate, repair, save, account.

External models are plug points: a function from pandas frames to pandas frames
that runs in ``mapInPandas``. Their results are written out before the next
step, so a lost executor never repeats a paid call that has been stored.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.batches import frugal, small_batches
from foliospark.functions import jsonx as J
from foliospark.operators import lanes, prompts, validate

#: Fixed value: repairs of a record at most.
MOST_REPAIRS = 2

#: From (system, prompt) to (text, input_tokens, output_tokens, error).
Model = Callable[[pd.DataFrame], pd.DataFrame]
RESULT = "text string, input_tokens bigint, output_tokens bigint, error string"


def echo_model(requests: pd.DataFrame) -> pd.DataFrame:
    """A stand-in: the prompt as text, its words as tokens; never fails."""
    n = [len(p.split()) for p in requests["prompt"].fillna("")]  # the words of one prompt at a time
    return pd.DataFrame({"text": requests["prompt"], "input_tokens": n, "output_tokens": n, "error": None})


def stub_repair(requests: pd.DataFrame) -> pd.DataFrame:
    """A stand-in that mends a wrong version and nothing else."""
    text = requests["prompt"].str.replace('"version": 2', '"version": 1', regex=False)
    return pd.DataFrame({"text": text, "input_tokens": 1, "output_tokens": 1, "error": None})


def call_model(requests: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys`` and the model's result for rows of ``system, prompt``.

    A frame holds at most the rows and bytes of ``small_batches``. Where one
    raises, its rows are sent one by one: a row that fails gives an error row
    and affects no other.
    """
    small_batches(requests.sparkSession)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests.schema if f.name in keys) + ", " + RESULT

    def answers(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return model(rows).reset_index(drop=True)
        except Exception as error:  # noqa: BLE001  an item's failure is a result
            if len(rows) == 1:
                return pd.DataFrame({"text": None, "input_tokens": 0, "output_tokens": 0, "error": str(error)}, index=[0])
            return pd.concat([answers(rows.iloc[k : k + 1]) for k in range(len(rows))], ignore_index=True)

    def run(frames):
        for frame in frames:
            yield pd.concat([frame[keys].reset_index(drop=True), answers(frame[["system", "prompt"]])], axis=1)

    return requests.select(*keys, "system", "prompt").mapInPandas(frugal(run), schema)


#: Fixed value: how the id of a batch starts that is worked on when it is polled.
DEFERRED = "codexbatch_"


def polled(requests: DataFrame, model: Model) -> DataFrame:
    """Answers of the deferred batches among ``custom_id, batch_id, system,
    prompt``: nothing ran when they were submitted; others wait for results."""
    return call_model(requests.filter(F.col("batch_id").startswith(DEFERRED)), model, ["custom_id", "batch_id"])


def repair(records: DataFrame, expected_date: str, model: Model, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``records`` (with ``text``) and ``ok, issues, repairs`` after at most two
    repairs. Each pass sends only rows that failed; ``store`` writes a pass's
    answers. Unparseable text is left as it is."""
    def checked(df: DataFrame) -> DataFrame:
        v = J.extract_json(F.col("text"))
        return df.withColumn("_v", validate.validation(v, expected_date)).withColumns({"ok": F.col("_v.ok"), "issues": F.col("_v.issues"), "parsed": v.isNotNull()}).drop("_v")

    keys = [c for c in records.columns if c != "text"]
    state = checked(records).withColumn("repairs", F.lit(0))
    for attempt in range(1, MOST_REPAIRS + 1):
        todo = state.filter("parsed and not ok").select(*keys, validate.repair_instruction(F.col("issues"), expected_date).alias("system"), F.col("text").alias("prompt"))
        answers = store(call_model(todo, model, keys)).select(*keys, "text")
        done = state.filter("ok or not parsed")
        state = done.unionByName(checked(answers).withColumn("repairs", F.lit(attempt)))
    return state


def synthesise(docs: DataFrame, model: Model, expected_date: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two rounds of model calls: four lanes a document, then one synthesis.

    ``docs`` has ``custom_id, text``. Lane answers are stored before the second
    round starts. Gives ``custom_id, missing, text, input_tokens,
    output_tokens, error``; documents without any lane answer are absent.
    """
    requests = lanes.fan_out(docs).select("lane_id", prompts.lane_instruction(F.col("lane")).alias("system"), F.concat_ws("\n\n", prompts.lane_prompt(F.col("lane")), "text").alias("prompt"))
    answers = store(call_model(requests, model, ["lane_id"])).filter("error is null")
    gathered = lanes.fan_in(answers, "output_tokens")
    hint = F.concat(F.lit("Use these extracted lane notes as your factual substrate:\n\n"), "body")
    second = gathered.select(F.col("base").alias("custom_id"), "missing", F.lit("").alias("system"), F.concat_ws("\n\n", prompts.user_instruction(F.lit(expected_date), F.lit(None).cast("string")), hint).alias("prompt"))
    return store(call_model(second, model, ["custom_id", "missing"]))
