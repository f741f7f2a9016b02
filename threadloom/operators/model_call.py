"""Batched model calls through a user-supplied function, and their answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.answers import object_text, parse_object
from ..schemas import INTENT_ANSWER, RUBRIC_DIMENSIONS
from ..session import stage
from .metrics import EMPTY_OVERALL, MISSING_DIM_SCORE
from .rules import closest_label

# Retry policy and the rows written when a step fails.
TRIES, FIRST_WAIT = 3, 2.0
FAILED_INTENT, ERROR_INTENT = "other", "error"
FAILED_REPLY = "We'd like to help! Please DM us your details so we can look into this further."

# complete(prompts with columns id, prompt, system; model kind)
#   -> frame with columns id, response, in_tokens, out_tokens, error (null = fine)
Complete = Callable[[pd.DataFrame, str], pd.DataFrame]


def call_model(
    prompts: DataFrame, complete: Complete, kind: str = "pipeline", id_col: str = "id", prompt_col: str = "prompt",
    system: str = "", wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """(id, response, in_tokens, out_tokens, attempts, error), written before use.

    ``complete`` gets one Arrow batch at a time.  Rows that fail, or that it leaves
    out, are tried again after ``wait`` and twice ``wait`` seconds; the last try of
    the ``pipeline`` kind asks for the ``fallback`` model.  Of the answers to one id the
    first counts, and answers to ids that were not asked do not.  The result is
    staged, so later steps never repeat a call.
    """
    key = prompts.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, key), T.StructField("response", T.StringType()), T.StructField("in_tokens", T.LongType()),
        T.StructField("out_tokens", T.LongType()), T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())])

    def attempt(rows: pd.DataFrame, model: str) -> pd.DataFrame:
        try:
            answers = complete(rows, model)[["id", "response", "in_tokens", "out_tokens", "error"]]
            return answers[answers["id"].isin(rows["id"])].drop_duplicates("id")
        except Exception as problem:  # a failing batch fails all its rows
            return rows[["id"]].assign(response=None, in_tokens=0, out_tokens=0, error=str(problem))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            open_rows = batch.assign(system=system)
            for number in range(1, TRIES + 1):
                if number > 1:
                    sleep(wait * 2 ** (number - 2))
                model = "fallback" if number == TRIES and kind == "pipeline" else kind
                answers = attempt(open_rows, model)
                silent = open_rows.loc[~open_rows["id"].isin(answers["id"]), ["id"]]
                if len(silent):
                    silent = silent.assign(response=None, in_tokens=0, out_tokens=0, error="no answer for this row")
                    answers = pd.concat([answers, silent], ignore_index=True)
                answers = answers.assign(attempts=number)
                failed = answers["error"].notna()
                final = answers if number == TRIES else answers[~failed]
                if len(final):
                    yield final.rename(columns={"id": id_col})
                open_rows = open_rows[open_rows["id"].isin(answers.loc[failed, "id"])]
                if open_rows.empty:
                    break

    asked = prompts.select(F.col(id_col).alias("id"), F.col(prompt_col).alias("prompt"))
    return stage(asked.mapInPandas(run, schema).select(*[f.name for f in schema.fields]), "model-answers")


def stored_answers(prompts: DataFrame, answers: DataFrame, step: str, id_col: str = "id") -> DataFrame:
    """(id, response, error) from answers that are there already: rows (step, id, response), one per step and id.

    A row without one is an error row, as if the call had failed.
    """
    own = answers.filter(F.col("step") == step).select(F.col("id").alias(id_col), "response")
    return prompts.select(id_col).join(own, id_col, "left").withColumn("error", F.when(F.col("response").isNull(), "no stored answer"))


def usage(calls: DataFrame) -> DataFrame:
    """Successful calls and their tokens."""
    fine = calls.filter("error is null")
    return fine.agg(
        F.count("*").alias("total_calls"),
        F.coalesce(F.sum("in_tokens"), F.lit(0)).cast("bigint").alias("total_input_tokens"),
        F.coalesce(F.sum("out_tokens"), F.lit(0)).cast("bigint").alias("total_output_tokens"))


def intent_answer(response: Column, error: Column, labels: list[str]) -> Column:
    """Parsed intent with a repaired label, or the failure row."""
    parsed = parse_object(response, INTENT_ANSWER)
    why = F.coalesce(error, F.concat(F.lit("Could not parse JSON from response: "), F.substring(response, 1, 200)), F.lit("no response"))
    failed = F.struct(
        F.lit(FAILED_INTENT).alias("intent"), F.lit(0.0).alias("confidence"),
        F.concat(F.lit("Classification failed: "), why).alias("reasoning"))
    good = F.struct(
        closest_label(parsed["intent"], labels).alias("intent"), parsed["confidence"].alias("confidence"), parsed["reasoning"].alias("reasoning"))
    return F.when(error.isNull() & parsed.isNotNull(), good).otherwise(failed)


def reply_answer(response: Column, error: Column, sources: Column) -> Column:
    """Parsed reply, or a generic one; the grounding sources are kept either way."""
    parsed = parse_object(response, T.StructType([T.StructField("reply", T.StringType()), T.StructField("strategy", T.StringType())]))
    why = F.coalesce(error, F.lit("unreadable response"))
    good = F.struct(parsed["reply"].alias("reply"), sources.alias("grounding_sources"), parsed["strategy"].alias("strategy"))
    failed = F.struct(
        F.lit(FAILED_REPLY).alias("reply"), sources.alias("grounding_sources"),
        F.concat(F.lit("Fallback generic reply (error: "), why, F.lit(")")).alias("strategy"))
    return F.when(error.isNull() & parsed["reply"].isNotNull(), good).otherwise(failed)


def escalation_answer(response: Column, error: Column) -> Column:
    """Parsed decision struct, null when the call or the parsing failed."""
    parsed = parse_object(response, T.StructType([
        T.StructField("decision", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("confidence", T.DoubleType())]))
    return F.when(error.isNull(), parsed)


def error_rows(predictions: DataFrame, error_col: str = "error") -> DataFrame:
    """Replace the answers of rows whose processing failed as a whole."""
    error = F.col(error_col)
    def swap(name: str, failed: Column) -> Column:
        return F.when(error.isNotNull(), failed).otherwise(F.col(name))
    return predictions.withColumns({
        "intent": swap("intent", F.struct(F.lit(ERROR_INTENT).alias("intent"), F.lit(0.0).alias("confidence"), error.alias("reasoning"))),
        "reply": swap("reply", F.struct(
            F.lit("").alias("reply"), F.array().cast("array<string>").alias("grounding_sources"), F.lit("error").alias("strategy"))),
        "escalation": swap("escalation", F.struct(
            F.lit("escalate").alias("decision"), F.concat(F.lit("Error: "), error).alias("reason"),
            F.lit(0.0).alias("confidence"), F.lit("error").alias("trigger"))),
    })


def judge_rows(answers: DataFrame, response_col: str = "response", error_col: str = "error") -> DataFrame:
    """Rubric structs and an overall score from judge answers.

    A missing overall score becomes the mean of the dimensions: an absent
    dimension, or an object without ``score``, counts 3; a bare number counts as
    it is; anything else is skipped; 3 when nothing is left.  An answer that is
    unreadable or not an object gives zeros.
    """
    parsed = answers.withColumn("_json", F.coalesce(
        F.try_parse_json(F.col(response_col)), F.try_parse_json(object_text(F.col(response_col)))))
    ok = F.col(error_col).isNull() & F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    reason = F.concat(F.lit("Judge failed: "), F.coalesce(F.col(error_col), F.lit("unreadable response")))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get(F.col("_json"), path, kind)

    def kind_of(path: str) -> Column:
        return F.schema_of_variant(part(path, "variant"))

    numeric = "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"
    columns, counted = {}, []
    for dim in RUBRIC_DIMENSIONS:
        kind = kind_of(f"$.{dim}")
        is_object = kind.startswith("OBJECT")
        score = F.when(is_object, part(f"$.{dim}.score", "double")).when(kind.rlike(numeric), part(f"$.{dim}", "double"))
        counted.append(F.when(kind.isNull(), F.lit(MISSING_DIM_SCORE)).when(is_object, F.coalesce(score, F.lit(MISSING_DIM_SCORE))).otherwise(score))
        columns[dim] = F.struct(
            F.when(ok, score).otherwise(F.lit(0.0)).alias("score"),
            F.when(ok, part(f"$.{dim}.reasoning", "string")).otherwise(reason).alias("reasoning"))
    usable = F.filter(F.array(*counted), lambda s: s.isNotNull())
    mean = F.when(F.size(usable) > 0, F.aggregate(usable, F.lit(0.0), lambda t, s: t + s) / F.size(usable))
    repaired = F.coalesce(F.bround(mean, 2), F.lit(EMPTY_OVERALL))
    given = F.when(kind_of("$.overall_score").rlike(numeric), part("$.overall_score", "double"))
    columns["overall_score"] = F.when(ok, F.coalesce(given, repaired)).otherwise(F.lit(0.0))
    columns["overall_assessment"] = F.when(ok, part("$.overall_assessment", "string")).otherwise(
        F.concat(F.lit("Evaluation failed: "), F.coalesce(F.col(error_col), F.lit("unreadable response"))))
    return parsed.withColumns(columns).drop("_json")
