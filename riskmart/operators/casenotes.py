"""Case notes: validate written answers, keep the first valid attempt, upsert, summarize.

Answers arrive as a table ``(transaction_id, attempt, raw_response)`` - one row
per attempt, attempts counted from 1.  Everything is set-based: parsing is a
projection, "first valid attempt" a partial aggregate per transaction, and the
upsert a join on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.answers import parse_answers
from riskmart.schema import ANSWER_FIELDS, CASE_NOTE_TYPES, ddl

NOTE_COLUMNS = list(CASE_NOTE_TYPES)            # key, six fields, raw text, created_at
UPSERT_COLUMNS = NOTE_COLUMNS[:-1]              # what an upsert writes (not created_at)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Every attempt with ``valid`` and its six parsed fields (NULL when invalid)."""
    return parse_answers(responses.select("transaction_id", "attempt", "raw_response"))


def first_valid(parsed: DataFrame, candidate_ids: DataFrame | None = None,
                max_retries: int = 2) -> DataFrame:
    """Per transaction: the lowest valid attempt among the first ``max_retries + 1``.

    Result columns: transaction_id, succeeded, attempt, six fields, raw_response.
    With ``candidate_ids`` (one ``transaction_id`` column) transactions without
    any valid attempt are kept as failures.
    """
    ok = parsed.where(F.col("valid") & (F.col("attempt") <= max_retries + 1))
    best = ok.groupBy("transaction_id").agg(
        F.min_by(F.struct("attempt", *ANSWER_FIELDS, "raw_response"), F.col("attempt")).alias("b"))
    best = best.select("transaction_id", F.lit(True).alias("succeeded"), "b.*")
    if candidate_ids is None:
        return best
    ids = candidate_ids.select("transaction_id").distinct()
    out = ids.join(best, "transaction_id", "left")
    return out.select("transaction_id",
                      F.coalesce(F.col("succeeded"), F.lit(False)).alias("succeeded"),
                      "attempt", *ANSWER_FIELDS, "raw_response")


def notes_from_results(results: DataFrame) -> DataFrame:
    """Case-note rows (text key) for the successful results, written now."""
    return (results.where(F.col("succeeded"))
            .select(F.col("transaction_id").cast("string").alias("transaction_id"),
                    *ANSWER_FIELDS, "raw_response",
                    F.current_timestamp().alias("created_at")))


def empty_notes(spark) -> DataFrame:
    """The case-note table when none exists yet."""
    return spark.createDataFrame([], ddl(CASE_NOTE_TYPES))


def upsert_case_notes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-or-replace by ``transaction_id``.

    Incoming rows replace the eight written columns; ``created_at`` of an
    existing row is kept (an upsert with a column list leaves unlisted
    columns alone), new rows get ``created_at`` of the incoming row or now.
    The key stays unique: should ``incoming`` hold a key twice, one row wins
    (latest ``created_at``, then the answer text), as one of two sequential
    writes of the same key would.
    """
    old = existing.select(*NOTE_COLUMNS).alias("o")
    stamped = incoming.select(*UPSERT_COLUMNS,
                              (F.col("created_at") if "created_at" in incoming.columns
                               else F.current_timestamp()).alias("created_at"))
    rest = [c for c in NOTE_COLUMNS if c != "transaction_id"]
    new = (stamped.groupBy("transaction_id")
           .agg(F.max_by(F.struct(*rest), F.struct("created_at", "raw_response")).alias("r"))
           .select("transaction_id", "r.*").alias("n"))
    joined = old.join(new, F.col("o.transaction_id") == F.col("n.transaction_id"), "full_outer")
    has_new = F.col("n.transaction_id").isNotNull()
    cols = [F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
            for c in UPSERT_COLUMNS]
    cols.append(F.coalesce(F.col("o.created_at"), F.col("n.created_at")).alias("created_at"))
    return joined.select(*cols)


def batch_summary(candidate_rows: DataFrame, results: DataFrame) -> DataFrame:
    """investigated, succeeded, failed, failed_ids (comma list in candidate order).

    One row; the failed-id list is bounded by the batch size (top-N).
    """
    r = candidate_rows.select("transaction_id", "candidate_rank").join(
        results.select("transaction_id", "succeeded"), "transaction_id", "left")
    failed = F.coalesce(F.col("succeeded"), F.lit(False)) == F.lit(False)
    failed_list = F.array_sort(F.collect_list(
        F.when(failed, F.struct("candidate_rank", F.col("transaction_id").cast("string").alias("id")))))
    return r.agg(
        F.count(F.lit(1)).alias("investigated"),
        F.count_if(~failed).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.array_join(F.transform(failed_list, lambda x: x["id"]), ", ").alias("failed_ids"),
    )


def failed_candidates(candidate_rows: DataFrame, results: DataFrame) -> DataFrame:
    """(candidate_rank, transaction_id) of every candidate without a valid answer, one row each."""
    ok = results.where(F.col("succeeded")).select("transaction_id")
    return candidate_rows.join(ok, "transaction_id", "left_anti").select("candidate_rank", "transaction_id")


def label_counts(results: DataFrame, column: str) -> DataFrame:
    """(label, count) of a result field over successful results, by label."""
    return (results.where(F.col("succeeded")).groupBy(F.col(column).alias("label"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_first("label")))
