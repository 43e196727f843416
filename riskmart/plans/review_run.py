"""A review batch that can be cut off and resumed.

A run has a folder of its own.  Starting it writes the candidates, their statistics, history
and prompts.  Each :meth:`ReviewRun.take` reads the answers that have arrived, keeps the
first valid one of every candidate that is still open, upserts the case notes of those and
publishes a state table: ``open`` (no valid answer yet, attempts left), ``done`` or
``failed``.  Only open candidates are asked about again, so a run that was cut off goes on
where its last published state stands; answers taken twice change nothing, since a note is
upserted by its key and a candidate that is not open takes no answer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators import casenotes as cn
from riskmart.plans.batch import review_inputs
from riskmart.plans.pipeline import Layers
from riskmart.session import join_path
from riskmart.sources.manifest import Manifests
from riskmart.sources.notes import NoteTable
from riskmart.sources.tables import LayerStore

RESULT_COLUMNS = ["transaction_id", "attempt", *cn.ANSWER_FIELDS, "raw_response"]


class ReviewRun:
    """The run ``name`` under ``root``; ``notes`` is the case-note table all runs write to."""

    def __init__(self, spark: SparkSession, root: str, name: str, notes: NoteTable, max_retries: int = 2):
        self.spark, self.notes, self.max_retries = spark, notes, max_retries
        self.store = LayerStore(spark, join_path(root, name))
        self.manifests = Manifests(spark, join_path(root, name))

    def start(self, layers: Layers, n: int = 5, k: int = 10) -> "ReviewRun":
        """Write the batch's inputs and its first state, where an earlier start did not finish that."""
        if self.manifests.latest() is None:
            inputs = review_inputs(layers, n, k, self.store)
            self.store.write("review_prompts", inputs.prompts)
            self._publish(0, inputs.candidates.select(
                "candidate_rank", "transaction_id", F.lit("open").alias("state"), F.lit(0).alias("attempts"),
                *(F.lit(None).cast("double" if c == "confidence" else "int" if c == "attempt" else "string").alias(c)
                  for c in RESULT_COLUMNS[1:])))
        return self

    def _publish(self, number: int, state: DataFrame) -> bool:
        name = f"state-{uuid.uuid4().hex}"
        self.store.write(name, state)
        return self.manifests.publish(number, {"state": name})

    def state(self) -> DataFrame:
        """One row for each candidate: its state, attempts so far, and the answer that was kept."""
        return self.store.read(self.manifests.latest()[1]["state"])

    def open_prompts(self) -> DataFrame:
        """(transaction_id, candidate_rank, prompt, attempt): what is to be asked next."""
        still = self.state().where("state = 'open'").select("transaction_id", (F.col("attempts") + 1).alias("attempt"))
        return self.store.read("review_prompts").join(still, "transaction_id")

    def take(self, answers: DataFrame) -> DataFrame:
        """Take the answers (transaction_id, attempt, raw_response) of open candidates; the new state."""
        number, state = self.manifests.next_number(), self.state()
        still = state.where("state = 'open'").select("transaction_id", "attempts")
        new = answers.join(still, "transaction_id").where(F.col("attempt") > F.col("attempts"))
        parsed = cn.parse_responses(new)
        best = cn.first_valid(parsed, None, self.max_retries).select(*RESULT_COLUMNS, "succeeded")
        seen = new.groupBy("transaction_id").agg(F.max("attempt").cast("int").alias("last"))
        found = self.store.write(f"results-{uuid.uuid4().hex}", seen.join(best, "transaction_id", "left"))
        self.notes.upsert(cn.notes_from_results(found.where("succeeded")))
        s, f = state.alias("s"), found.alias("f")
        tried = F.greatest(F.col("s.attempts"), F.coalesce(F.col("f.last"), F.lit(0)))
        now = (F.when(F.col("s.state") != "open", F.col("s.state")).when(F.col("f.succeeded"), "done")
               .when(tried > self.max_retries, "failed").otherwise("open"))
        kept = [F.coalesce(F.col(f"s.{c}"), F.col(f"f.{c}")).alias(c) for c in RESULT_COLUMNS[1:]]
        joined = s.join(f, F.col("s.transaction_id") == F.col("f.transaction_id"), "left").select(
            "s.candidate_rank", "s.transaction_id", now.alias("state"), tried.cast("int").alias("attempts"), *kept)
        if not self._publish(number, joined):
            raise RuntimeError("another process took answers of this run at the same time")
        return self.state()

    def failed(self) -> DataFrame:
        """(candidate_rank, transaction_id) of the candidates that no answer was valid for."""
        return self.state().where("state = 'failed'").select("candidate_rank", "transaction_id")

    def summary(self) -> DataFrame:
        """Candidates investigated, done, failed and still open."""
        count = lambda name: F.count_if(F.col("state") == name).alias(name)
        return self.state().agg(F.count(F.lit(1)).alias("investigated"), count("done"), count("failed"), count("open"))
