"""Batch review plan: candidates -> statistics -> history -> prompts, and
answers -> first valid -> case-note upsert -> summary.

The review service sits between the two halves: the first half writes the
prompt table, the service's answers come back as a table, the second half
turns them into case notes.  No Python loop over rows, no driver collect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskmart.operators import casenotes as cn
from riskmart.operators import investigate as inv
from riskmart.plans.pipeline import Layers
from riskmart.sources.tables import LayerStore


@dataclass
class ReviewInputs:
    candidates: DataFrame
    statistics: DataFrame
    history: DataFrame
    prompts: DataFrame


def review_inputs(layers: Layers, n: int = 5, k: int = 10, store: LayerStore | None = None) -> ReviewInputs:
    """The first half: everything the reviewer sees, one row (or k rows) per candidate.

    The candidate list is written first (``review_candidates``), so the top-N
    over the scoring table runs once; statistics, history and prompts read it.  It goes
    into ``store``, next to the layers where none is given.
    """
    cands = (store or layers.store).write("review_candidates", inv.candidates(layers.scoring, layers.enriched, n))
    stats = inv.card_statistics(cands, layers.enriched)
    hist = inv.recent_history(cands, layers.enriched, k)
    return ReviewInputs(cands, stats, hist, inv.prompts(cands, stats, hist))


@dataclass
class ReviewOutcome:
    attempts: DataFrame      # every answer, parsed and validated
    results: DataFrame       # one row per candidate: first valid answer or failure
    notes: DataFrame         # the case-note table after the upsert
    summary: DataFrame       # investigated / succeeded / failed / failed ids


def review_outcome(candidates: DataFrame, answers: DataFrame, existing_notes: DataFrame,
                   max_retries: int = 2) -> ReviewOutcome:
    """The second half, from the answer table."""
    attempts = cn.parse_responses(answers)
    results = cn.first_valid(attempts, candidates.select("transaction_id"), max_retries)
    notes = cn.upsert_case_notes(existing_notes, cn.notes_from_results(results))
    return ReviewOutcome(attempts, results, notes, cn.batch_summary(candidates, results))


def write_report_base(store, fact: DataFrame, notes: DataFrame, scored: DataFrame) -> DataFrame:
    """Write the dashboard's joined extract (fact + notes + scoring) once.

    All worksheets aggregate this one table, so the large fact-scoring join
    runs once per refresh instead of once per worksheet.  The fact holds train rows
    only and a transaction is in one split, so only that part of the scoring is read.
    """
    from riskmart.operators.reporting import report_base
    return store.write("report_base", report_base(fact, notes, scored.where("split = 'train'")))
