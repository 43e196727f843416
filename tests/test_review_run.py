"""A review run goes on where its last published state stands."""

import uuid

import pytest
from pyspark.sql import functions as F

from riskmart.plans.catalog import layers_for
from riskmart.plans.fixtures import answers_for
from riskmart.plans.review_run import ReviewRun
from riskmart.sources.notes import NoteTable
from tests.conftest import SF0001


@pytest.fixture()
def made(spark, tmp_dir):
    notes = NoteTable(spark, tmp_dir + "/notes", buckets=4)
    name = uuid.uuid4().hex
    again = lambda: ReviewRun(spark, tmp_dir + "/runs", name, notes)
    run = again().start(layers_for(spark, SF0001), n=8)
    return again, notes, answers_for(run.store.read("review_candidates")).cache()


def states(run):
    return {r["transaction_id"]: (r["state"], r["attempts"], r["attempt"]) for r in run.state().collect()}


def test_rounds_until_done_or_failed(spark, made):
    again, notes, answers = made
    valid = {}
    for r in answers.collect():
        if (r["transaction_id"] + r["attempt"]) % 8 < 3:
            valid[r["transaction_id"]] = min(r["attempt"], valid.get(r["transaction_id"], 9))
    assert again().open_prompts().count() == 8 and again().summary().first()["open"] == 8
    for attempt in (1, 2, 3):
        run = again()
        asked = run.open_prompts()
        assert {r["attempt"] for r in asked.select("attempt").collect()} <= {attempt}
        assert {r[0] for r in asked.select("transaction_id").collect()} == {
            t for t in states(run) if valid.get(t, 9) >= attempt}
        run.take(answers.where(F.col("attempt") == attempt))
    assert states(again()) == {t: ("done", valid[t], valid[t]) if t in valid else ("failed", 3, None) for t in states(again())}
    assert {r[0] for r in notes.latest().select("transaction_id").collect()} == {str(t) for t in valid}
    assert {r["transaction_id"] for r in again().failed().collect()} == set(states(again())) - set(valid)
    s = again().summary().first()
    assert (s["investigated"], s["done"], s["failed"], s["open"]) == (8, len(valid), 8 - len(valid), 0)


def test_all_attempts_at_once_and_twice(spark, made):
    again, notes, answers = made
    again().take(answers)
    first, written = states(again()), sorted(map(tuple, notes.latest().collect()))
    again().take(answers)                               # nothing is open: nothing changes
    assert states(again()) == first and sorted(map(tuple, notes.latest().collect())) == written
    assert "open" not in {s for s, _, _ in first.values()}


def test_cut_off_between_notes_and_state(spark, made, monkeypatch):
    again, notes, answers = made
    monkeypatch.setattr(ReviewRun, "_publish", lambda self, number, state: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        again().take(answers)
    monkeypatch.undo()
    times = {r["transaction_id"]: r["created_at"] for r in notes.latest().collect()}
    assert {s for s, _, _ in states(again()).values()} == {"open"} and times
    again().take(answers)
    assert {r["transaction_id"]: r["created_at"] for r in notes.latest().collect()} == times
    again().start(layers_for(spark, SF0001), n=8)       # a started run is left as it is
    assert "open" not in {s for s, _, _ in states(again()).values()}


def test_two_takers(spark, made, monkeypatch):
    again, notes, answers = made
    plain = ReviewRun._publish

    def overtaken(self, number, state):
        monkeypatch.setattr(ReviewRun, "_publish", plain)
        again().take(answers)
        return plain(self, number, state)
    monkeypatch.setattr(ReviewRun, "_publish", overtaken)
    with pytest.raises(RuntimeError, match="same time"):
        again().take(answers)
    assert "open" not in {s for s, _, _ in states(again()).values()}
