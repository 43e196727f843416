"""End-to-end batch flow through the command line, in the test session."""

import os

from riskmart.__main__ import main
from riskmart.plans.fixtures import answers_for
from riskmart.sources.notes import NoteTable
from tests.conftest import SF0001


def test_events_prompts_notes_export(spark, tmp_dir, capsys):
    work = os.path.join(tmp_dir, "work")
    main(["events", "--sf-dir", SF0001, "--work", work])
    main(["prompts", "--work", work, "--limit", "4"])
    prompts = spark.read.parquet(os.path.join(work, "review", "review_prompts"))
    assert prompts.count() == 4
    assert all(p.startswith("Flagged transaction for review:") for (p,) in
               prompts.select("prompt").collect())

    cands = spark.read.parquet(os.path.join(work, "review", "review_candidates"))
    answers = os.path.join(tmp_dir, "answers")
    answers_for(cands).write.parquet(answers)
    main(["notes", "--work", work, "--answers", answers])
    main(["notes", "--work", work, "--answers", answers])          # a second run upserts
    table = NoteTable(spark, os.path.join(work, "case_notes"))
    assert table.version() == 1
    notes = table.latest()
    ids = [r[0] for r in notes.select("transaction_id").collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) <= 4

    out = os.path.join(tmp_dir, "exports")
    main(["export", "--work", work, "--out", out])
    assert sorted(os.listdir(out)) == ["case_notes", "fct_fraud_analysis", "rule_based_scoring"]
    text = capsys.readouterr().out
    assert "investigated" in text and "rule_based_scoring" in text


def test_catalog_store_flow(spark, tmp_dir):
    import uuid
    db = f"riskmart_cli_{uuid.uuid4().hex[:8]}"
    work = os.path.join(tmp_dir, "work")
    main(["events", "--sf-dir", SF0001, "--work", work, "--catalog-db", db, "--buckets", "4"])
    main(["prompts", "--work", work, "--limit", "3", "--catalog-db", db])
    assert spark.table(f"{db}.review_prompts").count() == 3
    assert spark.catalog.tableExists(f"{db}.int_transactions_enriched")
