"""Skew check: a third of all transactions on one card.

Derives a larger input from the driver's events (replicated ``--copies`` times,
with one user taking every third row), builds the layers and the review
inputs, and reports per-stage task balance from Spark's event log.

Usage: python scripts/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from riskmart.plans.batch import review_inputs  # noqa: E402
from riskmart.plans.pipeline import build_layers  # noqa: E402
from riskmart.session import build_session  # noqa: E402
from riskmart.sources.events import events_to_identity, events_to_transactions  # noqa: E402
from riskmart.sources.tables import LayerStore  # noqa: E402

HOT_USER = 7   # p_emaildomain 'mail.com': its rows also score high, so candidates sit on it


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    work = tempfile.mkdtemp(prefix="riskmart-skew-")
    logs = f"{work}/events"
    Path(logs).mkdir()
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                                 "spark.driver.memory": "8g",
                                                 "spark.eventLog.dir": logs,
                                                 "spark.eventLog.compress": "false",
                                                 "spark.eventLog.rolling.enabled": "false",
                                                 "spark.checkpoint.dir": work})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.count()
    big = (ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
           .select((F.col("event_id") * copies + F.col("copy")).alias("event_id"), "ts",
                   F.when((F.col("event_id") * copies + F.col("copy")) % 3 == 0, F.lit(HOT_USER))
                   .otherwise(F.col("user_id")).alias("user_id"),
                   "event_type", "value", "props"))
    # Real input arrives as many files: write the derived events as 16 files first.
    big.repartition(16).write.parquet(f"{work}/events_in")
    big = spark.read.parquet(f"{work}/events_in")
    store = LayerStore(spark, f"{work}/layers")
    t0 = time.perf_counter()
    layers = build_layers(store, events_to_transactions(big),
                          identity_from_transactions=events_to_identity)
    t1 = time.perf_counter()
    inputs = review_inputs(layers, n=20)
    for name in ("statistics", "history", "prompts"):
        store.write(f"review_{name}", getattr(inputs, name))
    t2 = time.perf_counter()
    hot = layers.enriched.where(F.col("card1") == HOT_USER).count()
    total = layers.enriched.count()
    on_hot = store.read("review_candidates").where(F.col("card1") == HOT_USER).count()
    hist = store.read("review_history").groupBy("candidate_id").count().agg(F.max("count")).first()[0]
    spark.stop()

    tasks = defaultdict(list)
    for f in [p for p in glob.glob(f"{logs}/**/*", recursive=True) if Path(p).is_file()]:
        for line in open(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                        + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                tasks[e["Stage ID"]].append((m.get("Executor Run Time", 0), recs))
    print(json.dumps({"rows": total, "events_in": n * copies, "hot_card_rows": hot,
                      "hot_share": round(hot / total, 3), "candidates_on_hot_card": on_hot,
                      "max_history_rows_per_candidate": hist,
                      "layers_sec": round(t1 - t0, 1), "review_sec": round(t2 - t1, 1)}))
    worst = []
    for sid, ts in tasks.items():
        if len(ts) < 2:
            continue
        runs = [t for t, _ in ts]
        recs = [r for _, r in ts]
        worst.append((max(runs) / max(1, statistics.median(runs)), sid, len(ts), max(runs),
                      statistics.median(runs), max(recs), statistics.median(recs)))
    print("stage  tasks  max_ms  median_ms  max_records  median_records   (5 most skewed)")
    for ratio, sid, k, mx, md, mr, mdr in sorted(worst, reverse=True)[:5]:
        print(f"{sid:5d} {k:6d} {mx:7d} {md:10.0f} {mr:12d} {mdr:15.0f}")


if __name__ == "__main__":
    main()
