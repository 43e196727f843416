"""Layer sets are published whole; note tables rewrite only the buckets of a batch."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from riskmart.operators.casenotes import NOTE_COLUMNS
from riskmart.schema import CASE_NOTE_TYPES, ddl
from riskmart.sources.layer_sets import LayerSets, LostBuild
from riskmart.sources.manifest import Manifests
from riskmart.sources.notes import NoteTable


def number(spark, n):
    return spark.createDataFrame([(n,)], "n int")


def both(store, spark, n):
    store.write("a", number(spark, n))
    store.write("b", number(spark, n))


def values(store):
    return {name: store.read(name).first()["n"] for name in ("a", "b")}


def test_a_cut_off_build_leaves_the_old_set(spark, tmp_dir):
    sets = LayerSets(spark, tmp_dir)
    assert sets.current() is None
    sets.build(lambda s: both(s, spark, 1))
    pinned = sets.current()

    def dies(store):
        store.write("a", number(spark, 2))
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        sets.build(dies)
    assert values(sets.current()) == {"a": 1, "b": 1}
    sets.build(lambda s: both(s, spark, 3))
    assert values(sets.current()) == {"a": 3, "b": 3} and values(pinned) == {"a": 1, "b": 1}
    assert len(sets.prune(keep=1)) == 2                      # the first set and the one that was cut off
    assert values(LayerSets(spark, tmp_dir).current()) == {"a": 3, "b": 3}


def test_of_two_writers_one_wins(spark, tmp_dir):
    sets = LayerSets(spark, tmp_dir)

    def overtaken(store):
        both(store, spark, 1)
        LayerSets(spark, tmp_dir).build(lambda s: both(s, spark, 2))
    with pytest.raises(LostBuild):
        sets.build(overtaken)
    assert values(sets.current()) == {"a": 2, "b": 2}
    assert values(sets.current_or_build(lambda s: both(s, spark, 4))) == {"a": 2, "b": 2}


def test_one_of_many_creates_a_manifest(spark, tmp_dir):
    found = Manifests(spark, tmp_dir)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: found.publish(0, {"k": k}), range(16)))
    assert sum(won) == 1 and found.latest() == (0, {"k": won.index(True)})


def test_an_unfinished_manifest_is_passed_over(spark, tmp_dir):
    found = Manifests(spark, tmp_dir)
    assert found.publish(0, {"k": 0}) and not found.publish(0, {"k": 1})
    with open(os.path.join(tmp_dir, "manifests", f"{1:012d}.json"), "w") as f:
        f.write('{"k": 9')
    assert found.latest() == (0, {"k": 0}) and found.next_number() == 2


def notes(spark, rows):
    """(key, text, second) rows as notes written at that second of a minute."""
    made = [(k, "low", None, 0.5, t, "approve", t, t, s) for k, t, s in rows]
    types = {**CASE_NOTE_TYPES, "created_at": "int"}
    return spark.createDataFrame(made, ddl(types)).selectExpr(
        *NOTE_COLUMNS[:-1], "timestamp_seconds(1700000000 + created_at) AS created_at")


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_an_upsert_writes_its_buckets_only(spark, tmp_dir):
    table = NoteTable(spark, tmp_dir, buckets=16)
    assert table.latest().count() == 0 and table.upsert(notes(spark, [])) == []
    table.upsert(notes(spark, [(str(k), "first", 0) for k in range(200)]))
    before = files(tmp_dir)
    touched = table.upsert(notes(spark, [("7", "second", 9), ("new", "x", 9)]))
    written = files(tmp_dir) - before
    assert len(touched) <= 2 and len(written) == len(touched)
    now = {r["transaction_id"]: (r["case_note"], r["created_at"].second) for r in table.latest().collect()}
    first = now["8"][1]
    assert len(now) == 201 and now["7"] == ("second", first) and now["new"] == ("x", (first + 9) % 60)


def test_two_upserts_at_once_both_count(spark, tmp_dir):
    table = NoteTable(spark, tmp_dir, buckets=2)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: NoteTable(spark, tmp_dir, buckets=2).upsert(notes(spark, [(f"k{k}", "t", k)])), range(3)))
    assert sorted(r[0] for r in table.latest().select("transaction_id").collect()) == ["k0", "k1", "k2"]
    kept = table.latest()
    table.rebucket(5)
    assert table.latest().count() == 3
    assert kept.count() == 3                                 # an opened version stays readable
    table.prune(keep=1)
    assert NoteTable(spark, tmp_dir).latest().count() == 3
    assert table.upsert(notes(spark, [("k1", "later", 30)])) and table.latest().count() == 3


def test_repeated_keys_in_a_batch(spark, tmp_dir):
    table = NoteTable(spark, tmp_dir, buckets=4)
    table.upsert(notes(spark, [("a", "old", 1), ("a", "newer", 5)]))
    assert [(r["case_note"]) for r in table.latest().collect()] == ["newer"]
