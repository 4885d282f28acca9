from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from lakekit.operators import changes, history

SCHEMA = "k int, t string, v double"


def at(day: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(days=day)


def data_bytes(folder) -> int:
    return sum(
        os.path.getsize(os.path.join(p, f)) for p, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    )


def table(spark, n):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"), F.rand(1).alias("v"))


def test_random_versions_against_full_states(spark, tmp_path):
    """Every version's state and every range's feed, as if all states had been kept."""
    path, rng = str(tmp_path / "h"), random.Random(3)
    states = [{k: (f"t{k}", float(k)) for k in range(40)}]
    history.write_version(spark.createDataFrame([(k, *r) for k, r in states[0].items()], SCHEMA), path, 0, "CREATE", at(0))
    kinds = []
    for version in range(1, 8):
        new = dict(states[-1])
        gone = rng.sample(sorted(new), 2)
        touched = rng.sample(sorted(set(new) - set(gone)), 3)
        for k in gone:
            del new[k]
        new.update({k: (f"t{k}", rng.random()) for k in touched})
        new.update({100 * version + i: (None, None) for i in range(2)})
        state = spark.createDataFrame([(k, *r) for k, r in new.items()], SCHEMA)
        if version == 4:
            history.write_version(state, path, version, "LOAD", at(version))  # as a whole, without keys
        elif version % 2:
            history.write_version(state, path, version, "MERGE", at(version), ["k"])
        else:
            same = [min(set(new) - set(touched))]  # a row as it was
            given = [(k, *new[k], False) for k in (*touched, *same, 100 * version, 100 * version + 1)] + [(k, None, None, True) for k in gone]
            history.write_changes(spark.createDataFrame(given, f"{SCHEMA}, _deleted boolean"), path, version, "MERGE", at(version), ["k"])
        states.append(new)
        kinds.append(history._commits(spark, path).where(F.col("_version") == version).first()["_based"])
    assert True in kinds and False in kinds  # some became bases

    def frame(state):
        return spark.createDataFrame([(k, *r) for k, r in state.items()], SCHEMA)

    for version, state in enumerate(states):
        assert rows(history.snapshot_as_of(spark, path, version)) == rows(frame(state))
        assert rows(history.snapshot_as_of(spark, path, at=at(version) + timedelta(hours=1))) == rows(frame(state))
    counts = {r.version: r.num_rows for r in history.snapshot_history(spark, path).collect()}
    assert counts == {v: len(s) for v, s in enumerate(states)}
    assert history.read_history(spark, path).count() == sum(map(len, states))
    for first, last in ((1, 7), (2, 3), (4, 4), (5, 7)):
        want = []
        for v in range(first, last + 1):
            want += rows(changes.change_feed(frame(states[v - 1]), frame(states[v]), ["k"], v, at(v)))
        assert rows(history.change_feed_range(spark, path, ["k"], first, last)) == sorted(want, key=repr)
    assert history.snapshot_restore(spark, path, 5, at(9)) == 8
    assert rows(history.snapshot_as_of(spark, path, 8)) == rows(frame(states[5]))
    assert history.snapshot_restore(spark, path, 2, at(10)) == 9  # beyond a version without keys: a whole state
    assert rows(history.snapshot_as_of(spark, path, 9)) == rows(frame(states[2]))
    assert history.snapshot_as_of(spark, path, 77).count() == history.snapshot_as_of(spark, path, at=at(-1)).count() == 0
    assert history.change_feed_range(spark, path, ["k"], 70, 77).count() == 0


def test_written_bytes_follow_the_change(spark, tmp_path):
    path = str(tmp_path / "h")
    history.write_version(table(spark, 50_000), path, 0, "CREATE", at(0))
    whole = data_bytes(path)
    assert history.update_version(spark, path, F.col("k") % 100 == 7, {"v": F.lit(0.0)}, "UPDATE", at(1), ["k"]) == 1
    one_percent = data_bytes(path) - whole
    assert one_percent < 0.03 * whole
    assert history.snapshot_as_of(spark, path, 1).where("v = 0").count() == 500
    history.snapshot_restore(spark, path, 0, at(2))
    assert data_bytes(path) - whole - one_percent < 0.03 * whole
    assert rows(history.snapshot_as_of(spark, path, 2)) == rows(history.snapshot_as_of(spark, path, 0))
    feed = history.change_feed_range(spark, path, ["k"], 1, 2)
    assert dict(rows(changes.change_counts(feed))) == {"update_preimage": 1000, "update_postimage": 1000}


def test_feed_of_change_sets_shuffles_changed_keys_only(spark, tmp_path):
    path = str(tmp_path / "h")
    history.write_version(table(spark, 50_000), path, 0, "CREATE", at(0))
    history.update_version(spark, path, F.col("k") % 1000 == 7, {"v": F.lit(0.0)}, "UPDATE", at(1), ["k"])
    feed = history.change_feed_range(spark, path, ["k"], 1, 1)
    assert len(feed.collect()) == 100
    plan = executed_plan(feed)
    assert "FullOuter" not in plan and "BroadcastHashJoin" in plan
    state = history.snapshot_as_of(spark, path, 1)
    assert len(state.collect()) == 50_000
    assert "SortMergeJoin" not in executed_plan(state)


def test_a_share_of_changes_makes_a_base(spark, tmp_path):
    path = str(tmp_path / "h")
    history.write_version(table(spark, 100), path, 0, "CREATE", at(0))
    based = []
    for version in range(1, 6):
        history.update_version(spark, path, F.col("k") < 20, {"v": F.lit(float(version))}, "UPDATE", at(version), ["k"])
        based.append(history._commits(spark, path).where(F.col("_version") == version).first()["_based"])
    assert based == [False, False, True, False, False]
    assert rows(history.snapshot_as_of(spark, path, 5).where("k < 20").select("v").distinct()) == [(5.0,)]


def test_bad_keys_stop_the_job(spark, tmp_path):
    path = str(tmp_path / "h")
    with pytest.raises(ValueError, match="full state"):
        history.write_changes(table(spark, 1), path, 0, "X", at(0), ["k"])
    history.write_version(table(spark, 5), path, 0, "CREATE", at(0), ["k"])
    for bad, message in (([(1, "a", 1.0), (1, "b", 2.0)], "duplicate key"), ([(None, "a", 1.0)], "a key is NULL")):
        with pytest.raises(Exception, match=message):
            history.write_changes(spark.createDataFrame(bad, SCHEMA), path, 1, "X", at(1), ["k"])
    assert history.last_version(spark, path) == 0 and history.snapshot_as_of(spark, path, 0).count() == 5


def test_writing_a_change_set_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "h")
    history.write_version(table(spark, 100), path, 0, "CREATE", at(0))
    for n in (3, 2):
        given = spark.createDataFrame([(1000 + i, "new", 1.0) for i in range(n)], SCHEMA)
        history.write_changes(given, path, 1, "INSERT", at(1), ["k"])
    assert history.snapshot_as_of(spark, path, 1).count() == 102
    assert [r.num_rows for r in history.snapshot_history(spark, path).orderBy("version").collect()] == [100, 102]
