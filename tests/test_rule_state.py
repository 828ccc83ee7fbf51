"""Rule state merged load by load against the ruleset on the whole table."""

import pytest

from laminar.operators import quality, rule_state
from laminar.plans.layers import key_rules
from laminar.session import fresh_dir
from laminar.sources import snapshots


def _values(df):
    return {r.rule: (r.value, r.passed) for r in df.collect()}


def _whole(frames, keys):
    table = frames[0]
    for f in frames[1:]:
        table = table.unionByName(f, allowMissingColumns=True)
    return _values(quality.evaluate_ruleset(table, key_rules(keys)))


LOADS = [
    [(1, "a"), (2, "a"), (2, "b"), (None, "c")],
    [(1, "a"), (3, "a"), (4, None), (4, None)],
    [],
    [(3, "a"), (5, "z"), (None, None), (9, "q")],
]


@pytest.mark.parametrize("keys", ["id", ("id", "kind")])
def test_loads_equal_the_whole_table(spark, keys):
    path = f"{fresh_dir(spark, 'rules')}/state"
    frames = [spark.createDataFrame(rows, "id long, kind string") for rows in LOADS]
    for k, frame in enumerate(frames):
        got = _values(rule_state.add_load(frame, path, keys, f"load-{k}"))
        assert got == _whole(frames[: k + 1], keys)
    assert _values(rule_state.evaluate(spark, path, keys)) == _whole(frames, keys)


def test_replayed_loads_take_their_own_place(spark):
    path = f"{fresh_dir(spark, 'rules')}/state"
    frames = [spark.createDataFrame(rows, "id long, kind string") for rows in LOADS]
    for k in (0, 1, 3):
        rule_state.add_load(frames[k], path, "id", f"load-{k}")
    more = spark.createDataFrame([(1, "a"), (7, "b")], "id long, kind string")
    for label, frame, now in (
        ("load-3", frames[3], [frames[0], frames[1], frames[3]]),  # the last one
        ("load-0", more, [more, frames[1], frames[3]]),  # an earlier one
        ("load-0", frames[0], [frames[0], frames[1], frames[3]]),  # and back
    ):
        assert _values(rule_state.add_load(frame, path, "id", label)) == _whole(now, "id")
    assert len(snapshots.manifest(spark, path)["entries"]) == 3


def test_gate_keeps_a_failing_load_out(spark):
    path = f"{fresh_dir(spark, 'rules')}/state"
    good = spark.range(100)
    rule_state.add_load(good, path, "id", "good", key_rules("id"))
    before = _values(rule_state.evaluate(spark, path, "id"))
    with pytest.raises(ValueError, match="rules failed"):
        rule_state.add_load(spark.range(50), path, "id", "bad", key_rules("id"))
    assert _values(rule_state.evaluate(spark, path, "id")) == before
    with pytest.raises(ValueError, match="no counts"):
        rule_state.evaluate(spark, path, "id", key_rules("other"))


def test_merged_loads_keep_the_counts(spark, monkeypatch):
    monkeypatch.setattr(rule_state, "MAX_LOADS", 2)
    path = f"{fresh_dir(spark, 'rules')}/state"
    frames = [spark.createDataFrame(rows, "id long, kind string") for rows in LOADS]
    for k, frame in enumerate(frames):
        assert _values(rule_state.add_load(frame, path, "id", f"load-{k}")) == _whole(frames[: k + 1], "id")
    assert len(snapshots.manifest(spark, path)["entries"]) == 2
    # the last load can still be replayed, merged ones can't
    assert _values(rule_state.add_load(frames[3], path, "id", "load-3")) == _whole(frames, "id")
    with pytest.raises(ValueError, match="merged"):
        rule_state.add_load(frames[0], path, "id", "load-0")


def test_empty_and_missing(spark):
    path = f"{fresh_dir(spark, 'rules')}/state"
    assert not any(p for r, (_, p) in _values(rule_state.evaluate(spark, path, "id")).items())
    empty = spark.createDataFrame([], "id long")
    got = _values(rule_state.add_load(empty, path, "id", "none"))
    assert got["Completeness"] == (None, False) and got["Uniqueness"] == (None, False)
