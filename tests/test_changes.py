"""Change capture against a plain replay, in any order and with failures."""

import os
import random

import pytest
from pyspark.sql import functions as F
from riskloom.operators import changes, layout
from riskloom.sources.tables import read_table

LOG = "k int, part int, op string, seq long, v string"


def log_rows(seed, keys=30):
    """Changes of each key with ascending numbers; a delete has no values."""
    rng, out = random.Random(seed), []
    for k in [*range(keys), None]:
        for seq in range(rng.randrange(1, 7)):
            op = "I" if seq == 0 else rng.choice(["U", "D", "insert", "delete "])
            out.append((k, (k or 0) % 5, op, 10 * seq + (k or 0) % 3, None if op[0] in "Dd" else f"{k}-{seq}"))
    rng.shuffle(out)
    return out


def replay(rows):
    """What exists when all changes are applied in the order of their numbers."""
    state = {}
    for k, _, op, seq, value in sorted(rows, key=lambda r: (r[3], r[2][0] in "Dd")):
        state[k] = None if op[0] in "Dd" else (seq, value)
    return {k: x for k, x in state.items() if x}


def applied(spark, path, rows, parts):
    for n in range(parts):
        some = spark.createDataFrame(rows[n::parts], LOG)
        changes.apply_changes(spark, path, some, "k", "seq", "op", "part", f"r{n}", key_gives_partition=True)
    return content(spark, path)


def content(spark, path):
    schema = spark.createDataFrame([], LOG).schema
    found = changes.current(spark, path, schema, "op").collect()
    assert len({r.k for r in found}) == len(found)
    return {r.k: (r.seq, r.v) for r in found}


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 4), (3, 6)])
def test_any_order_gives_the_replay(spark, tmp_path, seed, parts):
    rows = log_rows(seed)
    assert applied(spark, str(tmp_path / "t"), rows, parts) == replay(rows)


def test_late_change_does_not_bring_a_row_back(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 1, "I", 1, "a"), (1, 1, "D", 5, None), (1, 1, "U", 3, "late"), (2, 1, "D", 4, None), (2, 1, "I", 2, "late")]
    assert applied(spark, path, rows, 5) == {}
    again = spark.createDataFrame([(1, 1, "I", 6, "new"), (2, 1, "U", 4, "same number as the delete")], LOG)
    changes.apply_changes(spark, path, again, "k", "seq", "op", "part", "r9", key_gives_partition=True)
    assert content(spark, path) == {1: (6, "new")}


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    applied(spark, path, [(k, k % 5, "I", 1, "x") for k in range(50)], 1)
    files = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_ino for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    part = spark.createDataFrame([(3, 3, "D", 2, None)], LOG)
    changes.apply_changes(spark, path, part, "k", "seq", "op", "part", "r9", key_gives_partition=True)
    after = files()
    same = {f for f, i in before.items() if after.get(f) == i}
    assert {f.split("part=")[1][0] for f in same} == set("0124") and 3 not in content(spark, path)


def test_forgotten_deletes_rewrite_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], LOG).schema
    rows = [(k, k % 3, "I", 1, "x") for k in range(9)] + [(0, 0, "D", 2, None), (1, 1, "D", 9, None), (20, 7, "D", 2, None)]
    applied(spark, path, rows, 1)
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    for _ in range(2):
        changes.forget_deletes(spark, path, schema, "op", "part", F.col("seq") < 5, "forget")
    stored = read_table(spark, path, changes.stored_schema(schema, "op"))
    assert {r.k for r in stored.filter(changes.GONE).collect()} == {1}
    assert set(content(spark, path)) == set(range(2, 9))
    kept = {f for f in before if "part=1/" in f or "part=2/" in f}
    assert kept and kept <= files() and not any("part=7" in f for f in files())


@pytest.mark.parametrize("bad", [(1, 1, "X", 1, "a"), (1, 1, None, 1, "a"), (1, 1, "U", None, "a")])
def test_unknown_changes_are_refused(spark, tmp_path, bad):
    path = str(tmp_path / "t")
    applied(spark, path, [(5, 1, "I", 1, "a")], 1)
    with pytest.raises(Exception, match="unknown operation"):
        changes.apply_changes(spark, path, spark.createDataFrame([bad], LOG), "k", "seq", "op", "part", "r9", key_gives_partition=True)
    assert content(spark, path) == {5: (1, "a")}


def test_continues_after_a_failure(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "t"), log_rows(5)
    half = len(rows) // 2
    applied(spark, path, rows[:half], 1)
    part = spark.createDataFrame(rows[half:], LOG)
    apply = lambda: changes.apply_changes(spark, path, part, "k", "seq", "op", "part", "next", key_gives_partition=True)
    move = layout.move_folders

    def half_way(session, source, target):
        names = sorted(n for n in os.listdir(source) if n.startswith("part="))
        for n in names[1:]:
            os.rename(f"{source}/{n}", f"{source}/../{n}")
        move(session, source, target)
        for n in names[1:]:
            os.rename(f"{source}/../{n}", f"{source}/{n}")
        raise OSError("lost")

    monkeypatch.setattr(layout, "move_folders", half_way)
    with pytest.raises(OSError):
        apply()
    monkeypatch.setattr(layout, "move_folders", move)
    apply()
    apply()
    assert content(spark, path) == replay(rows)
