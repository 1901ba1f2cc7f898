"""Tables of bucket folders: what a load reads and writes, and what a failing one leaves."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tamiz.sinks import folders
from tamiz.sinks.folders import (
    current_commit,
    digest,
    drop_unused,
    insert_absent_folders,
    read_changes,
    read_folders,
    upsert_folders,
)

KINDS = "k int, j string, v double, note string"


def made(spark, rows, kinds=KINDS):
    return spark.createDataFrame(rows, kinds)


def content(spark, path, *columns):
    return sorted(read_folders(spark, path).select(*columns or ["*"]).collect(), key=str)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)}


@pytest.fixture
def many(spark):
    return made(spark, [(k, f"j{k}", k / 2, None) for k in range(500)])


def test_identical_delivery_writes_nothing(spark, tmp_path, many):
    path = str(tmp_path / "t")
    assert upsert_folders(path, many, ["k", "j"], 16, logged=True) == 1
    before = files(path)
    assert upsert_folders(path, many.orderBy(F.desc("v")), ["k", "j"], 16, logged=True) == 1
    # A part of it has another digest, so its rows are compared; they do not differ.
    assert upsert_folders(path, many.filter("k < 20"), ["k", "j"], 16, logged=True) == 1
    assert files(path) == before


def test_one_cell_rewrites_one_bucket(spark, tmp_path, many):
    path = str(tmp_path / "t")
    upsert_folders(path, many, ["k"], 16, logged=True)
    old = current_commit(spark, path)
    change = many.withColumn("note", F.when(F.col("k") == 7, "seen"))
    assert upsert_folders(path, change, ["k"], 16, logged=True) == 2
    new = current_commit(spark, path)
    moved = [b for b in new.folders if new.folders[b] != old.folders[b]]
    assert len(moved) == 1 and new.folders[moved[0]].versions == [2]
    assert content(spark, path) == sorted(change.collect(), key=str)
    log = read_changes(spark, path).filter("version = 2").collect()
    assert [(r.operacion, r.k) for r in log] == [("UPDATE", 7)]
    assert read_changes(spark, path).count() == 501


def test_only_touched_buckets_are_read(spark, tmp_path, many, monkeypatch):
    path, read = str(tmp_path / "t"), []
    upsert_folders(path, many, ["k"], 16)
    plain = folders._rows

    def noted(session, where, commit, only):
        read.extend(folders.folder_paths(where, commit, only))
        return plain(session, where, commit, only)

    monkeypatch.setattr(folders, "_rows", noted)
    upsert_folders(path, many, ["k"], 16)
    assert not read
    upsert_folders(path, many.filter("k = 7").withColumn("v", F.lit(0.5)), ["k"], 16)
    assert len(set(read)) == 1


def test_digests_follow_the_content(spark, tmp_path, many):
    path = str(tmp_path / "t")
    upsert_folders(path, many, ["k"], 4)
    upsert_folders(path, many.filter("k < 300").withColumn("v", F.col("v") + 1), ["k"], 4)
    upsert_folders(path, made(spark, [(-1, None, None, "x")]), ["k"], 4)
    for bucket, held in current_commit(spark, path).folders.items():
        rows = read_folders(spark, path, [bucket])
        row = rows.agg(F.count(F.lit(1)).alias("n"), *digest([F.col(c) for c in rows.columns])).first()
        assert (row.n, [int(row["_d0"]), int(row["_d1"])]) == (held.rows, held.content)


def test_content_is_recognised_after_other_deliveries(spark, tmp_path, many):
    path = str(tmp_path / "t")
    upsert_folders(path, many, ["k"], 4)
    upsert_folders(path, many.withColumn("v", F.lit(1.0)), ["k"], 4)
    assert upsert_folders(path, many, ["k"], 4) == 3
    assert content(spark, path) == sorted(many.collect(), key=str)


def test_null_keys_are_one_key(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, value in enumerate([1.0, 2.0, 2.0]):
        rows = made(spark, [(None, "a", value, None), (1, None, value, None), (None, None, value, None)])
        upsert_folders(path, rows, ["k", "j"], 8)
        assert read_folders(spark, path).count() == 3, n
    assert [r.v for r in content(spark, path, "v")] == [2.0, 2.0, 2.0]
    quarantine = str(tmp_path / "q")
    for _ in range(3):
        insert_absent_folders(quarantine, rows, ["k", "j"], 8)
    assert read_folders(spark, quarantine).count() == 3


def test_insert_absent_keeps_old_folders(spark, tmp_path, many):
    path = str(tmp_path / "t")
    insert_absent_folders(path, many.filter("k < 400"), ["k"], 4)
    before = files(f"{path}/data")
    insert_absent_folders(path, many.withColumn("v", F.lit(-1.0)), ["k"], 4)
    assert before.items() <= files(f"{path}/data").items()
    assert all(held.versions == [1, 2] for held in current_commit(spark, path).folders.values())
    got = {r.k: r.v for r in content(spark, path)}
    assert got == {k: k / 2 if k < 400 else -1.0 for k in range(500)}
    # What was inserted or ignored is no upsert: the same delivery still overwrites.
    upsert_folders(path, many.withColumn("v", F.lit(-1.0)), ["k"], 4)
    assert {r.v for r in content(spark, path)} == {-1.0}


def test_buckets_of_many_folders_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(folders, "MOST_FOLDERS", 3)
    path = str(tmp_path / "t")
    for k in range(8):
        upsert_folders(path, made(spark, [(k, "a", 1.0, None)]), ["k"], 1)
    assert len(current_commit(spark, path).folders[0].versions) <= 3
    assert read_folders(spark, path).count() == 8
    assert drop_unused(spark, path) > 0
    assert read_folders(spark, path).count() == 8


def test_missing_and_refreshed_columns(spark, tmp_path):
    path, day = str(tmp_path / "t"), F.lit("2024-01-01")
    upsert_folders(path, made(spark, [(1, "a", 1.0, "kept"), (2, "b", 2.0, "kept")]), ["k"], 4, {"day": day})
    part = made(spark, [(1, "a", 1.0), (2, "b", 3.0), (3, "c", 4.0)], "k int, j string, v double")
    upsert_folders(path, part, ["k"], 4, {"day": F.lit("2024-02-02")})
    assert [tuple(r) for r in content(spark, path)] == [
        (1, "a", 1.0, "kept", "2024-01-01"),
        (2, "b", 3.0, "kept", "2024-02-02"),
        (3, "c", 4.0, None, "2024-02-02"),
    ]


def broken(rows, column="v"):
    """Rows whose writing fails in one task."""
    bomb = F.when(F.col("k") == 333, F.raise_error(F.lit("lost"))).otherwise(F.lit(9.0))
    return rows.withColumn(column, bomb.cast("double"))


def test_failing_load_leaves_content_and_log(spark, tmp_path, many, monkeypatch):
    path = str(tmp_path / "t")
    upsert_folders(path, many, ["k"], 8, logged=True)
    before, log = content(spark, path), read_changes(spark, path).count()
    with pytest.raises(Exception, match="lost"):
        upsert_folders(path, broken(many), ["k"], 8, logged=True)
    assert content(spark, path) == before and read_changes(spark, path).count() == log
    change = many.withColumn("v", F.col("v") * 2)
    # Killed after writing rows and log, before the commit; then repeated.
    with monkeypatch.context() as patched:
        patched.setattr(folders, "_publish", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            upsert_folders(path, change, ["k"], 8, logged=True)
    assert content(spark, path) == before and read_changes(spark, path).count() == log
    assert upsert_folders(path, change, ["k"], 8, logged=True) == 2
    assert content(spark, path) == sorted(change.collect(), key=str)
    assert read_changes(spark, path).filter("version = 2").count() == 499  # 0 * 2 is 0


def test_what_does_not_fit_is_refused(spark, tmp_path, many):
    path = str(tmp_path / "t")
    upsert_folders(path, many, ["k"], 8)
    for rows, keys, buckets in [
        (many, ["k"], 16),
        (many, ["j"], 8),
        (many.withColumn("k", F.col("k").cast("long")), ["k"], 8),
        (many.withColumn("more", F.lit(1)), ["k"], 8),
        (many.union(many), ["k"], 8),
    ]:
        with pytest.raises(ValueError):
            upsert_folders(path, rows, keys, buckets)


def test_empty_delivery(spark, tmp_path, many):
    path = str(tmp_path / "t")
    assert read_folders(spark, path) is None and read_changes(spark, path) is None
    assert upsert_folders(path, many.limit(0), ["k"], 8) == 1
    assert read_folders(spark, path).count() == 0
    upsert_folders(path, many, ["k"], 8)
    assert upsert_folders(path, many.limit(0), ["k"], 8) == 2
    assert read_folders(spark, path).count() == 500
