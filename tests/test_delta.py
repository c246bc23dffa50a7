"""Tables with a transaction log, against the rows that the same steps give in plain Python."""

import datetime as dt
import json
import os
import urllib.parse

import pytest

from lodestride.sources import delta, readers

SCHEMA = "user_id long, day date, name string, x double"


def day(n):
    return dt.date(2024, 1, n)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


A = [(1, day(1), "a b", 1.0), (2, day(1), None, None), (3, day(2), "c/d=e", 3.0)]
B = [(4, day(2), "[x]", 4.0), (5, day(3), "é%20", 5.0)]


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_delta_log" not in d)


@pytest.mark.parametrize("partition_by", [(), ("day",), ("name",), ("day", "name")])
def test_append_overwrite_and_delete_give_the_snapshot(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    delta.write_delta(table(spark, A), path, partition_by=partition_by)
    delta.write_delta(table(spark, B), path)
    assert rows_of(delta.read_delta(spark, path)) == sorted(A + B, key=str)
    delta.delete_rows(spark, path, [("user_id", "=", 3)])
    left = [r for r in A + B if r[0] != 3]
    assert rows_of(readers.read_files(spark, path)) == sorted(left, key=str)
    delta.write_delta(table(spark, B), path, "overwrite")
    assert rows_of(delta.read_delta(spark, path)) == sorted(B, key=str)
    # Every version can still be read, for nothing is deleted from disk.
    assert [rows_of(delta.read_delta(spark, path, v)) for v in range(4)] == [sorted(x, key=str) for x in (A, A + B, left, B)]
    with pytest.raises(ValueError, match="version 9"):
        delta.snapshot(spark, path, 9)


def test_checkpoint_replaces_older_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (A, B):
        delta.write_delta(table(spark, rows), path, partition_by=("day",))
    delta.delete_rows(spark, path, [("user_id", "<", 2)])
    assert delta.write_log_checkpoint(spark, path) == 2
    delta.write_delta(table(spark, [(9, day(9), "z", 9.0)]), path)
    for v in range(2):
        os.remove(f"{path}/_delta_log/{v:020d}.json")  # a cleaned log
    want = sorted([r for r in A + B if r[0] >= 2] + [(9, day(9), "z", 9.0)], key=str)
    assert rows_of(delta.read_delta(spark, path)) == want
    with pytest.raises(delta.UnsupportedTable, match="missing"):
        delta.snapshot(spark, path, 1)
    os.remove(f"{path}/_delta_log/{2:020d}.checkpoint.parquet")
    with pytest.raises(delta.UnsupportedTable, match="missing"):
        delta.read_delta(spark, path)


def test_statistics_and_partitions_leave_out_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        delta.write_delta(table(spark, [(i * 10 + k, day(1 + i), f"n{i}", float(i)) for k in range(5)]), path, partition_by=("day",))
    state = delta.snapshot(spark, path)
    count = lambda *w: len(delta.live_files(state, list(w)))
    assert count() == 6 and count(("day", ">=", day(5))) == 2 and count(("user_id", "=", 23)) == 1 and count(("user_id", "<", 10)) == 1
    assert count(("name", "=", "n3")) == 1 and count(("x", ">", 3.5), ("day", "<", day(6))) == 1 and count(("x", "=", 9.0)) == 0
    assert rows_of(delta.read_delta(spark, path, where=[("user_id", ">=", 23), ("x", "<=", 3.0)])) == sorted([(20 + k, day(3), "n2", 2.0) for k in (3, 4)] + [(30 + k, day(4), "n3", 3.0) for k in range(5)], key=str)


def test_merge_rewrites_only_touched_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        delta.write_delta(table(spark, [(i * 10 + k, day(1 + i), "old", float(k)) for k in range(3)]), path, partition_by=("day",))
    before = delta.live_files(delta.snapshot(spark, path))
    updates = spark.createDataFrame([(11, day(2), "new", 7.0), (99, day(2), "new", 8.0), (None, day(2), "null key", 1.0)], SCHEMA)
    delta.merge_rows(updates, path, ["user_id"])
    after = delta.live_files(delta.snapshot(spark, path))
    assert len(set(before) - set(after)) == 1 and all("day=2024-01-02" in f for f in set(before) ^ set(after))
    want = [(i * 10 + k, day(1 + i), "old", float(k)) for i in range(4) for k in range(3) if (i, k) != (1, 1)]
    assert rows_of(delta.read_delta(spark, path)) == sorted([*want, *map(tuple, updates.collect())], key=str)
    # Only matching rows, only one column: the reward merge.
    delta.merge_rows(spark.createDataFrame([(0, -1.0), (500, -2.0)], "user_id long, x double"), path, ["user_id"], insert=False)
    assert rows_of(delta.read_delta(spark, path, where=[("user_id", "<", 2)])) == sorted([(0, day(1), "old", -1.0), (1, day(1), "old", 1.0)], key=str)
    version = delta.snapshot(spark, path).version
    with pytest.raises(ValueError, match="two rows of one user_id"):
        delta.merge_rows(spark.createDataFrame([(1, 1.0), (1, 2.0)], "user_id long, x double"), path, ["user_id"], insert=False)
    assert delta.merge_rows(spark.createDataFrame([], "user_id long, x double"), path, ["user_id"]) == version
    assert delta.merge_rows(spark.createDataFrame([(777, 1.0)], "user_id long, x double"), path, ["user_id"], insert=False) == version


def test_days_are_replaced_in_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(i, day(1 + i % 4), "old", float(i)) for i in range(12)]
    delta.write_delta(table(spark, old), path, partition_by=("day",))
    before = delta.live_files(delta.snapshot(spark, path))
    new = [(100, day(2), "new", 1.0)]
    span = [("day", ">=", day(2)), ("day", "<=", day(3))]
    assert delta.replace_rows(table(spark, new), path, span) == 1
    assert rows_of(delta.read_delta(spark, path)) == sorted([r for r in old if r[1] in (day(1), day(4))] + new, key=str)
    assert sum("day=2024-01-01" in f or "day=2024-01-04" in f for f in set(before) & set(delta.live_files(delta.snapshot(spark, path)))) == 2
    # A condition that cuts through a file keeps the file's other rows.
    delta.replace_rows(table(spark, [(4, day(1), "cut", 0.0)]), path, [("user_id", "=", 4)])
    assert rows_of(delta.read_delta(spark, path, where=[("day", "=", day(1))])) == sorted([(0, day(1), "old", 0.0), (4, day(1), "cut", 0.0), (8, day(1), "old", 8.0)], key=str)
    with pytest.raises(ValueError, match="outside"):
        delta.replace_rows(table(spark, new), path, [("day", "=", day(3))])


def test_a_write_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    delta.write_delta(table(spark, A), path, partition_by=("day",))
    monkeypatch.setattr(delta, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    for write in (lambda: delta.write_delta(table(spark, B), path, "overwrite"), lambda: delta.merge_rows(table(spark, [(1, day(1), "n", 0.0)]), path, ["user_id"]), lambda: delta.delete_rows(spark, path, [("x", ">", 0.0)])):
        with pytest.raises(KeyboardInterrupt):
            write()
        assert rows_of(delta.read_delta(spark, path)) == sorted(A, key=str)
    assert len(files_of(path)) > len(A)  # what they left is there, but no commit names it


def test_a_version_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "t")
    delta.write_delta(table(spark, A), path)
    delta._commit(spark, path, 1, "TEST", [])
    with pytest.raises(delta.ConcurrentWrite):
        delta._commit(spark, path, 1, "TEST", [])
    assert [f for f in sorted(os.listdir(f"{path}/_delta_log")) if not f.endswith(".crc")] == [f"{v:020d}.json" for v in range(2)]
    assert rows_of(delta.read_delta(spark, path)) == sorted(A, key=str)


def test_new_columns_join_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    delta.write_delta(table(spark, A), path)
    delta.write_delta(spark.createDataFrame([(7, 1.5)], "user_id long, reward double"), path)
    got = delta.read_delta(spark, path)
    assert got.columns == ["user_id", "day", "name", "x", "reward"]
    assert rows_of(got) == sorted([(*r, None) for r in A] + [(7, None, None, None, 1.5)], key=str)


def foreign(spark, path, actions):
    """A table as another writer leaves it: names that are only right once decoded, no statistics."""
    table(spark, A).drop("day").write.parquet(f"{path}/day=2024-01-01")
    (name,) = [f for f in files_of(path)]
    relative = urllib.parse.quote(os.path.relpath(name, path))
    os.makedirs(f"{path}/_delta_log")
    schema = json.dumps({"type": "struct", "fields": [{"name": f.name, "type": f.dataType.typeName(), "nullable": True, "metadata": {}} for f in table(spark, A).schema.fields]})
    head = [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}}, {"metaData": {"id": "x", "format": {"provider": "parquet", "options": {}}, "schemaString": schema, "partitionColumns": ["day"], "configuration": {}}}]
    add = {"add": {"path": relative, "partitionValues": {"day": "2024-01-01"}, "size": 1, "modificationTime": 1, "dataChange": True}}
    for v, lines in enumerate([[*head, add], *actions]):
        with open(f"{path}/_delta_log/{v:020d}.json", "w") as f:
            f.write("\n".join(map(json.dumps, lines)))


def test_foreign_table_without_statistics(spark, tmp_path):
    foreign(spark, str(tmp_path), [])
    want = [(i, day(1), n, x) for i, _, n, x in A]
    assert rows_of(delta.read_delta(spark, str(tmp_path), where=[("user_id", ">", 1), ("day", "=", day(1))])) == sorted([r for r in want if r[0] > 1], key=str)


@pytest.mark.parametrize(
    "action",
    [
        {"protocol": {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": ["deletionVectors"], "writerFeatures": ["deletionVectors"]}},
        {"protocol": {"minReaderVersion": 4, "minWriterVersion": 7}},
        {"metaData": {"id": "x", "schemaString": "{\"type\":\"struct\",\"fields\":[]}", "partitionColumns": [], "configuration": {"delta.columnMapping.mode": "name"}}},
        {"add": {"path": "day=2024-01-01/f.parquet", "partitionValues": {"day": "2024-01-01"}, "size": 1, "dataChange": True, "deletionVector": {"storageType": "u"}}},
        {"add": {"path": "f.parquet", "partitionValues": {"day": "2024-01-01"}, "size": 1, "dataChange": True}},
        {"add": {"path": "s3://elsewhere/day=2024-01-01/f.parquet", "partitionValues": {"day": "2024-01-01"}, "size": 1, "dataChange": True}},
    ],
)
def test_what_would_give_wrong_rows_raises(spark, tmp_path, action):
    foreign(spark, str(tmp_path), [[action]])
    with pytest.raises(delta.UnsupportedTable):
        delta.read_delta(spark, str(tmp_path)).collect()


def test_a_path_removed_and_added_again_is_live(spark, tmp_path):
    path = str(tmp_path)
    foreign(spark, path, [])
    (name,) = delta.live_files(delta.snapshot(spark, path))
    add = {"add": {"path": urllib.parse.quote(name), "partitionValues": {"day": "2024-01-01"}, "size": 1, "dataChange": True}}
    delta._commit(spark, path, 1, "X", [delta._remove(name)])
    assert delta.read_delta(spark, path).count() == 0
    delta._commit(spark, path, 2, "X", [add])
    assert delta.read_delta(spark, path).count() == 3
    delta._commit(spark, path, 3, "X", [delta._remove(name), add])
    assert delta.read_delta(spark, path).count() == 3
