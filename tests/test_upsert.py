import re
import shutil

import pytest

from conftest import plan_of

from lakemart.operators import upsert as upserts
from lakemart.operators.quality import QualityError
from lakemart.operators.upsert import merged, recover, upsert
from lakemart.sources.tables import exists, read_table, table_exists

COLUMNS = "id string, seq int, v int, day string"
PARTS = ["day"]
FIRST = [("a", 1, 10, "01"), ("a", 2, 20, "01"), ("b", None, 30, "02"), ("c", 1, 40, "03")]
# a/1 stays, a/2 moves to another day, b/null is updated, d is new, c is untouched.
SECOND = [("a", 2, 21, "04"), ("b", None, 31, "02"), ("d", 1, 50, "01")]
AFTER = [
    ("a", 1, 10, "01"), ("a", 2, 21, "04"), ("b", None, 31, "02"), ("c", 1, 40, "03"), ("d", 1, 50, "01")
]


@pytest.fixture
def frame(spark):
    return lambda data: spark.createDataFrame(data, COLUMNS)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "lake" / "table")


def put(spark, path, df, **options):
    upsert(spark, path, df, ["id", "seq"], partitions=PARTS, **options)


def content(spark, path, rows):
    return rows(read_table(spark, path, PARTS), "id", "seq", "v", "day")


def test_merged_matches_nulls(frame, rows):
    assert rows(merged(frame(FIRST), frame(SECOND), ["id", "seq"])) == sorted(AFTER, key=repr)


def test_create_update_and_repeat(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    assert content(spark, path, rows) == sorted(FIRST, key=repr)
    for _ in range(2):
        put(spark, path, frame(SECOND))
        assert content(spark, path, rows) == sorted(AFTER, key=repr)
        assert not exists(spark, f"{path}__staging")


def test_untouched_partitions_keep_their_files(spark, path, frame):
    put(spark, path, frame(FIRST))

    def files():
        return {f for f in read_table(spark, path, PARTS).inputFiles() if "day=03" in f}

    before = files()
    put(spark, path, frame(SECOND))
    assert files() == before


def test_partition_left_empty_disappears(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    put(spark, path, frame([("c", 1, 41, "01")]))
    assert not exists(spark, f"{path}/day=03")
    assert ("c", 1, 41, "01") in content(spark, path, rows)


def test_empty_source_leaves_the_table_alone(spark, path, frame, rows):
    put(spark, path, frame([]))
    assert not table_exists(spark, path)
    put(spark, path, frame(FIRST))
    put(spark, path, frame([]))
    assert content(spark, path, rows) == sorted(FIRST, key=repr)


def test_replaced_keys_drop_rows_the_source_no_longer_has(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    gone = spark.createDataFrame([("a",), ("c",), ("a",)], "id string")
    put(spark, path, frame([("a", 2, 22, "01")]), replaced=gone, replaced_keys=["id"])
    assert content(spark, path, rows) == sorted([("a", 2, 22, "01"), ("b", None, 30, "02")], key=repr)
    put(spark, path, frame([]), replaced=gone, replaced_keys=["id"])
    assert content(spark, path, rows) == [("b", None, 30, "02")]


def test_replaced_keys_without_a_frame(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    put(spark, path, frame([("a", 3, 9, "02"), ("a", 4, 9, "02")]), replaced_keys=["id"])
    assert [row[:2] for row in content(spark, path, rows)] == [("a", 3), ("a", 4), ("b", None), ("c", 1)]


def test_key_that_fixes_its_partition(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    same_day = [("a", 2, 21, "01"), ("d", 1, 50, "01")]
    put(spark, path, frame(same_day), key_fixes_partition=True)
    expected = [FIRST[0], *same_day, *FIRST[2:]]
    assert content(spark, path, rows) == sorted(expected, key=repr)


def test_newer_rows_of_the_table_stay(spark, path, frame, rows):
    put(spark, path, frame(FIRST), newest_by="v")
    older_and_newer = [("a", 1, 9, "02"), ("b", None, 29, "02"), ("c", 1, 41, "03"), ("d", 1, 1, "01")]
    put(spark, path, frame(older_and_newer), newest_by="v")
    assert content(spark, path, rows) == sorted(
        [FIRST[0], FIRST[1], FIRST[2], ("c", 1, 41, "03"), ("d", 1, 1, "01")], key=repr
    )
    put(spark, path, frame([("a", 1, 9, "02")]), newest_by="v")
    assert FIRST[0] in content(spark, path, rows)


def test_null_partition(spark, path, frame, rows):
    put(spark, path, frame([("a", 1, 1, None), ("b", 1, 2, "01")]))
    put(spark, path, frame([("a", 1, 5, None), ("c", 1, 3, None)]))
    put(spark, path, frame([("a", 1, 6, "01")]))
    assert content(spark, path, rows) == sorted(
        [("a", 1, 6, "01"), ("b", 1, 2, "01"), ("c", 1, 3, None)], key=repr
    )


def test_nested_key(spark, path):
    ddl = "id string, item struct<sequence: int, n: int>, day string"
    keys = ["id", "item.sequence"]
    first = spark.createDataFrame([("a", (1, 10), "01"), ("a", (2, 20), "01")], ddl)
    upsert(spark, path, first, keys, partitions=PARTS)
    second = spark.createDataFrame([("a", (2, 21), "02")], ddl)
    upsert(spark, path, second, keys, partitions=PARTS)
    found = {(r.item.sequence, r.item.n, r.day) for r in read_table(spark, path, PARTS).collect()}
    assert found == {(1, 10, "01"), (2, 21, "02")}


def test_ambiguous_or_differing_source_is_refused(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    with pytest.raises(QualityError, match="not unique"):
        put(spark, path, frame([SECOND[0], SECOND[0]]))
    put(spark, path, frame([]))
    assert content(spark, path, rows) == sorted(FIRST, key=repr)
    with pytest.raises(ValueError, match="plain word"):
        put(spark, path, frame([("a", 1, 1, "0/1")]))


class Stop(Exception):
    pass


STEPS = ("delete", "save", "finish", "drop")


def stop_at(monkeypatch, call, torn=False):
    """Let `call` file operations work, then stop; torn: with half of a record on disk. Returns
    the names of the operations as they come."""
    count, names = [0], []

    def wrap(name):
        real = getattr(upserts._Run, name)

        def step(self, *args):
            names.append(name)
            if count[0] == call:
                if torn and name == "save":
                    upserts.write_file(self.spark, args[0], '{"create": fal')
                raise Stop
            count[0] += 1
            return real(self, *args)

        monkeypatch.setattr(upserts._Run, name, step)

    for name in STEPS:
        wrap(name)
    real_write = upserts.write_table

    def write(df, path, *args, **options):
        names.append("write")
        if count[0] == call:
            raise Stop
        count[0] += 1
        real_write(df, path, *args, **options)
        if count[0] == call:
            raise Stop

    monkeypatch.setattr(upserts, "write_table", write)
    return names


def small(frame):
    """One partition, as these tests run very many small jobs."""
    return lambda data: frame(data).coalesce(1)


def put_stopped(spark, path, df, monkeypatch, call, torn=False):
    """True if the run was stopped, False if it had fewer steps."""
    with monkeypatch.context() as patch:
        stop_at(patch, call, torn)
        try:
            put(spark, path, df)
        except Stop:
            return True
    return False


def test_a_run_that_stops_at_any_file_operation_is_made_good(spark, tmp_path, frame, rows, monkeypatch):
    frame = small(frame)
    made = str(tmp_path / "made")
    put(spark, made, frame(FIRST))
    shutil.copytree(made, tmp_path / "whole")
    with monkeypatch.context() as patch:
        steps = stop_at(patch, -1)
        put(spark, str(tmp_path / "whole"), frame(SECOND))
    assert steps.count("save") == 2 and "write" in steps and len(steps) > 8
    for call, name in enumerate(steps):
        for torn in (False, True) if name == "save" else (False,):
            path = str(tmp_path / f"table{call}-{torn}")
            shutil.copytree(made, path)
            put_stopped(spark, path, frame(SECOND), monkeypatch, call, torn)
            recover(spark, path)
            assert not exists(spark, f"{path}__staging")
            assert content(spark, path, rows) in (sorted(FIRST, key=repr), sorted(AFTER, key=repr))
            put(spark, path, frame(SECOND))
            assert content(spark, path, rows) == sorted(AFTER, key=repr)


def test_creation_that_stops_at_any_file_operation_is_made_good(spark, tmp_path, frame, rows, monkeypatch):
    frame = small(frame)
    for call in range(40):
        path = str(tmp_path / f"table{call}")
        stopped = put_stopped(spark, path, frame(FIRST), monkeypatch, call)
        put(spark, path, frame(FIRST))
        assert content(spark, path, rows) == sorted(FIRST, key=repr)
        if not stopped:
            break
    assert 2 < call < 39


def test_a_recovery_that_stops_is_taken_up(spark, tmp_path, frame, rows, monkeypatch):
    frame = small(frame)
    made = str(tmp_path / "made")
    put(spark, made, frame(FIRST))
    for first in (2, 4):
        for call in range(12):
            path = str(tmp_path / f"table{first}-{call}")
            shutil.copytree(made, path)
            put_stopped(spark, path, frame(SECOND), monkeypatch, first)
            with monkeypatch.context() as patch:
                stop_at(patch, call)
                try:
                    recover(spark, path)
                    stopped = False
                except Stop:
                    stopped = True
            recover(spark, path)
            assert content(spark, path, rows) in (sorted(FIRST, key=repr), sorted(AFTER, key=repr))
            if not stopped:
                break


def test_the_record_names_only_files_of_touched_partitions(spark, path, frame, monkeypatch):
    put(spark, path, frame(FIRST))
    with monkeypatch.context() as patch:
        stop_at(patch, 1)
        with pytest.raises(Stop):
            put(spark, path, frame([("c", 1, 41, "01")]))
    record = upserts._Run(spark, path).load(f"{path}__staging/begun.json")
    assert sorted(record["old"]) == ["day=01", "day=03"] and not record["create"]
    recover(spark, path)


def test_a_table_may_gain_a_column_and_a_source_may_lack_one(spark, path, frame, rows):
    put(spark, path, frame(FIRST))
    put(spark, path, spark.createDataFrame([("a", 2, "new", 21, "04")], "id string, seq int, extra string, v int, day string"))
    put(spark, path, frame([("d", 1, 50, "01")]))
    found = rows(read_table(spark, path, PARTS), "id", "seq", "v", "extra", "day")
    assert ("a", 2, 21, "new", "04") in found and ("c", 1, 40, None, "03") in found
    assert len(found) == 5
    with pytest.raises(QualityError, match="types"):
        put(spark, path, spark.createDataFrame([("a", 2, "21", "04")], "id string, seq int, v string, day string"))


def test_candidates_prune_the_search(spark, path, frame, rows, conf):
    put(spark, path, frame(FIRST))
    days = spark.createDataFrame([("01",), ("02",), ("09",)], "day string")
    put(spark, path, frame(SECOND), candidates=days)
    assert content(spark, path, rows) == sorted(AFTER, key=repr)
    searched = read_table(spark, path, PARTS).where(upserts.partition_folder(PARTS).isin(["day=01"]))
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan_of(searched))
