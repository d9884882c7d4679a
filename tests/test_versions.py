"""Tables in versions: one whole version at any time, and updates of touched folders alone."""

import os

import pytest
from pyspark.sql import functions as F

from orderlens.sources import versions
from orderlens.sources.versions import Changed, Folder, clean_up, open_table, publish, replace_from_self, update_where


def rows(frame):
    return sorted(map(repr, frame.collect()))


def parted(spark, n, parts=2):
    return spark.range(n).select((F.col("id") % parts).alias("part"), "id")


def files(path):
    return {f"{os.path.relpath(at, path)}/{name}" for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_publish_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(5), path)
    assert publish(spark.range(3), path).count() == 3 == open_table(spark, path).count()
    assert publish(spark.range(0), path).count() == 0 == open_table(spark, path).count()
    assert open_table(spark, path).columns == ["id"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_partitions_come_and_go_whole(spark, setting, tmp_path, mode):
    setting("spark.sql.sources.partitionOverwriteMode", mode)
    path = str(tmp_path / "t")
    stored = publish(parted(spark, 10), path, ["part"])
    assert stored.columns == ["part", "id"] and rows(stored) == rows(parted(spark, 10))
    assert rows(publish(parted(spark, 1), path, ["part"])) == rows(parted(spark, 1))
    # Other partition columns, and none.
    assert rows(publish(parted(spark, 6), path, ["id"])) == rows(parted(spark, 6))
    assert rows(publish(parted(spark, 4), path)) == rows(parted(spark, 4)) == rows(open_table(spark, path))


def test_readers_of_the_version_before_end_in_peace(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish(spark.range(5), path)
    publish(spark.range(3), path)
    assert first.count() == 5 and len(files(path)) > 0
    publish(spark.range(2), path)
    assert open_table(spark, path).count() == 2
    versions_left = {f.split("/")[0] for f in files(path)}
    assert len(versions_left) == 2


STEPS = ["query", "_add", "write_pointer", "current", "swap", "clean_up"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("write", ["publish", "replace", "update"])
def test_a_stop_at_any_step_leaves_one_whole_version(spark, tmp_path, monkeypatch, step, write):
    path = str(tmp_path / "t")
    publish(parted(spark, 10), path, ["part"])
    before = rows(open_table(spark, path))
    bad = F.when(F.col("id") >= 0, F.raise_error(F.lit("no")).cast("bigint")) if step == "query" else F.col("id") * 100

    def stop(*_, **__):
        raise KeyboardInterrupt

    if step == "_add":
        # The rows are written and the process ends.
        real = versions._add
        monkeypatch.setattr(versions, "_add", lambda *a: (real(*a), stop()))
    elif step == "current":
        monkeypatch.setattr(Folder, "swap", lambda self, name: stop())
    elif step in ("write_pointer", "swap"):
        real = getattr(Folder, step)
        monkeypatch.setattr(Folder, step, lambda *a: (real(*a), stop()))
    elif step == "clean_up":
        monkeypatch.setattr(versions, "clean_up", stop)

    def run():
        if write == "publish":
            publish(parted(spark, 10).withColumn("id", bad), path, ["part"])
        elif write == "replace":
            replace_from_self(spark, path, lambda t: t.withColumn("id", bad))
        else:
            update_where(spark, path, F.col("part") == 1, {"id": bad})

    with pytest.raises(BaseException):
        run()
    monkeypatch.undo()
    after = rows(open_table(spark, path))
    changed = rows(parted(spark, 10).withColumn(
        "id", F.when((F.col("part") == 1) | F.lit(write != "update"), F.col("id") * 100).otherwise(F.col("id"))))
    assert after == (changed if step in ("swap", "clean_up") else before)
    # Whatever was left over, the next write goes through and cleans up in time.
    publish(parted(spark, 4), path, ["part"])
    assert rows(open_table(spark, path)) == rows(parted(spark, 4))
    clean_up(spark, path, grace=-1.0)
    kept = Folder(spark, path).current()
    assert {f.rsplit("/", 1)[0] for f in files(path)} == {*kept.folders, *kept.replaced}
    assert [n for n in os.listdir(path) if n.startswith("_current")] == ["_current"]


def test_replace_from_self(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(parted(spark, 4), path, ["part"])
    for _ in range(2):
        replace_from_self(spark, path, lambda t: t.union(t))
    assert open_table(spark, path).count() == 16 and Folder(spark, path).current().partition_by == ("part",)


def test_a_plain_folder_becomes_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert open_table(spark, path).count() == 4
    replace_from_self(spark, path, lambda t: t.union(t))
    assert open_table(spark, path).count() == 8
    clean_up(spark, path, grace=-1.0)
    assert open_table(spark, path).count() == 8 and all(f.startswith("version_=") for f in files(path))


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(4), path)

    def meanwhile(table):
        publish(spark.range(7), path)
        return table

    with pytest.raises(Changed):
        replace_from_self(spark, path, meanwhile)
    assert open_table(spark, path).count() == 7


ODD_PARTS = ["plain", "with space", "a/b", "50%", "x=y", "colon:x", "é", "{a}", "?*", "%41", None]


def test_update_leaves_other_folders_as_they_are(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(p, n, n * 10) for p in ODD_PARTS for n in range(3)]
    frame = spark.createDataFrame(data, "part string, n int, v int")
    publish(frame, path, ["part"])
    before = files(path)
    assert rows(open_table(spark, path)) == rows(frame)
    hit = F.col("part").isin("a/b", "50%", "%41", "x=y") | F.col("part").isNull()
    added = update_where(spark, path, hit & (F.col("n") == 1), {"v": F.col("n") + F.col("v"), "n": F.lit(7)})
    assert len(added) == 5
    wanted = [(p, 7, 11) if n == 1 and p in ("a/b", "50%", "%41", "x=y", None) else (p, n, v) for p, n, v in data]
    assert rows(open_table(spark, path)) == rows(spark.createDataFrame(wanted, frame.schema))
    # Files of untouched folders keep their names, and are all that is read of them.
    now = {os.path.relpath(f.removeprefix("file:"), path) for f in open_table(spark, path).inputFiles()}
    assert len(now) >= 11 and len(files(path) & before) == len(before)
    assert update_where(spark, path, F.col("n") == 99, {"v": F.lit(0)}) == []
    assert update_where(spark, path, F.lit(None).cast("boolean"), {"v": F.lit(0)}) == []
    with pytest.raises(ValueError):
        update_where(spark, path, F.lit(True), {"part": F.lit("p")})


def test_update_of_a_table_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(5), path)
    assert len(update_where(spark, path, F.col("id") > 2, {"id": -F.col("id")})) == 1
    assert rows(open_table(spark, path)) == rows(spark.createDataFrame([(0,), (1,), (2,), (-3,), (-4,)], "id long"))


def test_finding_touched_folders_reads_the_condition_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(9).select((F.col("id") % 3).alias("part"), "id", F.lit("x" * 99).alias("wide")), path, ["part"])
    table = open_table(spark, path)
    plan = table.filter(F.col("id") == 4).select(F.input_file_name())._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan and "PushedFilters: [IsNotNull(id), EqualTo(id,4)]" in plan
