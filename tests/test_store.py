"""Writers of the raw store, and what restarts and late rows do to it."""

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexweave.sinks import store
from lexweave.sinks import tables as sinks
from lexweave.sources import files

KEY = ["org", "id"]


def frame(spark, *data):
    return spark.createDataFrame(list(data), "org int, id int, ts int, v string")


def state(spark, path):
    return rows(sinks.read_current(spark, path).select("org", "id", "ts", "v"))


def test_upsert_is_idempotent_and_ignores_late_rows(spark, scratch):
    path = scratch()
    first = frame(spark, (1, 1, 5, "a"), (1, 2, 5, "b"), (2, 1, 5, "c"))
    second = frame(spark, (1, 1, 6, "A"), (1, 2, 4, "late"), (1, 3, 1, "new"))
    expected = [(1, 1, 6, "A"), (1, 2, 5, "b"), (1, 3, 1, "new"), (2, 1, 5, "c")]
    sinks.upsert(first, path, KEY, ["ts", "v"], ["org"], 4)
    for _ in range(2):
        sinks.upsert(second, path, KEY, ["ts", "v"], ["org"], 4)
        assert state(spark, path) == expected


def files_of(path, part=""):
    """Parquet files of a store with their sizes."""
    found = Path(path).rglob("*.parquet")
    return {str(f): f.stat().st_size for f in found if part in str(f)}


def test_upsert_and_compaction_leave_untouched_partitions_alone(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a"), (2, 1, 1, "b")), path, KEY, ["ts"], ["org"], 2)
    assert sinks.compact(spark, path) == 2
    before = files_of(path)
    assert any("org=2" in f for f in before)
    sinks.upsert(frame(spark, (1, 1, 2, "x")), path, KEY, ["ts"], ["org"], 2)
    assert sinks.compact(spark, path) == 1
    after = files_of(path)
    assert before.items() <= after.items()
    assert {f for f in after if "org=2" in f} == {f for f in before if "org=2" in f}
    assert state(spark, path) == [(1, 1, 2, "x"), (2, 1, 1, "b")]


def test_a_batch_writes_in_proportion_to_itself(spark, scratch):
    path = scratch()
    wide = spark.range(200_000).selectExpr("cast(id % 5 AS int) org", "cast(id AS int) id", "1 ts", "uuid() v")
    sinks.upsert(wide, path, KEY, ["ts"], ["org"], 8)
    sinks.compact(spark, path)
    before = files_of(path)
    sinks.upsert(wide.limit(1000).withColumn("ts", F.lit(2)), path, KEY, ["ts"], ["org"], 8)
    written = sum(n for f, n in files_of(path).items() if f not in before)
    assert written < sum(before.values()) / 50
    # So few rows outgrow no bucket; nothing is written for them.
    assert sinks.compact(spark, path) == 0
    assert sinks.read_current(spark, path).where("ts = 2").count() == 1000
    assert sinks.read_current(spark, path).count() == 200_000

    path = scratch()
    groups = wide.select("org", F.col("id").alias("project"), "v")
    sinks.replace_sections(groups, path, ["project"], groups, ["org"], 8)
    sinks.compact(spark, path)
    before = files_of(path)
    some = groups.where("project < 1000")
    sinks.replace_sections(some.where("project >= 10"), path, ["project"], some, ["org"], 8)
    assert sum(n for f, n in files_of(path).items() if f not in before) < sum(before.values()) / 50
    assert sinks.read_current(spark, path).count() == 200_000 - 10


@pytest.mark.parametrize("declared", [False, True])
def test_upserts_compactions_and_tombstones_against_a_dictionary(spark, scratch, declared):
    rng = random.Random(7 + declared)
    path, known = scratch(), {}
    schema = frame(spark).schema if declared else None
    for step in range(7):
        data = {
            (rng.choice([1, 2, None]), rng.randint(1, 12)): (rng.randint(1, 9) * 100 + step, rng.choice(["a", "b", "gone"]))
            for _ in range(rng.randint(0, 8))
        }
        rows_ = [(*key, *value) for key, value in data.items()]
        sinks.upsert(frame(spark, *rows_), path, KEY, ["ts"], ["org"], 2, schema, gone=F.col("v") == "gone")
        for key, value in data.items():
            if value[0] >= known.get(key, (0,))[0]:
                known[key] = value
        if rng.random() < 0.5:
            sinks.compact(spark, path, schema, outgrown=rng.choice([0.0, 0.5, 5.0]), buckets=rng.choice([None, None, 3, 5]))
            if rng.random() < 0.5:
                sinks.vacuum(spark, path, schema)
        buckets = store.read_layout(spark, path).buckets
        if buckets != 2:
            sinks.compact(spark, path, schema, buckets=2)
        expected = [(*k, *v) for k, v in known.items() if v[1] != "gone"]
        out = sinks.read_current(spark, path, schema).select("org", "id", "ts", "v")
        assert rows(out) == sorted(expected, key=repr), step


def test_sections_and_compactions_against_a_dictionary(spark, scratch):
    rng = random.Random(9)
    path, known = scratch(), {}
    schema = "org int, project int, v string"
    for step in range(8):
        groups = {(rng.choice([1, 2]), rng.randint(1, 6)) for _ in range(rng.randint(1, 4))}
        items = [(*g, f"{step}-{i}") for g in groups for i in range(rng.choice([0, 0, 1, 3]))]
        sinks.replace_sections(
            spark.createDataFrame(items, schema), path, ["project"],
            spark.createDataFrame(list(groups), "org int, project int"), ["org"], 2)
        for g in groups:
            known[g] = [i for i in items if i[:2] == g]
        if step % 3 == 1:
            sinks.compact(spark, path, outgrown=rng.choice([0.0, 0.7]))
        if step % 4 == 3:
            sinks.vacuum(spark, path)
        expected = sorted((i for items in known.values() for i in items), key=repr)
        assert rows(sinks.read_current(spark, path).select("org", "project", "v")) == expected, step


def test_half_a_write_is_not_read(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a"), (1, 2, 1, "b")), path, KEY, ["ts"], ["org"], 2)
    sinks.compact(spark, path)
    sinks.upsert(frame(spark, (1, 1, 2, "x")), path, KEY, ["ts"], ["org"], 2)
    whole = state(spark, path)
    sinks.upsert(frame(spark, (1, 2, 2, "y"), (1, 3, 2, "z")), path, KEY, ["ts"], ["org"], 2)
    sinks.compact(spark, path)
    # What a writer that died before its commit leaves behind.
    for folder in (store.loads(spark, path)[-1], store.runs(spark, path)[0].path):
        Path(folder.removeprefix("file:"), "_SUCCESS").unlink()
    assert state(spark, path) == whole
    sinks.upsert(frame(spark, (1, 2, 2, "y")), path, KEY, ["ts"], ["org"], 2)
    sinks.compact(spark, path)
    assert state(spark, path) == [(1, 1, 2, "x"), (1, 2, 2, "y")]


def test_tombstones_outlive_late_rows_and_end(spark, scratch):
    path = scratch()

    def load(number, *data):
        df = frame(spark, *data)
        sinks.upsert(df, path, KEY, ["ts"], ["org"], 1, gone=F.col("v") == "gone", load=number)

    load(1, (1, 1, 5, "gone"), (1, 2, 5, "b"))
    sinks.compact(spark, path, keep_gone=100)
    load(50, (1, 1, 4, "late"))
    sinks.compact(spark, path, outgrown=0.0, keep_gone=100)
    assert state(spark, path) == [(1, 2, 5, "b")]
    load(200, (1, 3, 1, "c"))
    sinks.compact(spark, path, outgrown=0.0, keep_gone=100)
    assert store.view(spark, path).base.where("_state = 'gone'").isEmpty()
    load(201, (1, 1, 6, "again"))
    assert state(spark, path) == [(1, 1, 6, "again"), (1, 2, 5, "b"), (1, 3, 1, "c")]


def test_vacuum_keeps_what_is_read(spark, scratch):
    path = scratch()
    for number in range(1, 5):
        sinks.upsert(frame(spark, (1, number, 1, "a"), (2, 1, number, "b")), path, KEY, ["ts"], ["org"], 1, load=number)
    assert sinks.vacuum(spark, path) == 0
    sinks.compact(spark, path)
    sinks.upsert(frame(spark, (1, 9, 1, "z")), path, KEY, ["ts"], ["org"], 1, load=5)
    expected = state(spark, path)
    assert sinks.vacuum(spark, path) == 4
    assert [store.load_number(p) for p in store.loads(spark, path)] == [5]
    assert state(spark, path) == expected


def test_other_keys_are_refused(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a")), path, KEY, ["ts"], ["org"], 4)
    with pytest.raises(ValueError, match="other keys"):
        sinks.upsert(frame(spark, (1, 1, 1, "a")), path, KEY, ["v"], ["org"], 4)
    with pytest.raises(TypeError, match="name columns"):
        sinks.upsert(frame(spark, (1, 1, 1, "a")), scratch(), KEY, [F.col("ts")], ["org"], 4)


def test_upsert_with_a_null_partition_value(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (None, 1, 1, "a"), (None, 2, 1, "b")), path, KEY, ["ts"], ["org"], 1)
    sinks.upsert(frame(spark, (None, 1, 2, "x")), path, KEY, ["ts"], ["org"], 1)
    assert state(spark, path) == [(None, 1, 2, "x"), (None, 2, 1, "b")]


def test_upsert_of_many_partitions(spark, scratch):
    path = scratch()
    many = frame(spark, *[(1, i, 1, "a") for i in range(40)])
    sinks.upsert(many, path, KEY, ["ts"], ["org"], 8)
    sinks.upsert(many.withColumns({"ts": F.lit(2), "v": F.lit("b")}), path, KEY, ["ts"], ["org"], 8)
    assert state(spark, path) == sorted([(1, i, 2, "b") for i in range(40)], key=repr)


def test_upsert_key_must_hold_the_partition(spark, scratch):
    with pytest.raises(ValueError, match="part of the key"):
        sinks.upsert(frame(spark, (1, 1, 1, "a")), scratch(), ["id"], ["ts"], ["org"])


def test_new_columns_appear_on_upsert(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a"), (1, 2, 1, "b")), path, KEY, ["ts"], ["org"], 1)
    wide = frame(spark, (1, 2, 2, "c")).withColumn("extra", F.lit("e"))
    sinks.upsert(wide, path, KEY, ["ts"], ["org"], 1)
    out = sinks.read_current(spark, path).select("id", "v", "extra")
    assert rows(out) == [(1, "a", None), (2, "c", "e")]


def test_a_column_only_some_files_have_survives(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a"), (1, 2, 1, "b")), path, KEY, ["ts"], ["org"], 4)
    wide = frame(spark, (1, 1, 2, "c"), (2, 1, 1, "d")).withColumn("extra", F.lit("e"))
    sinks.upsert(wide, path, KEY, ["ts"], ["org"], 4)
    sinks.upsert(frame(spark, (1, 2, 2, "x"), (2, 9, 1, "y")), path, KEY, ["ts"], ["org"], 4)
    out = sinks.read_current(spark, path).select("org", "id", "v", "extra")
    assert rows(out) == [(1, 1, "c", "e"), (1, 2, "x", None), (2, 1, "d", "e"), (2, 9, "y", None)]


def test_upsert_with_a_declared_schema(spark, scratch):
    path = scratch()
    first = frame(spark, (1, 1, 1, "a"), (2, 1, 1, "b"))
    for df in (first, frame(spark, (1, 1, 2, "x"))):
        sinks.upsert(df, path, KEY, ["ts"], ["org"], 4, schema=first.schema)
    assert state(spark, path) == [(1, 1, 2, "x"), (2, 1, 1, "b")]
    declared = sinks.read_current(spark, path, first.schema)
    assert rows(declared.select("org", "id", "ts", "v")) == state(spark, path)


@pytest.mark.parametrize("declared", [False, True])
def test_text_tenants_that_look_like_numbers(spark, scratch, declared):
    path = scratch()
    first = spark.createDataFrame([("007", 1, 1, "a"), ("7", 1, 1, "b")],
                                  "org string, id int, ts int, v string")
    schema = first.schema if declared else None
    sinks.upsert(first, path, KEY, ["ts"], ["org"], 2, schema)
    sinks.upsert(first.where("org = '007'").withColumns({"ts": F.lit(2), "v": F.lit("x")}),
                 path, KEY, ["ts"], ["org"], 2, schema)
    out = sinks.read_current(spark, path, first.schema).select("org", "id", "v")
    assert rows(out) == [("007", 1, "x"), ("7", 1, "b")]

    path = scratch()
    groups = first.select("org", "id").distinct()
    sinks.replace_sections(first, path, ["id"], groups, ["org"], 2, schema)
    sinks.replace_sections(first.limit(0), path, ["id"], groups.where("org = '007'"), ["org"], 2, schema)
    out = sinks.read_current(spark, path, first.schema).select("org", "id", "v")
    assert rows(out) == [("7", 1, "b")]


def test_compaction_scans_only_outgrown_partitions(spark, scratch):
    path = scratch()
    many = frame(spark, *[(o, i, 1, "a") for o in range(5) for i in range(5)])
    sinks.upsert(many, path, KEY, ["ts"], ["org"], 2)
    sinks.compact(spark, path)
    sinks.upsert(frame(spark, (3, 1, 2, "x")), path, KEY, ["ts"], ["org"], 2)
    now = store.view(spark, path)
    (touched,) = store._outgrown(now, store.OUTGROWN)
    assert touched["org"] == 3
    plan = now.only([touched]).merged()._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(org" in plan and "(org#" in plan


def test_reading_does_not_shuffle_stored_rows(spark, scratch):
    """Few deltas are sent to the stored rows, which stay where they are."""
    path = scratch()
    sinks.upsert(spark.range(1000).selectExpr("1 org", "cast(id AS int) id", "1 ts", "'a' v"), path, KEY, ["ts"], ["org"], 4)
    sinks.compact(spark, path)
    sinks.upsert(frame(spark, (1, 1, 2, "x")), path, KEY, ["ts"], ["org"], 4)
    df = sinks.read_current(spark, path)
    assert df.count() == 1000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, scratch):
    for name in ("left_cases", "right_cases"):
        sinks.warehouse_write(spark.range(100).withColumnRenamed("id", "k"), name, scratch(), "k", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_cases").join(spark.table("right_cases"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_section_replace_empties_groups_and_partitions(spark, scratch):
    path = scratch()
    items = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "c"), (2, 20, "d")],
                                  "org int, project int, v string")
    groups = items.select("org", "project").distinct()

    def load(new, asked):
        sinks.replace_sections(new, path, ["project"], asked, ["org"], 2)
        return rows(sinks.read_current(spark, path).select("project", "v"))

    assert load(items, groups) == [(10, "a"), (10, "b"), (11, "c"), (20, "d")]
    assert load(items.where("v = 'b'"), groups.where("project = 10")) == [(10, "b"), (11, "c"), (20, "d")]
    # The whole partition of tenant 2 is emptied, and filled again later.
    assert load(items.limit(0), groups.where("org = 2")) == [(10, "b"), (11, "c")]
    assert load(items.where("org = 2"), groups.where("org = 2")) == [(10, "b"), (11, "c"), (20, "d")]


def test_sections_of_other_tenants_with_the_same_project_stay(spark, scratch):
    """Both tenants are touched, but project 1 only of the first."""
    path = scratch()
    items = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (2, 2, "c")], "org int, project int, v string")
    groups = items.select("org", "project")
    sinks.replace_sections(items, path, ["project"], groups, ["org"], 1)
    asked = groups.where("org = 1 OR project = 2")
    sinks.replace_sections(items.where("v = 'c'"), path, ["project"], asked, ["org"], 1)
    assert rows(sinks.read_current(spark, path).select("org", "project", "v")) == [(2, 1, "b"), (2, 2, "c")]


def test_a_batch_written_twice_is_there_once(spark, scratch):
    path = scratch()
    for _ in range(2):
        sinks.append_batch(spark.range(3), path, 7)
    assert spark.read.parquet(path).count() == 3
    # A new run numbers its batches anew and leaves the former run's.
    sinks.append_batch(spark.range(2), path, 7, "other")
    assert spark.read.parquet(path).count() == 5


def test_another_bucket_count_is_refused(spark, scratch):
    path = scratch()
    sinks.upsert(frame(spark, (1, 1, 1, "a")), path, KEY, ["ts"], ["org"], 4)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        sinks.upsert(frame(spark, (1, 1, 2, "b")), path, KEY, ["ts"], ["org"], 8)
    assert state(spark, path) == [(1, 1, 1, "a")]


def test_a_group_in_a_partition_that_was_not_asked_for(spark, scratch):
    """Rows of a group that comes along unasked replace it and leave its neighbours."""
    path = scratch()
    items = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 2, "d")],
                                  "org int, project int, v string")
    groups = items.select("org", "project")
    sinks.replace_sections(items, path, ["project"], groups, ["org"], 1)
    new = spark.createDataFrame([(2, 1, "x")], items.schema)
    sinks.replace_sections(new, path, ["project"], groups.where("org = 1 AND project = 1"), ["org"], 1)
    out = sinks.read_current(spark, path).select("org", "project", "v")
    assert rows(out) == [(1, 2, "b"), (2, 1, "x"), (2, 2, "d")]


def test_rebuild_from_the_log(spark, scratch):
    log, path = scratch(), scratch()
    sinks.append_batch(frame(spark, (1, 1, 1, "a"), (1, 2, 1, "b")), log, 0)
    sinks.append_batch(frame(spark, (1, 1, 2, "x")), log, 1)
    sinks.rebuild(spark, log, path, KEY, ["ts"], ["org"], 2)
    assert state(spark, path) == [(1, 1, 2, "x"), (1, 2, 1, "b")]


def test_export(spark, scratch):
    path, df = scratch(), spark.range(0, 100, 1, 4)
    sinks.export(df, path, files=1)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    sinks.export(df, path)
    assert len(spark.read.parquet(path).inputFiles()) == 4
    assert spark.read.parquet(path).count() == 100


def test_missing_store_is_none(spark, scratch):
    assert files.read_if_present(spark, scratch()) is None


def test_conflicting_types_need_a_declared_schema(spark, scratch):
    root = scratch()
    spark.sql("SELECT 1L a").write.parquet(f"{root}/x/1.parquet")
    spark.sql("SELECT 'n/a' a").write.parquet(f"{root}/y/1.parquet")
    frames = [files.read_folder(spark, f"{root}/{d}/1.parquet") for d in "xy"]
    assert rows(files.union_as(frames, {"a": "bigint", "b": "date"})) == [(1, None), (None, None)]


def test_files_of_many_types_lose_no_row(spark, scratch):
    """Forty files, types in no order: few groups, every value in the widest type."""
    rng = random.Random(6)
    root = scratch()
    kinds = {"a": ["int", "bigint", "smallint"], "b": ["int", "double", "float"], "c": ["string", "bigint", "date"],
             "d": ["struct<x:int>", "string"], "e": ["date", "timestamp"], "f": ["boolean"]}
    expected = []
    for number in range(40):
        chosen = {c: rng.choice(k) for c, k in kinds.items() if rng.random() < 0.8}
        values = {"a": number, "b": number * 2, "c": "2024-01-31" if chosen.get("c") == "date" else number,
                  "e": "2024-01-31", "f": "true"}
        columns = [f"named_struct('x', {number}) d" if (c, k) == ("d", "struct<x:int>") else
                   f"CAST('{values.get(c, 'text')}' AS {k}) {c}" for c, k in chosen.items()]
        spark.sql(f"SELECT {', '.join([f'{number} n', *columns])}").coalesce(1).write.parquet(f"{root}/{number}/x.parquet")
        expected.append((
            number, number if "a" in chosen else None, number * 2.0 if "b" in chosen else None,
            str(values["c"]) if "c" in chosen else None,
            None if "d" not in chosen else '{"x":%d}' % number if chosen["d"] != "string" else "text",
            datetime.datetime(2024, 1, 31) if "e" in chosen else None, True if "f" in chosen else None))
    df = files.read_merged(spark, f"{root}/*/x.parquet").select("n", *kinds)
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "int", "bigint", "double", "string", "string", "timestamp", "boolean"]
    assert rows(df) == sorted(expected, key=repr)


def test_mixed_files_keep_folder_columns(spark, scratch):
    root = scratch()
    spark.sql("SELECT 1L a").write.parquet(f"{root}/org=7")
    spark.sql("SELECT 'n/a' a").write.parquet(f"{root}/org=8")
    assert rows(files.read_merged(spark, root).select("org", "a")) == [(7, "1"), (8, "n/a")]


def test_path_keys_of_written_files(spark, scratch):
    root = f"{scratch()}/cms"
    spark.range(2).write.parquet(f"{root}/6/18/77/form/intake.parquet")
    df = files.read_merged(spark, f"{root}/6/*/*/form/intake.parquet")
    # Spark's own folder level stands between the name and the part files here.
    path = F.regexp_replace(files.file_path(), r"/part-[^/]*$", "")
    keys = df.select(*[c.alias(n) for n, c in files.case_path_keys(path).items()]).distinct()
    assert rows(keys) == [("6", 18, 77, "form", "intake", None)]
