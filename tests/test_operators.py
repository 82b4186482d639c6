"""Numbering, latest state, phase history, snapshots: against plain Python."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from lexweave.config.model import ConfigError
from lexweave.operators import latest, numbering, phases, snapshots
from lexweave.plans.history import PhaseHistory
from lexweave.sinks import store
from lexweave.sources import records
from pyspark.sql import functions as F


@pytest.mark.parametrize("fan, depth, n", [(2, 1, 500), (3, 3, 700), (8, 2, 50), (8, 3, 1500), (8, 1, 0)])
def test_numbers_are_dense_and_ordered(spark, fan, depth, n, monkeypatch):
    monkeypatch.setattr(numbering, "FAN_OUT", fan)
    keys = random.Random(1).sample(range(10_000), n)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = rows(numbering.number_in_order(df, "k", "n", depth))
    assert sorted(got) == [(k, i) for i, k in enumerate(sorted(keys))]


def test_ranges_follow_the_rows(spark, monkeypatch):
    assert [numbering.depth_for(n) for n in (0, 10**6, 10**6 + 1, 10**9, 10**10)] == [0, 0, 1, 4, 5]
    keys = random.Random(2).sample(range(10_000), 300)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    for most in (1_000, 50, 5):
        monkeypatch.setattr(numbering, "RANGE_ROWS", most)
        got = rows(numbering.number_in_order(df, "k", "n"))
        assert sorted(got) == [(k, i) for i, k in enumerate(sorted(keys))]


def test_key_map_keeps_numbers_and_stays_dense(spark, scratch, monkeypatch):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 7)
    rng = random.Random(4)
    keys, known = numbering.KeyMap(scratch(), "w", "n"), {}
    for number in range(4):
        words = [rng.choice("abcdefgh") * rng.randint(1, 8) for _ in range(rng.choice([0, 15, 40]))] + [None]
        df = spark.createDataFrame([(w, 1) for w in words], "w string, other int")
        got = dict(rows(keys.load(df)))
        new = sorted({w for w in words if w is not None and w not in known})
        known |= {w: len(known) + i for i, w in enumerate(new)}
        assert got == known
    assert dict(rows(keys.load(df, number=3))) == known
    # A load that died after its first write is done again.
    spark.sql("SELECT 'zz' w").write.parquet(f"{keys.path}/new/load=4")
    assert dict(rows(keys.load(spark.sql("SELECT 'yy' w")))) == known | {"yy": len(known)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(min_size=1, max_size=4), min_size=1, max_size=40))
def test_numbers_of_any_text(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {w: n for w, n in rows(numbering.number_in_order(df, "w", "n", 2))}
    order = sorted(words, key=lambda w: w.encode("utf-8", "surrogatepass"))
    assert got == {w: i for i, w in enumerate(order)}


def test_ranges_are_ordered_and_balanced(spark):
    df = spark.range(100_000).select((F.col("id") * F.col("id")).alias("k"))
    sizes = numbering.with_range(df, "k", "b", 2).groupBy("b").agg(
        F.count("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
    ).orderBy("b").collect()
    assert [r.b for r in sizes] == list(range(64))
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))
    assert max(r.n for r in sizes) < 4 * 100_000 / 64


def test_hashed_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "w string")
    keyed = numbering.hashed_key(df, "w", "k")
    assert len({r.k for r in keyed.collect()}) == 2
    assert numbering.key_collisions(keyed, "w", "k").count() == 0
    forged = spark.createDataFrame([("a", 1), ("b", 1)], "w string, k long")
    assert numbering.key_collisions(forged, "w", "k").count() == 1


def test_latest_row_with_ties_nulls_and_a_hot_key(spark):
    rng = random.Random(2)
    data = [
        (0 if rng.random() < 0.5 else rng.randrange(20), rng.choice([None, *range(5)]), i, f"v{i}")
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "k int, ts int, arrival int, v string").repartition(7)
    best = {}
    for row in data:
        order = (-1 if row[1] is None else row[1], row[2])
        if row[0] not in best or order > best[row[0]][0]:
            best[row[0]] = (order, row)
    got = rows(latest.latest_per_key(df, ["k"], ["ts", "arrival"]))
    assert got == sorted((r for _, r in best.values()), key=repr)


def test_group_replace_with_emptied_groups(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "g int, v string")
    new = spark.createDataFrame([(1, "x")], "g int, v string")
    assert rows(latest.replace_groups(old, new, ["g"])) == [(1, "x"), (2, "c"), (3, "d")]
    asked = spark.createDataFrame([(1,), (3,)], "g int")
    assert rows(latest.replace_groups(old, new, ["g"], asked)) == [(1, "x"), (2, "c")]


def test_deleted_then_created_again_survives(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "item_id string")
    events = spark.createDataFrame(
        [("a", "Deleted", 2, 1), ("b", "Deleted", 1, 2), ("b", "Created", 2, 3),
         ("c", "Created", 1, 5), ("c", "Deleted", 1, 6)],
        "item_id string, event_name string, ts int, arrival int",
    )
    assert rows(latest.without_deleted(items, events, ["item_id"], ["ts", "arrival"])) == [("b",)]


def test_bounds_are_off_by_default(spark):
    df = spark.range(10)
    assert latest.bounded(df, "id").count() == 10
    assert rows(latest.bounded(df, "id", 6, 3)) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("width", [1, 10, 1000, 10**9])
def test_phase_history_of_a_hot_project(spark, width):
    rng = random.Random(width)
    log = {
        (1 if rng.random() < 0.6 else rng.randrange(2, 6), rng.randrange(3000), f"p{rng.randrange(3)}")
        for _ in range(300)
    }
    df = spark.createDataFrame(list(log), "project_id int, event_ts long, phase string").repartition(5)
    expected, by_project = [], defaultdict(list)
    for project, ts, phase in log:
        by_project[project].append((ts, phase))
    for project, changes in by_project.items():
        changes.sort()
        for i, (ts, phase) in enumerate(changes):
            before = changes[i - 1][1] if i else None
            after = changes[i + 1][0] if i + 1 < len(changes) else None
            days = None if after is None else (after - ts) // phases.DAY_MILLIS
            expected.append((project, ts, phase, before, after, days, after is None))
    assert rows(phases.phase_history(df, width, ["project_id"])) == sorted(expected, key=repr)


def test_projects_of_two_tenants_are_kept_apart(spark):
    log = spark.createDataFrame([(1, 5, 10, "a"), (2, 5, 20, "b")],
                                "org_id int, project_id int, event_ts long, phase string")
    assert rows(phases.current_phase(log)) == [(1, 5, "a", 10), (2, 5, "b", 20)]
    assert {r.previous_phase for r in phases.phase_history(log).collect()} == {None}


def test_first_lead_stays_in_the_first_status(spark):
    statuses = spark.createDataFrame([(1, "New"), (2, "Open"), (3, "Shut")], "Id int, Status string")
    leads = spark.createDataFrame(
        [(9, "Open", None), (4, "Open", None), (5, "Shut", 7)], "Id int, Status string, ContactId int"
    )
    assert snapshots.first_lead(statuses, leads).first().Id == 4
    # The first status with leads has no contact, and later ones are not searched.
    assert snapshots.first_lead(statuses, leads, "ContactId").count() == 0


def test_first_with_items_skips_empty_projects(spark):
    projects = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "projectId int, projectTypeId int")
    items = spark.createDataFrame([(3, 1), (2, 8), (2, 7)], "projectId int, id int")
    assert rows(snapshots.first_with_items(projects, items, 5, ["projectId", "id"])) == [(2, 7)]


def test_snapshot_dispatch(spark, tables):
    frames = {
        "contact": tables["contact"], "project": tables["project"], "meds": tables["meds"],
        "intake": tables["intake"],
    }
    assert snapshots.snapshot(frames, "case", "core", "contact").first().personId == 0
    assert snapshots.snapshot(frames, "case", "core", "Project", 2).first().projectTypeId == 2
    form = snapshots.snapshot(frames, "case", "form", "intake", 3).first()
    typed = tables["project"].where("projectTypeId = 3").selectExpr("min(projectId) AS p").first()
    assert form.projectId == typed.p
    assert snapshots.snapshot(frames, "case", "collections", "meds", 1).count() == 1
    with pytest.raises(ConfigError):
        snapshots.snapshot(frames, "lead", "core", "unheard")


def test_history_by_loads_equals_the_whole_and_writes_neighbours_only(spark, scratch):
    rng = random.Random(8)
    history = PhaseHistory(scratch(), buckets=2)
    changes, schema = [], "org_id long, project_id long, event_ts long, phase string"
    pool = [(o, p, rng.randint(0, 10**10), rng.choice("abc")) for o in (1, 2) for p in range(6) for _ in range(30)]
    rng.shuffle(pool)
    for number, start in enumerate(range(0, 360, 120)):
        # Every load repeats some changes of the one before.
        part = pool[max(0, start - 10) : start + 120]
        history.load(spark.createDataFrame(part, schema))
        changes += part
        whole = phases.phase_history(spark.createDataFrame(sorted(set(changes)), schema))
        assert rows(history.read(spark).select(*whole.columns)) == rows(whole)
        if number == 1:
            assert history.compact(spark) > 0
            assert rows(history.read(spark).select(*whole.columns)) == rows(whole)
    (late,) = [(1, 0, 5, "late")]
    history.load(spark.createDataFrame([late], schema))
    last = store.loads(spark, history.path)[-1]
    assert spark.read.parquet(last).count() <= 3
    assert history.read(spark).where("phase = 'late'").first()["previous_phase"] is None


@pytest.mark.parametrize("fields", [[], ["kind"], ["kind", "Note", "projectId", "kind"]])
def test_sections_of_projects(spark, fields):
    rng = random.Random(7)
    listed = [(rng.choice([1, 2, 3, 9, None]), rng.choice(["a", "b", None]), "p") for _ in range(12)]
    items = [(1 if rng.random() < 0.4 else rng.choice([2, 4, 9, None]), rng.randrange(5), "s") for _ in range(60)]
    projects = spark.createDataFrame(listed, "projectId long, kind string, note string")
    sections = spark.createDataFrame(items, "projectId long, item long, note string")
    found = records.sections_of(projects, sections, fields)
    kinds = defaultdict(list)
    for key, kind, _ in listed:
        kinds[key].append(kind)
    # A null kind comes first, as in Spark's order; the records' own note stays.
    least = {k: min(v, key=lambda x: (x is not None, x or "")) for k, v in kinds.items()}
    extra = (lambda k: (least[k],)) if fields else (lambda k: ())
    assert rows(found) == sorted(((*extra(r[0]), *r) for r in items if r[0] is not None and r[0] in least), key=repr)
    assert found.columns == [*(["kind"] if fields else []), "projectId", "item", "note"]


def test_sections_of_no_project(spark):
    none = spark.createDataFrame([], "projectId long, kind string")
    assert records.sections_of(none, spark.createDataFrame([(1, 2)], "projectId long, item long"), ["kind"]).collect() == []
