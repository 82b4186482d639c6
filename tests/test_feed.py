"""The change feed as a stream: equal to the batch, safe to restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexweave.operators.latest import without_deleted
from lexweave.sinks.tables import read_current, read_phase_log, rebuild_sections
from lexweave.streaming import events as ev
from lexweave.streaming import feed

PHASE = {"Timestamp": 1654733926323, "Object": "Project", "Event": "PhaseChanged",
         "ObjectId": {"ProjectTypeId": 18, "PhaseId": 17}, "OrgId": 6, "ProjectId": 10,
         "UserId": 4, "Other": {"PhaseName": "Demand"}}
FORM = {"Timestamp": 1654741352640, "Object": "Form", "Event": "Updated",
        "ObjectId": {"ProjectTypeId": 18, "SectionSelector": "intake"}, "OrgId": 6,
        "ProjectId": 11, "UserId": 4, "Other": {}}
PROJECT = {"Timestamp": 1654741352641, "Object": "Project", "Event": "Updated",
           "ObjectId": {"ProjectId": 12}, "OrgId": 6, "ProjectId": 99, "UserId": None, "Other": {}}
ITEM = {"Timestamp": 1654741352642, "Object": "CollectionItem", "Event": "Created",
        "ObjectId": {"ProjectTypeId": 18, "SectionSelector": "meds", "ItemId": "a-1"}, "OrgId": 6,
        "ProjectId": 13, "UserId": 4, "Other": {}}


def land(folder, name, *payloads):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps(p) + "\n" for p in payloads)


def batch(spark, *payloads):
    text = spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string")
    return ev.parse_events(text)


def finish(query):
    query.awaitTermination()
    query.stop()


def test_normalise(spark):
    out = ev.normalise(batch(spark, PHASE, FORM, PROJECT, ITEM))
    got = rows(out.select("entity", "event_name", "project_type_id", "project_id", "section", "org_id"))
    assert got == sorted([
        ("Project", "PhaseChanged", 18, 10, None, 6),
        ("Form", "Updated", 18, 11, "intake", 6),
        ("Project", "Updated", None, 12, "core", 6),
        ("CollectionItem", "Created", 18, 13, "meds", 6),
    ], key=repr)
    body = json.loads(out.where("project_id = 10").first().webhook_body)
    assert body["Other"]["PhaseName"] == "Demand" and body["UserId"] == 4


def test_routing_ignores_other_entities(spark):
    other = {**FORM, "Object": "Invoice"}
    normal = ev.normalise(batch(spark, PHASE, FORM, PROJECT, ITEM, other))
    assert sorted(r.route for r in ev.routed(normal).collect()) == [
        "collections", "form", "phases", "project"
    ]


def test_subscription(spark):
    events = batch(spark, {**FORM, "Event": "Deleted"}, {**ITEM, "Event": "Deleted"}, PROJECT)
    assert sorted(r.Event for r in ev.subscribed(events).collect()) == ["Deleted", "Updated"]


def test_the_same_phase_change_twice_is_one_row(spark):
    assert ev.phase_log(ev.normalise(batch(spark, PHASE, PHASE))).count() == 1


def test_late_event_loses(spark):
    events = ev.normalise(batch(spark, {**FORM, "Timestamp": 5, "Event": "Created"}, FORM))
    numbered = events.withColumn("n", F.when(F.col("event_timestamp") == 5, 2).otherwise(1))
    assert [r.event_name for r in ev.latest_events(numbered, "n").collect()] == ["Updated"]


def test_project_type_from_the_project_of_the_same_tenant(spark):
    events = ev.normalise(batch(spark, PROJECT, FORM))
    projects = spark.createDataFrame([(12, 1, 6), (12, 2, 7), (11, 3, 6)],
                                     "projectId long, projectTypeId long, orgId long")
    out = ev.with_project_type(events, projects).select("project_id", "project_type_id")
    assert rows(out) == [(11, 18), (12, 1)]
    assert ev.with_project_type(events, projects.drop("orgId").where("projectTypeId = 2")).where(
        "project_id = 12").first().project_type_id == 2


def test_lead_routing_quarantines_unknown_events(spark):
    df = spark.createDataFrame(
        [("Lead Edited", 1, None, None), ("Contact Added", None, 2, None),
         ("Opportunity Created", None, None, 3), ("Lead Merged", 4, None, None)],
        ev.LEAD_EVENT_SCHEMA,
    )
    got = rows(ev.route_leads(df).select("entity", "record_id"))
    assert got == [("contact", 2), ("leaddetail", 1), ("opportunities", 3), ("quarantine", None)]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tables, scratch):
    landing, out, mark = scratch("landing"), scratch("out"), scratch("mark")
    whole = tables.webhook().drop("arrival")
    whole.repartition(3).write.json(landing)
    for _ in range(2):
        finish(feed.stream_phases(ev.read_events(spark, landing), out, mark))
    expected = ev.phase_log(ev.normalise(ev.subscribed(whole)))
    assert rows(spark.read.parquet(out).select(*expected.columns)) == rows(expected)


def test_repeats_and_very_late_changes(spark, scratch):
    """A repeat in a later batch is merged when read; a change years late is kept."""
    landing, out, mark = scratch("landing"), scratch("out"), scratch("mark")
    late = {**PHASE, "Timestamp": 1000, "Other": {"PhaseName": "Old"}}
    for name, payloads in (("b0", [PHASE]), ("b1", [PHASE, FORM]), ("b2", [late])):
        land(landing, name, *payloads)
        finish(feed.stream_phases(ev.read_events(spark, landing, max_files=1), out, mark))
    log = read_phase_log(spark, out).select("event_ts", "phase")
    assert rows(log) == [(1000, "Old"), (PHASE["Timestamp"], "Demand")]


def test_bounded_lateness_drops_repeats_in_the_stream(spark, scratch):
    landing, out, mark = scratch("landing"), scratch("out"), scratch("mark")
    for name in ("b0", "b1"):
        land(landing, name, PHASE)
        finish(feed.stream_phases(ev.read_events(spark, landing), out, mark, "1 day"))
    assert spark.read.parquet(out).count() == 1


def collection(spark, source):
    """Landed items of both projects, read again for every batch."""
    return lambda _, keys: spark.read.json(source, schema=(
        "org_id bigint, project_type_id bigint, project_id bigint, section string, id bigint, v string"
    ))


def item(project, number, value):
    return {"org_id": 6, "project_type_id": 18, "project_id": project, "section": "meds",
            "id": number, "v": value}


@pytest.mark.parametrize("newest_first", [False, True])
def test_feed_in_any_order(spark, scratch, newest_first):
    """Phases and refreshed sections do not depend on the order files arrive in."""
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    land(landed, "meds", item(13, 1, "a"), item(13, 2, "b"), item(14, 1, "c"))
    runner = feed.CaseFeed(root, {"collections": collection(spark, landed)})
    batches = [
        [PHASE, ITEM],
        [{**PHASE, "Timestamp": PHASE["Timestamp"] + 9, "Other": {"PhaseName": "Trial"}},
         {**ITEM, "ProjectId": 14}, FORM],
    ]
    for number, payloads in enumerate(reversed(batches) if newest_first else batches):
        land(landing, f"b{number}", *payloads)
        finish(runner.start(ev.read_events(spark, landing), mark))
    phases = read_phase_log(spark, f"{root}/phases").select("project_id", "phase")
    assert rows(phases) == [(10, "Demand"), (10, "Trial")]
    items = read_current(spark, f"{root}/collections/current").select("project_id", "id", "v")
    assert rows(items) == [(13, 1, "a"), (13, 2, "b"), (14, 1, "c")]


def test_feed_drops_items_gone_from_the_source(spark, scratch):
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    runner = feed.CaseFeed(root, {"collections": collection(spark, landed)})

    def step(name, items, *events):
        land(landed, "meds", *items)
        land(landing, name, *events)
        finish(runner.start(ev.read_events(spark, landing), mark))
        df = read_current(spark, f"{root}/collections/current").select("project_id", "id")
        return rows(df)

    other = {**ITEM, "ProjectId": 14}
    gone = {**ITEM, "Event": "Deleted"}
    both = [item(13, 1, "a"), item(13, 2, "b"), item(14, 1, "c")]
    assert step("b0", both, ITEM, other) == [(13, 1), (13, 2), (14, 1)]
    assert step("b1", both[1:], gone) == [(13, 2), (14, 1)]
    # The last item goes as well: the project's section is empty now.
    assert step("b2", both[2:], gone) == [(14, 1)]

    store, again = f"{root}/collections", scratch("again")
    rebuild_sections(
        spark, f"{store}/log", f"{store}/refreshed", again, ["project_id", "section"],
        feed.PARTITIONS, 4,
    )
    assert rows(read_current(spark, again).select("project_id", "id")) == [(14, 1)]


def test_a_batch_that_died_half_way_runs_again(spark, scratch, monkeypatch):
    """The phases and the log are written, the merge is not: the restart completes all of it."""
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    land(landed, "meds", item(13, 1, "a"), item(13, 2, "b"))
    land(landing, "b0", PHASE, ITEM)
    runner = feed.CaseFeed(root, {"collections": collection(spark, landed)})

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(feed, "replace_sections", fail)
        with pytest.raises(Exception, match="lost"):
            finish(runner.start(ev.read_events(spark, landing), mark))
    assert spark.read.parquet(f"{root}/phases").count() == 1
    finish(runner.start(ev.read_events(spark, landing), mark))
    assert spark.read.parquet(f"{root}/phases").count() == 1
    assert spark.read.parquet(f"{root}/collections/log").count() == 2
    state = read_current(spark, f"{root}/collections/current")
    assert rows(state.select("project_id", "id")) == [(13, 1), (13, 2)]


def test_feed_refreshes_forms_by_key(spark, scratch):
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    schema = ("org_id bigint, project_type_id bigint, project_id bigint, section string, fee string")
    runner = feed.CaseFeed(root, {"form": lambda _, keys: spark.read.json(landed, schema=schema)})

    def form(project, fee):
        return {"org_id": 6, "project_type_id": 18, "project_id": project, "section": "intake",
                "fee": fee}

    land(landed, "f", form(11, "1"), form(12, "1"))
    land(landing, "b0", FORM, {**FORM, "ProjectId": 12})
    finish(runner.start(ev.read_events(spark, landing), mark))
    land(landed, "f", form(11, "2"), form(12, "2"))
    land(landing, "b1", {**FORM, "Timestamp": FORM["Timestamp"] + 1})
    finish(runner.start(ev.read_events(spark, landing), mark))
    out = read_current(spark, f"{root}/form/current").select("project_id", "fee")
    assert rows(out) == [(11, "2"), (12, "1")]
    # A late event loads the record as it is now, which is newer all the same.
    land(landed, "f", form(11, "3"), form(12, "3"))
    land(landing, "b2", {**FORM, "Timestamp": 5})
    finish(runner.start(ev.read_events(spark, landing), mark))
    out = read_current(spark, f"{root}/form/current").select("project_id", "fee")
    assert rows(out) == [(11, "3"), (12, "1")]


def test_lead_feed(spark, scratch):
    root, mark, landing = scratch("root"), scratch("mark"), scratch("landing")
    land(landing, "b0", {"EventType": "Lead Edited", "LeadId": 1}, {"EventType": "Odd", "LeadId": 2})
    finish(feed.LeadFeed(root).start(ev.read_events(spark, landing, ev.LEAD_EVENT_SCHEMA), mark))
    assert rows(spark.read.parquet(f"{root}/refresh").drop("run", "batch_id")) == [("leaddetail", 1)]
    assert spark.read.parquet(f"{root}/quarantine").first().EventType == "Odd"


def test_current_phase_stream_with_late_files(spark, scratch):
    out, mark, landing = scratch("out"), scratch("mark"), scratch("landing")
    late = {**PHASE, "Timestamp": 1, "Other": {"PhaseName": "Old"}}
    for name, payload in (("b0", PHASE), ("b1", late)):
        land(landing, name, payload)
        finish(feed.stream_current_phase(ev.read_events(spark, landing), out, mark))
    state = read_current(spark, out).select("project_id", "current_phase", "since_ts")
    assert rows(state) == [(10, "Demand", PHASE["Timestamp"])]


@pytest.mark.parametrize("event_type", [None, 7, 18])
def test_events_without_the_records_type_lose_nothing(spark, scratch, event_type):
    """The stored type is the record's; other projects of the bucket stay."""
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    items = [item(p, n, "a") for p in range(20) for n in (1, 2)]
    land(landed, "meds", *items)
    runner = feed.CaseFeed(root, {"collections": collection(spark, landed)}, buckets=1)
    land(landing, "b0", *[{**ITEM, "ProjectId": p} for p in range(20)])
    finish(runner.start(ev.read_events(spark, landing), mark))
    land(landed, "meds", *items[1:])
    odd = {**ITEM, "ObjectId": {**ITEM["ObjectId"], "ProjectTypeId": event_type}, "ProjectId": 0}
    land(landing, "b1", odd)
    finish(runner.start(ev.read_events(spark, landing), mark))
    out = read_current(spark, f"{root}/collections/current").select("project_id", "id", "project_type_id")
    assert rows(out) == sorted(((p, n, 18) for p in range(20) for n in (1, 2) if (p, n) != (0, 1)), key=repr)


def test_a_project_that_changes_its_type_is_there_once(spark, scratch):
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    schema = "org_id bigint, project_type_id bigint, project_id bigint, section string, fee string"
    runner = feed.CaseFeed(root, {
        "form": lambda _, keys: spark.read.json(landed, schema=schema),
        "collections": collection(spark, f"{landed}-items"),
    })
    for number, kind in enumerate((18, 19)):
        land(landed, "f", {"org_id": 6, "project_type_id": kind, "project_id": 11, "section": "intake", "fee": "1"})
        land(f"{landed}-items", "i", {**item(11, 1, "a"), "project_type_id": kind})
        land(landing, f"b{number}", {**FORM, "Timestamp": number}, {**ITEM, "ProjectId": 11, "Timestamp": number})
        finish(runner.start(ev.read_events(spark, landing), mark))
    for name in ("form", "collections"):
        out = read_current(spark, f"{root}/{name}/current").select("project_id", "project_type_id")
        assert rows(out) == [(11, 19)], name


def test_a_new_checkpoint_keeps_the_newest_state_and_all_logs(spark, scratch):
    root, landing, landed = scratch("root"), scratch("landing"), scratch("landed")
    schema = "org_id bigint, project_type_id bigint, project_id bigint, section string, fee string"
    runner = feed.CaseFeed(root, {"form": lambda _, keys: spark.read.json(landed, schema=schema)})
    for number, fee in enumerate(("first", "second")):
        land(landed, "f", {"org_id": 6, "project_type_id": 18, "project_id": 11, "section": "intake", "fee": fee})
        land(landing, f"b{number}", {**FORM, "Timestamp": number}, {**PHASE, "Timestamp": number})
        finish(runner.start(ev.read_events(spark, landing), scratch("mark")))
    assert [r.fee for r in read_current(spark, f"{root}/form/current").collect()] == ["second"]
    assert sorted(r.fee for r in spark.read.parquet(f"{root}/form/log").collect()) == ["first", "second"]


def test_phase_events_without_a_type_take_the_projects(spark, scratch):
    root, mark, landing = scratch("root"), scratch("mark"), scratch("landing")
    land(landing, "b0", {**PHASE, "ObjectId": {"PhaseId": 17}})
    projects = spark.createDataFrame([(10, 5, 6)], "projectId long, projectTypeId long, orgId long")
    runner = feed.CaseFeed(root, projects=lambda _: projects)
    finish(runner.start(ev.read_events(spark, landing), mark))
    assert rows(read_phase_log(spark, f"{root}/phases").select("project_id", "project_type_id")) == [(10, 5)]


def test_a_loader_may_read_only_the_keys_of_the_batch(spark, scratch):
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    land(landed, "meds", item(13, 1, "a"), item(14, 1, "b"))
    asked = []

    def load(_, keys):
        asked.append(rows(keys))
        return collection(spark, landed)(_, keys).join(keys, ["org_id", "project_id", "section"], "left_semi")

    land(landing, "b0", ITEM)
    finish(feed.CaseFeed(root, {"collections": load}).start(ev.read_events(spark, landing), mark))
    assert asked == [[(6, 13, "meds")]]
    assert rows(read_current(spark, f"{root}/collections/current").select("project_id", "v")) == [(13, "a")]


def test_deletes_stay_within_their_project(spark):
    items = spark.createDataFrame([(6, 1, "meds", "a"), (6, 2, "meds", "a")],
                                  "org_id long, project_id long, section string, item_id string")
    events = items.where("project_id = 1").withColumns({"event_name": F.lit("Deleted"), "t": F.lit(1)})
    assert rows(without_deleted(items, events, items.columns, ["t"])) == [(6, 2, "meds", "a")]


@pytest.mark.parametrize("together", [False, True])
def test_a_delete_hides_its_item_whatever_comes_later(spark, scratch, together):
    """Deleted arrives before the older Created; the landed section still holds the item."""
    root, mark, landing, landed = (scratch(n) for n in ("root", "mark", "landing", "landed"))
    land(landed, "meds", item(13, 1, "a"), item(13, 2, "b"), item(14, 1, "c"))
    runner = feed.CaseFeed(root, {"collections": collection(spark, landed)}, buckets=2)

    def event(name, at, project=13, number="1"):
        return {**ITEM, "Event": name, "Timestamp": at, "ProjectId": project,
                "ObjectId": {**ITEM["ObjectId"], "ItemId": number}}

    steps = [[event("Deleted", 20)], [event("Created", 10), event("Updated", 15, 14)]]
    for number, payloads in enumerate([sum(steps, [])] if together else steps):
        land(landing, f"b{number}", *payloads)
        finish(runner.start(ev.read_events(spark, landing), mark))
    seen = lambda: rows(runner.items(spark).select("project_id", "id"))
    assert seen() == [(13, 2), (14, 1)]
    runner.compact(spark)
    assert seen() == [(13, 2), (14, 1)]
    # Created anew, later than the delete: the item is back. The same item of another project never went.
    land(landing, "b9", event("Created", 30), event("Deleted", 30, 14, "2"))
    finish(runner.start(ev.read_events(spark, landing), mark))
    assert seen() == [(13, 1), (13, 2), (14, 1)]
    last = runner.last_events(spark).select("project_id", "item_id", "event_name", "event_timestamp", "is_gone")
    assert rows(last) == [(13, "1", "Created", 30, False), (14, "1", "Updated", 15, False), (14, "2", "Deleted", 30, True)]


def test_deletes_are_forgotten_after_their_time(spark, scratch):
    root, mark, landing = scratch("root"), scratch("mark"), scratch("landing")
    runner = feed.CaseFeed(root, buckets=1)
    for number in range(2):
        land(landing, f"b{number}", {**ITEM, "Event": "Deleted", "ProjectId": number, "Timestamp": number})
        finish(runner.start(ev.read_events(spark, landing), mark))
        runner.compact(spark, keep_gone=0)
    # The first was compacted with the load before the last: only loads since then count.
    runner.compact(spark, keep_gone=0)
    assert [r.project_id for r in runner.last_events(spark).collect()] == [1]


def test_lead_feed_refreshes_records(spark, scratch):
    root, mark, landing = scratch("root"), scratch("mark"), scratch("landing")
    state = {"v": "old"}

    def contacts(_, keys):
        return spark.createDataFrame([(1, state["v"]), (2, state["v"])], "Id long, name string")

    runner = feed.LeadFeed(root, {"contact": contacts}, buckets=2)
    land(landing, "b0", {"EventType": "Contact Added", "ContactId": 1}, {"EventType": "Contact Edited", "ContactId": 2})
    finish(runner.start(ev.read_events(spark, landing, ev.LEAD_EVENT_SCHEMA), mark))
    state["v"] = "new"
    land(landing, "b1", {"EventType": "Contact Edited", "ContactId": 2})
    finish(runner.start(ev.read_events(spark, landing, ev.LEAD_EVENT_SCHEMA), mark))
    assert rows(read_current(spark, f"{root}/contact/current").select("Id", "name")) == [(1, "old"), (2, "new")]
