"""Pages that land in any order: records appear with their pull's last page."""

import random

from conftest import rows
from lexweave.streaming.pages import PageFeed, numbered_pages, offset_pages

SCHEMA = "status string, pull long, page long, TotalPages int, Records array<struct<Id:int>>"


def apply(feed, spark, *pages):
    feed.apply(numbered_pages(spark.createDataFrame(list(pages), SCHEMA), ["status"]), 0)
    return rows(feed.records(spark))


def page(status, pull, number, total, *ids):
    return (status, pull, number, total, [(i,) for i in ids])


def test_half_landed_pulls_are_not_read(spark, scratch):
    feed = PageFeed(scratch(), ["status"], buckets=2)
    assert apply(feed, spark, page("new", 1, 1, 1, 1, 2), page("won", 1, 2, 2, 9)) == [("new", 1), ("new", 2)]
    # The second pull of "new" lands one page of two; the missing page of "won" comes.
    assert apply(feed, spark, page("new", 2, 1, 2, 3), page("won", 1, 1, 2, 8)) == [
        ("new", 1), ("new", 2), ("won", 8), ("won", 9)]
    # The pull's last page is empty, and null counts as empty.
    assert apply(feed, spark, ("new", 2, 2, 2, None)) == [("new", 3), ("won", 8), ("won", 9)]
    assert feed.compact(spark) > 0
    # An older pull that is completed late, and a pull that found nothing.
    assert apply(feed, spark, page("new", 1, 1, 1, 7), page("won", 5, 1, 0)) == [("new", 3)]


def test_pages_in_any_order_and_again_equal_the_batch(spark, scratch):
    rng = random.Random(5)
    pages = [page(s, p, n, total, *(100 * p + n, n)) for s, p, total in (("a", 1, 4), ("a", 2, 3), ("b", 1, 5)) for n in range(1, total + 1)]
    pages += rng.sample(pages, 5)
    rng.shuffle(pages)
    feed = PageFeed(scratch(), ["status"], buckets=2)
    cuts = [0, 5, 6, 12, len(pages)]
    for a, b in zip(cuts, cuts[1:]):
        feed.apply(numbered_pages(spark.createDataFrame(pages[a:b], SCHEMA), ["status"]), 0)
    expected = [(s, i) for s, p, total in (("a", 2, 3), ("b", 1, 5)) for n in range(1, total + 1) for i in (100 * p + n, n)]
    assert rows(feed.records(spark)) == sorted(expected, key=repr)


def test_offset_pages(spark):
    df = spark.createDataFrame(
        [("p", 1, [(1,)], True, 0, 50), ("p", 1, [(2,)], False, 50, 50)],
        "entity string, pull long, items array<struct<Id:int>>, hasMore boolean, offset long, limit long")
    assert rows(offset_pages(df, ["entity"]).select("page", "pages")) == [(1, None), (2, 2)]
