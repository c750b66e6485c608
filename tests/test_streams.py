import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terravane.operators import aggregates, text
from terravane.sources import messages
from terravane.streaming import control, posts
from terravane.streaming.counters import CounterLog
from terravane.streaming.marks import MarkedFeed, send_to_folder
from tests.helpers import frame, rows, text_frame

NOW = {"availableNow": True}


def post(author, at, words):
    return json.dumps({"author": author, "created_at": at, "text": words}, ensure_ascii=False)


class Topic:
    """A folder of JSON Lines files standing in for a message topic."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        path.mkdir()
        self.batches = 0

    def send(self, *lines):
        # Streams skip files whose name starts with a dot or underscore.
        (self.path / f"{self.batches:04d}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
        self.batches += 1

    def stream(self, files_per_trigger=None):
        return messages.message_stream(self.spark, str(self.path), files_per_trigger)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def test_decode_splits_good_and_bad(spark):
    raw = text_frame(
        spark, '{"message_type": "POST", "id": "p1", "score": 3}',
        '{"message_type": "HEARTBEAT", "status": "ALIVE", "random_val": 7}',
        "[1,2]", "{bad", '"word"', "  ", columns="value")
    decoded = messages.decode(raw, messages.FORUM_SCHEMA).cache()
    good, bad = messages.well_formed(decoded), messages.rejected(decoded)
    assert rows(good.select("message_type", "id", "score", "status", "random_val"), "id") == [
        ("HEARTBEAT", None, None, "ALIVE", 7), ("POST", "p1", 3, None, None)]
    assert rows(bad, "value") == [('"word"',), ("[1,2]",), ("{bad",)]
    assert rows(messages.of_type(good, "POST").select("id")) == [("p1",)]


def test_messages_land_unchanged_and_once(spark, topic, tmp_path):
    lines = ['{"message_type": "POST", "id": "é1", "extra": {"kept": [1, 2]}}',
             '{"message_type": "HEARTBEAT", "status": "ALIVE"}', "[1,2]", "{bad"]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    topic.send(*lines)
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        control.drain([posts.land_forum(topic.stream(), out, checkpoint, NOW)], 120)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(lines[:2])
    topic.send('{"id": "later"}')
    control.drain([posts.land_forum(topic.stream(), out, checkpoint, NOW)], 120)
    assert spark.read.text(out).count() == 3


def test_rejected_messages_have_their_own_sink(spark, topic, tmp_path):
    topic.send(post("a", "2025-01-01T00:00:00Z", "x"), "{bad")
    query = posts.land_rejects(topic.stream(), str(tmp_path / "bad"), str(tmp_path / "cp"), NOW)
    control.drain([query], 120)
    assert rows(spark.read.text(str(tmp_path / "bad"))) == [("{bad",)]


def test_posts_to_counters_with_restart(spark, topic, tmp_path):
    def run():
        control.drain([posts.enrich(topic.stream(1), str(tmp_path / "rich"), str(tmp_path / "cp1"),
                                    trigger=NOW)], 120)
        control.drain([posts.count_labels(spark, str(tmp_path / "rich"), log,
                                          str(tmp_path / "cp2"), NOW)], 120)
        return rows(log.current(spark), "city")

    log = CounterLog(str(tmp_path / "log"))
    topic.send(post("a", "2025-01-01T00:00:00Z", "Paris is great"),
               post("b", "2025-01-01T00:00:01Z", "awful Paris and MADRID"),
               post("b", "2025-01-01T00:00:02Z", "temperature 19"))
    expected = [("Madrid", 0, 1, 0), ("Paris", 1, 1, 0)]
    assert run() == expected
    assert run() == expected
    topic.send(post("a", "2025-01-02T00:00:00Z", "paris"))
    assert run() == [("Madrid", 0, 1, 0), ("Paris", 1, 1, 1)]
    rich = messages.read_json_lines(spark, str(tmp_path / "rich"), messages.ENRICHED_SCHEMA)
    batch = aggregates.label_counts(rich, "city", "assessment")
    assert rows(batch, "city") == rows(log.current(spark), "city")


def test_replayed_counter_batch_changes_nothing(spark, tmp_path):
    log = CounterLog(str(tmp_path / "log"))
    first = frame(spark, "city string, counter string, n bigint", ("A", "positive", 2))
    second = frame(spark, "city string, counter string, n bigint", ("A", "positive", 5))
    for batch, changed in ((0, first), (1, second), (1, second), (10, second)):
        log.write_batch(changed, batch)
    assert rows(log.current(spark)) == [("A", 5, 0, 0)]


def test_folded_counters_read_the_same(spark, tmp_path):
    log = CounterLog(str(tmp_path / "log"), fold_every=3)
    for batch in range(8):
        changed = frame(spark, "city string, counter string, n bigint",
                        (f"C{batch % 2}", "negative", batch + 1))
        for _ in range(2):  # every batch is replayed once
            log.write_batch(changed, batch)
    assert sorted(p.name for p in (tmp_path / "log" / "totals").iterdir()) == ["upto=3", "upto=6"]
    assert sorted(p.name for p in (tmp_path / "log" / "changes").iterdir()) == [
        "batch_id=4", "batch_id=5", "batch_id=6", "batch_id=7"]
    assert rows(log.current(spark), "city") == [("C0", 0, 7, 0), ("C1", 0, 8, 0)]


def test_counters_before_the_first_batch(spark, tmp_path):
    current = CounterLog(str(tmp_path / "log")).current(spark)
    assert current.columns == ["city", "positive", "negative", "neutral"]
    assert current.count() == 0


def test_a_batch_writes_only_moved_marks(spark, tmp_path):
    feed = MarkedFeed(spark, str(tmp_path / "marks"), fold_every=3)
    kind = "author string, created_at string, text string"

    def batch(number, *posts):
        _, moved = feed.poll(frame(spark, kind, *[(a, t, "x") for a, t in posts]), feed.marks_before(number))
        feed.write_moved(moved, number)
        path = str(tmp_path / "marks" / "moved" / f"batch_id={number}")
        return rows(spark.read.parquet(path).select("author", F.dayofmonth("mark")), "author")

    def day(d):
        return f"2025-01-{d:02d}T00:00:00Z"

    def known(number=None):
        return rows(feed.marks_before(number).select("author", F.dayofmonth("mark")), "author")

    assert batch(0, *[(f"a{i}", day(5)) for i in range(4)], (None, day(7)), ("z", "no day")) == [
        (None, 7), ("a0", 5), ("a1", 5), ("a2", 5), ("a3", 5)]
    assert batch(1, ("a0", day(4)), ("a1", day(6))) == [("a1", 6)]
    assert batch(2, ("a2", day(5)), (None, day(6))) == []  # folds
    assert batch(2, ("a2", day(6))) == [("a2", 6)]  # the replay of a batch replaces it
    assert batch(3, ("b", day(1)), ("a3", day(8))) == [("a3", 8), ("b", 1)]
    assert known() == [(None, 7), ("a0", 5), ("a1", 6), ("a2", 6), ("a3", 8), ("b", 1)]
    assert known(2) == [(None, 7), ("a0", 5), ("a1", 6), ("a2", 5), ("a3", 5)]
    for number in (4, 5, 6):
        batch(number, ("c", day(number)))
    assert known()[-1] == ("c", 6) and len(known()) == 7
    assert [v for v in range(7) if (tmp_path / "marks" / "moved" / f"batch_id={v}").exists()] == [3, 4, 5, 6]


def test_old_marks_are_folded(spark, topic, tmp_path):
    feed = MarkedFeed(spark, str(tmp_path / "marks"), fold_every=4)
    for i in range(13):
        # One author per file: files written at the same moment arrive in any order.
        topic.send(post(f"a{i}", f"2025-01-{i + 1:02d}T00:00:00Z", "paris"))
    stream = messages.well_formed(posts.decoded_posts(topic.stream(1)))
    control.drain([feed.start(stream, send_to_folder(str(tmp_path / "sent")), str(tmp_path / "cp"),
                              NOW)], 300)
    assert len(list((tmp_path / "marks" / "moved").glob("batch_id=*"))) <= 8
    assert feed.marks_before().count() == 13
    assert messages.read_json_lines(spark, str(tmp_path / "sent"), messages.POST_SCHEMA).count() == 13


def test_marks_compare_with_the_state_before_the_poll(spark, tmp_path):
    feed = MarkedFeed(spark, str(tmp_path / "m"), keywords=["climate"])
    marks = frame(spark, "author string, mark timestamp", ("a", datetime(2025, 1, 1, 10)))
    batch = frame(spark, "author string, created_at string, text string",
                  ("a", "2025-01-01T09:59:00Z", "climate"), ("a", "2025-01-01T10:00:00Z", "climate"),
                  ("a", "2025-01-01T10:01:00Z", "Climate!"), ("a", "2025-01-01T10:02:00Z", "other"))
    send, moved = feed.poll(batch, marks)
    assert rows(send.select("created_at")) == [("2025-01-01T10:01:00Z",)]
    assert rows(moved) == [("a", datetime(2025, 1, 1, 10, 2))]


def test_marked_feed_across_polls_and_replay(spark, topic, tmp_path):
    feed = MarkedFeed(spark, str(tmp_path / "marks"), since=datetime(2025, 1, 1))
    out, calls = str(tmp_path / "sent"), []

    def send(df, batch):
        calls.append(batch)
        send_to_folder(out)(df, batch)

    def run():
        stream = messages.well_formed(posts.decoded_posts(topic.stream(1)))
        control.drain([feed.start(stream, send, str(tmp_path / "cp"), NOW)], 120)
        sent = messages.read_json_lines(spark, out, messages.POST_SCHEMA)
        return sorted(r.created_at[:10] for r in sent.collect())

    topic.send(post("a", "2024-12-31T00:00:00Z", "paris"), post("a", "2025-01-02T00:00:00Z", "paris"),
               post("a", "2025-01-05T00:00:00Z", "nothing"))
    assert run() == ["2025-01-02"]
    topic.send(post("a", "2025-01-04T00:00:00Z", "paris"), post("b", "2025-01-03T00:00:00Z", "bilbao"))
    assert run() == ["2025-01-02", "2025-01-03"]
    replay, _ = feed.poll(frame(spark, "author string, created_at string, text string",
                                ("a", "2025-01-02T00:00:00Z", "paris")), feed.marks_before(0))
    assert replay.count() == 1
    assert rows(feed.marks_before(), "author") == [
        ("a", datetime(2025, 1, 5)), ("b", datetime(2025, 1, 3))]


def test_status_and_stop(spark, topic, tmp_path):
    topic.send(post("a", "2025-01-01T00:00:00Z", "x"))
    first = posts.land_posts(topic.stream(), str(tmp_path / "o"), str(tmp_path / "c"))
    second = posts.enrich(topic.stream(), str(tmp_path / "o2"), str(tmp_path / "c2"))
    try:
        first.processAllAvailable()
        lines = control.status([first, second])
        assert [x["name"] for x in lines] == ["land_posts", "enrich_posts"]
        assert all(x["running"] and x["error"] is None for x in lines)
    finally:
        control.stop_all([first, second])
    assert not any(x["running"] for x in control.status([first, second]))


def test_repeats_are_dropped_only_on_request(spark, topic, tmp_path):
    same = post("a", "2025-01-01T00:00:00Z", "x")
    topic.send(same, same, post("a", "2025-01-01T00:00:00Z", "y"))
    stream = messages.well_formed(posts.decoded_posts(topic.stream())).withColumn(
        "event_time", F.col("created_at").cast("timestamp"))
    query = messages.start(posts.drop_repeats(stream).select("text"), "json",
                           str(tmp_path / "o"), str(tmp_path / "c"), trigger=NOW)
    control.drain([query], 120)
    assert rows(spark.read.json(str(tmp_path / "o")), "text") == [("x",), ("y",)]


def test_drifted_enriched_lines(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"city": "Madrid", "assessment": "good for city", "score": 0.9}\n\n'
        '{"created_at": "2025-05-27T08:05:31.728Z", "city": "Madrid", "assessment": "bad", "score": 0.6}\n')
    df = messages.read_json_lines(spark, str(tmp_path / "e.json"), messages.ENRICHED_SCHEMA)
    assert rows(aggregates.label_counts(df, "city", "assessment")) == [("Madrid", 0, 1, 1)]
    from terravane.plans.reports import latest_posts

    assert [r.assessment for r in latest_posts(df).collect()] == ["bad", "good for city"]


def test_broken_enriched_lines_are_not_counted(spark, tmp_path):
    (tmp_path / "enriched").mkdir()
    (tmp_path / "enriched" / "e.json").write_text(
        '{"city": "Lima", "assessment": "bad", "score": 0.6}\n{broken\n{"assessment": "bad"}\n')
    log = CounterLog(str(tmp_path / "log"))
    control.drain([posts.count_labels(
        spark, str(tmp_path / "enriched"), log, str(tmp_path / "cp"), NOW)], 120)
    assert rows(log.current(spark)) == [("Lima", 0, 1, 0)]


def test_stream_equals_batch_enrichment(spark, topic, tmp_path):
    lines = [post("a", "t", words) for words in ("lima lima", "oslo, cairo", "none", "Rome bad")]
    topic.send(*lines)
    control.drain([posts.enrich(topic.stream(), str(tmp_path / "o"), str(tmp_path / "c"),
                                trigger=NOW)], 120)
    batch = messages.well_formed(posts.decoded_posts(text_frame(spark, *lines, columns="value")))
    streamed = messages.read_json_lines(spark, str(tmp_path / "o"), messages.ENRICHED_SCHEMA)
    assert rows(streamed, "city") == rows(text.enrich_posts(batch), "city")
