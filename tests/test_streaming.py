import time
from datetime import datetime

import pytest
from conftest import rows

from tiermill.sources.envelope import ENVELOPE, read_envelope_files, read_topic
from tiermill.streaming import progress
from tiermill.streaming import ratings as stream

T = datetime(2025, 5, 1, 10, 0, 0, 123456)


def message(offset, text, partition=0):
    return (None, None if text is None else text.encode(), "ratings", partition, offset, T)


def rating(offset, rating_value="4.5", timestamp="2025-05-01T10:00:00.123456", extra=""):
    return message(
        offset,
        '{"customer_id": 1, "branch_id": 2, "employee_id": 3, "treatment_id": 4,'
        f'"rating_value": {rating_value}, "comment": "ok", "timestamp": "{timestamp}"{extra}}}',
    )


T_DATE = stream.STORED["event_date"].dataType
PAYLOAD = ("customer_id", "branch_id", "rating_value", "comment", "timestamp", "_kafka_offset")


def envelopes(spark, messages):
    return spark.createDataFrame(messages, ENVELOPE)


def test_parse(spark):
    df = envelopes(
        spark,
        [
            rating(0),
            message(1, "no json"),
            rating(2, rating_value='"five"'),
            message(3, '{"customer_id": 1}'),
            rating(4, extra=', "more": [1, 2]'),
            message(5, "null"),
            message(6, None),
            rating(7, rating_value='"NaN"'),
        ],
    )
    parsed = stream.parse_ratings(df).drop("processed_timestamp")
    got = {r["_kafka_offset"]: r for r in parsed.collect()}
    assert got[0]["timestamp"] == T and got[0]["event_date"] == T.date()
    assert got[0]["rating_value"] == 4.5 and got[4]["rating_value"] == 4.5
    assert got[2]["rating_value"] is None and got[2]["branch_id"] == 2
    assert got[3]["customer_id"] == 1 and got[3]["comment"] is None
    assert got[7]["rating_value"] != got[7]["rating_value"]
    unreadable = parsed.filter(stream.unreadable())
    assert rows(unreadable, "_kafka_offset") == [(1,), (5,), (6,)]


def _run(spark, tmp_path, batches, name="run", files_per_batch=1, **options):
    folder = tmp_path / name
    for messages in batches:
        envelopes(spark, messages).coalesce(1).write.mode("append").parquet(str(folder / "topic"))
    query = stream.start_bronze(
        read_envelope_files(spark, str(folder / "topic"), files_per_batch),
        str(folder / "bronze"),
        str(folder / "checkpoint"),
        until_caught_up=True,
        **options,
    )
    query.awaitTermination()
    assert query.exception() is None
    return str(folder / "bronze")


@pytest.mark.parametrize("split", [1, 2, 5])
def test_stream_equals_batch_for_any_split(spark, tmp_path, split):
    messages = [rating(i, timestamp=f"2025-05-0{1 + i % 3}T10:00:00") for i in range(10)]
    messages.append(message(10, "no json"))
    batches = [messages[i::split] for i in range(split)]
    path = _run(spark, tmp_path, batches, f"split{split}")
    stored = stream.read_batches(spark, path)
    counts = stream.batch_counts(stored).collect()
    assert sorted(r["row_count"] for r in counts) == sorted(map(len, batches))
    want = stream.parse_ratings(envelopes(spark, messages))
    assert rows(stored, *PAYLOAD) == rows(want, *PAYLOAD)


def test_a_later_run_adds_new_messages_only(spark, tmp_path):
    path = _run(spark, tmp_path, [[rating(0), rating(1)]])
    assert stream.read_batches(spark, path).count() == 2
    path = _run(spark, tmp_path, [[rating(2)]])
    assert rows(stream.read_batches(spark, path), "_kafka_offset") == [(0,), (1,), (2,)]
    _run(spark, tmp_path, [])
    assert stream.read_batches(spark, path).count() == 3


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = stream.parse_ratings(envelopes(spark, [rating(0), rating(1)]))
    for _ in range(3):
        stream.write_batch(batch, 7, path, ["event_date"])
    assert stream.read_batches(spark, path).count() == 2


def test_rejected_messages_are_set_aside(spark, tmp_path):
    rejected = str(tmp_path / "rejected")
    path = _run(
        spark, tmp_path, [[rating(0), message(1, "no json"), rating(2)]], rejected_path=rejected
    )
    assert rows(stream.read_batches(spark, path), "_kafka_offset") == [(0,), (2,)]
    assert rows(stream.read_batches(spark, rejected, stream.REJECTED), "raw", "_kafka_offset") == [("no json", 1)]


def test_a_new_checkpoint_adds_to_what_is_stored(spark, tmp_path):
    topics = [[rating(i) for i in range(5)], [rating(5), rating(6)]]
    for run, messages in enumerate(topics):
        topic = str(tmp_path / f"topic{run}")
        envelopes(spark, messages).coalesce(1).write.parquet(topic)
        query = stream.start_bronze(
            read_envelope_files(spark, topic, 1),
            str(tmp_path / "bronze"),
            str(tmp_path / f"checkpoint{run}"),
            until_caught_up=True,
        )
        query.awaitTermination()
    stored = stream.read_batches(spark, str(tmp_path / "bronze"))
    assert rows(stored, "_kafka_offset") == [(i,) for i in range(7)]


def test_a_topic_of_rejected_messages_leaves_an_empty_table(spark, tmp_path):
    rejected = str(tmp_path / "rejected")
    path = _run(spark, tmp_path, [[message(0, "no json")]], rejected_path=rejected)
    assert stream.read_batches(spark, path).count() == 0
    assert stream.read_batches(spark, path).schema["event_date"].dataType == T_DATE
    assert stream.read_batches(spark, rejected, stream.REJECTED).count() == 1
    assert stream.read_batches(spark, str(tmp_path / "nothing")).count() == 0


def test_the_stream_runs_by_the_clock(spark, tmp_path):
    topic, bronze = str(tmp_path / "topic"), str(tmp_path / "bronze")
    envelopes(spark, [rating(0)]).coalesce(1).write.parquet(topic)
    query = stream.start_bronze(
        read_envelope_files(spark, topic, 1), bronze, str(tmp_path / "checkpoint"), trigger="1 second"
    )
    try:
        for offset in (1, 2):
            for _ in range(60):
                if stream.read_batches(spark, bronze).count() >= offset:
                    break
                time.sleep(1)
            envelopes(spark, [rating(offset)]).coalesce(1).write.mode("append").parquet(topic)
    finally:
        query.stop()
    stored = rows(stream.read_batches(spark, bronze), "_kafka_offset")
    assert stored[:2] == [(0,), (1,)]


def test_latest_rows_break_ties_by_position(spark):
    parsed = stream.parse_ratings(envelopes(spark, [rating(i) for i in range(9)]))
    assert [r["_kafka_offset"] for r in stream.latest_rows(parsed).collect()] == [8, 7, 6, 5, 4]


def test_redelivered_messages_are_dropped_in_the_stream(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for messages in ([rating(0), rating(1)], [rating(1), rating(2)]):
        envelopes(spark, messages).coalesce(1).write.mode("append").parquet(topic)
    parsed = stream.parse_ratings(read_envelope_files(spark, topic, 1))
    query = (
        stream.drop_repeats(parsed)
        .writeStream.format("memory")
        .queryName("deduplicated")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.table("deduplicated"), "_kafka_offset") == [(0,), (1,), (2,)]


def test_topics_need_the_connector(spark):
    try:
        df = read_topic(spark, "localhost:1", "ratings")
    except Exception as missing:
        assert "kafka" in str(missing).lower()
    else:
        assert df.isStreaming and set(ENVELOPE.names) <= set(df.columns)


def _watched(spark, tmp_path, batches, **options):
    metrics = progress.BatchMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(metrics)
    topic = str(tmp_path / "topic")
    try:
        for messages in batches:
            if messages:
                envelopes(spark, messages).coalesce(1).write.mode("append").parquet(topic)
            query = stream.start_bronze(
                read_envelope_files(spark, topic), str(tmp_path / "bronze"), str(tmp_path / "checkpoint"),
                until_caught_up=True, **options,
            )
            query.awaitTermination()
            metrics.wait(query)
    finally:
        spark.streams.removeListener(metrics)
    return progress.read_metrics(spark, str(tmp_path / "metrics"))


def test_late_and_repeated_rows_are_counted_and_a_replay_once(spark, tmp_path):
    def at(offset, day):
        return rating(offset, timestamp=f"2025-05-{day:02d}T10:00:00")

    first = [at(0, 1), at(1, 10), message(2, "no json")]
    second = [at(1, 10), at(3, 9), at(4, 8), at(5, 2), at(6, 1), at(6, 1)]
    got = _watched(spark, tmp_path, [first, second], late_after="48 hours")
    columns = ("batch_id", "rows_in", "rows_kept", "rows_repeated", "rows_late")
    sums = (9, 4, 1, 4)
    # the message of the 8th is as late as the watermark itself
    assert rows(progress.totals(got)) == [sums]
    stored = stream.read_batches(spark, str(tmp_path / "bronze"))
    assert rows(stored, "_kafka_offset") == [(0,), (1,), (2,), (3,)]
    known = rows(got, *columns)
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    for done in (tmp_path / "checkpoint" / "commits").glob(f"*{last}*"):
        done.unlink()  # as if the query had been cut off before it noted the end of the batch
    again = _watched(spark, tmp_path, [[]], late_after="48 hours")
    assert rows(progress.totals(again)) == [sums] and rows(again, *columns) == known
    assert stream.read_batches(spark, str(tmp_path / "bronze")).count() == 4


def test_metrics_of_a_stream_that_drops_nothing(spark, tmp_path):
    got = _watched(spark, tmp_path, [[rating(0), rating(0)], [rating(1)]])
    assert rows(got, "rows_in", "rows_kept", "rows_late") == [(1, 1, 0), (2, 2, 0)]
    assert progress.read_metrics(spark, str(tmp_path / "nothing")).count() == 0
    assert rows(progress.totals(progress.read_metrics(spark, str(tmp_path / "nothing")))) == [(0, 0, 0, 0)]
