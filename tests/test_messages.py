"""Message sinks: replays add nothing."""

from __future__ import annotations

import pytest

from hazardlake.session import new_folder
from hazardlake.sinks import messages


def test_a_replayed_batch_of_messages_adds_none(spark):
    path = new_folder(spark, "messages")
    sink = messages.message_sink(lambda rows: messages.publications(rows, ["one", "two"], constant_key="k"), path)
    for batch_id, rows in ((0, 3), (1, 4), (1, 4), (0, 3)):
        sink(spark.range(rows), batch_id)
    stored = spark.read.schema("key string, value string, topic string").json(path)
    assert stored.count() == 14
    assert {tuple(r) for r in stored.groupBy("topic").count().collect()} == {("one", 7), ("two", 7)}


def test_a_broker_gets_the_number_of_the_batch(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(messages, "write_broker", lambda rows, servers: sent.append((rows.collect(), servers)))
    sink = messages.message_sink(lambda rows: messages.publications(rows, ["one"], constant_key="k"), servers="broker:9092")
    sink(spark.range(2), 7)
    rows, servers = sent[0]
    assert servers == "broker:9092" and len(rows) == 2
    assert all((r.topic, r.headers[0].key, bytes(r.headers[0].value)) == ("one", "batch_id", b"7") for r in rows)


def test_one_target(spark):
    with pytest.raises(ValueError):
        messages.message_sink(lambda rows: rows)
    with pytest.raises(ValueError):
        messages.message_sink(lambda rows: rows, "a", "b")
