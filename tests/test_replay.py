"""The replay of a dump, with failures and restarts."""

import pytest

from ratinglens.operators.ingest import accepted, number_by_date, parse_messages
from ratinglens.sources.topics import MESSAGE
from ratinglens.streaming.replay import Replay, to_files

from .conftest import same


@pytest.fixture
def dump(make_reviews):
    return make_reviews(*[{"review_id": f"r{i:03}", "date": f"2020-01-{1 + i * 7 % 28:02} 10:00:00", "text": "a \"b\"\n"} for i in range(95)])


def test_restart_after_a_failure_leaves_nothing_out(spark, dump, tmp_path):
    replay, sent = Replay(spark, str(tmp_path / "replay"), batch_size=10, block=3), []
    assert replay.stage(dump) == 10 and replay.last_sent() == -1
    write = to_files(str(tmp_path / "messages"))

    def send(messages, number):
        write(messages, number)
        sent.append(number)
        if sent.count(2) == 1 and number == 2:
            raise RuntimeError("written, but not marked as sent")

    with pytest.raises(RuntimeError):
        replay.run(send)
    again = Replay(spark, str(tmp_path / "replay"), batch_size=10, block=3)
    assert again.last_sent() == 1 and again.stage(dump) == 10
    assert again.run(send, at_most=3) == 3 and again.last_sent() == 4
    assert again.run(send) == 5 and again.run(send) == 0 and sent == [0, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    arrived = accepted(parse_messages(spark.read.schema(MESSAGE).json(f"{tmp_path}/messages")))
    assert same(arrived.select(dump.columns), dump)


def test_a_batch_reads_its_own_block(spark, dump, tmp_path):
    replay = Replay(spark, str(tmp_path), batch_size=10, block=3)
    replay.stage(dump)
    numbers = {r.review_id: r.id_date for r in number_by_date(dump).collect()}
    in_order = sorted(numbers, key=numbers.get)
    for number in (0, 4, 9):
        batch = replay.batch(number)
        assert [r.key for r in batch.collect()] == in_order[number * 10:number * 10 + 10]
        plan = batch._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert f"(block#" in text and "PartitionFilters: [isnotnull(block" in text and "GreaterThanOrEqual(id_date" in text
    (tmp_path / "messages" / "block=0").rename(tmp_path / "block0-elsewhere")
    assert replay.batch(4).count() == 10 and replay.batch(0).count() == 0


def test_marker_between_two_names(spark, dump, tmp_path):
    replay = Replay(spark, str(tmp_path), batch_size=50)
    assert replay.stage(dump) == 2
    replay.run(lambda messages, number: None, at_most=1)
    (tmp_path / "last_sent").rename(tmp_path / "last_sent.next")
    for crc in tmp_path.glob(".last_sent*.crc"):
        crc.unlink()
    assert replay.last_sent() == 0 and replay.run(lambda messages, number: None) == 1


def test_empty_dump_and_no_dump(spark, dump, tmp_path):
    with pytest.raises(ValueError):
        Replay(spark, str(tmp_path / "none")).run(lambda messages, number: None)
    replay = Replay(spark, str(tmp_path / "empty"))
    assert replay.stage(dump.where("false")) == 0 and replay.run(lambda messages, number: None) == 0
