from __future__ import annotations

import io
import random

import pytest

from footfall.sources import log_tail
from footfall.streaming import ingest
from tests.conftest import rows


def lines_of(data: bytes, start: int, stop: int, split: int):
    found = []
    for span in log_tail.spans({"f": start}, {"f": stop}, split):
        found += [tuple(line) for line in log_tail.lines(io.BytesIO(data), span)]
    return found


@pytest.mark.parametrize("split", [1, 2, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("block", [1, 5, 1 << 20])
def test_ranges_tell_each_line_once(monkeypatch, split, block):
    monkeypatch.setattr(log_tail, "BLOCK_BYTES", block)
    pick = random.Random(split * block)
    bodies = ["".join(pick.choice("abé") for _ in range(pick.choice([0, 1, 2, 9]))).encode() for _ in range(40)]
    data = b"".join(body + b"\n" for body in bodies)
    starts = [0]
    for body in bodies:
        starts.append(starts[-1] + len(body) + 1)
    assert lines_of(data, 0, len(data), split) == list(zip(starts, bodies))
    assert lines_of(data + b"unfinished", starts[13], starts[31], split) == list(zip(starts, bodies))[13:31]


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_only_whole_lines_count(monkeypatch, block):
    monkeypatch.setattr(log_tail, "BLOCK_BYTES", block)
    for data, end in ((b"", 0), (b"half", 0), (b"one\n", 4), (b"one\nha", 4), (b"\n\n", 2)):
        assert log_tail.whole_lines(io.BytesIO(data), len(data)) == end


def test_a_file_that_shrank_is_an_error():
    with pytest.raises(ValueError):
        log_tail.spans({"f": 9}, {"f": 4}, 10)
    (span,) = log_tail.spans({}, {"f": 9}, 100)
    with pytest.raises(EOFError):
        list(log_tail.lines(io.BytesIO(b"a\nb"), span))


def log_line(user, behavior, article, time):
    return "\x01".join((user, behavior, article, time))


def test_a_growing_log_is_ingested_once(spark, tmp_path):
    folder, store = tmp_path / "log", str(tmp_path / "store")
    folder.mkdir()
    (folder / "_ignored").write_text("x\n")
    last = log_line("U2", "2", "D1", "2015-05-08 14:00:00.0")

    def run():
        stream = log_tail.tail_messages(spark, str(folder), split_bytes=40)
        ingest.drain(ingest.ingest(stream, store, str(tmp_path / "checkpoint")))
        events = ingest.read_events(spark, store)
        return rows(events.select("user_id", "article_id", "behavior"))

    with open(folder / "a.log", "w") as log:
        log.write(log_line("U1", "1", "D1", "2015-05-08 13:13:19.0") + "\n" + last[:9])
        log.flush()
        assert run() == [("U1", "D1", "1")]
        log.write(last[9:] + "\r\n")
        log.flush()
        assert run() == [("U1", "D1", "1"), ("U2", "D1", "2")]
        # The same key again: the later line of the file wins; lines without time or fields are kept apart.
        for behavior in ("0", "9"):
            log.write(log_line("U1", behavior, "D1", "2015-05-08 13:13:19.0") + "\n")
        log.write("\n" + log_line("U3", "1", "D3", "soon") + "\n")
    (folder / "b.log").write_text(log_line("U4", "1", "D4", "2015-05-09 00:00:00.0") + "\n")
    assert run() == [("U1", "D1", "9"), ("U2", "D1", "2"), ("U4", "D4", "1")]
    assert run() == [("U1", "D1", "9"), ("U2", "D1", "2"), ("U4", "D4", "1")]
    assert rows(ingest.read_rejects(spark, store).select("value")) == [("@@@",), ("U3@1@D3@soon",)]


def test_lines_carry_their_place(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a").write_bytes("é\n\nb\nrest".encode())
    stream = log_tail.tail_lines(spark, f"file:{tmp_path}/log", split_bytes=2)
    query = stream.writeStream.format("memory").queryName("tailed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("tailed")) == [("", "a", 3), ("b", "a", 4), ("é", "a", 0)]
