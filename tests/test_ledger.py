from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows

from tiermill.plans.refresh import Sources, run_job
from tiermill.schemas import TABLES
from tiermill.sources.envelope import ENVELOPE
from tiermill.sources.tables import TableStore
from tiermill.streaming import ledger
from tiermill.streaming.ratings import parse_ratings, write_batch

NOW = datetime(2025, 6, 1, 12)


def message(offset, day):
    when = f'"timestamp":"2025-05-{day:02d}T10:00:00"' if day else '"comment":"no day"'
    text = f'{{"customer_id":{offset},"branch_id":1,"employee_id":1,"treatment_id":1,"rating_value":4.0,{when}}}'
    return (None, text.encode(), "ratings", 0, offset, NOW)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"), database="tiermill_ledger_tests")
    for table in made.tables():
        made.drop(table)
    return made


@pytest.fixture
def put(spark, tmp_path):
    def write(batch_id, *messages, run="a"):
        parsed = parse_ratings(spark.createDataFrame([message(*m) for m in messages], ENVELOPE))
        write_batch(parsed, batch_id, str(tmp_path / "ratings"), ["event_date"], run)

    write.path = str(tmp_path / "ratings")
    return write


def merged(store, put):
    counts = run_job("bronze_ratings", store, Sources(ratings_path=put.path), NOW)
    return counts, rows(store.read("bronze_ratings"), "_kafka_offset")


def files(store, table="bronze_ratings"):
    """Every data file with the day folder it is in."""
    found = {}
    for path in Path(store.root, table).rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


def test_only_touched_days_are_written(store, put):
    put(0, (1, 1), (2, 2), (3, 3))
    assert merged(store, put) == ({"batches": 1, "days": 3}, [(1,), (2,), (3,)])
    before = files(store)
    put(1, (4, 2))
    assert merged(store, put) == ({"batches": 1, "days": 1}, [(1,), (2,), (3,), (4,)])
    after = files(store)
    changed = {day for day in after if after[day] != before.get(day)}
    assert changed == {"event_date=2025-05-02"}


def test_a_run_without_new_batches_writes_nothing(store, put):
    put(0, (1, 1), (2, None))
    assert merged(store, put)[0] == {"batches": 1, "days": 2}
    before = files(store), files(store, ledger.LEDGER)
    assert merged(store, put) == ({"batches": 0, "days": 0}, [(1,), (2,)])
    assert (files(store), files(store, ledger.LEDGER)) == before


def test_a_run_cut_short_before_the_ledger_is_repeated(store, put, monkeypatch):
    put(0, (1, 1))
    merged(store, put)
    put(1, (2, 1), (3, 2))
    write = store.write

    def fail(df, table, mode, *rest):
        if table == ledger.LEDGER:
            raise RuntimeError("lost")
        write(df, table, mode, *rest)

    monkeypatch.setattr(store, "write", fail)
    with pytest.raises(RuntimeError):
        merged(store, put)
    monkeypatch.undo()
    assert merged(store, put) == ({"batches": 1, "days": 2}, [(1,), (2,), (3,)])
    assert merged(store, put)[0] == {"batches": 0, "days": 0}


def test_replayed_removed_and_unfinished_batches(store, put):
    put(0, (1, 1), (2, 2))
    put(0, (9, 3), run="b")
    assert merged(store, put)[1] == [(1,), (2,), (9,)]
    put(0, (1, 1), (5, 4))  # written again: day 2 is lost, day 4 is new
    mark = Path(put.path, "run_id=a", "batch_id=0", "_SUCCESS")
    stamp = mark.stat().st_mtime + 5
    import os

    os.utime(mark, (stamp, stamp))
    assert merged(store, put) == ({"batches": 2, "days": 3}, [(1,), (5,), (9,)])
    assert "event_date=2025-05-02" not in files(store)
    days, last = ledger.changed_days(store, 1)
    assert [d.day for d in days] == [1, 2, 4] and last == 2
    assert ledger.changed_days(store, last) == ([], 2)
    put(1, (7, 1))
    Path(put.path, "run_id=a", "batch_id=1", "_SUCCESS").unlink()  # still being written
    assert merged(store, put) == ({"batches": 0, "days": 0}, [(1,), (5,), (9,)])


def test_no_stream_yet(store, put):
    assert merged(store, put) == ({"batches": 0, "days": 0}, [])
    assert store.read(ledger.LEDGER).schema == TABLES[ledger.LEDGER]
    assert ledger.ledger(store).count() == 0
