"""The live ordering query reads what it appends from one epoch's files."""

from tidemark.plans import queries

FOLDER = "/root/testdata/sf0.001"


def test_an_append_reads_its_own_epoch(spark, monkeypatch):
    files = []
    append = queries.sinks.append
    monkeypatch.setattr(queries.sinks, "append", lambda s, rows, **k: (files.extend(rows.inputFiles()), append(s, rows, **k)))
    rows = queries.event_time_order_stream(spark, FOLDER)
    assert files and all("/epoch=" in f for f in files)
    assert rows.count() > 0
