"""What must not grow with the rows: calls of the state store, parsing, rows of a batch."""

import pandas as pd

from checks import streams
from quoteloom.sources import option_feed
from quoteloom.streaming import keyed


class Calls:
    """A state handle, its list and its value in one, that counts what it is asked."""

    def __init__(self):
        self.made, self.lists, self.sizes, self.timers = 0, [], None, []

    def __getattr__(self, name):
        self.made += 1
        if name in ("getListState", "getValueState"):
            return lambda kind, *_: Part(self, kind)
        return {"registerTimer": self.timers.append, "deleteTimer": self.timers.remove, "listTimers": lambda: list(self.timers)}[name]

    def getCurrentProcessingTimeInMs(self):
        return 5


class Part:
    def __init__(self, calls, kind):
        self.calls, self.kind = calls, kind

    def get(self):
        self.calls.made += 1
        return list(self.calls.lists) if self.kind == "rows" else self.calls.sizes

    def exists(self):
        self.calls.made += 1
        return self.calls.sizes is not None

    def update(self, value):
        self.calls.made += 1
        self.calls.sizes = value

    def appendList(self, rows):
        self.calls.made += 1
        self.calls.lists += rows

    def clear(self):
        self.calls.made += 1
        self.calls.lists = []


def test_flushes_need_few_state_calls():
    calls, rows, out = Calls(), [str(k) for k in range(5000)], []
    buffer = keyed._Buffer(10, 1000)
    buffer.init(calls)
    for a, b in ((0, 4), (4, 2501), (2501, 2505), (2505, 5000)):  # batches
        frames = [pd.DataFrame({"row": rows[k : min(b, k + 700)]}) for k in range(a, b, 700)]
        out += buffer.handleInputRows(("k",), iter(frames), calls)
        assert len(calls.timers) == (b % 10 > 0) and [r[0] for r in calls.lists] == rows[b - b % 10 : b]
    out = pd.concat(out)
    assert out["row"].tolist() == rows and out["flush"].tolist() == [k // 10 for k in range(5000)] and set(out["reason"]) == {"rows"}
    assert calls.made < 60


def test_large_tables_make_more_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "BATCH_ROWS", 25, raising=False)
    rows = spark.range(7, 107).selectExpr("id AS seq", "id * 2 AS v").repartition(4)
    stream = streams._in_files(rows, "seq", f"{tmp_path}/in")
    seen = []
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(sorted(tuple(r) for r in batch.collect())))
    query.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert [r for part in seen for r in part] == [(k, 2 * k) for k in range(7, 107)] and max(map(len, seen)) <= 26


def test_quotes_are_parsed_once(spark):
    messages = spark.createDataFrame([("{}", 1, 2)], "value string, ingest_ms long, arrival long")
    quotes = option_feed.l1_quotes(messages, extra=["arrival"])
    assert quotes._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
