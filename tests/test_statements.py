"""The statement store as a stream: every statement once, over restarts, idle runs and a clock that goes back."""

from datetime import datetime, timedelta

import pytest

from weftline.sources.remote import STATEMENTS_KEY, ZULU, stream_statements

START = datetime(2024, 1, 1)
# One statement each six hours, the first at the very start.
STORED = [(START + timedelta(hours=6 * i)).strftime(ZULU) for i in range(41)]


def store(fail_in=None):
    def fetch(request):
        if "link" in request:
            since, until, skip = request["link"].split("|")
        else:
            since, until, skip = request["params"]["since"], request["params"]["until"], "0"
        assert since < until
        if fail_in and since < fail_in <= until:
            raise OSError("unreachable")
        found = [s for s in STORED if since < s <= until][int(skip):]
        more = f"{since}|{until}|{int(skip) + 3}" if len(found) > 3 else None
        return {STATEMENTS_KEY: [{"stored": s} for s in found[:3]], "more": more}

    return fetch


def run(spark, folder, now, fetch=None, **kw):
    stream = stream_statements(spark, fetch or store(), START, lambda: now, **kw)
    job = (stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/at")
           .trigger(availableNow=True).start())
    job.awaitTermination()
    return sorted(r.event[-29:-2] for r in spark.read.schema("event string").parquet(f"{folder}/out").collect())


def test_restarts_idle_runs_and_a_clock_that_goes_back(spark, tmp_path):
    folder = str(tmp_path)
    day = timedelta(days=1)
    assert run(spark, folder, START + 3 * day) == STORED[1:13]
    assert run(spark, folder, START + 3 * day) == STORED[1:13]
    assert run(spark, folder, START + 2 * day) == STORED[1:13]
    assert run(spark, folder, START + 10 * day, step=timedelta(hours=30)) == STORED[1:]


def test_a_failed_batch_is_repeated(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(Exception):
        run(spark, folder, START + timedelta(days=5), store(fail_in=STORED[9]))
    assert run(spark, folder, START + timedelta(days=10)) == STORED[1:21]
    assert run(spark, folder, START + timedelta(days=10)) == STORED[1:]
