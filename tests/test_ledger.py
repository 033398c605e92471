"""Batches that count once, wherever the job is killed."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txnspark.sinks import ledger
from txnspark.sources.jdbc import Database


class Killed(ledger.FolderTable):
    """Fails once at each point that is listed."""

    points: list = []

    def _kill(self, batch_id, point):
        if (batch_id, point) in self.points:
            self.points.remove((batch_id, point))
            raise RuntimeError(f"killed {point} in batch {batch_id}")

    def stage(self, rows, query, batch_id):
        self._kill(batch_id, "before it is staged")
        # a stream with state must not run twice within a batch
        rows = rows.persist()
        # what an attempt that got half way leaves behind
        super().stage(rows.where("n % 2 = 0"), query, batch_id)
        self._kill(batch_id, "half staged")
        super().stage(rows, query, batch_id)

    def commit(self, query, batch_id):
        self._kill(batch_id, "between rows and ledger")
        super().commit(query, batch_id)
        self._kill(batch_id, "after the commit")


def run(spark, folder, table, stateful=False):
    stream = spark.readStream.schema("n long, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    if stateful:
        stream = stream.withWatermark("at", "1 hour").dropDuplicatesWithinWatermark(["n"])
    writer = stream.writeStream.foreachBatch(ledger.exactly_once(table, "q", ["n"]))
    writer.option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("stateful", [False, True])
def test_killed_at_every_point(spark, tmp_path, stateful):
    folder = str(tmp_path)
    for k in range(4):
        rows = spark.range(k * 10, k * 10 + 10, 1, 1).select(F.col("id").alias("n"), F.timestamp_seconds(F.col("id") + 10**9).alias("at"))
        rows.unionAll(rows.limit(3)).coalesce(1).write.parquet(f"{folder}/in", mode="append")
    table = Killed(spark, f"{folder}/table", rows.schema)
    table.points[:] = [
        (0, "before it is staged"),
        (1, "half staged"),
        (1, "between rows and ledger"),
        (2, "after the commit"),
        (3, "between rows and ledger"),
        (3, "after the commit"),
    ]
    kills = 0
    while True:
        try:
            run(spark, folder, table, stateful)
            break
        except StreamingQueryException as error:
            assert "killed" in str(error)
            kills += 1
            seen = [r.n for r in table.rows().collect()]
            # whole batches only
            assert len(seen) == len(set(seen)) and len(seen) % 10 == 0
    assert kills == 6 and not table.points
    assert sorted(r.n for r in table.rows().collect()) == list(range(40))


def test_empty_table_and_empty_batch(spark, tmp_path):
    df = spark.createDataFrame([], "n long, at timestamp")
    table = ledger.FolderTable(spark, str(tmp_path / "t"), df.schema)
    assert table.rows().collect() == [] and not table.holds("q", 0)
    write = ledger.exactly_once(table, "q")
    write(df, 0)
    assert table.holds("q", 0) and not table.holds("q", 1) and not table.holds("other", 0)
    assert table.rows().collect() == []


class Connection:
    """Notes what is run and what becomes of it."""

    def __init__(self, log, fails_at=None):
        self.log, self.fails_at = log, fails_at

    def cursor(self):
        return self

    def execute(self, sql, values=()):
        if self.fails_at and sql.startswith(self.fails_at):
            raise RuntimeError("connection lost")
        self.log.append((sql, tuple(values)))

    def fetchone(self):
        return None

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def database_table(log, fails_at=None):
    database = Database("jdbc:postgresql://host/db", "me", "secret")
    return ledger.DatabaseTable(
        database, lambda: Connection(log, fails_at), "alerts", ["alert_id", "score"], ["alert_id"], "alerts_staging"
    )


def test_ledger_row_and_rows_share_a_transaction():
    log = []
    database_table(log).commit("q", 7)
    assert log == [
        ("INSERT INTO stream_ledger (query, batch) VALUES (%s, %s)", ("q", 7)),
        (
            "INSERT INTO alerts (alert_id, score) SELECT alert_id, score FROM alerts_staging s "
            "WHERE NOT EXISTS (SELECT 1 FROM alerts t WHERE t.alert_id = s.alert_id)",
            (),
        ),
        "commit",
        "close",
    ]
    log.clear()
    assert not database_table(log).holds("q", 7) and log[0][1] == ("q", 7) and log[-1] == "close"
    for point in ("INSERT INTO stream_ledger", "INSERT INTO alerts"):
        log.clear()
        with pytest.raises(RuntimeError):
            database_table(log, point).commit("q", 7)
        assert log[-2:] == ["rollback", "close"] and "commit" not in log
    assert "PRIMARY KEY (query, batch)" in database_table(log).ledger_ddl()
