"""Incremental runs over growing inputs with Structured Streaming."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from cohortsieve import vocabulary as v
from cohortsieve.functions import rules as R
from cohortsieve.operators.extract import extract
from cohortsieve.operators.review import KEYS, latest_by, newest_first


def _run_to_end(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_extract(notes: DataFrame, out: str, checkpoint: str, rules: R.RuleSet = R.CAREFUL) -> None:
    """Read statuses out of notes not seen before and append them to ``out``.

    ``notes`` is a streaming frame. The file sink and the checkpoint make each note count once, also
    after a restart.
    """
    reports = notes.filter(F.col("note_source_value") == v.PATHOLOGY_REPORT)
    read = extract(reports, "note_text", rules).select("note_id", "person_id", *rules.ladders)
    _run_to_end(read.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


class ExtractionTable:
    """An incrementally kept extraction table that can be rebuilt from scratch.

    Rows live in generations below ``root``. Each attempt at a full refresh has rows and a checkpoint of its own, so a refresh
    that died leaves nothing to a later one, and readers of the earlier generation are not disturbed while it fills. The ledger names the rule set of
    each finished generation.
    """

    LEDGER = "generation int, attempt string, rules string, finished_at timestamp"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _ledger(self) -> str:
        return f"{self.root}/generations"

    def _finished(self) -> Row | None:
        """The ledger row of the generation readers see."""
        try:
            ledger = self.spark.read.schema(self.LEDGER).parquet(self._ledger())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return ledger.orderBy(F.desc("generation"), F.desc("finished_at")).first()

    def generation(self) -> int:
        """The finished generation readers see, or -1."""
        row = self._finished()
        return -1 if row is None else row["generation"]

    def _fill(self, attempt: str, notes: DataFrame, rules: R.RuleSet) -> None:
        stream_extract(notes, f"{self.root}/rows/{attempt}", f"{self.root}/state/{attempt}", rules)

    def update(self, notes: DataFrame, rules: R.RuleSet = R.CAREFUL) -> int:
        """Add new notes to the current generation, starting the first one if needed."""
        current = self._finished()
        if current is None:
            return self.full_refresh(notes, rules)
        if current["rules"] != rules.name:
            raise ValueError(f"generation {current['generation']} was read by {current['rules']!r}; refresh it to read by {rules.name!r}")
        self._fill(current["attempt"], notes, rules)
        return current["generation"]

    def full_refresh(self, notes: DataFrame, rules: R.RuleSet = R.CAREFUL) -> int:
        fresh, attempt = self.generation() + 1, uuid.uuid4().hex
        self._fill(attempt, notes, rules)
        self.spark.createDataFrame([(fresh, attempt, rules.name, datetime.now(timezone.utc))], self.LEDGER) \
            .coalesce(1).write.mode("append").parquet(self._ledger())
        return fresh

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows/{self._finished()['attempt']}")


def stream_reviews(events: DataFrame, out: str, checkpoint: str) -> None:
    """Append each batch's latest decisions to a log, one folder per batch.

    A batch that is run again after a failure replaces its own folder, so no decision counts twice.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        latest_by(batch, KEYS, newest_first()).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run_to_end(events.writeStream.foreachBatch(save), checkpoint)


def read_reviews(spark: SparkSession, out: str) -> DataFrame:
    """Latest decision per person and trial over all batches."""
    return latest_by(spark.read.parquet(out).drop("batch"), KEYS, newest_first())
