"""Batch life cycle as small JSON files in the shared store: worker statuses, done and failed markers, current pointer."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from .batch import readiness
from .sinks import read_text, switch_pointer

STATUS_SCHEMA = "batch_id string, worker_id string, conclusion string, failure_reason string, finished_at string"


def _status(root: str, batch: str, worker: str) -> str:
    return f"{root}/status/{batch}/{worker}.json"


def set_status(spark: SparkSession, root: str, batch: str, worker: str, conclusion: str = "in_progress", reason: str | None = None, at: str | None = None) -> None:
    """A worker's state; each change replaces its file as a whole."""
    row = {"batch_id": batch, "worker_id": worker, "conclusion": conclusion, "failure_reason": reason, "finished_at": at}
    switch_pointer(spark, _status(root, batch, worker), json.dumps(row, sort_keys=True))


def statuses(spark: SparkSession, root: str, batch: str, workers: list[str]) -> DataFrame:
    """A row a worker of the manifest; one that has not begun has no conclusion."""
    rows = [json.loads(read_text(spark, _status(root, batch, w)) or json.dumps({"batch_id": batch, "worker_id": w})) for w in workers]
    names = [part.split()[0] for part in STATUS_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], STATUS_SCHEMA)


def finish(spark: SparkSession, root: str, batch: str, workers: list[str], at: str) -> str:
    """The batch's state; with all workers ended its marker is written, and after success it is the current batch."""
    state = readiness(statuses(spark, root, batch, workers)).first()["state"]
    if state != "not_ready":
        marker = "done" if state == "ready_success" else "failed"
        switch_pointer(spark, f"{root}/{marker}/{batch}.json", json.dumps({"batch_id": batch, "finished_at": at}, sort_keys=True))
        if marker == "done":
            switch_pointer(spark, f"{root}/current.json", json.dumps({"batch_id": batch}))
    return state


def current_batch(spark: SparkSession, root: str) -> str | None:
    text = read_text(spark, f"{root}/current.json")
    return json.loads(text)["batch_id"] if text else None
