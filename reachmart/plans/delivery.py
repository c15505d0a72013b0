"""Handing leads and tasks to a destination.

The package has no client of its own; the caller passes a function that makes one. Each task
makes one client and works through its partition in Arrow batches; the outcome of every
record is written to a log. Spark repeats a task whose executor is lost, so a record may be
handed over twice; the client should create by the record's e-mail or id.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from reachmart.plans.activation import outreach_rows
from reachmart.plans.scoring import spread

LOG_SCHEMA = "customer_id string, lead_id string, task_created boolean, error string"


class Client(Protocol):
    def create(self, kind: str, fields: dict) -> str:
        """Creates a Lead or a Task and returns its id, or raises."""


def outcomes(records: DataFrame, make_client: Callable[[], Client], tasks: int | None = None) -> DataFrame:
    """Creates a lead per record and then its task. Where the lead fails, the record keeps
    its stand-in id and gets no task; ``error`` says why. ``tasks`` is the number of clients
    at work. Records with a number (``_record``) keep it."""
    texts = [F.to_json(name).alias(name) for name in ("lead", "task")]
    numbers = [name for name in ("_record",) if name in records.columns]
    rows = outreach_rows(spread(records, tasks), numbers).select("customer_id", *texts, *numbers)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def hand_over(lead_text: str, task_text: str) -> tuple[str, bool, str | None]:
            task = json.loads(task_text)
            try:
                lead_id = client.create("Lead", json.loads(lead_text))
            except Exception as error:
                return task["WhoId"], False, f"Lead: {error}"
            try:
                client.create("Task", {**task, "WhoId": lead_id})
            except Exception as error:
                return lead_id, False, f"Task: {error}"
            return lead_id, True, None

        for batch in batches:
            done = [hand_over(lead, task) for lead, task in zip(batch["lead"], batch["task"])]
            yield pd.DataFrame(
                {
                    "customer_id": batch["customer_id"],
                    "lead_id": pd.Series([lead_id for lead_id, _, _ in done], dtype="object", index=batch.index),
                    "task_created": pd.Series([made for _, made, _ in done], dtype="bool", index=batch.index),
                    "error": pd.Series([error for _, _, error in done], dtype="object", index=batch.index),
                    **{name: batch[name] for name in numbers},
                }
            )

    return rows.mapInPandas(work, ", ".join([LOG_SCHEMA, *[f"{name} long" for name in numbers]]))


def sender(
    make_client: Callable[[], Client], log_folder: str, tasks: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A ``send`` for the jobs: delivers the records, logs the outcomes and returns them.
    Written before anything reads them, so that a record is handed over once per successful
    run. Each call logs to a folder of its own."""

    def send(records: DataFrame) -> DataFrame:
        folder = f"{log_folder.rstrip('/')}/call={uuid.uuid4().hex}"
        found = outcomes(records, make_client, tasks)
        found.write.parquet(folder)
        return records.sparkSession.read.schema(found.schema).parquet(folder)

    return send
