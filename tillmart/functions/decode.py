"""Texts for numeric status codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome codes of an agent job run.
RUN_STATUS = {
    0: "Failed",
    1: "Succeeded",
    2: "Retry",
    3: "Canceled",
    4: "In Progress",
}

# States of a package execution.
EXECUTION_STATUS = {
    1: "Created",
    2: "Running",
    3: "Canceled",
    4: "Failed",
    5: "Pending",
    6: "Ended Unexpectedly",
    7: "Succeeded",
    8: "Stopping",
    9: "Completed",
}

# Message types that have a name; all others show their number.
MESSAGE_TYPE = {
    120: "ERROR",
    110: "WARNING",
    70: "INFO",
}

RUN_ENDED = (0, 1, 3)
EXECUTION_SUCCEEDED = 7
ERROR_MESSAGE, WARNING_MESSAGE, INFO_MESSAGE = 120, 110, 70


def decode(code: Column, texts: Mapping[int, str]) -> Column:
    """Text of a code, NULL for an unknown one."""
    branches = [(code == key, text) for key, text in texts.items()]
    chain = F.when(*branches[0])
    for condition, text in branches[1:]:
        chain = chain.when(condition, text)
    return chain


def run_status_text(code: Column) -> Column:
    return decode(code, RUN_STATUS)


def execution_status_text(code: Column) -> Column:
    return decode(code, EXECUTION_STATUS)


def message_type_text(code: Column) -> Column:
    return F.coalesce(decode(code, MESSAGE_TYPE), code.cast("string"))


def step_text(step_id: Column) -> Column:
    return F.when(step_id == 0, "Not running").otherwise(
        F.concat(F.lit("Step "), step_id.cast("string"))
    )
