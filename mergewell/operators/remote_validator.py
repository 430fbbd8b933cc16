"""Second opinions on pairs of labels from a service that the caller supplies.

A client takes a request and gives back a status and a text.  The text is untrusted: only a JSON object
with the three expected fields in range is an opinion, anything else means "not the same", confidence 0.
:func:`service_judge` turns a client into a judge for :func:`mergewell.plans.pipelines.validated_dedup`.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Client = Callable[[dict], tuple[int, str]]

MOST_CALLS = 200
ATTEMPTS = 3
TIMEOUT_SECONDS = 30

_INSTRUCTION = "Label one and label two come from the same register. Decide whether both stand for one organisation. Reply with JSON only: same_company as true or false, confidence between 0 and 1, reasoning in a few words."
_FENCE = re.compile(r"^\s*```\w*\s*|\s*```\s*$")
_NO_OPINION = {"same_company": False, "confidence": 0.0, "reasoning": "No usable answer."}


def request_for(label_a: str, label_b: str) -> dict:
    """What a client is handed; how it words or transports this is its own affair."""
    return {"instruction": _INSTRUCTION, "one": label_a, "two": label_b, "timeout": TIMEOUT_SECONDS}


def parse_answer(text: str) -> dict:
    """The opinion in an answer; a code fence around it is taken off."""
    try:
        found = json.loads(_FENCE.sub("", text or ""))
    except ValueError:
        return dict(_NO_OPINION)
    if not isinstance(found, dict) or not isinstance(found.get("same_company"), bool):
        return dict(_NO_OPINION)
    sure = found.get("confidence")
    if isinstance(sure, bool) or not isinstance(sure, int | float) or not 0 <= sure <= 1:
        return dict(_NO_OPINION)
    return {"same_company": found["same_company"], "confidence": float(sure), "reasoning": str(found.get("reasoning", ""))[:500]}


def ask(client: Client, label_a: str, label_b: str, wait: Callable[[float], None] = time.sleep) -> dict:
    """An opinion after at most ``ATTEMPTS`` calls, with doubled waits between them."""
    for attempt in range(ATTEMPTS):
        if attempt:
            wait(float(2**attempt))
        try:
            status, text = client(request_for(label_a, label_b))
        except OSError:
            continue
        if status == 200:
            return parse_answer(text)
    return dict(_NO_OPINION)


def remote_verdicts(pairs: DataFrame, client: Client, most_calls: int = MOST_CALLS, pause: float = 1.0) -> DataFrame:
    """``label_a, label_b, score, verdict`` of the ``most_calls`` best scored pairs.

    The limit is one of cost.  A single partition of at most that many rows asks, so the pause holds for all calls.
    """
    chosen = pairs.select("label_a", "label_b", "score").orderBy(F.desc("score"), "label_a", "label_b").limit(most_calls).coalesce(1)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            opinions = []
            for a, b in zip(part["label_a"], part["label_b"]):
                opinions.append(ask(client, a, b))
                time.sleep(pause)
            yield part.assign(**{field: [o[field] for o in opinions] for field in _NO_OPINION})

    asked = chosen.mapInPandas(run, "label_a string, label_b string, score double, same_company boolean, confidence double, reasoning string")
    return asked.select("label_a", "label_b", "score", F.struct("same_company", "confidence", "reasoning").alias("verdict"))


def service_judge(client: Client, most_calls: int = MOST_CALLS, pause: float = 1.0) -> Callable[[DataFrame], DataFrame]:
    """A judge of pairs: adds ``verdict``, which stays null on pairs beyond the limit, so those are left open."""

    def judge(pairs: DataFrame) -> DataFrame:
        asked = remote_verdicts(pairs.select("label_a", "label_b", "score").distinct(), client, most_calls, pause)
        return pairs.join(F.broadcast(asked.drop("score")), ["label_a", "label_b"], "left")  # at most ``most_calls`` rows

    return judge
