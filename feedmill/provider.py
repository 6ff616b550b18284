"""Scoring providers: what answers the prompts of the enrichment stage.

``Replay`` joins recorded answers, the default and the one for tests.  ``Http``
posts prompts to an endpoint from the executors; ``Durable`` keeps what it answers.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.scoring import envelope_text
from .ledger import Ledger


class Provider(Protocol):
    def answer(self, prompts: DataFrame) -> DataFrame:
        """``prompts`` (source_key, prompt, system, ...) with ``answer``, null
        where there is none."""


@dataclass(frozen=True)
class Replay:
    responses: DataFrame  # source_key, answer

    def answer(self, prompts: DataFrame) -> DataFrame:
        one = self.responses.groupBy("source_key").agg(F.max("answer").alias("answer"))
        return prompts.join(one, "source_key", "left")


def post(url: str, key: str, payload: dict, timeout: float = 120) -> str:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return r.read().decode()


#: Request bodies by kind of endpoint.
BODIES: dict[str, Callable[[str, str, str | None, int], dict]] = {
    "openai": lambda model, prompt, system, most: {"model": model, "max_tokens": most, "messages": [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt}]},
    "anthropic": lambda model, prompt, system, most: {"model": model, "max_tokens": most, "messages": [{"role": "user", "content": prompt}]} | ({"system": system} if system else {}),
    "custom": lambda model, prompt, system, most: {"model": model, "max_output_tokens": most, "input": ([{"role": "system", "content": system}] * bool(system)) + [{"role": "user", "content": prompt}]},
}


@dataclass(frozen=True)
class Http:
    kind: str
    url: str
    key: str
    model: str
    system: str | None = None
    max_tokens: int = 1024
    send: Callable[[str, str, dict], str] = post
    delays: tuple[float, ...] = (0, 1, 4)

    def __post_init__(self) -> None:
        if self.kind not in BODIES:
            raise RuntimeError(f"provider {self.kind!r} is none of {', '.join(BODIES)}")

    def ask(self, prompt: str | None, system: str | None) -> str | None:
        """The endpoint's answer as it came; None after the last attempt failed."""
        try:
            return retry(lambda: self.send(self.url, self.key, BODIES[self.kind](self.model, prompt or "", system or self.system, self.max_tokens)), self.delays)
        except OSError:
            return None  # this item fails, the others go on

    def answer(self, prompts: DataFrame) -> DataFrame:
        me = self

        @F.arrow_udf("string")
        def ask(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for asked, systems in batches:
                yield pa.array([me.ask(p, s) for p, s in zip(asked.to_pylist(), systems.to_pylist())], pa.string())

        return prompts.withColumn("_fm_body", ask(F.col("prompt"), system_of(prompts))).withColumn("answer", said(F.col("_fm_body"))).drop("_fm_body")


def system_of(prompts: DataFrame) -> Column:
    return F.col("system") if "system" in prompts.columns else F.lit(None).cast("string")


def said(body: Column) -> Column:
    """The text in an endpoint's answer."""
    return F.coalesce(envelope_text(body), F.get_json_object(body, "$.content[0].text"))


@dataclass(frozen=True)
class Durable:
    """Answers on record before the next stage: a prompt is asked once, however
    many items, runs and attempts need it.  ``inner.ask`` is called on the executors,
    at most ``per_second`` times in each of the ledger's buckets."""

    inner: Http
    ledger: Ledger
    per_second: float | None = None

    def answer(self, prompts: DataFrame) -> DataFrame:
        inner = self.inner
        asked = F.to_json(F.struct(F.col("prompt"), system_of(prompts).alias("system")), {"ignoreNullFields": "false"})
        keyed = prompts.withColumn("_fm_body", asked).withColumn("_fm_key", F.sha2(F.concat(F.lit(f"{inner.kind}\n{inner.model}\n{inner.system}\n{inner.max_tokens}\n"), "_fm_body").cast("binary"), 256))

        def do(batch: list[tuple[str, str]]) -> list[str | None]:
            return [inner.ask(q["prompt"], q["system"]) for q in (json.loads(body) for _, body in batch)]

        self.ledger.work(keyed.select(F.col("_fm_key").alias("key"), F.col("_fm_body").alias("body")), do, 1, self.per_second)
        known = self.ledger.read(prompts.sparkSession).select(F.col("key").alias("_fm_key"), F.col("value").alias("_fm_said"))
        return keyed.join(known, "_fm_key", "left").withColumn("answer", said(F.col("_fm_said"))).drop("_fm_key", "_fm_body", "_fm_said")


def retry(call: Callable[[], object], delays: tuple[float, ...] = (0, 1, 2), sleep: Callable[[float], None] = time.sleep):
    """The call's result, after at most so many attempts; the last error else."""
    for i, delay in enumerate(delays):
        sleep(delay)
        try:
            return call()
        except OSError:
            if i + 1 == len(delays):
                raise
