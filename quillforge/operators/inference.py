"""Model calls over a DataFrame, through a callable the user brings."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Limits of the real-time path and of the retry policy.
REALTIME_MAX_TOKENS = 32768
TEMPERATURE = 0.001
MAX_RETRIES = 5
MAX_DELAY_SECONDS = 60.0


class RateLimited(Exception):
    """Raised by a completer when the service asks to slow down."""


@dataclass(frozen=True)
class Completion:
    """What a completer is asked for."""

    system: str | None
    user: str
    max_tokens: int = REALTIME_MAX_TOKENS
    temperature: float = TEMPERATURE

    @property
    def messages(self) -> list[dict[str, str]]:
        user = {"role": "user", "content": self.user}
        return [user] if self.system is None else [{"role": "system", "content": self.system}, user]


Completer = Callable[[Completion], "str | None"]


@dataclass(frozen=True)
class Retry:
    """Full-jitter exponential backoff on rate limits."""

    retries: int = MAX_RETRIES
    max_delay: float = MAX_DELAY_SECONDS
    sleep: Callable[[float], None] = time.sleep
    uniform: Callable[[float, float], float] = random.uniform

    def call(self, completer: Completer, request: Completion) -> tuple[str | None, int]:
        """Reply and number of attempts; the last rate limit is passed on."""
        attempt = 0
        while True:
            try:
                return completer(request), attempt + 1
            except RateLimited:
                if attempt == self.retries:
                    raise
                self.sleep(self.uniform(0, min(self.max_delay, 2.0**attempt)))
                attempt += 1


def with_retry(completer: Completer, retry: Retry | None = None) -> Completer:
    """A completer that backs off and tries again on rate limits."""
    policy = retry or Retry()
    return lambda request: policy.call(completer, request)[0]


def infer(
    df: DataFrame,
    make_completer: Callable[[], Completer],
    system: str | None,
    content: str = "content",
    max_tokens: int = REALTIME_MAX_TOKENS,
    temperature: float = TEMPERATURE,
    retry: Retry | None = None,
    partitions: int | None = None,
    threads: int = 1,
) -> DataFrame:
    """Add ``reply``, ``attempts`` and ``error``: one completion per row.

    ``make_completer`` is picklable and is called once per task. Calls in flight
    are bounded by ``partitions`` (tasks) times ``threads``. A failed call makes
    a row with an error, not a failed job. A lost task calls the model again, so
    write the result to a table before using it.
    """
    extra = [
        T.StructField("reply", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
    schema = T.StructType(df.schema.fields + extra)
    policy = retry or Retry(retries=0)

    def answer(completer: Completer, text: str) -> tuple[str | None, int, str | None]:
        tried = 0

        def counted(request: Completion) -> str | None:
            nonlocal tried
            tried += 1
            return completer(request)

        if text is None:
            return None, 0, "no content"
        try:
            reply, _ = policy.call(counted, Completion(system, text, max_tokens, temperature))
            return reply, tried, None if reply is not None else "no reply"
        except Exception as failure:  # noqa: BLE001 - any failure belongs to its row
            return None, tried, f"{type(failure).__name__}: {failure}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        completer = make_completer()
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                texts = batch.column(content).to_pylist()
                answers = list(pool.map(lambda text: answer(completer, text), texts))
                replies, attempts, errors = zip(*answers) if answers else ((), (), ())
                added = [
                    pa.array(replies, pa.string()),
                    pa.array(attempts, pa.int32()),
                    pa.array(errors, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

    source = df if partitions is None else df.repartition(partitions)
    return source.mapInArrow(run, schema)
