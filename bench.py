"""Times the headline queries: one JSON line with seconds per query and their sum."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillforge.session import local_session  # noqa: E402
from quillforge.workloads import QUERIES  # noqa: E402

HEADLINE = (
    "reply_outcomes",
    "validated_events",
    "validation_errors",
    "nested_validation",
    "first_per_key",
    "record_ids",
    "pending_by_content",
    "attached_replies",
    "batch_requests",
    "chat_samples",
    "line_checks",
    "prepared_corpus",
    "conversation_tokens",
    "template_tokens",
    "page_text",
    "infer_stub",
    "batch_job",
    "archive_roundtrip",
    "publish_and_prepare",
    "backfill_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # Start-up (JVM, Python workers, first code generation) is not part of any query.
    QUERIES["document_count"](spark, folder).collect()
    QUERIES["tokenizer_counts"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {name: round(seconds(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
