"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from registry import load_all
from tinta.session import build_session

HEADLINE = (
    "clean_tokens",
    "corpus_stats",
    "vocab_min_count",
    "split_70_15_15",
    "token_rows_to_sentences",
    "wordpiece_vocabulary",
    "wordpiece_encode",
    "sentencepiece_encode",
    "fragmentation_summary",
    "chunk_recursive",
    "chunk_documents",
    "encode_texts",
    "topk_per_query",
    "retrieve_topk",
    "skipgram_pairs",
    "similar_words",
    "stream_clean",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    quiet = {"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, quiet)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").count()  # start the executors outside the timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        load_all()[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
