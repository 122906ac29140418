"""Headline queries at one scale: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "web_math_to_chat", "cot_to_chat", "validate_chat_jsonl", "dialog_pairs_sft", "chat_template_prompt", "react_flatten",
    "preference_prompt", "seeded_shuffle", "split_head_percent", "mix_sources", "sample_until_quota",
    "build_vocab", "encode_tokens", "encode_sft", "pack_eos_blocks", "pad_batch", "length_percentiles",
    "chunk_overlap", "chunk_chinese", "bm25_index", "bm25_topk", "dense_topk", "rag_context_prompt",
    "extract_number", "score_predictions", "accuracy_summary", "reward_table", "unigram_perplexity",
    "token_accuracy", "src_doc_lines", "src_vocab_lists",
]


def main() -> None:
    from quern.plans import QUERIES
    from quern.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start the engine before the clock
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)/?$", sf_dir)
    sf = float(found.group(1)) if found else None
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
