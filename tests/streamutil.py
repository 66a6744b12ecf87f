"""Helpers to drive a streaming query from hand-written micro-batches (JSON files)."""

from __future__ import annotations

import json
import os
import tempfile
import time


def write_batches(batches: list[list[dict]]) -> str:
    """One JSON-lines file per batch, with increasing modification times so the file source
    reads them in order (one file per trigger)."""
    d = tempfile.mkdtemp(prefix="eventide-stream-in-")
    now = time.time() - 10_000
    for i, rows in enumerate(batches):
        p = os.path.join(d, f"part-{i:05d}.json")
        with open(p, "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        os.utime(p, (now + i, now + i))
    return d


def run_to_end(df, output_mode: str = "append") -> list:
    """Run a stream over all available input and return every emitted row."""
    got: list = []

    def collect(batch, batch_id):
        got.extend(batch.collect())

    ck = tempfile.mkdtemp(prefix="eventide-stream-ck-")
    q = (df.writeStream.outputMode(output_mode).option("checkpointLocation", ck)
         .foreachBatch(collect).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return got
