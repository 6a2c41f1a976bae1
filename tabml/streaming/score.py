"""Scoring streams with a fitted bundle.

The reference has no streaming; what a fitted model offers a stream is
scoring.  Two forms:

* ``transform_stream``: bundles whose prediction is row-wise (trees,
  forests, SVMs: preprocessing expressions + MLlib transform or a pandas UDF;
  KNN with a training side within the broadcast bound: a broadcast
  ``mapInPandas``) turn a streaming DataFrame into a streaming DataFrame of
  predictions.
* ``score_stream``: any bundle, KNN with a large training side included.  Each
  micro-batch is scored with the batch path inside ``foreachBatch`` and
  written to the parquet sink's partition
  ``batch_id=<id>`` with overwrite: a batch replayed after a failure replaces
  its own partition instead of adding rows (an idempotent sink); with a
  checkpoint location the query restarts where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabml.operators import score as score_op


def transform_stream(bundle, stream: DataFrame, decode: bool = True, keep: list[str] | None = None) -> DataFrame:
    return score_op.predict(bundle, stream, decode=decode, keep=keep)


def score_stream(bundle, stream: DataFrame, sink_path: str, checkpoint: str, decode: bool = True,
                 keep: list[str] | None = None, trigger_once: bool = True) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        scored = score_op.predict(bundle, batch, decode=decode, keep=keep)
        scored.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
