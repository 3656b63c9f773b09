"""Continuous preparation: new files are encoded once, with a frozen vocabulary."""

from __future__ import annotations

import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqprep.operators.encode import Lookup, encode_pairs, select_pair, vocab_lookup
from seqprep.options import PrepOptions


def prepare_stream(
    spark: SparkSession,
    in_dir: str,
    vocab: DataFrame,
    out_dir: str,
    checkpoint: str,
    schema: str | StructType,
    opts: PrepOptions = PrepOptions(),
    fmt: str = "parquet",
    max_files: int = 1000,
) -> StreamingQuery:
    """Encode what is new in ``in_dir`` and stop; resumable.

    Every micro-batch is an ordinary batch job and goes to a folder of its
    own, so a replay after a failure replaces what it wrote the first time.
    Read the result with ``spark.read.parquet(out_dir)``.

    The vocabulary is measured, collected and sent to the executors once, before
    the first micro-batch, and freed when the query ends.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(in_dir)
    pairs = select_pair(raw, opts.source_lang, opts.target_lang)

    lookup = vocab_lookup(vocab)

    def write(batch: DataFrame, batch_id: int) -> None:
        encoded = encode_pairs(batch, lookup, opts)
        encoded.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    query = (
        pairs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    threading.Thread(target=_close_after, args=(query, lookup), daemon=True).start()
    return query


def _close_after(query: StreamingQuery, lookup: Lookup) -> None:
    """Free the lookup once the query has ended, well or not."""
    try:
        query.awaitTermination()
    except StreamingQueryException:
        pass  # whoever waits for the query gets it too
    finally:
        lookup.close()
