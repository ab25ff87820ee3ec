"""A folder where files keep arriving.

The stream carries the names of the files; each micro-batch reads its own files as ``read_edi`` does, whatever their
length. A file never spans two micro-batches, and the files of a document's folder arrive together, so loop assignment
needs no state between batches: it runs on each batch as an ordinary DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.framing import cut_elements, cut_segments, frame, quarantine
from ..operators.loops import assign_loops
from ..sources.files import BINARY_SCHEMA, files_as_raw, named, read_edi
from ..specs.model import Spec


def read_edi_stream(spark: SparkSession, folder: str, charset: str = "UTF-8", files_per_batch: int | None = None) -> DataFrame:
    """``raw`` as a stream."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return files_as_raw(reader.option("recursiveFileLookup", "true").load(folder), charset)


def parse_stream(raw: DataFrame, spec: Spec, table: str, checkpoint: str, errors: str | None = None,
                 trigger: dict | None = None, charset: str = "UTF-8", **options) -> StreamingQuery:
    """Locate the segments of each batch and add them to a Parquet table. A batch that is run again after a
    failure replaces its own folder, so nothing is written twice. ``errors`` names a second table, for the files that
    cannot be read (F7). ``trigger`` holds the arguments of ``DataStreamWriter.trigger``; by default what is there is read
    once. ``options`` go to ``read_edi``."""
    def locate(batch: DataFrame, batch_id: int) -> None:
        names = [named(r["path"]) for r in batch.collect()]
        if not names:
            return
        framed = frame(read_edi(batch.sparkSession, names, charset, **options), spec.spec_id)
        if errors:
            quarantine(framed, spec.spec_id).write.mode("overwrite").parquet(f"{errors}/batch={batch_id}")
        assign_loops(cut_elements(cut_segments(framed)), spec).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    # the stream itself opens no file
    return (raw.select("path").writeStream.foreachBatch(locate).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
