"""Continuous landing: the stream finds new files, the batch operators ingest them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenderlake.contracts import DATASETS, DatasetSpec
from tenderlake.sources.landing import discover_landing, ingest_files, read_manifest, recognise, unseen_files

# The fixed columns of Spark's binaryFile source.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def land_continuously(
    spark: SparkSession,
    folder: str,
    bronze_root: str,
    checkpoint: str,
    on_outcomes: Callable[[DataFrame, int], None] | None = None,
    files_per_batch: int = 1000,
    specs: Sequence[DatasetSpec] = DATASETS,
    **trigger,
) -> StreamingQuery:
    """Ingest files as they land; by default those present now, then stop.

    Only file names stream; contents are read by the batch scan. A batch that runs twice
    finds its files in the manifest and leaves them, so the bronze tables stay the same, and files of one period may come
    in different batches.

    The file source names a path once. Files rewritten under a known name are therefore looked for in the listing, when
    the stream starts (outcomes then come as batch -1) and with every batch: size, time of change and then content are compared
    with the manifest, and a file with other content replaces its rows. A file rewritten while nothing new
    lands is found by the next batch or start.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado"))
    )

    def rewritten(session: SparkSession) -> DataFrame:
        """Accepted files of the folder that the manifest knows by name, but not with this content."""
        names = read_manifest(session, bronze_root).select(F.col("arquivo_origem").alias("nome"))
        listed = discover_landing(session, folder, specs).filter("aceito").join(names, "nome", "left_semi")
        return unseen_files(session, listed, bronze_root)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = session.createDataFrame(batch.collect(), batch.schema)
        landed = unseen_files(session, recognise(files, specs), bronze_root)
        again = rewritten(session)
        both = landed.unionByName(again.select(*landed.columns).join(landed.select("nome"), "nome", "left_anti").select(*landed.columns))
        outcomes = ingest_files(session, session.createDataFrame(both.collect(), landed.schema), bronze_root)
        if on_outcomes:
            on_outcomes(outcomes, batch_id)

    found_again = rewritten(spark)
    if not found_again.isEmpty():
        outcomes = ingest_files(spark, found_again, bronze_root)
        if on_outcomes:
            on_outcomes(outcomes, -1)

    return (
        found.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
