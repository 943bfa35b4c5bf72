"""A stream of requests, each answered from the flight table.

Requests arrive as files. Repeats of a request id are dropped within the watermark. Each
micro-batch is matched as a table and written under its batch number; a batch that runs again
after a failure replaces its own output, so every request is answered once.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from skyloom.operators.matching import match_candidates, of_questions, on_days_asked, prepared, questions
from skyloom.schemas import REQUEST
from skyloom.session import scratch, setting, stored

EVENT_TIME = "asked_at"
STREAM_REQUEST = StructType([*REQUEST.fields, StructField(EVENT_TIME, TimestampType())])
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_PARTITIONS = 32


def read_requests(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON request files of a landing folder, as a stream."""
    return (
        spark.readStream.schema(STREAM_REQUEST).option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def once_each(requests: DataFrame, within: str = "1 hour") -> DataFrame:
    return requests.withWatermark(EVENT_TIME, within).dropDuplicatesWithinWatermark(["request_id"])


def state_partitions(spark: SparkSession) -> int:
    """Parts of the state of ids: every batch opens and commits each of them, however few rows it holds.

    As many as the session's shuffles have, at most two a core (``STATE_PARTITIONS`` on a small or still growing cluster). A
    job keeps the number of its first start.
    """
    return min(int(spark.conf.get(PARTITIONS)), max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism))


def answer_stream(
    requests: DataFrame,
    flights: DataFrame,
    order: list[str],
    output: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] | None = None,
    within: str = "1 hour",
    every: str | None = None,
    offered: DataFrame | None = None,
) -> StreamingQuery:
    """Start the job. It runs on with a batch ``every`` so often, or else stops when the files at hand are used up.

    ``score`` turns the matched requests of a batch into scored ones. ``offered``: the ``prepared`` candidates of
    ``flights``, for a job that is started again over the same flights.
    """

    # The flight side is reduced and laid out once, not once per batch.
    offered = prepared(flights, order) if offered is None else offered
    # The session of a stateful stream plans without AQE, so a small batch would run through all shuffle partitions at
    # each join. What is kept of a batch is read by the session that started the job.
    spark = offered.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        # What a batch stores is dropped when its answers are written.
        with scratch(spark):
            # Read several times below; kept so that the files and the state are read once.
            asked = stored(batch.drop(EVENT_TIME), spark)
            # Only the flights of numbers and days asked for are grouped and moved; the four levels read them.
            near = stored(of_questions(on_days_asked(offered, asked), questions(asked)))
            answers = match_candidates(asked, near, order)
            if score is not None:
                answers = score(stored(answers))
            answers.write.mode("overwrite").parquet(f"{output}/batch={number}")

    job = (
        once_each(requests, within)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
    )
    with setting(requests.sparkSession, PARTITIONS, str(state_partitions(requests.sparkSession))):
        return job.start()


def save_models(folder: str, classifier, regressor) -> None:
    """Store two fitted (model, encoding) pairs where every batch writer can load them."""
    from skyloom.plans.training import save_encoding

    for name, (model, encoding) in (("classifier", classifier), ("regressor", regressor)):
        model.write().overwrite().save(f"{folder}/{name}/model")
        save_encoding(encoding, f"{folder}/{name}/encoding")


def load_models(spark: SparkSession, folder: str):
    """The two stored (model, encoding) pairs of ``save_models``, read side by side: most of it is waiting for small jobs."""
    from pyspark.ml import PipelineModel

    from skyloom.plans.training import load_encoding

    names = ("classifier", "regressor")
    with ThreadPoolExecutor(2 * len(names)) as pool:
        models = [pool.submit(inheritable_thread_target(PipelineModel.load), f"{folder}/{n}/model") for n in names]
        encodings = [pool.submit(inheritable_thread_target(load_encoding), spark, f"{folder}/{n}/encoding") for n in names]
        return tuple((m.result(), e.result()) for m, e in zip(models, encodings))


def model_scorer(folder: str, score: Callable[[DataFrame, tuple], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A batch scorer that loads the stored models in the batch writer, so that a restarted or replaced job (or
    models stored anew between batches) is scored by what the folder holds when the batch runs."""

    def scored(answers: DataFrame) -> DataFrame:
        return score(answers, load_models(answers.sparkSession, folder))

    return scored


def read_answers(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop("batch")
