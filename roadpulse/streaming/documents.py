"""A batch sink with two outputs: feed envelopes of good documents, and rejects with reasons."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import schemas, settings
from roadpulse.settings import DEFAULTS, Thresholds
from roadpulse.sources.documents import judge_route_documents, judge_weather_documents
from roadpulse.sources.feeds import encode_feed, write_feed
from roadpulse.streaming import files

# The feed that documents of a kind become.
FEED_OF = {"route": "traffic", "weather": "weather"}
_KEY = {"route": "corridor_id", "weather": "location"}


def publish(rows: DataFrame, folder: str, batch_id: int, format: str) -> bool:
    """Write one batch as a folder that appears whole; a batch that is there already stays.

    Readers of the folder, streams included, so get every batch once, replayed or not.
    """
    spark, target = rows.sparkSession, f"{folder}/batch={batch_id}"
    if files.exists(spark, target):
        return False
    staged = f"{folder}/_staged-{batch_id}"
    rows.write.mode("overwrite").format(format).save(staged)
    return files.rename(spark, staged, target)


@dataclass(frozen=True)
class DocumentSink:
    """Where feed rows and rejects go.

    ``lookup`` lists corridors or weather locations. Feed rows go to files under ``feed_path``
    or, with ``topic``, to a broker, which a replayed batch reaches twice; rejects (key,
    fetched_at, reason, document) go to Parquet files under ``rejects_path``.
    """

    lookup: DataFrame
    rejects_path: str
    feed_path: str | None = None
    topic: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    th: Thresholds = DEFAULTS

    def judged(self, documents: DataFrame, kind: str) -> DataFrame:
        if kind == "route":
            return judge_route_documents(documents, self.lookup, self.th)
        return judge_weather_documents(documents, self.lookup)

    def writer(self, kind: str):
        feed = FEED_OF[kind]
        columns = schemas.FEEDS[feed].names

        def write(batch: DataFrame, batch_id: int) -> None:
            judged = self.judged(batch, kind).persist()
            try:
                rejects = judged.where(F.col("reason").isNotNull())
                publish(rejects.select("key", "fetched_at", "reason", "document"), self.rejects_path, batch_id, "parquet")
                good = judged.where(F.col("reason").isNull())
                encoded = encode_feed(good.select("fetched_at", *columns), _KEY[kind], keep=("fetched_at",))
                if self.topic:
                    write_feed(encoded, self.topic, self.options)
                    return
                envelopes = encoded.select(
                    F.lit(settings.TOPICS[feed]).alias("topic"), "key", "value",
                    F.unix_micros("fetched_at").alias("offset"), F.col("fetched_at").alias("timestamp"),
                )
                publish(envelopes, self.feed_path, batch_id, "json")
            finally:
                judged.unpersist()

        return write
