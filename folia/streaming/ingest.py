"""Page files as a stream: blocks as they come, and documents once all their pages are there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ..sources.schemas import LAYOUT


def stream_layout(spark: SparkSession, path: str, files_a_batch: int = 1000) -> DataFrame:
    """New page files below ``path``, a row a page, with the time that it came."""
    raw = spark.readStream.schema(LAYOUT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*_res.json").option("maxFilesPerTrigger", files_a_batch).json(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return raw.select("*", folder.alias("doc_id"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("came"))


def complete_documents(pages: DataFrame, lateness: str = "1 hour", wait: str = "24 hours") -> DataFrame:
    """Documents all of whose pages have come, once each: ``doc_id``, ``page_count``, ``pages_seen``, ``last_page``.

    Every page says how many there are; pages that come twice count once.  The
    state of a document is its page numbers, and once it is complete only that
    it was given, so pages that come again do not give it again.  The state is
    let go when the watermark, ``lateness`` behind the newest page, has passed
    the document's last page by ``wait``; one that is not complete by then is
    never given.
    """
    limit = int(pd.Timedelta(wait).total_seconds() * 1000)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, count, last = state.get if state.exists else ([], 0, 0)
        seen, given = set(seen), count < 0
        for pdf in frames:
            seen |= {int(p) for p in pdf["page_index"].dropna()}
            count = count if given else max(count, int(pdf["page_count"].fillna(0).max()))
            last = max(last, int(pdf["came"].max().timestamp() * 1000))
        if given:
            state.update(([], -1, last))
        elif count and len(seen) >= count:
            state.update(([], -1, last))
            yield pd.DataFrame({"doc_id": [key[0]], "page_count": [count], "pages_seen": [len(seen)], "last_page": [pd.Timestamp(last, unit="ms")]})
        else:
            state.update((sorted(seen), count, last))
        if state.exists:
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs() + 1) + limit)

    few = pages.withWatermark("came", lateness).select("doc_id", "page_index", "page_count", "came")
    return few.groupBy("doc_id").applyInPandasWithState(run, "doc_id string, page_count int, pages_seen int, last_page timestamp", "seen array<int>, count int, last long", "append", "EventTimeTimeout")


def start(df: DataFrame, table: str, checkpoint: str):
    """Appends what a stream gives to Parquet files; a restart goes on from its checkpoint."""
    return df.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
