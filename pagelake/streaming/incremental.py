"""New pages as they come: windowed counts, contents seen before, and what to do with a table next."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagelake.sources.tables import Refused, table

LATE = "1 hour"


def follow(spark: SparkSession, path: str, like: DataFrame, names: str = "*.parquet") -> DataFrame:
    """A folder's Parquet files of such names (a pattern; files, or folders of part files) as a stream."""
    return spark.readStream.schema(like.schema).parquet(f"{path}/{names}")


def window_counts(stream: DataFrame, every: str = "6 hours") -> DataFrame:
    """Events by type in tumbling windows; windows close LATE after the newest event."""
    w = stream.withWatermark("ts", LATE).groupBy(F.window("ts", every).alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.max("value").alias("most")).select(F.col("w.start").alias("start"), "event_type", "n", "most")


def new_contents(stream: DataFrame, content: str) -> DataFrame:
    """The first row of every content within the lateness allowed."""
    return stream.withWatermark("ts", LATE).dropDuplicatesWithinWatermark([content])


STATE = "last long, failures long, ways string"
ACTION = "key long, seq long, action string"


def escalate(verdicts: DataFrame, most_ways: int = 2) -> DataFrame:
    """After each verdict of a table (key, seq, passed, failed, way): done, recheck, wait, or human once it has failed in
    more ways than `most_ways`.

    Verdicts of a table come in the order of seq, over all batches: then the answer doesn't depend on how the stream is
    cut. One that comes after a later one is marked late and changes nothing.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, failures, ways = state.get if state.exists else (-(1 << 62), 0, "")
        seen = set(ways.split("\n")) - {""}
        out = []
        for seq, passed, failed, way in pd.concat(parts).sort_values("seq")[["seq", "passed", "failed", "way"]].itertuples(index=False):
            if seq < last:
                out.append((key[0], seq, "late"))
                continue
            last = seq
            if failed:
                failures += 1
                seen.add(str(way))
            out.append((key[0], seq, "done" if passed else "human" if len(seen) > most_ways else "recheck" if failures else "wait"))
        state.update((last, failures, "\n".join(sorted(seen))))
        yield pd.DataFrame(out, columns=["key", "seq", "action"])

    return verdicts.groupBy("key").applyInPandasWithState(step, ACTION, STATE, "append", GroupStateTimeout.NoTimeout)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; a folder of our own where it is unset and all run on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        raise Refused("spark.checkpoint.dir is not set: there is no folder that all machines share")
    return at or tempfile.mkdtemp()


def stream_escalation(spark: SparkSession, d: str) -> DataFrame:
    """The registered query: every event's action, from the events followed as a stream."""
    events = follow(spark, d, table(spark, d, "events"), "events.parquet*")
    kind = F.col("event_type")
    verdicts = events.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (kind == "purchase").alias("passed"), (kind == "error").alias("failed"), (F.col("event_id") % 3).cast("string").alias("way"))
    return run_once(escalate(verdicts), shared_folder(spark))


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The registered query: counts by window of all events, followed as a stream; the last windows close with the end."""
    events = follow(spark, d, table(spark, d, "events"), "events.parquet*")
    got = run_once(window_counts(events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")), shared_folder(spark))
    return got.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "most")


def stream_contents(spark: SparkSession, d: str) -> DataFrame:
    """The registered query: contents (type of event and part of its value), each once, from the stream."""
    events = follow(spark, d, table(spark, d, "events"), "events.parquet*")
    content = events.select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws("/", "event_type", (F.col("event_id") % 50).cast("string")).alias("content"))
    return run_once(new_contents(content, "content"), shared_folder(spark)).select("content")


QUERIES = {
    "stream_escalation": (stream_escalation, """WITH e AS (SELECT *, count(*) FILTER (event_type = 'error') OVER w AS failures,
  max(CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END) OVER w + max(CASE WHEN event_type = 'error' AND event_id % 3 = 1 THEN 1 ELSE 0 END) OVER w + max(CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN 1 ELSE 0 END) OVER w AS ways
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id AS key, event_id AS seq, CASE WHEN event_type = 'purchase' THEN 'done' WHEN ways > 2 THEN 'human' WHEN failures > 0 THEN 'recheck' ELSE 'wait' END AS action FROM e"""),
    "stream_windows": (stream_windows, """WITH e AS (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS w, event_type, value, (SELECT max(ts) FROM events) - INTERVAL '1 hour' AS mark FROM events)
SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, max(value) AS most FROM e WHERE w + INTERVAL '6 hours' <= mark GROUP BY w, event_type"""),
    "stream_contents": (stream_contents, "SELECT DISTINCT event_type || '/' || (event_id % 50) AS content FROM events"),
}


def run_once(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """All there is now, written to the folder with its own checkpoint, and read back."""
    at = f"{folder}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{at}/data").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/data")
