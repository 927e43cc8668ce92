"""Streams: captured exchanges kept and filtered, conversations stitched with state, running scores.

An exchange is (ts, path, status, request: array of (role, content)). It continues the open session whose last exchange shares the
longest prefix of non-system messages with it (one at least) and is shorter; of several the one with the same system text, then with
the same tools, then the one opened last. The key of the state is the hash of the first such message, so sessions that can meet
share a key.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accepted(exchanges: DataFrame) -> DataFrame:
    """Chat exchanges that went well and have a message list; the raw log keeps the others too."""
    return exchanges.filter((F.col("status") == 200) & F.col("path").endswith("/chat/completions") & (F.size("request") > 0))


def raw_log(exchanges: DataFrame, folder: str, at: str = "ts") -> None:
    """Every exchange kept as it came, in folders by day: a batch is appended, a stream is run over what there is (once each, by its sink's log)."""
    dated = exchanges.withColumn("day", F.to_date(at).cast("string"))
    if not exchanges.isStreaming:
        dated.write.mode("append").partitionBy("day").parquet(f"{folder}/raw")
        return
    sink = dated.writeStream.format("parquet").partitionBy("day").option("path", f"{folder}/raw").option("checkpointLocation", f"{folder}/state")
    sink.trigger(availableNow=True).start().awaitTermination()


def with_key(exchanges: DataFrame) -> DataFrame:
    """Rows (key, ts, talk, system, tools): a 128-bit hash for each message but system ones, one for the system texts, one for the tools.

    Only hashes go on, so what is shuffled and kept doesn't grow with the texts. ``key`` is the first message's hash (empty without one).
    An optional column ``tools`` (array of names) is a set; null messages count as absent.
    """
    digest = lambda c: F.substring(F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256), 1, 32)
    said = F.filter("request", lambda m: ~m["role"].eqNullSafe("system") & m.isNotNull())
    system = F.to_json(F.transform(F.filter("request", lambda m: m["role"] == "system"), lambda m: m["content"]))
    tools = F.to_json(F.array_sort(F.array_distinct("tools"))) if "tools" in exchanges.columns else F.lit("")
    talk = F.transform(said, lambda m: digest(F.to_json(m)))
    hashed = exchanges.select(F.col("ts").cast("double").alias("ts"), talk.alias("talk"), digest(system).alias("system"), digest(tools).alias("tools"))
    return hashed.select(F.coalesce(F.get("talk", F.lit(0)), F.lit("")).alias("key"), "*")


#: Exchanges of one moment go by length, then by hash, so that the outcome doesn't depend on how rows arrive.
ORDER = ["ts", "length", "talk", "system", "tools"]


class Sessions:
    """The open sessions of one opening, found by the prefixes of their last exchange.

    A tree of message hashes leads from a new exchange to the deepest prefix it shares; at each prefix the sessions stand by
    what they agree in (system text and tools, one of them, neither) and by length, last opened on top. So an exchange costs its own length
    and the different lengths of sessions, not the number of sessions. Entries of outgrown states stay until they are the greater part.
    """

    def __init__(self, rows: Iterable[list] = ()) -> None:
        self.rows = [list(r) for r in rows]  # first, last, exchanges, talk, system, tools
        self._index()

    def _index(self) -> None:
        self.nodes: dict[tuple, int] = {}
        self.heaps: dict[tuple, dict[int, list]] = {}
        self.version = [0] * len(self.rows)
        self.entries = self.live = 0
        for i in range(len(self.rows)):
            self._enter(i)

    def _enter(self, i: int) -> None:
        _, _, _, talk, system, tools = self.rows[i]
        node = 0
        for h in talk:
            node = self.nodes.setdefault((node, h), len(self.nodes) + 1)
            for agrees in ((system, tools), (system, None), (None, tools), (None, None)):
                heapq.heappush(self.heaps.setdefault((node, *agrees), {}).setdefault(len(talk), []), (-i, self.version[i]))
        self.entries += len(talk)
        self.live += len(talk)

    def _last_opened(self, place: tuple, below: int) -> int:
        """The last session opened at a place of the index that has fewer messages; -1 if there is none."""
        best, lengths = -1, self.heaps.get(place, {})
        for n in [n for n in lengths if n < below]:
            heap = lengths[n]
            while heap and self.version[-heap[0][0]] != heap[0][1]:
                heapq.heappop(heap)
            if heap:
                best = max(best, -heap[0][0])
            else:
                del lengths[n]
        return best

    def _find(self, talk: list[str], system: str, tools: str) -> int:
        path, node = [], 0
        for h in talk:
            node = self.nodes.get((node, h), 0)
            if not node:
                break
            path.append(node)
        for node in reversed(path):
            for agrees in ((system, tools), (system, None), (None, tools), (None, None)):
                found = self._last_opened((node, *agrees), len(talk))
                if found >= 0:
                    return found
        return -1

    def take(self, ts: float, talk: list[str], system: str, tools: str) -> None:
        """One exchange goes on with the session that fits best, else opens one."""
        i = self._find(talk, system, tools)
        if i < 0:
            i = len(self.rows)
            self.rows.append([ts, ts, 1, talk, system, tools])
            self.version.append(0)
        else:
            self.live -= len(self.rows[i][3])
            self.rows[i][1:] = [ts, self.rows[i][2] + 1, talk, system, tools]
            self.version[i] += 1
        self._enter(i)
        if self.entries > 2 * self.live + 1024:
            self._index()

    def table(self, key: str) -> list[tuple]:
        return [(key, i, n, len(talk), first, last) for i, (first, last, n, talk, _, _) in enumerate(self.rows)]


SESSION = "key string, session int, exchanges int, messages int, first double, last double"
COLUMNS = [c.split()[0] for c in SESSION.split(", ")]


def stitched_batch(exchanges: DataFrame) -> DataFrame:
    """The batch twin: exchanges stream through their key's task in time order, so a task holds open sessions only, not exchanges.

    Null times come first. Repeated rows are exchanges of their own (an equal request has no more messages: it opens a session).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sessions = None, Sessions()
        for frame in frames:
            out: list[tuple] = []
            for x in frame.itertuples(index=False):
                if x.key != key:
                    out += sessions.table(key)
                    key, sessions = x.key, Sessions()
                sessions.take(x.ts, list(x.talk), x.system, x.tools)
            yield pd.DataFrame(out, columns=COLUMNS)
        yield pd.DataFrame(sessions.table(key), columns=COLUMNS)

    flat = with_key(exchanges).withColumn("length", F.size("talk"))
    return flat.repartition("key").sortWithinPartitions("key", *ORDER).mapInPandas(run, SESSION)


def stitched_stream(exchanges: DataFrame) -> DataFrame:
    """The streaming form: state per key is its open sessions (hashes); each batch emits the sessions of the keys it touched."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sessions = Sessions(json.loads(state.get[0]) if state.exists else [])
        arrived = [(x.ts, len(x.talk), list(x.talk), x.system, x.tools) for frame in frames for x in frame.itertuples(index=False)]
        for ts, _, talk, system, tools in sorted(arrived, key=lambda x: (x[0] == x[0], x)):
            sessions.take(ts, talk, system, tools)
        state.update((json.dumps(sessions.rows),))
        yield pd.DataFrame(sessions.table(key[0]), columns=COLUMNS)

    return with_key(exchanges).groupBy("key").applyInPandasWithState(step, SESSION, "open string", "update", GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what there is into Parquet in the folder, batch by batch with its number, and read it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


def live_table(stream: DataFrame, folder: str, key: list[str], order: list[str]) -> DataFrame:
    """An append-only stream kept as its last row per key: each batch is merged into a new version of the table."""
    from millrace.operators.scores import last_wins

    spark = stream.sparkSession

    def files():
        return spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(below: float) -> list[int]:
        """Versions of batches before this one that were written whole; what is on disk survives a restart."""
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [x.getPath().getName() for x in (files().listStatus(root) if files().exists(root) else [])]
        done = [int(n[1:]) for n in names if re.fullmatch(r"v\d+", n)]
        return [n for n in done if n < below and files().exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{n}/_SUCCESS"))]

    def latest(below: float) -> str | None:
        done = versions(below)
        return f"{folder}/v{max(done)}" if done else None

    def merge(batch: DataFrame, number: int) -> None:
        before = latest(number)
        both = batch if before is None else spark.read.parquet(before).unionByName(batch)
        last_wins(both, key, order).select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/v{number}")
        # a batch that is run again needs the version before it, none needs those before that
        for old in versions(number - 1):
            files().delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{old}"), True)

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    now = latest(float("inf"))
    return spark.read.parquet(now) if now else spark.createDataFrame([], stream.schema)
