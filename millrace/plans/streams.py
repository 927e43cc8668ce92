"""Queries of streams, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import messages, rounds
from millrace.plans import messages as talk_plans
from millrace.plans import registry
from millrace.sources import folders
from millrace.streaming import capture

registry.view("exchanges", """
SELECT c.conv_id * 100 + c.turn AS ts, CASE WHEN c.turn % 9 = 8 THEN 500 ELSE 200 END AS status, '/v1/chat/completions' AS path,
 transform(filter(array_sort(collect_list(struct(p.turn, p.role, p.text))), x -> x.role IS NOT NULL), x -> struct(x.role AS role, x.text AS content)) AS request
FROM {conversations} c JOIN {conversations} p ON p.conv_id = c.conv_id AND p.turn <= c.turn WHERE c.role = 'user' GROUP BY c.conv_id, c.turn
""", "SELECT 1")  # fmt: skip


@registry.query("exchanges", sql="SELECT conv_id * 100 + turn AS ts, (turn + 1)::INT AS messages FROM {conversations} WHERE role = 'user' AND turn % 9 <> 8")
def ingest_exchanges(exchanges):
    return capture.accepted(exchanges).select("ts", F.size("request").alias("messages"))


@registry.query("exchanges")
def stitch_sessions(exchanges):
    """Captured requests grow turn by turn; those of a conversation are one session."""
    return capture.stitched_batch(capture.accepted(exchanges))


def _live(spark, sf_dir):
    stream = folders.stream_table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", (F.col("value") > 40).alias("ok"))
    live = capture.live_table(stream, folders.scratch(spark), ["event_type", "user_id"], ["event_id"])
    return live.groupBy("event_type").agg(F.sum(F.col("ok").cast("long")).alias("k"), F.count(F.lit(1)).alias("n"))


registry.QUERIES["live_scores"] = _live
registry.ORACLES["live_scores"] = "SELECT event_type, sum((v > 40)::INT)::BIGINT AS k, count(*)::BIGINT AS n FROM (SELECT event_type, user_id, arg_max(value, event_id) AS v FROM events GROUP BY ALL) GROUP BY event_type"


def _raw_log(spark, sf_dir):
    """Every event kept by day through a file sink, read back and counted."""
    folder = folders.scratch(spark)
    capture.raw_log(folders.stream_table(spark, sf_dir, "events"), folder)
    return spark.read.parquet(f"{folder}/raw").groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


registry.QUERIES["raw_exchange_log"] = _raw_log
registry.ORACLES["raw_exchange_log"] = "SELECT ts::DATE::VARCHAR AS day, count(*)::BIGINT AS n FROM events GROUP BY 1"


def _registry_csv(spark, sf_dir):
    """Attempts written as a registry and read back, then the best attempt of each task."""
    folder = folders.scratch(spark)
    attempts = registry.read(spark, sf_dir, "attempts").select("task", "skill", "attempt", "ok", "length")
    folders.write_registry(attempts, f"{folder}/registry")
    return rounds.best_attempt(folders.read_registry(spark, f"{folder}/registry"))


registry.QUERIES["registry_csv"] = _registry_csv
registry.ORACLES["registry_csv"] = registry.oracle(
    "SELECT task, attempt, length, 0::BIGINT AS violations FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY length, attempt) AS r FROM {attempts} WHERE lower(ok) IN ('true', '1', 'oui')) WHERE r = 1"
)


registry.view("result_lines", """
SELECT 'r' || CAST(event_id % 2 AS varchar(9)) AS tour, event_type AS configuration, 'u' || CAST(user_id AS varchar(20)) AS tache_id, event_id % 3 > 0 AS ok, CAST(event_id AS double) AS duree_juge_s, CAST(floor(event_id / 1000) AS bigint) % 4 AS batch FROM {events}
""")


def _append(spark, sf_dir):
    """Results appended in four batches, one of them twice; the last line of each key, a later batch before an earlier."""
    path, lines = f"{folders.scratch(spark)}/results", registry.read(spark, sf_dir, "result_lines")
    for batch in (0, 1, 1, 2, 3):
        ordered = lines.filter(F.col("batch") == batch).drop("batch").repartitionByRange("duree_juge_s").sortWithinPartitions("duree_juge_s")
        folders.append_results(ordered, path, f"b{batch}")
    return folders.read_results(spark, f"{path}/*").select("tour", "configuration", "tache_id", "ok", "duree_juge_s")


registry.QUERIES["append_results"] = _append
registry.ORACLES["append_results"] = registry.oracle(
    "SELECT tour, configuration, tache_id, arg_max(ok, (batch, duree_juge_s)) AS ok, arg_max(duree_juge_s, (batch, duree_juge_s)) AS duree_juge_s FROM {result_lines} GROUP BY ALL"
)


def _sft(spark, sf_dir):
    """Valid conversations written as chats, turns and a declaration, then read back through the declaration."""
    path, chat = f"{folders.scratch(spark)}/sft", registry.read(spark, sf_dir, "chat")
    rendered = messages.sharegpt_rendered(chat).filter("valid").select("session", "system", F.col("turns").alias("conversations")).checkpoint()
    said = F.transform(F.sort_array(F.collect_list(F.struct("pos", "role", "content"))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    folders.write_sft(chat.join(rendered.select("session"), "session", "left_semi").groupBy("session").agg(said.alias("messages")), rendered, path, "talks")
    chats = spark.read.schema("session bigint, messages array<struct<role: string, content: string>>").json(f"{path}/talks.jsonl").select("session", F.size("messages").cast("long").alias("n"))
    line = F.concat("from", F.lit(":"), "value")
    back = folders.read_sft(spark, path, "talks").groupBy("session").agg(F.count(F.lit(1)).alias("turns"), F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))).alias("x"))
    return chats.join(back, "session").select("session", "n", "turns", F.sha2(F.array_join(F.transform("x", lambda x: x["line"]), "\n").cast("binary"), 256).alias("hash"))


registry.QUERIES["write_sft"] = _sft
registry.ORACLES["write_sft"] = registry.oracle(f"""{talk_plans.RENDERED}
SELECT session, n, turns, sha256(said) AS hash FROM c JOIN (SELECT session, count(*) AS n FROM {{chat}} GROUP BY session) USING (session) WHERE valid""")


def _sessions(spark, sf_dir):
    """Sessions written with a header line and read back."""
    path = f"{folders.scratch(spark)}/sessions"
    m = registry.read(spark, sf_dir, "messages")
    folders.write_sessions(m, m.select("session").distinct(), path)
    back = folders.session_messages(spark.read.parquet(path))
    return back.select("session", "pos", "role", F.sha2(F.col("content").cast("binary"), 256).alias("hash"))


registry.QUERIES["write_sessions"] = _sessions
registry.ORACLES["write_sessions"] = registry.oracle("SELECT session, (row_number() OVER (PARTITION BY session ORDER BY pos) - 1)::INT AS pos, role, sha256(content) AS hash FROM {messages}")
