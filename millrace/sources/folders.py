"""Sources and sinks: task documents, file trees, session files, registries, test reports, streams over table folders."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK = "id string, competence string, consigne string, origine string, empreinte string, gelee boolean, juge struct<etapes:array<string>,patch_max_lignes:int>"
REQUIRED = ("id", "competence", "consigne", "origine", "empreinte")
TEXT_FILES = r"\.(gd|tscn|tres|cfg|godot|md|json|txt)$"


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only where that isn't set and everything runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")

        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Task documents, one JSON file a folder; ``missing`` names the required fields that a document lacks."""
    tasks = spark.read.schema(TASK).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    lacking = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED)))
    return tasks.withColumn("missing", F.array_join(lacking, ",")).withColumn("folder", F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1))


def read_file_tree(spark: SparkSession, root: str, ignored: str = r"/(\.git|\.godot|reports)/") -> DataFrame:
    """Rows (path, text) of the text files below the root, with paths relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = F.lit(re.sub("^file:/*", "/", root.rstrip("/")))
    path = F.regexp_replace("path", "^file:/*", "/")
    relative = F.expr("substring(p, length(b) + 2)")
    named = files.withColumn("p", path).withColumn("b", base).withColumn("relative", relative)
    return named.filter(F.col("relative").rlike(TEXT_FILES) & ~F.concat(F.lit("/"), "relative").rlike(ignored)).select(F.col("relative").alias("path"), F.decode("content", "UTF-8").alias("text"))


def session_messages(files: DataFrame) -> DataFrame:
    """Messages (session, header, pos, role, content) of rows (session, value) that hold a session's header line and message lines."""
    lines = files.select("session", F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "").alias("lines"))
    rows = lines.select("session", F.col("lines")[0].alias("header"), F.posexplode("lines").alias("pos", "line"))
    said = F.from_json("line", "role string, content string, tool_call_id string")
    return rows.filter("pos > 0").select("session", "header", (F.col("pos") - 1).alias("pos"), said["role"].alias("role"), said["content"].alias("content"))


def read_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Session files whose first line is a header and whose other lines are messages: (session, header, pos, role, content).

    The session is the file's name, or its folder where folders are named session=<name>.
    """
    files = spark.read.text(root, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.jsonl)?$", 1)
    return session_messages(files if "session" in files.columns else files.withColumn("session", name))


def write_sessions(messages: DataFrame, headers: DataFrame, folder: str) -> None:
    """Parquet rows (session, value), value being the session's file: header first, messages in order, keys sorted.

    Rows, not files, so that millions of sessions aren't millions of files; ``session_messages`` reads them again.
    """
    line = F.to_json(F.struct("content", "role"))
    ordered = messages.groupBy("session").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    value = F.concat_ws("\n", F.to_json(F.struct("session")), F.array_join("lines", "\n"))
    headers.join(ordered, "session").select("session", value.alias("value")).write.mode("overwrite").parquet(folder)


def append_results(rows: DataFrame, folder: str, batch: str) -> None:
    """Result lines of a batch added to a folder of JSON lines.

    A batch that is written again (a run that was lost half-way, a stream's batch after a restart) takes its own place, so lines
    are neither lost nor doubled. ``read_results`` reads the folder; batches count in the order of their names.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/batch={batch}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, such as a declaration, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


#: How a set of turns is declared to a trainer; fixed values.
DECLARED = {"formatting": "sharegpt", "columns": {"messages": "conversations", "system": "system"}, "tags": {"role_tag": "from", "content_tag": "value", "user_tag": "human", "assistant_tag": "gpt"}}


def write_sft(chat: DataFrame, turns: DataFrame, folder: str, name: str) -> None:
    """A training set as JSON lines: chats, turns and the declaration that names the turns' file, written last.

    ``chat`` has (session, messages array of (role, content)), ``turns`` (session, system, conversations array of (from, value)).
    Files are folders of parts, as Spark writes them.
    """
    chat.select("session", "messages").write.mode("overwrite").json(f"{folder}/{name}.jsonl")
    turns.select("session", "system", "conversations").write.mode("overwrite").json(f"{folder}/{name}_sharegpt.jsonl")
    write_text(turns.sparkSession, f"{folder}/dataset_info.json", json.dumps({name: {"file_name": f"{name}_sharegpt.jsonl", **DECLARED}}, ensure_ascii=False, indent=2) + "\n")


def read_sft(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Rows (session, system, turn, from, value) of a declared set: file and columns are those that the declaration names."""
    info = json.loads(spark.read.text(f"{folder}/dataset_info.json", wholetext=True).head()[0])[name]
    columns, tags = info["columns"], info["tags"]
    schema = f"session bigint, {columns['system']} string, {columns['messages']} array<struct<`{tags['role_tag']}`: string, `{tags['content_tag']}`: string>>"
    rows = spark.read.schema(schema).json(f"{folder}/{info['file_name']}")
    turns = rows.select("session", F.col(columns["system"]).alias("system"), F.posexplode(columns["messages"]).alias("turn", "x"))
    return turns.select("session", "system", "turn", F.col("x")[tags["role_tag"]].alias("from"), F.col("x")[tags["content_tag"]].alias("value"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Attempt registry as CSV; columns that old files lack take their neutral values."""
    df = spark.read.option("header", True).csv(path)
    for name, default in (("violations", "0"), ("structure_ok", "true"), ("session_ok", "true")):
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default))
    return df.select(*(F.col(c) for c in df.columns)).withColumn("attempt", F.col("attempt").cast("bigint")).withColumn("length", F.col("length").cast("bigint")).withColumn("violations", F.col("violations").cast("bigint"))


def write_registry(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("task", "attempt").sortWithinPartitions("task", "attempt").write.mode("overwrite").option("header", True).csv(path)


#: Fields of a result line; fixed values. A line without configuration or task has no key and goes.
RESULT = "tour string, configuration string, competence string, tache_id string, empreinte string, ok boolean, etape string, categorie string, duree_appel_s double, duree_juge_s double, jetons_entree bigint, jetons_sortie bigint, modele string"


def read_results(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Result files of JSON lines: for each (tour, configuration, tache_id) the last line, with its place.

    Blank lines and lines that can't be read (cut off by a crash) are skipped; a missing ``tour`` is empty. Lines come in the order
    of their files' paths, then of the file: by the start of the split and the line within it, so large files are read in parts.
    """
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    x = F.from_json("value", f"{RESULT}, broken string", {"columnNameOfCorruptRecord": "broken"})
    rows = raw.filter("trim(value) <> ''").withColumn("x", x).filter("x.broken IS NULL AND x.configuration IS NOT NULL AND x.tache_id IS NOT NULL")
    rows = rows.select("file", "start", "line", F.coalesce("x.tour", F.lit("")).alias("tour"), *(f"x.{c.split()[0]}" for c in RESULT.split(", ")[1:]))
    rest = [c for c in rows.columns if c not in ("tour", "configuration", "tache_id")]
    last = rows.groupBy("tour", "configuration", "tache_id").agg(F.max_by(F.struct(*rest), F.struct("file", "start", "line")).alias("x"))
    return last.select("tour", "configuration", "tache_id", *(f"x.{c}" for c in rest))


def read_junit(spark: SparkSession, path: str) -> DataFrame:
    """XML test report: one row a test case with its outcome."""
    schema = "_classname string, _name string, failure string, error string, skipped string"
    cases = spark.read.format("xml").option("rowTag", "testcase").schema(schema).load(path)
    outcome = F.when(F.col("failure").isNotNull(), "failure").when(F.col("error").isNotNull(), "error").when(F.col("skipped").isNotNull(), "skipped").otherwise("ok")
    return cases.select(F.lit(path).alias("report"), F.concat_ws(":", "_classname", "_name").alias("name"), outcome.alias("outcome"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file stream over one table of a folder of tables, be it a file or a folder of parts."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = table.inputFiles()
    folder = parts and parts[0].rsplit("/", 1)[0].endswith(f"/{name}.parquet")
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 4)
    return reader.parquet(f"{sf_dir}/{name}.parquet") if folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
