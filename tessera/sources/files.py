"""Sources and sinks: text corpora, JSON lines, knowledge bases, graphs, bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip, truncated

QA = "id string, question string, answer string, difficulty string, domain string, source_chunk_ids array<string>, source_subgraph_id string, escalation_history array<string>, required_tools array<string>, reasoning_steps int, metadata string, created_at timestamp"
ENTITIES = "id string, name string, entity_type string, value string, key_terms array<string>, tool_source string, tool_query string, snippet string"
RELATIONS = "source_id string, target_id string, relation_type string, evidence string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the text files of a folder, stripped, empty ones left out; of a
    single file as it is."""
    read = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    if path.rstrip("/").endswith(".txt"):
        return read
    return read.filter(F.col("path").endswith(".txt")).withColumn("text", strip(F.col("text"))).filter("text <> ''")


def documents(spark: SparkSession, path: str, max_chars: int, mark: str = "\n... [truncated]") -> DataFrame:
    """(path, text) of files read as UTF-8 with replacement, cut at max_chars."""
    read = spark.read.format("binaryFile").load(path)
    return read.select("path", truncated(F.decode("content", "UTF-8"), max_chars, mark).alias("text"))


def jsonl(spark: SparkSession, path: str, schema: str = QA) -> DataFrame:
    """JSON lines of a file, folder or pattern; blank lines are skipped and bad ones
    kept as rows of nulls with the line in _bad."""
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)


def graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entities and relations of a bundle {entities: [...], relations: [...]}, each
    with its place in the file."""
    whole = spark.read.schema(f"entities array<struct<{ENTITIES}>>, relations array<struct<{RELATIONS}>>").json(path, multiLine=True)
    e = whole.select(F.posexplode("entities").alias("seq", "x")).select("x.*", F.col("seq").cast("long"))
    r = whole.select(F.posexplode("relations").alias("edge_seq", "x")).select("x.*", F.col("edge_seq").cast("long"))
    return e, r


def knowledge_base(spark: SparkSession, folder: str) -> DataFrame:
    """(record, _category, _source_file): every record of the JSON and CSV files below
    a folder, at any depth, as a map of texts. A JSON file is a list of records or an
    object of such lists, whose keys are categories; other values and files that
    can't be read give none."""
    read = lambda kind: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{kind}").load(folder).select(F.decode("content", "UTF-8").alias("text"), F.col("path").alias("_source_file"))
    json = read("json")
    lists = "array<string>"
    plain = json.select("_source_file", F.lit(None).cast("string").alias("_category"), F.from_json("text", lists).alias("all")).filter("all is not null")
    named = json.filter(F.ltrim("text").startswith("{")).select("_source_file", F.explode(F.from_json("text", "map<string,string>")).alias("_category", "list"))
    named = named.select("_source_file", "_category", F.from_json("list", lists).alias("all")).filter("all is not null")
    each = plain.unionByName(named).select("_source_file", "_category", F.explode("all").alias("x")).filter(F.ltrim("x").startswith("{"))
    records = each.select(F.from_json("x", "map<string,string>").alias("record"), "_category", "_source_file")
    return records.unionByName(csv_records(read("csv")).select("record", F.lit(None).cast("string").alias("_category"), "_source_file"))


def csv_records(files: DataFrame) -> DataFrame:
    """(_source_file, record) of CSV files (_source_file, text) with a head, each file
    by its own columns."""
    import csv
    import io

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for name, text in zip(b["_source_file"], b["text"], strict=True):
                rows += [(name, {k: v for k, v in r.items() if k is not None and isinstance(v, str)}) for r in csv.DictReader(io.StringIO(text))]
            yield pd.DataFrame(rows, columns=["_source_file", "record"])

    return files.mapInPandas(run, "_source_file string, record map<string,string>")


def seeds(df: DataFrame, column: str) -> DataFrame:
    """(category, pos, seed) from {category: [seed, ...]} as JSON text."""
    by = df.select(F.explode(F.from_json(column, "map<string,array<string>>")).alias("category", "all"))
    return by.select("category", F.posexplode("all").alias("pos", "seed"))


def save_stage(df: DataFrame, folder: str, stage: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/checkpoints/{stage}")


def load_stage(spark: SparkSession, folder: str, stage: str) -> DataFrame | None:
    """The stage's rows if it was written to its end, else None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/checkpoints/{stage}/_SUCCESS")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.parquet(f"{folder}/checkpoints/{stage}") if there else None


def save_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def append_pair(qa: DataFrame, trajectories: DataFrame, folder: str) -> None:
    """Questions and, where there are any, their trajectories to two JSON-lines
    folders, behind what they hold."""
    save_jsonl(qa, f"{folder}/qa", append=True)
    save_jsonl(trajectories.filter("trajectory is not null"), f"{folder}/trajectories", append=True)


def save_bundle(entities: DataFrame, relations: DataFrame, qa: DataFrame, folder: str) -> None:
    """A viewer bundle: graph and questions as sections of a folder."""
    replace_graph(entities, relations, folder)
    qa.write.mode("overwrite").json(f"{folder}/qa_pairs")


def replace_graph(entities: DataFrame, relations: DataFrame, folder: str) -> None:
    """The graph's section of a bundle anew; the questions stay."""
    entities.write.mode("overwrite").json(f"{folder}/knowledge_graph/entities")
    relations.write.mode("overwrite").json(f"{folder}/knowledge_graph/relations")


def stage(spark: SparkSession, make, folder: str, name: str) -> DataFrame:
    """A stage's rows: those written before, if it had been written to its end, else
    what the function ``make`` gives, written."""
    done = load_stage(spark, folder, name)
    if done is None:
        save_stage(make(), folder, name)
        done = load_stage(spark, folder, name)
    return done


def bundle_upsert(bundle: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Rows are added if their key is absent; present ones stay as they are."""
    return bundle.unionByName(fresh.join(bundle.select(key), key, "left_anti"), allowMissingColumns=True)


def bundle_enrich(bundle: DataFrame, update: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """Columns are replaced where the key is in update; null becomes empty text."""
    new = update.select(key, F.lit(True).alias("_there"), *[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in columns])
    joined = bundle.join(new, key, "left")
    return joined.select(*[F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in bundle.columns])


def serialised(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(kind, seq, json) of a graph, for a sink that keeps order by seq."""
    e = entities.select(F.lit("entity").alias("kind"), F.col("seq"), F.to_json(F.struct(*[c for c in entities.columns if c != "seq"])).alias("json"))
    r = relations.select(F.lit("relation").alias("kind"), F.col("edge_seq").alias("seq"), F.to_json(F.struct(*[c for c in relations.columns if c != "edge_seq"])).alias("json"))
    return e.unionByName(r)
