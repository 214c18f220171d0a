"""The twelve tools, offline: each maps a table of (key, query) to (key, result).

A tool is a DataFrame function, so a batch of calls is one plan: ``Registry.execute``
sends each row to the tool that it names and puts the replies together. Searches and
pages come from tables instead of the network. A result is null where nothing was
found; an unknown tool, or a request that can't be read, is an error text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import calc, dates, sandbox, tables, text, units

#: Defaults of the tools.
DEFAULTS = {
    "search": {"max_results": 10},
    "scholar": {"max_results": 5},
    "visit": {"timeout": 15, "max_content_tokens": 8000},
    "python": {"timeout": 30},
    "wikipedia": {"language": "en", "max_chars": 8000},
    "knowledge_base": {"max_results": 10},
    "document_reader": {"max_chars": 15000},
    "comparison": {"max_entities": 5},
    "table": {"timeout": 15, "max_tables": 3, "max_rows": 20},
}


def settings(values: dict, environment: dict | None = None) -> dict:
    """Settings with ``${NAME}`` replaced from the environment, at any depth; a name
    that isn't set becomes empty."""
    known = os.environ if environment is None else environment

    def filled(x):
        if isinstance(x, dict):
            return {k: filled(v) for k, v in x.items()}
        if isinstance(x, list):
            return [filled(v) for v in x]
        return re.sub(r"\$\{(\w+)\}", lambda m: known.get(m[1], ""), x) if isinstance(x, str) else x

    return filled(values)


def tool_defaults(name: str, own: dict | None = None) -> dict:
    return DEFAULTS.get(name, {}) | (own or {})


def words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def search(calls: DataFrame, corpus: DataFrame, most: int = 10) -> DataFrame:
    """(key, rank, id, score): for each query the rows with most of its words, then by
    id. corpus: (id, text). Queries and rows meet by word; what a word of the corpus
    counts for is a row, so a frequent one is spread like any join key."""
    asked = calls.select("key", F.explode(words(F.col("query"))).alias("word"))
    wanted = asked.select("word").distinct()
    said = corpus.select("id", F.explode(words(F.col("text"))).alias("word")).join(wanted, "word", "left_semi")
    hits = asked.join(said, "word").groupBy("key", "id").agg(F.count("*").alias("score"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= most).select("key", "rank", "id", "score")


def result_text(found: DataFrame, most: int = 10) -> DataFrame:
    """(key, result): rows (key, rank, title, snippet, url) as numbered lines."""
    pair = lambda k: F.struct(F.lit(k).alias("key"), F.col(k).alias("value"))
    rows = F.array_sort(F.collect_list(F.struct("rank", F.array(*map(pair, ("title", "snippet", "url"))).alias("row"))))
    return found.groupBy("key").agg(text.numbered(F.transform(rows, lambda x: x["row"]), most).alias("result"))


def search_tool(corpus: DataFrame, most: int = 10) -> Callable[[DataFrame], DataFrame]:
    """corpus: (id, title, text, url)."""
    return lambda calls: result_text(search(calls, corpus, most).join(corpus.select("id", "title", F.substring("text", 1, 200).alias("snippet"), "url"), "id"), most)


def scholar(calls: DataFrame, papers: DataFrame, most: int = 5) -> DataFrame:
    """(key, rank, title, authors, year, venue, abstract, citation_count, url): papers
    (id, title, authors array of (name), year, ...), with authors flattened."""
    found = search(calls, papers.select("id", F.concat_ws(" ", "title", "abstract").alias("text")), most)
    flat = papers.withColumn("authors", F.transform("authors", lambda a: a["name"]))
    return found.join(flat, "id").select("key", "rank", "title", "authors", "year", "venue", "abstract", "citation_count", "url")


def scholar_tool(papers: DataFrame, most: int = 5) -> Callable[[DataFrame], DataFrame]:
    return lambda calls: result_text(scholar(calls, papers, most).select("key", "rank", "title", F.concat_ws(", ", "authors").alias("snippet"), "url"), most)


def article(calls: DataFrame, articles: DataFrame, max_chars: int = 8000) -> DataFrame:
    """(key, result): encyclopedia entries (title, description, extract, body) by
    title, whatever its case; the whole body if there is one, else the extract."""
    content = text.truncated(F.coalesce(F.nullif("body", F.lit("")), "extract", F.lit("")), max_chars)
    plain = lambda c: F.lower(F.replace(c, F.lit("_"), F.lit(" ")))
    found = articles.select(plain("title").alias("k"), F.concat(F.lit("# "), "title", F.lit("\n"), F.coalesce("description", F.lit("")), F.lit("\n\n"), content).alias("found"))
    joined = calls.join(found, plain("query") == F.col("k"), "left")
    return joined.groupBy("key").agg(F.coalesce(F.min("found"), F.concat(F.lit("Article not found: "), F.min("query"))).alias("result"))


def visit(calls: DataFrame, pages: DataFrame, max_chars: int = 32_000) -> DataFrame:
    """(key, result): ``url | goal``: the sentences of the page's text that hold a
    word of the goal, or its start if none does. An unknown or empty page says so."""
    url, goal = text.url_and_goal(F.col("query"))
    asked = calls.select("key", url, goal).join(pages.groupBy("url").agg(F.min(F.col("html")).alias("html")), "url", "left")
    said = asked.withColumn("text", F.substring(text.page_text(F.coalesce("html", F.lit(""))), 1, max_chars))
    sentences = F.split("text", r"(?<=[.!?])\s+|\n")
    about = F.filter(sentences, lambda s: F.size(F.array_intersect(words(s), F.col("wanted"))) > 0)
    said = said.withColumn("wanted", F.filter(words(F.col("goal")), lambda w: F.length(w) > 3))
    summary = F.when(F.size(about) > 0, F.array_join(about, " ")).otherwise(F.substring("text", 1, 2000))
    return said.select("key", F.when(F.col("text") == "", F.concat(F.lit("Could not read: "), "url")).otherwise(summary).alias("result"))


@F.pandas_udf(StringType())
def tables_text(pages: pd.Series, topics: pd.Series) -> pd.Series:
    return pd.Series([tables.as_text(tables.tables(p, t or None)) for p, t in zip(pages, topics, strict=True)], dtype=object)


def table(calls: DataFrame, pages: DataFrame) -> DataFrame:
    """(key, result): ``url | topic`` to the page's tables as text; null for a target
    that is no http address, an unknown page, or a page without tables."""
    url, topic = text.url_and_goal(F.col("query"))
    asked = calls.select("key", url, topic).filter(F.col("url").startswith("http"))
    found = asked.join(pages.groupBy("url").agg(F.min("html").alias("html")), "url")
    return found.select("key", F.nullif(tables_text("html", "goal"), F.lit("")).alias("result"))


def document_reader(calls: DataFrame, documents: DataFrame, max_chars: int = 15_000, page_chars: int = 3000) -> DataFrame:
    """(key, result): ``path pages=a-b`` to the text of documents (path, text), in
    pages of page_chars; cut at max_chars with a mark."""
    path = F.regexp_extract("query", r"^\s*(\S+)", 1)
    asked = calls.select("key", path.alias("path"), F.regexp_extract("query", r"pages=(\S+)", 1).alias("pages"))
    found = asked.join(documents, "path", "left")
    first, last = text.page_range(F.col("pages"), F.ceil(F.length("text") / page_chars).cast("int"))
    part = F.substring(F.col("text"), (first * page_chars + 1).cast("int"), ((last - first) * page_chars).cast("int"))
    return found.select("key", F.when(F.col("text").isNull(), F.concat(F.lit("File not found: "), "path")).otherwise(text.truncated(part, max_chars, "\n... [truncated]")).alias("result"))


def knowledge_base(calls: DataFrame, records: DataFrame, columns: list[str], most: int = 10) -> DataFrame:
    """(key, result): the best records (id, ...) by match score: the query's terms that
    are in the record's text, and as many more if the whole query is. Terms may be
    inside words, so every record is held against every distinct query; the queries
    are a stated set."""
    said = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns if not c.startswith("_")]))
    asked = calls.select("key", F.lower(F.trim("query")).alias("q")).filter("q <> ''")
    met = records.select("id", said.alias("said")).join(F.broadcast(asked.select("q").distinct()), F.exists(F.split("q", r"\s+"), lambda w: F.contains("said", w)))
    terms = F.split("q", r"\s+")
    score = F.size(F.filter(terms, lambda w: F.contains("said", w))) + F.when(F.contains("said", "q"), F.size(terms)).otherwise(0)
    best = met.withColumn("score", score)
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    rows = best.withColumn("rank", place).filter(F.col("rank") <= most).groupBy("q").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "said"))), lambda x: F.concat(x["rank"].cast("string"), F.lit(". "), x["said"])), "\n").alias("result"))
    return asked.join(rows, "q", "left").select("key", "result")


@F.pandas_udf(StringType())
def six_digits(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x != x else f"{x:.6g}")


@F.pandas_udf(StringType())
def import_problem(code: pd.Series) -> pd.Series:
    """What forbids a snippet; null if nothing does."""
    return code.map(lambda x: sandbox.problem(x or ""))


def unit_converter(calls: DataFrame) -> DataFrame:
    made = units.convert(calls.select("key", "query", *units.parse(F.col("query"))))
    shown = F.concat(F.col("amount").cast("string"), F.lit(" "), "source", F.lit(" = "), six_digits("converted"), F.lit(" "), "target")
    return made.select("key", F.when(F.col("amount").isNull(), F.concat(F.lit("Could not parse: "), "query")).otherwise(F.coalesce(shown, "problem")).alias("result"))


@dataclass(frozen=True)
class Tool:
    name: str
    description: str
    run: Callable[[DataFrame], DataFrame]
    settings: dict = field(default_factory=dict)


class Registry:
    """Tools by name, in order of registration."""

    def __init__(self, tools: list[Tool]):
        self.tools = {t.name.lower(): t for t in tools}

    def get(self, name: str) -> Tool:
        if name.lower() not in self.tools:
            raise ValueError(f"unknown tool: {name}")
        return self.tools[name.lower()]

    def descriptions(self) -> str:
        return "\n".join(f"- {t.name}: {t.description}" for t in self.tools.values())

    def enabled(self, names: list[str] | None) -> Registry:
        """All tools, or those named."""
        return Registry([t for t in self.tools.values() if names is None or t.name in names])

    def execute(self, calls: DataFrame) -> DataFrame:
        """(key, tool, result, error) of calls (key, tool, query)."""
        name = F.lower(F.trim("tool"))
        out = calls.filter(~name.isin(*self.tools) | name.isNull()).select("key", "tool", F.lit(None).cast("string").alias("result"), F.concat(F.lit("unknown tool: "), F.coalesce("tool", F.lit(""))).alias("error"))
        for t in self.tools.values():
            mine = calls.filter(name == t.name.lower()).select("key", "query")
            got = mine.select("key").join(t.run(mine).select("key", F.col("result").cast("string").alias("result")), "key", "left")
            out = out.unionByName(got.select("key", F.lit(t.name).alias("tool"), "result", F.lit(None).cast("string").alias("error")))
        return out


def event_log(replies: DataFrame, calls: DataFrame, stage: str) -> DataFrame:
    """(stage, tool, query, ok, event) of executed calls, for a JSON-lines sink."""
    joined = replies.join(calls.select("key", "query"), "key")
    row = F.struct(F.lit("tool_call").alias("event"), F.lit(stage).alias("stage"), "tool", F.substring("query", 1, 200).alias("query"), F.col("result").isNotNull().alias("ok"))
    return joined.select(F.lit(stage).alias("stage"), "tool", F.substring("query", 1, 200).alias("query"), F.col("result").isNotNull().alias("ok"), F.to_json(row).alias("event"))


def register_functions(spark: SparkSession) -> None:
    """The scalar tools as SQL functions, and table extraction as a table function."""
    spark.udf.register("calculate", calc.calculator)
    spark.udf.register("import_problem", import_problem)
    spark.udf.register("unescape_html", text.unescaped)
    spark.udtf.register("extract_tables", tables.ExtractTables)


def offline(corpus: DataFrame, papers: DataFrame, articles: DataFrame, pages: DataFrame, records: DataFrame, columns: list[str]) -> Registry:
    """All twelve tools over tables."""
    plain = lambda f: lambda calls: calls.select("key", f(F.col("query")).alias("result"))
    own = lambda name: tool_defaults(name)
    return Registry(
        [
            Tool("search", "finds texts by their words", search_tool(corpus, own("search")["max_results"])),
            Tool("scholar", "finds papers", scholar_tool(papers, own("scholar")["max_results"])),
            Tool("visit", "reads a page for a goal: url | goal", lambda c: visit(c, pages, 4 * own("visit")["max_content_tokens"])),
            Tool("python", "says whether a snippet may run; none is run", plain(lambda q: F.coalesce(import_problem(q), F.lit("allowed, but running is not offered")))),
            Tool("wikipedia", "an encyclopedia entry by its title", lambda c: article(c, articles, own("wikipedia")["max_chars"])),
            Tool("calculator", "works out an expression", plain(calc.calculator)),
            Tool("knowledge_base", "finds records", lambda c: knowledge_base(c, records, columns, own("knowledge_base")["max_results"])),
            Tool("document_reader", "reads a document: path pages=a-b", lambda c: document_reader(c, corpus.select(F.col("id").cast("string").alias("path"), "text"), own("document_reader")["max_chars"])),
            Tool("unit_converter", "converts units: number unit to unit", unit_converter),
            Tool("timeline", "works with dates: diff, order, overlap, add", plain(dates.answer)),
            Tool("comparison", "shows a comparison as a grid", plain(text.comparison_grid)),
            Tool("table", "reads the tables of a page: url | topic", lambda c: table(c, pages)),
        ]
    )


def search_visit(calls: DataFrame, corpus: DataFrame, pages: DataFrame, urls: int = 3) -> DataFrame:
    """(key, text): a search's usable results (with address and snippet), the text of
    the first pages and their tables, joined; less than 20 characters are nothing."""
    found = search(calls, corpus.select("id", "text")).join(corpus.select("id", "title", F.substring("text", 1, 200).alias("snippet"), "url"), "id")
    usable = found.filter("coalesce(url, '') <> '' and coalesce(snippet, '') <> ''")
    place = F.row_number().over(Window.partitionBy("key").orderBy("rank"))
    top = usable.withColumn("rank", place).filter(F.col("rank") <= urls)
    page = pages.groupBy("url").agg(F.min("html").alias("html"))
    read = top.join(page, "url", "left").select("key", "rank", F.concat(F.lit("["), F.coalesce("title", F.lit("")), F.lit("] "), "snippet").alias("line"), F.substring(text.page_text(F.coalesce("html", F.lit(""))), 1, 3000).alias("page"), F.substring(tables_text(F.coalesce("html", F.lit("")), F.lit("")), 1, 2000).alias("tables"))
    each = F.array_sort(F.collect_list(F.struct("rank", "line", "page", "tables")))
    part = lambda name, sep: F.array_join(F.filter(F.transform("rows", lambda x: x[name]), lambda x: F.trim(x) != ""), sep)
    joined = read.groupBy("key").agg(each.alias("rows")).select("key", F.array_join(F.filter(F.array(part("line", "\n"), part("page", "\n\n---\n\n"), part("tables", "\n\n")), lambda x: x != ""), "\n\n").alias("text"))
    return joined.filter(F.length(text.strip(F.col("text"))) >= 20).select("key", F.substring("text", 1, 5000).alias("text"))


