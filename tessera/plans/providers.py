"""The boundary to models and tools, and a rule-based provider that needs neither.

A provider maps a request text to a reply text and never raises: an error is a
column. Calls run once per row in mapInPandas, and callers write the result
before they read it twice. ``cached`` looks replies up in a table first and calls
only for what is missing; ``react`` lets a model call tools in turns.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cache_key

#: Parameters by role; an unknown role has none.
ROLES = {
    "summary_agent": {"temperature": 0.3, "max_tokens": 2000},
    "item_writer": {"temperature": 0.7, "max_tokens": 4000},
    "solver_base": {"temperature": 0.6, "max_tokens": 3000},
    "solver_advanced": {"temperature": 0.6, "max_tokens": 8000},
    "judge": {"temperature": 0.1, "max_tokens": 1000},
}


def parameters(role: str) -> dict:
    return dict(ROLES.get(role, {}))


@dataclass(frozen=True)
class Provider:
    """reply: request text to reply text. Retried with growing waits."""

    reply: Callable[[str], str]
    attempts: int = 4
    wait_s: float = 0.0

    def call(self, request: str | None) -> tuple[str | None, str | None]:
        """(reply, error); one of them is null."""
        error = "no attempt"
        for k in range(self.attempts):
            try:
                return self.reply(request or ""), None
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                time.sleep(self.wait_s * 2**k)
        return None, error


def ask(df: DataFrame, provider: Provider, key: str, request: str) -> DataFrame:
    """(key, reply, error) of every row."""

    def run(batches):
        for b in batches:
            got = [provider.call(x) for x in b["request"]]
            yield pd.DataFrame({"key": b["key"].astype(str), "reply": [g[0] for g in got], "error": [g[1] for g in got]})

    picked = df.select(F.col(key).cast("string").alias("key"), F.col(request).alias("request"))
    return picked.mapInPandas(run, "key string, reply string, error string").withColumnRenamed("key", key)


def cached(df: DataFrame, cache: DataFrame, provider: Provider, tool: str, request: str) -> tuple[DataFrame, DataFrame]:
    """(replies by request, rows to append to the cache). Only successes are to be
    kept; equal requests are asked once. cache: (tool, cache_key, payload)."""
    asked = df.select(F.col(request).alias("request")).distinct().withColumn("cache_key", cache_key(F.lit(tool), F.col("request")))
    known = cache.filter(F.col("tool") == tool).select("cache_key", "payload")
    found = asked.join(known, "cache_key")
    fresh = ask(asked.join(known, "cache_key", "left_anti"), provider, "cache_key", "request")
    return found.select("cache_key", F.col("payload").alias("reply")).unionByName(fresh.select("cache_key", "reply")), fresh.filter("reply is not null").select(F.lit(tool).alias("tool"), "cache_key", F.col("reply").alias("payload"))


def sentences(text: str) -> list[str]:
    return [s.strip() for s in re.split(r"(?<=[.!?])\s+", text) if s.strip()]


def summarise(text: str) -> str:
    """The first two sentences."""
    return " ".join(sentences(text)[:2])[:500]


def key_terms(text: str, most: int = 5) -> list[str]:
    """The first capitalised words, once each."""
    return list(dict.fromkeys(re.findall(r"\b[A-Z][a-z]{3,}\b", text)))[:most]


def atomise(df: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, pos, fact, terms): a text's first sentences as facts."""

    def run(batches):
        for b in batches:
            rows = [(i, k, s, key_terms(s)) for i, t in zip(b["id"], b["text"], strict=True) for k, s in enumerate(sentences(t or "")[:most])]
            yield pd.DataFrame(rows, columns=["id", "pos", "fact", "terms"])

    picked = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return picked.mapInPandas(run, "id string, pos int, fact string, terms array<string>")



def react(df: DataFrame, model: Callable[[list[str]], str], tools: dict[str, Callable[[str], str]], key: str, request: str, most_calls: int = 5) -> DataFrame:
    """(key, answer, steps, error): a bounded loop of turns for each row, inside one map.
    The model gets the conversation so far; a reply with a tool call is answered with
    an observation of at most 2000 characters, any other reply is the answer. After
    ``most_calls`` calls and one more turn the answer stays null. steps: array of
    (role, content, tool, tool_query, observation)."""

    def one(question: str):
        talk, steps = [question], []
        for _ in range(most_calls + 1):
            reply = model(talk)
            call = re.search(r"TOOL_CALL:\s*(\w+)\s*\|\s*(.+)", reply)
            if not call or len(steps) >= most_calls:
                if not call:
                    return reply, [*steps, ("assistant", reply, None, None, None)]
                break
            name, query = call[1].strip().lower(), call[2].strip()
            try:
                seen = str(tools[name](query))[:2000]
            except Exception as e:
                seen = f"Tool error: {e}"
            steps.append(("assistant", reply, name, query, seen[:500]))
            talk += [reply, f"OBSERVATION: {seen}"]
        return None, steps

    def run(batches):
        for b in batches:
            rows = []
            for k, q in zip(b["key"], b["request"], strict=True):
                try:
                    answer, steps = one(q or "")
                    rows.append((str(k), answer, steps, None))
                except Exception as e:
                    rows.append((str(k), None, [], f"{type(e).__name__}: {e}"))
            names = ("role", "content", "tool", "tool_query", "observation")
            yield pd.DataFrame([(k, a, [dict(zip(names, s, strict=True)) for s in steps], e) for k, a, steps, e in rows], columns=["key", "answer", "steps", "error"])

    picked = df.select(F.col(key).cast("string").alias("key"), F.col(request).alias("request"))
    step = "struct<role:string,content:string,tool:string,tool_query:string,observation:string>"
    return picked.mapInPandas(run, f"key string, answer string, steps array<{step}>, error string").withColumnRenamed("key", key)
