"""Review of uncertain entries: prompts, batches, the response cache, and what a response may change."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import ranked, written
from ..functions.names import blank

RESPONSE = "corrected STRUCT<class_name: STRING>, confidence DOUBLE, notes STRING"
TRIES = 3
#: Most fixtures that are looked for in every text.
MOST_FIXTURES = 1_000


#: Names of known classes that a prompt lists.
MOST_KNOWN = 200
SYSTEM = (
    "You are an expert in ontologies of power systems. Entries below were extracted from scanned standards by rules and may be misread. "
    "Correct what the scan got wrong. Class names are written in camel case; a name that is missing from the list of known classes may "
    "still be right if the context supports it."
)
_ANSWER = '{"corrected": {"class_name": "...", "namespace": "..."}, "confidence": 0.0, "notes": "..."}'
_TASK = """Task
1. Give the right value of a class or property name that was misread.
2. Give the right IRI of a namespace that was misspelt.
3. Write a multiplicity in its standard form.
4. Say in the notes if the target of an association is no known class.
5. State your confidence from 0 to 1."""
ONE = f"""{_TASK}

Answer with one JSON object and nothing else:
{_ANSWER}
Leave "corrected" empty if nothing is to be corrected."""
MANY = f"""{_TASK}

Answer with a JSON list and nothing else, one object for each entry above, by its case_id:
[{_ANSWER.replace('{"corrected"', '{"case_id": "...", "corrected"', 1)}]
Leave "corrected" empty where nothing can be said."""


class Prompt(str):
    """What a provider is asked; ``system`` says as whom."""

    system: str = SYSTEM

    def __new__(cls, text: str, system: str = SYSTEM) -> Prompt:
        self = super().__new__(cls, text)
        self.system = system
        return self


class Provider(Protocol):
    """Answers a prompt with text; it is sent to the workers."""

    def __call__(self, prompt: Prompt) -> str: ...


def retried(provider: Provider, tries: int = TRIES, pause: Callable[[float], None] = time.sleep) -> Provider:
    """``provider``, asked again after 1, 2, 4, ... seconds if it fails; the last failure is passed on."""

    def ask(prompt: str) -> str:
        for k in range(tries):
            try:
                return provider(prompt)
            except Exception:
                if k == tries - 1:
                    raise
                pause(2.0**k)
        raise AssertionError

    return ask


def latest(cache: DataFrame) -> DataFrame:
    """The response log read back: the last response of each case, by created_at."""
    return cache.where("case_id is not null").groupBy("case_id").agg(F.max_by("response", F.struct("created_at", "response")).alias("response"))


def split_by_cache(entries: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with their cached response, and those without one."""
    x = entries.join(latest(cache), "case_id", "left")
    return x.where("response is not null"), x.where("response is null").drop("response")


def batches(entries: DataFrame, size: int, within: list[str]) -> DataFrame:
    """The entries with the number of their batch, by case_id in each group of ``within``."""
    return ranked(entries, within, ["case_id"], "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("int"))


def known_lists(classes: list[str], namespaces: list[str] | tuple[str, ...] = ()) -> str:
    """The part of a prompt that lists what is known: the first ``MOST_KNOWN`` names in order, as a prompt has a length."""
    return f"Known namespaces: {', '.join(namespaces) or '(none)'}\nKnown classes: {', '.join(sorted(classes)[:MOST_KNOWN]) or '(none)'}"


def question(entries: DataFrame) -> Column:
    """What is asked about one entry: all that is known of it. Absent columns are left out; a rule's first attempt is listed by field."""
    parts = [("Package", "package"), ("Table", "source_table"), ("Raw text", "raw_text"), ("Reason", "uncertainty_reason"), ("Context", "context_snippet"), ("First attempt", "rule_attempt")]

    def value(c: str) -> Column:
        if c == "rule_attempt":
            pairs = F.array_sort(F.map_entries(c))
            return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "; ")
        return F.left(F.col(c), F.lit(200)) if c == "context_snippet" else F.col(c).cast("string")

    return F.concat_ws("\n", *[F.concat(F.lit(f"{name}: "), F.coalesce(value(c), F.lit(""))) for name, c in parts if c in entries.columns])


def prompts(entries: DataFrame, known: str = "") -> DataFrame:
    """(case_id, prompt) of entries that are asked one by one."""
    return entries.select("case_id", F.concat_ws("\n\n", *([F.lit(known)] if known else []), question(entries), F.lit(ONE)).alias("prompt"))


def batch_prompts(batched: DataFrame, keys: list[str], known: str = "") -> DataFrame:
    """(…keys, cases, batch_key, prompt) of every batch: its key is the sorted case ids joined with ``|``."""
    rows = batched.withColumn("_q", question(batched))
    g = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("case_id", "_q"))).alias("q"))
    ids = F.transform("q", lambda x: x["case_id"])
    text = F.array_join(F.transform("q", lambda x: F.concat(F.lit("case_id: "), x["case_id"], F.lit("\n"), x["_q"])), "\n\n")
    text = F.concat_ws("\n\n", *([F.lit(known)] if known else []), text, F.lit(MANY))
    return g.select(*keys, F.size("q").alias("cases"), F.array_join(ids, "|").alias("batch_key"), text.alias("prompt"))


def parsed_response(response: Column) -> Column:
    """The response as a struct; null if it is no JSON object."""
    return F.when(F.coalesce(F.schema_of_variant(F.try_parse_json(response)).startswith("OBJECT"), F.lit(False)), F.from_json(response, RESPONSE))


def decided(answered: DataFrame, known: DataFrame) -> DataFrame:
    """(…, corrected, outcome) of entries with a ``response``: json_invalid, business_invalid (a corrected name that isn't known), confirmed (no
    name) or corrected."""
    x = answered.withColumn("_r", parsed_response(F.col("response"))).withColumn("corrected", F.col("_r.corrected.class_name"))
    x = x.join(known.select(F.col("name").alias("corrected"), F.lit(True).alias("_known")).distinct(), "corrected", "left")
    outcome = F.when(F.col("_r").isNull(), "json_invalid").when(blank(F.col("corrected")), "confirmed").when(F.col("_known"), "corrected").otherwise("business_invalid")
    x = x.withColumn("outcome", outcome)
    return x.withColumn("corrected", F.when(F.col("outcome") == "corrected", F.col("corrected"))).drop("_r", "_known")


def corrected_classes(classes: DataFrame, decisions: DataFrame) -> DataFrame:
    """The classes with corrections applied: of each document, the last class whose name is a corrected entry's text is renamed. Keys are
    (doc_id, pkg_ord, cls_ord); decisions have (doc_id, raw_text, corrected)."""
    fix = decisions.where("corrected is not null").groupBy("doc_id", F.col("raw_text").alias("name")).agg(F.max_by("corrected", "case_id").alias("corrected"))
    last = classes.groupBy("doc_id", "name").agg(F.max(F.struct("pkg_ord", "cls_ord")).alias("k")).join(fix, ["doc_id", "name"]).select("doc_id", "k.*", "corrected")
    return classes.join(last, ["doc_id", "pkg_ord", "cls_ord"], "left").withColumn("name", F.coalesce("corrected", "name")).drop("corrected")


def ask(prompts: DataFrame, provider: Provider, key: str = "case_id", system: str = SYSTEM, tries: int = 1) -> DataFrame:
    """(key, response, failure) of every (key, prompt), asked inside the partitions, up to ``tries`` times; a failure keeps the row with a null
    response."""
    call = retried(provider, tries)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            said, failed = [], []
            for p in pdf["prompt"]:
                try:
                    said.append(call(Prompt(p, system)))
                    failed.append(None)
                except Exception as e:
                    said.append(None)
                    failed.append(type(e).__name__)
            yield pd.DataFrame({key: pdf[key], "response": pd.Series(said, dtype=object), "failure": pd.Series(failed, dtype=object)})

    return prompts.select(key, "prompt").mapInPandas(run, f"{key} string, response string, failure string")


def fixture_responses(entries: DataFrame, fixtures: DataFrame) -> DataFrame:
    """(case_id, response) from (stem, body): the fixture ``semantic_<raw_text>``, else the first by stem that stands in raw_text, else
    ``default``, else a response without confidence."""
    exact = fixtures.where(F.col("stem").startswith("semantic_")).select(F.expr("substring(stem, 10)").alias("raw_text"), F.col("body").alias("exact"))
    inside = fixtures.where(~F.col("stem").startswith("semantic_") & (F.col("stem") != "default")).select("stem", F.col("body").alias("inside"))
    default = fixtures.where("stem = 'default'").select("body").limit(1).collect()
    if inside.limit(MOST_FIXTURES + 1).count() > MOST_FIXTURES:
        raise ValueError(f"more than {MOST_FIXTURES} fixtures to look for")
    x = entries.join(exact, "raw_text", "left").join(F.broadcast(inside), F.col("raw_text").contains(F.col("stem")), "left")
    rest = default[0].body if default else '{"corrected": {}, "confidence": 0.0, "notes": "no fixture"}'
    return x.groupBy("case_id").agg(F.coalesce(F.max("exact"), F.min_by("inside", "stem"), F.lit(rest)).alias("response"))


def audit_lines(answered: DataFrame) -> DataFrame:
    """JSON lines of what was asked and answered, responses cut to 500 characters."""
    return answered.select(F.to_json(F.struct("case_id", F.left("response", F.lit(500)).alias("response"), "outcome"), {"ignoreNullFields": "false"}).alias("value"))


def reviewed(entries: DataFrame, cache: DataFrame, provider: Provider, known: DataFrame, tries: int = 1) -> tuple[DataFrame, DataFrame]:
    """(entries with response, corrected and outcome; the responses that are new to the cache). Cached entries aren't asked again; a failed call
    leaves the outcome ``provider_exception``. The answers are written once, so that nothing is asked twice."""
    hit, miss = split_by_cache(entries, cache)
    got = written(ask(prompts(miss, _listed(known)), provider, tries=tries))
    return _judged(entries, hit, got, known), got.where("response is not null").select("case_id", "response")


def reviewed_in_batches(entries: DataFrame, cache: DataFrame, provider: Provider, known: DataFrame, size: int = 14, within: str = "package", tries: int = 1) -> tuple[DataFrame, DataFrame]:
    """As ``reviewed``, with one call for each batch of entries. An answer is a list of objects with a case_id; of several the last counts. A
    batch whose call fails or whose answer is no list leaves all its entries unanswered (``provider_exception``, ``json_invalid``), a missing or
    odd object its own entry (``missing_entry``). New answers go to the cache even if they change nothing."""
    hit, miss = split_by_cache(entries, cache)
    b = batches(miss.withColumn(within, F.coalesce(within, F.lit(""))), size, [within])
    p = batch_prompts(b, [within, "batch"], _listed(known)).withColumn("case_id", F.concat_ws("#", within, "batch"))
    said = written(ask(p.select("case_id", "prompt"), provider, tries=tries)).withColumnRenamed("case_id", "call")
    items = F.try_variant_get(F.try_parse_json("response"), "$", "array<variant>")
    said = said.select("call", "failure", items.alias("items"))
    one = said.select("call", F.posexplode("items").alias("at", "item")).select("call", "at", F.try_variant_get("item", "$.case_id", "string").alias("case_id"), F.to_json("item").alias("response")).where("case_id is not null")
    one = one.groupBy("call", "case_id").agg(F.max_by("response", "at").alias("response"))
    x = b.select("case_id", F.concat_ws("#", within, "batch").alias("call")).join(said, "call").join(one, ["call", "case_id"], "left")
    got = written(x.select("case_id", "response", F.when(F.col("failure").isNotNull(), F.col("failure")).alias("failure"), F.when(F.col("failure").isNull(), F.when(F.col("items").isNull(), "json_invalid").when(F.col("response").isNull(), "missing_entry")).alias("reason")))
    return _judged(entries, hit, got, known), got.where("response is not null").select("case_id", "response")


def _listed(known: DataFrame) -> str:
    return known_lists([r.name for r in known.where("name is not null").select("name").distinct().orderBy("name").limit(MOST_KNOWN).collect()])


def _judged(entries: DataFrame, hit: DataFrame, got: DataFrame, known: DataFrame) -> DataFrame:
    reason = F.col("reason") if "reason" in got.columns else F.lit(None).cast("string")
    answers = hit.select("case_id", "response", F.lit(None).cast("string").alias("reason")).unionByName(got.select("case_id", "response", F.when(F.col("failure").isNotNull(), "provider_exception").otherwise(reason).alias("reason")))
    x = decided(entries.join(answers, "case_id"), known)
    return x.withColumn("outcome", F.coalesce("reason", "outcome")).withColumn("corrected", F.when(F.col("reason").isNull(), F.col("corrected"))).drop("reason")


def still_uncertain(decisions: DataFrame, names: DataFrame) -> DataFrame:
    """The entries that stay: those without an accepted answer, and corrections of texts that no class (``name``) has."""
    there = names.select(F.col("name").alias("raw_text"), F.lit(True).alias("_there")).distinct()
    x = decisions.join(there, "raw_text", "left")
    done = (F.col("outcome") == "confirmed") | ((F.col("outcome") == "corrected") & F.coalesce("_there", F.lit(False)))
    return x.where(~done).drop("_there")
