"""Samples, prompts, calls of a model that the user brings, and what its answers hold."""

from __future__ import annotations

import json
import random
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from graphloom.functions.text import looks_like_json

EXTRACTION = "entities array<struct<name:string,type:string,properties:map<string,string>>>, relationships array<struct<from:string,to:string,type:string,properties:map<string,string>>>"
SCHEMA_TYPES = "entity_types array<struct<name:string,description:string,example_properties:array<string>>>, relationship_types array<struct<name:string,from_type:string,to_type:string,description:string>>"


def sample_chunks(chunks: DataFrame, by: tuple[str, ...] = ("doc_id",), order: str = "chunk_seq", k: int = 5) -> DataFrame:
    """Of each group at most ``k`` chunks at equal steps from the first."""
    group = Window.partitionBy(*by)
    n, pos = F.count("*").over(group), F.row_number().over(group.orderBy(order)) - 1
    step = F.when(F.col("_n") <= k, 1).otherwise(F.floor(F.col("_n") / k))
    return chunks.withColumn("_n", n).withColumn("_pos", pos).where((F.col("_pos") % step == 0) & (F.col("_pos") / step < k)).drop("_n", "_pos")


def build_discovery_prompt(samples: DataFrame, instruction: str, by: tuple[str, ...] = ("corpus",), order: str = "chunk_seq") -> DataFrame:
    """The instruction and the numbered samples of each group."""
    listed = samples.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("section", F.lit("unknown")).alias("section"), "content"))).alias("s"))
    part = F.transform("s", lambda x, i: F.concat(F.lit("\n--- Sample "), (i + 1).cast("string"), F.lit(" (from "), x["section"], F.lit(") ---\n"), x["content"], F.lit("\n")))
    return listed.select(*by, F.concat(F.lit(instruction), F.array_join(part, "")).alias("prompt"))


def build_extraction_prompt(content: Column, entity_types: list[tuple[str, str]], relationship_types: list[tuple[str, str, str, str]], rules: str) -> Column:
    """The schema and rules as one literal, then the chunk. The lists are a schema: a few lines."""
    head = "\n".join(["ENTITY TYPES:", *(f"  - {n}: {d}" for n, d in entity_types), "RELATIONSHIP TYPES:", *(f"  - {n}: ({a}) -> ({b}) — {d}" for n, a, b, d in relationship_types), rules, "TEXT:", ""])
    return F.concat(F.lit(head), content)


class RetryableError(Exception):
    """Throttled, unavailable, timed out or failed inside the service: worth another try after a wait."""


class FatalError(Exception):
    """Access denied or a request that is not valid: no other try."""


class Pace:
    """Spaces the calls of one task: at most ``share`` a second. A throttled call halves the pace, every answer lifts it by a tenth
    of the share again, up to the share."""

    def __init__(self, share: float, wait: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.share, self.now, self.wait, self.clock = share, share, wait, clock
        self.next, self.lock = clock(), threading.Lock()

    def turn(self) -> None:
        """Returns when the next call may begin."""
        with self.lock:
            at = max(self.clock(), self.next)
            self.next = at + 1 / self.now
        if (left := at - self.clock()) > 0:
            self.wait(left)

    def tell(self, throttled: bool) -> None:
        with self.lock:
            self.now = max(self.now / 2, self.share / 64) if throttled else min(self.share, self.now + self.share / 10)


_CALL = "response string, attempts int, status string, error string, throttles int, seconds double"


def complete_prompts(
    df: DataFrame, fn: Callable[[str], str], prompt: str = "prompt", tries: int = 3, parallel: int | None = None, in_flight: int = 1,
    done: DataFrame | None = None, keys: tuple[str, ...] = ("doc_id", "chunk_seq"), wait: Callable[[float], None] = time.sleep, rate: float | None = None,
) -> DataFrame:
    """``df`` with response, attempts, status (ok, failed), error, throttles and seconds. ``fn`` takes a prompt and may raise
    the errors above.

    A retryable error waits 2**attempt seconds and up to one more; an answer without a brace is asked for again at once, and
    the last one is returned as it is; all other errors fail at once, and ``error`` says which. ``parallel`` tasks have
    ``in_flight`` calls each; ``rate`` is how many calls a second all of them make together, of which each task takes its equal
    share (``Pace``), and needs ``parallel``. Write the result before parsing it, so that a lost executor repeats only its own calls; to go on
    after a stop, pass what was written as ``done``: rows with its ``keys`` whose status is ok are not asked for again.
    """
    if rate is not None and parallel is None:
        raise ValueError("a rate over all tasks needs their number")
    if done is not None:
        df = df.join(done.where("status = 'ok'").select(*keys).distinct(), list(keys), "left_anti")
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(_CALL).fields])
    names, kinds = [f.name for f in schema.fields], to_arrow_schema(T.StructType.fromDDL(_CALL))

    def ask(text, pace):
        throttles, began = 0, time.monotonic()
        for attempt in range(1, tries + 1):
            try:
                if pace:
                    pace.turn()
                answer = fn(text)
                if pace:
                    pace.tell(False)
                if "{" in answer or attempt == tries:
                    return answer, attempt, "ok", None, throttles, time.monotonic() - began
            except RetryableError as e:
                throttles += 1
                if pace:
                    pace.tell(True)
                if attempt == tries:
                    return None, attempt, "failed", f"{type(e).__name__}: {e}", throttles, time.monotonic() - began
                wait(2 ** (attempt - 1) + random.random())
            except Exception as e:  # one prompt's error must not end the run; the row says what it was
                return None, attempt, "failed", f"{type(e).__name__}: {e}", throttles, time.monotonic() - began

    def run(batches):  # the columns of ``df`` pass as they are
        pace = Pace(rate / parallel) if rate else None
        with ThreadPoolExecutor(in_flight) as pool:
            for b in batches:
                rows = list(pool.map(lambda text: ask(text, pace), b.column(prompt).to_pylist()))
                answers = [pa.array([r[k] for r in rows], kinds.field(k).type) for k in range(len(kinds))]
                yield pa.RecordBatch.from_arrays([*b.columns, *answers], names)

    return (df if parallel is None else df.repartition(parallel)).mapInArrow(run, schema)


def answer_prompts(df: DataFrame, fn: Callable[[str], str], answers: str, prompt: str = "prompt", **call) -> DataFrame:
    """D5 with a table of answers: ``df`` as ``complete_prompts`` gives it, with one call for all equal prompts, ever.

    ``answers`` is a Parquet folder of (prompt_id, run, and what D5 adds), keyed by the prompts' SHA-256. Prompts without a good answer
    there are asked for, in ``complete_prompts``'s way, and what comes back is added to it before it is joined to the rows; so a
    run that comes again asks only for what failed or was lost. A hot prompt is one row on the side of the answers.
    """
    spark = df.sparkSession
    keyed = df.withColumn("prompt_id", F.sha2(F.coalesce(prompt, F.lit("")), 256))
    schema = T.StructType.fromDDL(f"prompt_id string, run long, {_CALL}")

    def known():
        try:
            return spark.read.schema(schema).parquet(answers)
        except AnalysisException:  # no answer yet
            return spark.createDataFrame([], schema)

    asked = keyed.select("prompt_id", F.coalesce(prompt, F.lit("")).alias(prompt)).dropDuplicates(["prompt_id"])
    asked = asked.join(known().where("status = 'ok'").select("prompt_id").distinct(), "prompt_id", "left_anti")
    run = known().agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    told = complete_prompts(asked, fn, prompt, **call).withColumn("run", F.lit(run).cast("long"))
    told.select(*schema.names).write.mode("append").parquet(answers)
    fields = [f.name for f in T.StructType.fromDDL(_CALL)]
    best = known().groupBy("prompt_id").agg(F.max_by(F.struct(*fields), F.struct(F.col("status") == "ok", "run")).alias("answer"))
    return keyed.join(best, "prompt_id", "left").select(*df.columns, "answer.*")


def _object_in(text: str | None) -> dict:
    """The JSON object that is the whole text, or lies between its first and last brace; else an empty one."""
    text = text or ""
    a, b = text.find("{"), text.rfind("}")
    for part in (text, text[a : b + 1] if 0 <= a < b else ""):
        try:
            found = json.loads(part)
        except (ValueError, RecursionError):
            continue
        return found if isinstance(found, dict) else {}
    return {}


def _listed(found: dict, key: str, texts: tuple[str, ...], rest: str, empty) -> list[dict]:
    """The objects under ``key`` with every text, and what is under ``rest``; what is missing is empty, null texts stay null."""
    rows = found.get(key)
    out = []
    for row in rows if isinstance(rows, list) else []:
        if isinstance(row, dict):
            value = {t: row.get(t, "") for t in texts}
            out.append(value | ({rest: row[rest] if isinstance(row.get(rest), type(empty)) else empty} if rest else {}))
    return out


#: The lists of D6 and D3: their names, the texts of an entry, what else it holds, and the type of that.
_EXTRACTION = (("entities", ("name", "type"), "properties", "map<string,string>"), ("relationships", ("from", "to", "type"), "properties", "map<string,string>"))
_SCHEMA = (("entity_types", ("name", "description"), "example_properties", "array<string>"), ("relationship_types", ("name", "from_type", "to_type", "description"), "", ""))


def _by_python(lists):
    """A function from answers to the JSON of their lists with all fields, for what needs Python's own parser."""

    def whole(text):
        found = _object_in(text)
        return json.dumps({name: _listed(found, name, texts, rest, [] if kind.startswith("array") else {}) for name, texts, rest, kind in lists})

    return F.pandas_udf(lambda texts: texts.map(whole, na_action="ignore"), T.StringType())


def _answer(text: Column, lists, schema: str) -> Column:
    """The lists of the JSON object that is the text or lies between its first and last brace, by Python's strict parser in Arrow
    batches; texts without a brace don't go there."""
    found = _by_python(lists)(F.when(looks_like_json(text), text))
    return F.from_json(F.coalesce(found, F.lit(json.dumps({name: [] for name, *_ in lists}))), schema)


def parse_extraction_response(text: Column) -> Column:
    """struct(entities, relationships). Missing texts are empty, missing properties and lists too; an explicit null name stays
    null. Property values are JSON text. Answers without a JSON object give empty lists."""
    return _answer(text, _EXTRACTION, EXTRACTION)


def parse_schema_response(text: Column) -> Column:
    """D3: struct(entity_types, relationship_types); missing lists are empty."""
    return _answer(text, _SCHEMA, SCHEMA_TYPES)


def extract_chunks(chunks: DataFrame, fn: Callable[[str], str], entity_types, relationship_types, rules: str, **call) -> DataFrame:
    """``chunks`` with what D5 adds and extraction; a failed chunk has an empty extraction and stays."""
    asked = complete_prompts(chunks.withColumn("prompt", build_extraction_prompt(F.col("content"), entity_types, relationship_types, rules)), fn, **call)
    return asked.withColumn("extraction", parse_extraction_response(F.col("response")))


def entities_of(df: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk_seq")) -> DataFrame:
    """Rows (keys, name, entity_type, properties, ord) of the extracted entities."""
    rows = df.select(*keys, F.posexplode("extraction.entities").alias("pos", "e"))
    return rows.select(*keys, F.col("e.name").alias("name"), F.col("e.type").alias("entity_type"), F.col("e.properties").alias("properties"), F.struct(*keys, "pos").alias("ord"))


def relationships_of(df: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk_seq")) -> DataFrame:
    """Rows (keys, from_entity, to_entity, relationship_type, properties, ord) of the extracted relationships."""
    rows = df.select(*keys, F.posexplode("extraction.relationships").alias("pos", "r"))
    return rows.select(*keys, F.col("r.from").alias("from_entity"), F.col("r.to").alias("to_entity"), F.col("r.type").alias("relationship_type"), F.col("r.properties").alias("properties"), F.struct(*keys, "pos").alias("ord"))


# The rule layer's patterns.
PATTERNS = {"Email": r"\b[\w.]+@[\w.]+\.\w+\b", "Date": r"\b\d{4}-\d{2}-\d{2}\b", "Url": r"https?://[^\s<>\"]+", "Id": r"\b[A-Z]{2,10}-\d+\b"}


def extract_patterns(df: DataFrame, text: str = "content", patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """``df`` without the text, with one row (name, entity_type, pos) for each match."""
    def matches(kind, pattern):
        return F.transform(F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), 0), lambda x: F.struct(x.alias("name"), F.lit(kind).alias("entity_type")))

    found = F.concat(*[matches(k, p) for k, p in patterns.items()])
    rows = df.select(*[c for c in df.columns if c != text], F.posexplode(found).alias("pos", "e"))
    return rows.select("*", "e.name", "e.entity_type").drop("e")


def embed_chunks(chunks: DataFrame, fn: Callable[[list[str]], list[list[float]]], text: str = "content") -> DataFrame:
    """P5: ``chunks`` with ``embedding``; ``fn`` embeds a batch of texts."""
    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    names = schema.names

    def run(batches):  # the columns of ``chunks`` pass as they are
        for b in batches:
            vectors = [None if v is None else [float(x) for x in v] for v in fn(b.column(text).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32()))], names)

    return chunks.mapInArrow(run, schema)
