"""Sheets in chunks without a text of a whole sheet: the same chunks as of that text."""

import random

from pyspark.sql import functions as F

from graphloom.operators import chunking
from graphloom.sources import markup


def test_sheet_chunks_are_those_of_the_text(spark):
    rng, rows = random.Random(1), []
    for doc in (1, 2, 3):
        for no, n in enumerate((65, 0, 1, 30, 200)[: doc + 2]):
            places = rng.sample(range(10_000), n + 1)
            rows += [(doc, no, f"S{no % 3}", p, ["x", *[rng.choice(["a", None, "b c"]) for _ in range(rng.randrange(4))]] if k else ["h1", None, "h3"]) for k, p in enumerate(sorted(places))]
    rows.append((4, 0, "empty", 1, []))
    cells = spark.createDataFrame(rows, "doc_id long, sheet_no int, sheet string, row_no long, values array<string>").repartition(7)
    got = markup.sheet_chunks(cells, rows_per_chunk=30)
    want = chunking.chunk_documents(markup.rows_to_markdown(cells).withColumn("pdf_type", F.lit(None).cast("string")), rows_per_chunk=30).drop("pdf_type")
    key = lambda df: sorted((r.doc_id, r.chunk_seq, r.section, r.chunk_index, r.row_range, r.char_count, r.content) for r in df.collect())
    assert key(got) == key(want)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 10


def test_no_group_is_larger_than_a_chunk(spark):
    cells = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit(0).alias("sheet_no"), F.lit("S").alias("sheet"), F.col("id").alias("row_no"), F.array(F.col("id").cast("string")).alias("values"))
    got = markup.sheet_chunks(cells)
    assert got.count() == -(-19_999 // 30) and got.agg(F.max("char_count")).first()[0] < 600
    assert got.orderBy("chunk_seq").select("row_range").head(2)[1][0] == "31-60"
