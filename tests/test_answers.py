"""Model answers in odd and damaged JSON: what a strict parser makes of them, and no broken character ends the job."""

import json
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import extraction as e

CASES = [
    '{"entities":[{"name":"a"}]}', 'see {"entities":[{"name":null,"type":"t","properties":{"k":1}}]} ok', "{} {}", "none", '[{"entities":[]}]', '{"entities":[{"name":"a"', None, "{'entities':[]}", "",
    '{"entities":[{"name":5,"type":{"x": 1.50},"properties":{"a":true,"b":null,"c":{"z":1,"a":[1, 2]},"d":"x\\u00e9"}}],"relationships":[{"from":"a","to":"b","type":"T","properties":[]}]}',
    '{"entities":["x",{"name":"a"},null]}', '{"entities":{"name":"a"}}', '{"entities":null}', '{"entities":[{"name":"a","name":"b"}]}', '{"entities":[{"name":"a","properties":"{\\"k\\":1}"}]}', '{"entities":[{"name":"\\ud800"}]}',
    '```json\n{"entities":[{"name":"q","properties":{"v":1.10,"w":1e5,"x":-0}}]}\n```', 'x {"entities":[{"name":"a"}]} {"entities":[]}', '{"entities":[{"name":"a"}]},"y":2', '{"entities":[{"name":"a"}]}] x', '[1] {"entities":[{"name":"a"}]}',
    '{"a":NaN,"entities":[{"name":"n"}]}', '"text {} "', "5", '  \n{"entities":[{"name":" pad "}]}\t ', ' {"entities":[{"name":"nb"}]}', '﻿{"entities":[{"name":"bom"}]}', '{"entities":[{"name":"a\tb"}]}', 'say "hi" {"entities":[{"name":"z","type":""}]}',
    '{"entities":[[]]}', '{"entities":[{}]}', '{"entities":[{"properties":null}]}', '{"entities":[{"name":"graphloom: end"}]}', '{"entity_types":[{"name":"X","example_properties":"no"},{"name":"Y","example_properties":{}}]}',
    'A {"entity_types":[{"name":"X","example_properties":["a",1,null,{"k":2}]}],"relationship_types":[{"name":"R","from_type":null}]} b',
]




def by_hand(text, name):
    """The entries' names, by Python's parser alone."""
    found = None
    for part in (text or "", (text or "")[(text or "").find("{") : (text or "").rfind("}") + 1]):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        break
    rows = found.get(name) if isinstance(found, dict) else None
    return [r.get("name", "") for r in rows if isinstance(r, dict)] if isinstance(rows, list) else []


def damaged(n):
    rng = random.Random(1)
    for _ in range(n):
        t = list(rng.choice([c for c in CASES if c]))
        for _ in range(rng.randrange(1, 4)):
            k = rng.randrange(len(t))
            t[k : k + rng.randrange(2)] = rng.choice(["", *'{}[]",: 1n.e\\x-'])
            t = t or ["x"]
        yield "".join(t)


@pytest.mark.parametrize(("field", "parse"), [("entities", e.parse_extraction_response), ("entity_types", e.parse_schema_response)])
def test_odd_and_damaged_answers(spark, field, parse):
    texts = [*CASES, *damaged(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", parse(F.col("t")).alias("x")).collect()
    show = lambda n: n if n is None or isinstance(n, str) and "\ud800" not in n else "?"  # noqa: E731 - numbers and broken characters
    got = {r.i: [n.name for n in r.x[field]] for r in rows}
    assert {i: [show(n) for n in (v or [])] for i, v in got.items()}.keys() == set(range(len(texts)))
    for i, t in enumerate(texts):
        want = by_hand(t, field)
        assert len(got[i]) == len(want) and all(a == b or not isinstance(b, str) or "\ud800" in b for a, b in zip(got[i], want, strict=True)), t
    assert sum(map(bool, got.values())) > 3
