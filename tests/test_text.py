import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X

def rebuilt(spark, *maps):
    """Through JSON, which keeps the order of the keys; a Python dict does not reach Spark in order."""
    df = spark.createDataFrame([(k, json.dumps(m)) for k, m in enumerate(maps)], "k int, m string")
    index = F.from_json("m", "map<string, array<int>>")
    rows = df.select("k", X.reconstruct_abstract(index).alias("a")).collect()
    return [r["a"] for r in sorted(rows)]


@pytest.mark.parametrize("index, expected", [
    ({"cold": [0], "rain": [1]}, "cold rain"),
    ({"no": [0, 3], "wind": [1], "and": [2], "snow": [4]}, "no wind and no snow"),
    ({"a": [0], "c": [2]}, "a c"),
    (None, None),
    ({}, None),
    ({"雨": [0], "und": [1], "éclair": [2]}, "雨 und éclair"),
    ({"b": [1], "a": [0, 4], "c": [4], "": [3]}, "a b c"),
    ({"x": []}, None),
    ({"x": [-1]}, None),
    ({"x": [0], "": [0]}, None),
    ({"x": [-1], "y": [0]}, "y"),
    ({" p  q ": [0], "r": [1]}, "p q r"),
    ({"a 　b": [0], "c\x1cd": [1], " ": [2]}, "a b c d"),
])
def test_reconstruct_abstract(spark, index, expected):
    assert rebuilt(spark, index) == [expected]


def test_reconstruct_abstract_like_slots(spark):
    """Random indexes against filling an array of slots."""
    rng = random.Random(7)
    words = ["a", "bb", "ç", "", " d ", "e\nf", "漢", "g h", "i"]
    maps = []
    for _ in range(120):
        chosen = rng.sample(words, rng.randint(0, len(words)))
        maps.append({w: [rng.randint(-2, 12) for _ in range(rng.randint(0, 4))] for w in chosen})

    def expected(index):
        slots = {}
        for token, positions in index.items():
            slots.update({p: token for p in positions if p >= 0})
        text = " ".join(slots[p] for p in sorted(slots) if slots[p])
        return re.sub(r"\s+", " ", text).strip() or None

    assert rebuilt(spark, *maps) == [expected(m) for m in maps]


def test_strip_is_unicode_strip(spark):
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    blank = df.where(X.strip(F.col("c")) == "").collect()
    assert {r["c"] for r in blank} == {c for c in every if not c.strip()}
    squeezed = df.where(X.squeeze(F.concat(F.lit("a"), "c", F.lit("b"))) == "a b").collect()
    assert {r["c"] for r in squeezed} == {c for c in every if re.fullmatch(r"\s", c)}


@pytest.mark.parametrize("title, abstract, mode, expected", [
    ("Heading", "A summary.", "title", "Heading"),
    ("Heading", "A summary.", "abstract", "A summary."),
    ("Heading", "A summary.", "title_abstract", "Heading\n\nA summary."),
    (None, "A summary.", "title_abstract", "A summary."),
    ("Heading", None, "title_abstract", "Heading"),
    (None, None, "title_abstract", None),
    ("  \n", " x ", "title_abstract", "x"),
    ("", "x", "title", None),
])
def test_build_text(spark, title, abstract, mode, expected):
    df = spark.createDataFrame([(title, abstract)], "t string, a string")
    assert df.select(X.build_text(F.col("t"), F.col("a"), mode)).first()[0] == expected


def test_build_text_rejects_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown text mode"):
        X.build_text(F.lit("a"), F.lit("b"), "both")


@pytest.mark.parametrize("url, expected", [
    ("s3://corpus/data/works/manifest", "https://corpus.s3.amazonaws.com/data/works/manifest"),
    ("s3://corpus//data/p_000.gz", "https://corpus.s3.amazonaws.com/data/p_000.gz"),
    ("https://example.org/x", "https://example.org/x"),
    ("s3://corpus", "https://corpus.s3.amazonaws.com/"),
])
def test_part_https(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(X.part_https(F.col("u"))).first()[0] == expected


@pytest.mark.parametrize("concepts, expected", [
    ([("https://example.org/C71924100", "Medicine"), ("https://example.org/C777", "Other")], True),
    ([("C71924100", None)], True),
    ([("https://example.org/C778", None)], False),
    ([("XC71924100", None)], False),
    ([(None, None)], False),
    ([None], False),
    (None, False),
    ([], False),
])
def test_has_concept(spark, concepts, expected):
    df = spark.createDataFrame([(concepts,)], "c array<struct<id:string, display_name:string>>")
    assert df.select(X.has_concept(F.col("c"))).first()[0] is expected


def test_short_work_id(spark):
    ids = ["https://example.org/W1", "W2", "xW3", "a/V1", "", None, "W", "W12x"]
    df = spark.createDataFrame(list(enumerate(ids)), "k int, id string")
    rows = df.select("k", X.short_work_id(F.col("id")).alias("w")).orderBy("k").collect()
    assert [r["w"] for r in rows] == ["W1", "W2"] + [None] * 6


def test_best_url(spark):
    records = [
        ("i", "d", None, 1, None, ("p",), ("l", "f"), ("o",)),
        ("i", "d", None, 1, None, ("p",), ("l", "f"), ("",)),
        ("i", "d", None, 1, None, ("p",), ("", "f"), None),
        ("i", "d", None, 1, None, ("p",), None, (None,)),
        ("i", "d", None, 1, None, ("",), None, None),
        ("i", "", None, 1, None, None, None, None),
    ]
    df = spark.createDataFrame(records, schemas.HYDRATION).coalesce(1)
    assert [r[0] for r in df.select(X.best_url()).collect()] == ["o", "l", "f", "p", "d", "i"]


def test_title_and_clamp(spark):
    df = spark.createDataFrame([("", "d"), (None, "d"), (" ", "d"), ("t", "d")], "t string, d string").coalesce(1)
    assert [r[0] for r in df.select(X.work_title(F.col("t"), F.col("d"))).collect()] == ["d", "d", " ", "t"]
    ks = spark.createDataFrame([(None,), (0,), (50,), (500,), (-3,)], "k int").coalesce(1)
    assert [r[0] for r in ks.select(X.clamp_k(F.col("k"))).collect()] == [50, 1, 50, 200, 1]
