import gzip
import json

import pytest
from pyspark.sql import functions as F

from quire.sources import snapshot


def write_part(root, date, lines, name="part_000.gz", cut=None):
    folder = root / f"updated_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    data = gzip.compress(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")
    (folder / name).write_bytes(data if cut is None else data[:cut])
    return str(folder / name)


def test_manifest_order_and_broken_entries(spark, tmp_path):
    doc = {"entries": [{"url": "s3://b/x/part_1.gz"}, {}, {"url": ""}, {"url": "s3://b/a/part_0.gz"}]}
    (tmp_path / "manifest").write_text(json.dumps(doc, indent=2))
    rows = snapshot.manifest_parts(snapshot.read_manifest(spark, str(tmp_path / "manifest"))).orderBy("pos").collect()
    assert [r["part"] for r in rows] == [
        "https://b.s3.amazonaws.com/x/part_1.gz", "https://b.s3.amazonaws.com/a/part_0.gz"
    ]
    (tmp_path / "empty").write_text("{}")
    assert snapshot.manifest_parts(snapshot.read_manifest(spark, str(tmp_path / "empty"))).count() == 0
    (tmp_path / "broken").write_text("{")
    with pytest.raises(Exception):
        snapshot.read_manifest(spark, str(tmp_path / "broken")).collect()


LINES = [
    '{"id": "a", "publication_year": 2020}',
    "",
    " \t ",
    "not json",
    '{"id": "cut", "publ',
    '{"id": "b", "publication_year": "2020"}',
    b'{"id": "c\xff", "title": "t"}',
    '[{"id": "listed"}]',
    "123",
    "null",
    '{"id": "d", "abstract_inverted_index": {"x": [0], "y": [1], "x": [2]}}',
    '{"id": "e", "concepts": "none"}',
    "{'id': 'quoted'}",
    '{"id": "f"} rest',
    '  {"id": "g", "extra": {"deep": [1, {"x": null}]}}  ',
]


def test_line_rules(spark, tmp_path):
    write_part(tmp_path, "2024-01-01", LINES)
    works = {w["id"]: w for w in snapshot.read_works(spark, str(tmp_path)).collect()}
    assert set(works) == {"a", "b", "c�", "d", "e", "g"}
    assert works["a"]["publication_year"] == 2020
    assert works["b"]["publication_year"] is None
    assert works["d"]["abstract_inverted_index"] == {"x": [2], "y": [1]}
    mapped = snapshot.map_works(snapshot.read_works(spark, str(tmp_path)), concept_id=None)
    assert {r["id"]: r["abstract"] for r in mapped.collect()}["d"] == "y x"
    assert snapshot.map_works(snapshot.read_works(spark, str(tmp_path))).count() == 0


def test_bad_lines_are_counted(spark, tmp_path):
    path = write_part(tmp_path, "2024-01-01", LINES)
    write_part(tmp_path, "2024-01-02", ['{"id": "z"}'])
    rows = snapshot.bad_lines(snapshot.read_lines(spark, str(tmp_path))).collect()
    assert [(r["part"].removeprefix("file:"), r["n_bad"]) for r in rows] == [(path, 7)]


def test_lines_keep_their_order(spark, tmp_path):
    write_part(tmp_path, "2024-01-01", [json.dumps({"id": str(i)}) for i in range(500)])
    rows = snapshot.read_works(spark, str(tmp_path)).orderBy("line").collect()
    assert [r["id"] for r in rows] == [str(i) for i in range(500)]


def test_truncated_part_fails(spark, tmp_path):
    write_part(tmp_path, "2024-01-01", [json.dumps({"id": str(i), "title": str(i * 7919)}) for i in range(2000)], cut=900)
    with pytest.raises(Exception):
        snapshot.read_works(spark, str(tmp_path)).collect()


def test_date_folders_are_pruned(spark, tmp_path):
    for day in range(1, 6):
        write_part(tmp_path, f"2024-01-0{day}", ['{"id": "W%d"}' % day])
    works = snapshot.read_works_since(spark, str(tmp_path), "2024-01-02", "2024-01-03")
    plan = works._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_date" in plan
    assert {r["id"] for r in works.collect()} == {"W2", "W3"}


def test_costly_columns_are_computed_once(spark, tmp_path):
    write_part(tmp_path, "2024-01-01", ['{"id": "a"}'])
    rows = snapshot.with_text(snapshot.map_works(snapshot.read_works(spark, str(tmp_path))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1
    assert plan.count("from_json(StructField(id") == 1
    concept, rebuilt = plan.index("exists("), plan.index("sort_array")
    assert concept > rebuilt, "the concept is tested below the abstract"


def test_keep_no_text(spark, tmp_path):
    write_part(tmp_path, "2024-01-01", ['{"id": "a", "title": "t"}', '{"id": "b", "title": " "}'])
    mapped = snapshot.map_works(snapshot.read_works(spark, str(tmp_path)), concept_id=None)
    assert [r["id"] for r in snapshot.with_text(mapped).collect()] == ["a"]
    kept = snapshot.with_text(mapped, skip_no_text=False)
    assert {r["id"]: r["text"] for r in kept.collect()} == {"a": "t", "b": ""}
    assert kept.where(F.col("title") == " ").count() == 1


def test_lines_without_the_concept_are_not_parsed(spark, tmp_path):
    escaped = '{"id": "esc", "concepts": [{"id": "\\u0043719\\u00324100"}]}'
    write_part(tmp_path, "2024-01-01", [
        '{"id": "yes", "concepts": [{"id": "C71924100"}]}',
        escaped,
        '{"id": "no", "concepts": [{"id": "C1"}]}',
        '{"id": "title", "title": "C71924100"}',
        '{"id": "accent", "title": "caf\\u00e9", "concepts": [{"id": "C1"}]}',
    ])
    parsed = snapshot.read_works(spark, str(tmp_path), concept_id="C71924100")
    assert {r["id"] for r in parsed.collect()} == {"yes", "esc", "title", "accent"}
    assert {r["id"] for r in snapshot.map_works(parsed).collect()} == {"yes", "esc"}
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("Contains("), "the test for the id comes first"
