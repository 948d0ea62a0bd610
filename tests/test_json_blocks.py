import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from quarry.sources import geojson, json_blocks
from tests.test_csv_blocks import blocks  # noqa: F401


def put(folder, text):
    path = os.path.join(folder, f"{uuid.uuid4().hex}.geojson")
    with open(path, "wb") as f:
        f.write(text.encode())
    return path


def feature(i):
    place = ['plain', 'a "quoted" } brace { and [', 'back\\slash\\\\"', 'é漢 }}', ''][i % 5]
    return {"type": "Feature", "id": f"q{i}", "properties": {"mag": i / 2, "place": place, "time": 1704067200000 + i, "nested": {"x": [{"y": 1}]}},
            "geometry": {"type": "Point", "coordinates": [-95.0 + i, 29.5, 3.0][: 1 + i % 3]} if i % 4 else None}


def collection(n, indent=None, before=True):
    out = {"type": "FeatureCollection", "metadata": {"title": 'all "features": [ {', "count": n}} if before else {}
    return json.dumps(out | {"features": [feature(i) for i in range(n)], "bbox": [1, 2, 3]}, indent=indent, ensure_ascii=False)


def rows(df):
    return sorted((tuple(r) for r in geojson.flatten_features(df).collect()), key=repr)


@pytest.mark.parametrize("indent,size,cell", [(None, 37, 50), (1, 150, 90)])
def test_equals_the_reader_of_whole_files(spark, tmp, blocks, monkeypatch, indent, size, cell):  # noqa: F811
    monkeypatch.setattr(json_blocks, "CELL", cell)
    path = put(tmp, collection(12, indent) + ("\n" if indent else ""))
    whole = rows(geojson.read_features(spark, path, blocks=False))
    assert len(whole) == 12
    blocks(size)
    pieces = spark.read.option("lineSep", "}").text(path)
    assert pieces.rdd.getNumPartitions() > 4
    assert rows(geojson.read_features(spark, path)) == whole  # larger than a task's share


def test_other_arrays_and_empty_collections(spark, tmp, blocks):  # noqa: F811
    text = '{"first": [{"id": "no"}, {"id": "no"}], "features": [{"id": "yes"}, {"id": "yes2"}], "last": [{"id": "no"}]}'
    blocks(16)
    got = geojson.read_features(spark, [put(tmp, text), put(tmp, '{"features": []}\n')], blocks=True).select("f.id").collect()
    assert sorted(r.id for r in got) == ["yes", "yes2"]


@pytest.mark.parametrize("text", ['{"features": [{"id": "x", "properties": {"mag": 1', '{"features": [{"id": "x"}]', '{"features": [{"id": "x"}', '{"features": [{"id": "x}'])
def test_truncated_files_end_the_load(spark, tmp, text):
    with pytest.raises(Exception, match="malformed"):
        geojson.read_features(spark, put(tmp, text), blocks=True).collect()


def test_a_file_without_features_ends_the_load(spark, tmp):
    with pytest.raises(Exception, match="no features"):
        geojson.read_features(spark, put(tmp, '{"type": "error", "list": [{"features": 1}]}'), blocks=True).collect()
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        geojson.read_features(spark, put(tmp, '{"features": [{"id": "a", broken}]}'), blocks=True).collect()


def test_large_collection_is_read_by_many_tasks(spark, tmp, blocks, monkeypatch):  # noqa: F811
    monkeypatch.setattr(json_blocks, "CELL", 2000)
    path = put(tmp, collection(600))
    blocks(10_000)
    got = geojson.read_features(spark, path)
    assert got.agg(F.count("*"), F.countDistinct("f.id")).first() == (600, 600)
