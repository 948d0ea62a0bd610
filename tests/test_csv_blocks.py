import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import csv_blocks, delimited, sheet

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])

TEXT = (
    'a,"b",c\n1,"line one\nline ""two""\n\n",x\n2,,\n"""",plain,"a,b"\n\n3,"x\n\n\n\ny","quoted, comma"\r\n'
    '4,"' + "long\n" * 30 + '","' + "w\r\n" * 8 + '"\n5,"""\n""","\n"\n6,too,many,fields\n7,few\n"8","é\n漢字",""\n9,last,"no\nend"'
)


@pytest.fixture
def blocks(spark):
    """Sets the size of a block."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {n: spark.conf.get(n) for n in names}

    def size(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "1")

    yield size
    for n, v in kept.items():
        spark.conf.set(n, v)


def put(folder, text):
    path = os.path.join(folder, f"{uuid.uuid4().hex}.csv")
    with open(path, "wb") as f:
        f.write(text.encode())
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [31])
def test_equals_the_reader_of_whole_files(spark, tmp, blocks, size):
    path = put(tmp, TEXT)
    whole = rows(delimited.read_text_columns(spark, path, SCHEMA, blocks=False))
    assert len(whole) == 10
    blocks(size)
    assert csv_blocks._lines(spark, [path]).rdd.getNumPartitions() >= min(10, len(TEXT) // size)
    got = delimited.read_text_columns(spark, path, SCHEMA)  # larger than a task's share
    clean = lambda r: tuple(None if i == 3 and v is None else v for i, v in enumerate(r))
    assert [clean(r)[:3] for r in rows(got)] == [clean(r)[:3] for r in whole]
    assert [r[3] is None for r in rows(got)] == [r[3] is None for r in whole]


@pytest.mark.parametrize("shift", [0, 7, 8, 13])
def test_a_border_at_every_place_of_a_quoted_field(spark, tmp, blocks, shift):
    """The same record moved over a block's border, byte pair by byte pair."""
    text = "a,b,c\n" + "x" * (26 + shift) + ',"p""\n""q\n",r\n1,2,3\n' * 1 + "y,z,w"
    path = put(tmp, text)
    whole = rows(delimited.read_text_columns(spark, path, SCHEMA, blocks=False))
    blocks(20)
    assert rows(delimited.read_text_columns(spark, path, SCHEMA, blocks=True)) == whole


def test_quotes_inside_a_field_go_to_the_reader_of_whole_files(spark, tmp, blocks):
    path = put(tmp, 'a,b,c\n1,5" pipe,x\n2,"y\nz",w\n3,p,q\n')
    whole = rows(delimited.read_text_columns(spark, path, SCHEMA, blocks=False))
    blocks(8)
    _, ill = csv_blocks.read_records(spark, [path])
    assert len(ill) == 1
    assert rows(delimited.read_text_columns(spark, path, SCHEMA)) == whole


def test_several_files_and_header_orders(spark, tmp, blocks):
    one, two = put(tmp, 'c,a,b\n1,2,"3\n4"\n'), put(tmp, 'a,b,c\n"5\n\n6",7,8\n')
    blocks(6)
    got = delimited.read_text_columns(spark, [one, two], SCHEMA, null_values=["7"])
    assert rows(got) == sorted([("2", "3\n4", "1", None), ("5\n\n6", None, "8", None)], key=repr)
    with pytest.raises(ValueError, match="no column"):
        delimited.read_text_columns(spark, put(tmp, "a,b\n1,2\n"), SCHEMA, blocks=True)
    empty = put(tmp, "a,b,c\n")
    assert delimited.read_text_columns(spark, empty, SCHEMA, blocks=True).count() == 0


def test_sheet_cells_keep_line_breaks(spark, tmp, blocks):
    notes = "".join(f'note {i} 5" pipe\n' for i in range(10)) + ",".join(f"c{i}" for i in range(12)) + "\n"
    row = lambda n, cell: ",".join([f'"{cell}"', *(str(n + k) for k in range(11))]) + "\n"
    cells = [f"one\ntwo, {i}" if i % 3 else "plain" for i in range(40)]
    path = put(tmp, notes + "".join(row(i, c) for i, c in enumerate(cells)))
    blocks(400)
    spark.conf.set("spark.sql.files.openCostInBytes", "400")  # the first block holds the notes
    got = sheet.read_rig_sheet(spark, path).collect()
    assert sorted(r["Country"] for r in got) == sorted(cells)
    assert all(r["_corrupt_record"] is None for r in got)


def test_large_file_is_read_by_many_tasks(spark, tmp, blocks):
    n = 1500
    path = put(tmp, "a,b,c\n" + "".join(f'{i},"x\n{"y" * (i % 50)}",{i % 7}\n' for i in range(n)))
    blocks(4096)
    got = delimited.read_text_columns(spark, path, SCHEMA)
    assert got.agg(F.count("*"), F.countDistinct("a"), F.sum(F.length("b")), F.count(delimited.CORRUPT)).first() == (n, n, sum(2 + i % 50 for i in range(n)), 0)
    assert got.rdd.getNumPartitions() > 1
