import random

import pytest
from pyspark.sql import types as T

from orderlens.sources.quoted_csv import read_quoted, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "score", "title", "message")])


def both(spark, path):
    whole = spark.read.schema(SCHEMA).options(header=True, enforceSchema=True, quote='"', escape='"', emptyValue="", multiLine=True).csv(path)
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    return order(read_quoted(spark, path, SCHEMA)), order(whole)


@pytest.fixture()
def cut(spark):
    """Set how many bytes a range of a file holds."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


TEXT = (
    'id,score,title,message\nr1,4,"","said ""ok"", fine\nsecond line\n\n""third"""\nr2,1,,plain\n"r\n3",5,"é日本","a,b"\n'
    'r4,,"""",\n"r5","2","x\ny\nz","\n"\nr6,3,t,end\n'
)


@pytest.mark.parametrize("size", [1, 5, 23, 10_000])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_same_as_the_reader_of_whole_files(spark, cut, tmp_path, size, newline):
    (tmp_path / "a.csv").write_bytes(TEXT.replace("\n", newline).encode())
    cut(size)
    mine, whole = both(spark, str(tmp_path))
    assert [tuple(v and v.replace("\r\n", "\n") for v in r) for r in mine] == [tuple(v and v.replace("\r\n", "\n") for v in r) for r in whole]
    assert len(mine) == 6


def test_many_files_without_a_last_line_end(spark, cut, tmp_path):
    rng = random.Random(2)
    for k in range(4):
        rows = []
        for i in range(60):
            field = "".join(rng.choices(['""', "\n", ",", "a", "é", " ", "b\n\n"], k=rng.randrange(25)))
            rows.append(f'f{k}r{i},{i},t,"{field}"')
        (tmp_path / f"{k}.csv").write_text("id,score,title,message\n" + "\n".join(rows))
    for size in (37, 400, 1 << 20):
        cut(size)
        mine, whole = both(spark, str(tmp_path))
        assert mine == whole and len(mine) == 240


def test_only_long_records_are_brought_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,score,title,message\n" + "".join(f"r{i},1,t,m\n" for i in range(500)))
    found = records(spark, str(tmp_path))
    assert found.where("first").count() == 1 and found.count() == 501
    (tmp_path / "empty.csv").write_text("")
    assert records(spark, str(tmp_path)).count() == 501
