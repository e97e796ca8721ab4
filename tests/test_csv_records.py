"""CSV records with line breaks in quotes, from files that are split anywhere."""

import random

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cardledger.sources import csv_records as source
from cardledger.sources.tables import read_csv, read_typed_csv, save_csv, skipped_lines

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("note", StringType())])


@pytest.fixture
def blocks_of(spark):
    """Sets the size of the blocks that files are split into."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_size(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield set_size
    for n, value in before.items():
        spark.conf.set(n, value)


def value(rng):
    return rng.choice(["plain", "a,b", 'says "no"', "two\nlines", "\n\n", '"\n"', "café\r\nbar", "x" * 90 + "\n" + "y" * 90, " ", "1"])


def rows(n, seed=3):
    rng = random.Random(seed)
    return [(i, value(rng), value(rng)) for i in range(n)]


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(path, data, end="\n", header="id,name,note"):
    body = [header] + [f"{i},{quoted(a)},{quoted(b)}" for i, a, b in data]
    path.write_bytes((end.join(body) + end).encode())


def as_tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_do_not_depend_on_the_blocks(spark, tmp_path, blocks_of, size, end):
    data = rows(9 if size < 50 else 60)
    write(tmp_path / "a.csv", data[:6], end)
    write(tmp_path / "b.csv", data[6:], end)
    blocks_of(size)
    assert as_tuples(read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)) == data


def test_one_file_is_read_by_many_tasks(spark, tmp_path, blocks_of):
    write(tmp_path / "a.csv", rows(400))
    blocks_of(2000)
    assert source.csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    assert read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).count() == 400


def test_as_the_reader_that_does_not_split(spark, tmp_path, blocks_of):
    data = rows(200, 5)
    save_csv(spark.createDataFrame(data, SCHEMA), str(tmp_path / "t"), single_file=True)
    blocks_of(500)
    plain = spark.read.options(header=True, quote='"', escape='"', multiLine=True).schema(SCHEMA).csv(str(tmp_path / "t"))
    assert as_tuples(read_typed_csv(spark, str(tmp_path / "t"), SCHEMA)) == as_tuples(plain)


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_records_of_another_length_are_skipped(spark, tmp_path, blocks_of, size):
    (tmp_path / "a.csv").write_text('id,name,note\n1,"a\nb",c\n2,"d\ne"\n\n3,f,"g\n",h\n4,,\n')
    blocks_of(size)
    assert as_tuples(read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)) == [(1, "a\nb", "c"), (4, "", "")]
    skipped = skipped_lines(spark, str(tmp_path), SCHEMA, multi_line=True)
    assert sorted(r.line for r in skipped.collect()) == ['2,"d\ne"', '3,f,"g\n",h']


def test_a_file_that_ends_within_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,"a,b\n2,c,d\n')
    with pytest.raises(Exception, match="ends within quotes"):
        read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()


def test_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "a.csv", rows(2))
    write(tmp_path / "b.csv", rows(2), header="id,note,name")
    with pytest.raises(Exception, match="another header"):
        read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()


def test_only_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,note\n")
    assert read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect() == []


def test_more_blocks_than_may_be_sent(spark, tmp_path, blocks_of):
    write(tmp_path / "a.csv", rows(50))
    blocks_of(100)
    with pytest.raises(ValueError, match="maxPartitionBytes"):
        source.csv_records(spark, str(tmp_path), most_blocks=3)
