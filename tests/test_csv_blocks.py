"""CSV read in blocks against Spark's own whole-file reader."""

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import PySparkException

from trendlake.schemas import STATS_CSV
from trendlake.sources import read_stats_csv

COLUMNS = [f.name for f in STATS_CSV if f.name != "region"]
HEADER = ",".join(COLUMNS)


@pytest.fixture
def small_blocks(spark):
    """Blocks of 61 bytes, so that quotes, records and heads span several."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def field(rng):
    """Plain, quoted with anything inside, or with quotes where Spark takes them as they come."""
    body = "".join(rng.choices(["a", "bc", ",", "\n", '""', " ", "\n\n", '"",""', "é", "\r\n"], k=rng.randint(0, 12)))
    plain = "".join(rng.choices(["x", "yz", " ", 'q"r', "\\"], k=rng.randint(0, 3)))
    return rng.choice([f'"{body}"', f'"{body}"', plain, plain, '""', f'"{body}" ', f'"{body.strip(chr(34))}"z'])


def record(rng, key):
    width = rng.choice([len(COLUMNS)] * 8 + [3])
    return ",".join([f"v{key}", *(field(rng) for _ in range(width - 1))])


def land(root, seed, end="\n", closed=True):
    rng = random.Random(seed)
    for region in ("ca", "01"):
        (root / f"region={region}").mkdir(exist_ok=True)
        for name in range(2):
            rows = [HEADER, *(record(rng, f"{region}{name}.{n}") + rng.choice(["", "", "\n"]) for n in range(rng.randint(0, 9)))]
            text = "\n".join(rows).replace("\n", end) + rng.choice(["", end])
            (root / f"region={region}" / f"f{name}.csv").write_bytes((text if closed else text + '\nz,"open\nto,the\nend').encode())
    return str(root)


def write(root, text):
    (root / "region=ca").mkdir()
    (root / "region=ca" / "f.csv").write_text(text)


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_whole_files(small_blocks, tmp_path, seed):
    root = land(tmp_path, seed, end="\r\n" if seed == 5 else "\n", closed=seed != 4)
    whole = read_stats_csv(small_blocks, root)
    blocks = read_stats_csv(small_blocks, root, split_above=0)
    assert blocks.schema.fieldNames() == whole.schema.fieldNames()
    assert rows_of(blocks) == rows_of(whole)
    assert rows_of(read_stats_csv(small_blocks, root, ["01"], split_above=0)) == rows_of(read_stats_csv(small_blocks, root, ["01"]))


def test_records_over_many_blocks(small_blocks, tmp_path):
    long = '"' + 'line, ""quoted""\n' * 40 + '"'
    rest = "," * (len(COLUMNS) - 2)
    rows = [HEADER, f"a,{long}{rest}", f"b,x{rest}", f'c,""{rest}', f"d,{long}{rest}", f"e,{long}{rest}"]
    write(tmp_path, "\n".join(rows))
    blocks = read_stats_csv(small_blocks, str(tmp_path), split_above=0)
    found = {r.video_id: r.trending_date for r in blocks.collect()}
    text = 'line, "quoted"\n' * 40
    assert {k: v or "" for k, v in found.items()} == {"a": text, "b": "x", "c": "", "d": text, "e": text}


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    """Only files above the bound are split; smaller ones beside them stay whole."""
    row = '{},17.14.11,"a\nb"' + "," * (len(COLUMNS) - 3) + "\n"
    (tmp_path / "region=ca").mkdir()
    (tmp_path / "region=ca" / "big.csv").write_text(HEADER + "\n" + "".join(row.format(n) for n in range(40_000)))
    (tmp_path / "region=ca" / "small.csv").write_text(HEADER + "\n" + row.format("s"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        df = read_stats_csv(spark, str(tmp_path), split_above=100_000)
        scan = spark.read.text(str(tmp_path))
        assert scan.rdd.getNumPartitions() >= 6
        rows = df.select("video_id", "title").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 40_001 and {r.video_id for r in rows} == {"s", *map(str, range(40_000))}
    assert {r.title for r in rows} == {"a\nb"}
    plan = plan_of(df)
    assert "Scan text" in plan and "Scan csv" in plan and "Python" not in plan


def test_another_header_fails(small_blocks, tmp_path):
    write(tmp_path, "b,a\n1,2\n")
    with pytest.raises(PySparkException, match="does not conform"):
        read_stats_csv(small_blocks, str(tmp_path), split_above=0).collect()


def test_long_lines_do_not_recurse(small_blocks, tmp_path):
    small_blocks.conf.unset("spark.sql.files.maxPartitionBytes")
    rest = "," * (len(COLUMNS) - 2)
    write(tmp_path, f'{HEADER}\na,"{chr(34) * 400_000}b"{rest}\nc,"{"x," * 200_000}"{rest}\n{"," * 10_000}\n')
    rows = read_stats_csv(small_blocks, str(tmp_path), split_above=0).where("video_id is not null").collect()
    assert [len(r.trending_date) for r in sorted(rows)] == [200_001, 400_000]
