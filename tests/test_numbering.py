"""Places, running sums and zips against plain Python, with a hot group, repeated rows and nulls."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import numbering


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    lines = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, 5, rng.randint(-9, 9)])) for i in range(700)]
    lines += [(300, "hot", 1)] * 250
    return spark.createDataFrame(lines, "id long, g string, v long").repartition(5).cache(), lines


def test_places_in_the_whole_frame(rows):
    df, lines = rows
    got = numbering.numbered(df, ["id"]).collect()
    assert sorted(r.row_id for r in got) == list(range(len(lines)))
    assert [r.id for r in sorted(got, key=lambda r: r.row_id)] == sorted(line[0] for line in lines)


def test_places_in_groups(rows):
    df, lines = rows
    got = numbering.numbered(df, [F.desc("id")], ["g"], "place").collect()
    for g in ("hot", "b", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        assert [r.id for r in own] == sorted((line[0] for line in lines if line[1] == g), reverse=True)


def test_rows_as_they_lie_are_not_shuffled(spark):
    df = spark.range(0, 1000, numPartitions=7)
    got = numbering.row_chunks(df, 300).collect()
    assert all(r.row_id == r.id and r.chunk == r.id // 300 for r in got) and len(got) == 1000


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_sums(rows, by):
    df, lines = rows
    got = numbering.running_sum(df, "v", ["id", F.asc_nulls_last("v")], by).collect()
    for g in {line[1] for line in lines} if by else [0]:
        total, want = None, []
        for i, _, v in sorted((x for x in lines if not by or x[1] == g), key=lambda x: (x[0], x[2] is None, x[2] or 0)):
            total = total if v is None else v + (total or 0)
            want.append((i, total))
        found = [(r.id, r.running) for r in got if not by or r.g == g]
        assert sorted(found, key=repr) == sorted(want, key=repr)


def test_no_window_gathers_the_frame(rows):
    df, _ = rows
    plan = numbering.numbered(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_zip(spark):
    a = spark.createDataFrame([(3,), (1,), (2,)], "x int")
    b = spark.createDataFrame([("c",), ("a",), ("b",)], "y string")
    assert sorted((r.x, r.y) for r in numbering.zip_rows(a, b, ["x"], ["y"]).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        numbering.zip_rows(a, b.limit(2), ["x"], ["y"])
    empty = spark.createDataFrame([], "x int, g string")
    assert numbering.numbered(empty, ["x"]).count() == numbering.numbered(empty, ["x"], ["g"]).count() == numbering.running_sum(empty, "x", ["x"]).count() == 0
