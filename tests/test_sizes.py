"""What one task holds does not grow with the input: shuffles start with more partitions."""

import pytest

from clientele.operators.ranking import global_row_number
from clientele.session import INITIAL_PARTITIONS, SHUFFLE_INPUT_BYTES, shuffle_partitions, size_shuffles
from clientele.sources import testdata
from clientele.sources.sinks import stored_bytes


@pytest.fixture
def sized(spark):
    yield spark
    spark.conf.unset(INITIAL_PARTITIONS)


def test_shuffles_grow_with_the_input(sized):
    size_shuffles(sized, SHUFFLE_INPUT_BYTES)
    assert shuffle_partitions(sized) == 8  # as configured
    size_shuffles(sized, 20 * SHUFFLE_INPUT_BYTES + 1)
    size_shuffles(sized, 1)
    assert shuffle_partitions(sized) == 21
    df = sized.range(2000)
    ranked = global_row_number(df, [df["id"].desc()], "r")
    assert ranked.where("r + id <> 2000").count() == 0 and ranked.count() == 2000
    ranges = sized.read.parquet(ranked.inputFiles()[0].rsplit("/", 1)[0]).select("_rank_pid").distinct()
    assert ranges.count() > 8


def test_star_sizes_the_shuffles_of_its_tables(sized, tmp_path, monkeypatch):
    for name in testdata.TABLES[:2]:
        sized.range(1000).write.parquet(f"{tmp_path}/{name}.parquet")
    size = sum(stored_bytes(sized, f"{tmp_path}/{name}.parquet") for name in testdata.TABLES)
    assert size > 0 and stored_bytes(sized, f"{tmp_path}/none") == 0
    seen = []
    monkeypatch.setattr(testdata, "size_shuffles", lambda spark, n: seen.append(n))
    testdata.load_star(sized, str(tmp_path))
    assert seen == [size]
