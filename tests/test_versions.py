"""Sets of tables that are replaced together: all old or all new, also when a run breaks off."""

import datetime as dt
from types import SimpleNamespace

import pytest

from clientele.plans import pipeline
from clientele.sources import sinks

AS_OF = dt.date(2024, 1, 1)


def contents(spark, folder, version=None):
    return {name: df.first().v for name, df in sinks.read_version(spark, folder, version).items()}


def test_readers_see_all_old_or_all_new_tables(spark, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "results"), []
    star = SimpleNamespace(customer=spark.range(1))

    def run(value, tables, breaks=False):
        def job(star, as_of, out_dir):
            for name in tables:
                seen.append(contents(spark, folder) if sinks.published_versions(spark, folder) else None)
                sinks.write_table(spark.range(1).selectExpr(f"{value} AS v"), f"{out_dir}/{name}")
            if breaks:
                raise RuntimeError("lost")
        monkeypatch.setattr(pipeline, "run_pipeline", job)
        return pipeline.publish_results(star, AS_OF, folder)

    with pytest.raises(ValueError, match="no published version"):
        sinks.read_version(spark, folder)
    first = run(1, "ab")
    assert contents(spark, folder) == {"a": 1, "b": 1} and seen == [None, None]
    with pytest.raises(RuntimeError):
        run(2, "ab", breaks=True)
    assert contents(spark, folder) == {"a": 1, "b": 1}       # what broke off is never seen
    second = run(3, "bc")                                    # a table less, a table more
    assert contents(spark, folder) == {"b": 3, "c": 3}
    assert seen[2:] == [{"a": 1, "b": 1}] * 4                # old tables until the switch
    assert contents(spark, folder, first) == {"a": 1, "b": 1}
    assert sinks.published_versions(spark, folder) == [first, second]


def test_old_versions_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "results")
    made = []
    for value in range(3):
        made.append(sinks.new_version(spark, folder))
        sinks.write_table(spark.range(1).selectExpr(f"{value} AS v"), f"{folder}/{made[-1]}/a")
        sinks.publish_version(spark, folder, made[-1])
    assert made == sorted(made)
    with pytest.raises(ValueError, match="published before"):
        sinks.publish_version(spark, folder, made[0])
    assert sinks.drop_versions(spark, folder, keep=1) == made[:2]
    assert contents(spark, folder) == {"a": 2}
    with pytest.raises(ValueError, match="current version"):
        sinks.drop_versions(spark, folder, keep=0)
