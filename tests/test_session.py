"""Run sizing and scratch folders."""

from pathlib import Path

from fieldgauge.session import DEFAULTS, path_exists, remove_path, scratch_path, sizing


def test_sizing_follows_the_input():
    def sized(input_bytes):
        found = sizing(input_bytes)
        return int(found["spark.sql.shuffle.partitions"]), int(found["spark.sql.files.maxPartitionBytes"][:-1])

    assert sized(10**9) == (200, 128)
    sizes = [sized(2**k * 1024**3) for k in range(18)]
    assert all(a <= b for one, two in zip(sizes, sizes[1:]) for a, b in zip(one, two))
    assert max(split for _, split in sizes) == 1024
    tib = 1024**4
    partitions, split = sized(4 * tib)
    assert partitions * (4 * tib / (split * 1024**2)) < 1.1e9


def test_scratch_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "y")
    assert Path(a).is_dir() and Path(a).parent == Path(b).parent


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared) and Path(a).is_dir()
    assert path_exists(spark, a)
    remove_path(spark, a)
    assert not path_exists(spark, a) and path_exists(spark, b)
