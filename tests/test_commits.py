"""Snapshots that become visible as a whole."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from tidewalk.sources import commits

SCHEMA = "n int"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def read(spark, root):
    frame, number = commits.newest(spark, root, numbers(spark).schema)
    return sorted(r.n for r in frame.collect()), number


def test_the_newest_commit_is_read(spark, tmp_path):
    root = str(tmp_path / "r")
    assert read(spark, root) == ([], 0)
    for number in (1, 2, 10):
        commits.commit(numbers(spark, number, 100), root, number)
    assert read(spark, root) == ([10, 100], 10)


def test_a_half_written_snapshot_is_not_read_and_blocks_nobody(spark, tmp_path):
    root = tmp_path / "r"
    commits.commit(numbers(spark, 1), str(root), 1)
    numbers(spark, 99).write.parquet(f"{root}/data/abandoned")  # its writer died before the commit
    half = root / "data" / "torn"
    half.mkdir()
    (half / "part-00000.parquet").write_bytes(b"PAR1 torn")
    assert read(spark, str(root)) == ([1], 1)
    commits.commit(numbers(spark, 2), str(root), 2)
    assert read(spark, str(root)) == ([2], 2)


def test_of_two_publishers_of_one_number_one_fails(spark, tmp_path):
    root = str(tmp_path / "r")

    def publish(value):
        try:
            commits.commit(numbers(spark, value), root, 1)
            return value
        except commits.NumberTaken:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [v for v in pool.map(publish, range(4)) if v is not None]
    assert len(won) == 1 and read(spark, root) == (won, 1)
    with pytest.raises(commits.NumberTaken):
        commits.commit(numbers(spark, 7), root, 1)
    assert read(spark, root) == (won, 1)
    assert not [p for p in (tmp_path / "r" / "commits").iterdir() if p.name.endswith(".tmp")]


def test_put_if_absent_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert commits.put_if_absent(spark, path, "first\n") and not commits.put_if_absent(spark, path, "second\n")
    assert open(path).read() == "first\n"
