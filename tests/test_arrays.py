"""JSON arrays cut into splits at every byte."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tunesmith.sources import read_completions, read_json_arrays
from tunesmith.sources.arrays import array_elements, pieces, scan


@pytest.fixture
def split_bytes(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def values(df):
    return [json.loads(r.v) for r in df.select("pos", F.to_json("value").alias("v")).orderBy("pos").collect()]


def made(rng, deep=0):
    kind = rng.randint(0, 6 if deep < 3 else 3)
    if kind < 3:
        return "".join(rng.choices('ab,[]{}":\\\n é🙂\t/', k=rng.randint(0, 12)))
    if kind == 3:
        return rng.choice([None, True, 12, -3])
    if kind < 6:
        return [made(rng, deep + 1) for _ in range(rng.randint(0, 4))]
    return {f"k{i},\"]": made(rng, deep + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize(("n", "sizes"), [(40, (1 << 20, 500)), (3, (40, 7))])
def test_every_split_size_gives_the_same_elements(spark, tmp_path, split_bytes, n, sizes):
    rng = random.Random(n)
    want = []
    for name in ("a", "b", "c"):
        items = [made(rng) for _ in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps(items, ensure_ascii=name == "a", indent=2 if name == "b" else None))
        want += items
    for size in sizes:
        split_bytes(size)
        df = read_json_arrays(spark, str(tmp_path))
        assert [r.pos for r in df.select("pos").orderBy("pos").collect()] == list(range(3 * n))
        assert values(df) == want, size


def test_one_file_is_read_by_many_tasks(spark, tmp_path, split_bytes):
    (tmp_path / "one.json").write_text(json.dumps([{"prompt": f"p{i}", "completion": "c, ] \" \\" * 20} for i in range(1000)]))
    split_bytes(20_000)
    assert scan(pieces(spark, str(tmp_path))).count() > 4
    elements, sizes, _, others = array_elements(spark, str(tmp_path))
    assert list(sizes.values()) == [1000] and not others and elements.count() == 1000
    rows = read_completions(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.prompt for r in rows] == [f"p{i}" for i in range(1000)] and {r.completion for r in rows} == {"c, ] \" \\" * 20}


def test_one_element_over_many_splits(spark, tmp_path, split_bytes):
    items = ["x,[" * 1500, [["y, "] * 600], "z"]
    (tmp_path / "one.json").write_text("  \n " + json.dumps(items) + " \n\n")
    split_bytes(500)
    assert values(read_json_arrays(spark, str(tmp_path))) == items


def test_arrays_lines_and_empty_files_together(spark, tmp_path, split_bytes):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text(" [ ]\n")
    (tmp_path / "c.json").write_text('{"a": 1}\n\n"two, 2"\n[3, 4]\n')
    (tmp_path / "d.json").write_text('["five",\n{"six": [6]}]')
    (tmp_path / "f.json").write_bytes(b"\xef\xbb\xbf[9]")
    (tmp_path / "g.json").write_text("10")
    for size in (1 << 20, 8):
        split_bytes(size)
        got = values(read_json_arrays(spark, str(tmp_path)))
        assert got == [{"a": 1}, "two, 2", [3, 4], "five", {"six": [6]}, 9, 10]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.json").write_text("\n")
    assert read_json_arrays(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("text", ['["open', "[1, 2", "[1, {]", "[1,,2]", "[1] 2]", "[7]\n[8]", "{1}", "no json"])
def test_broken_files_fail_with_their_name(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="neither a JSON array nor JSON lines.*bad.json"):
        read_json_arrays(spark, str(tmp_path)).collect()
