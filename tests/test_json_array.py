"""JSON array files in byte ranges against json.loads."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from segrec.sources import read_documents
from segrec.sources.json_array import read_json_array, write_json_array

SCHEMA = "id bigint, s string, l array<struct<x:bigint,t:string>>, m struct<a:string>"
PIECES = ["a", "é日", '"', "\\", "\\\\", '\\"', "{", "}", "},{", "[", "]", "\n", "}]", '{"', ",", "🙂", ""]


@pytest.fixture
def split_bytes(spark):
    """Ranges of so many bytes while a test runs."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    usual = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)
        spark.conf.set(names[2], 1)

    yield use
    for n, v in usual.items():
        if v is None:
            spark.conf.unset(n)
        else:
            spark.conf.set(n, v)


def element(rng, i):
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(8)))
    e = {"id": i, "s": text() if rng.random() < 0.9 else None, "l": [{"x": k, "t": text()} for k in range(rng.randrange(4))]}
    if rng.random() < 0.5:
        e["m"] = {"a": text()}
    if rng.random() < 0.3:
        e["other " + text()] = [[{}], {"b": [text(), {"c": text()}]}]
    return e


def plain(elements):
    return sorted((e["id"], e.get("s"), [(x["x"], x["t"]) for x in e["l"]], e.get("m") and e["m"]["a"]) for e in elements if isinstance(e, dict))


def rows(df):
    return sorted((r.id, r.s, [tuple(x) for x in r.l], r.m and r.m.a) for r in df.collect())


@pytest.mark.parametrize("size", [41, 300, 4000, 1 << 20])
@pytest.mark.parametrize("layout", [{}, {"separators": (",", ":"), "ensure_ascii": False}, {"indent": 2, "ensure_ascii": False}])
def test_arrays_in_ranges(spark, tmp_path, split_bytes, size, layout):
    rng = random.Random(size)
    elements = [element(rng, i) for i in range(60)] + [None, 5, "{[\"} text", [], [1, {"id": 7}], [[{"id": 1}]], element(rng, 99)]
    rng.shuffle(elements)
    more = [element(rng, 1000 + i) for i in range(30)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(elements, **layout), encoding="utf-8")
    (tmp_path / "a" / "two.json").write_text(" \n" + json.dumps(more, **layout) + "\n \n", encoding="utf-8")
    (tmp_path / "a" / "none.json").write_text("[]", encoding="utf-8")
    split_bytes(size)
    got = read_json_array(spark, str(tmp_path / "a"), SCHEMA)
    assert rows(got) == plain(elements + more)
    if size <= 300:
        assert spark.read.text(str(tmp_path / "a")).rdd.getNumPartitions() > 20


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.builds(lambda i, s: {"id": i, "s": s, "l": []}, st.integers(0, 9), st.text(alphabet='"\\{}[],ab\n', max_size=12)), max_size=8),
       st.integers(3, 40))
def test_any_strings(spark, tmp_path, split_bytes, elements, size):
    path = tmp_path / "x.json"
    path.write_text(json.dumps(elements), encoding="utf-8")
    split_bytes(size)
    assert rows(read_json_array(spark, str(path), SCHEMA)) == plain(elements)


def test_an_object_over_many_ranges(spark, tmp_path, split_bytes):
    elements = [{"id": 1, "s": "}" * 500 + "{" * 700, "l": []}, {"id": 2, "s": "x", "l": [{"x": k, "t": "}{"} for k in range(300)]}, {"id": 3, "s": "", "l": []}]
    (tmp_path / "big.json").write_text(json.dumps(elements), encoding="utf-8")
    split_bytes(50)
    assert rows(read_json_array(spark, str(tmp_path / "big.json"), SCHEMA)) == plain(elements)


@pytest.mark.parametrize("text", ['{"id": 1}', '[{"id": 1}', '[{"id": 1', '[{"id": "1]', "[1, 2", '[]]', "7"])
def test_no_arrays(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text, encoding="utf-8")
    with pytest.raises(ValueError):
        read_json_array(spark, str(tmp_path / "bad.json"), SCHEMA)


def test_ranges_that_were_not_known_are_an_error(spark, tmp_path, split_bytes):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "s": "abc", "l": []} for i in range(200)]), encoding="utf-8")
    split_bytes(3000)
    df = read_json_array(spark, str(tmp_path / "a.json"), SCHEMA)
    split_bytes(700)
    with pytest.raises(Exception, match="no begin of a range"):
        df.collect()
    split_bytes(6000)
    assert df.count() == 200


def test_written_arrays_and_documents(spark, tmp_path, split_bytes):
    docs = spark.createDataFrame([(i, i % 3, [(i, f't"{i}', 0.5)]) for i in range(200)],
                                 "user_id bigint, cluster bigint, recommendations array<struct<movie_id:bigint,movie_title:string,score:double>>")
    write_json_array(docs.repartition(3), str(tmp_path / "docs"))
    assert len([json.loads(p.read_text()) for p in (tmp_path / "docs").glob("part-*")]) == 3
    split_bytes(500)
    key = lambda r: r.user_id
    assert sorted(read_documents(spark, str(tmp_path / "docs"), multiline=True).collect(), key=key) == sorted(docs.collect(), key=key)
    write_json_array(docs.limit(0).coalesce(1), str(tmp_path / "none"))
    assert read_documents(spark, str(tmp_path / "none"), multiline=True).count() == 0


def test_many_ranges_share_few_tasks(spark, tmp_path, split_bytes):
    elements = [{"id": i, "s": "}\"{" * (i % 5), "l": []} for i in range(3000)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(elements), encoding="utf-8")
    split_bytes(200)
    ranges = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    got = read_json_array(spark, str(tmp_path), SCHEMA)
    few = 4 * spark.sparkContext.defaultParallelism
    assert ranges > 8 * few
    assert rows(got) == plain(elements + elements)
    got.write.parquet(str(tmp_path / "out"))
    # the objects of the ranges, and those put together, of a shuffle
    assert len(list((tmp_path / "out").glob("part-*"))) <= few + int(spark.conf.get("spark.sql.shuffle.partitions"))
