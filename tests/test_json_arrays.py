"""Arrays cut into many blocks, against Python's reader, and files that are not whole."""

import json
import random

import pytest

from tallyforge.sources import landing
from tallyforge.sources.json_arrays import array_records


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_record(toss):
    texts = ["", "}", "},{", '"', '\\', '\\"}', "]", "[{", "é🙂", "\n", "{\"a\":1}", "plain words"]
    record = {f"k{i}": toss.choice([toss.choice(texts), toss.random(), None, True, [], {}]) for i in range(toss.randint(0, 4))}
    if toss.random() < 0.3:
        record["deep"] = {"a": [{"b": toss.choice(texts)}, [], [1, {"c": {}}]], "t": toss.choice(texts)}
    if toss.random() < 0.1:
        record["long"] = toss.choice(texts) * 60
    return record


def records_of(spark, path):
    return sorted((r.raw_data for r in array_records(spark, str(path)).collect()))


def test_many_blocks_give_the_records_as_they_stand(spark, tmp_path, small_blocks):
    toss, expected = random.Random(4), []
    for i in range(12):
        rows = [odd_record(toss) for _ in range(toss.choice([0, 1, 2, 30]))]
        gap = toss.choice(["", " ", "\n", " \n\t"])
        texts = [json.dumps(r, ensure_ascii=toss.random() < 0.5, indent=toss.choice([None, 1])) for r in rows]
        (tmp_path / f"p {i}%ä.json").write_text(f"{gap}[{gap}" + f"{gap},{gap}".join(texts) + f"{gap}]{gap}")
        expected += texts
    assert records_of(spark, tmp_path) == sorted(expected)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "page.json").write_text(json.dumps([{"n": i, "t": "x" * 50} for i in range(200)]))
    tasks = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 50
    got = [json.loads(r)["n"] for r in records_of(spark, tmp_path)]
    assert sorted(got) == list(range(200))


def test_text_is_neither_sorted_nor_shuffled(spark, tmp_path):
    (tmp_path / "page.json").write_text(GOOD)
    plan = array_records(spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("piece" in line for line in windows)
    assert "collect_list" not in "".join(line for line in plan.splitlines() if "piece" in line)
    for name in ("Sort ", "Aggregate"):  # what is sorted or grouped are fragments of the few records across blocks
        assert not any("piece#" in line for line in plan.splitlines() if name in line)


@pytest.mark.parametrize("rows", ["1", "3"])
def test_a_block_of_many_batches(spark, tmp_path, rows):
    key, toss, expected = "spark.sql.execution.arrow.maxRecordsPerBatch", random.Random(int(rows)), []
    for i in range(5):
        rows_of = [odd_record(toss) for _ in range(toss.choice([0, 1, 40]))]
        texts = [json.dumps(r, ensure_ascii=False) for r in rows_of]
        (tmp_path / f"{i}.json").write_text(f"[{', '.join(texts)}]\n")
        expected += texts
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        assert records_of(spark, tmp_path) == sorted(expected)
    finally:
        spark.conf.set(key, before)


GOOD = '[{"a": "x}y", "b": {"c": [1, 2]}}, {"a": 2}]'


@pytest.mark.parametrize(
    "text",
    [
        "", " \n", "[", "]", "{}", '{"a": 1}', "[1, 2]", '["a"]', "[{}, 1]", "[{} {}]", "[{},, {}]", "[,{}]", "[{},]", "[{}]]", "[{}] x",
        "[[{}]]", "[{}", '[{"a": 1}, {"a"', '[{"a": "x}]', '[{"a": tru}]', '[{"a" 1}]', "[{}][{}]", '[{"a": 1]}', "x[{}]",
    ],
)
def test_damaged_page_raises(spark, tmp_path, text):
    (tmp_path / "good.json").write_text(GOOD)
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="not a whole JSON array of objects: .*bad.json"):
        array_records(spark, str(tmp_path)).collect()


def test_every_truncation_of_a_page_raises(spark, tmp_path, small_blocks):
    place = tmp_path / "page.json"
    for cut in range(0, len(GOOD), 5):
        place.write_text(GOOD[:cut])
        with pytest.raises(Exception, match="not a whole JSON array"):
            landing.read_landed(spark, str(tmp_path), "array").collect()
    place.write_text(GOOD)
    assert landing.read_landed(spark, str(tmp_path), "array").count() == 2
