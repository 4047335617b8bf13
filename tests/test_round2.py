"""Results that must not change with the size of the data, and scans by name."""

import pytest
from pyspark.sql import functions as F

from linkweave import UpdateConfig
from linkweave.functions import similarity
from linkweave.operators import search, similar
from linkweave.plans.update import update
from linkweave.session import scratch_root
from linkweave.sources import logs


def scores(spark, measure, *counts):
    rows = spark.createDataFrame([tuple(map(int, c)) for c in counts], "k long, i long, j long, n long")
    columns = [F.col(c) for c in "kijn"]
    return [r[0] for r in rows.select(similarity.resolve(measure)(*columns)).collect()]


def test_ratios_of_large_counts_stay_apart(spark):
    n = 10**8
    for size, both in ((10**5, (40_000, 50_000)), (10**6, (200_000, 300_000))):
        low, high = scores(
            spark, "SIMILARITY_LOGLIKELIHOOD", *[(k, size, size, n) for k in both]
        )
        assert low < high < 1


@pytest.mark.parametrize("measure", sorted(similarity.MEASURES))
def test_popular_items_with_one_common_user_have_a_score(spark, measure):
    (score,) = scores(spark, measure, (1, 1_600_000, 1_600_000, 10**9))
    assert score > 0


def test_independence_is_decided_on_whole_numbers(spark):
    rows = spark.createDataFrame(
        [(10**6, 10**9, 10**9, 10**12), (10**6 + 1, 10**9, 10**9, 10**12)],
        "k long, i long, j long, n long",
    )
    columns = [F.col(c) for c in "kijn"]
    assert [r[0] for r in rows.select(similarity.dependent(*columns)).collect()] == [False, True]


def test_own_measure_keeps_small_and_negative_scores(spark):
    history = spark.createDataFrame([(1, 1), (1, 2)], "user_id long, item_id long")
    found = similar.item_similarity(history, lambda k, i, j, n: -1e-9 * k).collect()
    assert {r.score for r in found} == {-1e-9}


def test_boost_brings_in_an_item_from_outside_the_plain_top(spark):
    links = spark.createDataFrame(
        [(0, n, 1.0 - n / 100) for n in range(1, 21)],
        "item_id long, other_item_id long, score double",
    )
    category = spark.createDataFrame(
        [(n, "a" if n in (0, 20) else "b") for n in range(21)], "item_id long, category string"
    )
    seeds = category.where("item_id = 0")
    found = search.query_cold_start(seeds, links, category, n=10).collect()
    assert {r.item_id for r in found} == {*range(1, 10), 20}
    assert next(r.rank for r in found if r.item_id == 20) == 1


def write(path, text="u\tpurchase\ti\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_scan_reads_the_named_directory_only(spark, tmp_path):
    for name in ("data/metadata", "data/olddata", "data/a.tsv"):
        write(tmp_path / name)
    assert logs.scan_logs(spark, str(tmp_path / "data"), ".*tsv").count() == 1


@pytest.mark.parametrize("name", ["my log.tsv", "a+b.tsv", "журнал.tsv", "50%.tsv"])
def test_names_are_as_on_disk(spark, tmp_path, name):
    write(tmp_path / "in" / name)
    assert logs.scan_logs(spark, str(tmp_path / "in" / name), "none").count() == 1
    found = logs.scan_logs(spark, str(tmp_path / "in"), ".*tsv")
    assert [r.file_name for r in found.collect()] == [name]


def test_pattern_is_a_java_regex(spark, tmp_path):
    write(tmp_path / "in" / "abc.tsv")
    write(tmp_path / "in" / "a1.tsv")
    found = logs.scan_logs(spark, str(tmp_path / "in"), r"\p{Alpha}+\.tsv").collect()
    assert [r.file_name for r in found] == ["abc.tsv"]


def test_times_are_ordered_as_numbers(spark):
    lines = spark.createDataFrame([("999\tu\tp\ta",), ("1000\tu\tp\tb",), ("x\tu\tp\tc",)], "value string")
    options = {"ts_col": 0, "user_col": 1, "action_col": 2, "item_col": 3}
    rows = logs.parse_logs(lines, on_bad_line="drop", **options)
    assert rows.orderBy(F.desc("ts")).first().item_id == "b"
    assert logs.bad_lines(lines, **options).count() == 1


def test_no_input_is_an_error_and_replaces_nothing(spark, tmp_path):
    write(tmp_path / "in" / "a.tsv", "u\tpurchase\ti\nu\tpurchase\tj\nv\tpurchase\ti\n")
    options = {"input": str(tmp_path / "in"), "output": str(tmp_path / "out")}
    before = update(spark, UpdateConfig(**options))["p_history"].count()
    with pytest.raises(ValueError, match="no lines"):
        update(spark, UpdateConfig(file_pattern="nothing", **options))
    assert spark.read.parquet(str(tmp_path / "out" / "actions" / "log")).count() == before


def test_latest_items_need_a_time(spark, tmp_path):
    write(tmp_path / "in" / "a.tsv")
    with pytest.raises(ValueError, match="ts_col"):
        update(
            spark, UpdateConfig(str(tmp_path / "in"), str(tmp_path / "out"), max_prefs_recs=3)
        )


def test_scratch_goes_with_the_session(spark):
    assert scratch_root(spark) == scratch_root(spark)
