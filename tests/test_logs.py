"""Reading logs: file choice, parsing, bad lines, and the text forms of the tables."""

import pytest
from example_rows import ACTIONS
from pyspark.sql import functions as F

from linkweave.config import UpdateConfig
from linkweave.functions.text import action_dir_name, extension_for
from linkweave.operators import ids, prefs
from linkweave.plans.update import update
from linkweave.session import scratch_root, shared_dir
from linkweave.sources import logs, tables


def lines_frame(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def parsed(spark, *lines, **options):
    rows = logs.parse_logs(lines_frame(spark, *lines), **options)
    return [(r.user_id, r.action, r.item_id) for r in rows.collect()]


def test_both_encodings(spark, example_files):
    for name, delim in (("action-logs.csv", ","), ("action-logs.tsv", "\t")):
        lines = logs.scan_logs(spark, str(example_files / name), "no-such-name")
        rows = logs.parse_logs(lines, delim).orderBy(logs.line_order()).collect()
        assert [(r.user_id, r.action, r.item_id) for r in rows] == ACTIONS


@pytest.fixture
def log_tree(tmp_path):
    root = tmp_path / "tree"
    (root / "sub" / "deep").mkdir(parents=True)
    (root / "sub" / "_h" / ".i").mkdir(parents=True)
    names = ["a.tsv", "b.txt", "~c.tsv.bak", "_d.tsv", ".e.tsv", "sub/f.tsv", "sub/deep/g.tsv.1"]
    names += ["sub/_h/.i/j.tsv", "sub/_k.tsv", "sub/_h/l.txt"]
    for name in names:
        (root / name).write_text(name + "\n")
    return root


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        (r".*tsv", {"a.tsv", "sub/f.tsv", "_d.tsv", ".e.tsv", "sub/_h/.i/j.tsv", "sub/_k.tsv"}),
        (".tsv", {"a.tsv", "sub/f.tsv", "sub/deep/g.tsv.1", "sub/_h/.i/j.tsv"}),
        (r"_.*", {"_d.tsv", "sub/_k.tsv"}),
        (r".*\.bak", {"~c.tsv.bak"}),
        (".bak", set()),
        ("b.", {"b.txt"}),
        ("*.tsv", set()),
    ],
)
def test_file_names(spark, log_tree, pattern, expected):
    found = logs.scan_logs(spark, str(log_tree), pattern)
    assert {r.value for r in found.select("value").collect()} == expected


def test_files_by_name(spark, log_tree):
    assert logs.scan_logs(spark, str(log_tree / "b.txt"), ".*tsv").count() == 1
    found = logs.scan_files(spark, [str(log_tree / "b.txt"), str(log_tree / "a.tsv")])
    assert {r.file_name for r in found.collect()} == {"a.tsv", "b.txt"}


def test_trim_and_delimiter(spark):
    assert parsed(spark, " u1 ,\x01buy\x02 , it em ,extra", delim=",") == [("u1", "buy", "it em")]
    assert parsed(spark, "u1|buy;i1", delim="[|;]") == [("u1", "buy", "i1")]
    rows = logs.parse_logs(
        lines_frame(spark, "9\ti\tpurchase\tu"), user_col=3, action_col=2, item_col=1, ts_col=0
    ).collect()
    assert [(r.user_id, r.action, r.item_id, r.ts) for r in rows] == [("u", "purchase", "i", 9)]


@pytest.mark.parametrize("bad", ["", "u1", "u1\tview", "u1\tview\t", "u1\tview\t\t", "u1\tview\t \tx"])
def test_bad_lines(spark, bad):
    good = "u1\tview\ti1"
    with pytest.raises(Exception, match="bad log line"):
        parsed(spark, good, bad)
    assert parsed(spark, good, bad, on_bad_line="drop") == [("u1", "view", "i1")]
    aside = logs.bad_lines(lines_frame(spark, good, bad)).collect()
    assert [r.raw for r in aside] == [bad]


def test_bad_lines_stop_a_count(spark):
    with pytest.raises(Exception, match="bad log line"):
        logs.parse_logs(lines_frame(spark, "u1")).count()


def test_empty_ids_on_request(spark):
    assert parsed(spark, "\tview\ti1", keep_empty_ids=True) == [("", "view", "i1")]
    assert parsed(spark, "\tview\ti1", on_bad_line="drop") == []
    with pytest.raises(ValueError, match="on_bad_line"):
        parsed(spark, "u\tv\ti", on_bad_line="ignore")


def test_roles(spark):
    log = spark.createDataFrame(
        [("u", "Purchase", "i"), ("u", "purchase", "i"), ("u", "purchase", "i"), ("u", "view", "j")],
        "user_id string, action string, item_id string",
    )
    roles = [r.role for r in prefs.split_actions(log, "purchase", "view").collect()]
    assert roles == ["other", "primary", "primary", "secondary"]
    same = prefs.split_actions(log, "purchase", "purchase").collect()
    assert {r.role for r in same} == {"other", "primary"}
    assert prefs.secondary_prefs(log, "purchase", "purchase").count() == 0
    assert prefs.other_actions(log, "purchase", "view").count() == 1
    assert prefs.history_matrix(prefs.primary_prefs(log, "purchase")).count() == 1


def test_names(spark):
    row = spark.range(1).select(action_dir_name(F.lit("Add_To Cart")).alias("d")).first()
    assert row.d == "add-to.cart"
    assert (extension_for(","), extension_for("\t")) == (".csv", ".tsv")


def test_recent_history(spark):
    log = spark.createDataFrame(
        [("u", 1, 5), ("u", 2, 9), ("u", 1, 10), ("u", 3, 9), ("u", 4, 1), ("v", 4, 1)],
        "user_id string, item_id int, ts int",
    )
    rows = prefs.recent_history(log, 3).collect()
    assert {(r.user_id, r.item_id, r["rank"]) for r in rows} == {
        ("u", 1, 1), ("u", 3, 2), ("u", 2, 3), ("v", 4, 1),
    }


def test_dictionary_is_dense_over_many_partitions(spark):
    n = 5000
    log = spark.range(n).select(
        F.col("id").alias("seq"), ((F.col("id") * 7919) % 1009).alias("user_id")
    )
    found = ids.assign_ids(log.repartition(16), "user_id", F.col("seq")).collect()
    expected = {(k * 7919) % 1009: k for k in range(1009)}
    assert {r.ext_id: r.int_id for r in found} == expected


def test_dictionary_text_round_trip(spark, tmp_path):
    names = ["a b", "c,d", "é漢", 'q"r', "tab\there"]
    dictionary = spark.createDataFrame(
        [(name, n) for n, name in enumerate(names)], "ext_id string, int_id bigint"
    )
    path = str(tmp_path / "dict")
    tables.write_dictionary_text(dictionary, path)
    back = tables.read_dictionary_text(spark, path)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in dictionary.collect()}


def test_empty_matrix_is_an_error(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.range(0).write.parquet(path)
    with pytest.raises(ValueError, match="no matrix rows"):
        tables.read_matrix(spark, path)


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_root(spark).startswith(shared_dir(spark))


def test_update_options(spark, tmp_path):
    folder = tmp_path / "in" / "day1"
    folder.mkdir(parents=True)
    lines = [f"{n}\tu{u}\tbuy it\ti {i}" for n, (u, i) in enumerate(
        [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 3), (4, 2), (4, 1), (4, 2)]
    )]
    lines += ["broken", "90\tu9\tclick\ti 9", "91\tu1\tlook\ti 3"]
    (folder / "x.tsv").write_text("\n".join(lines) + "\n")
    config = UpdateConfig(
        str(tmp_path / "in"), str(tmp_path / "out"),
        ts_col=0, user_col=1, action_col=2, item_col=3,
        primary_action="buy it", secondary_action="look", on_bad_line="quarantine",
        cross=True, similarity="SIMILARITY_COSINE", link_delim="|", min_prefs_per_user=1,
        max_prefs_recs=2, max_prefs_similarity=100, max_cross=2, cross_recs_per_user=1,
        max_similar=1, exclude_known=False,
    )
    result = update(spark, config)
    assert [r.raw for r in result["bad_lines"].collect()] == ["broken"]
    assert result["dims"].first().asDict() == {"n_users": 5, "n_items": 4}
    docs = {r.id: r.b_history for r in result["user_history_docs"].collect()}
    assert docs == {"u1": "i 3|i 2|i 1"}
    others = [p.read_text() for p in (tmp_path / "out" / "prefs" / "other").glob("part-*")]
    assert "".join(others) == "90\tu9\tclick\ti 9\n"
    assert (tmp_path / "out" / "prefs" / "by-action" / "action_dir=buy.it").is_dir()
    assert all(r["rank"] == 1 for r in result["p_sims"].collect())
    assert result["s_recs"].count() == 1


def test_hidden_names_below_an_odd_root(spark, tmp_path):
    root = tmp_path / "a{b},[c] d*"
    (root / "x").mkdir(parents=True)
    (root / "x" / "_q.tsv").write_text("one\ntwo\n")
    assert logs.scan_files(spark, logs.hidden_files(spark, str(root), ".*tsv")).count() == 2
    assert logs.hidden_files(spark, str(tmp_path / "none"), ".*") == []
