"""A model is published as a whole: what happens when a run fails or is cut off."""

import pytest

from linkweave import UpdateConfig
from linkweave.plans import publish
from linkweave.plans import update as plan
from linkweave.sources import tables


@pytest.fixture
def config(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    return UpdateConfig(str(logs), str(tmp_path / "model"), cross=True, on_bad_line="drop")


def log(config, users, extra=""):
    lines = [f"u{u}\tpurchase\ti{(u + k) % 4}\nu{u}\tview\ti{k}" for u in range(users) for k in (0, 2)]
    with open(f"{config.input}/a.tsv", "w") as file:
        file.write("\n".join([*lines, extra]))


def rows(model):
    return {name: sorted(map(str, df.collect())) for name, df in model.items()}


def test_failed_run_leaves_the_old_model(spark, config, monkeypatch, tmp_path):
    log(config, 5)
    before = rows(plan.update(spark, config))
    log(config, 9)

    def fails(*_):
        raise RuntimeError("no documents")

    with monkeypatch.context() as patch:
        patch.setattr(plan, "build_documents", fails)
        with pytest.raises(RuntimeError, match="no documents"):
            plan.update(spark, config)
    assert rows(publish.read_model(spark, config.output)) == before
    assert not list((tmp_path / "model").glob("_staging-*"))
    after = rows(plan.update(spark, config))
    assert after != before and after["dims"] == ["Row(n_users=9, n_items=4)"]


@pytest.mark.parametrize("moves", [0, 3, 12])
def test_publication_that_was_cut_off(spark, config, monkeypatch, moves):
    """Whoever reads next finds the new model, whole."""
    log(config, 5)
    plan.update(spark, config)
    log(config, 7)
    move, done = publish._Folder.move, []

    def stops(self, *names):
        if len(done) == moves:
            raise KeyboardInterrupt
        done.append(names)
        move(self, *names)

    with monkeypatch.context() as patch:
        patch.setattr(publish._Folder, "move", stops)
        with pytest.raises(KeyboardInterrupt):
            plan.update(spark, config)
    model = publish.read_model(spark, config.output)
    assert model["dims"].first().n_users == 7
    assert model["user_history_docs"].count() == 7 and model["p_history"].count() == 14
    files = {p.name for p in __import__("pathlib").Path(config.output).iterdir()}
    assert files >= {"_MODEL", "p-recs"} and not any(f.startswith(("_staging", "_PUBL")) for f in files)


def test_tables_that_the_new_model_lacks_go(spark, config, tmp_path):
    from dataclasses import replace

    log(config, 5)
    plan.update(spark, config)
    (tmp_path / "model" / "notes").write_text("not ours")
    model = plan.update(spark, replace(config, cross=False))
    assert "s_sims" not in model and not (tmp_path / "model" / "s-recs" / "sims").exists()
    assert (tmp_path / "model" / "notes").read_text() == "not ours"


def test_counters_come_from_the_writing_jobs(spark, config):
    log(config, 5, "broken\nu1\tshare\ti9")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("split", "")
    result = plan.split_log(spark, config)
    jobs = len(tracker.getJobIdsForGroup("split"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert result["counters"].first().asDict() == {
        "n_lines": 22, "n_bad_lines": 1, "n_primary": 10, "n_secondary": 10, "n_other": 1,
        "n_users": 5, "n_items": 5,
    }
    assert 0 < jobs < 40


def test_no_model(spark, tmp_path):
    with pytest.raises(ValueError, match="no model"):
        publish.read_model(spark, str(tmp_path / "nothing"))


def test_no_rows_no_matrix(spark, config):
    log(config, 3)
    model = plan.update(spark, config)
    assert tables.read_matrix(spark, f"{config.output}/p-recs/sims").count() == model["p_sims"].count()
