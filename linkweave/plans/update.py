"""The whole model update: log files in, matrices, recommendations and documents out.

Tables used by several later steps are written first and read back. That keeps each
plan short, and a lost executor costs one step instead of the whole run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkweave.config import UpdateConfig
from linkweave.functions.similarity import MEASURES, VALUE_MEASURES
from linkweave.functions.text import action_dir_name
from linkweave.operators import documents as docs
from linkweave.operators import ids, prefs, recommend, similar, vectors
from linkweave.plans import publish
from linkweave.session import delete_path, settled
from linkweave.sources import logs, tables


def read_actions(
    spark: SparkSession, config: UpdateConfig, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """The parsed log, and the lines set aside when `on_bad_line` is quarantine.

    `seen` observes the numbers of lines and of bad ones as the log is read.
    """
    lines = logs.scan_logs(spark, config.input, config.file_pattern)
    columns = (
        config.input_delim,
        config.user_col,
        config.action_col,
        config.item_col,
        config.ts_col,
    )
    if lines.isEmpty():
        raise ValueError(f"no lines in files like {config.file_pattern!r} at {config.input}")
    options = {
        "keep_empty_ids": config.keep_empty_ids,
        "ts_type": config.ts_type,
        "value_col": config.value_col,
    }
    parsed = logs.parse_logs(
        lines, *columns, on_bad_line=config.on_bad_line, seen=seen, **options
    )
    return parsed, logs.bad_lines(lines, *columns, **options)


def _one_row(spark: SparkSession, numbers: dict[str, int]) -> DataFrame:
    schema = ", ".join(f"{name} bigint" for name in numbers)
    return spark.createDataFrame([tuple(numbers.values())], schema).coalesce(1)


def split_log(spark: SparkSession, config: UpdateConfig) -> dict[str, DataFrame]:
    """Dictionaries, matrix sizes, numbered preferences by action, and the other lines.

    All numbers of `counters` and `dims` are observed by the jobs that write the tables.
    """
    out = config.output.rstrip("/")
    seen, roles, n_users, n_items = (Observation() for _ in range(4))
    parsed, bad = read_actions(spark, config, seen)
    split = prefs.split_actions(parsed, config.primary_action, config.secondary_action)
    counts = [
        F.count_if(F.col("role") == role).alias(f"n_{role}")
        for role in (prefs.PRIMARY, prefs.SECONDARY, prefs.OTHER)
    ]
    log = tables.write_table(
        split.observe(roles, *counts), f"{out}/actions/log", partition_by="role"
    )
    users = tables.write_dictionary(
        ids.assign_ids(log, "user_id", logs.line_order()).observe(
            n_users, F.count(F.lit(1)).alias("n_users")
        ),
        f"{out}/id-indexes/user-index",
    )
    items = tables.write_dictionary(
        ids.assign_ids(log, "item_id", logs.line_order()).observe(
            n_items, F.count(F.lit(1)).alias("n_items")
        ),
        f"{out}/id-indexes/item-index",
    )
    sizes = n_users.get | n_items.get
    dims = tables.write_table(_one_row(spark, sizes), f"{out}/id-indexes/dims")
    counters = tables.write_table(
        _one_row(spark, seen.get | roles.get | sizes), f"{out}/id-indexes/counters"
    )
    rest = ["ts"] if "ts" in log.columns else []
    wanted = log.where(F.col("role") != prefs.OTHER).select(
        "user_id",
        "item_id",
        "weight",
        *rest,
        "role",
        action_dir_name(F.col("action")).alias("action_dir"),
    )
    numbered = tables.write_table(
        ids.encode(wanted, users, items), f"{out}/prefs/numbered", partition_by="role"
    )
    tables.write_prefs_text(numbered, f"{out}/prefs/by-action", config.output_delim)
    others = log.where(F.col("role") == prefs.OTHER).select(F.col("raw").alias("value"))
    others.write.mode("overwrite").text(f"{out}/prefs/other")
    result = {
        "log": log, "users": users, "items": items, "dims": dims, "counters": counters,
        "prefs": numbered,
    }
    if config.on_bad_line == "quarantine":
        result["bad_lines"] = tables.write_table(bad, f"{out}/actions/bad-lines")
    return result


def role_history(numbered: DataFrame, role: str, config: UpdateConfig, path: str) -> DataFrame:
    """Distinct numbered (user_id, item_id) of one role, for users with enough of them.

    With values, also `value`: the last one in a timed log, else the greatest.
    """
    rest = [c for c in ("weight", "ts") if c in numbered.columns]
    chosen = numbered.where(F.col("role") == role).select(
        F.col("user_int").alias("user_id"), F.col("item_int").alias("item_id"), *rest
    )
    if config.value_col >= 0:
        history = prefs.valued_matrix(chosen, "weight", "ts" if "ts" in rest else None)
    else:
        history = prefs.history_matrix(chosen)
    if config.min_prefs_per_user > 1:
        history = prefs.min_prefs(settled(history), config.min_prefs_per_user)
    return tables.write_table(history, path)


def similar_items(history: DataFrame, config: UpdateConfig) -> DataFrame:
    """Scores of all pairs; from the values if there are any and the measure looks at them."""
    history = capped(history, config.max_prefs_similarity)
    by_value = config.similarity in VALUE_MEASURES or config.similarity not in MEASURES
    if config.value_col >= 0 and by_value:
        return similar.value_similarity(history, config.similarity, config.threshold)
    return similar.item_similarity(history, config.similarity, config.threshold)


def capped(history: DataFrame, cap: int | None) -> DataFrame:
    return history if cap is None else prefs.downsample_prefs(history, cap)


def recommendation_history(
    numbered: DataFrame, history: DataFrame, role: str, config: UpdateConfig
) -> DataFrame:
    """The history recommendations are made from: all of it, or the latest items."""
    if config.max_prefs_recs is None:
        return history
    if "ts" not in numbered.columns:
        raise ValueError("max_prefs_recs keeps the latest items and needs ts_col")
    timed = numbered.where(F.col("role") == role).select(
        F.col("user_int").alias("user_id"), F.col("item_int").alias("item_id"), "ts"
    )
    # With the history's values, where it has any.
    known = timed.join(history, ["user_id", "item_id"])
    recent = prefs.recent_history(known, config.max_prefs_recs).drop("rank")
    return recent.join(history, ["user_id", "item_id"]) if "value" in history.columns else recent


def primary_model(
    numbered: DataFrame, config: UpdateConfig
) -> dict[str, DataFrame]:
    """History, similar items and recommendations of the primary action."""
    out = config.output.rstrip("/")
    history = role_history(numbered, prefs.PRIMARY, config, f"{out}/actions/p-action")
    sims = tables.write_table(
        similar.top_similar(similar_items(history, config), config.max_similar),
        f"{out}/p-recs/sims",
    )
    recs = recommend.primary_recs(
        sims,
        recommendation_history(numbered, history, prefs.PRIMARY, config),
        config.recs_per_user,
        config.score_mode,
        history if config.exclude_known else None,
        "value" if config.value_col >= 0 else None,
    )
    return {
        "p_history": history,
        "p_sims": sims,
        "p_recs": tables.write_table(recs, f"{out}/p-recs/recs"),
    }


def cross_model(
    numbered: DataFrame, primary: DataFrame, config: UpdateConfig
) -> dict[str, DataFrame]:
    """Secondary history, cross co-occurrence and cross recommendations."""
    out = config.output.rstrip("/")
    history = role_history(numbered, prefs.SECONDARY, config, f"{out}/actions/s-action")
    cross = similar.cross_cooccurrence(
        capped(primary, config.max_prefs_similarity),
        capped(history, config.max_prefs_similarity),
    )
    if config.max_cross is not None:
        cross = similar.top_similar(cross, config.max_cross, "n_users")
    cross = tables.write_table(cross, f"{out}/s-recs/sims")
    recs = recommend.cross_recs(
        cross,
        recommendation_history(numbered, history, prefs.SECONDARY, config),
        config.cross_recs_per_user,
    )
    return {
        "s_history": history,
        "s_sims": cross,
        "s_recs": tables.write_table(recs, f"{out}/s-recs/recs"),
    }


def build_documents(
    tables_: dict[str, DataFrame], config: UpdateConfig
) -> dict[str, DataFrame]:
    """Item-links and user-history documents, joined when there is a cross model."""
    users, items = tables_["users"], tables_["items"]

    def links(matrix: DataFrame, weight: str) -> DataFrame:
        return docs.decode_links(matrix, "item_id", "other_item_id", weight, items, items, config.part_links)

    def history(matrix: DataFrame) -> DataFrame:
        weighted = matrix.withColumn("weight", F.lit(1.0))
        return docs.decode_links(
            weighted, "user_id", "item_id", "weight", users, items, config.part_links
        )

    own, cross = links(tables_["p_sims"], "score"), None
    primary, secondary = history(tables_["p_history"]), None
    if config.cross:
        cross = links(tables_["s_sims"], "n_users")
        secondary = history(tables_["s_history"])
    options = {"how": config.documents_join, "delim": config.link_delim}
    return {
        "item_links_docs": docs.item_links_docs(own, cross, **options),
        "user_history_docs": docs.user_history_docs(primary, secondary, **options),
    }


def _build(spark: SparkSession, config: UpdateConfig) -> dict[str, DataFrame]:
    """Everything, written below `config.output`."""
    out = config.output.rstrip("/")
    result = split_log(spark, config)
    result |= primary_model(result["prefs"], config)
    if config.cross:
        result |= cross_model(result["prefs"], result["p_history"], config)
        result["active_users"] = tables.write_table(
            vectors.active_user_counts(result["p_history"], result["s_history"]),
            f"{out}/id-indexes/active-users",
        )
    for name, table in build_documents(result, config).items():
        path = f"{out}/{name.replace('_', '-')}"
        tables.write_documents(table, path)
        result[name] = tables.read_documents(spark, path, table.schema)
    return result


def update(spark: SparkSession, config: UpdateConfig) -> dict[str, DataFrame]:
    """Run everything and return the published tables by name.

    All is written to a staging folder of the output and then put in the place of the
    former model (see `publish`): a run that fails leaves that model whole. Other things
    in the output folder are left alone.
    """
    staging = publish.begin(spark, config.output)
    try:
        result = _build(spark, replace(config, output=staging))
    except BaseException:
        delete_path(spark, staging)
        raise
    return publish.publish(spark, config.output, staging, result)
