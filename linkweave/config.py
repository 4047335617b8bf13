"""Options of a model update."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class UpdateConfig:
    input: str
    output: str

    # Column positions in a log line; ts_col = -1 means there is no time column.
    user_col: int = 0
    action_col: int = 1
    item_col: int = 2
    ts_col: int = -1
    value_col: int = -1  # column of a preference's value; -1 means that all are 1
    ts_type: str = "bigint"  # or timestamp; a time that is none makes a bad line

    primary_action: str = "purchase"
    secondary_action: str = "view"
    file_pattern: str = ".*tsv"
    input_delim: str = "\t"  # a regular expression
    output_delim: str = "\t"  # of the preference and dictionary text files
    link_delim: str = " "  # between the ids of one document field
    on_bad_line: str = "fail"  # fail | drop | quarantine
    keep_empty_ids: bool = False

    cross: bool = False
    similarity: str = "SIMILARITY_LOGLIKELIHOOD"
    min_prefs_per_user: int = 1
    max_similar: int = 100
    threshold: float | None = None
    recs_per_user: int = 10
    score_mode: str = "sum"  # sum | weighted_average
    exclude_known: bool = True
    documents_join: str = "inner"  # inner | full
    part_links: int = 100_000  # links in one row of a document; further ones go on in parts

    # Caps that change results; None keeps every preference.
    max_prefs_similarity: int | None = None
    max_prefs_recs: int | None = None
    max_cross: int | None = None
    cross_recs_per_user: int | None = None
