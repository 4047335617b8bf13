"""The registered queries as plain SQL over the same tables, for checking."""

from __future__ import annotations

TOP = 10
DOCUMENT_LINKS = 100
QUERY_PART = 5

EVENTS = """ev AS (SELECT event_id, ts, user_id, event_type AS action,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id FROM events)"""
ORDERS = """ev AS (SELECT o_custkey AS user_id, l_returnflag AS action,
  l_partkey AS item_id, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _history(name: str, action: str) -> str:
    return f"{name} AS (SELECT DISTINCT user_id, item_id FROM ev WHERE action = '{action}')"


EVENT_B, EVENT_A = _history("b", "purchase"), _history("a", "view")
ORDER_B, ORDER_A = _history("b", "N"), _history("a", "R")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def _cell(count: str, row: str, column: str) -> str:
    ratio = f"({count}) * n_all / (({row}) * ({column}))"
    return f"(CASE WHEN ({count}) > 0 THEN ({count}) * ln({ratio}) ELSE 0.0 END)"


_RATIO = "2.0 * (" + " + ".join(
    (
        _cell("k", "n_i", "n_j"),
        _cell("n_i - k", "n_i", "n_all - n_j"),
        _cell("n_j - k", "n_all - n_i", "n_j"),
        _cell("n_all - n_i - n_j + k", "n_all - n_i", "n_all - n_j"),
    )
) + ")"

# Pairs whose counts are those of independence have no log-likelihood ratio.
_DEPENDENT = """CAST(k AS HUGEINT) * CAST(n_all AS HUGEINT)
  <> CAST(n_i AS HUGEINT) * CAST(n_j AS HUGEINT)"""

MEASURES = {
    "llr": f"1.0 - 1.0 / (1.0 + CAST(CAST(greatest(0.0, {_RATIO}) AS FLOAT) AS DOUBLE))",
    "cosine": "k / sqrt(n_i * n_j)",
    "tanimoto": "k / (n_i + n_j - k)",
    "euclidean": "1.0 / (1.0 + sqrt(n_i + n_j - 2 * k))",
    "city_block": "1.0 / (1.0 + n_i + n_j - 2 * k)",
    "own_measure": "k / least(n_i, n_j)",
    "count": "k",
}

BITS, LIMB = 30, "1073741824.0"


def _exact_sum(x: str, top: str = "0") -> str:
    """Sum of scores up to 2**top, in three whole numbers of 30 bits each."""
    rest, parts = f"(({x}) * pow(2.0, {BITS} - ({top})))", []
    for _ in range(3):
        parts.append(f"floor({rest})")
        rest = f"(({rest} - floor({rest})) * {LIMB})"
    first, second, third = (f"CAST(sum(CAST({p} AS BIGINT)) AS DOUBLE)" for p in parts)
    return f"((({third} / {LIMB} + {second}) / {LIMB} + {first}) * pow(2.0, ({top}) - {BITS}))"


def _power(x: str, table: str) -> str:
    return f"(SELECT ceil(log2(greatest(1.0, max(abs({x}))))) FROM {table})"


def _units(x: str) -> str:
    return f"CAST(floor(({x}) * 4294967296.0 + 0.5) AS BIGINT)"


def _sims(measure: str, history: str = "b") -> str:
    return f"""cnt AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS n FROM {history} GROUP BY 1),
tot AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS n_all FROM {history}),
prs AS (SELECT x.item_id, y.item_id AS other_item_id, count(*) AS n_both
  FROM {history} x JOIN {history} y ON x.user_id = y.user_id AND x.item_id <> y.item_id
  GROUP BY 1, 2),
sims AS (SELECT item_id, other_item_id, n_both, {MEASURES[measure]} AS score
  FROM (SELECT p.*, CAST(n_both AS DOUBLE) AS k, ci.n AS n_i, cj.n AS n_j, n_all
    FROM prs p JOIN cnt ci ON ci.item_id = p.item_id
    JOIN cnt cj ON cj.item_id = p.other_item_id CROSS JOIN tot)
  WHERE {_DEPENDENT if measure == "llr" else "true"})"""


def _top(name: str, source: str, score: str, k: int = TOP) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id
  ORDER BY {score} DESC, other_item_id DESC) AS INTEGER) AS rank FROM {source})
  WHERE rank <= {k})"""


LINKS = _sims("llr") + ",\n" + _top("links", "sims", "score", DOCUMENT_LINKS)
TOP_LINKS = _sims("llr") + ",\n" + _top("links", "sims", "score")
CROSS = """ba AS (SELECT b.item_id, a.item_id AS other_item_id, count(*) AS n_users
  FROM b JOIN a ON a.user_id = b.user_id GROUP BY 1, 2)"""
CROSS_LINKS = CROSS + ",\n" + _top("links_ba", "ba", "n_users")


def _best(source: str, score: str, columns: str, n: int = TOP, key: str = "user_id") -> str:
    return f"""SELECT {columns}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {key}
  ORDER BY {score} DESC, item_id DESC) AS INTEGER) AS rank FROM {source}) WHERE rank <= {n}"""


CROSS_RECS = """xr AS (SELECT a.user_id, ba.item_id, CAST(sum(n_users) AS DOUBLE) AS score
  FROM a JOIN ba ON ba.other_item_id = a.item_id GROUP BY 1, 2)"""
TOPS = f"tops AS (SELECT {_power('score', 'links')} AS top)"
PRIMARY_RECS = f"""{TOPS},
pr AS (SELECT b.user_id, l.item_id, count(*) AS n_terms,
  {_exact_sum('score', '(SELECT top FROM tops)')} AS score
  FROM b JOIN links l ON l.other_item_id = b.item_id
  WHERE NOT EXISTS (SELECT 1 FROM b k WHERE k.user_id = b.user_id AND k.item_id = l.item_id)
  GROUP BY 1, 2)"""

DICTIONARIES = """ud AS (SELECT user_id AS ext_id,
  row_number() OVER (ORDER BY min(event_id)) - 1 AS int_id FROM ev GROUP BY 1),
idd AS (SELECT item_id AS ext_id,
  row_number() OVER (ORDER BY min(event_id)) - 1 AS int_id FROM ev GROUP BY 1)"""


def _docs(name: str, source: str, key: str, other: str, weight: str, keep: int = 10**9) -> str:
    return f"""{name} AS (SELECT {key} AS id,
  string_agg(CAST({other} AS VARCHAR), ' ' ORDER BY w DESC, int_id DESC) AS links
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY w DESC, int_id DESC) AS rn
    FROM (SELECT s.*, {weight} AS w, d.int_id FROM {source} s JOIN idd d ON d.ext_id = s.{other}))
  WHERE rn <= {keep} GROUP BY 1)"""


OWN_DOCS = _sims("llr") + ",\n" + _docs(
    "bb_docs", "sims", "item_id", "other_item_id", "score",
    DOCUMENT_LINKS,
)
CROSS_DOCS = CROSS + ",\n" + _docs("ba_docs", "ba", "item_id", "other_item_id", "n_users")
B_DOCS = _docs("b_docs", "b", "user_id", "item_id", "1.0")
A_DOCS = _docs("a_docs", "a", "user_id", "item_id", "1.0")


def _matches(name: str, history: str, links: str) -> str:
    return f"""{name} AS (SELECT h.user_id, l.item_id, count(*) AS n_match
  FROM {history} h JOIN {links} l ON l.other_item_id = h.item_id GROUP BY 1, 2)"""


LINE = "user_id || chr(9) || action || chr(9) || item_id"
MATCH_COLUMNS = "user_id, item_id, n_match"
SCORE_COLUMNS = "user_id, item_id, score"


def _sim_query(measure: str) -> str:
    return _with(
        ORDERS, ORDER_B, _sims(measure),
        "SELECT item_id, other_item_id, n_both, score FROM sims",
    )


# Preferences with values. Quantities are whole numbers, so that these sums are exact.
VALUES = """ev AS (SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N'),
b AS (SELECT user_id, item_id, max(quantity) AS value FROM ev GROUP BY 1, 2),
st AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS n, sum(value) AS s, sum(value * value) AS q
  FROM b GROUP BY 1),
prs AS (SELECT x.item_id AS low, y.item_id AS high, count(*) AS n_both,
    sum(x.value * y.value) AS dot, sum(x.value) AS s_i, sum(y.value) AS s_j
  FROM b x JOIN b y ON x.user_id = y.user_id AND x.item_id < y.item_id GROUP BY 1, 2)"""

VALUE_MEASURES = {
    "cosine": "dot / sqrt(i.q * j.q)",
    "euclidean": "1.0 / (1.0 + sqrt(greatest(0.0, i.q + j.q - 2.0 * dot)))",
    "pearson": """CASE WHEN (i.q - i.s * (i.s / i.n)) * (j.q - j.s * (j.s / j.n)) > 0 THEN
      (dot - (i.s / i.n) * s_j - (j.s / j.n) * s_i + CAST(n_both AS DOUBLE) * (i.s / i.n) * (j.s / j.n))
      / sqrt((i.q - i.s * (i.s / i.n)) * (j.q - j.s * (j.s / j.n))) END""",
}


def _value_sims(measure: str) -> str:
    return VALUES + f""",
one AS (SELECT low, high, n_both, {VALUE_MEASURES[measure]} AS score FROM prs
  JOIN st i ON i.item_id = low JOIN st j ON j.item_id = high),
sims AS (SELECT low AS item_id, high AS other_item_id, n_both, score FROM one WHERE score <> 0
  UNION ALL SELECT high, low, n_both, score FROM one WHERE score <> 0)"""


def _value_query(measure: str) -> str:
    return _with(_value_sims(measure), "SELECT item_id, other_item_id, n_both, score FROM sims")


def _value_recs(score: str, least: int) -> str:
    return _with(
        _value_sims("cosine"), _top("links", "sims", "score"),
        f"tops AS (SELECT {_power('score', 'links')} AS top, {_power('value', 'b')} AS more)",
        f"""pr AS (SELECT b.user_id, l.item_id, count(*) AS n_terms,
          {_exact_sum('value * score', '(SELECT top + more FROM tops)')} AS total,
          {_exact_sum('abs(score)', '(SELECT top FROM tops)')} AS size
        FROM b JOIN links l ON l.other_item_id = b.item_id
        WHERE NOT EXISTS (SELECT 1 FROM b k WHERE k.user_id = b.user_id AND k.item_id = l.item_id)
        GROUP BY 1, 2),
        sc AS (SELECT user_id, item_id, {score} AS score FROM pr WHERE n_terms >= {least})""",
        _best("sc", "score", SCORE_COLUMNS),
    )


SQL: dict[str, str] = {
    "scan_logs": _with(EVENTS, f"SELECT {LINE} AS line FROM ev"),
    "scan_file_pattern": _with(
        EVENTS,
        f"""SELECT CASE WHEN action = 'purchase' THEN 'contains' ELSE 'whole' END AS kind,
        {LINE} AS line FROM ev""",
    ),
    "scan_hidden_files": _with(
        EVENTS,
        f"""SELECT 'all' AS kind, {LINE} AS line FROM ev
        UNION ALL SELECT 'underscore', {LINE} FROM ev WHERE action = 'purchase'""",
    ),
    "scan_single_file": _with(EVENTS, f"SELECT {LINE} AS line FROM ev"),
    "parse_logs": _with(EVENTS, "SELECT user_id, action, item_id FROM ev"),
    "split_actions": _with(
        EVENTS,
        """SELECT CASE action WHEN 'purchase' THEN 'primary' WHEN 'view' THEN 'secondary'
        ELSE 'other' END AS role, user_id, item_id, CAST(1 AS DOUBLE) AS weight FROM ev""",
    ),
    "action_dir_name": _with(
        EVENTS,
        "t AS (SELECT DISTINCT action FROM ev)",
        "s AS (SELECT action FROM t UNION ALL SELECT upper(action) || '_X Y' FROM t)",
        "SELECT action, replace(replace(lower(action), '_', '-'), ' ', '.') AS dir_name FROM s",
    ),
    "primary_prefs": _with(
        EVENTS,
        "SELECT user_id, item_id, CAST(1 AS DOUBLE) AS weight FROM ev WHERE action = 'purchase'",
    ),
    "secondary_prefs": _with(
        EVENTS,
        "SELECT user_id, item_id, CAST(1 AS DOUBLE) AS weight FROM ev WHERE action = 'view'",
    ),
    "other_actions": _with(
        EVENTS,
        "SELECT user_id, action, item_id FROM ev WHERE action NOT IN ('purchase', 'view')",
    ),
    "min_prefs_filter": _with(
        ORDERS, ORDER_B,
        """SELECT user_id, item_id FROM b WHERE user_id IN
        (SELECT user_id FROM b GROUP BY 1 HAVING count(*) >= 10)""",
    ),
    "downsample_prefs": _with(
        ORDERS, ORDER_B,
        """SELECT user_id, item_id FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY item_id) AS rn FROM b) WHERE rn <= 5""",
    ),
    "recent_history": _with(
        EVENTS,
        """l AS (SELECT user_id, item_id, max(ts) AS ts FROM ev WHERE action = 'purchase'
        GROUP BY 1, 2)""",
        f"""SELECT user_id, item_id, rank FROM (SELECT *, CAST(row_number() OVER
        (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS INTEGER) AS rank FROM l)
        WHERE rank <= {TOP}""",
    ),
    "user_dictionary": _with(EVENTS, DICTIONARIES, "SELECT ext_id, int_id FROM ud"),
    "item_dictionary": _with(EVENTS, DICTIONARIES, "SELECT ext_id, int_id FROM idd"),
    "matrix_dims": _with(
        EVENTS,
        """SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
        FROM ev""",
    ),
    "encode_prefs": _with(
        EVENTS, DICTIONARIES,
        """SELECT u.int_id AS user_int, i.int_id AS item_int, CAST(1 AS DOUBLE) AS weight
        FROM ev JOIN ud u ON u.ext_id = user_id JOIN idd i ON i.ext_id = item_id
        WHERE action = 'purchase'""",
    ),
    "decode_matrix": _with(
        EVENTS,
        "SELECT user_id, item_id, CAST(1 AS DOUBLE) AS weight FROM ev WHERE action = 'purchase'",
    ),
    "user_vectors": _with(
        EVENTS, EVENT_B,
        """SELECT user_id, CAST(0 AS INTEGER) AS part,
        string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY item_id) AS items,
        count(*) AS n_items FROM b GROUP BY 1""",
    ),
    "item_vectors": _with(
        EVENTS, EVENT_B,
        """SELECT item_id, CAST(0 AS INTEGER) AS part,
        string_agg(CAST(user_id AS VARCHAR), ' ' ORDER BY user_id) AS users,
        count(*) AS n_users FROM b GROUP BY 1""",
    ),
    "user_vectors_parts": _with(
        EVENTS, EVENT_B,
        f"""r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rn,
        count(*) OVER (PARTITION BY user_id) AS n FROM b)""",
        f"""SELECT user_id, CAST((rn - 1) // {QUERY_PART} AS INTEGER) AS part,
        string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY item_id) AS items, n AS n_items
        FROM r GROUP BY user_id, (rn - 1) // {QUERY_PART}, n""",
    ),
    "transpose": _with(
        EVENTS, EVENT_B,
        "SELECT item_id AS row_id, user_id AS col_id, CAST(1 AS DOUBLE) AS value FROM b",
    ),
    "active_user_counts": _with(
        EVENTS, EVENT_B, EVENT_A,
        "x AS (SELECT count(DISTINCT user_id) AS p FROM b)",
        "y AS (SELECT count(DISTINCT user_id) AS s FROM a)",
        """SELECT p AS n_users_primary, s AS n_users_secondary, p = s AS n_users_equal
        FROM x CROSS JOIN y""",
    ),
    "cooccurrence": _with(
        ORDERS, ORDER_B, _sims("llr"), "SELECT item_id, other_item_id, n_both FROM prs"
    ),
    "sim_llr": _sim_query("llr"),
    "sim_cosine": _sim_query("cosine"),
    "sim_tanimoto": _sim_query("tanimoto"),
    "sim_euclidean": _sim_query("euclidean"),
    "sim_city_block": _sim_query("city_block"),
    "sim_own_measure": _sim_query("own_measure"),
    "sim_threshold": _with(
        ORDERS, ORDER_B, _sims("tanimoto"),
        "SELECT item_id, other_item_id, score FROM sims WHERE score >= 0.1",
    ),
    "top_k_similar": _with(
        ORDERS, ORDER_B, TOP_LINKS, "SELECT item_id, other_item_id, score, rank FROM links"
    ),
    "sim_threshold_cosine": _with(
        ORDERS, ORDER_B, _sims("cosine"),
        "SELECT item_id, other_item_id, n_both, score FROM sims WHERE score >= 0.4",
    ),
    "sim_threshold_llr": _with(
        ORDERS, ORDER_B, _sims("llr"),
        "SELECT item_id, other_item_id, n_both, score FROM sims WHERE score >= 0.9",
    ),
    "top_k_bounded": _with(
        ORDERS, ORDER_B, TOP_LINKS,
        "SELECT item_id, other_item_id, n_both, score, rank FROM links",
    ),
    "top_k_bounded_tanimoto": _with(
        ORDERS, ORDER_B, _sims("tanimoto"), _top("links", "sims", "score"),
        "SELECT item_id, other_item_id, n_both, score, rank FROM links",
    ),
    "cross_row_similarity": _with(
        ORDERS, ORDER_B, ORDER_A, CROSS,
        "sq AS (SELECT item_id, sum(n_users * n_users) AS norm FROM ba GROUP BY 1)",
        """dots AS (SELECT x.item_id, y.item_id AS other_item_id, count(*) AS n_common,
          sum(x.n_users * y.n_users) AS dot FROM ba x JOIN ba y
          ON x.other_item_id = y.other_item_id AND x.item_id <> y.item_id GROUP BY 1, 2)""",
        """sc AS (SELECT d.item_id, d.other_item_id, n_common,
          CAST(dot AS DOUBLE) / sqrt(CAST(i.norm AS DOUBLE) * CAST(j.norm AS DOUBLE)) AS score
          FROM dots d JOIN sq i ON i.item_id = d.item_id JOIN sq j ON j.item_id = d.other_item_id)""",
        "SELECT * FROM sc WHERE score >= 0.4",
    ),
    "cross_cooccurrence": _with(
        ORDERS, ORDER_B, ORDER_A, CROSS, "SELECT item_id, other_item_id, n_users FROM ba"
    ),
    "top_k_cross": _with(
        ORDERS, ORDER_B, ORDER_A, CROSS_LINKS,
        "SELECT item_id, other_item_id, n_users, rank FROM links_ba",
    ),
    "cross_recs": _with(
        EVENTS, EVENT_B, EVENT_A, CROSS, CROSS_RECS, "SELECT user_id, item_id, score FROM xr"
    ),
    "top_n_cross_recs": _with(
        EVENTS, EVENT_B, EVENT_A, CROSS, CROSS_RECS, _best("xr", "score", SCORE_COLUMNS)
    ),
    "primary_recs": _with(
        EVENTS, EVENT_B, LINKS, PRIMARY_RECS, _best("pr", "score", SCORE_COLUMNS)
    ),
    "valued_prefs": _with(
        """ev AS (SELECT event_id, user_id, value,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id
        FROM events WHERE event_type = 'purchase')""",
        """SELECT user_id AS user_int, CAST(item_id AS BIGINT) AS item_int,
        arg_max(value, event_id) AS weight FROM ev GROUP BY 1, 2""",
    ),
    "sim_values_cosine": _value_query("cosine"),
    "sim_values_euclidean": _value_query("euclidean"),
    "sim_values_pearson": _value_query("pearson"),
    "primary_recs_values": _value_recs("total", 1),
    "primary_recs_values_average": _value_recs("total / size", 2),
    "primary_recs_counts": _with(
        EVENTS, EVENT_B, _sims("count"), _top("links", "sims", "score"), PRIMARY_RECS,
        _best("pr", "score", SCORE_COLUMNS),
    ),
    "primary_recs_weighted_average": _with(
        EVENTS, EVENT_B, LINKS, PRIMARY_RECS,
        """wa AS (SELECT user_id, item_id, CAST(1 AS DOUBLE) AS score FROM pr
        WHERE n_terms > 1)""",
        _best("wa", "score", SCORE_COLUMNS),
    ),
    "blended_recs": _with(
        EVENTS, EVENT_B, EVENT_A, LINKS, PRIMARY_RECS, CROSS, CROSS_RECS,
        """SELECT user_id, item_id, sum(score) AS score
        FROM (SELECT user_id, item_id, score FROM pr
          UNION ALL SELECT user_id, item_id, score FROM xr) GROUP BY 1, 2""",
    ),
    "ordered_links": _with(
        EVENTS, EVENT_B, EVENT_A, DICTIONARIES, CROSS_DOCS,
        "SELECT id, CAST(0 AS INTEGER) AS part, links FROM ba_docs",
    ),
    "item_links_docs": _with(
        EVENTS, EVENT_B, EVENT_A, DICTIONARIES, OWN_DOCS, CROSS_DOCS,
        """SELECT x.id, CAST(0 AS INTEGER) AS part, x.links AS b_b_links, y.links AS b_a_links
        FROM bb_docs x JOIN ba_docs y ON x.id = y.id""",
    ),
    "item_links_docs_single": _with(
        EVENTS, EVENT_B, DICTIONARIES, OWN_DOCS,
        "SELECT id, CAST(0 AS INTEGER) AS part, links AS b_b_links FROM bb_docs",
    ),
    "user_history_docs": _with(
        EVENTS, EVENT_B, EVENT_A, DICTIONARIES, B_DOCS, A_DOCS,
        """SELECT x.id, CAST(0 AS INTEGER) AS part, x.links AS b_history, y.links AS a_history
        FROM b_docs x JOIN a_docs y ON x.id = y.id""",
    ),
    "user_history_docs_full": _with(
        EVENTS, EVENT_B, EVENT_A, DICTIONARIES, B_DOCS, A_DOCS,
        """SELECT coalesce(x.id, y.id) AS id, CAST(0 AS INTEGER) AS part,
        coalesce(x.links, '') AS b_history, coalesce(y.links, '') AS a_history
        FROM b_docs x FULL JOIN a_docs y ON x.id = y.id""",
    ),
    "user_history_docs_parts": _with(
        EVENTS, EVENT_B, DICTIONARIES,
        """r AS (SELECT user_id, item_id, int_id, row_number() OVER (PARTITION BY user_id
        ORDER BY int_id DESC) AS rn FROM b JOIN idd ON ext_id = item_id)""",
        f"""SELECT user_id AS id, CAST((rn - 1) // {QUERY_PART} AS INTEGER) AS part,
        string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY int_id DESC) AS b_history
        FROM r GROUP BY user_id, (rn - 1) // {QUERY_PART}""",
    ),
    "user_history_docs_single": _with(
        EVENTS, EVENT_B, DICTIONARIES, B_DOCS,
        "SELECT id, CAST(0 AS INTEGER) AS part, links AS b_history FROM b_docs",
    ),
    "similar_items": _with(
        ORDERS, ORDER_B, LINKS,
        """SELECT item_id, other_item_id, rank FROM links
        WHERE item_id IN (SELECT p_partkey FROM part)""",
    ),
    "query_history_primary": _with(
        EVENTS, EVENT_B, LINKS, _matches("m", "b", "links"),
        _best("m", "n_match", MATCH_COLUMNS),
    ),
    "query_history_cross": _with(
        EVENTS, EVENT_B, EVENT_A, CROSS, _matches("m", "a", "ba"),
        _best("m", "n_match", MATCH_COLUMNS),
    ),
    "query_history_both": _with(
        EVENTS, EVENT_B, EVENT_A, LINKS, CROSS,
        _matches("mb", "b", "links"), _matches("ma", "a", "ba"),
        """m AS (SELECT user_id, item_id, CAST(sum(n_match) AS BIGINT) AS n_match
        FROM (SELECT * FROM mb UNION ALL SELECT * FROM ma) GROUP BY 1, 2)""",
        _best("m", "n_match", MATCH_COLUMNS),
    ),
    "query_history_idf": _with(
        EVENTS, EVENT_B, LINKS,
        "nd AS (SELECT CAST(count(DISTINCT item_id) AS DOUBLE) AS n FROM links)",
        f"""wd AS (SELECT other_item_id, {_units('ln(1.0 + n / count(*))')} AS idf
        FROM links CROSS JOIN nd GROUP BY other_item_id, n)""",
        """m AS (SELECT b.user_id, l.item_id, CAST(sum(idf) AS DOUBLE) / 4294967296.0 AS n_match
        FROM b JOIN links l ON l.other_item_id = b.item_id
        JOIN wd ON wd.other_item_id = l.other_item_id GROUP BY 1, 2)""",
        _best("m", "n_match", MATCH_COLUMNS),
    ),
    "query_adhoc_history": _with(
        EVENTS, EVENT_B, _history("c", "click"), LINKS, _matches("m", "c", "links"),
        _best("m", "n_match", MATCH_COLUMNS),
    ),
    "query_category_boost": _with(
        ORDERS, ORDER_B, LINKS, _matches("m", "b", "links"),
        """pref AS (SELECT user_id, p_brand FROM (SELECT user_id, item_id, row_number() OVER
        (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS rn FROM ev WHERE action = 'N')
        JOIN part ON p_partkey = item_id WHERE rn = 1)""",
        """s AS (SELECT m.user_id, m.item_id, CAST(n_match AS DOUBLE) *
        CASE WHEN pref.p_brand = part.p_brand THEN 2.0 ELSE 1.0 END AS score
        FROM m LEFT JOIN part ON p_partkey = m.item_id
        LEFT JOIN pref ON pref.user_id = m.user_id)""",
        _best("s", "score", SCORE_COLUMNS),
    ),
    "query_cold_start": _with(
        ORDERS, ORDER_B, LINKS,
        f"""s AS (SELECT l.item_id AS seed_item_id, l.other_item_id AS item_id,
        score * CAST(CASE WHEN x.p_brand = y.p_brand THEN 2.0 ELSE 1.0 END AS DOUBLE) AS score
        FROM links l JOIN part x ON x.p_partkey = l.item_id
        LEFT JOIN part y ON y.p_partkey = l.other_item_id)""",
        _best("s", "score", "seed_item_id, item_id, score", key="seed_item_id"),
    ),
}

# What is written as text must read back the same.
SQL |= {
    "dictionary_text": SQL["user_dictionary"],
    "prefs_text": f"SELECT *, 'purchase' AS action_dir FROM ({SQL['encode_prefs']})",
    "documents_csv": SQL["user_history_docs_full"],
}

# Tables of a model update, in numbers that the dictionaries give.
_NUMBERED = (
    EVENTS.replace("ev AS", "log AS", 1),
    DICTIONARIES.replace("FROM ev", "FROM log"),
    """ev AS (SELECT u.int_id AS user_id, action, i.int_id AS item_id FROM log
    JOIN ud u ON u.ext_id = log.user_id JOIN idd i ON i.ext_id = log.item_id)""",
)

SQL |= {
    "update_user_index": SQL["user_dictionary"],
    "update_item_index": SQL["item_dictionary"],
    "update_dims": SQL["matrix_dims"],
    "update_prefs": _with(
        *_NUMBERED,
        "p AS (SELECT * FROM ev WHERE action IN ('purchase', 'view'))",
        """SELECT user_id AS user_int, item_id AS item_int, CAST(1 AS DOUBLE) AS weight,
        action AS action_dir FROM p""",
    ),
    "update_other_actions": _with(
        EVENTS, f"SELECT {LINE} AS line FROM ev WHERE action NOT IN ('purchase', 'view')"
    ),
    "update_similar": _with(
        *_NUMBERED, EVENT_B, LINKS, "SELECT item_id, other_item_id, n_both, score, rank FROM links",
    ),
    "update_active_users": _with(
        EVENTS, EVENT_B, EVENT_A,
        "x AS (SELECT count(DISTINCT user_id) AS p FROM b)",
        "y AS (SELECT count(DISTINCT user_id) AS s FROM a)",
        """SELECT p AS n_users_primary, s AS n_users_secondary, p = s AS n_users_equal
        FROM x CROSS JOIN y""",
    ),
    "update_counters": _with(
        EVENTS,
        """SELECT count(*) + count(*) FILTER (event_id % 10 = 0) AS n_lines,
        count(*) FILTER (event_id % 10 = 0) AS n_bad_lines,
        count(*) FILTER (action = 'purchase') AS n_primary,
        count(*) FILTER (action = 'view') AS n_secondary,
        count(*) FILTER (action NOT IN ('purchase', 'view')) AS n_other,
        count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM ev""",
    ),
    "update_recs": _with(
        *_NUMBERED, EVENT_B, LINKS, PRIMARY_RECS, _best("pr", "score", SCORE_COLUMNS),
    ),
    "update_cross_similar": _with(
        *_NUMBERED, EVENT_B, EVENT_A, CROSS, "SELECT item_id, other_item_id, n_users FROM ba",
    ),
    "update_cross_recs": _with(
        *_NUMBERED, EVENT_B, EVENT_A, CROSS, CROSS_RECS, "SELECT user_id, item_id, score FROM xr",
    ),
    "update_item_links_docs": SQL["item_links_docs"],
    "update_user_history_docs": SQL["user_history_docs"],
}

SQL["update_second_run"] = SQL["update_recs"]

# The same rows from posting lists. Links are those by number of the items' dictionary.
SQL["index_postings"] = _with(
    EVENTS, EVENT_B, DICTIONARIES, _sims("llr"),
    f"""l AS (SELECT * FROM (SELECT s.item_id, s.other_item_id, row_number() OVER (
        PARTITION BY s.item_id ORDER BY score DESC, d.int_id DESC) AS rn
      FROM sims s JOIN idd d ON d.ext_id = s.other_item_id) WHERE rn <= {DOCUMENT_LINKS})""",
    """SELECT other_item_id AS word, item_id, count(*) OVER (PARTITION BY other_item_id) AS n_docs
    FROM l""",
)
SQL["query_index_primary"] = SQL["query_history_primary"]
SQL["query_index_cross"] = SQL["query_history_cross"]
SQL["query_index_idf"] = SQL["query_history_idf"]
