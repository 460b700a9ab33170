"""The same results in plain SQL, for checking the queries on another engine.

Everything but fitted classifiers has one. Keys are hashed as in ``functions.keys``: md5 over
``seed|key...`` with seed 7, held out below the share's bound.
"""

from __future__ import annotations

LINE_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LINE_HASH = f"md5(concat_ws('|', 7, {LINE_KEY}))"
FIFTH = "'33333333000000000000000000000000'"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

_MASKED = f"""
    masked AS (
        SELECT {LINE_KEY}, l_quantity, l_extendedprice,
               CASE WHEN l_linenumber <> 7 THEN l_discount END AS l_discount,
               CASE WHEN l_linenumber <> 6 THEN l_tax END AS l_tax,
               1.5::DOUBLE AS flat,
               CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS returned
        FROM lineitem)
"""

_FIXED = f"""
    scored AS (
        SELECT {LINE_KEY}, l_quantity / 50.0::DOUBLE + l_discount AS score,
               (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::DOUBLE AS label,
               (CASE WHEN l_quantity / 50.0::DOUBLE + l_discount > 0.9::DOUBLE
                     THEN 1 ELSE 0 END)::DOUBLE AS prediction
        FROM lineitem)
"""

_CURVE = f"""
    {_FIXED},
    points AS (
        SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
    running AS (
        SELECT score, pos, neg,
               sum(pos) OVER (ORDER BY score DESC) AS tp,
               sum(neg) OVER (ORDER BY score DESC) AS fp,
               sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM points),
    steps AS (
        SELECT *, tp / (tp + fp) AS precision_here,
               coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), tp / (tp + fp))
                   AS precision_before
        FROM running),
    areas AS (
        SELECT sum(neg * (tp - pos / 2)) / (max(p) * max(n)) AS roc,
               sum(pos * (precision_here + precision_before) / 2) / max(p) AS pr
        FROM steps)
"""


def _pearson(x: str, y: str) -> str:
    both = f"({x} IS NOT NULL AND {y} IS NOT NULL)"
    return (
        f"round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) FILTER {both.replace('(', '(WHERE ', 1)}"
        f" * stddev_pop({y}) FILTER {both.replace('(', '(WHERE ', 1)}, 0), 6)"
    )


def _correlations(columns: list[str], target: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_pearson(c, target)} AS r FROM masked" for c in columns
    )


def _matrix(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {_pearson(x, y)} AS r FROM masked"
        for x in columns
        for y in columns
    )


def _stats(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_pop({c}), 6) AS std_pop, round(stddev_samp({c}), 6) AS std_samp FROM masked"
        for c in columns
    )


def _audit(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM masked"
        for c in columns
    )


def _ranks(column: str) -> str:
    """Values with their place by descending frequency, ties in alphabetical order."""
    return f"""(SELECT {column} AS value,
        (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS place
        FROM orders GROUP BY {column})"""


def _scaled(spread: str | None) -> str:
    fitted = ", ".join(
        f"avg({c}) AS m_{c}, {spread or 'count'}({c}) AS s_{c}" for c in MEASURES
    )
    values = ", ".join(
        f"round((l.{c} - m_{c}){f' / s_{c}' if spread else ''}, 6) AS {c}" for c in MEASURES
    )
    return f"""
        WITH fitted AS (SELECT {fitted} FROM lineitem WHERE {LINE_HASH} >= {FIFTH})
        SELECT {LINE_KEY}, {values} FROM lineitem l, fitted"""


def _hot(column: str, values: list[str], prefix: str) -> str:
    return ", ".join(
        f"(CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END)::DOUBLE AS {prefix}{i}"
        for i, v in enumerate(values)
    )


def _hot_by_place(place: str, width: int, prefix: str) -> str:
    return ", ".join(
        f"(CASE WHEN {place} = {i} THEN 1 ELSE 0 END)::DOUBLE AS {prefix}{i}"
        for i in range(width)
    )


def _exact(table: str, key: str, share: str) -> str:
    """Rows of ``table`` in hash order, with the number of rows to hold out."""
    return f"""(SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', 7, {key})), {key}) AS place,
        ceil(count(*) OVER () * {share}::DOUBLE) AS wanted FROM {table})"""


_PARTS_OF_DAY = {"day": "1-URGENT", "eve": "2-HIGH", "night": "3-MEDIUM", "int": "4-NOT SPECIFIED"}

_CHURN = (
    """
    history AS (
        SELECT o_custkey,
               date_diff('day', min(o_orderdate), max(o_orderdate))::DOUBLE AS account_length,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS vmail_message, """
    + ", ".join(
        f"""sum(round(o_totalprice * 100)::BIGINT) FILTER (WHERE o_orderpriority = '{v}')::DOUBLE
                / 100 AS {p}_mins,
            count(*) FILTER (WHERE o_orderpriority = '{v}') AS {p}_calls,
            max(o_totalprice) FILTER (WHERE o_orderpriority = '{v}') AS {p}_charge"""
        for p, v in _PARTS_OF_DAY.items()
    )
    + """,
               count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS custserve_calls
        FROM orders GROUP BY o_custkey),
    numbers AS (
        SELECT c_mktsegment AS state, c_nationkey::DOUBLE AS area_code, c_name AS phone, c_acctbal,
               coalesce(account_length, 0)::DOUBLE AS account_length,
               coalesce(vmail_message, 0)::DOUBLE AS vmail_message, """
    + ", ".join(
        f"coalesce({p}_{m}, 0)::DOUBLE AS {p}_{m}"
        for p in _PARTS_OF_DAY
        for m in ("mins", "calls", "charge")
    )
    + """,
               coalesce(custserve_calls, 0)::DOUBLE AS custserve_calls
        FROM customer LEFT JOIN history ON c_custkey = o_custkey),
    churn AS (
        SELECT *, c_acctbal < 3000 AS int_plan, vmail_message >= 4 AS vmail_plan,
               CASE WHEN custserve_calls >= 4 OR day_mins > 900000
                    THEN 'True.' ELSE 'False.' END AS label
        FROM numbers)
    """
)

_CHURN_FEATURES = [
    "account_length", "int_plan", "vmail_plan", "vmail_message",
    *[f"{p}_{m}" for p in _PARTS_OF_DAY for m in ("mins", "calls", "charge")],
    "custserve_calls",
]
_CHURN_COLUMNS = ", ".join(["state", "area_code", "phone", *_CHURN_FEATURES, "label"])

_RENEWAL = """
    sums AS (
        SELECT l_partkey, count(*)::DOUBLE AS nth_membership_period,
               date_diff('day', min(l_shipdate), max(l_shipdate))::DOUBLE AS "Window",
               max(l_quantity) AS usage_days, max(l_discount) AS "Supercategory_Ratio",
               min(l_tax) AS "Intensity_Ratio", sum(l_quantity) AS "Product_Article",
               count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE AS "Overview_Detail",
               count(*) FILTER (WHERE l_returnflag = 'A')::DOUBLE AS "Email_Open_R",
               count(*) FILTER (WHERE l_linestatus = 'O')::DOUBLE AS "Email_Clicked_R"
        FROM lineitem GROUP BY l_partkey),
    renewal AS (
        SELECT nth_membership_period, "Window",
               CASE WHEN "Window" > 2000 THEN usage_days END AS "Usage_Days",
               "Supercategory_Ratio", "Intensity_Ratio", "Product_Article", "Overview_Detail",
               "Email_Open_R", "Email_Clicked_R",
               CASE WHEN p_type <> 'SMALL' THEN p_size::DOUBLE END AS "Browser_Researcher",
               CASE WHEN "Product_Article" > 850 OR "Overview_Detail" >= 14
                    THEN 'Renewers' ELSE p_type END AS "Target_Group",
               (CASE WHEN "Product_Article" > 850 OR "Overview_Detail" >= 14 THEN 3
                     WHEN p_type = 'SMALL' THEN 1 ELSE 2 END)::DOUBLE AS "Target_Group_Code"
        FROM part LEFT JOIN sums ON p_partkey = l_partkey)
"""

_RENEWAL_NUMBERS = [
    "nth_membership_period", "Window", "Usage_Days", "Supercategory_Ratio", "Intensity_Ratio",
    "Product_Article", "Overview_Detail", "Email_Open_R", "Email_Clicked_R", "Browser_Researcher",
]

_CELL = """CASE WHEN l_linenumber = 1 THEN 'abc'
                WHEN l_linenumber = 2 THEN l_discount::VARCHAR || 'd'
                WHEN l_linenumber = 3 THEN ''
                WHEN l_linenumber = 4 THEN 'nan'
                WHEN l_linenumber = 5 THEN ' ' || l_tax::VARCHAR || ' '
                WHEN l_linenumber = 7 THEN l_quantity::VARCHAR END"""

_ANSWER = """CASE WHEN l_returnflag = 'A' THEN 'yes' WHEN l_returnflag = 'N' THEN 'no'
                  WHEN l_linestatus = 'O' THEN 'Yes' END"""

ORACLE: dict[str, str] = {
    "text_split_pick": """
        WITH lines AS (
            SELECT string_split(
                concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment), ',') AS c
            FROM customer)
        SELECT c[5] AS segment, try_cast(c[1] AS DOUBLE) AS custkey, c[2] AS name,
               try_cast(c[4] AS DOUBLE) AS acctbal, try_cast(c[10] AS DOUBLE) AS absent
        FROM lines""",
    "csv_header_scan": """
        SELECT p_retailprice AS price, '"' || p_name || '", ' || p_brand AS name,
               p_partkey::DOUBLE AS partkey
        FROM part""",
    "csv_sink_roundtrip": f"""
        SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_type, p_retailprice
        FROM {_exact("part", "p_partkey", "0.25")} WHERE place <= wanted""",
    "preview_top20": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
        FROM orders ORDER BY o_orderkey LIMIT 20""",
    "churn_lines_typed": f"WITH {_CHURN} SELECT {_CHURN_COLUMNS} FROM churn",
    "churn_csv_typed": f"""
        WITH {_CHURN}
        SELECT {", ".join(_CHURN_FEATURES)},
               (CASE WHEN label = 'True.' THEN 1 ELSE 0 END)::DOUBLE AS label
        FROM churn""",
    "renewal_lines_typed": f"""
        WITH {_RENEWAL}
        SELECT {", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in _RENEWAL_NUMBERS)},
               CASE WHEN "Target_Group" = 'Renewers' THEN 'Renewers' ELSE 'Others' END AS label
        FROM renewal""",
    "renewal_csv_typed": f"""
        WITH {_RENEWAL}
        SELECT {", ".join(f'"{c}"' for c in _RENEWAL_NUMBERS)}, "Target_Group" FROM renewal""",
    "project_drop_rename": "SELECT s_suppkey, s_acctbal * 2 AS balance FROM supplier",
    "yes_no_flags": f"""
        WITH a AS (SELECT {LINE_KEY}, {_ANSWER} AS answer FROM lineitem)
        SELECT {LINE_KEY}, coalesce(answer = 'yes', false) AS is_yes,
               CASE answer WHEN 'yes' THEN true WHEN 'no' THEN false END AS flag
        FROM a""",
    "safe_cast_zero": f"""
        WITH c AS (SELECT {LINE_KEY}, try_cast(trim({_CELL}) AS DOUBLE) AS x FROM lineitem),
             d AS (SELECT {LINE_KEY}, CASE WHEN NOT isnan(x) THEN x END AS number FROM c)
        SELECT {LINE_KEY}, number, coalesce(number, 0) AS filled, coalesce(number, 0) AS zeroed
        FROM d""",
    "label_one_vs_rest": """
        SELECT c_custkey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE 'Others' END AS grouped,
               (CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::DOUBLE AS by_text,
               (CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END)::DOUBLE AS by_code,
               (CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::DOUBLE AS by_literal
        FROM customer""",
    "row_subset": f"""
        SELECT {LINE_KEY}, l_extendedprice FROM lineitem WHERE {LINE_HASH} < {FIFTH}""",
    "null_audit": f"WITH {_MASKED} "
    + _audit([*LINE_KEY.split(", "), *MEASURES, "flat", "returned"]),
    "impute_mean": f"""
        WITH {_MASKED},
        means AS (SELECT avg(l_discount) AS d, avg(l_tax) AS t FROM masked
                  WHERE {LINE_HASH} >= {FIFTH})
        SELECT {LINE_KEY}, round(coalesce(l_discount, d), 6) AS discount,
               round(coalesce(l_tax, t), 6) AS tax
        FROM masked, means""",
    "column_stats": f"WITH {_MASKED} {_stats(MEASURES)}",
    "corr_topk": f"""
        WITH {_MASKED}, r AS ({_correlations([*MEASURES, "flat", "returned"], "returned")})
        SELECT feature, r FROM r ORDER BY r DESC NULLS LAST, feature LIMIT 10""",
    "corr_matrix": f"WITH {_MASKED} {_matrix([*MEASURES, 'flat'])}",
    "renewal_top_correlations": f"""
        WITH {_RENEWAL}, masked AS (SELECT * FROM renewal),
        r AS ({" UNION ALL ".join(
            f"SELECT '{c}' AS feature, {_pearson(chr(34) + c + chr(34), '"Target_Group_Code"')} AS r FROM masked"
            for c in [*_RENEWAL_NUMBERS, "Target_Group_Code"])})
        SELECT feature, r FROM r ORDER BY r DESC NULLS LAST, feature LIMIT 10""",
    "category_counts": """
        SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n
        FROM orders GROUP BY o_orderstatus
        UNION ALL
        SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority""",
    "class_weights": """
        WITH counts AS (SELECT c_mktsegment AS label, count(*) AS n FROM customer
                        GROUP BY c_mktsegment)
        SELECT label, n,
               round((sum(n) OVER ())::DOUBLE / ((count(*) OVER ())::DOUBLE * n), 6) AS weight
        FROM counts""",
    "class_weight_column": f"""
        WITH train AS (SELECT c_mktsegment AS label, count(*) AS n FROM customer
                       WHERE md5(concat_ws('|', 7, c_custkey)) >= {FIFTH} GROUP BY c_mktsegment),
        weights AS (SELECT label, (sum(n) OVER ())::DOUBLE / ((count(*) OVER ())::DOUBLE * n) AS w
                    FROM train)
        SELECT c_custkey, round(w, 6) AS weight
        FROM customer LEFT JOIN weights ON c_mktsegment = label""",
    "label_index_freq": f"""
        SELECT o_orderkey, o_orderstatus, place AS status_index
        FROM orders JOIN {_ranks("o_orderstatus")} r ON o_orderstatus = value""",
    "label_index_multi": f"""
        SELECT o_orderkey, s.place AS o_orderstatus, p.place AS o_orderpriority
        FROM orders JOIN {_ranks("o_orderstatus")} s ON o_orderstatus = s.value
        JOIN {_ranks("o_orderpriority")} p ON o_orderpriority = p.value""",
    "label_decode": f"""
        SELECT o_orderkey, place AS priority_index, o_orderpriority AS decoded
        FROM orders JOIN {_ranks("o_orderpriority")} r ON o_orderpriority = value""",
    "onehot_features": f"""
        SELECT o_orderkey, {_hot_by_place("s.place", 2, "status_")},
               {_hot_by_place("p.place", 4, "priority_")}
        FROM orders JOIN {_ranks("o_orderstatus")} s ON o_orderstatus = s.value
        JOIN {_ranks("o_orderpriority")} p ON o_orderpriority = p.value""",
    "onehot_label": f"""
        SELECT o_orderkey, {_hot("o_orderstatus", ["F", "O", "P"], "class_")} FROM orders""",
    "vector_assemble_dense": f"""
        SELECT {LINE_KEY}, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
               (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::DOUBLE AS f4
        FROM lineitem""",
    "auto_categorical": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(DISTINCT {c}) <= 10 AS is_category,
            CASE WHEN count(DISTINCT {c}) <= 10 THEN count(DISTINCT {c}) END AS n_values
            FROM lineitem"""
        for c in ("l_linenumber", "l_quantity", "l_tax", "l_discount")
    ),
    "auto_categorical_rows": f"""
        SELECT {LINE_KEY},
               (dense_rank() OVER (ORDER BY l_linenumber) - 1)::DOUBLE AS f0, l_quantity AS f1,
               (dense_rank() OVER (ORDER BY l_tax) - 1)::DOUBLE AS f2
        FROM lineitem""",
    "standardize": _scaled("stddev_pop"),
    "standardize_sample": _scaled("stddev_samp"),
    "center_only": _scaled(None),
    "split_hash": f"""
        SELECT {LINE_KEY}, CASE WHEN {LINE_HASH} < {FIFTH} THEN 'test' ELSE 'train' END AS part
        FROM lineitem""",
    "split_exact": f"""
        SELECT {LINE_KEY}, CASE WHEN place <= wanted THEN 'test' ELSE 'train' END AS part
        FROM {_exact("lineitem", LINE_KEY, "0.3")}""",
    "split_quarter_ids": f"""
        SELECT o_orderkey FROM {_exact("orders", "o_orderkey", "0.25")} WHERE place <= wanted""",
    "score_argmax": """
        SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS top_place
        FROM embeddings""",
    "score_softmax": """
        WITH e AS (
            SELECT vec_id, unnest(embedding)::DOUBLE AS x,
                   (generate_subscripts(embedding, 1) - 1)::INTEGER AS place,
                   list_max(embedding)::DOUBLE AS top
            FROM embeddings)
        SELECT vec_id, place,
               round(exp(x - top) / sum(exp(x - top)) OVER (PARTITION BY vec_id), 6) AS probability
        FROM e""",
    "prediction_listing": f"WITH {_FIXED} SELECT {LINE_KEY}, label, prediction FROM scored",
    "classification_report": f"""
        WITH {_FIXED},
        classes AS (SELECT DISTINCT label AS class FROM scored
                    UNION SELECT DISTINCT prediction FROM scored),
        sums AS (
            SELECT class, count(*) FILTER (WHERE label = class) AS support,
                   count(*) FILTER (WHERE prediction = class) AS predicted,
                   count(*) FILTER (WHERE label = class AND prediction = class) AS hits
            FROM classes, scored GROUP BY class),
        per_class AS (
            SELECT class::VARCHAR AS class, coalesce(hits / nullif(predicted, 0), 0) AS p,
                   coalesce(hits / nullif(support, 0), 0) AS r,
                   coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f, support
            FROM sums)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support
        FROM per_class
        UNION ALL
        SELECT 'avg / total', round(sum(p * support) / sum(support), 6),
               round(sum(r * support) / sum(support), 6),
               round(sum(f * support) / sum(support), 6), sum(support)::BIGINT
        FROM per_class""",
    "balanced_accuracy": f"""
        WITH {_FIXED}
        SELECT round((avg(prediction) FILTER (WHERE label = 1)
                      + avg(1 - prediction) FILTER (WHERE label = 0)) / 2, 6) AS balanced_accuracy
        FROM scored""",
    "accuracy": f"""
        WITH {_FIXED}
        SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy FROM scored""",
    "accuracy_pct": f"""
        WITH {_FIXED}
        SELECT round(100 * avg(((score > 0.9::DOUBLE)::INTEGER = label)::INTEGER), 6)
            AS accuracy_percent
        FROM scored""",
    "auc_roc": f"WITH {_CURVE} SELECT round(roc, 6) AS area_under_roc FROM areas",
    "auc_pr": f"WITH {_CURVE} SELECT round(pr, 6) AS area_under_pr FROM areas",
    "metric_table": f"""
        WITH {_CURVE}
        SELECT 'accuracy' AS metric, round(avg((label = prediction)::INTEGER), 6) AS value
        FROM scored
        UNION ALL
        SELECT 'balanced_accuracy', round((avg(prediction) FILTER (WHERE label = 1)
            + avg(1 - prediction) FILTER (WHERE label = 0)) / 2, 6) FROM scored
        UNION ALL SELECT 'area_under_roc', round(roc, 6) FROM areas
        UNION ALL SELECT 'area_under_pr', round(pr, 6) FROM areas""",
}

_MARKED = """SELECT l_linenumber, ((l_linenumber % 2 = 0) = (l_quantity < 35))::INT AS label
             FROM lineitem"""
_GROUP_MEANS = f"""
    SELECT l_linenumber, count(*) AS n, round(avg(label), 4) AS probability
    FROM ({_MARKED}) GROUP BY l_linenumber"""
_GROUP_MEANS_WEIGHTED = f"""
    WITH m AS ({_MARKED}), w AS (
        SELECT label, (SELECT count(*) FROM m) / (count(*) * 2.0::DOUBLE) AS weight
        FROM m GROUP BY label)
    SELECT l_linenumber, count(*) AS n, round(sum(label * weight) / sum(weight), 4) AS probability
    FROM m JOIN w USING (label) GROUP BY l_linenumber"""
for _learner in ("logreg", "forest"):
    ORACLE[f"{_learner}_group_means"] = _GROUP_MEANS
    ORACLE[f"{_learner}_group_means_weighted"] = _GROUP_MEANS_WEIGHTED
_GROUPS = f"""
    g AS (SELECT l_linenumber, count(*) AS n, avg(label) AS mean,
                 count(*) / (sum(count(*)) OVER ())::DOUBLE AS share
          FROM ({_MARKED}) GROUP BY l_linenumber)"""
# What minimizes the mean loss plus the penalty: with one weight for each group and nothing else, a
# group's weight depends on its own rows alone.
ORACLE["logreg_l1_group_means"] = f"""
    WITH {_GROUPS}
    SELECT l_linenumber, n, round(CASE WHEN abs(mean - 0.5) <= 0.02::DOUBLE / share THEN 0.5
           ELSE mean - sign(mean - 0.5) * 0.02::DOUBLE / share END, 4)::DOUBLE AS probability
    FROM g"""
_SLOPE = "share * (1 / (1 + exp(-(low + high) / 2)) - mean) + 0.02::DOUBLE * (low + high) / 2"
ORACLE["logreg_l2_group_means"] = f"""
    WITH RECURSIVE {_GROUPS},
    b AS (
        SELECT l_linenumber, n, mean, share, -20.0::DOUBLE AS low, 20.0::DOUBLE AS high, 0 AS step
        FROM g
        UNION ALL
        SELECT l_linenumber, n, mean, share,
               CASE WHEN {_SLOPE} < 0 THEN (low + high) / 2 ELSE low END,
               CASE WHEN {_SLOPE} < 0 THEN high ELSE (low + high) / 2 END, step + 1
        FROM b WHERE step < 60)
    SELECT l_linenumber, n, round(1 / (1 + exp(-(low + high) / 2)), 4) AS probability
    FROM b WHERE step = 60"""
ORACLE["svc_group_margins"] = f"""
    WITH {_GROUPS}
    SELECT l_linenumber, n,
           round(greatest(-1, least(1, (2 * mean - 1) * share / 0.15::DOUBLE)), 4) AS margin
    FROM g"""
ORACLE["mlp_group_means"] = _GROUP_MEANS
# Newton steps, as many as any start needs.
ORACLE["platt_fit"] = f"""
    WITH RECURSIVE m AS (
        SELECT (l_quantity - 25) / 10 AS x,
               ((l_linenumber % 2 = 0) = (l_quantity < 35))::INT AS label FROM lineitem),
    s AS (SELECT sum(label)::DOUBLE AS n1, sum(1 - label)::DOUBLE AS n0 FROM m),
    t AS (SELECT x, CASE label WHEN 1 THEN (n1 + 1) / (n1 + 2) ELSE 1 / (n0 + 2) END AS t,
                 count(*)::DOUBLE AS w FROM m, s GROUP BY ALL),
    r AS (
        SELECT 0.0::DOUBLE AS a, ln((n1 + 1) / (n0 + 1)) AS b, 0 AS step FROM s
        UNION ALL
        SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab),
               b - (haa * gb - hab * ga) / (haa * hbb - hab * hab), step + 1
        FROM (
            SELECT a, b, step, sum(w * (p - t) * x) AS ga, sum(w * (p - t)) AS gb,
                   sum(w * p * (1 - p) * x * x) AS haa, sum(w * p * (1 - p) * x) AS hab,
                   sum(w * p * (1 - p)) AS hbb
            FROM (SELECT a, b, step, x, t, w, 1 / (1 + exp(-(a * x + b))) AS p
                  FROM r, t WHERE step < 30)
            GROUP BY a, b, step))
    SELECT (SELECT count(*) FROM m) AS n, round(a, 6) AS slope, round(b, 6) AS offset
    FROM r WHERE step = 30"""
ORACLE["score_saved_model"] = "SELECT count(*) AS n, count(*) AS n_same FROM customer"
ORACLE["csv_mixed_headers"] = """
    SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_retailprice,
           CASE WHEN p_partkey % 2 = 1 THEN p_type END AS p_type
    FROM part"""
ORACLE["label_index_wide"] = """
    WITH c AS (SELECT o_custkey::VARCHAR AS customer, count(*) AS n FROM orders GROUP BY ALL),
    r AS (SELECT customer, (row_number() OVER (ORDER BY n DESC, customer) - 1)::DOUBLE AS i,
                 (row_number() OVER (ORDER BY customer) - 1)::DOUBLE AS p FROM c)
    SELECT o_orderkey, i AS customer_index, p AS customer_place
    FROM orders JOIN r ON o_custkey::VARCHAR = customer"""
ORACLE["split_exact_repeats"] = """
    SELECT 'test' AS part, ceil(count(*) * 0.3::DOUBLE)::BIGINT AS n FROM lineitem
    UNION ALL SELECT 'train', (count(*) - ceil(count(*) * 0.3::DOUBLE))::BIGINT FROM lineitem"""
