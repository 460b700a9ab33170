"""Queries over the star-schema tables, one per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake import constants as C
from keepsake.functions import cells, labels, scores
from keepsake.operators import columns as cols
from keepsake.operators import evaluate as ev
from keepsake.operators import features as ft
from keepsake.operators import learners as ln
from keepsake.operators import missing as ms
from keepsake.operators import profile as pf
from keepsake.operators import split as sp
from keepsake.operators.calibrate import fit_sigmoid
from keepsake.plans import derived, scoring, studies
from keepsake.plans.derived import table
from keepsake.session import new_shared_path
from keepsake.sources import delimited, schemas, sinks

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIGITS = 6


def _round(value: Column | str) -> Column:
    return F.round(value, DIGITS)


# --- Sources and sinks ---------------------------------------------------------------------


def text_split_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lines of customers, cut without quoting and picked by position."""
    customers = table(spark, sf_dir, "customer")
    path = new_shared_path(spark, "customer-lines")
    customers.select(F.concat_ws(",", *customers.columns).alias("value")).write.text(path)
    schema = T.StructType.fromDDL(
        "segment string, custkey double, name string, acctbal double, absent double"
    )
    positions = {"segment": 4, "custkey": 0, "name": 1, "acctbal": 3, "absent": 9}
    return delimited.read_unquoted(spark, path, schema, positions)


def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part CSV with awkward names and quoted cells, read by name in another column order."""
    path = new_shared_path(spark, "part-csv")
    table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"),
        F.concat(F.lit('"'), "p_name", F.lit('", '), "p_brand").alias("Part's Name"),
        F.col("p_type"),
        F.col("p_retailprice").alias("Price?"),
    ).write.csv(path, header=True, quote='"', escape='"')
    read = delimited.read_with_header(
        spark, path, {"Price?": "double", "Part's Name": "string", "Part Key": "double"}
    )
    return cols.rename(read, {"Price?": "price", "Part's Name": "name", "Part Key": "partkey"})


def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the parts, held out, written as CSV with the key first, and read back."""
    _, test = sp.split_exact(table(spark, sf_dir, "part"), ["p_partkey"])
    path = new_shared_path(spark, "part-held-out")
    sinks.write_csv(test, path, ["p_partkey"])
    types = {"p_partkey": "double", "p_name": "string", "p_type": "string",
             "p_retailprice": "double"}
    return delimited.read_with_header(spark, path, types)


def preview_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return sinks.preview(orders, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


def churn_lines_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headerless churn scan: 21 typed columns."""
    return schemas.read_churn(spark, derived.write_churn_lines(spark, sf_dir))


def churn_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn scan with a header: all its numbers, flags, 0/1 label."""
    read = schemas.read_churn_with_header(spark, derived.write_churn_csv(spark, sf_dir))
    return read.select(
        F.col("Int'l Plan").alias("int_plan"), F.col("VMail Plan").alias("vmail_plan"),
        *[
            cells.column(c).alias(c.replace(" ", "_").lower())
            for c in read.columns if c not in ("Int'l Plan", "VMail Plan")
        ],
    )


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files have the same columns in two orders, and one more in some of them."""
    path = new_shared_path(spark, "part-mixed")
    parts = table(spark, sf_dir, "part")
    plain, turned = parts.where("p_partkey % 2 = 0"), parts.where("p_partkey % 2 = 1")
    plain.select("p_partkey", "p_name", "p_retailprice").write.csv(path, header=True)
    turned.select("p_retailprice", "p_type", "p_partkey", "p_name").write.mode("append").csv(
        path, header=True
    )
    types = {"p_partkey": "double", "p_name": "string", "p_type": "string",
             "p_retailprice": "double"}
    return delimited.read_with_header(spark, path, types, headers="each", optional=["p_type"])


def renewal_lines_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide renewal scan: ten positions and the collapsed label, bad cells as 0.0."""
    return schemas.read_renewal(spark, derived.write_renewal_lines(spark, sf_dir), fill="zero")


def renewal_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The renewal scan with a header: ten numbers, missing ones NULL, and the group text."""
    return schemas.read_renewal_with_header(spark, derived.write_renewal_csv(spark, sf_dir))


# --- Projections, cells, labels ------------------------------------------------------------


def project_drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    kept = cols.keep(suppliers, cols.names_except(suppliers, {"s_name"}))
    doubled = cols.replace(kept, {"s_acctbal": F.col("s_acctbal") * 2})
    return cols.rename(cols.drop(doubled, ["s_nationkey"]), {"s_acctbal": "balance"})


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "N", "no")
    other = F.when(F.col("l_linestatus") == "O", "Yes")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, F.coalesce(answer, other).alias("answer")
    )


def yes_no_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.col("answer")
    return _answers(spark, sf_dir).select(
        *LINE_KEY, cells.is_yes(answer).alias("is_yes"), cells.to_flag(answer).alias("flag")
    )


def _mixed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, mixed with words, suffixes, blanks, NaN and NULL."""
    line = F.col("l_linenumber")
    cell = (
        F.when(line == 1, "abc")
        .when(line == 2, F.concat(F.col("l_discount").cast("string"), F.lit("d")))
        .when(line == 3, "")
        .when(line == 4, "nan")
        .when(line == 5, F.concat(F.lit(" "), F.col("l_tax").cast("string"), F.lit(" ")))
        .when(line == 7, F.col("l_quantity").cast("string"))
    )
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, cell.alias("cell"))


def safe_cast_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell")
    read = _mixed_cells(spark, sf_dir).select(
        *LINE_KEY,
        cells.to_double(cell).alias("number"),
        cells.to_double_or_zero(cell).alias("zeroed"),
    )
    return ms.fill_zero(read.withColumn("filled", F.col("number")), ["filled"])


def label_one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    churn = F.when(F.col("c_acctbal") < 0, "True.").when(F.col("c_acctbal") < 9000, "False.")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        labels.one_vs_rest(segment, "BUILDING", "Others").alias("grouped"),
        labels.equals_label(segment, "BUILDING").alias("by_text"),
        labels.equals_label(F.col("c_nationkey"), C.RENEWAL_POSITIVE_CODE).alias("by_code"),
        labels.equals_label(churn, C.CHURN_LABELS[1]).alias("by_literal"),
    )


def row_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose key falls into the held-out fifth."""
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return items.where(sp.held_out(LINE_KEY, C.SHARE_FIFTH))


# --- Missing values ------------------------------------------------------------------------


def _masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with NULL discounts, NaN taxes, a constant, and a returned label."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        "l_quantity",
        "l_extendedprice",
        F.when(line != 7, F.col("l_discount")).alias("l_discount"),
        F.when(line == 6, float("nan")).otherwise(F.col("l_tax")).alias("l_tax"),
        F.lit(1.5).alias("flat"),
        labels.equals_label(F.col("l_returnflag"), "R").alias("returned"),
    )


def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.null_audit(_masked(spark, sf_dir))


def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells of all rows filled with the means of the training rows."""
    masked = _masked(spark, sf_dir)
    train, _ = sp.split(masked, LINE_KEY, C.SHARE_FIFTH)
    filled = ms.mean_imputer(["l_discount", "l_tax"]).fit(train).transform(masked)
    return filled.select(
        *LINE_KEY, _round("l_discount").alias("discount"), _round("l_tax").alias("tax")
    )


# --- Profiles ------------------------------------------------------------------------------


def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = pf.column_stats(_masked(spark, sf_dir), MEASURES)
    return stats.select(
        "column", "n", *[_round(m).alias(m) for m in ("mean", "std_pop", "std_samp")]
    )


def corr_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = pf.top_correlations(_masked(spark, sf_dir), "returned", [*MEASURES, "flat"])
    return top.select("feature", _round("r").alias("r"))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = pf.correlation_matrix(_masked(spark, sf_dir), [*MEASURES, "flat"])
    return matrix.select("x", "y", _round("r").alias("r"))


def renewal_top_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-ten listing of the renewal study, on its CSV file."""
    path = derived.write_renewal_csv(spark, sf_dir)
    return studies.renewal_correlations(spark, path).select("feature", _round("r").alias("r"))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.category_counts(
        table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"]
    )


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = pf.class_weights(table(spark, sf_dir, "customer"), "c_mktsegment")
    return weights.select("label", "n", _round("weight").alias("weight"))


def class_weight_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the weight its class has among the training rows."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    train, _ = sp.split(customers, ["c_custkey"], C.SHARE_FIFTH)
    weighted = pf.with_class_weight(customers, train, "c_mktsegment")
    return weighted.select("c_custkey", _round("weight").alias("weight"))


# --- Features ------------------------------------------------------------------------------


def _order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def label_index_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_labels(spark, sf_dir)
    indexed = ft.index_by_frequency(["o_orderstatus"]).fit(orders).transform(orders)
    return indexed.select(
        "o_orderkey", "o_orderstatus", F.col("o_orderstatus_index").alias("status_index")
    )


def label_index_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns indexed in place; both survive."""
    orders = _order_labels(spark, sf_dir)
    return ft.index_in_place(orders, orders, ["o_orderstatus", "o_orderpriority"])


def label_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with as many values as customers, numbered by frequency and by alphabet in tables."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer")
    )
    stages = [
        *ft.index_wide(["customer"], few=0), *ft.index_wide(["customer"], "_place", "alphabet", 0)
    ]
    indexed = Pipeline(stages=stages).fit(orders).transform(orders)
    return indexed.select("o_orderkey", "customer_index", "customer_place")


def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority to index and back to text, with the labels of the fitted indexer."""
    orders = _order_labels(spark, sf_dir)
    model = ft.index_by_frequency(["o_orderpriority"]).fit(orders)
    decode = ft.label_text("o_orderpriority_index", model.labelsArray[0], "decoded")
    return decode.transform(model.transform(orders)).select(
        "o_orderkey", F.col("o_orderpriority_index").alias("priority_index"), "decoded"
    )


def _places(vector: str, width: int, prefix: str) -> list[Column]:
    values = vector_to_array(F.col(vector))
    return [F.get(values, F.lit(i)).alias(f"{prefix}{i}") for i in range(width)]


def onehot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two indexed columns to 0/1 vectors in place, the last category dropped."""
    names = ["o_orderstatus", "o_orderpriority"]
    orders = _order_labels(spark, sf_dir)
    indexed = (
        ft.index_by_frequency(names).setHandleInvalid("error").fit(orders).transform(orders)
    ).select("o_orderkey", *[F.col(c + "_index").alias(c) for c in names])
    hot = ft.one_hot_in_place(indexed, indexed, names)
    return hot.select(
        "o_orderkey", *_places("o_orderstatus", 2, "status_"),
        *_places("o_orderpriority", 4, "priority_"),
    )


def onehot_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status label as a 0/1 vector, one place per class in alphabetical order."""
    orders = _order_labels(spark, sf_dir)
    stages = Pipeline(stages=ft.label_one_hot("o_orderstatus", "hot"))
    return stages.fit(orders).transform(orders).select("o_orderkey", *_places("hot", 3, "class_"))


def vector_assemble_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("open", F.col("l_linestatus") == "O")
    assembled = ft.assemble([*MEASURES, "open"]).transform(items)
    return ft.to_dense(assembled, "features").select(*LINE_KEY, *_places("features", 5, "f"))


def auto_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns have few enough values to be categories, and how many."""
    names = ["l_linenumber", "l_quantity", "l_tax", "l_discount"]
    vectors = ft.assemble(names, "raw").transform(table(spark, sf_dir, "lineitem").select(*names))
    found = ft.detect_categories("raw", "indexed").fit(vectors).categoryMaps
    sizes = {c: len(found[i]) if i in found else None for i, c in enumerate(names)}
    rows = [(c, size is not None, size) for c, size in sizes.items()]
    return spark.createDataFrame(rows, "feature string, is_category boolean, n_values long")


def auto_categorical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its re-indexed features: categories get their place in value order."""
    names = ["l_linenumber", "l_quantity", "l_tax"]
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity", "l_tax")
    vectors = ft.assemble(names, "raw").transform(items)
    indexed = ft.detect_categories("raw", "indexed").fit(vectors).transform(vectors)
    return indexed.select(*LINE_KEY, *_places("indexed", 3, "f"))


def _scaled(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *MEASURES)
    vectors = ft.assemble(MEASURES, "raw").transform(items)
    train, _ = sp.split(vectors, LINE_KEY, C.SHARE_FIFTH)
    scaled = ft.standardize("raw", "scaled", **options).fit(train).transform(vectors)
    values = vector_to_array(F.col("scaled"))
    return scaled.select(
        *LINE_KEY, *[_round(F.get(values, F.lit(i))).alias(c) for i, c in enumerate(MEASURES)]
    )


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows scaled by the mean and population deviation of the training rows."""
    return _scaled(spark, sf_dir)


def standardize_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, spread="sample")


def center_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, scale=False)


# --- Splits --------------------------------------------------------------------------------


def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return _parts(sp.split(items, LINE_KEY, C.SHARE_FIFTH))


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return _parts(sp.split_exact(items, LINE_KEY, C.SHARE_THREE_TENTHS))


def split_exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of an exact split of a table whose whole rows repeat: three in ten of all flags."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    parts = _parts(sp.split_exact(flags, ["l_returnflag", "l_linestatus"], C.SHARE_THREE_TENTHS))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def split_quarter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of a held-out quarter."""
    ids = table(spark, sf_dir, "orders").select("o_orderkey")
    return sp.split_exact(ids, ["o_orderkey"])[1]


def _parts(tables: tuple[DataFrame, DataFrame]) -> DataFrame:
    train, test = tables
    return train.withColumn("part", F.lit("train")).unionAll(
        test.withColumn("part", F.lit("test"))
    )


# --- Learners ------------------------------------------------------------------------------

TEXT_FEATURES = ["n_chars", "n_words", "word_length", "letter_share", "distinct_share"]


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as five numbers over the whole text, a split key and a quality label.

    The text is reduced to numbers and a hash before the join, so no text is shuffled.
    """
    text = F.col("text")
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text).alias("text_hash"),
        F.length(text).cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        letters.cast("double").alias("n_letters"),
        F.size(F.array_distinct(words)).cast("double").alias("n_distinct"),
    )
    features = counted.select(
        "doc_id", "text_hash", "n_chars", "n_words",
        _share("n_letters", "n_words").alias("word_length"),
        _share("n_letters", "n_chars").alias("letter_share"),
        _share("n_distinct", "n_words").alias("distinct_share"),
    )
    marked = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return features.join(marked, "doc_id")


def _marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label that depends on the line number and the quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("line"),
        ((F.col("l_linenumber") % 2 == 0) == (F.col("l_quantity") < 35))
        .cast("double").alias("label"),
        ((F.col("l_quantity") - 25) / 10).alias("margin"),
    )


def platt_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sigmoid that turns a margin into a probability, fitted to all line items."""
    rows = _marked_lines(spark, sf_dir)
    slope, offset = fit_sigmoid(rows, "margin", "label")
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    return n.select("n", _round(F.lit(slope)).alias("slope"), _round(F.lit(offset)).alias("offset"))


def svc_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear support-vector classifier with probabilities: the listing of held-out documents."""
    rows, = sinks.keep_in_memory(quality_rows(spark, sf_dir))
    train, test = sp.split(rows, ["text_hash"], C.SHARE_FIFTH)
    model = ln.calibrated_svc(train, TEXT_FEATURES, ["text_hash"])
    return ev.listing(model.transform(test), ["doc_id"], probability="probability")


def score_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many customers there are in a file without labels, and how many of them a saved model
    scores as the fitted one does."""
    path = derived.write_churn_csv(spark, sf_dir)
    result = studies.run_study(spark, "churn_linear", path)
    model, unmarked = new_shared_path(spark, "model"), new_shared_path(spark, "churn-unmarked")
    scoring.save_model(result, "churn_linear", model)
    delimited.read_with_header(spark, path).drop(C.CHURN_HEADER_LABEL).write.csv(
        unmarked, header=True
    )
    scorer = scoring.Scorer.load(spark, model)
    rows = scorer.read(spark, unmarked)
    saved_score = scores.element(F.col("probability"), 1).alias("saved")
    again = scorer.score(rows).select(*[cells.column(c) for c in rows.columns], saved_score)
    both = result.model.transform(again)
    same = scores.element(F.col("probability"), 1) == F.col("saved")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("n_same"))


def _group_means(
    learner: Estimator, hot: bool, weighted: bool, digits: int = 4
) -> Callable[[SparkSession, str], DataFrame]:
    """Fit a label that depends on the line number, score all line items, and list the fitted
    probability of each line number. It is known without a fit: the (weighted) mean label."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, = sinks.keep_in_memory(_marked_lines(spark, sf_dir))
        if weighted:
            rows = pf.with_class_weight(rows, rows, "label")
        shaped = [ft.one_hot(["line"])] if hot else []
        stages = [*shaped, ft.assemble(["line_hot" if hot else "line"]), learner()]
        scored = Pipeline(stages=stages).fit(rows).transform(rows)
        chance = vector_to_array("probability")[1]
        return scored.groupBy(F.col("line").cast("int").alias("l_linenumber")).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.max(chance), digits).alias("probability")
        )

    return query


def _group_fits(learner: Callable[[], Estimator], margin: bool = False) -> Query:
    """As above, on all seven places of the line number and without weights: the fitted probability
    or margin of each line number, which a formula gives without a fit."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, = sinks.keep_in_memory(_marked_lines(spark, sf_dir))
        stages = [ft.one_hot(["line"], drop_last=False), ft.assemble(["line_hot"]), learner()]
        scored = Pipeline(stages=stages).fit(rows).transform(rows)
        name, value = ("margin", "rawPrediction") if margin else ("probability", "probability")
        return scored.groupBy(F.col("line").cast("int").alias("l_linenumber")).agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.max(vector_to_array(value)[1]), 4).alias(name),
        )

    return query


def _group_mean_queries() -> dict[str, Query]:
    exact = {"label": "label", "tol": 1e-12, "maxIter": 1000}
    bare = {**exact, "fitIntercept": False, "standardization": False}
    found = {
        "logreg_l1_group_means": _group_fits(lambda: ln.logistic("l1", 0.02, **bare)),
        "logreg_l2_group_means": _group_fits(lambda: ln.logistic("l2", 0.02, **bare)),
        "svc_group_margins": _group_fits(lambda: ln.linear_svc(**bare, regParam=0.15), margin=True),
        # One row a block: MLlib weighs a partition's last, shorter block like a full one.
        "mlp_group_means": _group_fits(lambda: ln.network("none", 8, **exact, blockSize=1)),
    }
    for suffix, weight in (("", None), ("_weighted", "weight")):
        found[f"logreg_group_means{suffix}"] = _group_means(
            lambda w=weight: ln.logistic(label="label", weight=w, tol=1e-12, maxIter=500),
            hot=True, weighted=bool(weight),
        )
        found[f"forest_group_means{suffix}"] = _group_means(
            lambda w=weight: ln.forest(
                "churn", "label", weight=w, numTrees=1, bootstrap=False,
                featureSubsetStrategy="all",
            ),
            hot=False, weighted=bool(weight),
        )
    return found


def _share(top: str, bottom: str) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _quality_listing(
    learner: Estimator, scaling: str | None = None, balanced: bool = False,
    probability: bool = True,
) -> Query:
    """Fit on four fifths of the labelled documents, list the predictions for the rest."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # One materialised table of numbers serves the fit's passes and the scoring.
        rows, = sinks.keep_in_memory(quality_rows(spark, sf_dir))
        train, test = sp.split(rows, ["text_hash"], C.SHARE_FIFTH)
        if balanced:
            train = pf.with_class_weight(train, train, "label")
        model = ln.classification_stages(learner, TEXT_FEATURES, scaling=scaling).fit(train)
        return ev.listing(
            model.transform(test), ["doc_id"], probability="probability" if probability else None
        )

    return query


def _learner_queries() -> dict[str, Query]:
    """Learners are built on first use: MLlib objects need a running session."""
    width = len(TEXT_FEATURES)

    def when_called(make: Callable[[], Estimator], **options) -> Query:
        return lambda spark, sf_dir: _quality_listing(make(), **options)(spark, sf_dir)

    def plain(make: Callable[[], Estimator], **options) -> Query:
        return when_called(make, scaling="standard", **options)

    found = {
        "rf_churn": when_called(lambda: ln.forest("churn", "label")),
        "rf_renewal": when_called(lambda: ln.forest("renewal", "label")),
        "rf_balanced": when_called(
            lambda: ln.forest("renewal", "label", weight="weight"), balanced=True
        ),
        "logreg": plain(lambda: ln.logistic(label="label")),
        "logreg_l1": plain(
            lambda: ln.logistic("l1", label="label", weight="weight"), balanced=True
        ),
        "logreg_l2": plain(
            lambda: ln.logistic("l2", label="label", weight="weight"), balanced=True
        ),
        "linear_svc": plain(lambda: ln.linear_svc("label"), probability=False),
    }
    for shape in C.NETWORK_HIDDEN:
        found[f"mlp_{shape}"] = plain(
            lambda shape=shape: ln.network(shape, width, label="label")
        )
    return found


# --- Scores and metrics --------------------------------------------------------------------


def score_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of the largest element of each embedding."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", scores.argmax(F.col("embedding")).alias("top_place")
    )


def score_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as probabilities over its elements, one row per element."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(scores.softmax(F.col("embedding"))).alias("place", "p")
    )
    return rows.select("vec_id", "place", _round("p").alias("probability"))


def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items scored by a fixed rule, so that the metrics can be checked against SQL."""
    score = F.col("l_quantity") / 50.0 + F.col("l_discount")
    items = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        score.alias("score"),
        labels.equals_label(F.col("l_returnflag"), "R").alias("label"),
    )
    return items.withColumn("prediction", (F.col("score") > 0.9).cast("double"))


def prediction_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.listing(fixed_scores(spark, sf_dir), LINE_KEY)


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ev.classification_report(fixed_scores(spark, sf_dir))
    return report.select(
        "class", *[_round(m).alias(m) for m in ("precision", "recall", "f1")], "support"
    )


def balanced_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.balanced_accuracy(fixed_scores(spark, sf_dir))
    return found.select(_round("balanced_accuracy").alias("balanced_accuracy"))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.accuracy(fixed_scores(spark, sf_dir)).select(_round("accuracy").alias("accuracy"))


def accuracy_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent of rows where the larger of two class scores is where the one-hot label is."""
    scored = fixed_scores(spark, sf_dir).select(
        F.array(F.lit(0.9), "score").alias("class_scores"),
        F.array(1.0 - F.col("label"), "label").alias("hot"),
    )
    found = ev.accuracy_percent(
        scored, scores.argmax(F.col("class_scores")), scores.argmax(F.col("hot"))
    )
    return found.select(_round("accuracy_percent").alias("accuracy_percent"))


def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.area_under_roc(fixed_scores(spark, sf_dir))
    return found.select(_round("area_under_roc").alias("area_under_roc"))


def auc_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.area_under_pr(fixed_scores(spark, sf_dir))
    return found.select(_round("area_under_pr").alias("area_under_pr"))


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.evaluate(fixed_scores(spark, sf_dir))
    return found.select("metric", _round("value").alias("value"))


# --- Studies -------------------------------------------------------------------------------

def _study_file(name: str) -> Callable[[SparkSession, str], str]:
    """The writer of the file that a study reads: lines for the two scans without a header."""
    if name == "churn_forest":
        return derived.write_churn_lines
    if name == "renewal_forest":
        return derived.write_renewal_lines
    return derived.write_churn_csv if name.startswith("churn") else derived.write_renewal_csv


def study_metrics(name: str) -> Query:
    """Derive the study's file, run the study on it, and return its metrics."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return studies.run_study(spark, name, _study_file(name)(spark, sf_dir)).metrics()

    return query


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        text_split_pick, csv_header_scan, csv_sink_roundtrip, preview_top20, churn_lines_typed,
        churn_csv_typed, csv_mixed_headers, renewal_lines_typed, renewal_csv_typed, project_drop_rename,
        yes_no_flags, safe_cast_zero, label_one_vs_rest, row_subset, null_audit, impute_mean,
        column_stats, corr_topk, corr_matrix, renewal_top_correlations, category_counts,
        class_weights, class_weight_column, label_index_freq, label_index_multi, label_index_wide,
        label_decode,
        onehot_features, onehot_label, vector_assemble_dense, auto_categorical,
        auto_categorical_rows, standardize, standardize_sample, center_only, split_hash,
        split_exact, split_exact_repeats, split_quarter_ids, score_argmax, score_softmax,
        prediction_listing, platt_fit, svc_probability, score_saved_model,
        classification_report, balanced_accuracy, accuracy, accuracy_pct, auc_roc, auc_pr,
        metric_table,
    )
}
QUERIES.update(_learner_queries())
QUERIES.update(_group_mean_queries())
QUERIES.update({f"study_{name}": study_metrics(name) for name in studies.STUDIES})
