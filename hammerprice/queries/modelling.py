"""Preparation, regression, search, importance and promotion over whole tables.

The linear models have closed forms, so their folds, grids, importances and gates are checked in SQL; so are those of
a forest without sampling on one feature of few values.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from hammerprice.learning.dictionary import slot_dictionary
from hammerprice.learning.estimators import least_squares, random_forest
from hammerprice.learning.forest_relation import broken_nodes, forest_nodes, tree_predictions
from hammerprice.learning.importance import permutation_importance
from hammerprice.learning.preparation import FEATURES, PopulationScaler, preparation_stages, regression_pipeline
from hammerprice.learning.promotion import gate, retrain_verdict
from hammerprice.learning.search import TimeOrderedSearch, cross_validate
from hammerprice.operators.metrics import regression_report as report
from hammerprice.operators.row_order import permutation_sql
from hammerprice.operators.splits import relative_month_split
from hammerprice.queries.frame import TIES, rounded, table
from hammerprice.queries.registry import query
from hammerprice.session import materialize, scratch_path
from hammerprice.sources.model_registry import current_champion, promote_model

LINEAR = {"regressor": "least_squares", "params": {}, "numeric": ["l_partkey", "l_quantity"], "text": []}


def priced_lines(spark, sf_dir):
    """Line items with a price that depends on their part as label, and the order month, stored as a table.

    Fitting and scoring read it several times; the joins run once.
    """
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    lines = joined.select(
        *TIES, "l_quantity", "p_size", "p_type",
        (F.col("p_retailprice") + F.col("l_discount") * 100).alias("price"),
        F.trunc("o_orderdate", "month").alias("month"),
    )
    return materialize(lines, "priced-lines")


PRICED_SQL = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, p_size, p_retailprice + l_discount * 100 AS y,
         CAST(l_partkey AS DOUBLE) AS x1, l_quantity AS x2, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
),
cut AS (SELECT max(month) AS latest, CAST(max(month) - INTERVAL 1 MONTH AS DATE) AS before FROM lines)
"""


def two_feature_fit(source: str) -> str:
    """Least squares of y on x1 and x2 by the normal equations, per `who`."""
    return f"""
moments AS (SELECT who, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22,
                   covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y
            FROM {source} GROUP BY who),
slopes AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
                  (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM moments),
coef AS (SELECT who, b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM slopes)
"""


# ---- preparation ----


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
       round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS quantity,
       round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS price
FROM lineitem
"""
)
def standardised(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*TIES, "l_quantity", "l_extendedprice")
    scaler = PopulationScaler(inputCols=["l_quantity", "l_extendedprice"], outputCols=["quantity", "price"])
    return rounded(scaler.fit(lines).transform(lines), 6, "quantity", "price").select(*TIES, "quantity", "price")


@query(
    """
SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS high,
       CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS medium, CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS none
FROM orders
"""
)
def one_hot(spark, sf_dir):
    """Slots in sorted order; the priority the encoder was not fitted on gets zeros."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    stages = preparation_stages([], ["o_orderpriority"])
    fitted = Pipeline(stages=stages).fit(orders.where("o_orderpriority <> '5-LOW'"))
    slots = vector_to_array(F.col(FEATURES))
    names = ["urgent", "high", "medium", "none"]
    return fitted.transform(orders).select(
        "o_orderkey", *[slots[i].cast("int").alias(name) for i, name in enumerate(names)]
    )


@query(
    """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_orderkey || '/' || l_linenumber AS line,
                  nullif(l_returnflag, 'N') AS flag FROM lineitem),
     lines AS (SELECT line, row_number() OVER (ORDER BY line) - 1 AS slot FROM (SELECT DISTINCT line FROM t WHERE l_linenumber <> 2)),
     flags AS (SELECT flag, (SELECT count(*) FROM lines) + row_number() OVER (ORDER BY flag) - 1 AS slot
               FROM (SELECT DISTINCT flag FROM t WHERE flag IS NOT NULL AND l_linenumber <> 2))
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, lines.slot AS line_slot, flags.slot AS flag_slot
FROM t LEFT JOIN lines USING (line) LEFT JOIN flags USING (flag)
"""
)
def one_hot_dictionary(spark, sf_dir):
    """Slots of a text column with a value per line and of one with NULLs; lines numbered 2 are not fitted on."""
    lines = table(spark, sf_dir, "lineitem").select(
        *TIES, F.concat_ws("/", "l_orderkey", "l_linenumber").alias("line"), F.nullif("l_returnflag", F.lit("N")).alias("flag")
    )
    found = slot_dictionary(lines.where("l_linenumber <> 2"), ["line", "flag"])
    slots, lines_end = F.col("slots"), found.table.where("which = 0").count()
    first = lambda inside: F.get(F.filter(slots, inside), F.lit(0))
    return found.encode(lines, keep=TIES).select(
        *TIES, first(lambda s: s < lines_end).alias("line_slot"), first(lambda s: s >= lines_end).alias("flag_slot")
    )


@query(
    """
WITH p AS (SELECT p_partkey, p_type, p_brand, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS size,
                  (p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS price FROM part),
     d AS (SELECT count(DISTINCT p_type) AS types, count(DISTINCT p_brand) AS brands FROM part)
SELECT p_partkey, CAST(2 + types + brands AS INTEGER) AS slots, round(size, 6) AS size, round(price, 6) AS price,
       CAST((SELECT count(DISTINCT t.p_type) FROM part t WHERE t.p_type < p.p_type) AS INTEGER) AS type_slot,
       CAST(types + (SELECT count(DISTINCT t.p_brand) FROM part t WHERE t.p_brand < p.p_brand) AS INTEGER) AS brand_slot
FROM p, d
"""
)
def feature_vector(spark, sf_dir):
    """Scaled numbers first, then the one-hot slots of each text column."""
    parts = table(spark, sf_dir, "part")
    stages = preparation_stages(["p_size", "p_retailprice"], ["p_type", "p_brand"])
    vector = vector_to_array(F.col(FEATURES))
    hot = F.slice(vector, F.lit(3), F.size(vector) - 2)
    brands = F.reverse(hot)
    return Pipeline(stages=stages).fit(parts).transform(parts).select(
        "p_partkey",
        F.size(vector).alias("slots"),
        F.round(vector[0], 6).alias("size"),
        F.round(vector[1], 6).alias("price"),
        (F.array_position(hot, F.lit(1.0)) - 1).cast("int").alias("type_slot"),
        (F.size(hot) - F.array_position(brands, F.lit(1.0))).cast("int").alias("brand_slot"),
    )


# ---- least squares ----


@query(
    """
SELECT round(regr_slope(p_retailprice, p_partkey) * stddev_pop(p_partkey), 6) AS slope_per_deviation,
       round(avg(p_retailprice), 6) AS intercept FROM part
"""
)
def linear_fit(spark, sf_dir):
    """Coefficients on the standardised feature."""
    parts = table(spark, sf_dir, "part")
    model = regression_pipeline(least_squares("p_retailprice"), ["p_partkey"], []).fit(parts).stages[-1]
    fitted = [(float(model.coefficients[0]), model.intercept)]
    return rounded(
        spark.createDataFrame(fitted, "slope_per_deviation double, intercept double"), 6,
        "slope_per_deviation", "intercept",
    )


@query(
    """
WITH m AS (SELECT regr_slope(p_retailprice, p_partkey) AS b, regr_intercept(p_retailprice, p_partkey) AS a FROM part)
SELECT p_partkey, round(a + b * p_partkey, 6) AS prediction, 2 AS sequence FROM part, m
"""
)
def model_registry(spark, sf_dir):
    """Two models promoted one after the other; the newer one is loaded and applied."""
    parts = table(spark, sf_dir, "part")
    root = scratch_path(spark, "registry")
    settings = {"regressor": "least_squares", "params": {}, "numeric": ["p_partkey"], "text": []}
    older = regression_pipeline(least_squares("p_retailprice", fitIntercept=False), ["p_partkey"], [])
    newer = regression_pipeline(least_squares("p_retailprice"), ["p_partkey"], [])
    promote_model(spark, older.fit(parts), root, "first", settings | {"params": {"fitIntercept": False}})
    promote_model(spark, newer.fit(parts), root, "second", settings)
    champion = current_champion(spark, root)
    scored = champion.load().transform(parts)
    return rounded(scored, 6, "prediction").select(
        "p_partkey", "prediction", F.lit(champion.sequence).cast("int").alias("sequence")
    )


_FOLDS_SQL = """
r AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS i, CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y FROM part),
n AS (SELECT count(*) AS n, count(*) // 6 AS t FROM r),
f AS (SELECT CAST(k AS INTEGER) AS fold, n - (5 - k) * t AS s, t FROM n, range(5) g(k)),
m AS (SELECT fold, s, t, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS mx, stddev_pop(x) AS sx,
             regr_sxy(y, x) / stddev_pop(x) AS zy, count(*) AS zz FROM f JOIN r ON i < s GROUP BY fold, s, t)
"""


@query(
    f"""
WITH {_FOLDS_SQL}
SELECT fold, round(sqrt(avg(pow(y - (a + b * x), 2))), 6) AS rmse FROM m JOIN r ON i >= s AND i < s + t GROUP BY fold
"""
)
def linear_folds(spark, sf_dir):
    """RMSE of each expanding fold."""
    pipeline = regression_pipeline(least_squares("p_retailprice"), ["p_partkey"], [])
    found = cross_validate(pipeline, table(spark, sf_dir, "part"), "p_retailprice", ["p_partkey"])
    return rounded(found.scores.select("fold", "rmse"), 6, "rmse")


@query(
    f"""
WITH {_FOLDS_SQL},
e AS (
  SELECT 0 AS candidate, fold, sqrt(avg(pow(y - (a + b * x), 2))) AS rmse
  FROM m JOIN r ON i >= s AND i < s + t GROUP BY fold
  UNION ALL
  SELECT 1, fold, sqrt(avg(pow(y - zy / zz * (x - mx) / sx, 2))) FROM m JOIN r ON i >= s AND i < s + t GROUP BY fold
)
SELECT candidate, round(avg(rmse), 6) AS mean_rmse, round(stddev_pop(rmse), 6) AS std_rmse FROM e GROUP BY candidate
"""
)
def grid_search(spark, sf_dir):
    """Two candidates, with and without intercept, over five folds each; the best one is refitted."""
    regressor = least_squares("p_retailprice")
    pipeline = regression_pipeline(regressor, ["p_partkey"], [])
    grid = ParamGridBuilder().addGrid(regressor.fitIntercept, [True, False]).build()
    search = TimeOrderedSearch(pipeline, "p_retailprice", ["p_partkey"], grid)
    return rounded(search.fit(table(spark, sf_dir, "part")).summary, 6, "mean_rmse", "std_rmse")


# ---- scores, importance, promotion ----


@query(
    """
WITH s AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
SELECT l_returnflag, count(*) AS example_count, round(avg(abs(y - p)), 4) AS mean_absolute_error,
       round(avg(pow(y - p, 2)), 1) AS mean_squared_error, round(sqrt(avg(pow(y - p, 2))), 4) AS root_mean_squared_error,
       round(sum(y), 2) AS sum_on_target, round(avg(y), 4) AS mean_on_target,
       round(1 - avg(pow(y - p, 2)) / var_pop(y), 6) AS r2_score, round(max(abs(y - p)), 4) AS max_error,
       round(avg(abs(y - p) / abs(y)), 6) AS mean_absolute_percentage_error
FROM s GROUP BY l_returnflag
"""
)
def regression_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    scores = report(lines, "l_extendedprice", "guess", ["l_returnflag"])
    digits = {
        "mean_absolute_error": 4, "mean_squared_error": 1, "root_mean_squared_error": 4, "sum_on_target": 2,
        "mean_on_target": 4, "r2_score": 6, "max_error": 4, "mean_absolute_percentage_error": 6,
    }
    return scores.withColumns({name: F.round(name, n) for name, n in digits.items()})


@query(
    """
WITH s AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS a, 50000 + l_quantity AS b FROM lineitem),
     e AS (SELECT sqrt(avg(pow(y - a, 2))) AS champion_rmse, sqrt(avg(pow(y - b, 2))) AS challenger_rmse FROM s)
SELECT round(champion_rmse, 4) AS champion_rmse, round(challenger_rmse, 4) AS challenger_rmse,
       challenger_rmse < 0.95 * champion_rmse AS promote FROM e
"""
)
def rmse_gate(spark, sf_dir):
    """Two formulas as champion and challenger on the same rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 2000).alias("old"), (F.col("l_quantity") + 50000).alias("new")
    )
    return rounded(gate(lines, "l_extendedprice", "old", "new"), 4, "champion_rmse", "challenger_rmse")


@query(
    f"""
WITH {PRICED_SQL},
training AS (SELECT 'champion' AS who, lines.* FROM lines, cut WHERE month < before
             UNION ALL SELECT 'challenger', lines.* FROM lines, cut WHERE month < latest),
{two_feature_fit('training')},
e AS (SELECT who, sqrt(avg(pow(y - (b0 + b1 * x1 + b2 * x2), 2))) AS rmse
      FROM lines, cut, coef WHERE month = latest GROUP BY who),
v AS (SELECT max(rmse) FILTER (WHERE who = 'champion') AS champion_rmse,
             max(rmse) FILTER (WHERE who = 'challenger') AS challenger_rmse FROM e)
SELECT round(champion_rmse, 6) AS champion_rmse, round(challenger_rmse, 6) AS challenger_rmse,
       challenger_rmse < 0.95 * champion_rmse AS promote FROM v
"""
)
def retrain_gate(spark, sf_dir):
    """The champion's configuration refitted on train and test, both compared on the newest month."""
    splits = relative_month_split(priced_lines(spark, sf_dir))
    verdict = retrain_verdict(LINEAR, splits["train"], splits["test"], splits["retrain_test"], "price")
    return rounded(verdict, 6, "champion_rmse", "challenger_rmse")


@query(
    f"""
WITH RECURSIVE {PRICED_SQL},
training AS (SELECT 'model' AS who, lines.* FROM lines, cut WHERE month < before),
{two_feature_fit('training')},
t AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS i, y, x1, x2
      FROM lines, cut WHERE month = before),
{permutation_sql("t", 10, 42)},
d AS (SELECT repeat, row_index AS i, x1 AS d1, x2 AS d2 FROM donors JOIN t USING (i)),
base AS (SELECT avg(pow(y - (b0 + b1 * x1 + b2 * x2), 2)) AS mse, var_pop(y) AS spread FROM t, coef),
p AS (SELECT repeat, avg(pow(y - (b0 + b1 * d1 + b2 * x2), 2)) AS mse1, avg(pow(y - (b0 + b1 * x1 + b2 * d2), 2)) AS mse2
      FROM t JOIN d USING (i), coef GROUP BY repeat)
SELECT 'l_partkey' AS feature, round(avg((mse1 - mse) / spread), 9) AS importance_mean,
       round(stddev_pop((mse1 - mse) / spread), 9) AS importance_std FROM p, base
UNION ALL
SELECT 'l_quantity', round(avg((mse2 - mse) / spread), 9), round(stddev_pop((mse2 - mse) / spread), 9) FROM p, base
"""
)
def linear_importance(spark, sf_dir):
    """Permutation importance of a linear model on the month before the newest."""
    splits = relative_month_split(priced_lines(spark, sf_dir))
    features = LINEAR["numeric"]
    model = regression_pipeline(least_squares("price"), features, []).fit(splits["train"])
    found = permutation_importance(model, splits["test"], features, "price", TIES)
    return rounded(found, 9, "importance_mean", "importance_std")


# ---- forests ----

# One feature of at most 64 values, every row in every tree and leaves of one value: such a forest predicts the mean
# of the label by value, which SQL can tell. The tuned settings run in `tune_forest`.
_EXACT_FOREST = {
    "numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": 64, "maxDepth": 16,
    "minInstancesPerNode": 1,
}
_FOREST_SQL = """
sized AS (SELECT lines.* EXCLUDE (y), y + 100 * p_size AS y FROM lines),
means AS (SELECT p_size, avg(y) AS p FROM sized, cut WHERE month < before GROUP BY p_size),
scored AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS i, y, p_size, p
           FROM sized JOIN means USING (p_size), cut WHERE month = before)
"""


def _sized_lines(spark, sf_dir):
    return priced_lines(spark, sf_dir).withColumn("price", F.col("price") + 100 * F.col("p_size"))


def _forest():
    return regression_pipeline(random_forest("price", **_EXACT_FOREST), ["p_size"], [])


@query(
    f"""
WITH {PRICED_SQL}, {_FOREST_SQL}
SELECT count(*) AS example_count, round(avg(abs(y - p)), 6) AS mean_absolute_error,
       round(avg(pow(y - p, 2)), 4) AS mean_squared_error, round(sqrt(avg(pow(y - p, 2))), 6) AS root_mean_squared_error,
       round(sum(y), 2) AS sum_on_target, round(avg(y), 6) AS mean_on_target,
       round(1 - avg(pow(y - p, 2)) / var_pop(y), 9) AS r2_score, round(max(abs(y - p)), 6) AS max_error,
       round(avg(abs(y - p) / abs(y)), 9) AS mean_absolute_percentage_error
FROM scored
"""
)
def forest_scores(spark, sf_dir):
    """A forest trained on all but the two newest months, scored on the month before the newest."""
    splits = relative_month_split(_sized_lines(spark, sf_dir))
    scores = report(_forest().fit(splits["train"]).transform(splits["test"]), "price", "prediction")
    digits = {
        "mean_absolute_error": 6, "mean_squared_error": 4, "root_mean_squared_error": 6, "sum_on_target": 2,
        "mean_on_target": 6, "r2_score": 9, "max_error": 6, "mean_absolute_percentage_error": 9,
    }
    return scores.withColumns({name: F.round(name, n) for name, n in digits.items()})


@query(
    f"""
WITH {PRICED_SQL}, {_FOREST_SQL},
r AS (SELECT row_number() OVER (ORDER BY month, l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS i, p_size, y
      FROM sized, cut WHERE month < before),
n AS (SELECT count(*) AS n, count(*) // 6 AS t FROM r),
f AS (SELECT CAST(k AS INTEGER) AS fold, n - (5 - k) * t AS s, t FROM n, range(5) g(k)),
m AS (SELECT fold, s, t, p_size, avg(y) AS p FROM f JOIN r ON i < s GROUP BY fold, s, t, p_size)
SELECT 0 AS candidate, fold, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse
FROM m JOIN r ON i >= s AND i < s + t AND r.p_size = m.p_size GROUP BY fold
"""
)
def forest_search(spark, sf_dir):
    """A forest over five expanding folds."""
    train = relative_month_split(_sized_lines(spark, sf_dir))["train"]
    return rounded(cross_validate(_forest(), train, "price", ["month", *TIES]).scores, 6, "rmse")


@query(
    f"""
WITH RECURSIVE {PRICED_SQL}, {_FOREST_SQL},
{permutation_sql("scored", 10, 42)},
d AS (SELECT repeat, row_index AS i, p AS given FROM donors JOIN scored USING (i)),
base AS (SELECT avg(pow(y - p, 2)) AS mse, var_pop(y) AS spread FROM scored),
e AS (SELECT repeat, avg(pow(y - given, 2)) AS mse FROM scored JOIN d USING (i) GROUP BY repeat)
SELECT 'p_size' AS feature, round(avg((e.mse - base.mse) / spread), 9) AS importance_mean,
       round(stddev_pop((e.mse - base.mse) / spread), 9) AS importance_std FROM e, base
"""
)
def forest_importance(spark, sf_dir):
    """Permutation importance of the forest's feature on the month before the newest."""
    splits = relative_month_split(_sized_lines(spark, sf_dir))
    model = _forest().fit(splits["train"])
    found = permutation_importance(model, splits["test"], ["p_size"], "price", TIES)
    return rounded(found, 9, "importance_mean", "importance_std")


# Two numeric features and a text one, of few values each, every row in every tree and leaves of one combination: each
# tree predicts the mean of its combination.
_COMBINED_SQL = """
combined AS (SELECT *, p_size // 18 AS sizes, CAST(floor(l_quantity / 18) AS BIGINT) AS amounts FROM
             (SELECT lines.*, p_type FROM lines JOIN part ON l_partkey = p_partkey)),
leaves AS (SELECT sizes, amounts, p_type, avg(y) AS p, count(*) AS n FROM combined, cut WHERE month < before
           GROUP BY sizes, amounts, p_type)
"""


@query(
    f"""
WITH {PRICED_SQL}, {_COMBINED_SQL}
SELECT CAST(t AS INTEGER) AS tree, (SELECT count(*) FROM leaves) AS leaves, CAST((SELECT sum(n) FROM leaves) AS BIGINT) AS trained_on,
       count(*) AS scored, round(avg(p), 6) AS mean_prediction, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse,
       0 AS leaves_off, 0 AS broken
FROM combined JOIN leaves USING (sizes, amounts, p_type), cut, range(3) r(t) WHERE month = before GROUP BY t
"""
)
def forest_by_relation(spark, sf_dir):
    """Three trees as a node table: scored by native expressions, the leaf means recomputed from the training rows."""
    size_class, amount_class = F.floor(F.col("p_size") / 18).cast("double"), F.floor(F.col("l_quantity") / 18).cast("double")
    lines = priced_lines(spark, sf_dir).withColumns({"sizes": size_class, "amounts": amount_class})
    splits = relative_month_split(lines)
    settings = _EXACT_FOREST | {"maxDepth": 30}
    fitted = regression_pipeline(random_forest("price", **settings), ["sizes", "amounts"], ["p_type"]).fit(splits["train"])
    prepare, forest = PipelineModel(fitted.stages[:-1]), fitted.stages[-1]
    nodes = materialize(forest_nodes(spark, forest), "forest-nodes")

    trained = tree_predictions(prepare.transform(splits["train"]), forest, [*TIES, "price"])
    means = trained.groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean"), F.min("prediction").alias("prediction")
    )
    off = F.count_if(F.abs(F.col("mean") - F.col("prediction")) > 1e-6 * F.abs("mean"))
    leaves = means.groupBy("tree").agg(
        F.count(F.lit(1)).alias("leaves"), F.sum("n").alias("trained_on"), off.cast("int").alias("leaves_off")
    )
    scored = tree_predictions(prepare.transform(splits["test"]), forest, [*TIES, "price"])
    error = F.sqrt(F.avg(F.pow(F.col("price") - F.col("prediction"), 2)))
    scores = scored.groupBy("tree").agg(
        F.count(F.lit(1)).alias("scored"), F.avg("prediction").alias("mean_prediction"), error.alias("rmse")
    )
    broken = F.lit(broken_nodes(nodes).count()).cast("int").alias("broken")
    return rounded(leaves.join(scores, "tree").select("*", broken), 6, "mean_prediction", "rmse")
