"""Low-review model L1-L18: frame, stratified split, pipelines, evaluation, importance, error analysis."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import forests, scoring
from mercato.functions.cycles import donors
from mercato.functions.numbers import mean, mean_days, per
from mercato.functions.order_stats import positioned, quantiles
from mercato.functions.profile import box_summary, describe, melted, missing_counts, with_share
from mercato.market import Market
from mercato.session import discard, written

SEED = 42
TEST_SHARE = 0.2
NUMERIC = [
    "order_value",
    "products_value",
    "freight_value",
    "items_count",
    "payment_value",
    "delivery_time_days",
    "delivery_delay_days",
]
CATEGORICAL = ["is_delayed", "customer_state"]
UPPER_PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
# Class names, model names and outcome names.
CLASS_NAMES = ("Score 3–5", "Score 1–2")
PRIOR, LOGISTIC, FOREST = "Dummy Classifier", "Logistic Regression", "Random Forest"
TASK_ORDERS = 4096  # whose permuted scores are one task's work
OUTCOMES = {(0, 0): "True Negative", (0, 1): "False Positive", (1, 0): "False Negative", (1, 1): "True Positive"}


def _review_group() -> Column:
    return F.when(F.col("is_low_review") == 0, CLASS_NAMES[0]).otherwise(CLASS_NAMES[1]).alias("review_group")


def model_frame(m: Market) -> DataFrame:
    """L1: reviewed, completed orders with their features and the 0/1 target."""
    return m.delivered.where("average_review_score IS NOT NULL").select(
        "order_id",
        F.col("order_items_value").alias("order_value"),
        "products_value",
        "freight_value",
        "items_count",
        "payment_value",
        "delivery_time_days",
        "delivery_delay_days",
        "is_delayed",
        "customer_state",
        (F.col("average_review_score") <= 2).cast("int").alias("is_low_review"),
    )


def missing_features(m: Market) -> DataFrame:
    return missing_counts(model_frame(m)).orderBy(F.desc("missing_count"), "variable")


def target_distribution(m: Market) -> DataFrame:
    """L2."""
    counts = model_frame(m).groupBy("is_low_review").agg(F.count(F.lit(1)).alias("orders_count"))
    return with_share(counts.select("*", _review_group()), "orders_count", "orders_share_percent").orderBy(
        F.desc("orders_count")
    )


def feature_describe(m: Market) -> DataFrame:
    return describe(model_frame(m), NUMERIC, UPPER_PERCENTILES)


def feature_summary(m: Market) -> DataFrame:
    """L3: feature means and medians by class; two passes over one written frame."""
    frame = written(model_frame(m), "model_frame")
    key = ["is_low_review"]
    delayed = per(F.sum(F.col("is_delayed").cast("int")), F.count("is_delayed"))
    groups = frame.groupBy(*key).agg(
        F.count("order_id").alias("orders_count"),
        mean(F.col("order_value")).alias("average_order_value"),
        mean(F.col("freight_value")).alias("average_freight_value"),
        mean(F.col("items_count")).alias("average_items_count"),
        mean_days(F.col("delivery_time_days")).alias("average_delivery_time"),
        mean_days(F.col("delivery_delay_days")).alias("average_delivery_delay"),
        delayed.alias("delayed_orders_share"),
    )
    medians = {"order_value": "median_order_value", "delivery_time_days": "median_delivery_time"}
    middle = (
        quantiles(melted(frame, list(medians), key), [*key, "variable"], "value", {"median": 0.5})
        .groupBy(*key)
        .agg(*[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(name) for c, name in medians.items()])
    )
    return (
        groups.join(middle, key, "left")
        .select("*", _review_group(), (F.col("delayed_orders_share") * 100).alias("delayed_orders_share_percent"))
        .orderBy("is_low_review")
    )


def delay_by_review(m: Market) -> DataFrame:
    return feature_summary(m).select(
        "is_low_review", "delayed_orders_share", "review_group", "delayed_orders_share_percent"
    )


def shuffle_key(seed: int = SEED) -> Column:
    """A 60-bit number that orders rows at random but the same way everywhere."""
    digest = F.md5(F.concat(F.col("order_id").cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def with_split(frame: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """L4: exact stratified split; per class the rows with the smallest keys form the test set.

    The class cut is an order statistic, so rows compare against it in place instead of being sorted.
    """
    keyed = frame.withColumn("split_key", shuffle_key(seed))
    cut = positioned(
        keyed, ["is_low_review"], "split_key", lambda size: F.round(size * F.lit(test_share)) - 1, "cut"
    )
    tested = F.coalesce(F.col("split_key") <= F.col("cut"), F.lit(False))
    # one cut per class, so at most two rows are broadcast
    return keyed.join(F.broadcast(cut), "is_low_review", "left").withColumn("is_test", tested).drop("cut", "split_key")


class LowReviewStudy:
    """One split with its fitted preparation and models; fitting happens on first use."""

    def __init__(self, m: Market, trees: int = 300, depth: int = 12, leaf: int = 20, seed: int = SEED):
        self.market, self.trees, self.depth, self.leaf, self.seed = m, trees, depth, leaf, seed

    @cached_property
    def frame(self) -> DataFrame:
        """Model frame with its split, written once because every fit passes over it many times.

        The cuts are found on the written frame, so the order facts are made once.
        """
        whole = written(model_frame(self.market), "model_frame")
        split = written(with_split(whole, seed=self.seed), "split_frame")
        discard(whole)
        return split

    @cached_property
    def train(self) -> DataFrame:
        return self.frame.where("NOT is_test")

    @cached_property
    def test(self) -> DataFrame:
        return self.frame.where("is_test")

    def split_summary(self) -> DataFrame:
        name = F.when(F.col("is_test"), "Test").otherwise("Train")
        return self.frame.groupBy(name.alias("dataset")).agg(
            F.count(F.lit(1)).alias("observations_count"),
            (mean(F.col("is_low_review")) * 100).alias("low_review_share_percent"),
        )

    def split_overlap(self) -> DataFrame:
        shared = self.train.select("order_id").join(self.test.select("order_id"), "order_id", "left_semi")
        return shared.agg(F.count(F.lit(1)).alias("shared_orders"))

    def fill_values(self) -> DataFrame:
        """Training medians of numeric and most frequent values of categorical features."""
        middle = quantiles(melted(self.train, NUMERIC), ["variable"], "value", {"median": 0.5})
        frames = [middle.select("variable", F.col("median").cast("string").alias("fill_value"))]
        for name in CATEGORICAL:
            common = (
                self.train.where(F.col(name).isNotNull())
                .groupBy(F.col(name).cast("string").alias("fill_value"))
                .agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), "fill_value")
                .limit(1)
            )
            frames.append(common.select(F.lit(name).alias("variable"), "fill_value"))
        return frames[0].unionByName(frames[1]).unionByName(frames[2])

    @cached_property
    def _fills(self) -> dict[str, str]:
        return {r.variable: r.fill_value for r in self.fill_values().collect()}  # nine scalars

    def prepared(self, df: DataFrame) -> DataFrame:
        """Missing values replaced by the training fills; categories as text. A column that training rows leave empty
        has no fill: it is 0 or empty text throughout."""
        fills = self._fills
        numbers = [F.coalesce(F.col(c).cast("double"), F.lit(float(fills.get(c) or 0))).alias(c) for c in NUMERIC]
        texts = [F.coalesce(F.col(c).cast("string"), F.lit(fills.get(c) or "")).alias(c) for c in CATEGORICAL]
        kept = [c for c in df.columns if c not in NUMERIC + CATEGORICAL]
        return df.select(*kept, *numbers, *texts)

    def _weighted(self, df: DataFrame) -> DataFrame:
        """Balanced weights n / (2 n_class); the two class sizes are scalars of the training set."""
        label = F.col("is_low_review")
        sizes = self.train.agg(F.count(F.lit(1)).alias("n"), F.sum("is_low_review").alias("low")).first()
        low, high = sizes["n"] / (2.0 * sizes["low"]), sizes["n"] / (2.0 * (sizes["n"] - sizes["low"]))
        return self.prepared(df).withColumn("weight", F.when(label == 1, low).otherwise(high))

    def _stages(self, scaled: bool) -> list:
        """Column transformer; the indexer's extra code for a category unseen in training is the
        dropped last one, so such a row gets an all-zero vector."""
        codes = [f"{c}_code" for c in CATEGORICAL]
        flags = [f"{c}_flags" for c in CATEGORICAL]
        stages = [
            StringIndexer(inputCols=CATEGORICAL, outputCols=codes, handleInvalid="keep"),
            OneHotEncoder(inputCols=codes, outputCols=flags, dropLast=True),
            VectorAssembler(inputCols=NUMERIC, outputCol="numbers"),
        ]
        numbers = "numbers"
        if scaled:
            stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
            numbers = "scaled"
        return [*stages, VectorAssembler(inputCols=[numbers, *flags], outputCol="features")]

    @cached_property
    def assembly(self) -> PipelineModel:
        """The forest's inputs; needs no forest."""
        return Pipeline(stages=self._stages(scaled=False)).fit(self._weighted(self.train))

    @cached_property
    def scaling(self) -> PipelineModel:
        """The logistic model's inputs."""
        return Pipeline(stages=self._stages(scaled=True)).fit(self._weighted(self.train))

    @cached_property
    def logistic(self) -> PipelineModel:
        """L2-regularised logistic regression with C = 1, which is 1 / n on the mean loss."""
        classifier = LogisticRegression(
            featuresCol="features",
            labelCol="is_low_review",
            weightCol="weight",
            maxIter=1000,
            regParam=1.0 / self.train.count(),
            standardization=False,
        )
        return self._fitted(self.scaling, classifier)

    def _fitted(self, inputs: PipelineModel, classifier: LogisticRegression | RandomForestClassifier) -> PipelineModel:
        """One pipeline of fitted inputs and the classifier fitted on them; it passes over nothing but its columns."""
        rows = inputs.transform(self._weighted(self.train)).select("is_low_review", "weight", "features")
        return PipelineModel([*inputs.stages, classifier.fit(rows)])

    @cached_property
    def forest(self) -> PipelineModel:
        """L10. The node that every row has reached in every tree is kept, not walked to from the root in each pass; that
        lineage is as long as the passes are many, so it needs no checkpoint."""
        classifier = RandomForestClassifier(
            featuresCol="features",
            labelCol="is_low_review",
            weightCol="weight",
            numTrees=self.trees,
            maxDepth=self.depth,
            minInstancesPerNode=self.leaf,
            featureSubsetStrategy="sqrt",
            seed=self.seed,
            cacheNodeIds=True,
            checkpointInterval=-1,
        )
        return self._fitted(self.assembly, classifier)

    def _scored(self, model: PipelineModel, name: str, df: DataFrame | None = None) -> DataFrame:
        rows = model.transform(self.prepared(self.test if df is None else df))
        p = vector_to_array("probability")[1]
        return rows.select(
            F.lit(name).alias("model"),
            "order_id",
            F.col("is_low_review").alias("label"),
            p.alias("score"),
            (p > 0.5).cast("int").alias("predicted"),
        )

    def prior_scores(self) -> DataFrame:
        """Everybody gets the training prevalence and the majority class."""
        share = self.train.agg(mean(F.col("is_low_review")).alias("share"))
        return self.test.select(
            F.lit(PRIOR).alias("model"),
            "order_id",
            F.col("is_low_review").alias("label"),
            share.scalar().alias("score"),
        ).withColumn("predicted", (F.col("score") > 0.5).cast("int"))

    @cached_property
    def flat_forest(self) -> forests.FlatForest:
        """The forest's nodes; trees and depth bound them."""
        return forests.FlatForest(forests.node_table(self.market.spark, self.forest.stages[-1]).toArrow().to_pandas())

    def _forest_inputs(self) -> DataFrame:
        """order_id, label and x, the forest's inputs, of the test orders."""
        rows = PipelineModel(self.forest.stages[:-1]).transform(self.prepared(self.test))
        return rows.select("order_id", F.col("is_low_review").alias("label"), vector_to_array("features").alias("x"))

    @cached_property
    def forest_scores(self) -> DataFrame:
        """Test probabilities of the forest, written once for curves, thresholds and error groups. Rows walk down flat nodes;
        ``model_checks.forest_walk`` compares with the model's own probabilities."""
        scored = forests.scored(self._forest_inputs(), self.flat_forest, "x", "score")
        return written(scored.select(F.lit(FOREST).alias("model"), "*", (F.col("score") > 0.5).cast("int").alias("predicted")), "forest_scores")

    @cached_property
    def logistic_scores(self) -> DataFrame:
        return written(self._scored(self.logistic, LOGISTIC), "logistic_scores")

    def prior_metrics(self) -> DataFrame:
        return scoring.metrics(self.prior_scores(), ["model"])

    def comparison(self, models: Sequence[str] = (PRIOR, LOGISTIC, FOREST)) -> DataFrame:
        """All models evaluated in one pass."""
        frames = {PRIOR: self.prior_scores, LOGISTIC: lambda: self.logistic_scores, FOREST: lambda: self.forest_scores}
        scored = None
        for name in models:
            scored = frames[name]() if scored is None else scored.unionByName(frames[name]())
        return scoring.metrics(scored, ["model"]).orderBy("roc_auc")

    def delay_scores(self) -> DataFrame:
        """A model-free score for checks: days of delay, 0 where unknown; late means low."""
        score = F.coalesce("delivery_delay_days", F.lit(0.0))
        return self.test.select(
            F.lit("Delay days").alias("model"),
            "order_id",
            F.col("is_low_review").alias("label"),
            score.alias("score"),
            (score > 0).cast("int").alias("predicted"),
        )

    @staticmethod
    def at_best_threshold(scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        """Decisions at the threshold with the best F1 on the same scores."""
        cut = scoring.best_threshold(scores, unit).select("threshold")
        return scores.withColumn("predicted", (F.col("score") >= cut.scalar()).cast("int"))

    def threshold_metrics(self, scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        cut = scoring.best_threshold(scores, unit).select("threshold")
        return scoring.decisions(self.at_best_threshold(scores, unit)).select(
            cut.scalar().alias("threshold"), "precision", "recall", "f1_score"
        )

    def feature_importance(self, size: int | None = 15) -> DataFrame:
        """Forest importances with readable feature names; one value per model input."""
        *_, forest = self.forest.stages
        names = list(NUMERIC)
        for column, labels in zip(CATEGORICAL, self.forest.stages[0].labelsArray, strict=True):
            names += [f"{column}_{label}" for label in labels]
        rows = list(zip(names, forest.featureImportances.toArray().tolist(), strict=True))
        spark = self.market.spark
        table = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
        return table if size is None else table.limit(size)

    def shuffle_jobs(self, repeats: int) -> DataFrame:
        """(job, order_id, number, text): for every raw column and repeat the value that is to be shuffled."""
        columns = NUMERIC + CATEGORICAL
        number = [F.col(c) if c in NUMERIC else F.lit(None).cast("double") for c in columns]
        text = [F.col(c) if c in CATEGORICAL else F.lit(None).cast("string") for c in columns]
        values = F.array(*[F.struct(n.alias("number"), t.alias("text")) for n, t in zip(number, text, strict=True)])
        each = self.prepared(self.test).select("order_id", F.posexplode(values).alias("feature", "value"))
        turns = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
        return each.withColumn("turn", turns).select((F.col("feature") * repeats + F.col("turn")).alias("job"), "order_id", "value.*")

    def _exchange(self) -> forests.Exchange:
        """Columns by their place in NUMERIC + CATEGORICAL, with their slots in the forest's inputs."""
        size, labels = len(NUMERIC), {}
        for place, known in enumerate(self.forest.stages[0].labelsArray, len(NUMERIC)):
            labels[place] = (size, list(known))
            size += len(known)
        return forests.Exchange(self.flat_forest, size, {i: i for i in range(len(NUMERIC))}, labels)

    def permutation_importance(self, repeats: int = 10) -> DataFrame:
        """Loss of average precision when one raw column is shuffled, mean and deviation.

        In every (column, repeat) job each row takes the value of the next row of one random cycle through
        all test rows; only id, job and that one value travel. The values that an order is given meet its own once, so
        equal ones and trees that cannot tell them apart are not walked again. The scores are written: the areas look at
        them several times.
        """
        columns = NUMERIC + CATEGORICAL
        given = donors(self.shuffle_jobs(repeats), "job", "order_id", ["number", "text"], self.seed + 1)
        tasks = -(-self.test.count() // TASK_ORDERS) or 1
        values = given.repartition(tasks, "order_id").groupBy("order_id").agg(F.collect_list(F.struct("job", "number", "text")).alias("given"))
        rows = self._forest_inputs().repartition(tasks, "order_id").join(values, "order_id")
        scored = written(forests.exchanged(rows, self._exchange(), repeats), "permuted_scores")
        names = F.array(*[F.lit(c) for c in columns])
        base = scoring.areas(self.forest_scores.select("label", "score")).select("pr_auc")
        drops = scoring.areas(scored, ["job"]).select(
            F.get(names, F.floor(F.col("job") / repeats).cast("int")).alias("feature"), (base.scalar() - F.col("pr_auc")).alias("drop")
        )
        return (
            drops.groupBy("feature")
            .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
            .orderBy(F.desc("importance_mean"), "feature")
        )

    def errors(self, scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        """Test rows with their outcome at the best threshold."""
        label = F.lit("Unknown")
        for (actual, predicted), name in OUTCOMES.items():
            label = F.when((F.col("label") == actual) & (F.col("predicted") == predicted), name).otherwise(label)
        decided = self.at_best_threshold(scores, unit).withColumn("prediction_result", label)
        return decided.drop("model").join(self.test.select("order_id", *NUMERIC, *CATEGORICAL), "order_id")

    def error_counts(self, scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        counts = self.errors(scores, unit).groupBy("prediction_result").agg(F.count(F.lit(1)).alias("orders_count"))
        return counts.orderBy(F.desc("orders_count"), "prediction_result")

    def error_groups(self, scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        delayed = per(F.sum(F.col("is_delayed").cast("int")), F.count("is_delayed"))
        return (
            self.errors(scores, unit)
            .groupBy("prediction_result")
            .agg(
                F.count("predicted").alias("orders_count"),
                F.avg("score").alias("average_predicted_probability"),
                mean_days(F.col("delivery_delay_days")).alias("average_delivery_delay"),
                mean_days(F.col("delivery_time_days")).alias("average_delivery_time"),
                delayed.alias("delayed_orders_share"),
                mean(F.col("items_count")).alias("average_items_count"),
                mean(F.col("order_value")).alias("average_order_value"),
            )
            .withColumn("delayed_orders_share_percent", F.col("delayed_orders_share") * 100)
        )

    def error_boxes(self, scores: DataFrame, unit: float = 1e-6) -> DataFrame:
        return box_summary(self.errors(scores, unit), ["prediction_result"], "score", unit)
