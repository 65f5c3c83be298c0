"""Model operators: splits, encoding, baseline classifiers, and their comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from threadmill.operators.relational import places, quantiles

SEED, TEST_SHARE = 42, 0.30


def seeded(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, label: str, key: str, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """df with `split`: per class, round(n * share) rows in seeded order are test, at least one and at most all but one; a single row trains."""
    n = F.col("_n")
    test = F.when(n <= 1, 0).otherwise(F.least(n - 1, F.greatest(F.lit(1), F.bround(n * share))))
    return places(df, label, seeded(key, seed), key).withColumn("split", F.when(F.col("_rank") <= test, "test").otherwise("train")).drop("_rank", "_n")


def encode(train: DataFrame, df: DataFrame, numeric: list[str]) -> DataFrame:
    """Numeric columns with nulls at the training median, centred and scaled by its population deviation (1 where that is 0)."""
    median = reduce(DataFrame.crossJoin, [quantiles(train, c, [0.5]).select(F.col("q")[0].alias(f"{c}_median")) for c in numeric])
    filled = train.crossJoin(F.broadcast(median)).select(*[F.coalesce(F.col(c), F.col(f"{c}_median")).alias(c) for c in numeric])
    moments = filled.agg(*[x for c in numeric for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))])
    stats = median.crossJoin(moments)
    scale = lambda c: F.when(F.col(f"{c}_std") <= 1e-12, 1.0).otherwise(F.col(f"{c}_std"))
    return df.crossJoin(F.broadcast(stats)).select(
        *[c for c in df.columns if c not in numeric], *[((F.coalesce(F.col(c), F.col(f"{c}_median")) - F.col(f"{c}_mean")) / scale(c)).alias(c) for c in numeric]
    )


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """0/1 columns per level, null as its own level; unseen values are all zero."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("__MISSING__"))
    return df.withColumns({f"{column}={v}": (value == v).cast("double") for v in [*levels, "__MISSING__"]})


def softmax_regression(features: list[str], label: str, weight: str | None = None, l2: float = 0.001, iterations: int = 100) -> Pipeline:
    extra = {"weightCol": weight} if weight else {}
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=features, outputCol="features"), LogisticRegression(featuresCol="features", labelCol="label_index", family="multinomial", regParam=l2, maxIter=iterations, **extra)])


def bagged_stumps(features: list[str], label: str, trees: int = 200, seed: int = SEED) -> Pipeline:
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=features, outputCol="features"), RandomForestClassifier(featuresCol="features", labelCol="label_index", maxDepth=1, numTrees=trees, maxBins=10, featureSubsetStrategy="sqrt", seed=seed)])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """df with class_weight: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return df.join(F.broadcast(counts.crossJoin(total)), label).withColumn("class_weight", F.col("_all") / (F.col("_k") * F.col("_n"))).drop("_n", "_all", "_k")


def balanced_resample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Every class as large as the largest: its rows go round in seeded order; column `copy` numbers the rounds."""
    most = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size")).agg(F.max("_size").alias("_most"))
    times = F.floor((F.col("_most") - F.col("_rank")) / F.col("_n"))
    sized = places(df, label, seeded(key), key).crossJoin(F.broadcast(most))
    return sized.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), times))).drop("_n", "_most", "_rank")


def better(df: DataFrame) -> DataFrame:
    """The best of model rows: macro F1, balanced accuracy, accuracy, name."""
    return df.orderBy(F.col("macro_f1").desc(), F.col("balanced_accuracy").desc(), F.col("accuracy").desc(), "model").limit(1)


def keeps_refinement(f1_gain: float, balanced_gain: float, recall_drop: float, tolerance: float = 0.05) -> bool:
    """Whether a refined model replaces the baseline: more F1, no less balanced accuracy, and no minority recall lost beyond the tolerance."""
    return f1_gain > 1e-12 and balanced_gain >= 0 and recall_drop <= tolerance


# Model columns by what they are about, besides those that begin with a group's prefixes.
GROUP_PREFIXES = {"trend_match": ("trend_", "match_"), "post_text": ("post_", "raw_"), "actor_account": ("actor_",), "temporal": ("post_hour_",)}
GROUP_COLUMNS = {
    "trend_match": "has_candidate has_trend_match is_ambiguous is_ambiguous_match is_matched candidate_count matched_candidate_count matched_candidate_rate same_day_trend_match".split(),
    "post_text": "has_hashtag has_url has_mention has_special_chars has_non_ascii".split(),
    "actor_account": "followers_count follows_count posts_count has_avatar has_banner display_name description".split(),
    "temporal": "post_day_of_week post_is_weekend post_month trend_post_day_diff same_day_trend_match".split(),
}


def ablation_groups(columns: list[str]) -> dict[str, list[str]]:
    """Model columns by group, sorted; a column may be in several groups or in none."""
    return {g: sorted({c for c in columns if c in GROUP_COLUMNS[g] or c.startswith(p)}) for g, p in GROUP_PREFIXES.items()}


def importances(fitted, features: list[str]) -> DataFrame:
    """(feature, class, importance) of a fitted pipeline, largest first: a forest's gain shares; a regression's mean absolute weights and, per class, its weights."""
    from pyspark.sql import SparkSession

    model, spark = fitted.stages[-1], SparkSession.getActiveSession()
    if hasattr(model, "featureImportances"):
        rows = [(f, None, float(x)) for f, x in zip(features, model.featureImportances.toArray(), strict=True)]
    else:
        weights = model.coefficientMatrix.toArray()
        labels = fitted.stages[0].labels if len(weights) > 1 else fitted.stages[0].labels[1:]
        rows = [(f, None, float(abs(weights[:, j]).mean())) for j, f in enumerate(features)]
        rows += [(f, c, float(weights[i, j])) for i, c in enumerate(labels) for j, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, class string, importance double").orderBy(F.col("class").asc_nulls_first(), F.col("importance").desc(), "feature")


def predictions(fitted, df: DataFrame, label: str, key: str, rows: int | None = None) -> DataFrame:
    """key, label, predicted class, whether it is right, and each class's probability; with `rows`, the first ones by key."""
    from pyspark.ml.functions import vector_to_array

    labels = fitted.stages[0].labels
    named = F.array(*[F.lit(x) for x in labels])
    out = fitted.transform(df).select(key, F.col(label).cast("string").alias("label"), named[F.col("prediction").cast("int")].alias("predicted"), vector_to_array("probability").alias("p"))
    out = out.select(key, "label", "predicted", (F.col("label") == F.col("predicted")).alias("is_right"), *[F.col("p")[i].alias(f"probability_{x}") for i, x in enumerate(labels)])
    return out if rows is None else out.orderBy(key).limit(rows)


def experiments(split: DataFrame, label: str, key: str, features: list[str], l2: float = 0.01, trees: int = 200) -> DataFrame:
    """Refinement experiments on a split table, a row each with its metrics on the test rows: the two baselines, class weights, stronger regularisation, fewer stumps, and a balanced resample."""
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    weighted = class_weights(train, label)
    plain = {
        "softmax": (softmax_regression(features, label), train),
        "stumps": (bagged_stumps(features, label, trees), train),
        "softmax_class_weights": (softmax_regression(features, label, "class_weight"), weighted),
        "softmax_more_l2": (softmax_regression(features, label, l2=l2), train),
        "stumps_half": (bagged_stumps(features, label, trees // 2), train),
        "stumps_balanced": (bagged_stumps(features, label, trees), balanced_resample(train, label, key)),
    }
    return scored(plain, test, label, key)


def scored(models: dict[str, tuple[Pipeline, DataFrame]], test: DataFrame, label: str, key: str) -> DataFrame:
    from threadmill.operators.quality import class_metrics

    rows = [class_metrics(predictions(p.fit(own), test, label, key), "label", "predicted").withColumn("model", F.lit(name)) for name, (p, own) in models.items()]
    return reduce(DataFrame.unionByName, rows)


def ablations(split: DataFrame, label: str, key: str, features: list[str], groups: dict[str, list[str]] | None = None, trees: int = 200) -> DataFrame:
    """A model with all features, and one without each group: metrics, and the reason where a model is left out (no such columns, or none left)."""
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    models, left_out = {"all": (bagged_stumps(features, label, trees), train)}, []
    for name, columns in (groups or ablation_groups(features)).items():
        rest = [f for f in features if f not in columns]
        if len(rest) == len(features):
            left_out.append((f"without_{name}", "no columns of this group"))
        elif not rest:
            left_out.append((f"without_{name}", "no columns left"))
        else:
            models[f"without_{name}"] = (bagged_stumps(rest, label, trees), train)
    out = scored(models, test, label, key).withColumn("skipped", F.lit(None).cast("string"))
    return out.unionByName(split.sparkSession.createDataFrame(left_out, "model string, skipped string"), allowMissingColumns=True)
