"""Feature matrices, stratified split, class weights and Spark ML
detectors (P7-P9, M1-M8, M13, M14, A18, S7).

Training uses Spark ML's distributed tree learners; the feature order is
carried by the ``VectorAssembler`` stage of the saved ``PipelineModel``.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add, or_

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.operators.evaluation import zero_fill
from pktscope.operators.scoring import add_prediction_labels
from pktscope.session import Scratch, path_exists

FEATURES_COL = "features"
WEIGHT_COL = "class_weight"
SPLIT_COL = "split"
FOLD_COL = "fold"


# --- P7-P9 --------------------------------------------------------------------

def select_features(df: DataFrame, feature_list: list[str]) -> list[str]:
    """The ordered features that are present (plan-time check)."""
    return [c for c in feature_list if c in df.columns]


def feature_matrix(df: DataFrame, feature_list: list[str], keep: list[str] | None = None) -> DataFrame:
    """Present features in order, zero-filled, plus ``keep``
    columns (keys, label)."""
    feats = select_features(df, feature_list)
    keep = [c for c in (keep or []) if c in df.columns and c not in feats]
    return zero_fill(df.select(*keep, *feats), feats)


# --- M1: stratified split -------------------------------------------------------

def _class_allocation(counts: DataFrame, label_col: str, test_size: float) -> DataFrame:
    """Per class: rows ``c`` and test rows ``t``.  ``ceil(test_size * n)``
    test rows overall; train rows per class by largest remainder of
    ``c * n_train / n`` (ties to the smaller label), the rest is test.
    Fails (at execution) like the reference when a class has fewer than two
    rows.  ``counts`` has one row per class, so its window is bounded."""
    allw = Window.partitionBy()  # bounded: one row per class
    n = F.sum("c").over(allw)
    n_test = F.ceil(F.lit(float(test_size)) * n)
    cont = (F.col("c") / n) * (n - n_test)  # same operation order as the reference
    a = counts.withColumns({"n": n, "n_test": n_test, "cont": cont, "base": F.floor(cont)})
    a = a.withColumn("need", (F.col("n") - F.col("n_test")) - F.sum("base").over(allw))
    a = a.withColumn("rem_rank", F.row_number().over(
        Window.partitionBy().orderBy(F.desc(F.col("cont") - F.col("base")), F.col(label_col))))
    train = F.col("base") + F.when(F.col("rem_rank") <= F.col("need"), 1).otherwise(0)
    guard = F.when(F.min("c").over(allw) < 2, F.raise_error(F.lit(
        "The least populated class has fewer than 2 members; stratified split impossible")))
    return a.select(label_col, "c", (F.col("c") - train + F.coalesce(guard.cast("bigint"), F.lit(0))).alias("t"))


#: Rows of a hash range that are ranked by a sort; larger ranges are cut again.
RANKED_ROWS = 100_000


def order_statistics(rows: DataFrame, label_col: str, targets: DataFrame, bits: int = 16,
                     ranked_rows: int = RANKED_ROWS) -> list:
    """For every row of ``targets`` (label, which, rank) the ``rank``-th (from
    1) smallest ``_order`` of that label: rows with label, which, order, and
    ``equal``, how many rows have that order, and ``taken``, how many of those
    are among the ``rank`` smallest.  Ranks of 0 are left out.

    ``_order`` is a struct that begins with a hash ``h``.  Histogram refinement:
    rows are counted by label and the first ``bits`` of the hash, which says in
    which range a rank lies; the ranges that hold a rank (one per target) are
    counted by the next bits, until they have at most ``ranked_rows`` rows.  Only
    those rows are sorted.  A step sends at most targets x 2^bits counts.
    """
    left = targets.filter("rank > 0").select(label_col, "which", "rank", F.lit(0).cast("long").alias("p"))
    within, used = rows, 0
    with Scratch(rows.sparkSession, "order-statistics") as scratch:
        while True:
            width = min(bits, 64 - used)
            used += width
            counts = within.groupBy(F.col(label_col), F.shiftright("_order.h", 64 - used).alias("q")).agg(
                F.count(F.lit(1)).alias("c"))
            parent = F.shiftright("q", width) if used > width else F.lit(0).cast("long")
            before = F.sum("c").over(Window.partitionBy(label_col, "p").orderBy("q")) - F.col("c")  # <= 2^bits rows
            ranges = counts.withColumn("p", parent).withColumn("before", before)
            left = scratch.land(left.join(ranges, [label_col, "p"]).filter(
                (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("c"))).select(
                label_col, "which", (F.col("rank") - F.col("before")).alias("rank"), F.col("q").alias("p"), "c"),
                f"ranges-{used}")
            most = left.agg(F.max("c")).first()[0] or 0
            left = left.drop("c")
            found = left.select(label_col, F.col("p").alias("_p")).distinct()  # a row per target at most
            within = rows.join(F.broadcast(found), label_col).filter(
                F.shiftright("_order.h", 64 - used) == F.col("_p")).drop("_p")
            if most <= ranked_rows or used >= 64:
                break
        same = within.groupBy(label_col, F.shiftright("_order.h", 64 - used).alias("p"), F.col("_order").alias("order")).agg(
            F.count(F.lit(1)).alias("equal"))
        below = F.sum("equal").over(Window.partitionBy(label_col, "p").orderBy("order")) - F.col("equal")
        at = same.withColumn("below", below).join(left, [label_col, "p"]).filter(
            (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("equal")))
        return at.select(label_col, "which", "order", "equal",
                         (F.col("rank") - F.col("below")).alias("taken")).collect()  # a row per target


def _literal(value, kind) -> Column:
    """A value of a collected row as a constant of type ``kind``."""
    if hasattr(kind, "fields") and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
    return F.lit(value).cast(kind)


def stratified_split(df: DataFrame, key_cols: list[str], label_col: str = S.LABEL,
                     test_size: float = 0.2, seed: int = 42, folds: int = 0, bits: int = 16,
                     ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """M1: adds ``split`` ('train' / 'test') with exactly the per-class test
    counts of a stratified split; with ``folds > 0`` also ``fold`` (0 ..
    folds-1), whose sizes differ by one at most within a class.

    Rows are ordered at random, by ``xxhash64(seed, key)`` and then the key.  A
    class's test rows are those up to its t-th row in that order, and its folds are
    consecutive ranges of it.  The rows at those places are found by
    ``order_statistics``; then each row is labelled by comparing its own order with
    them, so no row is shuffled or sorted.  ``key_cols`` should identify a row; rows
    of one key on a limit are told apart by their place in the input.

    ``df`` is read three times here (counts, the ranges around the limits, and by
    the result): pass a landed table when making it costs more than reading it.
    """
    order = F.struct(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]).alias("h"),
                     *[F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)])
    rows = df.filter(F.col(label_col).isNotNull()).select(label_col, order.alias("_order"))
    classes = _class_allocation(rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("c")), label_col, test_size).collect()
    cuts = [(r[label_col], "test", r["t"]) for r in classes]
    cuts += [(r[label_col], str(k), (k + 1) * (r["c"] // folds) + min(k + 1, r["c"] % folds))
             for r in classes for k in range(folds - 1)]
    spark = df.sparkSession
    targets = spark.createDataFrame(cuts, f"`{label_col}` {df.schema[label_col].dataType.simpleString()}, which string, rank long")
    limits = order_statistics(rows, label_col, targets, bits, ranked_rows)
    held = df.filter(F.col(label_col).isNotNull()).withColumn("_order", order)
    label, mine = F.col(label_col), F.col("_order")
    kinds = rows.schema
    limit = {id(r): _literal(r["order"], kinds["_order"].dataType) for r in limits}
    of_label = lambda r: label == _literal(r[label_col], kinds[label_col].dataType)
    divided = [r for r in limits if r["taken"] < r["equal"]]
    if divided:  # rows of one key on both sides of a limit
        ties = reduce(or_, [of_label(r) & (mine == limit[id(r)]) for r in divided])
        place = F.row_number().over(Window.partitionBy(label_col, "_order").orderBy(F.monotonically_increasing_id()))
        held = (held.filter(~ties).withColumn("_place", F.lit(0))
                .unionByName(held.filter(ties).withColumn("_place", place)))

    def within(which: str) -> Column:
        tests = []
        for r in limits:
            if r["which"] == which:
                first = mine <= limit[id(r)]
                if r in divided:
                    first = (mine < limit[id(r)]) | ((mine == limit[id(r)]) & (F.col("_place") <= r["taken"]))
                tests.append(of_label(r) & first)
        return reduce(or_, tests, F.lit(False))

    out = held.withColumn(SPLIT_COL, F.when(within("test"), "test").otherwise("train"))
    if folds:
        out = out.withColumn(FOLD_COL, reduce(add, [(~within(str(k))).cast("int") for k in range(folds - 1)], F.lit(0)))
    return out.drop("_order", "_place")


def balance_metrics(label_col: str = S.LABEL) -> dict[str, Column]:
    """A18 as metrics of a write: rows and labelled rows of each split."""
    test = F.col(SPLIT_COL) == "test"
    return {"test": F.count_if(test), "train": F.count_if(~test),
            "test_sum": F.sum(F.when(test, F.col(label_col))), "train_sum": F.sum(F.when(~test, F.col(label_col)))}


def balance_of(spark: SparkSession, seen: dict) -> DataFrame:
    """The table of A18 from ``balance_metrics`` of a finished write."""
    rows = [(split, seen[split], float(seen[f"{split}_sum"]) / seen[split])
            for split in ("train", "test") if seen.get(split)]
    return spark.createDataFrame(rows, f"{SPLIT_COL} string, rows long, attack_ratio double")


def split_balance(split_df: DataFrame, label_col: str = S.LABEL) -> DataFrame:
    """Rows and attack ratio per split."""
    return split_df.groupBy(SPLIT_COL).agg(F.count(F.lit(1)).alias("rows"),
                                           F.avg(label_col).alias("attack_ratio"))


# --- M5: class weights ----------------------------------------------------------

def class_weights(df: DataFrame, label_col: str = S.LABEL) -> DataFrame:
    """Per class: n / (k * n_class) ('balanced')."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_class"))
    allw = Window.partitionBy()  # bounded: one row per class
    return counts.select(label_col, "n_class",
                         (F.sum("n_class").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("n_class")))
                         .alias(WEIGHT_COL))


def with_class_weights(df: DataFrame, label_col: str = S.LABEL) -> DataFrame:
    w = class_weights(df, label_col).select(label_col, WEIGHT_COL)
    return df.join(F.broadcast(w), label_col)  # one row per class


# --- M2-M4, M6 (default hyperparameters are fixed values of the detectors) -------------------------------------------------------------------

def random_forest(n_estimators: int = 100, max_depth: int = 10, min_samples_leaf: int = 2,
                  seed: int = 42, balanced: bool = True, max_bins: int = 128) -> RandomForestClassifier:
    """M2 (network defaults) / M3 (``min_samples_leaf=1``).  Spark has no
    minimum-split-size; ``maxBins`` is raised to approach exact splits."""
    # cacheNodeIds + checkpointInterval: deep trees on large data keep node
    # assignments cached and cut their lineage every 10 levels (into the
    # shared checkpoint folder).
    rf = RandomForestClassifier(featuresCol=FEATURES_COL, labelCol=S.LABEL, numTrees=n_estimators,
                                maxDepth=max_depth, minInstancesPerNode=min_samples_leaf, seed=seed,
                                maxBins=max_bins, cacheNodeIds=True, checkpointInterval=10)
    return rf.setWeightCol(WEIGHT_COL) if balanced else rf


def boosted_trees(n_estimators: int = 100, max_depth: int = 6, learning_rate: float = 0.1,
                  seed: int = 42, max_bins: int = 128, scale_pos_weight: float = 1.0) -> GBTClassifier:
    """M4: gradient-boosted trees.  ``scale_pos_weight`` multiplies the
    weight of attack rows (``train_model`` adds the weight column)."""
    gbt = GBTClassifier(featuresCol=FEATURES_COL, labelCol=S.LABEL, maxIter=n_estimators,
                        maxDepth=max_depth, stepSize=learning_rate, seed=seed, maxBins=max_bins,
                        cacheNodeIds=True, checkpointInterval=10)
    return gbt if scale_pos_weight == 1 else gbt.setWeightCol(WEIGHT_COL)


def make_estimator(model_type: str = "random_forest", **params):
    if model_type == "random_forest":
        return random_forest(**params)
    if model_type in ("gbt", "xgboost"):
        return boosted_trees(**params)
    raise ValueError(f"no estimator is called {model_type!r}")


def _bare(spark: SparkSession, model):
    """A fitted model without its training summary: that holds the session, which
    can not be sent to tasks along with the model once the session has observed a
    write (``session.observed``)."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(spark._jvm.scala.Option.apply(None))
    return model


def train_model(train: DataFrame, features: list[str], model_type: str = "random_forest",
                **params) -> PipelineModel:
    """M6: assemble the ordered features and fit.  Class weights are joined
    when the estimator uses them."""
    est = make_estimator(model_type, **params)
    data = train
    if est.hasParam("weightCol") and est.isSet("weightCol"):
        weight = params.get("scale_pos_weight")
        data = with_class_weights(train) if weight is None else train.withColumn(
            WEIGHT_COL, F.when(F.col(S.LABEL) == 1, float(weight)).otherwise(1.0))
    assembler = VectorAssembler(inputCols=features, outputCol=FEATURES_COL)
    fitted = Pipeline(stages=[assembler, est]).fit(data)
    _bare(train.sparkSession, fitted.stages[-1])
    return fitted


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


# --- M13 / M14 --------------------------------------------------------------------

def score(model: PipelineModel, df: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Predict, P(class 1), text label.  Missing features count as 0 for the
    model only: every input column comes through as it was (an earlier
    prediction in the input is replaced)."""
    made = {FEATURES_COL, "rawPrediction", "probability", "prediction", "attack_probability", "prediction_label"}
    columns = [c for c in df.columns if c not in made]
    feats = [c for c in model_features(model) if c in columns]
    kept = {f: f"_input_{i}" for i, f in enumerate(feats)}
    held = df.select(*columns).withColumns({k: F.col(f) for f, k in kept.items()})
    scored = model.transform(zero_fill(held, feats))
    scored = scored.select(*[F.col(kept.get(c, c)).alias(c) for c in columns],
                           F.col("prediction").cast("int").alias("prediction"),
                           vector_to_array(F.col("probability"))[1].alias("attack_probability"))
    return add_prediction_labels(scored, names)


# --- M7: cross-validation ----------------------------------------------------------

def f1_of(scored: DataFrame, label_col: str = S.LABEL) -> DataFrame:
    y, p = F.col(label_col), F.col("prediction")
    agg = scored.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                     F.count_if((y == 0) & (p == 1)).alias("fp"),
                     F.count_if((y == 1) & (p == 0)).alias("fn"))
    return agg.select(F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                                 F.lit(0.0)).alias("f1"))


def assign_folds(data: DataFrame, key_cols: list[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """``data`` with ``fold`` (0 .. folds-1), of even sizes within each class."""
    return stratified_split(data, key_cols, test_size=0.5, seed=seed, folds=folds).drop(SPLIT_COL)


def _fold_weights(assigned: DataFrame, folds: int, label_col: str, scale_pos_weight: float | None) -> list[Column]:
    """The class-weight column of each fold's training rows, as constants per
    class: the weights come from one count by fold and class."""
    if scale_pos_weight is not None:
        return [F.when(F.col(label_col) == 1, float(scale_pos_weight)).otherwise(1.0)] * folds
    counts = {(r[FOLD_COL], r[label_col]): r["count"] for r in assigned.groupBy(FOLD_COL, label_col).count().collect()}
    labels = sorted({label for _, label in counts})
    out = []
    for k in range(folds):
        per = {label: sum(c for (f, of), c in counts.items() if f != k and of == label) for label in labels}
        present = [label for label in labels if per[label]]
        n = sum(per.values())
        weight = F.lit(1.0)
        for label in present:
            weight = F.when(F.col(label_col) == label, n / (len(present) * per[label])).otherwise(weight)
        out.append(weight)
    return out


def cross_validate(data: DataFrame, features: list[str], key_cols: list[str], folds: int = 5,
                   model_type: str = "random_forest", seed: int = 42, parallelism: int | None = None,
                   label_col: str = S.LABEL, landed: bool = False, **params) -> DataFrame:
    """M7: stratified ``folds``-fold CV, F1 of class 1 per fold, plus
    mean and population std rows.

    The narrow table is written once (not if ``landed``: ``data`` then reads a
    written table already), and once more with its folds and assembled vectors, which
    all fits read.  The folds are fitted and scored at the same time
    (``parallelism`` of them; all by default): a fit is a row of jobs with a wait
    after each, which the jobs of the others fill.
    """
    spark = data.sparkSession
    parallelism = max(1, min(folds, parallelism or folds))
    estimator = make_estimator(model_type, **params)
    weighted = estimator.hasParam("weightCol") and estimator.isSet("weightCol")
    assembler = VectorAssembler(inputCols=features, outputCol=FEATURES_COL)
    with Scratch(spark, "folds") as scratch:
        narrow = data.select(*dict.fromkeys([*key_cols, *features, label_col]))
        narrow = narrow if landed else scratch.land(narrow, "input")
        assigned = scratch.land(assembler.transform(assign_folds(narrow, key_cols, folds, seed)).select(
            label_col, FOLD_COL, FEATURES_COL), "folds")
        weights = _fold_weights(assigned, folds, label_col, params.get("scale_pos_weight")) if weighted else None

        def fold_f1(k: int) -> float:
            train = assigned.where(F.col(FOLD_COL) != k)
            own = make_estimator(model_type, **params)  # a JVM object of its own: threads fit at the same time
            model = _bare(spark, own.fit(train.withColumn(WEIGHT_COL, weights[k]) if weighted else train))
            scored = model.transform(assigned.where(F.col(FOLD_COL) == k))
            return f1_of(scored, label_col).first()[0]  # one scalar per fold (a model-sized result)

        with ThreadPool(parallelism) as pool:
            scores = pool.map(inheritable_thread_target(spark)(fold_f1), range(folds))
    per_fold = spark.createDataFrame([(str(k), float(v)) for k, v in enumerate(scores)], "fold string, f1 double")
    summary = per_fold.agg(F.avg("f1").alias("m"), F.stddev_pop("f1").alias("s"))
    return per_fold.unionByName(summary.select(F.lit("mean").alias("fold"), F.col("m").alias("f1"))).unionByName(
        summary.select(F.lit("std").alias("fold"), F.col("s").alias("f1")))


# --- M8 / S7 --------------------------------------------------------------------------

def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """M8: (feature, importance) sorted by importance (a model-sized table)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(model_features(model), [float(v) for v in imp]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str, model_type: str | None = None) -> None:
    """The pipeline (assembler with the feature order + estimator); with
    ``model_type`` (e.g. 'sqli_detector') also that tag, as a small table
    beside the stages."""
    model.write().overwrite().save(path)
    if model_type:
        spark = SparkSession.active()
        spark.createDataFrame([(model_type, ",".join(model_features(model)))],
                              "model_type string, features string").coalesce(1).write.json(f"{path}/tag")


def model_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a saved detector as a table, a row per node of every tree:
    tree, weight, node (0 is the root), feature and threshold (a value up to it
    goes to ``left``, others to ``right``; NULL in a leaf), prediction, class_0 and
    class_1 (the node's weighted training rows) and gain.  Any SQL engine
    can score with it."""
    features = model_features(load_model(path))
    stages = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
    found = stages.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(stages)
    last = max((f.getPath().toString() for f in found), key=lambda p: int(p.rsplit("/", 1)[1].split("_")[0]))
    nodes = spark.read.parquet(f"{last}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{last}/treesMetadata").toDF("treeID", "metadata", "weights")
    split = F.col("split")
    inner = split["featureIndex"] >= 0
    names = F.array(*[F.lit(f) for f in features])
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"), F.col("weights").alias("weight"), F.col("id").alias("node"),
        F.when(inner, F.get(names, split["featureIndex"])).alias("feature"),
        F.when(inner, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", F.get("impurityStats", F.lit(0)).alias("class_0"), F.get("impurityStats", F.lit(1)).alias("class_1"),
        F.when(inner, F.col("gain")).alias("gain"))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_type_of(spark: SparkSession, path: str) -> str | None:
    """The tag a model was saved with."""
    if not path_exists(spark, f"{path}/tag"):
        return None
    return spark.read.json(f"{path}/tag").first()["model_type"]
