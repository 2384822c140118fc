"""Relational naive Bayes, stratified splits and evaluation reports.

Naive Bayes is written as DataFrame aggregates over the long matrix:

* training is one ``groupBy(feature, class)`` of value sums plus per-class totals;
* the model is stored sparsely: for each class a base term and a slope on the
  document's total mass, plus a correction ``delta`` only for (feature, class)
  pairs that occurred in training.  So the model is never a dense
  feature x class grid and scoring never pairs documents with classes beyond
  the k scores kept per document;
* scoring joins each document's features to the bounded delta table
  (broadcast), sums per document into a k-slot score array, and takes
  argmax / softmax / top-5 inside the row.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.features import check_bounded
from corpusflow.operators.selection import class_sizes

N_BUCKETS = 4096


def _hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def class_ranks(labels: DataFrame, class_col: str = "class_id", id_col: str = "doc_id",
                seed: int = 42) -> DataFrame:
    """Rank of each row inside its class in a seeded pseudo-random order.

    Skew-safe: the order key is ``md5(id|seed)``; its first three hex digits
    give one of 4096 buckets, a tiny (class, bucket) count table gives each
    bucket's offset, and the exact rank is the offset plus the rank inside
    the (class, bucket) group.  A class holding a third of all rows is spread
    over 4096 window partitions instead of one.
    """
    h = _hash_key(id_col, seed)
    base = labels.select(F.col(id_col).alias("doc_id"), F.col(class_col).alias("class_id"), h.alias("h"),
                         F.conv(F.substring(h, 1, 3), 16, 10).cast("int").alias("bucket"))
    per_bucket = base.groupBy("class_id", "bucket").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("class_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("class_id", "bucket",
                                F.coalesce(F.sum("c").over(w), F.lit(0)).alias("offset"),
                                F.sum("c").over(Window.partitionBy("class_id")).alias("n_c"))
    inner = Window.partitionBy("class_id", "bucket").orderBy("h", "doc_id")
    ranked = base.withColumn("r", F.row_number().over(inner))
    return ranked.join(offsets, ["class_id", "bucket"]).select(
        "doc_id", "class_id", (F.col("offset") + F.col("r")).alias("rank"), "n_c")


def split_holdout(labels: DataFrame, test_size: float = 0.2, class_col: str = "class_id",
                  id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Stratified hold-out: per class the first ``ceil(test_size * n_c)`` rows of the
    seeded order are test.  Returns ``(doc_id, class_id, is_test)``."""
    r = class_ranks(labels, class_col, id_col, seed)
    return r.select("doc_id", "class_id", (F.col("rank") <= F.ceil(F.lit(test_size) * F.col("n_c")))
                    .alias("is_test"))


def kfold_assign(labels: DataFrame, k: int = 3, class_col: str = "class_id", id_col: str = "doc_id",
                 seed: int = 42) -> DataFrame:
    """Stratified k folds: ``fold = (rank - 1) % k`` in the seeded order per class."""
    r = class_ranks(labels, class_col, id_col, seed)
    return r.select("doc_id", "class_id", ((F.col("rank") - 1) % k).cast("int").alias("fold"))


@dataclass
class NBModel:
    deltas: DataFrame     # feature, class_id, delta
    classes: DataFrame    # class_id, base, slope  (k rows)
    feature_const: DataFrame | None  # feature, c  (class-independent weight; complement NB)
    n_classes: Column     # scalar


def nb_fit(matrix: DataFrame, labels: DataFrame, alpha: float = 1.0, fit_prior: bool = True,
           complement: bool = False, n_features=None, class_col: str = "class_id",
           max_classes: int = 100_000) -> NBModel:
    """Multinomial (or complement) naive Bayes from long-table sums.

    Multinomial: ``theta_fc = ln((N_fc + a) / (N_c + a d))``, prior
    ``ln(n_c / n)`` or uniform.  Complement: weights ``-ln((T_f - N_fc + a) /
    (T - N_c + a d))``, no prior.  ``d`` is the number of features (defaults to
    the distinct features in ``matrix``).
    """
    lab = labels.select("doc_id", F.col(class_col).alias("class_id"))
    sizes = class_sizes(lab)
    check_bounded(sizes, max_classes, "class table")
    k = sizes.select(F.count(F.lit(1))).scalar()
    n = sizes.select(F.sum("n_c")).scalar()
    d = n_features if n_features is not None else matrix.select(F.countDistinct("feature")).scalar()
    # (feature, class) sums: bounded by features x classes, reused by every model
    # table and scalar below, so persisted once.
    nfc = matrix.join(lab, "doc_id").groupBy("feature", "class_id").agg(F.sum("value").alias("nfc")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    nc = nfc.groupBy("class_id").agg(F.sum("nfc").alias("mass_c"))
    cls = sizes.join(nc, "class_id", "left").select("class_id", "n_c",
                                                    F.coalesce("mass_c", F.lit(0.0)).alias("mass_c"))
    a = F.lit(float(alpha))
    if not complement:
        prior = F.log(F.col("n_c") / n) if fit_prior else -F.log(k.cast("double"))
        classes = cls.select("class_id", prior.alias("base"),
                             (F.log(a) - F.log(F.col("mass_c") + a * d)).alias("slope"))
        deltas = nfc.select("feature", "class_id", (F.log(F.col("nfc") + a) - F.log(a)).alias("delta"))
        return NBModel(deltas, classes, None, k)
    tf = nfc.groupBy("feature").agg(F.sum("nfc").alias("T_f"))
    total = tf.select(F.sum("T_f")).scalar()
    classes = cls.select("class_id", F.lit(0.0).alias("base"),
                         (F.log(total - F.col("mass_c") + a * d) - F.log(a)).alias("slope"))
    deltas = nfc.join(tf, "feature").select(
        "feature", "class_id", (F.log(F.col("T_f") + a) - F.log(F.col("T_f") - F.col("nfc") + a)).alias("delta"))
    # Class-independent part; features never seen in training weigh -ln(a),
    # which is folded into the slope, so only seen features need a row here.
    const = tf.select("feature", (F.log(a) - F.log(F.col("T_f") + a)).alias("c"))
    return NBModel(deltas, classes, const, k)


def nb_scores(model: NBModel, matrix: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc_id, scores)``: the k joint log-likelihoods per document as an array
    indexed by class_id (0..k-1).

    Documents without any feature keep their base scores (left join from
    ``docs``), so every document gets a prediction.
    """
    k = model.n_classes
    per_doc = matrix.groupBy("doc_id").agg(F.sum("value").alias("mass"))
    contrib = matrix.join(F.broadcast(model.deltas), "feature").groupBy("doc_id", "class_id").agg(
        F.sum(F.col("value") * F.col("delta")).alias("s"))
    sparse = contrib.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("class_id", "s")))
                                           .alias("m"))
    if model.feature_const is not None:
        cst = matrix.join(F.broadcast(model.feature_const), "feature").groupBy("doc_id").agg(
            F.sum(F.col("value") * F.col("c")).alias("cst"))
    cls = model.classes.select(F.sort_array(F.collect_list(F.struct("class_id", "base", "slope"))).alias("a"))
    arr = cls.scalar()
    base = docs.select("doc_id").join(per_doc, "doc_id", "left").join(sparse, "doc_id", "left")
    if model.feature_const is not None:
        base = base.join(cst, "doc_id", "left")
        shift = F.coalesce(F.col("cst"), F.lit(0.0))
    else:
        shift = F.lit(0.0)
    # The class table (k rows) rides along as a column: lambdas cannot hold subqueries.
    base = base.withColumn("__cls", arr)
    mass = F.coalesce(F.col("mass"), F.lit(0.0))
    scores = F.transform("__cls", lambda c: c["base"] + c["slope"] * mass
                         + F.coalesce(F.try_element_at(F.col("m"), c["class_id"]), F.lit(0.0)) + shift)
    return base.select("doc_id", scores.alias("scores"))


def nb_predict(model: NBModel, matrix: DataFrame, docs: DataFrame, top: int = 5) -> DataFrame:
    """``(doc_id, pred_class_id, confidence, top)``: argmax, softmax posterior of the
    winner, and the ``top`` best ``{class_id, confidence}`` (all in-row)."""
    s = nb_scores(model, matrix, docs)
    mx = F.array_max("scores")
    lse = mx + F.log(F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + F.exp(x - mx)))
    probs = F.transform("scores", lambda x, i: F.struct((F.exp(x - lse)).alias("p"), (-i).alias("neg_id")))
    ranked = F.reverse(F.array_sort(probs))
    topk = F.transform(F.slice(ranked, 1, top), lambda e: F.struct((-e["neg_id"]).alias("class_id"),
                                                                    e["p"].alias("confidence")))
    out = s.select("doc_id", topk.alias("top"))
    return out.select("doc_id", F.col("top")[0]["class_id"].alias("pred_class_id"),
                      F.col("top")[0]["confidence"].alias("confidence"), "top")


def nb_grid_cv(matrix: DataFrame, labels: DataFrame, ks: list[int], alphas: list[float], priors: list[bool] = (True, False),
               selectors: tuple[str, ...] = ("f_score", "chi2"), k_folds: int = 3) -> DataFrame:
    """Cross-validated accuracy of top-k selection -> min-max scaling -> naive Bayes for every cell of the grid.

    Selection and scaling are fit on each fold's training rows, from one table of sums per (fold, feature, class).
    A held-out document is read once for all cells: its chosen terms are shuffled as one row and summed per selector and
    bucket of ranks, the smoothing values are columns, and priors only change a constant.  Values must not be negative, so an implicit
    zero is scaled to zero unless all training rows hold the feature; that shift is a constant of each class.
    A feature with no score is not selected; a selector with fewer than k features takes them all.
    Broadcast: at most folds x selectors x max(ks) features, times the classes for their weights.
    """
    ks, n_a = sorted(ks), range(len(alphas))
    folds = kfold_assign(labels, k_folds).persist(StorageLevel.MEMORY_AND_DISK)
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(k_folds - 1)), lambda j: j != F.col("fold"))).alias("j")
    sizes = folds.select(others, "class_id").groupBy("j", "class_id").agg(F.count(F.lit(1)).alias("n_c"))
    sizes = sizes.join(sizes.groupBy("j").agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("n_k")), "j")
    sizes = F.broadcast(sizes.persist(StorageLevel.MEMORY_AND_DISK))
    held = matrix.join(folds.select("doc_id", "class_id", F.col("fold")), "doc_id")
    v = F.col("value")
    own = held.groupBy("fold", "feature", "class_id").agg(
        F.count(F.lit(1)).alias("a"), F.sum(v).alias("s1"), F.sum(v * v).alias("s2"), F.min(v).alias("mn"), F.max(v).alias("mx"))
    sums = (own.select(others, "*").groupBy("j", "feature", "class_id").agg(
        *[F.sum(c).alias(c) for c in ("a", "s1", "s2")], F.min("mn").alias("mn"), F.max("mx").alias("mx"))
        .join(sizes, ["j", "class_id"]).persist(StorageLevel.MEMORY_AND_DISK))
    per_f = sums.groupBy("j", "feature").agg(
        *[F.sum(c).alias(c) for c in ("a", "s1", "s2")], F.min("mn").alias("mn"), F.max("mx").alias("mx"),
        F.first("n").alias("n"), F.first("n_k").alias("n_k"), F.sum(F.col("s1") * F.col("s1") / F.col("n_c")).alias("q"))
    between = F.col("q") - F.col("s1") * F.col("s1") / F.col("n")
    within = (F.col("s2") - F.col("q")) / (F.col("n") - F.col("n_k"))
    scores = {"f_score": F.when(within > 0, between / (F.col("n_k") - 1) / within),
              "chi2": F.when(F.col("s1") > 0, F.col("q") * F.col("n") / F.col("s1") - F.col("s1"))}
    full = F.col("a") == F.col("n")
    low, high = F.when(full, F.col("mn")).otherwise(F.lit(0.0)), F.when(full, F.col("mx")).otherwise(F.greatest("mx", F.lit(0.0)))
    scored = per_f.select("j", "feature", low.alias("low"), F.when(high > low, 1 / (high - low)).otherwise(F.lit(1.0)).alias("inv"),
                          F.explode(F.array(*[F.struct(F.lit(s).alias("selector"), scores[s].alias("score")) for s in selectors])).alias("s"))
    best_first = Window.partitionBy("j", "selector").orderBy(F.desc("score"), "feature")
    chosen = (scored.select("j", "feature", "low", "inv", "s.selector", "s.score").filter(F.col("score").isNotNull())
              .withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= ks[-1])
              .select("j", "selector", "feature", "low", "inv",
                      F.array_min(F.filter(F.array(*map(F.lit, ks)), lambda k: k >= F.col("rank"))).alias("bucket"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    known = chosen.select("j", "feature", "low", "inv").distinct()
    nfc = F.greatest((F.col("s1") - F.col("n_c") * F.col("low")) * F.col("inv"), F.lit(0.0))
    weights = (sums.join(F.broadcast(known), ["j", "feature"]).select("j", "feature", "class_id", nfc.alias("nfc"))
               .select("*", *[(F.log(F.col("nfc") + a) - math.log(a)).alias(f"d{i}") for i, a in enumerate(alphas)])
               .persist(StorageLevel.MEMORY_AND_DISK))
    upto = F.explode(F.filter(F.array(*map(F.lit, ks)), lambda k: k >= F.col("bucket"))).alias("k")
    cell = chosen.select("j", "selector", upto, "feature", (F.col("low") * F.col("inv")).alias("shift"))
    totals = cell.groupBy("j", "selector", "k").agg(F.count(F.lit(1)).alias("d"), F.sum("shift").alias("shift"))
    by_class = cell.join(weights, ["j", "feature"]).groupBy("j", "selector", "k", "class_id").agg(
        F.sum("nfc").alias("mass"), *[F.sum(F.col("shift") * F.col(f"d{i}")).alias(f"c{i}") for i in n_a])
    cells = (totals.join(sizes, "j").join(by_class, ["j", "selector", "k", "class_id"], "left")
             .fillna(0.0, ["mass", *[f"c{i}" for i in n_a]]))
    # One shuffle, by doc_id, of one row per document; all that follows groups by doc_id and more, so it stays where it is.
    index = F.broadcast(chosen.select("feature").distinct().select("feature", F.row_number().over(Window.orderBy("feature")).alias("i")))
    entries = matrix.join(index, "feature").groupBy("doc_id").agg(F.collect_list(F.struct("i", v.cast("double").alias("v"))).alias("e"))
    owners = (folds.groupBy("doc_id", F.col("fold").alias("j"), F.col("class_id").alias("true_c")).agg(F.count(F.lit(1)).alias("n"))
              .groupBy("doc_id").agg(F.collect_list(F.struct("j", "true_c", "n")).alias("owners")))
    # Entry 0, of value 0, is in every document, so that one without terms is scored too; class -1 adds up the x itself.
    none = F.array(F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("v")))
    held_out = (owners.join(entries, "doc_id", "left").select("doc_id", "owners", F.explode("owners").alias("o"), "e")
                .select("doc_id", "owners", "o.j", "o.n", F.explode(F.concat(F.coalesce("e", F.array().cast("array<struct<i:int,v:double>>")), none)).alias("e"))
                .select("doc_id", "owners", "j", "e.i", (F.col("e.v") * F.col("n")).alias("v")))
    ranks = chosen.join(index, "feature").select("j", "i", "selector", "bucket", "inv").unionByName(
        chosen.select("j", F.lit(0).alias("i"), "selector", F.lit(ks[0]).alias("bucket"), F.lit(1.0).alias("inv")).distinct())
    total = [F.lit(-1).cast("long").alias("class_id"), *[F.lit(float(i == 0)).alias(f"d{i}") for i in n_a]]
    found = weights.join(index, "feature").select("j", "i", "class_id", *[f"d{i}" for i in n_a])
    found = found.unionByName(ranks.select("j", "i").distinct().select("j", "i", *total))
    per = F.col("v") * F.col("inv")
    terms = (held_out.join(F.broadcast(ranks.join(found, ["j", "i"])), ["j", "i"]).groupBy("doc_id", "owners", "selector", "bucket", "class_id")
             .agg(*[F.sum(per * F.col(f"d{i}")).alias(f"s{i}") for i in n_a])
             .select("doc_id", "owners", "selector", upto, "class_id", *[f"s{i}" for i in n_a])
             .groupBy("doc_id", "owners", "selector", "k", "class_id").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in n_a])
             .groupBy("doc_id", "owners", "selector", "k").agg(F.map_from_entries(F.collect_list(F.struct("class_id", F.struct(*[f"s{i}" for i in n_a])))).alias("m")))
    rows = (terms.select("doc_id", "selector", "k", "m", F.explode("owners").alias("o")).select("doc_id", "selector", "k", "m", "o.j", "o.true_c")
            .join(F.broadcast(cells), ["j", "selector", "k"])
            .withColumn("own", F.try_element_at("m", F.col("class_id").cast("long")))
            .select("doc_id", "j", "true_c", "selector", "k", "class_id", "n_c", "n", "n_k", "mass", "d", "shift", *[f"c{i}" for i in n_a],
                    F.try_element_at("m", F.lit(-1).cast("long"))["s0"].alias("x"), *[F.coalesce(F.col("own")[f"s{i}"], F.lit(0.0)).alias(f"s{i}") for i in n_a]))

    def score(i: int, prior: bool) -> Column:
        base = F.log(F.col("n_c") / F.col("n")) if prior else -F.log(F.col("n_k"))
        slope = math.log(alphas[i]) - F.log(F.col("mass") + alphas[i] * F.col("d"))
        # Rounded, so that equal scores stay equal whatever the order of the sums; ties go to the lowest class.
        return F.round(base + (F.col("x") - F.col("shift")) * slope + F.col(f"s{i}") - F.col(f"c{i}"), 9)

    grid = [(i, p) for i in n_a for p in priors]
    best = rows.groupBy("doc_id", "j", "true_c", "selector", "k").agg(
        *[F.max_by("class_id", F.struct(score(i, p), -F.col("class_id"))).alias(f"p{g}") for g, (i, p) in enumerate(grid)])
    acc = best.groupBy("selector", "k", "j").agg(
        *[F.avg((F.col(f"p{g}") == F.col("true_c")).cast("double")).alias(f"p{g}") for g in range(len(grid))])
    each = F.explode(F.array(*[F.struct(F.lit(float(alphas[i])).alias("alpha"), F.lit(p).alias("fit_prior"), F.col(f"p{g}").alias("acc"))
                               for g, (i, p) in enumerate(grid)])).alias("g")
    return acc.select("selector", "k", each).groupBy("selector", "k", "g.alpha", "g.fit_prior").agg(
        F.round(F.avg("g.acc"), 6).alias("cv_accuracy"), F.round(F.stddev_pop("g.acc"), 6).alias("cv_std"))


def confusion_matrix(pred: DataFrame, label_col: str = "class_id", pred_col: str = "pred_class_id") -> DataFrame:
    return pred.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(pred: DataFrame, label_col: str = "class_id",
                          pred_col: str = "pred_class_id") -> DataFrame:
    """Precision, recall, F1, support per class, plus accuracy, macro and weighted rows
    (zero division -> 0).  Everything derives from the confusion matrix (k x k
    rows), which is computed in one pass and cached."""
    cm = confusion_matrix(pred, label_col, pred_col).persist(StorageLevel.MEMORY_AND_DISK)
    stats = cm.select(
        F.explode(F.array(
            F.struct(F.col("label").alias("c"), F.when(F.col("label") == F.col("predicted"), F.col("n"))
                     .otherwise(F.lit(0)).alias("tp"), F.col("n").alias("support"), F.lit(0).alias("pn")),
            F.struct(F.col("predicted").alias("c"), F.lit(0).alias("tp"), F.lit(0).alias("support"),
                     F.col("n").alias("pn")))).alias("s")).select("s.*")
    per = stats.groupBy("c").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                 F.sum("pn").alias("predicted_n"))
    per = per.select(F.col("c").cast("string").alias("class"), "tp", "support", "predicted_n")
    prec = F.when(F.col("predicted_n") > 0, F.col("tp") / F.col("predicted_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select("class", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.select("class", "precision", "recall", f1.alias("f1"), F.col("support").cast("long").alias("support"),
                     "tp")
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), (F.col("tp") / F.col("n")).alias("precision"),
                 (F.col("tp") / F.col("n")).alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("n")).alias("precision"),
                 (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                 F.col("n").alias("support")))).alias("s")).select("s.*")
    out = per.drop("tp").unionByName(summary)
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def accuracy(pred: DataFrame, label_col: str = "class_id", pred_col: str = "pred_class_id") -> Column:
    return F.avg((F.col(label_col) == F.col(pred_col)).cast("double"))
