"""Association rules: pair rules (R2, P13, W1, O4, O6), itemsets (R3, R4) and
itemset rules (R5), plus the per-level run summary (K3).

Pair rules come from the co-occurrence of each *unordered* pair, counted once.
Both directions of a pair share support and (up to rounding) lift; they differ
in confidence. The reference filters directed rules and then keeps, per
unordered pair, the direction with the highest confidence (then lift, then
support, then the one enumerated first, i.e. the smaller antecedent). With one
row per pair that is a per-row choice, so no window and no extra shuffle is
needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered, stored
from shopseg.functions.scalar import itemset_text, pair_key
from shopseg.operators.basket import Basket, checked_broadcast, cooccurrence
from shopseg.session import cut_lineage

#: Candidates counted in one pass over the baskets, and places (items x users) of a task's table of who holds what.
SCAN, HELD = 200_000, 1 << 26

RULE_COLUMNS = ["level", "antecedent", "consequent", "support", "confidence", "lift"]


def _pair_metrics(bk: Basket) -> DataFrame:
    """One row per co-occurring kept pair with both directions' metrics."""
    co = cooccurrence(bk.basket, bk.kept_sizes)
    total = sum(bk.kept_sizes.values())
    k = bk.kept.select("level", "idx", "item", "user_count")
    ka = checked_broadcast(k.select("level", F.col("idx").alias("a"), F.col("item").alias("item_a"),
                                    F.col("user_count").alias("n_a")), total)
    kb = checked_broadcast(k.select("level", F.col("idx").alias("b"), F.col("item").alias("item_b"),
                                    F.col("user_count").alias("n_b")), total)
    bu = F.broadcast(bk.basket_users)  # one row per level
    u = F.col("U").cast("double")
    return (co.join(ka, ["level", "a"]).join(kb, ["level", "b"]).join(bu, "level")
            .select("level", "item_a", "item_b", "co", "n_a", "n_b", "U",
                    (F.col("co") / u).alias("support"),
                    (F.col("co") / F.col("n_a")).alias("conf_ab"),
                    (F.col("co") / F.col("n_b")).alias("conf_ba"))
            .withColumn("lift_ab", F.col("conf_ab") / (F.col("n_b") / u))
            .withColumn("lift_ba", F.col("conf_ba") / (F.col("n_a") / u)))


def _with_thresholds(pm: DataFrame, params: DataFrame) -> DataFrame:
    p = F.broadcast(params.select("level", "min_conf", "min_lift"))
    return pm.join(p, "level")


def directed_rules(bk: Basket, params: DataFrame) -> DataFrame:
    """Every directed rule passing ``confidence >= c AND lift >= l`` (before dedupe)."""
    pm = _with_thresholds(_pair_metrics(bk), params)
    both = F.array(
        F.struct(F.col("item_a").alias("antecedent"), F.col("item_b").alias("consequent"),
                 F.col("conf_ab").alias("confidence"), F.col("lift_ab").alias("lift")),
        F.struct(F.col("item_b").alias("antecedent"), F.col("item_a").alias("consequent"),
                 F.col("conf_ba").alias("confidence"), F.col("lift_ba").alias("lift")))
    return (pm.select("level", "support", "min_conf", "min_lift", F.inline(both))
              .where((F.col("confidence") >= F.col("min_conf")) & (F.col("lift") >= F.col("min_lift")))
              .select(*RULE_COLUMNS))


def pair_rules(bk: Basket, params: DataFrame) -> DataFrame:
    """R2 + W1: filtered rules, one direction kept per unordered pair."""
    pm = _with_thresholds(_pair_metrics(bk), params)
    pass_ab = (F.col("conf_ab") >= F.col("min_conf")) & (F.col("lift_ab") >= F.col("min_lift"))
    pass_ba = (F.col("conf_ba") >= F.col("min_conf")) & (F.col("lift_ba") >= F.col("min_lift"))
    # b->a wins only if a->b fails, or both pass and b->a ranks strictly higher
    ba_higher = ((F.col("conf_ba") > F.col("conf_ab"))
                 | ((F.col("conf_ba") == F.col("conf_ab")) & (F.col("lift_ba") > F.col("lift_ab"))))
    take_ba = pass_ba & (~pass_ab | ba_higher)
    return (pm.where(pass_ab | pass_ba)
              .select("level",
                      F.when(take_ba, F.col("item_b")).otherwise(F.col("item_a")).alias("antecedent"),
                      F.when(take_ba, F.col("item_a")).otherwise(F.col("item_b")).alias("consequent"),
                      "support",
                      F.when(take_ba, F.col("conf_ba")).otherwise(F.col("conf_ab")).alias("confidence"),
                      F.when(take_ba, F.col("lift_ba")).otherwise(F.col("lift_ab")).alias("lift")))


def top_rules(rules: DataFrame, n: int = 200, order: str = "lift") -> DataFrame:
    """The first ``n`` rules per level.

    ``order="lift"``: lift, confidence, support descending (pair text breaks
    ties). ``order="pair"``: the reference's literal file order after dedupe,
    i.e. by unordered pair key.
    """
    key = pair_key(F.col("antecedent"), F.col("consequent"))
    lo, hi = key["lo"], key["hi"]
    if order == "pair":
        keys = [lo.asc(), hi.asc(), F.desc("confidence"), F.desc("lift"), F.desc("support")]
    else:
        keys = [F.desc("lift"), F.desc("confidence"), F.desc("support"), lo.asc(), hi.asc(),
                F.asc("antecedent")]
    w = Window.partitionBy("level").orderBy(*keys)
    return (rules.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))


def run_summary(levels: DataFrame, bk: Basket, rules: DataFrame) -> DataFrame:
    """K3: ``level, n_users, n_items, n_rules, mode``; levels without rules stay (0).

    ``rules`` needs only a ``level`` column (one row per rule, any mode).
    """
    n_items = bk.kept.groupBy("level").agg(F.count(F.lit(1)).alias("n_items"))
    n_rules = rules.groupBy("level").agg(F.count(F.lit(1)).alias("n_rules"))
    return (levels.select("level", "mode")
            .join(bk.users.select("level", "n_users"), "level", "left")
            .join(n_items, "level", "left").join(n_rules, "level", "left")
            .select("level",
                    F.coalesce("n_users", F.lit(0)).cast("long").alias("n_users"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"),
                    "mode"))


# ---------------------------------------------------------------------------
# Frequent itemsets and itemset rules
# ---------------------------------------------------------------------------

def frequent_itemsets(bk: Basket, level: str, min_support: float, max_len: int = 3,
                      method: str = "vertical") -> DataFrame:
    """Itemsets of a level up to ``max_len`` with ``freq / U >= min_support``.

    Support is counted over basket users (rows of the basket matrix). ``"vertical"`` intersects compressed user sets and
    ``"apriori"`` (R4) joins; neither builds a set longer than ``max_len``. ``"fpgrowth"`` (MLlib) is one more
    cross-check: it mines every length first, with a count floor lowered by a hair so that float rounding in ``min_support * U``
    cannot drop a set.
    """
    if method == "vertical":
        from shopseg.operators.vertical import frequent_itemsets_vertical
        params = bk.basket.sparkSession.createDataFrame([(level, float(min_support), int(max_len))],
                                                        "level string, min_support double, max_len int")
        return frequent_itemsets_vertical(bk, params)
    if method == "apriori":
        return frequent_itemsets_apriori(bk, level, min_support, max_len)
    if method != "fpgrowth":
        raise ValueError(f"unknown method {method!r}")
    from pyspark.ml.fpm import FPGrowth

    baskets = (bk.basket.where(F.col("level") == level).groupBy("User_ID")
               .agg(F.collect_set("item").alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=max(min_support - 1e-9, 0.0), minConfidence=1.0).fit(baskets)
    got = bk.basket_users.where(F.col("level") == level).collect()
    n_baskets = float(got[0]["U"]) if got else 1.0
    return (model.freqItemsets.where(F.size("items") <= max_len)
            .where(F.col("freq") / F.lit(n_baskets) >= F.lit(min_support))
            .select(F.lit(level).alias("level"), F.array_sort("items").alias("items"),
                    F.col("freq").cast("long").alias("freq")))


def frequent_itemsets_apriori(bk: Basket, level: str, min_support: float, max_len: int = 3) -> DataFrame:
    """``frequent_itemsets_by_level`` for one level."""
    spark = bk.basket.sparkSession
    return frequent_itemsets_by_level(bk, spark.createDataFrame([(level, float(min_support), int(max_len))],
                                                               "level string, min_support double, max_len int"))


def frequent_itemsets_by_level(bk: Basket, params: DataFrame) -> DataFrame:
    """R4 for every level of ``params`` (``level, min_support, max_len``): ``level, items, freq``, level-wise.

    Length 1 comes from the kept-item counts, length 2 from the co-occurrence counts. Longer sets are
    candidates from joining two frequent sets that differ in their last item, kept if all their
    subsets are frequent, and counted by scanning the baskets: these are stored once, a row per user, and each length
    passes over them without a shuffle but that of the counts. Nothing is kept per set and user.
    """
    floor = params.select("level", "min_support", "max_len").join(bk.basket_users, "level") \
        .withColumn("U", F.col("U").cast("double"))
    floor = cut_lineage(floor)
    longest = floor.agg(F.max("max_len")).first()[0] or 0

    def frequent(counted: DataFrame, length: int) -> DataFrame:
        return cut_lineage(counted.join(F.broadcast(floor.where(F.col("max_len") >= length)), "level")
                           .where(F.col("freq") / F.col("U") >= F.col("min_support")).select("level", "items", "freq"))

    found = [frequent(bk.kept.select("level", F.array("idx").alias("items"), F.col("user_count").cast("long").alias("freq")), 1)]
    if longest >= 2:
        wanted = floor.where("max_len >= 2").select("level")
        co = cooccurrence(bk.basket.join(F.broadcast(wanted), "level", "left_semi"), bk.kept_sizes)
        found.append(frequent(co.select("level", F.array("a", "b").alias("items"), F.col("co").cast("long").alias("freq")), 2))
    baskets = None
    for length in range(3, longest + 1):
        # of the levels that want sets so long
        last = found[-1].join(F.broadcast(floor.where(F.col("max_len") >= length).select("level")), "level", "left_semi")
        candidates = cut_lineage(numbered(candidate_sets(last, length), ["level", "items"], "no"))
        n, counted = candidates.count(), None
        if not n:
            break
        if baskets is None:
            wanted = floor.where("max_len >= 3").select("level")
            baskets = stored(bk.basket.join(F.broadcast(wanted), "level", "left_semi")
                             .groupBy("level", "User_ID").agg(F.collect_list("idx").alias("idx")).select("level", "idx"), "baskets")
        for first in range(0, n, SCAN):
            part = _scanned(baskets, candidates.where((F.col("no") >= first) & (F.col("no") < first + SCAN)), length)
            counted = part if counted is None else counted.unionByName(part)
        found.append(frequent(counted, length))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return named_sets(out, bk)


def named_sets(sets: DataFrame, bk: Basket) -> DataFrame:
    """``level, items, freq`` with the names of the items; kept items are numbered in order, so these come out in order, too."""
    named = sets.select("level", "items", "freq", F.posexplode("items").alias("at", "idx")).join(bk.kept.select("level", "idx", "item"), ["level", "idx"])
    return named.groupBy("level", "items").agg(F.first("freq").alias("freq"), F.array_sort(F.collect_list(F.struct("at", "item"))).alias("i")) \
        .select("level", F.col("i.item").alias("items"), "freq")


def _scanned(baskets: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """``level, items, freq`` of ``candidates`` (``level, items, no``; at most ``SCAN``) over ``baskets`` (``level, idx``).

    A task turns its baskets, some at a time, to a bitmap of users per item and counts the bits that a candidate's items share.
    """
    by_level: dict[str, tuple] = {}
    for r in sorted(candidates.collect(), key=lambda r: r.no):
        no, items = by_level.setdefault(r.level, ([], []))
        no.append(r.no)
        items.append(r["items"])
    for level, (no, items) in by_level.items():
        used, at = np.unique(np.array(items, np.int64), return_inverse=True)
        by_level[level] = np.array(no, np.int64), used, at.reshape(-1, length)
    sent = baskets.sparkSession.sparkContext.broadcast(by_level)

    def count(batches):
        totals = {level: np.zeros(len(no), np.int64) for level, (no, _, _) in sent.value.items()}

        def add(level, lists):
            _, used, sets = sent.value[level]
            users = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            idx = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.minimum(np.searchsorted(used, idx), len(used) - 1)
            known = used[row] == idx
            held = np.zeros((len(used), -(-len(lists) // 64) * 64), bool)
            held[row[known], users[known]] = True
            bits = np.packbits(held, axis=1).view(np.uint64)
            step = max(1, (1 << 20) // bits.shape[1])
            for a in range(0, len(sets), step):
                both = bits[sets[a:a + step, 0]]
                for j in range(1, length):
                    both &= bits[sets[a:a + step, j]]
                totals[level][a:a + step] += np.bitwise_count(both).sum(1, dtype=np.int64)

        for b in batches:
            for level in set(b["level"].unique().to_pylist()) & set(totals):
                lists = b.filter(pc.equal(b["level"], level))["idx"]
                most = max(64, HELD // len(sent.value[level][1]))
                for a in range(0, len(lists), most):
                    add(level, pa.concat_arrays([lists.slice(a, most)]))
        for level, (no, _, _) in sent.value.items():
            some = totals[level] > 0
            yield pa.RecordBatch.from_pydict({"no": pa.array(no[some]), "n": pa.array(totals[level][some])})

    counts = baskets.mapInArrow(count, "no long, n long").groupBy("no").agg(F.sum("n").alias("freq"))
    out = cut_lineage(candidates.join(counts, "no").select("level", "items", "freq"))
    sent.destroy()
    return out


def candidate_sets(sets: DataFrame, length: int) -> DataFrame:
    """``level, items``: sets of ``length`` all of whose subsets of one item less are among ``sets``."""
    head = sets.select("level", F.slice("items", 1, length - 2).alias("head"), F.element_at("items", -1).alias("x"))
    joined = head.join(head.withColumnRenamed("x", "y"), ["level", "head"]).where("x < y") \
        .select("level", F.concat("head", F.array("x", "y")).alias("items"))
    subsets = joined.select("level", F.col("items").alias("whole"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(length - 1)),
        lambda k: F.filter("items", lambda _, i: i != k))).alias("items"))
    return cut_lineage(subsets.join(sets.select("level", "items"), ["level", "items"], "left_semi")
                       .groupBy("level", F.col("whole").alias("items")).agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") == length).select("level", "items"))


def itemset_rules(itemsets: DataFrame, basket_users: DataFrame, params: DataFrame) -> DataFrame:
    """Every split of every frequent itemset into antecedent -> consequent.

    ``confidence = supp(X ∪ Y) / supp(X)``, ``lift = confidence / supp(Y)``;
    kept when ``confidence >= min_conf`` and ``lift >= min_lift``. The split
    masks are generated per itemset (at most 6 for a triple) and the subset
    supports found by joining the itemset table on its sorted item array.
    """
    sets = itemsets.join(F.broadcast(basket_users), "level").select(
        "level", "items", "freq", (F.col("freq") / F.col("U")).alias("supp"))
    multi = sets.where(F.size("items") >= 2)
    splits = (multi.withColumn("m", F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), F.size("items")).cast("int") - 2)))
              .withColumn("ante", F.expr("filter(items, (x, i) -> ((m >> i) & 1) = 1)"))
              .withColumn("cons", F.expr("filter(items, (x, i) -> ((m >> i) & 1) = 0)")))
    sa = sets.select("level", F.col("items").alias("ante"), F.col("supp").alias("antecedent_support"))
    sc = sets.select("level", F.col("items").alias("cons"), F.col("supp").alias("consequent_support"))
    p = F.broadcast(params.select("level", "min_conf", "min_lift"))
    r = (splits.join(sa, ["level", "ante"]).join(sc, ["level", "cons"]).join(p, "level")
         .withColumn("confidence", F.col("supp") / F.col("antecedent_support"))
         .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
         .where((F.col("confidence") >= F.col("min_conf")) & (F.col("lift") >= F.col("min_lift"))))
    return r.select(
        "level",
        F.col("ante").alias("antecedents"), F.col("cons").alias("consequents"),
        itemset_text(F.col("ante")).alias("antecedent"), itemset_text(F.col("cons")).alias("consequent"),
        "antecedent_support", "consequent_support", F.col("supp").alias("support"), "confidence", "lift",
        (F.col("supp") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
        F.when(F.col("confidence") >= 1.0, F.lit(float("inf")))
         .otherwise((1 - F.col("consequent_support")) / (1 - F.col("confidence"))).alias("conviction"))

