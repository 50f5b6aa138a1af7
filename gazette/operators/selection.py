"""Top-N selection: windows, quotas, and the mixed pick of an edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.text import bound
from gazette.functions.tokens import lit_array
from gazette.operators.joins import related


def per_feed_cap(entries: DataFrame, cap: int) -> DataFrame:
    """The first `cap` entries of each feed."""
    return entries.withColumn("n", F.row_number().over(Window.partitionBy("feed_id").orderBy("pos"))).where(F.col("n") <= cap).drop("n")


def topic_limits(feeds: DataFrame, default: int = 3) -> DataFrame:
    return feeds.groupBy("topic").agg(F.max(F.coalesce("limit", F.lit(default))).alias("topic_limit"))


def per_topic_top(rows: DataFrame, limits: DataFrame, default: int = 3, most: int | None = None) -> DataFrame:
    """Each topic's best rows, as many as its limit.

    `most` is the largest limit (read from limits, a row per topic, where it isn't given). With it
    as a plain number Spark keeps only that many rows of a topic on each side of the shuffle.
    """
    if most is None:
        most = max(default, limits.agg(F.max("topic_limit")).first()[0] or 0)
    ranked = rows.withColumn("topic_rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("score"), "item_id"))).where(F.col("topic_rank") <= most)
    return ranked.join(limits, "topic", "left").where(F.col("topic_rank") <= F.coalesce("topic_limit", F.lit(default))).drop("topic_limit")


def running_ids(rows: DataFrame) -> DataFrame:
    """Numbers 1, 2, ... over (feed_ord, pos) without one task for all rows: counts per feed, offsets, then numbers inside feeds."""
    counts = rows.groupBy("feed_ord").agg(F.count("*").alias("c"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("feed_ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    inside = F.row_number().over(Window.partitionBy("feed_ord").orderBy("pos", "item_id"))
    return rows.withColumn("k", inside).join(offsets, "feed_ord").withColumn("running_id", F.concat(F.lit("item_"), (F.col("before") + F.col("k")).cast("string"))).drop("k", "before")


def quotas(cfg: Config) -> dict[str, int]:
    """Each target's share of the limit: the surplus by integer share, what remains by target, then name."""
    targets = dict(cfg.importance_targets)
    total, surplus = sum(targets.values()), max(0, cfg.importance_limit - sum(targets.values()))
    out = {c: n + surplus * n // total for c, n in targets.items()}
    for c in sorted(targets, key=lambda c: (-targets[c], c))[: max(0, cfg.importance_limit - sum(out.values()))]:
        out[c] += 1
    return out


def importance_candidates(rows: DataFrame, cfg: Config) -> DataFrame:
    """Rows to be judged: category quotas first, then other categories, then by rank (a top-k report)."""
    w = Window.partitionBy("category").orderBy(F.desc("score"), "item_id")
    quota = F.lit(None).cast("int")
    for c, n in quotas(cfg).items():
        quota = F.when(F.col("category") == c, n).otherwise(quota)
    df = rows.withColumn("category_rank", F.row_number().over(w)).withColumn("quota", quota)
    phase = F.when(F.col("category_rank") <= F.col("quota"), 0).when(F.col("quota").isNull(), 1).otherwise(2)
    best = df.withColumn("phase", phase).orderBy("phase", F.desc("score"), "item_id").limit(cfg.importance_limit)
    return best.drop("quota")


def semantic_candidates(rows: DataFrame, cfg: Config) -> DataFrame:
    """The best rows and up to half as many related ones."""
    top = rows.orderBy(F.desc("score"), "item_id").limit(cfg.semantic_limit)
    return top.unionByName(related(rows, top, cfg.semantic_limit // 2).select(*rows.columns))


def output_ids(rows: DataFrame) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("date").orderBy("pick_rank", "item_id"))
    return rows.withColumn("id", F.concat_ws("_", "date", n))


# the mixed pick: folds over one edition's pool, an array of rows from the best on


def _count(chosen: Column, field: str, value: Column) -> Column:
    return F.size(F.filter(chosen, lambda r: r[field].eqNullSafe(value)))


def _among(chosen: Column, row: Column) -> Column:
    return F.exists(chosen, lambda r: r["item_id"] == row["item_id"])


def _below_cap(chosen: Column, row: Column, cfg: Config) -> Column:
    """Whether the row's category may have one more."""
    out = F.lit(True)
    for category, most in cfg.category_caps:
        out = F.when(row["category"] == category, _count(chosen, "category", row["category"]) < most).otherwise(out)
    return out


def _outlet_free(chosen: Column, row: Column, cfg: Config) -> Column:
    return _count(chosen, "source", row["source"]) < cfg.source_cap if cfg.source_cap > 0 else F.lit(True)


def _needs(pool: Column, limit: Column, cfg: Config) -> Column:
    """(category, least) of each minimum: no more than there are; beyond the limit one after the other is lowered, the category with the weakest best row first."""
    of = lambda c: F.filter(pool, lambda r: r["category"] == c)
    one = lambda c, n: bound(of(c), lambda mine: F.struct(F.coalesce(F.get(mine, F.lit(0))["score"], F.lit(0.0)).alias("strength"), F.lit(c).alias("category"), F.least(F.lit(n), F.size(mine)).alias("least")))
    rounds = max((n for _, n in cfg.category_minimums), default=0)

    def lowered(needs: Column) -> Column:
        total = F.aggregate(needs, F.lit(0), lambda acc, x: acc + x["least"])
        start = F.struct((total - limit).alias("over"), lit_array(()).alias("cut"))

        def step(acc: Column, x: Column) -> Column:
            hit = (acc["over"] > 0) & (F.size(F.filter(acc["cut"], lambda c: c == x["category"])) < x["least"])
            return F.struct((acc["over"] - hit.cast("int")).alias("over"), F.when(hit, F.array_append(acc["cut"], x["category"])).otherwise(acc["cut"]).alias("cut"))

        cut = F.aggregate(F.flatten(F.array_repeat(F.array_sort(needs), rounds)), start, step, lambda acc: acc["cut"])
        return bound(cut, lambda gone: F.transform(needs, lambda x: F.struct(x["category"].alias("category"), (x["least"] - F.size(F.filter(gone, lambda c: c == x["category"]))).alias("least"))))

    return bound(F.array(*(one(c, n) for c, n in cfg.category_minimums)), lowered)


def _swept(pool: Column, chosen: Column, limit: Column, may) -> Column:
    """chosen with each row of the pool that may(chosen, row) lets in, in order, up to the limit."""
    fits = lambda acc, r: (F.size(acc) < limit) & ~_among(acc, r) & may(acc, r)
    return F.aggregate(pool, chosen, lambda acc, r: F.when(fits(acc, r), F.array_append(acc, r)).otherwise(acc))


def mixed(pool: Column, limit: Column, cfg: Config) -> Column:
    """The rows picked from a pool: category minimums, then by score under caps of categories and outlets, then without the outlets', then without any."""

    def whole(needs: Column) -> Column:
        chosen = F.slice(pool, 1, 0)
        for k, (category, _) in enumerate(cfg.category_minimums):
            least = needs[k]["least"]
            chosen = _swept(pool, chosen, limit, lambda acc, r, c=category, n=least: (r["category"] == c) & (_count(acc, "category", F.lit(c)) < n) & _outlet_free(acc, r, cfg))
        chosen = _swept(pool, chosen, limit, lambda acc, r: _below_cap(acc, r, cfg) & _outlet_free(acc, r, cfg))
        chosen = _swept(pool, chosen, limit, lambda acc, r: _below_cap(acc, r, cfg))
        return _swept(pool, chosen, limit, lambda acc, r: F.lit(True))

    return bound(_needs(pool, limit, cfg), whole)


def signal_capped(pool: Column, chosen: Column, limit: Column, cfg: Config) -> Column:
    """struct(chosen, replaced): rows with capped labels beyond the share give way, the lowest first, to the best others that score almost as much.

    A row that nothing can replace stays, and the next one is tried; replacements go to the end.
    """
    most = F.greatest(F.lit(1), F.floor(limit * cfg.signal_share).cast("int"))

    def swapped(first: Column) -> Column:
        marked = F.filter(first, lambda r: r["capped"])
        victims = F.transform(F.array_sort(F.transform(marked, lambda r, i: F.struct(r["score"].alias("score"), i.alias("i"), r.alias("r")))), lambda x: x["r"])
        start = F.struct(first.alias("chosen"), F.greatest(F.size(marked) - most, F.lit(0)).alias("over"), F.lit(0).alias("replaced"))

        def step(acc: Column, victim: Column) -> Column:
            others = F.filter(acc["chosen"], lambda r: r["item_id"] != victim["item_id"])
            may = lambda rest: F.get(F.filter(pool, lambda r: ~r["capped"] & (r["score"] >= victim["score"] - cfg.signal_slack) & ~_among(rest, r) & (r["item_id"] != victim["item_id"]) & _below_cap(rest, r, cfg) & _outlet_free(rest, r, cfg)), F.lit(0))
            best = F.when(acc["over"] > 0, bound(others, may))
            done = lambda x: F.struct(F.when(x.isNotNull(), F.array_append(others, x)).otherwise(acc["chosen"]).alias("chosen"), (acc["over"] - x.isNotNull().cast("int")).alias("over"), (acc["replaced"] + x.isNotNull().cast("int")).alias("replaced"))
            return bound(best, done)

        return F.aggregate(victims, start, step, lambda acc: F.struct(acc["chosen"], acc["replaced"]))

    return bound(chosen, swapped)


def pools(rows: DataFrame, cfg: Config, limit: int) -> DataFrame:
    """(edition, pool): an edition's rows that a pick of up to `limit` can look at, as one sorted array.

    A row is let in or not by category, outlet and flag alone, so of such a cell no more than
    2 * limit rows count, and in a category no more than 2 * limit outlets can stand before a row
    that is picked, each with two cells: 8 * limit^2 rows of a category and flag are enough. An
    array has at most that many per category and flag, however many rows and outlets there are.
    """
    capped = F.arrays_overlap("signals", lit_array(cfg.capped_signals)) & ~(F.coalesce("importance", F.lit(0)) >= 4) & ~F.arrays_overlap("longs", lit_array(cfg.capped_signals))
    df = rows.select("edition", "item_id", "category", "source", "score", F.coalesce(capped, F.lit(False)).alias("capped"))
    best = lambda *keys: F.row_number().over(Window.partitionBy("edition", *keys).orderBy(F.desc("score"), "item_id"))
    cells = df.withColumn("n", best("category", "source", "capped")).where(F.col("n") <= 2 * limit)
    kept = cells.withColumn("n", best("category", "capped")).where(F.col("n") <= 8 * limit * limit).drop("n")
    row = F.struct((-F.col("score")).alias("rank"), "item_id", "category", "source", "score", "capped")
    return kept.groupBy("edition").agg(F.array_sort(F.collect_list(row)).alias("pool"))


def picks(pool: DataFrame, cfg: Config, limit: Column) -> DataFrame:
    """(edition, chosen, replaced) for pools and a limit each; the folds stay in the JVM."""
    first = pool.withColumn("limit", limit.cast("int")).withColumn("first", mixed(F.col("pool"), F.col("limit"), cfg))
    done = first.withColumn("done", signal_capped(F.col("pool"), F.col("first"), F.col("limit"), cfg))
    return done.select("edition", "limit", F.col("done.chosen").alias("chosen"), F.col("done.replaced").alias("replaced"))


def _listed(found: DataFrame) -> DataFrame:
    return found.select("edition", F.posexplode("chosen").alias("p", "r")).select("edition", F.col("r.item_id").alias("item_id"), (F.col("p") + 1).cast("int").alias("pick_rank"))


def mix_pick(rows: DataFrame, cfg: Config, limit: int | None = None) -> DataFrame:
    """(edition, item_id, pick_rank) of each edition's mixed pick."""
    limit = limit or cfg.top_limit
    return _listed(picks(pools(rows, cfg, limit), cfg, F.lit(limit)))


def pick_stats(rows: DataFrame, cfg: Config, limit: int | None = None) -> DataFrame:
    """What each edition's pick came to: picked, the signal cap and how many rows it replaced, outlets and categories picked."""
    limit = limit or cfg.top_limit
    found = picks(pools(rows, cfg, limit), cfg, F.lit(limit))
    names = lambda field: F.size(F.array_distinct(F.transform("chosen", lambda r: r[field])))
    return found.select("edition", F.size("chosen").alias("picked"), F.greatest(F.lit(1), F.floor(F.col("limit") * cfg.signal_share).cast("int")).alias("cap_limit"), "replaced", names("source").alias("sources"), names("category").alias("categories"))


def allowlist_pick(rows: DataFrame, cfg: Config, strict: bool) -> DataFrame:
    """(edition, item_id, pick_rank): the mixed pick of fresh, eligible rows of allowed outlets (columns top_fresh, eligible, allowed).

    strict: that is all, even if short. Else the missing places go to the best fresh rows by score.
    """
    fresh = rows.where("top_fresh AND eligible")
    picked = mix_pick(fresh.where("allowed"), cfg)
    return picked if strict else filled(picked, fresh, cfg)


def filled(picked: DataFrame, rows: DataFrame, cfg: Config) -> DataFrame:
    """The missing places of each edition, filled with the best rows that aren't picked."""
    have = picked.groupBy("edition").agg(F.count("*").alias("have"))
    rest = rows.join(picked.select("edition", "item_id"), ["edition", "item_id"], "left_anti")
    ranked = rest.withColumn("n", F.row_number().over(Window.partitionBy("edition").orderBy(F.desc("score"), "item_id"))).where(F.col("n") <= cfg.top_limit)
    fill = ranked.join(have, "edition", "left").where(F.col("n") + F.coalesce("have", F.lit(0)) <= cfg.top_limit)
    return picked.unionByName(fill.select("edition", "item_id", (F.col("n") + F.coalesce("have", F.lit(0))).cast("int").alias("pick_rank")))


def refill(picked: DataFrame, rows: DataFrame, cfg: Config) -> DataFrame:
    """Picks that are still eligible stay; the rest is picked from again for the number that is missing (one round)."""
    good = rows.where("eligible")
    kept = picked.join(good.select("edition", "item_id"), ["edition", "item_id"], "left_semi")
    have = kept.groupBy("edition").agg(F.count("*").alias("have"))
    rest = pools(good.join(kept.select("edition", "item_id"), ["edition", "item_id"], "left_anti"), cfg, cfg.top_limit).join(have, "edition", "left")
    missing = rest.withColumn("missing", cfg.top_limit - F.coalesce("have", F.lit(0))).where("missing > 0")
    more = _listed(picks(missing, cfg, F.col("missing")))
    return kept.unionByName(more.select("edition", "item_id", (F.col("pick_rank") + cfg.top_limit).alias("pick_rank")))
