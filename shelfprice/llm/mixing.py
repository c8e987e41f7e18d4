"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times. The whole part of that
number is certain; what remains is a probability per document, and pivotal rounding turns these into
whole copies: two documents meet, mass moves at random from one to the other until one of them is
integral, and the other goes on with what is left. Mass is counted in words, so every meeting leaves
the expected copies of both and the words of the source as they were; only what is left over last
in a source is rounded on its own.

What is left over of a meeting is the larger one, as a rule: the smaller one cannot move it to a whole number. So
sizes are met from large to small, where a large document meets all smaller ones of its source
together, which share one fraction; they have the room to make it integral, and their fraction moves a little.
That is done for the documents of over 1 / ``GIANTS`` of their source's words, fewer than ``GIANTS`` a source. The others meet
in a reduction tree: they are dealt into blocks of about ``BLOCK`` by a hash, meet one after another inside their
block, and the one left over goes up to the next level, which has one document per block of the level
below. So the data that is shuffled shrinks by ``BLOCK`` per level, no source, however large, meets in
one task, and the last one left over holds at most 1 / ``GIANTS`` of the source.

Defined results: NULL texts have size 0; documents of size 0 take nothing; NULL is a source of its own
and comes last; a source whose documents are all empty has target 0; rows that agree in source,
document id and size are told apart by a number; a NULL id is unlike any text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfprice.llm.text import unit_interval, word_count
from shelfprice.plans.staging import stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 128
GIANTS = 1000
# Rows that agree in source, id and size are numbered in runs of so many, each by a task of its own.
RUN = 10_000
# Fractions nearer than this to a whole number are whole: sums of doubles leave such dust.
DUST = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Weights repeat along the sources in code point order, NULL last. A target is its weight's share of
    all words, but at most ``max_repeats`` times the source. The sources that reach their limit are those
    with the smallest limit per weight, so one pass in that order finds where the common level lies:
    above a limit the source gets the limit, below it its weight times the level. The windows run over
    one row per source, never over documents.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    repeated = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(repeated, (F.col("rank") % len(weights)).cast("int"))
    )
    limit = F.col("source_size").cast("double") * max_repeats
    ranked = ranked.withColumns({"limit": limit, "per_weight": limit / F.col("weight")})
    by_limit = everything.orderBy("per_weight", "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = F.sum("source_size").over(everything).cast("double")
    levels = ranked.withColumn("level", (total - spent) / left)
    # The level of the first source below its limit holds for it and for all after it.
    whole = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    common = F.first(F.when(F.col("level") <= F.col("per_weight"), F.col("level")), ignorenulls=True).over(whole)
    target = F.least("limit", F.coalesce(F.col("weight") * common, F.col("limit")))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def _meet(carry: Column, unit: Column) -> Column:
    """The meeting of the unit left over so far with the next one: (settled unit with its copy, unit left over).

    Mass ``up`` can move from the carry to the unit, or ``down`` the other way, until one is 0 or 1. Each
    way is taken with the probability that keeps both expectations.
    """
    up = F.least(carry["mass"], unit["size"] - unit["mass"])
    down = F.least(unit["mass"], carry["size"] - carry["mass"])
    draw = unit_interval(carry["id"], carry["size"], unit["id"], unit["size"], seed=1)
    moved = F.when(draw < down / (up + down), up).otherwise(-down)
    a = (carry["mass"] - moved).alias("mass")
    b = (unit["mass"] + moved).alias("mass")
    return F.struct(
        F.struct(carry["id"].alias("id"), carry["size"].alias("size"), a).alias("a"),
        F.struct(unit["id"].alias("id"), unit["size"].alias("size"), b).alias("b"),
    )


def _whole(u: Column) -> Column:
    return (u["mass"] <= u["size"] * DUST) | (u["mass"] >= u["size"] * (1 - DUST))


def _reduce(block: Column) -> Column:
    """All meetings of a block: ``settled`` units with their copy and the ``left`` unit (NULL if none)."""
    block = F.transform(block, lambda u: F.struct(u["id"].alias("id"), u["size"].alias("size"), u["mass"].alias("mass")))
    none = F.get(F.slice(block, 1, 0), F.lit(0))
    settle = lambda u: F.array(
        F.struct(u["id"].alias("id"), u["size"].alias("size"), (u["mass"] * 2 > u["size"]).cast("int").alias("copy"))
    )
    start = F.struct(F.slice(settle(F.get(block, F.lit(0))), 1, 0).alias("settled"), none.alias("left"))

    def step(acc: Column, unit: Column) -> Column:
        # The pair is bound once by a transform over a one-element array.
        first = F.struct(acc["settled"].alias("settled"), unit.alias("left"))
        met = F.get(
            F.transform(
                F.array(_meet(acc["left"], unit)),
                lambda p: F.struct(
                    F.concat(
                        acc["settled"],
                        F.when(_whole(p["a"]) & _whole(p["b"]), F.concat(settle(p["a"]), settle(p["b"])))
                        .when(_whole(p["a"]), settle(p["a"]))
                        .otherwise(settle(p["b"])),
                    ).alias("settled"),
                    F.when(_whole(p["a"]) & _whole(p["b"]), none)
                    .when(_whole(p["a"]), p["b"])
                    .otherwise(p["a"])
                    .alias("left"),
                ),
            ),
            F.lit(0),
        )
        return F.when(acc["left"].isNull(), first).otherwise(met)

    return F.aggregate(block, start, step)


def _alone() -> Column:
    """The copy of a unit that has nobody left to meet."""
    return (unit_interval("id", "size", seed=2) * F.col("size") < F.col("mass")).cast("int").alias("copy")


def pivotal_copies(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``source, id, size, copy`` (0 or 1) from ``source, id, size, mass``, where mass is the words to be taken.

    ``id`` is unique within (source, size); sizes are positive. One job per level of the tree.
    """
    settled = []
    level = 0
    while True:
        counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        blocks = F.ceil(F.col("n") / block)
        dealt = units.join(
            counts.select(F.col("source").alias("of"), blocks.alias("blocks")), F.col("source").eqNullSafe(F.col("of"))
        ).select(
            "source",
            F.pmod(F.xxhash64(F.lit(level), "id", "size"), F.col("blocks")).alias("block"),
            (F.col("blocks") <= 1).alias("last"),
            F.struct((-F.col("size")).alias("order"), "id", "size", "mass").alias("unit"),
        )
        reduced = dealt.groupBy("source", "block", "last").agg(F.sort_array(F.collect_list("unit")).alias("units"))
        done = stage(reduced.select("source", "last", _reduce(F.col("units")).alias("r")), "mixing_level")
        settled.append(done.select("source", F.explode("r.settled").alias("u")).select("source", "u.*"))
        left = done.where("r.left IS NOT NULL").select("source", "last", "r.left.*")
        # The one unit that a source ends with is rounded alone.
        settled.append(left.where("last").select("source", "id", "size", _alone()))
        units = left.where("NOT last").drop("last")
        if units.isEmpty():
            break
        level += 1
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


def _large_to_small(giants: Column, fraction: Column, total: Column) -> Column:
    """The copy of every giant, and the fraction that the documents behind them go on with.

    ``giants`` is sorted from large to small and ``total`` counts the words of the source's open documents. All that are
    not decided yet share one fraction, so a giant and those behind it are two units that can meet.
    """
    nothing = F.slice(F.transform(giants, lambda u: F.struct(u["id"].alias("id"), u["size"].alias("size"), F.lit(0).alias("copy"))), 1, 0)

    def step(acc: Column, unit: Column) -> Column:
        size, f, behind = unit["size"], acc["fraction"], acc["left"] - unit["size"]
        up = F.least(f * size, (1 - f) * behind)
        down = F.least(f * behind, (1 - f) * size)
        draw = unit_interval(unit["id"], size, seed=3)
        # What the giant gains; the others lose it. Nobody behind it, or nothing to move: it is decided alone.
        gained = F.when(up + down <= size * DUST, F.lit(0.0)).when(draw * (up + down) < down, -up).otherwise(down)
        share = f + gained / size
        copy = F.when(share <= DUST, 0).when(share >= 1 - DUST, 1).otherwise((unit_interval(unit["id"], size, seed=2) < share).cast("int"))
        settled = F.array(F.struct(unit["id"].alias("id"), size.alias("size"), copy.alias("copy")))
        rest = F.when(behind > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), f - gained / behind))).otherwise(f)
        return F.struct(F.concat(acc["settled"], settled).alias("settled"), rest.alias("fraction"), behind.alias("left"))

    start = F.struct(nothing.alias("settled"), fraction.alias("fraction"), total.alias("left"))
    return F.aggregate(giants, start, step)


def _giants_first(units: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decide the giants of each source: their copies, and the fraction (by source) of the other documents."""
    giant = F.when(F.col("giant"), F.struct((-F.col("size")).alias("order"), "id", "size"))
    blocks = units.groupBy("source").agg(F.sort_array(F.collect_list(giant)).alias("giants"), F.sum("size").alias("total"))
    fractions = sources.select(F.col("source").alias("of"), "fraction")
    known = blocks.join(fractions, F.col("source").eqNullSafe(F.col("of")))
    decided = known.select("source", _large_to_small(F.col("giants"), F.col("fraction"), F.col("total")).alias("r"))
    decided = stage(decided, "mixing_giants")
    copies = decided.select("source", F.explode("r.settled").alias("u")).select("source", "u.*")
    return copies, decided.select("source", "r.fraction")


def _numbered(counted: DataFrame, run: int) -> DataFrame:
    """One row per document again, with a number among those that agree; many alike are numbered by several tasks."""
    few = counted.where(F.col("rows") <= run).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    starts = F.sequence(F.lit(1).cast("long"), F.col("rows"), F.lit(run).cast("long"))
    runs = counted.where(F.col("rows") > run).withColumn("start", F.explode(starts)).repartition("start", "size")
    last = F.least("rows", F.col("start") + run - 1)
    many = runs.withColumn("row", F.explode(F.sequence("start", last))).drop("start")
    return few.unionByName(many).drop("rows")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    counted = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = _numbered(stage(counted, "mixing_counted"), RUN)
    ident = F.concat(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")), F.lit("#"), F.col("row"))
    units = stage(units.withColumn("id", ident), "mixing_units")
    targets = source_targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    sure = F.floor(rate + DUST)
    fraction = F.greatest(rate - sure, F.lit(0.0))
    targets = stage(targets.withColumns({"sure": sure, "fraction": fraction}), "mixing_targets")

    of = targets.withColumnRenamed("source", "of")
    known = units.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    open_ = known.where((F.col("size") > 0) & (F.col("fraction") > DUST)).select(
        "source",
        "id",
        F.col("size").cast("double").alias("size"),
        (F.col("fraction") * F.col("size")).alias("mass"),
        (F.col("size") * GIANTS > F.col("source_size")).alias("giant"),
    )
    giants, fractions = _giants_first(open_, targets)
    now = fractions.select(F.col("source").alias("of"), F.col("fraction").alias("now"))
    rest = open_.where("NOT giant").join(now, F.col("source").eqNullSafe(F.col("of")))
    # The giants may have used up all room of the others, or taken all their mass.
    whole = (F.col("now") <= DUST) | (F.col("now") >= 1 - DUST)
    given = rest.where(whole).select("source", "id", "size", F.round("now").cast("int").alias("copy"))
    rest = rest.where(~whole).select("source", "id", "size", (F.col("now") * F.col("size")).alias("mass"))
    drawn = giants.unionByName(given).unionByName(pivotal_copies(rest, block)).select(
        F.col("source").alias("d_source"), F.col("id").alias("d_id"), F.col("size").cast("long").alias("d_size"), "copy"
    )
    same = (F.col("id") == F.col("d_id")) & (F.col("size") == F.col("d_size"))
    joined = known.join(drawn, same & F.col("source").eqNullSafe(F.col("d_source")), "left")
    copies = F.when(F.col("size") > 0, F.col("sure") + F.coalesce("copy", F.lit(0))).otherwise(0).cast("long")
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
