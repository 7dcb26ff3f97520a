"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources share the whole size by weight, none above MOST times its own size. Documents of
a source are dealt to blocks by hash; a source's blocks, in as many rounds as its target
needs (the last round in part), are its quota. A binary tree splits the quotas of all
sources among the output shards: a node gives its left half a multivariate
hypergeometric draw of its blocks, so each shard gets the composition that a full
shuffle would give it, and every quota is met exactly. Each shard then takes its counts
from the sources' permuted blocks, disjoint from the other shards', and orders its own
documents by hash. The tree is as deep as the words to be drawn need, at SHARD_WORDS a shard.

Only DataFrame functions. What grows with the corpus is only ever grouped by source and
block, and blocks keep to a source's share of MOST_BLOCKS, so a hot source is spread. The
decisions are made on sizes alone and written; texts are read for the sizes and for the
output, where they are ordered by a sort that can spill. The quotas of all sources are one row.

Defined results: a null text has size 0; a null source is a source, the last; sources
without words have target 0; repeated rows are documents of their own, which may differ
in what is taken only where nothing but their hash order (id, size) tells them apart; an
empty table gives an empty result; columns named like those added are replaced, and any
other names may be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release
from .rules import let, words_of

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20
#: Words of an output shard, about.
SHARD_WORDS = 1 << 26
LEAST_DEPTH = 6
#: Documents that a block has on average, as long as its source has at most MOST_BLOCKS.
BLOCK_DOCS = 128
MOST_BLOCKS = 65_536


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", F.size(words_of(F.col(text))).cast("long"))


def targets(sized: DataFrame) -> DataFrame:
    """__sid (rank of the source), __source, __docs, source_size, target: a row for each source."""
    total = sized.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("__docs"), F.sum("size").alias("source_size"))
    everything = Window.partitionBy()  # over one row for each source
    sid = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last()))
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("__sid") - 1) % len(WEIGHTS)).cast("double")
    cap = F.col("source_size").cast("double") * MOST
    t = total.withColumn("__sid", sid).withColumns({"__weight": weight, "__cap": cap})
    # the sources at their cap are the first by cap over weight; the level is that of the first one below
    before = Window.orderBy(F.col("__cap") / F.col("__weight"), "__sid").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    level = rest / (F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0.0)))
    t = t.withColumn("__level", level)
    below = F.col("__level") <= F.col("__cap") / F.col("__weight")
    common = F.min(F.when(below, F.struct((F.col("__cap") / F.col("__weight")).alias("r"), F.col("__sid").alias("s"), F.col("__level").alias("l")))).over(everything)["l"]
    return t.withColumn("target", F.least(F.col("__cap"), common * F.col("__weight"))).select("__sid", "__source", "__docs", "source_size", "target")


# ------------------------------------------------------------- splitting tree
def _uniform(*parts: Column) -> Column:
    return (F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 53)) + F.lit(0.5)) / F.lit(float(1 << 53))


def _down(a: Column, b: Column) -> Column:
    """a, a - 1, ..., b."""
    return F.when(a >= b, F.sequence(a, b, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def _up(a: Column, b: Column) -> Column:
    return F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of the marked are among the drawn: by inversion, outward from the mode.
    Terms beyond twelve standard deviations, which have no weight in doubles, are left out."""
    big = lambda c: c.cast("long")

    def from_mode(mode: Column) -> Column:
        m, n, k, x0 = total, drawn, marked, mode
        var = n * (k / F.greatest(m, F.lit(1))) * ((m - k) / F.greatest(m, F.lit(1)))
        reach = big(F.ceil(12 * F.sqrt(F.greatest(var, F.lit(0.0))))) + 12
        lo, hi = F.greatest(big(F.lit(0)), n + k - m, x0 - reach), F.least(n, k, x0 + reach)
        rise = lambda t, x: t * (k - x + 1) * (n - x + 1) / (x * (m - k - n + x))
        fall = lambda t, x: t * (x + 1) * (m - k - n + x + 1) / ((k - x) * (n - x))
        one, none = F.lit(1.0), F.lit(0.0)

        def weight(places: Column, move, start: Column) -> Column:
            zero = F.struct(one.alias("t"), start.alias("s"))
            return F.aggregate(places, zero, lambda a, x: let(move(a["t"], x), lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s"))), lambda a: a["s"])

        def pick(places: Column, move, start: Column, goal: Column) -> Column:
            zero = F.struct(one.alias("t"), start.alias("s"), F.lit(None).cast("long").alias("x"))
            step = lambda a, x: let(move(a["t"], x), lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s"), F.coalesce(a["x"], F.when(a["s"] + t >= goal, x)).alias("x")))
            return F.aggregate(places, zero, step, lambda a: a["x"])

        above, under = _up(x0 + 1, hi), _down(x0 - 1, lo)
        return let(weight(above, rise, one), lambda up: let(u * (up + weight(under, fall, none)), lambda goal: F.when(goal <= 1, x0).otherwise(F.coalesce(pick(above, rise, one, goal), pick(under, fall, up, goal), x0))))

    mode = big(F.floor((drawn + 1) * ((marked + 1) / (total + 2))))
    safe = F.least(F.greatest(mode, F.greatest(big(F.lit(0)), drawn + marked - total)), F.least(drawn, marked))
    return let(safe, from_mode)


def _deal(level: int):
    """Draws for one source after another from what a node has left."""

    def deal(a: Column, k: Column) -> Column:
        u = _uniform(F.lit(level), F.col("shard"), F.size(a["got"]))
        return let(hypergeometric(a["all"], k, a["left"], u), lambda d: F.struct((a["all"] - k).alias("all"), (a["left"] - d).alias("left"), F.concat(a["got"], F.array(d)).alias("got")))

    return deal


def split(quotas: DataFrame, depth: int = LEAST_DEPTH) -> DataFrame:
    """(shard, counts) for 2^depth shards, from one row with the array counts of all quotas."""
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "counts")
    for level in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, k: a + k)
        coin = F.pmod(F.xxhash64(F.lit(SEED), F.lit(level), F.col("shard")), F.lit(2))
        sized = nodes.withColumn("__all", total).withColumn("__left", ((F.col("__all") + coin) / 2).cast("long"))
        zero = F.struct(F.col("__all").alias("all"), F.col("__left").alias("left"), F.array().cast("array<bigint>").alias("got"))

        dealt = sized.withColumn("__got", F.aggregate("counts", zero, _deal(level), lambda a: a["got"]))
        left = F.struct((F.col("shard") * 2).alias("shard"), F.col("__got").alias("counts"))
        right = F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("counts", "__got", lambda k, d: k - d).alias("counts"))
        nodes = dealt.select(F.explode(F.array(left, right)).alias("n")).select("n.shard", "n.counts")
    return nodes


# -------------------------------------------------------------------- mixture
def _keyed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """sized (doc_id, source, size) with the columns of its source, its hash and its block."""
    own = F.xxhash64(F.lit(SEED), "doc_id", "size")
    joined = sized.withColumn("__h", own).join(sources, F.col("source").eqNullSafe(F.col("__source")))
    return joined.withColumn("__block", F.pmod(F.xxhash64(F.lit(SEED + 1), "__h"), F.col("__blocks")))


def _fitting(keyed: DataFrame, ending: DataFrame) -> DataFrame:
    """(__sid, __h) of the documents that are taken once more in the one block of a source in which its target ends: parts
    of about BLOCK_DOCS documents one after another, and in the part where it ends, documents in hash order as far as each fits."""
    units = keyed.select("__sid", "__block", "__h", "size").join(ending, ["__sid", "__block"]).groupBy("__sid", "__left", "__h").agg(F.sum("size").alias("w"))
    number = units.groupBy("__sid").agg(F.ceil(F.count("*") / BLOCK_DOCS).alias("__parts"))
    units = units.join(number, "__sid").withColumn("__part", F.pmod(F.xxhash64(F.lit(SEED + 4), "__h"), F.col("__parts")))
    order = Window.partitionBy("__sid").orderBy("__part")
    parts = units.groupBy("__sid", "__part", "__left").agg(F.sum("w").alias("__words"))
    before = F.coalesce(F.sum("__words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = parts.select("__sid", "__part", (F.col("__left") - before).alias("__rest"), "__words").where("__rest > 0")
    listed = units.select("__sid", "__part", "__h", "w").join(rest, ["__sid", "__part"])
    whole = listed.where("__rest >= __words").select("__sid", "__h")
    last = listed.where("__rest < __words").groupBy("__sid", "__rest").agg(F.array_sort(F.collect_list(F.struct("__h", "w"))).alias("us"))
    zero = F.struct(F.col("__rest").alias("left"), F.array().cast("array<bigint>").alias("got"))
    fits = F.aggregate("us", zero, lambda a, x: F.when(x["w"] <= a["left"], F.struct((a["left"] - x["w"]).alias("left"), F.concat(a["got"], F.array(x["__h"])).alias("got"))).otherwise(a), lambda a: a["got"])
    return whole.unionByName(last.select("__sid", F.explode(fits).alias("__h")))


def plan(sized: DataFrame, depth: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The decisions for sized (doc_id, source, size): sources; of each block whether it is drawn once more and its shards, one for each
    draw; and the documents that are taken once more in a block drawn in part."""
    sources = cut(targets(sized).withColumns({
        "__blocks": F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("__docs") / BLOCK_DOCS)).cast("long"),
        "__rounds": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    }).withColumn("__rest", F.col("target") - F.col("__rounds") * F.col("source_size")))
    if depth is None:
        words = sources.agg(F.sum("target")).first()[0] or 0
        depth = max(LEAST_DEPTH, int(-(-words // SHARD_WORDS) - 1).bit_length())
    keyed = _keyed(sized, sources)
    # blocks: at most MOST_BLOCKS for each source
    per_block = keyed.groupBy("__sid", "__block").agg(F.sum("size").alias("__words"), *[F.first(c).alias(c) for c in ("__rounds", "__rest")])
    order = Window.partitionBy("__sid").orderBy("__block")
    before = F.coalesce(F.sum("__words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = per_block.withColumn("__left", F.col("__rest") - before)
    blocks = cut(blocks.withColumn("__last", F.col("__left") > 0).select("__sid", "__block", "__words", "__rounds", "__left", "__last"))
    # every draw of a block in a round, in an order of its own within the source
    rounds = F.when(F.col("__rounds") + F.col("__last").cast("long") > 0, F.sequence(F.lit(1).cast("long"), F.col("__rounds") + F.col("__last").cast("long")))
    draws = blocks.select("__sid", "__block", F.explode(rounds).alias("__round")).withColumn("__nth", F.row_number().over(Window.partitionBy("__sid").orderBy(F.xxhash64(F.lit(SEED + 2), "__sid", "__block", "__round"), "__block", "__round")) - 1)
    quota = cut(draws.groupBy("__sid").agg(F.count("*").alias("q")).agg(F.array_sort(F.collect_list(F.struct("__sid", "q"))).alias("qs")))
    leaves = split(quota.select(F.transform("qs", lambda x: x["q"]).alias("counts")), depth)
    sids = quota.select(F.posexplode(F.transform("qs", lambda x: x["__sid"])).alias("__pos", "__sid"))
    dealt = cut(leaves.select("shard", F.posexplode("counts").alias("__pos", "__count")).join(sids, "__pos"))
    so_far = F.coalesce(F.sum("__count").over(Window.partitionBy("__sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = dealt.withColumn("__from", so_far).where("__count > 0").select("__sid", "shard", F.explode(F.expr("sequence(__from, __from + __count - 1)")).alias("__nth"))
    placed = draws.join(places, ["__sid", "__nth"]).groupBy("__sid", "__block").agg(F.transform(F.array_sort(F.collect_list(F.struct("__round", "shard"))), lambda x: x["shard"]).alias("__shards"))
    table = cut(blocks.select("__sid", "__block", (F.col("__left") >= F.col("__words")).alias("__whole")).join(placed, ["__sid", "__block"], "left"), done=[quota, dealt])
    ending = blocks.where("__left > 0 and __left < __words").select("__sid", "__block", "__left")
    fitting = cut(_fitting(keyed, ending), done=[blocks])
    return sources, table, fitting


def _taken(sized: DataFrame, plan: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """sized (with doc_id, source and size) and source_size, target, copies, taken and shards (one for each copy)."""
    sources, table, fitting = plan
    once = fitting.withColumn("__fits", F.lit(True))
    joined = _keyed(sized, sources).join(table, ["__sid", "__block"]).join(once, ["__sid", "__h"], "left").withColumn("__more", F.coalesce("__whole", F.lit(False)) | F.coalesce("__fits", F.lit(False)))
    copies = (F.col("__rounds") + F.col("__more").cast("long")).cast("int")
    out = joined.withColumn("copies", copies).withColumns({"taken": F.col("size") * F.col("copies"), "shards": F.slice(F.coalesce("__shards", F.array().cast("array<bigint>")), F.lit(1), F.col("copies"))})
    return out.select(*sized.columns, "source_size", "target", "copies", "taken", "shards")


def mix(sized: DataFrame, depth: int | None = None) -> DataFrame:
    """sized (doc_id, source, size) and source_size, target, copies, taken and shards (one for each copy)."""
    return _taken(sized, plan(sized, depth))


def mixture(docs: DataFrame, depth: int | None = None) -> DataFrame:
    """The mixed corpus: a row for each copy, with shard, copy and position, by which the documents of a shard are in
    order; the rows of a shard come together and sorted."""
    kept = [c for c in docs.columns if c not in ("shard", "copy", "position")]
    # a document's own columns stay in one, so that their names cannot clash with those used here
    whole = with_size(docs.select(F.struct(*kept).alias("__doc"), "doc_id", "source", "text")).drop("text")
    sizes = cut(whole.drop("__doc"))
    mixed = _taken(whole, plan(sizes, depth))
    release(sizes)
    rows = mixed.select("__doc", "doc_id", F.posexplode("shards").alias("copy", "shard"))
    rows = rows.withColumn("position", F.xxhash64(F.lit(SEED + 3), "shard", "doc_id", "copy"))
    return rows.repartition("shard").sortWithinPartitions("shard", "position").select("__doc.*", "shard", "copy", "position")


def op10_mixing(documents: DataFrame) -> DataFrame:
    sized = cut(with_size(documents.select("doc_id", "source", "text")).drop("text"))
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken", F.size("shards").alias("copies"))
