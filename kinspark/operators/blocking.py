"""Blocking: keys, bucket policy, candidate priority and top-k, as joins and windows.

Keys and tokens are made once for each record. A bucket's size is counted before the
join, so oversize buckets never meet, and large ones keep a bounded number for each key
of a reference record. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import text as T
from ..functions.words import BRANCH_WEIGHTS

CAP, LARGE_CAP, TAKE = 25, 200, 2
PREFIX_CAP, PREFIX_LARGE_CAP, PREFIX_TAKE = 8, 100, 1
PREFIX = "state+prefix3"


def prepared(records: DataFrame) -> DataFrame:
    """records with tokens, state and postal code."""
    return records.withColumns({
        "name_toks": T.sig_tokens(N.transliterate(F.col("business_name"))), "addr_toks": T.key_addr_tokens(F.col("business_address")),
        "st": T.state_code(F.col("business_address"), F.col("country")), "pin": T.postal_code(F.col("business_address"), F.col("country")),
    })


def keys(p: DataFrame) -> DataFrame:
    """(entity_id, key_pos, pass, branch, key): up to eight keys of a prepared record, repeats kept."""
    t0, t1 = F.get("name_toks", F.lit(0)), F.get("name_toks", F.lit(1))
    st, pin, c = F.col("st"), F.col("pin"), F.col("country")
    long_addr = F.slice(F.filter("addr_toks", lambda x: F.length(x) >= 5), 1, 2)

    def key(number: int, branch: str, when: Column, *parts: Column | str) -> Column:
        name = F.concat_ws("_", c, *[F.lit(x) if isinstance(x, str) else x for x in parts])
        return F.when(F.coalesce(when, F.lit(False)) & (c != ""), F.struct(F.lit(number).alias("pass"), F.lit(branch).alias("branch"), name.alias("key")))

    made = F.array(
        key(1, "state+token", (st != "") & t0.isNotNull(), "ST", st, t0),
        key(2, "state+token", (st != "") & (F.length(t1) >= 3), "ST", st, t1),
        key(3, "2tok_conjunction", t1.isNotNull(), "2TOK", F.least(t0, t1), F.greatest(t0, t1)),
        key(4, PREFIX, (st != "") & (F.length(t0) >= 3), "ST_PRE3", st, F.substring(t0, 1, 3)),
        key(5, "state+addr_token", (st != "") & F.get(long_addr, F.lit(0)).isNotNull(), "ADDR", st, F.get(long_addr, F.lit(0))),
        key(5, "state+addr_token", (st != "") & F.get(long_addr, F.lit(1)).isNotNull(), "ADDR", st, F.get(long_addr, F.lit(1))),
        key(6, "pin+prefix", (pin != "") & t0.isNotNull(), "PIN", pin, F.substring(t0, 1, 3)),
        key(7, "country+token_fallback", (st == "") & (F.length(t0) >= 4), "TOK", t0),
    )
    return p.select("entity_id", F.posexplode(F.filter(made, lambda k: k.isNotNull())).alias("key_pos", "k")).select("entity_id", "key_pos", "k.*")


def buckets(index: DataFrame) -> DataFrame:
    """(key, n): entries of each bucket, repeats counted."""
    return index.groupBy("key").agg(F.count("*").alias("n"))


def _cap(prefix: int, other: int) -> Column:
    return F.when(F.col("branch") == PREFIX, prefix).otherwise(other)


def probes(reference: DataFrame, index: DataFrame) -> DataFrame:
    """Keys of reference records with their bucket's size, oversize ones dropped."""
    return reference.join(buckets(index), "key").where(F.col("n") <= _cap(PREFIX_LARGE_CAP, LARGE_CAP))


def hits(reference: DataFrame, index: DataFrame, tokens: DataFrame) -> DataFrame:
    """(s1_id, cid, branch, spec) for every admitted entry of every key."""
    asked = probes(reference, index).withColumnRenamed("entity_id", "s1_id")
    small = asked.where(F.col("n") <= _cap(PREFIX_CAP, CAP))
    large = asked.where(F.col("n") > _cap(PREFIX_CAP, CAP))
    entries = index.select("key", F.col("entity_id").alias("cid"))
    admitted = small.join(entries, "key").select("s1_id", "cid", "branch", (1 / F.sqrt("n")).alias("spec"))
    toks = lambda side: tokens.select(F.col("entity_id").alias(side), F.col("name_toks").alias(f"n_{side}"), F.col("addr_toks").alias(f"a_{side}"))
    met = large.join(entries, "key").join(toks("s1_id"), "s1_id").join(toks("cid"), "cid")
    names, addrs = F.size(F.array_intersect("n_s1_id", "n_cid")), F.size(F.array_intersect("a_s1_id", "a_cid"))
    scored = met.select("s1_id", "key_pos", "cid", "branch", names.alias("ov"), addrs.alias("av")).where("ov >= 1 or av >= 2")
    rank = F.row_number().over(Window.partitionBy("s1_id", "key_pos").orderBy(F.desc(F.col("ov") * 2.0 + F.col("av")), F.desc("cid")))
    chosen = scored.withColumn("rank", rank).where(F.col("rank") <= _cap(PREFIX_TAKE, TAKE)).select("s1_id", "cid", "branch", F.lit(0.1).alias("spec"))
    return admitted.unionByName(chosen)


def candidates(found: DataFrame, tokens: DataFrame, top: int = 12) -> DataFrame:
    """(s1_id, cid, score, rank): the top candidates of each reference record by priority."""
    merged = found.groupBy("s1_id", "cid").agg(F.collect_set("branch").alias("branches"), F.sum("spec").alias("spec"))
    toks = lambda side: tokens.select(F.col("entity_id").alias(side), F.array_distinct("name_toks").alias(f"n_{side}"), F.array_distinct("addr_toks").alias(f"a_{side}"))
    met = merged.join(toks("s1_id"), "s1_id").join(toks("cid"), "cid")
    weights = F.create_map(*[F.lit(x) for kv in BRANCH_WEIGHTS.items() for x in kv])
    branch = F.aggregate("branches", F.lit(0.0), lambda a, b: a + F.element_at(weights, b)) + 3.0 * (F.size("branches") - 1)
    both = lambda k: F.size(F.array_intersect(f"{k}_s1_id", f"{k}_cid"))
    share = lambda k: both(k) / F.greatest(F.lit(1), F.size(F.array_union(f"{k}_s1_id", f"{k}_cid")))
    score = branch + F.least(F.lit(3.0), "spec") + share("n") * 4.0 + both("n") * 1.5 + share("a") * 2.5 + both("a") * 0.8
    scored = met.select("s1_id", "cid", F.round(score, 9).alias("score"))
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("score"), F.desc("cid")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def generate(records: DataFrame, top: int = 12) -> DataFrame:
    """Candidates of the records of source S1 among the others."""
    p = prepared(records)
    ref, vendors = p.where("source = 'S1'"), p.where("source <> 'S1'")
    tokens = p.select("entity_id", "name_toks", "addr_toks")
    return candidates(hits(keys(ref), keys(vendors), tokens), tokens, top)


def intersect_capped(records: DataFrame, cap: int = 100) -> DataFrame:
    """Pairs that share a key, of the first cap records of either side of each bucket by ordinal."""
    p = prepared(records)
    held = keys(p).select("entity_id", "key").distinct().join(p.select("entity_id", "source", "ordinal"), "entity_id")
    side = lambda d, name: d.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("ordinal"))).where(F.col("r") <= cap).select("key", F.col("entity_id").alias(name))
    return side(held.where("source = 'S1'"), "s1_id").join(side(held.where("source <> 'S1'"), "cid"), "key").select("s1_id", "cid").distinct()


def three_index(records: DataFrame, bucket: int = 30, keep: int = 8) -> DataFrame:
    """Candidates by word, number, and postal code with prefix; the first ones of each bucket, in order of index, key and file."""
    p = records.withColumns({
        "word": T.blocking_word(F.col("business_name")), "nums": F.filter(T.number_set(F.col("business_address")), lambda x: (F.length(x) >= 2) & (F.length(x) <= 6)),
        "posts": T.postal_codes(F.col("business_address"), F.col("country")), "pre": T.prefix3(F.col("business_name")),
    })
    made = F.concat(
        F.when(F.col("word") != "", F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("pos"), F.col("word").alias("k")))).otherwise(F.array().cast("array<struct<kind:int,pos:int,k:string>>")),
        F.transform("nums", lambda x, i: F.struct(F.lit(1).alias("kind"), i.cast("int").alias("pos"), x.alias("k"))),
        F.transform("posts", lambda x, i: F.struct(F.lit(2).alias("kind"), i.cast("int").alias("pos"), F.concat_ws("_", x, "pre").alias("k"))),
    )
    held = p.select("entity_id", "source", "country", "ordinal", F.explode(made).alias("m")).select("entity_id", "source", "country", "ordinal", "m.*")
    vendor = held.where("source <> 'S1'").groupBy("country", "kind", "k", "entity_id", "ordinal").agg(F.lit(1).alias("one"))
    first = F.row_number().over(Window.partitionBy("country", "kind", "k").orderBy("ordinal"))
    index = vendor.withColumn("at", first).where(F.col("at") <= bucket).select("country", "kind", "k", "at", F.col("entity_id").alias("cid"))
    met = held.where("source = 'S1'").join(index, ["country", "kind", "k"]).groupBy(F.col("entity_id").alias("s1_id"), "cid").agg(F.min(F.struct("kind", "pos", "at")).alias("o"))
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy("o"))
    return met.withColumn("rank", rank).where(F.col("rank") <= keep).select("s1_id", "cid", "rank")
