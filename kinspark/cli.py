"""Command line: `python -m kinspark.cli evaluate|validate|candidates|train|match ...` on tab-separated files."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import normalize as N
from .functions import text as T
from .operators import blocking as B
from .operators import cascade as C
from .operators import files as X
from .operators import matching as M
from .sources import views as V
from .sources.state import cut, exists

MATCHES, CANDIDATES = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")


def lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids, ordinal) of an id-list file with a header, ids as text, ordinal by the file's order."""
    raw = spark.read.schema("s1_id string, ids string").option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return raw.select("s1_id", F.coalesce("ids", F.lit("")).alias("ids"), V.file_order().alias("ordinal"))


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Record files with normalised names and addresses, written once as plans read them often; the source is in the id.
    Of a repeated id the last row counts."""
    out = V.read_source(spark, paths[0], order=True)
    for p in paths[1:]:
        out = out.unionByName(V.read_source(spark, p, order=True))
    clean = N.with_clean(X.last_of_each(out))
    made = clean.select("entity_id", F.col("name_clean").alias("business_name"), F.col("address_clean").alias("business_address"), "country", F.substring("entity_id", 1, 2).alias("source"), "ordinal")
    return cut(made)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> dict:
    truth = V.id_lists(lists(spark, args.truth), "s1_id", "ids")
    found = lists(spark, args.found)
    got = V.id_lists(found, "s1_id", "ids", "ordinal").select("s1_id", F.col("ids").alias("got"), "ordinal")
    return M.report(truth, got).first().asDict()


def validate(spark: SparkSession, args: argparse.Namespace) -> dict:
    if not exists(spark, args.found):
        return {"missing_file": {"severity": "error", "n": 1, "examples": args.found}}
    reference = V.read_source(spark, args.reference).select(F.col("entity_id").alias("s1_id"))
    found = lists(spark, args.found).drop("ordinal")
    lines = spark.read.text(args.found).select(F.monotonically_increasing_id().alias("n"), "value")
    issues = M.validate(found, reference).unionByName(X.line_faults(lines, CANDIDATES if args.lists == "candidates" else MATCHES))
    if args.known:
        ids = [X.ids_of(V.read_source(spark, p)) for p in args.known]
        known = ids[0]
        for other in ids[1:]:
            known = known.unionByName(other)
        issues = issues.unionByName(X.unknown_ids(found, known))
    if args.candidates:
        issues = issues.unionByName(X.outside_candidates(found, lists(spark, args.candidates)))
    return {r.rule: {"severity": r.severity, "n": r.n, "examples": r.examples} for r in X.examples(issues).collect()}  # a row for each rule


def candidates(spark: SparkSession, args: argparse.Namespace) -> dict:
    r = records(spark, args.sources)
    write(X.ranked_lists(B.generate(r, top=args.top), reference(r)), args.out, CANDIDATES)
    return {"written": args.out}


def reference(r: DataFrame) -> DataFrame:
    return r.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "ordinal")


def train(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Fit the cascade's forest on the candidates of records whose matches are known, and save it."""
    r = records(spark, args.sources)
    truth = V.id_lists(lists(spark, args.truth), "s1_id", "ids").select("s1_id", F.explode("ids").alias("cid")).distinct()
    features = cut(C.ten_features(B.generate(r, top=args.top).select("s1_id", "cid"), r))
    model = C.fit(features, truth)
    if model is None:
        return {"written": None, "why": "the candidates hold one class only"}
    model.write().overwrite().save(args.out)
    return {"written": args.out}


def model_of(spark: SparkSession, paths: list[str]) -> RandomForestClassificationModel | None:
    """The model at the first of the paths that exists."""
    found = next((p for p in paths if exists(spark, p)), None)
    return RandomForestClassificationModel.load(found) if found else None


def match(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Scored pairs are read from the cache where it exists, and written there otherwise. Without a model only pairs
    that need none are matched."""
    r = records(spark, args.sources)
    if args.cache and exists(spark, args.cache):
        scored = spark.read.parquet(args.cache)
    else:
        features = cut(C.ten_features(B.generate(r, top=args.top).select("s1_id", "cid"), r))
        scored = C.score(features, model_of(spark, args.model))
        if args.cache:
            scored.write.parquet(args.cache)
            scored = spark.read.parquet(args.cache)
    ok = scored.where(T.passes(F.col("prob"), F.col("digit_status"), F.col("country"), args.confirm, args.absent))
    taken = M.assign_greedy(ok).groupBy("s1_id").agg(F.collect_set("cid").alias("c"))
    lists_ = reference(r).join(taken, "s1_id", "left").select("s1_id", F.coalesce(F.array_join(F.array_sort("c"), ","), F.lit("")).alias("ids"), "ordinal")
    write(lists_.orderBy("ordinal"), args.out, MATCHES)
    return {"written": args.out}


def write(ordered: DataFrame, path: str, header: tuple[str, str]) -> None:
    """One line for each reference record, in its file's order; an existing file stays and is an error."""
    out = ordered.select(F.col("s1_id").alias(header[0]), F.col("ids").alias(header[1]))
    out.write.option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kinspark")
    sub = parser.add_subparsers(dest="what", required=True)
    e = sub.add_parser("evaluate", help="macro F0.5 of matches against the truth")
    e.add_argument("truth")
    e.add_argument("found")
    e.add_argument("-v", "--verbose", action="store_true", help="all figures")
    e.add_argument("-q", "--quiet", action="store_true", help="the macro F0.5 alone")
    e.add_argument("--json", action="store_true")
    v = sub.add_parser("validate", help="faults of an id-list file")
    v.add_argument("found")
    v.add_argument("reference")
    v.add_argument("--lists", choices=("matches", "candidates"), default="matches", help="what the file lists, by which its header is known")
    v.add_argument("--known", nargs="*", default=[], help="record files whose ids may be listed")
    v.add_argument("--candidates", help="the candidate file that matches should lie in")
    about = {"candidates": "candidates of each reference record", "train": "fit the model that scores pairs", "match": "matches of each reference record"}
    for name, told in about.items():
        p = sub.add_parser(name, help=told)
        p.add_argument("sources", nargs="+")
        p.add_argument("--out", required=True)
        p.add_argument("--top", type=int, default=12)
        if name == "train":
            p.add_argument("--truth", required=True)
        if name == "match":
            p.add_argument("--confirm", type=float, default=0.78)
            p.add_argument("--absent", type=float, default=0.86)
            p.add_argument("--model", nargs="*", default=[], help="where the model may be; the first that exists is taken")
            p.add_argument("--cache", help="Parquet file of scored pairs")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("kinspark").getOrCreate()
    result = {"evaluate": evaluate, "validate": validate, "candidates": candidates, "train": train, "match": match}[args.what](spark, args)
    if args.what != "evaluate" or args.json:
        print(json.dumps(result, indent=2))
    elif args.quiet:
        print(f"{result['macro_f05']:.6f}")
    else:
        shown = result if args.verbose else {k: result[k] for k in ("total_ground_truth_entities", "macro_f05", "macro_precision", "macro_recall")}
        print("\n".join(f"{k}\t{x}" for k, x in shown.items()))
    return int(args.what == "validate" and any(x["severity"] == "error" for x in result.values()))


if __name__ == "__main__":
    sys.exit(main())
