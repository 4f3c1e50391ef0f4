"""Command line: python -m glyphmill.plans.cli JOB --input PATH --output PATH."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from glyphmill.functions.predicates import UnitRules
from glyphmill.operators import sampling
from glyphmill.plans import builders, pipelines
from glyphmill.sources import readers, writers
from glyphmill.sources.config import load_config, nested


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="glyphmill")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=about)
        one.add_argument("--input", required=True)
        one.add_argument("--output", required=True)
        one.add_argument("--config")
        return one

    clean = job("clean-text", "texts cut to units, with prompts and attributes for a renderer")
    clean.add_argument("--max-units", type=int, default=80)
    pages = job("interleave", "pages of interleaved documents")
    pages.add_argument("--width", type=int, default=1024)
    pages.add_argument("--height", type=int, default=1024)
    for one in (clean, pages):
        one.add_argument("--limit", type=int)
        one.add_argument("--seed", type=int, default=0)
    ocr = job("filter-ocr", "valid samples of OCR records, without copies")
    ocr.add_argument("--subset", default=pipelines.OCR_SUBSET)
    ocr.add_argument("--keep-copies", action="store_true")
    spans = job("pages", "page texts of spans that were extracted before (JSONL)")
    spans.add_argument("--max-pages", type=int)
    build = job("build", "samples or pairs of a subset that needs no service, of prepared records")
    build.add_argument("kind", choices=("words", "papers", "slides"))
    build.add_argument("--pairs", action="store_true", help="bilingual pairs (slides only: the others need a translation service, see plans.builders)")
    build.add_argument("--source", default="records")
    build.add_argument("--seed", type=int, default=20260428)
    for name in ("pack", "pack-pairs"):
        job(name, "one dataset of samples").add_argument("--format", default="jsonl", choices=("jsonl", "parquet", "webdataset"))
    for name in ("eval-split", "eval-pairs"):
        split = jobs.add_parser(name, help="stratified evaluation split of sample files")
        for key in sampling.EVAL_PLAN:
            split.add_argument(f"--{key}", nargs="+", metavar="PATH")
        split.add_argument("--subset", help="source subset of all inputs, in place of the plan's names")
        split.add_argument("--output", required=True)
        split.add_argument("--seed", type=int, default=20260428)
    return top


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> int:
    given = {key: getattr(args, key) for key in sampling.EVAL_PLAN if getattr(args, key)}
    if not given:
        raise SystemExit("an evaluation split needs at least one of: " + ", ".join(f"--{key}" for key in sampling.EVAL_PLAN))
    pairs = args.job == "eval-pairs"
    plan = sampling.PAIR_PLAN if pairs else sampling.EVAL_PLAN
    plan = {key: (args.subset or name, strategy, n) for key, (name, strategy, n) in plan.items()}

    def read(paths: list[str]):
        out = None
        for path in paths:
            rows = spark.read.json(path) if pairs else readers.samples(spark, path)
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    inputs = {key: read(paths) for key, paths in given.items()}
    if not pairs:
        return writers.write_jsonl(sampling.eval_split(inputs, args.seed, plan).drop("line"), args.output)
    picked = sampling.pair_eval_split(inputs, args.seed, plan)
    writers.write_jsonl(sampling.pair_review(picked), f"{args.output}/review")
    return writers.write_pairs(picked, args.output)


SPANS = "path string, page int, ord long, x0 double, y0 double, x1 double, y1 double, text string, font string, size double, color int"
ELEMENTS = "path string, page int, ord long, kind string, x0 double, y0 double, x1 double, y1 double, text string, font string, size double, caption string"


def _build(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.pairs and args.kind != "slides":
        raise SystemExit(f"pairs of {args.kind} need a translation service: call glyphmill.plans.builders")
    if args.kind == "words":
        rows = builders.long_words(readers.ocr_line_records(spark, args.input), args.source, args.seed)
    elif args.kind == "papers":
        rows = builders.papers(readers.paper_pages(spark.read.schema(SPANS).json(args.input)))
    else:
        pages = readers.slide_pages(spark.read.schema(ELEMENTS).json(args.input))
        rows = builders.slide_pairs(pages) if args.pairs else builders.slides(pages)
    return writers.write_pairs(rows, args.output) if args.pairs else writers.write_jsonl(rows, args.output)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"glyphmill-{args.job}").getOrCreate()
    config = load_config(getattr(args, "config", None))
    if args.job in ("eval-split", "eval-pairs"):
        n = _evaluate(spark, args)
    elif args.job == "build":
        n = _build(spark, args)
    elif args.job == "clean-text":
        n = writers.write_jsonl(pipelines.clean_texts(readers.texts(spark, args.input), args.seed, args.max_units, args.limit).drop("line"), args.output)
    elif args.job == "interleave":
        rows = readers.documents(spark, args.input)
        rows = sampling.first_n(rows, "line", args.limit) if args.limit else rows
        margin, units = nested(config, "interleave.margin", 48), nested(config, "interleave.max_text_units_per_box", 80)
        n = writers.write_jsonl(pipelines.interleaved_pages(rows, args.seed, args.width, args.height, margin, units), args.output)
    elif args.job == "filter-ocr":
        names = {"min_units": "min_units", "min_unique_ratio": "min_unique_ratio", "max_consecutive_repeat": "max_run", "min_cjk_ratio": "min_cjk_ratio"}
        rules = UnitRules(**{ours: config["filter"][theirs] for theirs, ours in names.items() if theirs in nested(config, "filter", {})})
        records = readers.ocr_records(spark, args.input).drop("raw")
        n = writers.write_jsonl(pipelines.filter_ocr(records, args.subset, rules, deduplicate=not args.keep_copies).drop("line"), args.output)
    elif args.job == "pages":
        spans = "path string, page int, x0 double, y0 double, x1 double, y1 double, text string, font string, size double, color int"
        n = writers.write_jsonl(readers.page_texts(spark.read.schema(spans).json(args.input), most_pages=args.max_pages), args.output)
    else:
        rows = spark.read.json(args.input)
        n = writers.pack_pairs(rows, args.output, args.format) if args.job == "pack-pairs" else writers.pack(rows, args.output, args.format)
    print(f"{n} rows written to {args.output}")
    return n


if __name__ == "__main__":
    main()
