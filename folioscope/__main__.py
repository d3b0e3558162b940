"""Command line: ``python -m folioscope <command> ...``; every command is a call of ``folioscope.api``."""

from __future__ import annotations

import argparse
import os
import sys
from pathlib import Path


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioscope", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *arguments: tuple) -> None:
        sub = commands.add_parser(name, help=text)
        for names, options in arguments:
            sub.add_argument(*names, **options)

    def path(name: str, **options) -> tuple:
        return ((name,), options)

    out = (("--out",), {"required": True, "help": "folder of the output"})
    column = (("--column",), {"default": "text"})
    add("evaluate", "scores and report of a run's results", path("results"), (("--truths",), {}), (("--key",), {"default": "sample_index"}), (("--furniture",), {}), (("--model",), {"default": ""}), (("--dataset",), {"default": ""}), out)
    add("evaluate-checkpoint", "the same from a checkpoint, whose run must be the one named", path("checkpoint"), *(((f"--{c}",), {"required": True}) for c in ("dataset", "split", "model", "backend")), out)
    add("leaderboard", "leaderboards of the reports below a folder", path("reports"), (("--metric",), {}), out)
    add("compare", "runs beside each other", path("reports"), out)
    add("summary", "main metric of each run", path("reports"))
    add("rank-correlation", "how well scores order the models as other scores do", path("synthetic"), path("real"), (("--aliases",), {}), (("--confidence",), {"type": float, "default": 0.95}), (("--draws",), {"type": int, "default": 2000}), out)
    add("text-stats", "text statistics of a table", path("texts"), column, (("--by",), {"nargs": "*", "default": []}), (("--prose",), {"action": "store_true"}), out)
    add("gap", "gap of the text statistics of two tables", path("reference"), path("candidate"), column, out)
    add("discriminate", "how well the texts of two tables are told apart", path("reference"), path("candidate"), column, out)
    add("import-wikitext", "titles and paragraphs of a wiki dump", path("lines"), out)
    add("publish", "samples in one form, parted, with a card", path("samples"), (("--name",), {"required": True}), (("--key",), {"required": True}), (("--test-share",), {"type": float, "default": 0.1}), (("--dry-run",), {"action": "store_true"}), out)
    add("profile", "presence, lengths and numbers of a table's fields", path("samples"), out)
    add("generate", "synthetic pages", (("--size",), {"type": int, "required": True}), (("--words",), {"required": True, "help": "text file, a word or phrase a line"}), (("--shard-size",), {"type": int, "default": 1000}), (("--seed",), {"type": int, "default": 42}), out)
    add("list-operators", "modules and their operators")
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    if args.command == "list-operators":
        import inspect
        from importlib import import_module

        for name in ("corpus", "evaluation", "generation", "ground_truth", "measure", "neighbours", "profiling", "schema_drift", "scores", "summary", "tables_generation"):
            module = import_module(f"folioscope.operators.{name}")
            own = [f for f, v in vars(module).items() if inspect.isfunction(v) and v.__module__ == module.__name__ and not f.startswith("_")]
            print(f"{name}: {', '.join(own)}")
        return 0

    from pyspark.sql import SparkSession

    from folioscope import api
    from folioscope.operators import evaluation
    from folioscope.sources import readers, reports

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"
    spark = SparkSession.builder.appName(f"folioscope {args.command}").getOrCreate()
    read = lambda p: api.read(spark, p)
    if args.command == "evaluate":
        config = {"model": args.model, "dataset_id": args.dataset, "results": args.results}
        print(api.evaluate_to(read(args.results), args.out, config, truths=read(args.truths) if args.truths else None, key=args.key, furniture=args.furniture))
    elif args.command == "evaluate-checkpoint":
        context = {"dataset_id": args.dataset, "split": args.split, "model_id": args.model, "backend": args.backend}
        print(api.evaluate_to(evaluation.checkpoint(spark, args.checkpoint, context), args.out, context))
    elif args.command == "leaderboard":
        print(api.leaderboard_to(api.runs_of(spark, args.reports), args.out, args.metric))
    elif args.command == "compare":
        print(api.compare_to(api.runs_of(spark, args.reports), args.out))
    elif args.command == "summary":
        rows = reports.every(evaluation.summary_entries(api.runs_of(spark, args.reports)), ["language", "model_id"])
        print(reports.markdown(rows, list(rows[0]) if rows else ["model_id"]))
    elif args.command == "rank-correlation":
        page = api.rank_correlation(readers.scores(spark, args.synthetic), readers.scores(spark, args.real), read(args.aliases) if args.aliases else None, args.confidence, args.draws)
        reports.save(Path(args.out) / "rank_correlation.md", page)
        print(page)
    elif args.command == "text-stats":
        api.text_statistics(read(args.texts), args.column, args.by, args.prose).write.mode("overwrite").json(args.out)
    elif args.command in ("gap", "discriminate"):
        make = api.gap_report if args.command == "gap" else api.discriminate
        page = make(read(args.reference), read(args.candidate), (args.reference, args.candidate), args.column)
        reports.save(Path(args.out) / f"{args.command}.md", page)
        print(page)
    elif args.command == "import-wikitext":
        api.import_wikitext(spark.read.text(args.lines), args.out)
    elif args.command == "publish":
        print(api.publish(read(args.samples), args.out, args.name, args.key, args.test_share, args.dry_run))
    elif args.command == "profile":
        print(api.profile(read(args.samples), args.out))
    elif args.command == "generate":
        from folioscope.operators.generation import generate_pages

        words = [w for w in Path(args.words).read_text(encoding="utf-8").splitlines() if w.strip()]
        readers.write_shards(generate_pages(spark, args.size, words, shard_size=args.shard_size, seed=args.seed), args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
