"""Command line of the embedding runs: ``python -m postloom embed|api-embed ...``."""

from __future__ import annotations

import argparse
import importlib

from postloom.operators.stats import MAX_TOKENS
from postloom.plans.embedding import api_embedding_run, embedding_run
from postloom.session import build_session
from postloom.sources.tables import with_file_order


def _factory(name: str | None):
    """``package.module:factory`` -> the factory."""
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="postloom")
    commands = parser.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--postings", required=True, help="parquet table of postings")
    common.add_argument("--output", required=True, help="embedding table or file")
    common.add_argument("--order-by", nargs="+", help="columns that order the rows of an id; default: place in the files")
    common.add_argument("--encoder", help="package.module:factory; default: hashing encoder")
    common.add_argument("--tokenizer", help="package.module:factory; default: words")
    common.add_argument("--max-tokens", type=int, default=MAX_TOKENS)
    common.add_argument("--dim", type=int, default=64, help="length of hashed vectors")
    embed = commands.add_parser("embed", parents=[common], help="embed what is above the watermark")
    embed.add_argument("--watermark", required=True, help="control table of the mark")
    embed.add_argument("--kind", choices=("query", "passage"), default="query")
    embed.add_argument("--report", help="table of run reports")
    api = commands.add_parser("api-embed", parents=[common], help="embed all postings, unprefixed")
    api.add_argument("--sink", choices=("parquet", "csv", "collection"), default="parquet")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    postings = spark.read.parquet(args.postings)
    if not args.order_by:
        postings = with_file_order(postings)
    order_by = args.order_by or ["file_order"]
    hooks = {"encoder": _factory(args.encoder), "tokenizer": _factory(args.tokenizer)}
    if args.command == "embed":
        print(embedding_run(
            spark, postings, args.output, args.watermark, order_by=order_by, max_tokens=args.max_tokens, kind=args.kind, dim=args.dim,
            report_path=args.report, **hooks))
    else:
        api_embedding_run(postings, args.output, args.sink, order_by=order_by, max_tokens=args.max_tokens, dim=args.dim, **hooks)


if __name__ == "__main__":
    main()
