"""The command line: `python -m kgspark ingest|version|info`.

Exit codes: 0 done, 1 done with failed documents, failed chunks or flagged relations, 2 wrong use.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

VERSION = "0.3"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="kgspark")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("version", help="print the version")
    commands.add_parser("info", help="say what there is")
    one = commands.add_parser("ingest", help="markdown folders to a version of the graph")
    one.add_argument("--flat-dir", help="folder of files whose names have all segments")
    one.add_argument("--nested-dir", help="folder whose subfolders are the segments")
    one.add_argument("--flat-repo", default="corpus-a")
    one.add_argument("--nested-repo", default="corpus-b")
    one.add_argument("--home", default="graph-home", help="folder of the cache, the versions and the reports")
    one.add_argument("--backend", default="rules")
    one.add_argument("--prompt-version", default="v0")
    one.add_argument("--master", help="Spark master; that of spark-submit if not given")
    return parser


def main(arguments: Sequence[str] | None = None) -> int:
    try:
        given = _parser().parse_args(arguments)
    except SystemExit as stop:
        return int(stop.code or 0)
    if given.command == "version":
        print(VERSION)
        return 0
    from kgspark.operators import extraction
    from kgspark.plans import corpus_run, ingest

    extraction.register_backend("rules", ingest.RuleBackend)
    if given.command == "info":
        print(f"kgspark {VERSION}\nbackends: {', '.join(extraction.backends())}")
        return 0
    sources = [(d, r, layout) for d, r, layout in ((given.flat_dir, given.flat_repo, "flat"), (given.nested_dir, given.nested_repo, "nested")) if d]
    if not sources:
        print("error: give --flat-dir or --nested-dir", file=sys.stderr)
        return 2
    try:
        make = extraction.backend_maker(given.backend)
    except ValueError as wrong:
        print(f"error: {wrong}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("kgspark ingest")
    spark = (builder.master(given.master) if given.master else builder).getOrCreate()
    try:
        told = corpus_run.ingest_folders(spark, sources, given.home, make, given.prompt_version)
    except FileNotFoundError as wrong:
        print(f"error: {wrong}", file=sys.stderr)
        return 2
    print(f"[{told['run_id']}] {told['version']}")
    print(f"  docs={told['docs_canonicalized']} (errors={told['docs_failed']}) new={told['docs_new']} changed={told['docs_changed']} deleted={told['docs_deleted']}")
    print(f"  chunks={told['chunks_total']} extracted={told['chunks_extracted']} cached={told['chunks_cache_hits']} failed={told['chunks_failed']} cost=${told['cost_usd']:.4f}")
    print(f"  chunk_grounding={told['chunk_grounding_rate']:.3f} span_grounding={told['evidence_grounding_rate']:.3f} types_ok={told['predicate_type_ok_rate']:.3f} flagged={told['flagged_count']}/{told['n_relationships_scored']}")
    for line in told["canonicalization_errors"]:
        print(f"  {line}", file=sys.stderr)
    return 1 if told["docs_failed"] or told["chunks_failed"] or told["flagged_count"] else 0
