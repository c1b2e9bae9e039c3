"""python -m loomtext ingest [--sites KEY ...] [--max-pages N] [--recreate] [--embed-backend NAME] | search --query TEXT [--k N] [--sites KEY ...]"""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging
import sys

from .config import Config, load_dotenv


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomtext")
    p.add_argument("--log-level", default="INFO")
    sub = p.add_subparsers(dest="command", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--sites", nargs="*")
    i.add_argument("--max-pages", type=int)
    i.add_argument("--recreate", action="store_true")
    i.add_argument("--embed-backend")
    s = sub.add_parser("search")
    s.add_argument("--query", required=True)
    s.add_argument("--k", type=int, default=5)
    s.add_argument("--sites", nargs="*")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=a.log_level)
    load_dotenv(".env")
    from pyspark.sql import SparkSession

    from .plans import pipeline

    spark = SparkSession.builder.appName("loomtext").getOrCreate()
    config = Config()
    try:
        if a.command == "ingest":
            if a.embed_backend:
                config = dataclasses.replace(config, embedding=dataclasses.replace(config.embedding, backend=a.embed_backend))
            print(json.dumps(pipeline.run(spark, sites=a.sites, max_pages=a.max_pages, recreate=a.recreate, config=config), ensure_ascii=False))
            return 0
        hits = pipeline.search(spark, a.query, a.k, a.sites, config).collect()
        for n, h in enumerate(hits, 1):
            print(f"[{n}] {h['similarity']:.4f} {h['source']} {h['title'] or ''}\n    {h['url']}\n    {h['text'][:220]}")
        if not hits:
            print("no results")
        return 0 if hits else 1
    except Exception:
        logging.exception("failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
