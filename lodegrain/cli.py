"""Command line: prepare records, load a collection, search it.

    python -m lodegrain.cli prepare --works W --abstracts A --sources S --out OUT
    python -m lodegrain.cli load --records OUT --collection C
    python -m lodegrain.cli search --collection C -q "some words" [--keyword] [--queries FILE]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession, functions as F

from lodegrain.functions.ids import numeric_id
from lodegrain.operators import models, predicates, projections
from lodegrain.plans import engine, prepare
from lodegrain.settings import Settings
from lodegrain.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lodegrain", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    to = top.add_subparsers(dest="command", required=True)
    p = to.add_parser("prepare")
    for name in ("works", "abstracts", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--sources")
    p.add_argument("--years", type=lambda x: tuple(int(y) for y in x.split(",")))
    p.add_argument("--rows-per-part", type=int)
    p = to.add_parser("load")
    p.add_argument("--records", required=True)
    p.add_argument("--collection", required=True)
    p.add_argument("--dim", type=int, default=64)
    p.add_argument("--recreate", action="store_true")
    p.add_argument("--yes", action="store_true", help="confirms --recreate")
    p = to.add_parser("search")
    p.add_argument("--collection", required=True)
    p.add_argument("-q", "--query", action="append", default=[])
    p.add_argument("--queries")
    p.add_argument("--keyword", action="store_true")
    p.add_argument("--phrase", action="store_true")
    p.add_argument("--limit", type=int, default=10)
    p.add_argument("--candidates", type=int, default=50)
    p.add_argument("--no-rerank", action="store_true")
    p.add_argument("--keyword-rerank", action="store_true", help="rerank keyword hits, which are in key order otherwise")
    p.add_argument("--hnsw-ef", type=int, default=64, help="search width of the index")
    p.add_argument("--rescore", action="store_true", help="score int8 candidates again in full precision")
    p.add_argument("--full", action="store_true", help="whole abstracts in place of their beginnings")
    p.add_argument("--meta", action="store_true", help="counts and times with the results")
    p.add_argument("--json", action="store_true", help="results as JSON, as without --text")
    p.add_argument("--text", action="store_true", help="text to read in place of JSON")
    p.add_argument("--interactive", action="store_true", help="ask for queries until an empty line")
    p.add_argument("--no-dedupe", action="store_true")
    p.add_argument("--raw", action="store_true")
    p.add_argument("--dim", type=int, default=64)
    for name in ("field", "subfield", "domain", "topic", "source", "type", "country"):
        p.add_argument(f"--{name}")
    for name in ("year", "year-from", "year-to"):
        p.add_argument(f"--{name}", type=int)
    p.add_argument("--out")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lodegrain").getOrCreate()
    if args.command == "prepare":
        base = Settings.from_env()
        years, rows = args.years or base.years, args.rows_per_part or base.rows_per_part
        chosen = Settings(years=years, rows_per_part=rows, attach_country=bool(args.sources))
        works, abstracts = (readers.check_folder(spark, p) for p in (args.works, args.abstracts))
        made = prepare.prepare(readers.works(spark, works), readers.abstracts(spark, abstracts), readers.sources(spark, args.sources) if args.sources else None, chosen)
        writers.write_records(made, args.out, chosen.rows_per_part)
        return 0
    if args.command == "load":
        held = writers.Collection(spark, args.collection, dim=args.dim)
        if args.recreate:
            held.recreate(confirm=args.yes)
        elif not held.meta:
            held.create(embedding_model=models.HashingEmbedder.__name__)
        payload = projections.to_payload(readers.records(spark, args.records).drop("year", "part"))
        embedded = payload.filter(F.trim("abstract") != "").withColumn("embedding", models.embed(F.col("abstract"), lambda: models.HashingEmbedder(args.dim)))
        held.upsert(projections.to_points(models.check_vectors(embedded, args.dim, key="openalex_id")))
        print(held.describe())
        return 0
    queries = readers.queries_from(spark, args.queries, args.query)
    if not queries and not args.interactive:
        print("no query given", file=sys.stderr)
        return 2
    held = writers.Collection(spark, args.collection, dim=args.dim)
    points = held.read()
    if points is None:
        print("the collection is empty", file=sys.stderr)
        return 1
    points = points.withColumn("vec_id", F.coalesce(numeric_id(F.col("openalex_id")), F.xxhash64("point_id")))
    found = engine.Engine(points, lambda: models.HashingEmbedder(args.dim), models.OverlapReranker)
    filters = predicates.Filters(**{k: getattr(args, k) for k in ("field", "subfield", "domain", "topic", "source", "type", "country", "year", "year_from", "year_to")})

    def answer(queries: list[str]) -> list[dict]:
        if args.keyword:
            return [x for q in queries for x in found.respond(engine.KeywordRequest(q, filters, args.limit, args.phrase, not args.no_dedupe, args.keyword_rerank, args.raw))]
        requests = [engine.SearchRequest(tuple(queries[i : i + 32]), filters, args.limit, args.candidates, not args.no_rerank, not args.no_dedupe, args.raw, args.hnsw_ef, args.rescore) for i in range(0, len(queries), 32)]
        return [x for r in requests for x in found.respond(r)]

    def shown(answers: list[dict], text: bool = args.text and not args.json) -> str:
        if not text:
            return "\n".join(json.dumps(x if args.meta else x["results"], ensure_ascii=False, indent=2, default=str) for x in answers)
        lines = []
        for x in answers:
            lines.append(f"# {x['query']}" + (f" ({x['count']} of {x['candidates']} candidates, {x['deduped']} copies merged, {x['took_ms']} ms)" if args.meta else ""))
            for r in x["results"]:
                body = r.get("abstract") or ""
                score = "" if r.get("score") is None else f" [{r['score']:.4f}]"
                lines.append(f"{r['rank']}. {r.get('title') or '-'}{score}\n   {body if args.full or len(body) <= 300 else body[:300] + ' ...'}")
        return "\n".join(lines)

    text = shown(answer(queries)) if queries else ""
    if args.out:
        with open(args.out, "w", encoding="utf-8") as out:
            out.write(text)
    elif text:
        print(text)
    while args.interactive:
        try:
            query = input("> ").strip()
        except EOFError:
            break
        if not query:
            break
        print(shown(answer([query]), text=not args.json))
    return 0


if __name__ == "__main__":
    sys.exit(main())
