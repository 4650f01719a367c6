"""Batch jobs: python -m eventloom {knowledge-base,index,actors} INPUT OUTPUT ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventloom.operators import retrieval
from eventloom.operators.actors import country_patterns, parse_agents
from eventloom.operators.knowledge import build_knowledge_base
from eventloom.plans.coding import Dimensions, agent_to_code
from eventloom.sources import readers, sinks


def main() -> None:
    parser = argparse.ArgumentParser(prog="eventloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    base = jobs.add_parser("knowledge-base", help="XML dump to articles")
    index = jobs.add_parser("index", help="articles to search tables, which are then read back and checked")
    coded = jobs.add_parser("actors", help="JSON lines of text and date to codes")
    for job in (base, index, coded):
        job.add_argument("input")
        job.add_argument("output")
    coded.add_argument("--countries", required=True, help="CSV with CCA2, Name, CCA3, Nationality")
    coded.add_argument("--agents", required=True, help="agent dictionary")
    coded.add_argument("--articles", help="knowledge base")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("eventloom").getOrCreate()
    if args.job == "knowledge-base":
        sinks.upsert_articles(None, build_knowledge_base(readers.read_dump(spark, args.input)), args.output)
    elif args.job == "index":
        fields = retrieval.DEFAULT_FIELDS + [f for f in retrieval.REQUIRED_FIELDS if f.whole]
        articles = readers.read_articles(spark, args.input).withColumn("article_id", F.col("title"))
        flat = F.transform(F.map_entries(F.coalesce("infobox", F.expr("cast(map() as map<string,string>)"))), lambda e: e["value"])
        retrieval.write_index(retrieval.build_index(articles.withColumn("infobox", flat), fields), args.output)
        retrieval.read_index(spark, args.output)
    else:
        countries = readers.read_countries(spark, args.countries)
        patterns, of = ([(r.pattern, r.code) for r in country_patterns(countries, c).orderBy("ordinal").collect()] for c in (False, True))  # dimensions
        roles = parse_agents(readers.read_lines(spark, args.agents)).select("pattern", "code_1", "code_2").dropDuplicates(["pattern"])
        articles = readers.read_articles(spark, args.articles) if args.articles else None
        mentions = spark.read.schema("text string, date string").json(args.input)
        sinks.write_events(agent_to_code(mentions, Dimensions(patterns, readers.country_lookup(countries), roles, of), articles), args.output)


if __name__ == "__main__":
    main()
