"""Headline timings: median of warm runs, one JSON line.

The serving tables and the postings are written once before the clock starts, as a user has
them as tables. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` set data, cores and runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from skilltide.operators import demand as q  # noqa: E402
from skilltide.operators import normalize as n  # noqa: E402
from skilltide.operators.ingest import insert_if_absent  # noqa: E402
from skilltide.plans import lake  # noqa: E402
from skilltide.registry import REGISTRY, shapes  # noqa: E402
from skilltide.registry.core import AS_OF, shape, table  # noqa: E402
from skilltide.session import local_session, scratch_dir  # noqa: E402
from skilltide.sources.warehouse import read_title_index, save_title_index  # noqa: E402

FUZZY_VALUES = 2_000


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = sys.argv[1:]
    spark = local_session(cores, "bench", **{"spark.ui.showConsoleProgress": "false"})
    root = scratch_dir(spark, "bench")

    def saved(df, name):
        path = f"{root}/{name}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    jobs, skills, pairs, alias = (
        saved(shape(spark, sf_dir, s), s) for s in ("jobs", "skills", "job_skills", "alias")
    )
    spark.sql("CREATE SCHEMA IF NOT EXISTS bench")
    save_title_index(jobs, "bench", f"{root}/index", 2)
    serving = q.Serving(jobs, skills, pairs, alias, read_title_index(spark, "bench"))
    postings = saved(shapes.postings(spark, sf_dir), "postings")
    vocab = saved(shapes.vocab(spark, sf_dir), "vocab")
    names = [r["name"] for r in skills.select("name").orderBy("name").collect()]
    hundred = [
        q.Request(
            title if i < len(names) else title.split(" ")[1] + "t",
            levels=["1-URGENT", "2-HIGH"] if title.startswith("b") else None,
            request_id=i,
        )
        for i, title in enumerate((names * 2)[:100])
    ]
    events = table(spark, sf_dir, "events")
    # fuzzy matching of as many new values as the vocabulary has: distinct words, half and half
    words = (
        table(spark, sf_dir, "documents")
        .select(F.lit("tech_stack").alias("category"), F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("value"))
        .filter(F.length("value") > 3).distinct()
    )
    halves = saved(words.orderBy(F.xxhash64("value")).limit(2 * FUZZY_VALUES).withColumn("half", F.pmod(F.hash("value"), F.lit(2))), "halves")
    new_keys = saved(halves.filter("half = 0").select("category", F.col("value").alias("key")), "new_keys")
    large_vocab = saved(
        halves.filter("half = 1").select(
            "category", "value", F.col("value").alias("key"), F.row_number().over(Window.orderBy("value")).alias("ord")
        ),
        "large_vocab",
    )

    # 8,000 by 8,000 keys of three words, two of which all share
    pairs_of = (
        spark.range(16_000).select(
            F.lit("tech_stack").alias("category"), F.expr("id % 2").alias("half"),
            F.concat(F.lit("senior developer "), F.expr(
                "translate(substring(sha2(CAST(id AS STRING), 256), 1, 4 + id % 7), '0123456789', 'ghijklmnop')"
            )).alias("key"), F.col("id").alias("ord"),
        )
    )
    title_keys = saved(pairs_of.filter("half = 0").select("category", "key").distinct(), "title_keys")
    title_vocab = saved(pairs_of.filter("half = 1").select("category", F.col("key").alias("value"), "key", "ord"), "title_vocab")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def registered(name):
        return lambda: noop(REGISTRY[name].run(spark, sf_dir))

    cases = {
        "q16_skill_demand": lambda: noop(q.skill_demand(serving, q.Request("red widget"), AS_OF)),
        "q17_skill_demand_100": lambda: noop(
            q.skill_demand_batch(serving, q.requests_frame(spark, hundred), AS_OF)
        ),
        "q18_skill_frequency_stats": lambda: noop(q.skill_frequency_stats(jobs, pairs, skills)),
        "n11_tech_stack_fuzzy": lambda: noop(n.silver_tech_stack(postings, vocab)),
        "n4_fuzzy_2000_x_2000": lambda: noop(n.match_fuzzy(new_keys, large_vocab)),
        "n4_fuzzy_8000_x_8000_two_shared_words": lambda: noop(n.match_fuzzy(title_keys, title_vocab)),
        "n16_silver_five_fields": lambda: noop(
            n.silver_postings(postings, n.field_mapping(postings, vocab))
        ),
        "j1_run_datalake_month": lambda: lake.run_datalake(
            postings, vocab, scratch_dir(spark, "lake"), "2000-03-01"
        ),
        "i3_insert_if_absent": lambda: noop(
            insert_if_absent(events, None, "user_id", ["ts", "event_id"])
        ),
        "p10_extract_entities": registered("p10_extract_entities"),
        "x13_tokens": registered("x13_tokens"),
    }
    seconds = {}
    for name, run in cases.items():
        if only and name not in only:
            continue
        for _ in range(2):
            run()
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
