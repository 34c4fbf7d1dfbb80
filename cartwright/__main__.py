"""Command line: the runs a user of the original project performs.

    python -m cartwright build      --sf-dir DIR   # write all models, run the checks
    python -m cartwright test       --sf-dir DIR   # data-quality suite results
    python -m cartwright insights   --sf-dir DIR   # headline block + chart data
    python -m cartwright experiment --sf-dir DIR   # experiment read-out + decision
    python -m cartwright query NAME --sf-dir DIR   # any registered query

``--tables ROOT`` reads shop tables (users, orders, order_items, products)
instead of the test data; ``--start``, ``--end``, ``--alpha``, ``--mde`` and
``--variants`` set the experiment. Every command runs Spark jobs and only shows
small results (``show``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from cartwright.session import get_session


def main(argv: list[str] | None = None) -> int:
    from cartwright.operators.experiment import ExperimentConfig
    from cartwright.plans.queries import queries, register_models
    from cartwright.sources.shop import from_tables, from_tpch
    from cartwright.sources.tables import TableSource

    p = argparse.ArgumentParser(prog="cartwright")
    p.add_argument("command", choices=["build", "test", "insights", "experiment", "query"])
    p.add_argument("name", nargs="?", help="query name for the 'query' command")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: from the environment")
    p.add_argument("--tables", help="root of shop tables, instead of --sf-dir")
    p.add_argument("--start", type=dt.date.fromisoformat, help="first day of the experiment")
    p.add_argument("--end", type=dt.date.fromisoformat, help="last day of the experiment")
    p.add_argument("--alpha", type=float)
    p.add_argument("--mde", type=float, dest="mde_relative", help="relative lift worth shipping")
    p.add_argument("--variants", type=lambda s: tuple(s.split(",")), help="control,treatment")
    p.add_argument("--rows", type=int, default=100)
    a = p.parse_args(argv)
    cfg = ExperimentConfig(**{k: v for k in ("start", "end", "alpha", "mde_relative", "variants")
                              if (v := getattr(a, k)) is not None})

    spark = get_session(a.master)
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    root = a.tables or a.sf_dir
    tables = TableSource(spark, root)
    sources = from_tables(tables) if a.tables else from_tpch(tables)
    register_models(spark, root, sources, cfg)

    def show(name: str) -> None:
        print(f"== {name}")
        q[name](spark, root).show(a.rows, truncate=False)

    if a.command == "build":
        from cartwright.plans.build import build
        out = build(spark, sources, cfg=cfg)
        print(f"run {out['run_id']} -> {out['root']}")
        for name, path in out["paths"].items():
            print(f"  {name:30s} {path}")
        out["checks"].show(a.rows, truncate=False)
    elif a.command == "test":
        show("dq_results")
        show("dq_rate_bounds")
    elif a.command == "insights":
        for name in ("headline_display", "category_top10", "retention_line", "channel_bars"):
            show(name)
    elif a.command == "experiment":
        for name in ("variant_balance", "variant_summary", "experiment_report_display",
                     "experiment_decision"):
            show(name)
    else:
        if a.name not in q:
            print(f"unknown query {a.name!r}; known: {', '.join(sorted(q))}", file=sys.stderr)
            return 2
        show(a.name)
    return 0


if __name__ == "__main__":
    sys.exit(main())
