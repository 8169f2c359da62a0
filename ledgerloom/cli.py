"""Commands: download, normalize, build-master, sample, enrich, export, enrich-table, all, status."""

from __future__ import annotations

import argparse

from .plans import table_flow
from .plans.pipeline import Store
from .session import session, ship
from .sources.fetch import download


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    p.add_argument("--root", default="data", help="folder of the run's tables; raw/<source>/<date>/ holds the snapshots")
    p.add_argument("--now", required=True, help="the run's time, ISO seconds")
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name: sub.add_parser(name)
    for name in ("normalize", "all"):
        add(name).add_argument("--sources", nargs="*")
    for name in ("build-master", "status", "categorize"):
        add(name)
    d = add("download")
    d.add_argument("--transport", required=True, help="module:function that streams a URL's bytes")
    d.add_argument("--file", nargs=3, action="append", metavar=("SOURCE", "URL", "NAME"), default=[])
    d.add_argument("--force", action="store_true")
    for name in ("sample", "enrich", "export", "enrich-table"):
        add(name)
    for name in ("normalize", "build-master"):
        sub.choices[name].add_argument("--force", action="store_true")
    for name in ("sample", "all"):
        sub.choices[name].add_argument("--multiplier", type=float, default=1.5)
    for name in ("enrich", "enrich-table", "all"):
        sub.choices[name].add_argument("--search-results", required=name != "all")
        sub.choices[name].add_argument("--pages", required=name != "all")
    e = sub.choices["enrich"]
    e.add_argument("--category")
    e.add_argument("--retry-failed", action="store_true")
    e.add_argument("--parts", type=int, default=1, help="how often the work is saved")
    for opt in ("--start", "--end", "--limit"):
        e.add_argument(opt, type=int, default=0)
    t = sub.choices["enrich-table"]
    t.add_argument("file")
    t.add_argument("--out", required=True)
    t.add_argument("--limit", type=int, default=0)
    for opt in ("--skip-existing", "--force-recollect", "--quick"):
        t.add_argument(opt, action="store_true")
    for name in ("export", "all"):
        sub.choices[name].add_argument("--out", default="report.xlsx")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = ship(session())
    store = Store(spark, a.root)
    today = a.now[:10]
    tables = lambda: (spark.read.parquet(a.search_results), spark.read.parquet(a.pages))
    if a.command == "download":
        for n, (source, url, name) in enumerate(a.file):
            print(source, download(spark, url, store.path("raw"), source, today, name, a.transport, a.force, required=n == 0))
    if a.command in ("normalize", "all"):
        for source, outcome in store.normalize(today, a.sources, getattr(a, "force", False)).items():
            print(source, outcome)
    if a.command in ("build-master", "all"):
        print("companies", store.master(force=a.command == "all" or a.force).count())
    if a.command == "categorize":
        # Categories are made with the master, in one plan; this makes both anew.
        store.master(force=True).groupBy("category").count().show(truncate=False)
    if a.command in ("sample", "all"):
        print("candidates", store.sample(a.multiplier).count())
    if a.command == "enrich" or a.command == "all" and a.search_results:
        options = {k: getattr(a, k) for k in ("category", "start", "end", "limit", "retry_failed", "parts")} if a.command == "enrich" else {}
        print("state", store.enrich(*tables(), a.now, **options).count())
    if a.command in ("export", "all"):
        store.export(a.out)
    if a.command == "enrich-table":
        from .sources.xlsx import write_workbook
        from .streaming.state import state_view

        options = table_flow.Options(a.skip_existing, a.force_recollect, a.limit, a.quick, today)
        out = table_flow.enrich_table(table_flow.read_table(spark, a.file), state_view(store.attempts()), *tables(), options)
        write_workbook({"results": out, "summary": table_flow.table_summary(out)}, a.out)
    if a.command == "status":
        for name, df in store.status().items():
            print(name)
            df.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
