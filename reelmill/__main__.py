"""Command line for the daily jobs: ``python -m reelmill JOB --root FOLDER ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from reelmill.operators.forest import ForestParams
from reelmill.plans import jobs, ratings_model
from reelmill.session import build_session
from reelmill.sources.store import TableStore


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="reelmill")
    parser.add_argument(
        "job", choices=["titles", "now-playing", "upsert", "marts", "model", "daily", "vacuum"]
    )
    parser.add_argument("--root", required=True, help="folder of the published tables")
    for name in ("basics", "ratings", "pages", "genres", "external-ids"):
        parser.add_argument(f"--{name}", default="", help=f"folder of the landed {name} files")
    parser.add_argument("--multi-line", action="store_true", help="one JSON object per file")
    parser.add_argument("--pandas-na", action="store_true", help="more spellings of NULL")
    parser.add_argument("--quote", default="", help="quote character of the title files")
    parser.add_argument("--fractions", choices=["error", "null"], default="error")
    parser.add_argument("--partitions", type=int, help="spread rows of few large gzip files")
    parser.add_argument("--older-than-hours", type=float, default=48.0, help="for vacuum")
    parser.add_argument("--run-date", type=date.fromisoformat, help="default: today in UTC")
    parser.add_argument("--on-duplicate", choices=["error", "latest"], default="error")
    parser.add_argument("--unrated-too", action="store_true", help="predict unrated films")
    for name in ("trees", "depth", "bins", "seed", "leaf-rows"):
        default = getattr(ForestParams, name.replace("-", "_"))
        parser.add_argument(f"--{name}", type=int, default=default, help="of the forest")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    store = TableStore(build_session(), args.root)
    landed = jobs.Landed(
        args.basics, args.ratings, args.pages, args.genres, args.external_ids,
        args.multi_line, args.pandas_na, args.quote, args.fractions, args.partitions,
    )
    run_date = args.run_date or datetime.now(timezone.utc).date()
    params = ForestParams(args.trees, args.depth, args.bins, args.seed, args.leaf_rows)
    rated_only = not args.unrated_too
    run = None
    if args.job == "titles":
        jobs.refresh_titles(store, landed)
    elif args.job == "now-playing":
        jobs.refresh_now_playing(store, landed, run_date)
    elif args.job == "upsert":
        jobs.upsert_titles(store, args.on_duplicate)
    elif args.job == "marts":
        jobs.build_marts(store)
    elif args.job == "model":
        run = jobs.train_and_publish(store, params, rated_only)
    elif args.job == "vacuum":
        store.vacuum(args.older_than_hours)
    else:
        run = jobs.daily_run(store, landed, run_date, params, args.on_duplicate, rated_only)
    if run is not None:
        print({name: round(value, 3) for name, value in run.metrics.items()})
        ratings_model.prediction_sample(run.predictions).show(truncate=False)


if __name__ == "__main__":
    main()
