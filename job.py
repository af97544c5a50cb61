"""spark-submit job.py --output-dir DIR [--input PATH | --json PATH | --captures PATH | --sample] [options]"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from datetime import UTC, datetime

from chatterlens.operators.capture import collect_posts
from chatterlens.operators.dedup import FingerprintStore
from chatterlens.options import JobOptions
from chatterlens.plans.signals import run
from chatterlens.session import build_session
from chatterlens.sources.posts import from_json_lines, read_captures, read_json_lines, read_posts, rejected_json_lines
from chatterlens.sources.sample import generate_posts, posts_or_sample

log = logging.getLogger("chatterlens.job")
#: Posts to make up when no number is given.
SAMPLE_POSTS = 100


def count(text: str) -> int:
    """A whole number of at least one."""
    if not text.isdecimal() or not int(text):
        raise argparse.ArgumentTypeError(f"{text!r} is no count; give 1 or more")
    return int(text)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Posts to features, keywords, signal summary and chart tables.")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--input", help="Parquet folder of posts")
    source.add_argument("--json", help="folder of posts as JSON lines")
    source.add_argument("--captures", help="JSON folder of captured cards")
    source.add_argument("--sample", action="store_true", help="synthetic posts instead of an input")
    parser.add_argument("--sample-if-empty", action="store_true", help="synthetic posts where the input has none")
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--max-tweets", type=count, help="most posts to take from captures (default: all), or how many to make up")
    parser.add_argument("--cutoff-hours", type=int, default=None, help="oldest capture to take, in hours before --as-of")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="the run's now; default: wall clock")
    parser.add_argument("--output-dir", default=None)
    parser.add_argument("--known", help="folder of fingerprints kept between runs; posts of earlier batches are left out")
    parser.add_argument("--batch", type=int, default=0, help="number of this run in --known; running it again is safe")
    parser.add_argument("--seen", help="Parquet folder with the status_id of cards that are not to be parsed again")
    return parser.parse_args(argv)


def options_from(args: argparse.Namespace) -> JobOptions:
    as_of = args.as_of or datetime.now(UTC)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=UTC)
    given = {
        "output_dir": args.output_dir or os.environ.get("OUTPUT_DIR", "data"),
        "cutoff_hours": int(os.environ.get("CUTOFF_HOURS") or "168") if args.cutoff_hours is None else args.cutoff_hours,
        "seed": args.seed,
    }
    if args.max_tweets is not None:
        given["max_posts"] = args.max_tweets
    return JobOptions.from_env(os.environ, as_of, **given)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    options = options_from(args)
    spark = build_session()
    made_up = options.max_posts or SAMPLE_POSTS
    rejected_lines = None
    if args.sample:
        posts = generate_posts(spark, made_up, options.as_of, options.seed)
    elif args.captures:
        cards = read_captures(spark, args.captures)
        seen = spark.read.schema("status_id string").parquet(args.seen) if args.seen else None
        posts = collect_posts(
            cards, list(options.search_hashtags), options.max_posts, options.as_of, options.cutoff_hours, seen
        )
    elif args.json:
        lines = read_json_lines(spark, args.json)
        posts, rejected_lines = from_json_lines(lines), rejected_json_lines(lines)
    elif args.input:
        posts = read_posts(spark, args.input)
    else:
        raise ValueError("nothing to read: give --input, --json, --captures or --sample")
    if args.sample_if_empty:
        posts = posts_or_sample(posts, made_up, options.as_of, options.seed)
    store = FingerprintStore(spark, args.known) if args.known else None
    result = run(spark, posts, options, store, args.batch, rejected_lines)
    log.info(
        "finished: %s; %d duplicates, %d rejected lines, %s posts a second",
        result, result.duplicates, result.rejected_lines, result.posts_per_second,
    )
    return 0


def exit_code(argv: list[str] | None = None) -> int:
    """0 for a finished run, 130 for an interrupted one, 1 for a failed one."""
    try:
        return main(argv)
    except KeyboardInterrupt:
        return 130
    except Exception as error:
        log.error("no result", exc_info=error)
        return 1


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(exit_code())
