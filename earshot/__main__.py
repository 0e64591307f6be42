"""Command line: train a model, find similar users, show histories and totals.

    spark-submit --py-files earshot.zip -m earshot ...   or   python -m earshot ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from earshot.functions import columns
from earshot.operators import factorize, profiles, similar
from earshot.plans import training
from earshot.sources import models, schemas, sinks, storage, tables


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("earshot").getOrCreate()
    args.run(spark, args)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="earshot")
    commands = parser.add_subparsers(required=True)

    def command(name: str, run, *needed: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in needed:
            sub.add_argument(path)
        sub.add_argument("--out", help="write files here instead of printing")
        sub.add_argument("--format", choices=sinks.FORMATS, default="parquet", help="of the files")
        sub.add_argument("--display", action="store_true", help="short texts, rounded figures, names for the unknown")
        return sub

    train = command("train", _train, "interactions", "model")
    train.add_argument("--seed", type=int, required=True)
    train.add_argument("--ranks", type=int, nargs="+", default=[150])
    train.add_argument("--regs", type=float, nargs="+", default=[0.1])
    train.add_argument("--alphas", type=float, nargs="+", default=[1.0])
    train.add_argument("--iterations", type=int, nargs="+", default=[20])
    train.add_argument("--min-user", type=int, default=5)
    train.add_argument("--min-song", type=int, default=5)
    train.add_argument("--overwrite", action="store_true")

    near = command("similar", _similar, "model")
    near.add_argument("--users", help="user dimension with user_id, Username")
    near.add_argument("--ids", type=int, nargs="+", help="users to ask for; everyone when left out")
    near.add_argument("--top", type=int, default=10)
    near.add_argument("--method", choices=["exact", "lsh"], default="lsh")
    near.add_argument("--seed", type=int, default=0)
    near.add_argument("--tables", type=int, default=5)
    near.add_argument("--bucket-length", type=float, default=2.0)

    past = command("history", _history, "interactions")
    past.add_argument("--songs", help="song dimension with song_id, title, artist_name")
    past.add_argument("--ids", type=int, nargs="+")
    past.add_argument("--limit", type=int, default=50, help="0 for no limit")

    stats = command("stats", _stats, "interactions")
    stats.add_argument("--ids", type=int, nargs="+")

    command("describe", _describe, "model")
    return parser


def _ids(spark: SparkSession, ids: list[int] | None, name: str) -> DataFrame | None:
    return None if ids is None else spark.createDataFrame([(i,) for i in ids], f"{name} long")


def _warn_unknown(wanted: DataFrame | None, known: DataFrame) -> None:
    if wanted is not None:
        for row in profiles.unknown_users(wanted, known, wanted.columns[0]).collect():
            print(f"user {row[0]} is not known")


def _deliver(df: DataFrame, args, order: list[str]) -> None:
    """All rows, to files or printed; the values are the same either way."""
    if args.out:
        sinks.write(df, args.out, args.format)
        return
    _print(df, order)


def _print(df: DataFrame, order: list[str]) -> None:
    for line in sinks.printed(df, order):
        print(line)


def _warn_unreadable(spark: SparkSession, path: str, schema) -> None:
    lost = tables.unreadable_cells(spark, path, schema).head().asDict()
    for name, n in lost.items():
        if n:
            print(f"{n} cells of {name} in {path} cannot be read and count as missing")


def _train(spark: SparkSession, args) -> None:
    tables.validate_inputs(spark, {"interactions": args.interactions})
    _warn_unreadable(spark, args.interactions, schemas.INTERACTIONS)
    # Parsed once; every later pass reads columns.
    plays = storage.written(tables.read_interactions(spark, args.interactions), "plays")
    result = training.train_and_save(
        plays, args.model, seed=args.seed, min_user=args.min_user, min_item=args.min_song,
        overwrite=args.overwrite, ranks=args.ranks, regs=args.regs, alphas=args.alphas,
        iterations=args.iterations,
    )
    _print(result.report, ["rows_before"])
    _deliver(result.metrics, args, ["rank", "reg", "alpha", "iterations"])


def _similar(spark: SparkSession, args) -> None:
    tables.validate_inputs(spark, {"model": args.model})
    vectors = factorize.user_vectors(models.load(args.model)).persist()
    wanted = _ids(spark, args.ids, "id")
    _warn_unknown(wanted, vectors)
    index = None
    if args.method == "lsh":
        index = similar.fit_index(
            vectors, seed=args.seed, tables=args.tables, bucket_length=args.bucket_length
        )
    found = similar.similar_users(
        vectors, wanted, args.top, args.method, index,
        users=tables.read_dimension(spark, args.users, schemas.USERS), display=args.display,
    )
    _deliver(found, args, ["query_id", "rank"])


def _history(spark: SparkSession, args) -> None:
    _warn_unreadable(spark, args.interactions, schemas.INTERACTIONS)
    plays = tables.read_interactions(spark, args.interactions)
    wanted = _ids(spark, args.ids, "user_id")
    _warn_unknown(wanted, plays)
    songs = tables.read_dimension(spark, args.songs, schemas.SONGS)
    shown = profiles.history(plays, songs, args.limit, wanted, display=args.display)
    _deliver(shown, args, ["user_id", "rank"])


def _stats(spark: SparkSession, args) -> None:
    _warn_unreadable(spark, args.interactions, schemas.INTERACTIONS)
    plays = tables.read_interactions(spark, args.interactions)
    digits = columns.AVERAGE_DIGITS if args.display else None
    _deliver(profiles.user_stats(plays, _ids(spark, args.ids, "user_id"), digits), args, ["user_id"])


def _describe(spark: SparkSession, args) -> None:
    _deliver(models.describe(models.load(args.model)), args, ["rank"])


if __name__ == "__main__":
    main()
