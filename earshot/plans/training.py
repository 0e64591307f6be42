"""Grid search, and the whole way from play counts to a saved model."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from earshot.operators import evaluate, factorize, interactions, recommend, split
from earshot.sources import models, schemas, storage

_METRICS = (
    "rank int, reg double, alpha double, iterations int, users long, ndcg double, is_best boolean"
)


@dataclass(frozen=True)
class GridResult:
    metrics: DataFrame
    best: ALSModel
    best_params: dict
    best_ndcg: float
    report: DataFrame | None = None


def grid_search(
    train: DataFrame,
    test: DataFrame,
    *,
    seed: int,
    ranks: Sequence[int] = (150,),
    regs: Sequence[float] = (0.1,),
    alphas: Sequence[float] = (1.0,),
    iterations: Sequence[int] = (20,),
    k: int = 10,
    parallelism: int = 2,
    **fit_args,
) -> GridResult:
    """Fit every combination, score each by mean nDCG@k, keep the best; the first wins ties.

    Training rows and truth pairs are kept for the length of the search. All scores
    may be 0: there is a best model all the same. ``parallelism`` fits run at a time, so one
    fills the cores that another leaves idle; what is kept does not depend on which ends
    first. When one fails, the jobs of the others are cancelled and its error is raised.
    """
    if parallelism < 1:
        raise ValueError("parallelism must be positive")
    spark = train.sparkSession
    storage.ensure_checkpoint_dir(spark)
    train = train.select("user_id", "song_id", "rating_log").persist()
    truth = evaluate.truth_pairs(test).persist()
    grid = list(itertools.product(ranks, regs, alphas, iterations))
    rows, best, best_row = [None] * len(grid), None, None
    try:
        n = schemas.require_trainable(train, "user_id", "song_id", "rating_log")

        def one(i: int) -> tuple[int, ALSModel, tuple]:
            rank, reg, alpha, iters = grid[i]
            model = factorize.train(
                train, seed=seed, rank=rank, reg=reg, alpha=alpha, iterations=iters, checked_rows=n, **fit_args
            )
            listed = recommend.predictions(recommend.top_items(model, k))
            score = evaluate.mean_ndcg(evaluate.ndcg_per_user(listed, truth, k)).head()
            return i, model, (rank, float(reg), float(alpha), iters, score["users"], score["ndcg"])

        for i, model, row in _together(spark, one, len(grid), parallelism):
            rows[i] = row
            if best is None or (row[5], -i) > (rows[best_row][5], -best_row):
                best, best_row = model, i
    finally:
        train.unpersist()
        truth.unpersist()
    metrics = train.sparkSession.createDataFrame(
        [(*row, i == best_row) for i, row in enumerate(rows)], _METRICS
    )
    rank, reg, alpha, iters, _, ndcg = rows[best_row]
    params = {"rank": rank, "reg": reg, "alpha": alpha, "iterations": iters}
    return GridResult(metrics, best, params, ndcg)


def _together(spark, one, n: int, parallelism: int):
    """``one(0)`` to ``one(n - 1)`` as they end, ``parallelism`` at a time, each in a job group of its own.

    The first error cancels the groups that are under way and is raised.
    """
    sc, search = spark.sparkContext, uuid.uuid4().hex
    groups = [f"grid-{search}-{i}" for i in range(n)]

    def grouped(i: int):
        sc.setJobGroup(groups[i], f"grid search, combination {i + 1} of {n}", interruptOnCancel=True)
        return one(i)

    with ThreadPoolExecutor(parallelism) as pool:
        waiting, running = list(range(n)), {}
        try:
            while waiting or running:
                while waiting and len(running) < parallelism:
                    i = waiting.pop(0)
                    running[pool.submit(inheritable_thread_target(spark)(grouped), i)] = i
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in done:
                    del running[future]
                for future in done:
                    yield future.result()
        except BaseException:
            for i in running.values():
                sc.cancelJobGroup(groups[i])
            raise


def train_and_save(
    raw: DataFrame,
    path: str,
    *,
    seed: int,
    min_user: int = 5,
    min_item: int = 5,
    overwrite: bool = False,
    **grid_args,
) -> GridResult:
    """Clean, split by rows, check, search the grid, save the best model.

    ``raw`` is read for the support counts and for the cleaned rows: stage what is dear
    to read with :func:`earshot.sources.storage.written` first. The cleaned rows are written
    once, with their side. Rows without a user or a song drop out in the cleaning; any
    other fault in the rows kept is an error.
    """
    tagged = split.random_tag(interactions.clean(raw, min_user, min_item), seed)
    tagged = storage.written(tagged, "split", "is_train")
    schemas.require_valid_interactions(tagged)
    report = interactions.cleaning_report(raw, tagged)
    train, test = split.halves(tagged)
    result = grid_search(train, test, seed=seed, **grid_args)
    models.save(result.best, path, overwrite)
    return replace(result, report=report)
