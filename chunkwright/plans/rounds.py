"""Completion rounds with incremental outcomes (D4, D10, D11, D15).

Every attempt row carries its own history: ``attempt`` is the number of tries
so far and ``max_tokens`` the budget grown so far. So a round's answers alone
tell, chunk by chunk, what is settled and what is asked next; a round parses
only its own answers, stages their outcomes and never looks at earlier ones.
The outcomes of the job are the settled rows of all rounds, each chunk in one.
Answers that an earlier run left in the store are folded once, before the
first round.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.operators import completion as D4
from chunkwright.operators.responses import CHUNK_KEY
from chunkwright.session import stage
from chunkwright.sources import answers as store


@dataclass
class Rounds:
    """How a job asks and judges.

    requests_of: chunk rows (with attempt, max_tokens) -> request rows
    outcomes_of: attempt rows -> one row a chunk with ``tries``, ``budget``
                 (max_tokens of a next try) and ``settled``
    """

    requests_of: Callable[[DataFrame], DataFrame]
    outcomes_of: Callable[[DataFrame], DataFrame]
    max_attempts: int
    first_budget: int


def settled_outcomes(asked: DataFrame, rounds: Rounds, fn: D4.CompleteFn, path: str, partitions: int | None = None, **publish) -> DataFrame:
    """Ask until every chunk of `asked` (key and text) is settled; the settled
    outcomes, staged. ``publish``: options of ``sources.answers.ask``."""
    kept, due = [], None
    if store.has_answers(asked.sparkSession, path):
        ids = stage(rounds.requests_of(_due(asked, F.lit(1), F.lit(rounds.first_budget))).select("request_id"), "request-ids")
        before = stage(rounds.outcomes_of(store.answers_to(ids, path)), "outcomes")
        kept.append(before.where("settled"))
        state = before.select(*CHUNK_KEY, "tries", "budget", "settled")
        left = asked.join(state, CHUNK_KEY, "left").where(~F.coalesce("settled", F.lit(False)))
        due = _due(left, F.coalesce("tries", F.lit(0)) + 1, F.coalesce("budget", F.lit(rounds.first_budget)))
        due = stage(due.select(*CHUNK_KEY, "attempt", "max_tokens"), "pending")
    for _ in range(rounds.max_attempts):
        if due is None:
            rows = _due(asked, F.lit(1), F.lit(rounds.first_budget))
        elif due.isEmpty():
            break
        else:
            rows = asked.join(due, CHUNK_KEY)
        answers = store.ask(D4.for_function(rounds.requests_of(rows)), path, lambda b: D4.answer_batch(fn, b), partitions, **publish)
        outcomes = stage(rounds.outcomes_of(answers), "outcomes")
        kept.append(outcomes.where(F.col("settled")))
        due = _due(outcomes.where(~F.col("settled")), F.col("tries") + 1, F.col("budget")).select(*CHUNK_KEY, "attempt", "max_tokens")
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.drop("settled", "budget")


def _due(rows: DataFrame, attempt, budget) -> DataFrame:
    return rows.withColumn("attempt", attempt.cast("bigint")).withColumn("max_tokens", budget.cast("int"))
