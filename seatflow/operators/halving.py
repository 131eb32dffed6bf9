"""Search over settings whose fits are shared between numbers of rounds (M7).

A boosted model of many rounds holds the model of every smaller number of rounds, so settings that differ in rounds only
are one fit. Fits begin with few rounds; the better part of them goes on with more, until the best ones have all the rounds
that they ask for, or the last rounds no longer lower the error on the validation rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

#: A fit goes on while its best round is among the last half, or the last `PATIENCE` rounds.
PATIENCE = 16


@dataclass(frozen=True)
class Outcome:
    """The least validation error of a setting, at how many rounds, and how many rounds were fitted."""

    error: float
    rounds: int
    fitted: int


def shape_of(setting: Mapping) -> str:
    """What fits share: all but the number of rounds."""
    return json.dumps({k: v for k, v in setting.items() if k != "rounds"}, sort_keys=True)


def halved(
    settings: Sequence[Mapping],
    errors_of: Callable[[Mapping, int], Sequence[float]],
    first: int = 2,
    keep: int = 4,
    at_once: int = 8,
) -> list[Outcome]:
    """An outcome per setting. `errors_of(setting, rounds)` fits that many rounds and gives the error after each.

    `first` rounds are fitted of every shape; one in `keep` shapes stays and gets `keep` times as many, the least
    error first. `keep` = 1 fits every shape to its end at once.
    """
    shapes: dict[str, list[int]] = {}
    for trial, setting in enumerate(settings):
        shapes.setdefault(shape_of(setting), []).append(trial)
    most = {shape: max(int(settings[t]["rounds"]) for t in trials) for shape, trials in shapes.items()}
    out: dict[int, Outcome] = {}
    alive, budget = list(shapes), first if keep > 1 else max(most.values(), default=0)
    with ThreadPoolExecutor(at_once) as pool:
        while alive:
            rounds = [min(budget, most[shape]) for shape in alive]
            fits = pool.map(lambda shape, n: errors_of(settings[shapes[shape][0]], n), alive, rounds)
            left = []
            for place, (shape, n, errors) in enumerate(zip(alive, rounds, fits, strict=True)):
                errors = [math.inf if math.isnan(e) else float(e) for e in errors]
                for trial in shapes[shape]:
                    own = errors[: int(settings[trial]["rounds"])]
                    out[trial] = Outcome(min(own), own.index(min(own)) + 1, len(own))
                best = errors.index(min(errors)) + 1
                if n < most[shape] and best > n - max(PATIENCE, n / 2):
                    left.append((min(errors), place, shape))
            ranked = sorted([(min(out[t].error for t in shapes[shape]), place) for place, shape in enumerate(alive)])
            stays = {place for _, place in ranked[: -(-len(alive) // keep)]}
            alive = [shape for _, place, shape in left if place in stays]
            budget *= max(2, keep)
    return [out[trial] for trial in range(len(settings))]
