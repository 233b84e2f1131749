"""Timing helpers: one call, the stages of a query, repeated searches, ladders of settings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def run_all(df: DataFrame) -> None:
    """Execute a plan completely without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


def timed(call: Callable, raising: bool = False) -> tuple[object, float | None, str | None]:
    """(result, seconds, error type); with ``raising``, errors go on."""
    began = time.perf_counter()
    try:
        return call(), time.perf_counter() - began, None
    except Exception as e:
        if raising:
            raise
        return None, None, type(e).__name__


@dataclass
class Stages:
    """Seconds by stage of a query in several stages."""

    seconds: dict[str, float] = field(default_factory=dict)

    def run(self, label: str, call: Callable):
        result, took, _ = timed(call, raising=True)
        self.seconds[label] = self.seconds.get(label, 0.0) + took
        return result


def trend(seconds: list[float]) -> str:
    """What repeated runs show: warming, not a matter of the cache, or something between."""
    if len(seconds) < 2 or not seconds[0]:
        return "unknown"
    share = seconds[-1] / seconds[0]
    return "warming" if share < 0.5 else "not cache" if share > 0.8 else "mixed"


def repeat(call: Callable, times: int) -> tuple[list[float], str]:
    took = [timed(call, raising=True)[1] for _ in range(times)]
    return took, trend(took)


#: The steps of the search ladder as (limit, search width).
LADDER = ((1, 16), (10, 64), (50, 128))


def ladder(search: Callable[..., DataFrame], steps: Iterable[tuple[int, int]] = LADDER, **fixed) -> list[dict]:
    """Seconds of each step; an error is a row of its own and the ladder goes on."""
    out = []
    for limit, ef in steps:
        _, took, error = timed(lambda limit=limit, ef=ef: run_all(search(limit=limit, ef=ef, **fixed)))
        out.append({"limit": limit, "ef": ef, "seconds": took, "error": error})
    return out


def one_at_a_time(search: Callable[..., DataFrame], base: dict, variants: dict[str, list]) -> list[dict]:
    """The base setting, then each factor's other values with the rest as in the base."""
    settings = [("base", base)] + [(f"{k}={v}", base | {k: v}) for k, values in variants.items() for v in values if base.get(k) != v]
    out = []
    for label, chosen in settings:
        _, took, error = timed(lambda chosen=chosen: run_all(search(**chosen)))
        out.append({"setting": label, "seconds": took, "error": error})
    return out


def model_bench(call: Callable[[list], object], items: list, warm: int = 2) -> dict:
    """Cold and warm seconds of a model call, and milliseconds an item when warm."""
    _, cold, _ = timed(lambda: call(items), raising=True)
    again = [timed(lambda: call(items), raising=True)[1] for _ in range(warm)]
    return {"cold": cold, "warm": again, "ms_per_item": 1000 * min(again) / max(1, len(items))}
