"""Check-gated build: a table is built only when every check on the tables before it has passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from martworks.checks.suite import ERROR, PASS, SKIP, Check, run_checks
from martworks.session import written
from martworks.sources.tables import Buckets, as_table, as_view

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """A table to build from the tables named in `needs`. `kind` is `view` (stays lazy) or `table` (is written)."""

    name: str
    kind: str
    needs: tuple[str, ...]
    build: Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Fixture:
    """A check of a step's logic on fixed rows; it runs before the step and returns failing rows."""

    model: str
    name: str
    failing: Callable[[SparkSession], DataFrame]


def _ancestors(steps: Sequence[Step]) -> dict[str, set[str]]:
    """Every table before a step. Steps are listed after the steps they need."""
    found: dict[str, set[str]] = {}
    for step in steps:
        found[step.name] = set(step.needs).union(*(found.get(n, set()) for n in step.needs))
    return found


def gated_build(
    spark: SparkSession,
    steps: Sequence[Step],
    checks: Sequence[Check] = (),
    fixtures: Sequence[Fixture] = (),
    given: Tables | None = None,
    publish: Callable[[Step, DataFrame], DataFrame] | None = None,
    threads: int = 4,
) -> DataFrame:
    """Build every step once all its needs are built, and run every check once all its tables are. Returns one row per
    node: `node, kind, status, failures, message`; the message is that of a step that could not be built or a check that could
    not run, which counts as failed.

    A failed check leaves its own table built but skips every step that depends on all tables of the check, and with
    it that step's checks and descendants. Skipped tables are not touched, so an earlier version keeps serving.
    `given` holds tables that exist already. `publish` stores a built step and returns what later steps read; without
    it a view becomes a temporary view and a table is written to the shared folder.

    Steps that became possible together are stored at the same time, by at most `threads` threads, and their checks
    are counted in one job."""
    publish = publish or _publish
    tables: dict[str, DataFrame] = dict(given or {})
    known = set(tables) | {s.name for s in steps}
    ancestors = _ancestors(steps)
    blocked: set[str] = set()
    failed_checks: list[Check] = []
    waiting = list(steps)
    pending = [c for c in checks if set(c.models) <= known]
    result: list[tuple[str, str, str, int | None, str | None]] = []

    def stored(step: Step) -> DataFrame | str:
        try:
            return publish(step, step.build(tables))
        except PySparkException as error:
            return str(error)

    def counted(due: list[Check]) -> dict[tuple[str, str], int | str]:
        """Failures by check, or why a check could not run. If one cannot, each runs alone."""
        try:
            return {(r["model"], r["check"]): r["failures"] for r in run_checks(tables, due).collect()}
        except PySparkException as error:
            if len(due) == 1:
                return {(due[0].model, due[0].name): str(error)}
            return {key: found for check in due for key, found in counted([check]).items()}

    while waiting:
        settled = set(tables) | blocked
        ready = [s for s in waiting if set(s.needs) <= settled]
        if not ready:
            raise ValueError(f"steps need tables that nothing builds: {[s.name for s in waiting]}")
        waiting = [s for s in waiting if s not in ready]

        runnable = []
        for step in ready:
            stopped = bool(blocked.intersection(step.needs)) or any(
                set(c.models) <= ancestors[step.name] for c in failed_checks
            )
            for fixture in (f for f in fixtures if f.model == step.name):
                failures = None if stopped else fixture.failing(spark).count()
                result.append((fixture.name, "fixture", _status(failures), failures, None))
                stopped = stopped or bool(failures)
            if stopped:
                blocked.add(step.name)
                result.append((step.name, step.kind, SKIP, None, None))
            else:
                runnable.append(step)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            outcomes = list(pool.map(stored, runnable))
        for step, df in zip(runnable, outcomes):
            message = df if isinstance(df, str) else None
            result.append((step.name, step.kind, ERROR if message else PASS, None, message))
            if message:
                blocked.add(step.name)
            else:
                tables[step.name] = df

        skipped = [c for c in pending if blocked.intersection(c.models)]
        due = [c for c in pending if c not in skipped and set(c.models) <= set(tables)]
        pending = [c for c in pending if c not in skipped and c not in due]
        result += [(f"{c.model}: {c.name}", "check", SKIP, None, None) for c in skipped]
        if due:
            found = counted(due)
            for check in due:
                failures = found[(check.model, check.name)]
                message = failures if isinstance(failures, str) else None
                number = None if message else failures
                status = ERROR if message else _status(failures)
                result.append((f"{check.model}: {check.name}", "check", status, number, message))
                if failures:
                    failed_checks.append(check)

    return spark.createDataFrame(result, "node string, kind string, status string, failures bigint, message string")


def _status(failures: int | None) -> str:
    return SKIP if failures is None else ERROR if failures else PASS


def _publish(step: Step, df: DataFrame) -> DataFrame:
    return as_view(df, step.name) if step.kind == "view" else written(df, step.name, "zstd")


def to_catalog(
    folder: str, database: str | None = None, buckets: Mapping[str, Buckets] | None = None
) -> Callable[[Step, DataFrame], DataFrame]:
    """A `publish` for `gated_build` that keeps tables in the catalog: each build writes a new version under `folder`
    and switches to it, so a skipped table goes on serving its last good version."""

    def publish(step: Step, df: DataFrame) -> DataFrame:
        if step.kind == "view":
            return as_view(df, step.name)
        name = f"{database}.{step.name}" if database else step.name
        return as_table(df, name, folder, bucket_by=(buckets or {}).get(step.name))

    return publish
