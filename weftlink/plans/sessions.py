"""A run in two sessions: each stage in a process of its own, a later session reading what an earlier one left."""

from __future__ import annotations

import argparse
import subprocess
import sys
from collections.abc import Callable

#: Stages and splits of each session, in order.
SESSIONS = {
    "first": [
        *[("ingest", s) for s in ("train", "test")], ("split", "train"), ("lexicon", "train"), *[(n, s) for n in ("normalize", "block") for s in ("train", "test")],
        ("cheap_train", "train"), *[("cheap_apply", s) for s in ("train", "test")],
    ],
    "second": [*[("features", s) for s in ("train", "test")], ("train", "train"), ("evaluate", "train"), ("predict", "test"), ("submit", "test")],
}


def commands(session: str, config_path: str, previous: list[str] | None = None, overrides: list[str] | None = None) -> list[list[str]]:
    """One command line for each stage; previous are work folders of earlier sessions, looked through in order."""
    sets = [*([f"prev_work_dirs=[{','.join(previous)}]"] if previous else []), *(overrides or [])]
    more = [x for s in sets for x in ("--set", s)]
    return [[sys.executable, "-m", "weftlink.plans.stages", "--config", config_path, "--stage", stage, "--split", split, *more] for stage, split in SESSIONS[session]]


def run(session: str, config_path: str, previous: list[str] | None = None, overrides: list[str] | None = None, start: Callable[[list[str]], object] | None = None) -> None:
    """Run a session's stages one after another; the first that fails ends it."""
    start = start or (lambda command: subprocess.run(command, check=True))
    for command in commands(session, config_path, previous, overrides):
        start(command)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Run one session of a linkage run.")
    p.add_argument("--session", required=True, choices=list(SESSIONS))
    p.add_argument("--config", required=True)
    p.add_argument("--previous", action="append", default=[], help="work folder of an earlier session")
    p.add_argument("--set", action="append", default=[], metavar="a.b=value")
    a = p.parse_args(argv)
    run(a.session, a.config, a.previous, a.set)


if __name__ == "__main__":
    main()
