from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from leaguelake.session import local_session  # noqa: E402
from leaguelake.sources.store import Lake, clear_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_session(session)
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


class Inbox:
    """Payload files as the loader finds them."""

    def __init__(self, folder: Path) -> None:
        self.folder = folder

    def put(self, dataset: str, competition: str, season: str | None, payload, name: str = "a") -> None:
        text = payload if isinstance(payload, str) else json.dumps(payload)
        target = self.folder / dataset
        target.mkdir(parents=True, exist_ok=True)
        line = {"dataset": dataset, "competition_code": competition, "season": season, "payload": text}
        (target / f"{name}-{competition}-{season}.json").write_text(json.dumps(line) + "\n")

    def __str__(self) -> str:
        return str(self.folder)


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "inbox")
