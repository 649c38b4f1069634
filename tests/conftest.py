from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from armlens.domain import ENVELOPE  # noqa: E402
from armlens.session import local_session  # noqa: E402
from armlens.sources.landing import land  # noqa: E402
from armlens.sources.local import local_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


ENVELOPE_SCHEMA = ", ".join(f"{name} string" for name in ENVELOPE)


def event(event_id, user="u_1", name="app_installed", at="2026-06-15T10:00:00+00:00", arm="A",
          platform="iOS", session="s1", **props):
    """One envelope row; a payload given as ``raw`` is taken as it is."""
    text = props["raw"] if "raw" in props else json.dumps(props)
    return (event_id, user, name, at, arm, platform, session, text)


@pytest.fixture
def envelope(spark):
    return lambda rows: local_frame(spark, rows, ENVELOPE_SCHEMA)


@pytest.fixture
def landed(envelope):
    return lambda rows, **options: land(envelope(rows), source_file="test", **options)


def as_dicts(frame, *order):
    rows = [row.asDict(recursive=True) for row in frame.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
