import datetime as dt
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.session import checkpoint_dir, local_session, use_utc  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"
MID_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = use_utc(local_session("*", shuffle_partitions=8, app="tributary-tests"))
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def tmp_lake():
    return tempfile.mkdtemp(prefix="tributary-lake-")


BASE_TS = dt.datetime(2024, 1, 5, 12, 0, 0)


def event(**overrides):
    """A valid change event as a dict; ``overrides`` replace fields
    (a value of ``...`` removes the field)."""
    body = {
        "id": 1,
        "type": "edit",
        "namespace": 0,
        "title": "Test",
        "title_url": "https://en.example.org/Test",
        "comment": "c",
        "parsedcomment": "pc",
        "timestamp": int(BASE_TS.replace(tzinfo=dt.timezone.utc).timestamp()),
        "user": "Ed",
        "bot": False,
        "server_name": "en.example.org",
        "wiki": "enwiki",
        "meta": {"id": "abc", "domain": "en.example.org", "stream": "rc",
                 "dt": BASE_TS.strftime("%Y-%m-%dT%H:%M:%SZ")},
    }
    meta = overrides.pop("meta", None)
    if meta:
        body["meta"].update(meta)
        body["meta"] = {k: v for k, v in body["meta"].items() if v is not ...}
    body.update(overrides)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def kafka_frame(spark, values, ingested_at=None):
    """Kafka-layout frame from raw message texts (or (text, partition, offset))."""
    rows = []
    for i, item in enumerate(values):
        text, partition, offset = item if isinstance(item, tuple) else (item, 0, i)
        rows.append((None, None if text is None else text.encode(), "rc", partition, offset,
                     BASE_TS))
    from tributary.schemas import KAFKA_SCHEMA

    df = spark.createDataFrame(rows, KAFKA_SCHEMA)
    return df
