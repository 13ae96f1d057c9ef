import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakekit.session import local_session  # noqa: E402

NOW = 1_704_153_600  # 2024-01-02 00:00 UTC


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_posts(spark):
    words = ["data", "model", "table", "query", "stream"]
    rows = [
        (
            "post",
            f"p{i:05d}",
            "ch_ds",
            "datascience" if i % 2 == 0 else "learning",
            False,
            NOW - 3600 * i,
            f"/c/{i}",
            f"{words[i % 5]} {words[(i + 2) % 5]} title {i}" + ("?" if i % 3 == 0 else ""),
            "[removed]" if i % 4 == 0 else f"text about {words[(i + 1) % 5]} number {i}",
            "self.text",
            None if i % 2 == 0 else f"https://e.com/{i}",
            i - 5,
        )
        for i in range(50)
    ]
    schema = (
        "type string, id string, `channel.id` string, `channel.name` string, "
        "`channel.nsfw` boolean, created_utc long, permalink string, title string, "
        "selftext string, domain string, url string, score long"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def raw_comments(spark):
    rows = [
        (
            "comment",
            f"c{i:05d}",
            "ch_ds",
            "engineering",
            False,
            NOW - 1800 * i,
            f"/c/{i}",
            "[deleted]" if i % 5 == 0 else f"a comment with some words {i}",
            "0.5" if i % 2 == 0 else "-0.3",
            i % 20,
        )
        for i in range(60)
    ]
    schema = (
        "type string, id string, `channel.id` string, `channel.name` string, "
        "`channel.nsfw` boolean, created_utc long, permalink string, body string, "
        "sentiment string, score long"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def events(raw_posts, raw_comments):
    from lakekit.operators.silver import to_events

    return to_events(raw_posts, raw_comments, topic="ds").cache()
