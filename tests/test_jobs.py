from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from eventloom import jobs
from eventloom.plans.pipeline import Lake
from eventloom.streaming import streams
from tests.conftest import write_feed
from tests.test_pipeline import hour_messages
from tests.test_streaming import write_lines


def test_backfill_load_and_anomalies(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(jobs, "now", lambda: datetime(2024, 1, 6, 3, 30))
    hours = [datetime(2024, 1, 5, 22), datetime(2024, 1, 5, 23)]
    for h in hours:
        write_feed(tmp_path / f"feed/2024-01-05-{h.hour}.json.gz", hour_messages(h, 12))
    lake, feed = str(tmp_path / "lake"), str(tmp_path / "feed")
    jobs.main(["backfill", "--lake", lake, "--feed", feed, "--start-date", "2024-01-05",
               "--end-date", "2024-01-05"])
    jobs.main(["load", "--lake", lake, "--at", "2024-01-05T22:00"])
    assert "processed 12, inserted 12, rejected 0" in capsys.readouterr().out
    assert Lake(spark, lake).raw().count() == 12
    jobs.main(["anomalies", "--lake", lake])
    assert Lake(spark, lake).detected_anomalies().count() == 0


def test_stream_load_refreshes_the_models(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "now", lambda: datetime(2024, 1, 6, 3, 30))
    lake = Lake(spark, str(tmp_path / "lake"))
    for day in (5, 3):  # the second delivery is two days late
        write_lines(tmp_path / "in", f"{day}.json", list(hour_messages(datetime(2024, 1, day, 7), 12)))
        messages = streams.read_message_files(spark, str(tmp_path / "in"))
        streams.land_stream(
            messages, lake.path("landing_stream"), str(tmp_path / "progress"), interval=None
        ).awaitTermination()
        jobs.main(["stream-load", "--lake", lake.root, "--checkpoint", str(tmp_path / "load")])
    assert lake.raw().count() == 24
    days = {r.event_date.day: r.total_events for r in lake.daily_repo().filter("repo_id = 1").collect()}
    assert days == {3: 3, 5: 3}
    top = lake.mart("mart_trending_repos").filter("repo_id = 1").first()
    assert top.total_events == 6
    # The batch load sees the stream's hours too.
    jobs.main(["load", "--lake", lake.root, "--at", "2024-01-03T07:00"])
    assert lake.raw().count() == 24


def test_defaults_follow_the_source_lag(monkeypatch):
    monkeypatch.setattr(jobs, "now", lambda: datetime(2024, 1, 6, 3, 30))
    assert jobs.now() - jobs.SOURCE_LAG == datetime(2024, 1, 6, 1, 30)
    assert jobs.SOURCE_LAG == timedelta(hours=2)


def test_unknown_job():
    with pytest.raises(SystemExit):
        jobs.main(["nothing"])
