"""What a stream reads and parses of its feed."""

import re

from skyledger.sources import cdc, fixture
from skyledger.streaming import vault_stream

from .conftest import SF_SMALL


def test_a_stream_keeps_messages_of_its_own_topics_only(spark, scratch, monkeypatch):
    feed = fixture.change_feed(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    feed.write.parquet(f"{scratch}/feed")
    seen = []
    monkeypatch.setattr(vault_stream, "load_changes_batch", lambda batch, *a, **k: seen.extend(r[0] for r in batch.select("topic").distinct().collect()))
    for name, rejects in (("own", None), ("all", f"{scratch}/rejects")):
        vault_stream.start_vault_stream(cdc.cdc_source(spark, "parquet", f"{scratch}/feed"), f"{scratch}/v", f"{scratch}/{name}", tables=["airports"],
                                        quarantine_path=rejects).awaitTermination()
        seen.append(name)
    assert seen[:2] == ["airline.public.airports", "own"]
    assert sorted(seen[2:-1]) == ["airline.public.aircrafts", "airline.public.airports"]  # a report of rejects is of all topics


def test_an_image_is_parsed_once(spark):
    feed = fixture.change_feed(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    plan = cdc.typed_images(cdc.parse_changes(feed, once=True), "airports")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\([^\n]*?airport_code", plan)) == 1
