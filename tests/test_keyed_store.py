"""The keyed store against the model: batches, replays, untouched buckets and streams."""

import datetime as dt
import os
import random

from forumflow.schemas import STATE
import pytest

from forumflow.operators.typed import post_rows, type_posts
from forumflow.sources.keyed import KeyedStore
from forumflow.streaming import ingest
from forumflow.streaming.ingest import read_item_stream, running_counters, stream_upsert
from tests.model import Model
from tests.test_batch import START, compare, frame, item, random_items

BUCKETS = {"post": 8, "comment": 8, "community": 2, "post_mark": 2, "comment_mark": 2}


def outputs(store):
    return {**{name: store.table(name) for name in STATE}, "rejects": store.rejects()}


def snapshot(store):
    return {name: sorted(map(repr, rows.collect())) for name, rows in outputs(store).items()}


def test_batches_equal_the_model_and_a_replay_changes_nothing(spark, tmp_path):
    items = random_items(random.Random(11), 150)
    parts = [items[:60], items[60:100], items[100:]]
    store, model = KeyedStore(spark, str(tmp_path / "s"), BUCKETS), Model()
    for n, part in enumerate(parts):
        store.apply(frame(spark, part), START + dt.timedelta(days=n), batch_id=n)
        model.run(part, START + dt.timedelta(days=n))
    compare(outputs(store), model)
    before = snapshot(store)
    store.apply(frame(spark, parts[2]), START + dt.timedelta(days=5), batch_id=2)
    assert snapshot(store) == before


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), {**BUCKETS, "post": 32})
    items = random_items(random.Random(2), 80)
    store.apply(frame(spark, items), START, batch_id=0)
    folder = tmp_path / "s" / "post"

    def files():
        return {
            d: sorted(os.listdir(folder / d)) for d in os.listdir(folder) if d.startswith("bucket=")
        }

    first = files()
    one = [dict(items[0], seq=1000, comments=[])]
    store.apply(frame(spark, one), START, batch_id=1)
    second = files()
    changed = [b for b in first if first[b] != second.get(b)]
    assert len(changed) == 1 and len(first) > 1


def test_stream_of_several_epochs_with_a_restart(spark, tmp_path):
    items = random_items(random.Random(5), 200)
    parts = [items[i : i + 40] for i in range(0, 200, 40)]
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for n, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.json(str(tmp_path / f"part{n}"))
    store, model = KeyedStore(spark, str(tmp_path / "s"), BUCKETS), Model()
    stream = read_item_stream(spark, str(inbox), files_per_batch=1)
    epochs = 0
    for stop in (3, 5):  # three files, stop; then two more on the same checkpoint
        for n in range(epochs, stop):
            [file] = (tmp_path / f"part{n}").glob("*.json")
            (inbox / f"{n}.json").write_bytes(file.read_bytes())
            os.utime(inbox / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # arrival order
        query = stream_upsert(stream, store, str(tmp_path / "cp"), "keyed", clock=lambda: START)
        query.awaitTermination()
        batches = [p for p in query.recentProgress if p["numInputRows"]]
        # One epoch per file; a batch reads its micro-batch twice (posts, then comments).
        want = [2 * len(parts[n]) for n in range(epochs, stop)]
        assert [p["numInputRows"] for p in batches] == want
        epochs = stop
    for part in parts:  # what a first sighting fixes depends on the order of arrival
        model.run(part, START)
    compare(outputs(store), model)


def test_a_batch_failing_half_way_is_applied_again(spark, tmp_path, monkeypatch):
    store, model = KeyedStore(spark, str(tmp_path / "s"), BUCKETS), Model()
    items = random_items(random.Random(8), 90)
    store.apply(frame(spark, items[:50]), START, batch_id=0)
    model.run(items[:50], START)
    real = KeyedStore.bucket

    def fail_at_comments(self, name):
        if name == "comment_mark":
            raise OSError("lost")
        return real(self, name)

    monkeypatch.setattr(KeyedStore, "bucket", fail_at_comments)
    with pytest.raises(Exception):
        store.apply(frame(spark, items[50:]), START, batch_id=1)
    monkeypatch.undo()
    store.apply(frame(spark, items[50:]), START, batch_id=1)  # as Spark repeats an epoch
    model.run(items[50:], START)
    compare(outputs(store), model)


def test_empty_batch_and_new_store(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), BUCKETS)
    assert store.table("post").count() == 0 and store.rejects().count() == 0
    store.apply(frame(spark, []), START, batch_id=0)
    store.apply(frame(spark, [item(1)]), START, batch_id=1)
    assert [r.title for r in store.table("post").collect()] == ["T"]


def test_running_counters_equal_the_batch(spark, tmp_path):
    items = random_items(random.Random(4), 120)
    for n in range(3):
        rows = frame(spark, items[n * 40 : n * 40 + 40]).coalesce(1)
        rows.write.mode("append").json(str(tmp_path / "in"))

    def usable(rows):
        typed = post_rows(type_posts(rows))
        return typed.filter("reason is null and insert_reason is null")

    stream = read_item_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    query = (
        running_counters(usable(stream))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("counters")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    query.awaitTermination()
    batch = running_counters(usable(frame(spark, items))).collect()
    assert sorted(spark.table("counters").collect(), key=str) == sorted(batch, key=str)


def test_fold_kept_as_streaming_state_over_epochs_and_a_restart(spark, tmp_path):
    from forumflow.operators import merge
    from forumflow.streaming.ingest import latest, stream_fold

    items = random_items(random.Random(6), 160)

    def fold(rows):
        return merge.fold_posts(post_rows(type_posts(rows)))

    for run in range(2):  # two files a run, the second on the same checkpoint
        for n in (2 * run, 2 * run + 1):
            part = frame(spark, items[n * 40 : n * 40 + 40]).coalesce(1)
            part.write.mode("append").json(str(tmp_path / "in"))
        reader = read_item_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        query = stream_fold(reader, fold, str(tmp_path / "up"), str(tmp_path / "cp"), "fold")
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    got = latest(spark, str(tmp_path / "up"), "title")
    want = fold(frame(spark, items))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


def test_stream_fold_deals_each_epoch_to_as_many_files_as_tasks(spark, tmp_path, monkeypatch):
    from forumflow.plans import catalog

    events = spark.range(900, numPartitions=3).selectExpr(
        "id as event_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 97) as ts",
        "id % 40 as user_id",
        "'view' as event_type",
        "1.0D as value",
        "'text' as props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    tasks = spark.read.parquet(str(tmp_path / "events.parquet")).rdd.getNumPartitions()
    assert tasks > 1
    started = []

    def recorded(*args):
        started.append(ingest.stream_fold(*args))
        return started[-1]

    monkeypatch.setattr(catalog, "stream_fold", recorded)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = catalog.stream_fold_query(spark, str(tmp_path)).collect()
    want = catalog.fold_duplicates(spark, str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 40
    inbox = spark.read.parquet(str(tmp_path / "stream-fold" / "inbox"))
    assert len(inbox.inputFiles()) == 4 * tasks and inbox.count() == 900
    epochs = [[p for p in q.recentProgress if p["numInputRows"]] for q in started]
    assert [len(e) for e in epochs] == [2, 2]
