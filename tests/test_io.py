"""Sources, sinks, sample, options, the job and the streams."""

import json
import os
import time
from datetime import UTC, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import job
from chatterlens.operators import dedup, signal
from chatterlens.operators.normalize import conform, misfit_posts, normalise_posts
from chatterlens.options import JobOptions
from chatterlens.plans import signals
from chatterlens.plans.runs import RunLog
from chatterlens.schema import POST_SCHEMA
from chatterlens.session import scratch_dir, stored
from chatterlens.sources import posts as io
from chatterlens.sources import results, sample
from chatterlens.streaming import stateful

NOW = datetime(2024, 1, 31, tzinfo=UTC)


def test_parquet_round_trip_and_append(spark, make_posts):
    posts = make_posts({"content": "a", "hashtags": ["x"]}, {"content": "b"})
    path = io.write_posts(posts, scratch_dir(spark, "p"), "gzip")
    assert io.read_posts(spark, path).schema == POST_SCHEMA
    io.write_posts(posts, path, mode="append")
    assert io.read_posts(spark, path).count() == 4
    assert any("gz" in name for name in os.listdir(path))


def test_missing_path(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        io.read_posts(spark, scratch_dir(spark, "absent"))


def test_empty_batch_keeps_the_schema(spark):
    path = io.write_posts(io.empty_posts(spark), scratch_dir(spark, "empty"))
    stored = io.read_posts(spark, path)
    assert stored.count() == 0 and stored.schema == POST_SCHEMA


def test_null_lists_become_empty(spark, make_posts):
    path = io.write_posts(make_posts({"hashtags": None, "mentions": None}), scratch_dir(spark, "n"))
    row = io.read_normalised_posts(spark, path).first()
    assert (row.hashtags, row.mentions) == ([], [])


def test_lake(spark, make_posts):
    posts = make_posts({"hashtags": ["a", "b", "a"]}, {"hashtags": []})
    lake = io.read_lake(spark, io.write_lake(posts, scratch_dir(spark, "lake")))
    assert sorted((r.post_id, r.hashtag or "") for r in lake.collect()) == [(0, "a"), (0, "b"), (1, "")]
    assert lake.filter("hashtag = 'a'").first().date.isoformat() == "2024-01-01"


def test_lake_of_batches_equals_one_of_all(spark, make_posts):
    """The second batch runs twice, first with a post too many; made-up tags share folders."""
    rows = [{"hashtags": [f"t{i}", "hot", "~3" if i % 2 else ""][: i % 4]} for i in range(120)]
    posts = make_posts(*rows)
    path = scratch_dir(spark, "lake")
    for batch, part in ((0, "post_id < 50"), (1, "post_id >= 49"), (1, "post_id >= 50")):
        io.write_lake(posts.filter(part), path, batch, own_folders=3, shared_folders=4)
    whole = io.read_lake(spark, io.write_lake(posts, scratch_dir(spark, "lake"), own_folders=3, shared_folders=4))
    lake = io.read_lake(spark, path)
    key = lambda r: (r.post_id, str(r.hashtag), str(r.date), r.content)
    assert sorted(map(key, lake.collect())) == sorted(map(key, whole.collect()))
    assert lake.select("batch", "date", "folder").distinct().count() <= 2 * (3 + 4 + 1)
    for tag in ("hot", "t7", "~3", "", "nowhere"):
        got = io.read_lake(spark, path, tag, shared_folders=4)
        assert sorted(map(key, got.collect())) == sorted(key(r) for r in lake.filter(F.col("hashtag") == tag).collect())
        assert got.select(F.input_file_name()).distinct().count() <= 4


def test_lake_posts_are_shuffled_once_whatever_their_tags(spark, make_posts, capsys):
    own = spark.createDataFrame([("a",)], "_tag string")
    rows = io.lake_rows(make_posts({"hashtags": ["a", "b", "a"]}, {}), own, 2)
    capsys.readouterr()
    rows.explain("extended")
    plan = capsys.readouterr().out.split("Optimized Logical Plan")[1].split("Physical Plan")[0]
    assert plan.index("Generate explode") < plan.index("RebalancePartitions")
    found = sorted((r.post_id, r.hashtag or "", r.folder) for r in rows.collect())
    assert [f[:2] for f in found] == [(0, "a"), (0, "b"), (1, "")]
    assert found[0][2] == "a" and found[1][2].startswith("~") and found[2][2] == "~none"


def test_json_codec(spark, make_posts):
    posts = normalise_posts(make_posts({"content": 'q " ü', "hashtags": ["#A"], "timestamp": datetime(2024, 1, 1, 1, 2, 3, 4000, tzinfo=UTC)}))
    lines = io.to_json_lines(posts)
    assert json.loads(lines.first().value)["timestamp"] == "2024-01-01T01:02:03.004000+00:00"
    assert io.from_json_lines(lines).select(posts.columns).collect() == posts.collect()
    texts = [
        '{"timestamp": "2024-01-01T00:00:00"}',
        '{"timestamp": "2024-01-01T00:00:00+00:00", "likes": "7", "replies": 2.9, "hashtags": ["#X"]}',
        '{"timestamp": "soon"}',
        '{"username": "x"}',
        '{"timestamp": "2024-01-01T00:00:00Z", "likes": "many"}',
        "not json",
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    good = io.from_json_lines(raw).collect()
    assert sorted((r.username, r.likes, r.replies, tuple(r.hashtags)) for r in good) == [("", 0, 0, ()), ("", 7, 2, ("x",))]
    assert io.rejected_json_lines(raw).count() == 4


def test_json_files_feed_the_pipeline(spark, make_posts):
    posts = normalise_posts(make_posts({"content": "a"}, {"content": "b"}, {"content": "b"}))
    path = io.write_json_posts(posts, scratch_dir(spark, "lines"))
    assert sorted(io.read_json_posts(spark, path).select(posts.columns).collect()) == sorted(posts.collect())
    from_json, direct = (signals.prepared_posts(p).collect() for p in (io.read_json_posts(spark, path), posts))
    assert sorted(from_json) == sorted(direct)


def test_misfits_are_set_aside(spark):
    raw = spark.createDataFrame(
        [("1", "a", "7"), ("2", "b", "x"), ("many", "c", None), ("4", "d", "1.5x")], "post_id string, username string, likes string"
    )
    assert [tuple(r) for r in conform(raw).collect()] == [(1, "a", 7)]
    assert {r.username: r.unreadable for r in misfit_posts(raw).collect()} == {"b": ["likes"], "c": ["post_id"], "d": ["likes"]}
    assert misfit_posts(conform(raw)).count() == 0


def test_raw_zone(spark):
    from chatterlens.schema import CAPTURE_SCHEMA

    cards = spark.createDataFrame([(1, "#a") + (None,) * 11], CAPTURE_SCHEMA)
    path = io.write_captures(cards, scratch_dir(spark, "raw"))
    assert io.read_captures(spark, path).collect() == cards.collect()


def test_sample_is_stable_and_in_range(spark):
    many = sample.generate_posts(spark, 500, NOW, seed=3)
    assert many.orderBy("post_id").collect() == sample.generate_posts(spark, 500, NOW, seed=3).repartition(5).orderBy("post_id").collect()
    assert many.select("username").distinct().count() == 500
    gap = (F.unix_seconds(F.lit(NOW)) - F.unix_seconds("timestamp")) / 60
    low, high = many.select(F.min(gap), F.max(gap)).first()
    assert 12 <= low <= 17 and 6000 <= high <= 6005
    assert sample.generate_posts(spark, 50, NOW, 1).collect() != sample.generate_posts(spark, 50, NOW, 2).collect()


def test_fallback(spark, make_posts):
    assert sample.posts_or_sample(io.empty_posts(spark), 2000, NOW).count() == 2000
    assert sample.posts_or_sample(io.empty_posts(spark), 7, NOW).count() == 7
    assert sample.posts_or_sample(make_posts({}), 7, NOW).count() == 1


def test_options():
    options = JobOptions("out/", NOW, 24, search_hashtags=("x", " #y"))
    assert options.search_hashtags == ("#x", "#y") and options.processed_dir == "out/processed"
    for bad in ({"max_posts": 0}, {"cutoff_hours": -1}, {"search_hashtags": (" ",)}):
        with pytest.raises(ValueError):
            JobOptions(**{"output_dir": "o", "as_of": NOW, "cutoff_hours": 1, **bad})
    env = {"SEARCH_HASHTAGS": "a, b", "MAX_TWEETS": "5", "CUTOFF_HOURS": "9", "OUTPUT_DIR": "d"}
    made = JobOptions.from_env(env, NOW, max_posts=6)
    assert (made.search_hashtags, made.max_posts, made.cutoff_hours, made.output_dir) == (("#a", "#b"), 6, 9, "d")
    with pytest.raises(SystemExit):
        job.parse_args(["--max-tweets", "0"])
    assert job.options_from(job.parse_args(["--as-of", "2024-01-31", "--output-dir", "z"])).as_of == NOW


def test_run_writes_every_output(spark):
    options = JobOptions(scratch_dir(spark, "run"), NOW, 24)
    raw = sample.generate_posts(spark, 60, NOW, 5)
    done = signals.run(spark, raw.unionByName(raw), options)
    assert io.read_posts(spark, done.posts_path).count() == 60
    summary = spark.read.json(done.summary_path).first()
    assert summary.total_tweets == 60 and summary.ci_95_lower <= summary.mean_signal <= summary.ci_95_upper
    assert results.read_keywords(spark, done.keywords_path).count() == 10
    csv = spark.read.options(**results.CSV_OPTIONS).csv(done.features_path)
    assert "bearish_keyword_count" in csv.columns and csv.count() == 60
    assert set(done.chart_paths) == {"posts_over_time", "top_hashtags", "engagement_histogram", "signal_chart"}
    assert spark.read.parquet(done.chart_paths["signal_chart"]).count() == 30


def test_run_counts(spark, make_posts):
    raw = make_posts({"content": "a"}, {"content": "a"}, {"content": "http://x.example/"}, {"content": "b"}, {"content": None})
    done = signals.run(spark, raw, JobOptions(scratch_dir(spark, "run"), NOW, 24))
    assert (done.total, done.retained, done.unique, done.duplicates) == (4, 3, 2, 1)
    assert done.posts_per_second > 0 and spark.read.parquet(done.rejected_path).count() == 1


def test_batches_with_known_fingerprints_keep_all_posts(spark, make_posts):
    root = scratch_dir(spark, "job")
    posts = normalise_posts(make_posts({"content": "a"}, {"content": "b"}, {"content": "c"}))
    io.write_json_posts(posts.filter("content <> 'c'"), f"{root}/one")
    io.write_json_posts(posts.filter("content <> 'a'"), f"{root}/two")
    log = RunLog(spark, f"{root}/out/processed")
    for batch, name, new in ((0, "one", ["a", "b"]), (1, "two", ["c"]), (1, "two", ["c"])):
        args = ["--json", f"{root}/{name}", "--known", f"{root}/known", "--batch", str(batch), "--output-dir", f"{root}/out"]
        assert job.main(args) == 0
        assert sorted(r.content for r in io.read_posts(spark, f"{log.latest()}/posts").collect()) == new
    assert sorted(r.content for r in log.posts().collect()) == ["a", "b", "c"]
    assert dedup.FingerprintStore(spark, f"{root}/known").known().count() == 3


def test_a_lost_run_leaves_the_earlier_one(spark, make_posts, monkeypatch):
    """Lost between outputs, and lost after the log but before the fingerprints."""
    options = JobOptions(scratch_dir(spark, "run"), NOW, 24)
    store, log = dedup.FingerprintStore(spark, f"{options.output_dir}/known"), RunLog(spark, options.processed_dir)
    first, second = make_posts({"content": "a"}), make_posts({"content": "a"}, {"content": "b"})
    done = signals.run(spark, first, options, store, 0)

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(signals, "summarise", lost)
    with pytest.raises(RuntimeError):
        signals.run(spark, second, options, store, 1)
    monkeypatch.undo()
    assert log.latest() == done.run_path and spark.read.json(f"{log.latest()}/signal_summary").first().total_tweets == 1
    assert [r.content for r in log.posts().collect()] == ["a"]

    monkeypatch.setattr(dedup.FingerprintStore, "commit", lost)
    with pytest.raises(RuntimeError):
        signals.run(spark, second, options, store, 1)
    monkeypatch.undo()
    third = signals.run(spark, second, options, store, 2)
    assert third.unique == 0 and store.batches() == {0, 1}  # the third batch has no post
    assert sorted(r.content for r in log.posts().collect()) == ["a", "b"]


def test_rejected_lines_are_written_and_counted(spark, tmp_path, caplog):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"timestamp": "2024-01-01T00:00:00Z", "content": "x"}\n{"timestamp": "soon"}\nno json\n')
    assert job.main(["--json", str(tmp_path / "in"), "--output-dir", str(tmp_path / "out")]) == 0
    run_path = RunLog(spark, str(tmp_path / "out" / "processed")).latest()
    rows = spark.read.parquet(f"{run_path}/rejected_lines").orderBy("line").collect()
    assert [(r.line, r.value) for r in rows] == [(1, '{"timestamp": "soon"}'), (2, "no json")] and rows[0].file.endswith("a.json")
    assert io.read_posts(spark, f"{run_path}/posts").count() == 1


def test_lines_keep_their_keys_however_files_are_split(spark, tmp_path, monkeypatch):
    """Copies without keys: the same one is first for every partitioning."""
    (tmp_path / "in").mkdir()
    for name, k in (("b", 0), ("a", 1), ("c", 2)):
        lines = [json.dumps({"username": f"u{i % 40}", "timestamp": "2024-01-01T00:00:00Z", "content": f"t{i % 11}", "likes": 7 * i + k}) for i in range(1500 + k)]
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines) + "\n")
    results_ = []
    for size in ("128m", "40k", "9k", "701"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            rows = io.read_json_lines(spark, str(tmp_path / "in"))
            keys = {(r.file[-6:], r.line): (r.line_key, r.value) for r in rows.collect()}
            unique = dedup.deduplicate(io.read_json_posts(spark, str(tmp_path / "in")))
            results_.append((keys, sorted((r.ingest_seq, r.post_id, r.fingerprint, r.likes) for r in unique.collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(r == results_[0] for r in results_)
    assert len(results_[0][0]) == 4503 and len(results_[0][1]) == 440
    assert {k[0]: v[0] >> 40 for k, v in results_[0][0].items()} == {"a.json": 0, "b.json": 1, "c.json": 2}
    assert all(r[3] % 7 == 1 for r in results_[0][1])  # all from the first file by name


def test_copies_without_keys_are_told_apart_by_their_columns(make_posts):
    posts = make_posts(*[{"ingest_seq": None, "likes": n} for n in (891, 30, 718, 119)])
    got = {dedup.deduplicate(posts.repartition(p)).first().likes for p in (1, 2, 3, 4)}
    assert got == {30}


def test_cutoff_of_nothing_is_refused():
    with pytest.raises(ValueError, match="cutoff_hours"):
        job.options_from(job.parse_args(["--cutoff-hours", "0"]))
    assert job.options_from(job.parse_args([])).cutoff_hours == 168


def test_run_on_nothing_leaves_empty_tables(spark):
    done = signals.run(spark, io.empty_posts(spark), JobOptions(scratch_dir(spark, "run"), NOW, 24))
    assert io.read_posts(spark, done.posts_path).count() == 0
    assert spark.read.json(done.summary_path).first().signal_label == "HOLD"


def test_streaming_dedup_and_exact_store(spark, make_posts):
    root = scratch_dir(spark, "stream")
    first = make_posts({"username": "a"}, {"username": "b"}, {"username": "A"})
    io.write_posts(first, f"{root}/in")
    io.write_posts(make_posts({"username": "b"}, {"username": "c"}), f"{root}/in", mode="append")
    stream = stateful.read_post_stream(spark, f"{root}/in", max_files_per_trigger=1)
    once = stateful.flush_stream(stateful.deduplicate_stream(stream), spark, "d", root)
    assert once.select("fingerprint").distinct().count() == once.count() == 3

    store = dedup.FingerprintStore(spark, f"{root}/hashes")
    write = stateful.foreach_batch_dedup(store, f"{root}/exact")
    query = (
        stateful.read_post_stream(spark, f"{root}/in", max_files_per_trigger=1)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/exact-state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/exact").count() == 3 and store.known().count() == 3


def test_streams_go_on_where_they_stopped(spark, make_posts):
    """Stopped, given more files and started again: equal to the batch, with state in RocksDB."""
    root = scratch_dir(spark, "restart")
    parts = [make_posts({"username": "a"}, {"username": "b"}, {"username": "A"}), make_posts({"username": "b"}, {"username": "c"}, {"username": "d"})]
    for part in parts:
        io.write_posts(part, f"{root}/in", mode="append")
        stream = stateful.deduplicate_stream(stateful.read_post_stream(spark, f"{root}/in"), "60 days").select("fingerprint")
        got = stateful.flush_stream(stream, spark, "d", root)
    want = dedup.deduplicate(parts[0].unionByName(parts[1]))
    assert sorted(r.fingerprint for r in got.collect()) == sorted(r.fingerprint for r in want.collect())
    state = [os.path.join(d, f) for d, _, names in os.walk(f"{root}/d-state/state") for f in names]
    assert any(f.endswith((".changelog", ".zip")) for f in state) and not any(f.endswith(".delta") for f in state)


def test_rolling_stream_equals_batch(spark):
    root = scratch_dir(spark, "rolling")
    rows = spark.range(200).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 97).alias("timestamp"),
        (F.sin("id")).alias("weighted_signal"),
    )
    end = spark.sql("select timestamp'2024-03-01 00:00:00Z' as timestamp, cast(0 as double) as weighted_signal")
    rows.write.parquet(f"{root}/in/part=0")
    end.write.parquet(f"{root}/in/part=1")
    stream = spark.readStream.schema("timestamp timestamp, weighted_signal double, part int").parquet(f"{root}/in")
    got = stateful.flush_stream(stateful.rolling_signal_stream(stream), spark, "r", root)
    want = signal.rolling_summary(rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def left_by(spark, make):
    """Shuffle files that are still there some seconds after ``make`` has run."""
    before = shuffle_files(spark)
    make()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def several_posts(make_posts):
    return make_posts(*[{"username": f"u{i % 40}", "content": f"gain of lot {i % 40}", "hashtags": [f"t{i % 3}"]} for i in range(80)])


def test_a_run_keeps_no_shuffle_files(spark, make_posts, tmp_path):
    """Each output is stored, so what was shuffled for it need not stay on the executors' disks, nor does the setting."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    options = JobOptions(str(tmp_path), datetime(2024, 1, 31, tzinfo=UTC), 168)
    posts = several_posts(make_posts)
    left = left_by(spark, lambda: signals.run(spark, posts, options))
    # A stage that a query no longer waits for may write late on a busy machine.
    assert len({name.split("_")[1] for name in left}) <= 2
    assert spark.conf.get(name, None) == before


def test_writing_a_lake_keeps_no_shuffle_files(spark, make_posts):
    posts = io.read_posts(spark, io.write_posts(several_posts(make_posts), scratch_dir(spark, "posts")))
    assert not left_by(spark, lambda: io.write_lake(posts, scratch_dir(spark, "lake")))


def test_stored_tables_keep_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert not left_by(spark, lambda: stored(rows, "rows"))
    assert sorted(map(tuple, stored(rows, "rows").collect())) == sorted(map(tuple, rows.collect()))


def test_compressed_json_lines_are_numbered_alike(spark, make_posts):
    posts = several_posts(make_posts).orderBy("ingest_seq")
    paths = [scratch_dir(spark, "lines") for _ in range(2)]
    assert not left_by(spark, lambda: io.write_json_posts(posts, paths[0], keyed=False, compression="gzip"))
    io.write_json_posts(posts, paths[1], keyed=False)
    packed, plain = (signals.prepared_posts(io.read_json_posts(spark, p)).drop("post_id", "ingest_seq") for p in paths)
    assert sorted(packed.collect()) == sorted(plain.collect())
    assert packed.count() == 40 and all(f.endswith(".txt.gz") for f in spark.read.text(paths[0]).inputFiles())
